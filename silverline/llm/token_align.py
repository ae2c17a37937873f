"""Cross-tokenizer alignment by galloping intersection (operator 13).

Two tokenizers cut the same bytes, a space and the text: A a byte-level
vocabulary file (.json), B a byte-fallback piece model (.model), which adds the
space itself.  Each gives a rising list of end offsets.  The shorter list drives
a search into the longer one: from its proportional place an end gallops in
doubling steps until it is bracketed, and a binary search finds its rank.  Ends
that both lists hold cut the tokens into groups; the ranks of neighbouring ends
of the shorter list differ by the range of the longer list's tokens that a token
overlaps, which are its links.  All ends of a slice take each step together.

Texts are cut before a space that follows what is surely not white space: no
token of either vocabulary goes across (checked when the files are loaded), so
such a place ends a token in both.  The distinct pieces of a slice are encoded
and aligned once, and a document's groups are those of its pieces in order.

An id pair counts the documents that hold it linked.  A slice of some MB of
texts leaves as what its documents are made of, packed and cut into rows of at
most ``PART_BYTES``, and its distinct pairs with their documents.  Pairs are
summed over the corpus by key, each slice gets the counts of its own pairs back
by a join on the key, and adds them up by document.  A pair that occurs
everywhere is one row a slice, so nothing is broadcast, and no group holds more
than a slice's pairs or a vocabulary.  Small rows in small row groups keep what
the JVM reads, sorts and fetches at a time small, and parts and counts meet
slice by slice, so no Arrow batch holds a partition's slices together.

Defined cases: a null or empty text, or one whose joined token bytes differ
from the space and the text (B writes U+2581 for a space), has no tokens: zeros
and empty groups.  A text without spaces is one piece, however long; memory
follows the slice, or a longer single text.  Repeated rows are documents of their own; ties
among the highest counts are all best.  An empty table gives an empty result.
Only the id and the text column are read, so others may have any name.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from silverline.llm import common as C
from silverline.llm.token_count import cut_points
from silverline.session import stored

SLICE_BYTES = 2 << 20
BATCH_BYTES = 1 << 17
#: Bytes of a packed slice in a row, and such rows in a row group.
PART_BYTES, GROUP_ROWS = 1 << 17, 16
#: Tokens whose groups are written at a time, linked pairs counted at a time.
TEXT_TOKENS, PAIR_LINKS = 1 << 15, 1 << 18
_MARK = "▁"


def runs(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of every run, one run after another."""
    before = np.cumsum(length) - length
    out = np.repeat(start - before, length)
    out += np.arange(len(out))
    return out


def blocks(at: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of the spans ``at`` that hold some ``limit`` elements together, or one longer span."""
    edges = np.unique([0, *np.searchsorted(at, np.arange(0, at[-1], limit)), len(at) - 1]).tolist()
    return zip(edges[:-1], edges[1:])


def byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for:
    printable Latin-1 itself, the others in order from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class _Side:
    """One tokenizer in a Python worker: ids of texts, and the bytes of an id."""

    def __init__(self, name: str, content: bytes):
        if name.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_proto=content)
            tokens = []
            for i in range(model.get_piece_size()):
                piece = model.id_to_piece(i)
                tokens.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(_MARK, " ").encode())
                if _MARK in piece.lstrip(_MARK) and not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)):
                    raise ValueError("a piece goes on across a space: texts can't be cut there")
            # the model puts the space in front itself
            self.encode = lambda texts: model.encode([t[1:] for t in texts], num_threads=1)
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            model = Tokenizer.from_str(content.decode())
            model.no_truncation()
            model.no_padding()
            model.encode_special_tokens = True
            before = json.loads(content).get("pre_tokenizer") or {}
            if before.get("type") != "ByteLevel" or not before.get("use_regex", True) or before.get("add_prefix_space"):
                raise ValueError("not a byte-level vocabulary file that splits at white space")
            byte = byte_level()
            tokens = [b""] * model.get_vocab_size(with_added_tokens=True)
            for token, i in model.get_vocab(with_added_tokens=True).items():
                tokens[i] = bytes(byte[c] for c in token)
            self.encode = lambda texts: [e.ids for e in model.encode_batch_fast(texts, add_special_tokens=False)]
        self.size = len(tokens)
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.at = np.cumsum([0, *map(len, tokens)])

    def cut(self, ids: np.ndarray, content: bytes) -> np.ndarray | None:
        """End offsets of the tokens if they spell ``content``, else None."""
        width = (self.at[1:] - self.at[:-1])[ids]
        if int(width.sum()) != len(content) or self.bytes[runs(self.at[ids], width)].tobytes() != content:
            return None
        return np.cumsum(width)


def _may_end_in_space(data: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether the last character before each ``end`` might be white space."""
    last, one, two = (data[np.maximum(end - k, 0)] for k in (1, 2, 3))
    ascii_ = C.IS_SPACE[last] | ((last >= 0x1C) & (last <= 0x1F))
    wide = (one == 0xC2) | ((two == 0xE1) & (one == 0x9A)) | ((two == 0xE2) & ((one == 0x80) | (one == 0x81))) | ((two == 0xE3) & (one == 0x80))
    return np.where(last < 0x80, ascii_, wide)


def encode_pieces(side: _Side, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids, ends within the piece, offsets by piece, whether the tokens spell
    the piece) of pieces that start with a space."""
    data, off = C.text_buffers(pieces)
    size = np.diff(off)
    ids, ends, count = [], [], np.zeros(len(size), np.int64)
    spelled = np.ones(len(size), bool)
    order = []

    def alone(which: np.ndarray) -> None:
        content = [data[off[i]:off[i + 1]].tobytes() for i in which]
        for i, piece, found in zip(which, content, side.encode([c.decode() for c in content])):
            found = np.array(found, np.int64)
            cut = side.cut(found, piece)
            spelled[i] = cut is not None
            if cut is not None:
                ids.append(found)
                ends.append(cut)
                count[i] = len(cut)
                order.append([i])

    def together(which: np.ndarray) -> None:
        joined = data[runs(off[which], size[which])].tobytes()
        found = np.array(side.encode([joined.decode()])[0], np.int64)
        cut = side.cut(found, joined)
        bounds = np.concatenate([[0], np.cumsum(size[which])])
        last = None if cut is None else np.searchsorted(cut, bounds, side="right")
        if cut is None or (cut[last[1:] - 1] != bounds[1:]).any():
            return alone(which)
        count[which] = np.diff(last)
        ids.append(found)
        ends.append(cut - np.repeat(bounds[:-1], np.diff(last)))
        order.append(which)

    # pieces that end in white space would join the next one's space
    lone = _may_end_in_space(data, off[1:]) | (size > BATCH_BYTES) if len(data) else np.zeros(0, bool)
    some = np.flatnonzero(~lone)
    batch = np.cumsum(size[some]) // BATCH_BYTES
    for which in np.split(some, np.flatnonzero(np.diff(batch)) + 1):
        if len(which):
            together(which)
    alone(np.flatnonzero(lone))
    # the pieces lie in the order of their encoding; put them back
    flat_ids = np.concatenate(ids) if ids else np.zeros(0, np.int64)
    flat_ends = np.concatenate(ends) if ends else np.zeros(0, np.int64)
    start = np.zeros(len(size), np.int64)
    done = np.concatenate(order).astype(np.int64) if order else np.zeros(0, np.int64)
    start[done] = np.cumsum(count[done]) - count[done]
    take = runs(start, count)
    return flat_ids[take], flat_ends[take], np.concatenate([[0], np.cumsum(count)]), spelled


def gallop(ends: np.ndarray, first: np.ndarray, last: np.ndarray, guess: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """For every lane the first index in ``first:last`` of the rising ``ends``
    whose value is at least ``wanted``; the last value of a lane's range must be.
    Doubling steps from ``guess`` bracket it, halving finds it."""
    below = ends[guess] < wanted
    # the answer lies in low < answer <= high
    low, high = np.where(below, guess, first - 1), np.where(below, last - 1, guess)
    step = 1
    open_ = np.arange(len(wanted))
    while len(open_):
        up = below[open_]
        probe = np.where(up, low[open_] + step, high[open_] - step)
        inside = np.where(up, probe < high[open_], probe > low[open_])
        open_, up, probe = open_[inside], up[inside], probe[inside]
        less = ends[probe] < wanted[open_]
        low[open_[less]], high[open_[~less]] = probe[less], probe[~less]
        open_ = open_[less == up]
        step *= 2
    open_ = np.flatnonzero(high - low > 1)
    while len(open_):
        mid = (low[open_] + high[open_]) // 2
        less = ends[mid] < wanted[open_]
        low[open_[less]], high[open_[~less]] = mid[less], mid[~less]
        open_ = open_[high[open_] - low[open_] > 1]
    return high


def intersect(a_ends: np.ndarray, a_at: np.ndarray, b_ends: np.ndarray, b_at: np.ndarray) -> dict[str, np.ndarray]:
    """Groups and links of many pairs of end lists (spans ``a_at``, ``b_at``;
    both lists of a pair end alike, empty lists come in pairs).

    Gives ``a``, ``b``: indices of the linked tokens, ``link_at`` by pair of
    lists; ``a_cut``, ``b_cut``: index after each group's last token, ``group_at``."""
    n_a, n_b = np.diff(a_at), np.diff(b_at)
    by_a = n_a <= n_b
    both = np.concatenate([a_ends, b_ends])
    a_from, b_from = a_at[:-1], len(a_ends) + b_at[:-1]
    n_short, n_long = np.minimum(n_a, n_b), np.maximum(n_a, n_b)
    short_at, long_from = runs(np.where(by_a, a_from, b_from), n_short), np.where(by_a, b_from, a_from)
    lane = np.repeat(np.arange(len(n_a)), n_short)
    place = np.arange(len(lane)) - np.repeat(np.cumsum(n_short) - n_short, n_short)
    wanted, first, last = both[short_at], long_from[lane], (long_from + n_long)[lane]
    guess = first + place * n_long[lane] // np.maximum(n_short[lane], 1)
    rank = gallop(both, first, last, guess, wanted)
    common = both[rank] == wanted
    # the tokens of the longer list from the one after the previous end to the one that reaches this end
    begin = np.where(place == 0, first, np.concatenate([[0], (rank + common)[:-1]]) if len(rank) else rank)
    width = rank - begin + 1
    short_link, long_link = np.repeat(short_at, width), runs(begin, width)
    swapped = np.repeat(~by_a[lane], width)
    a = np.where(swapped, long_link, short_link)
    b = np.where(swapped, short_link, long_link) - len(a_ends)
    shared = np.flatnonzero(common)
    turned = ~by_a[lane[shared]]
    a_cut = np.where(turned, rank[shared], short_at[shared]) + 1
    b_cut = np.where(turned, short_at[shared], rank[shared]) + 1 - len(a_ends)
    return {"a": a, "b": b, "link_at": _by(lane, width, len(n_a)), "a_cut": a_cut, "b_cut": b_cut, "group_at": _by(lane, common.astype(np.int64), len(n_a))}


def _by(lane: np.ndarray, amount: np.ndarray, lanes: int) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.bincount(lane, amount, lanes).astype(np.int64))])


def _total(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of the spans ``at`` of ``values``."""
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[at[1:]] - sums[at[:-1]]


def _decimals(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers below n, each followed by a comma, and where each starts."""
    written = [b"%d," % i for i in range(n)]
    return np.frombuffer(b"".join(written), np.uint8), np.cumsum([0, *map(len, written)])


def _group_texts(found: dict[str, np.ndarray], a_ids: np.ndarray, b_ids: np.ndarray, at: np.ndarray, decimals: tuple) -> np.ndarray:
    """The groups of each piece as ``a1,a2|b1;a3|b2,b3;``; ``at`` counts the tokens of both sides before each piece."""
    a_cut, b_cut = found["a_cut"], found["b_cut"]
    # a group's tokens of A, then its tokens of B
    n_a, n_b = np.diff(a_cut, prepend=0), np.diff(b_cut, prepend=0)
    line = np.zeros(len(a_ids) + len(b_ids), np.int64)
    line[np.arange(len(a_ids)) + np.repeat(b_cut - n_b, n_a)] = a_ids
    line[np.arange(len(b_ids)) + np.repeat(a_cut, n_b)] = b_ids
    digits, start = decimals
    size, cut, group_at, texts = start[1:] - start[:-1], a_cut + b_cut, found["group_at"], []
    for x, y in blocks(at, TEXT_TOKENS):
        here, cuts = line[at[x]:at[y]], slice(group_at[x], group_at[y])
        width = size[here]
        out = digits[runs(start[here], width)]
        end = np.concatenate([[0], np.cumsum(width)])
        out[end[(cut - n_b)[cuts] - at[x]] - 1] = ord("|")
        out[end[cut[cuts] - at[x]] - 1] = ord(";")
        text, bounds = out.tobytes().decode(), end[at[x:y + 1] - at[x]].tolist()
        texts += [text[p:q] for p, q in zip(bounds[:-1], bounds[1:])]
    return np.array([*texts, ""], object)


def _distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values, rising."""
    values = np.sort(values)
    return values[np.diff(values, prepend=-1) != 0]


def align_slice(texts: pa.Array, a: _Side, b: _Side, decimals: tuple, digest: bool) -> dict[str, object]:
    """What the texts of a slice are made of: per text ``n_a``, ``n_b``,
    ``n_groups``, ``n_links``, ``groups``; its pieces (``words`` in spans
    ``word_at``), the pairs of each piece (``links`` in spans ``link_at``:
    indices into ``keys``), and ``held``, the texts of the slice that hold each key."""
    data, off = C.text_buffers(texts)
    size = np.diff(off)
    full = size > 0
    # a space in front of every text
    data = np.insert(data, off[:-1][full], 0x20)
    off = off + np.concatenate([[0], np.cumsum(full)])
    mark = np.zeros(len(data) + 1, bool)
    mark[off] = True
    ended = mark.copy()
    cuts = cut_points(data) if len(data) else np.zeros(0, np.int64)
    # a space alone at the end of a text stays with the word before it
    mark[cuts[(data[cuts] == 0x20) & ~ended[cuts + 1]]] = True
    bounds = np.flatnonzero(mark)
    coded = pc.dictionary_encode(C.string_array(data, bounds).cast(pa.large_binary()))
    word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    # frequent pieces first: small numbers take little room
    order = np.argsort(-np.bincount(word, minlength=len(coded.dictionary)), kind="stable")
    pieces, place = coded.dictionary.take(pa.array(order)), np.empty_like(order)
    place[order] = np.arange(len(order))
    word = place[word]
    a_ids, a_ends, a_at, a_spelled = encode_pieces(a, pieces)
    b_ids, b_ends, b_at, b_spelled = encode_pieces(b, pieces)
    good = a_spelled & b_spelled
    if not good.all():  # no tokens on either side
        a_ids, a_ends, a_at = _only(good, a_ids, a_ends, a_at)
        b_ids, b_ends, b_at = _only(good, b_ids, b_ends, b_at)
    found = intersect(a_ends, a_at, b_ends, b_at)
    word_at = np.searchsorted(bounds, off)
    told = full & (_total(~good[word], word_at) == 0)
    n = np.diff(word_at) * told
    words, word_at = word[runs(word_at[:-1], n)], np.concatenate([[0], np.cumsum(n)])
    each = {"n_a": np.diff(a_at), "n_b": np.diff(b_at), "n_groups": np.diff(found["group_at"]), "n_links": np.diff(found["link_at"])}
    out: dict[str, object] = {k: _total(v[words], word_at) for k, v in each.items()}
    spelt = _group_texts(found, a_ids, b_ids, a_at + b_at, decimals)
    groups = ["".join(spelt[words[x:y]])[:-1] for x, y in zip(word_at[:-1].tolist(), word_at[1:].tolist())]
    if digest:
        groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
    keys, links = np.unique(a_ids[found["a"]] * b.size + b_ids[found["b"]], return_inverse=True)
    held = np.zeros(len(keys), np.int64)
    for x, y in blocks(np.concatenate([[0], np.cumsum(out["n_links"])]), PAIR_LINKS):
        used = _distinct(np.repeat(np.arange(y - x), n[x:y]) * (len(pieces) + 1) + words[word_at[x]:word_at[y]])
        row, piece = used // (len(pieces) + 1), used % (len(pieces) + 1)
        width = each["n_links"][piece]
        pairs = _distinct(np.repeat(row, width) * (len(keys) + 1) + links[runs(found["link_at"][piece], width)])
        held += np.bincount(pairs % (len(keys) + 1), minlength=len(keys))
    return out | {"groups": groups, "words": words, "word_at": word_at, "links": links, "link_at": found["link_at"], "keys": keys, "held": held}


def _only(good: np.ndarray, ids: np.ndarray, ends: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = np.where(good, np.diff(at), 0)
    take = runs(at[:-1], n)
    return ids[take], ends[take], np.concatenate([[0], np.cumsum(n)])


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
_PACKED = ("words", "links", "link_at")


def _planes(values: np.ndarray) -> bytes:
    """Small numbers as four planes of bytes, of which the high ones compress to almost nothing."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _values(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def pack(ids: pa.Array, made: dict[str, object], limit: int) -> list[bytes]:
    """What ``align_slice`` made of the documents ``ids``, without its counts
    of keys, as compressed bytes in parts of at most ``limit``."""
    lists = {"ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), "groups": pa.array([made["groups"]], pa.list_(pa.string()))}
    lists |= {k: pa.array([made[k]], pa.list_(pa.int64())) for k in (*_COUNTS, "word_at")}
    lists |= {k: pa.array([_planes(made[k])], pa.large_binary()) for k in _PACKED}
    batch = pa.RecordBatch.from_arrays([*lists.values()], names=[*lists])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd", use_threads=False)) as writer:
        writer.write_batch(batch)
    content = memoryview(sink.getvalue())
    return [bytes(content[i:i + limit]) for i in range(0, len(content), limit)]


def unpack(parts: list[bytes]) -> dict[str, object]:
    """What ``pack`` was given: ``ids``, ``groups`` as Arrow arrays, the others as numbers."""
    batch = pa.ipc.open_stream(b"".join(parts)).read_next_batch()
    made = {k: batch.column(k)[0].values for k in ("ids", "groups", *_COUNTS, "word_at")}
    made |= {k: made[k].to_numpy(zero_copy_only=False) for k in (*_COUNTS, "word_at")}
    return made | {k: _values(batch.column(k)[0].as_buffer()) for k in _PACKED}


def align(docs: DataFrame, a_file: str, b_file: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """One row per document: the id, ``n_a``, ``n_b``, ``n_groups``,
    ``n_links``, ``n_best`` (links whose pair counts most of its A id's),
    ``count_sum`` (the pairs' counts over its links) and ``groups`` as
    ``a1,a2|b1;a3|b2,b3``, or with ``digest`` their SHA-256 in place of the text."""
    spark = docs.sparkSession
    C.prepared(spark)
    content = []
    for path in (a_file, b_file):
        with open(path, "rb") as f:
            content.append((os.path.basename(path), f.read()))
    shared = spark.sparkContext.broadcast(content)
    one = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = one.schema["id"].dataType

    def tools() -> tuple:
        a, b = (_Side(*c) for c in shared.value)
        return a, b, _decimals(max(a.size, b.size))

    def cut(batches: Iterator[pa.RecordBatch], key=uuid.uuid4().hex) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in C.byte_slices(batch, "text", SLICE_BYTES):
                a, b, decimals = C.held(key, tools)
                made = align_slice(part.column(1), a, b, decimals, digest)
                parts = pack(part.column(0), made, PART_BYTES)
                # the keys are in the first part's row
                at = pa.array(np.minimum(np.arange(len(parts) + 1), 1) * len(made["keys"]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([task << 32 | n] * len(parts)), pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary()),
                     pa.ListArray.from_arrays(at, pa.array(made["keys"], pa.int64())), pa.ListArray.from_arrays(at, pa.array(made["held"], pa.int64()))],
                    names=["slice", "part", "data", "keys", "held"])
                n += 1

    slices = stored(one.mapInArrow(cut, "slice long, part int, data binary, keys array<long>, held array<long>"), "align-slices",
                    **{"parquet.block.row.count.limit": GROUP_ROWS})

    width = _Side(*content[1]).size
    pairs = slices.select(F.explode(F.arrays_zip("keys", "held")).alias("p")).groupBy(F.col("p.keys").alias("key")).agg(F.sum("p.held").alias("count"))
    # at most one row per B id in a group
    most = F.max("count").over(Window.partitionBy(F.expr(f"key div {width}")))
    pairs = stored(pairs.withColumn("best", F.col("count") == most), "align-pairs")
    asked = slices.select("slice", F.posexplode("keys").alias("pos", "key")).join(pairs, "key").select(F.col("slice").alias("of"), "pos", "count", "best")

    def total(parts: pa.Table, told: pa.Table) -> pa.Table:
        C.let_go()
        x = unpack(parts.sort_by("part").column("data").to_pylist())
        pos = told.column("pos").to_numpy()
        count, best = np.zeros(len(pos), np.int64), np.zeros(len(pos), np.int64)
        count[pos], best[pos] = told.column("count").to_numpy(), told.column("best").to_numpy()
        sums = [_total(_total(v[x["links"]], x["link_at"])[x["words"]], x["word_at"]) for v in (best, count)]
        return pa.table([x["ids"].cast(to_arrow_type(kind)), *[pa.array(x[k]) for k in _COUNTS], *map(pa.array, sums), x["groups"]], names=["id", *_COUNTS, "n_best", "count_sum", "groups"])

    longs = [T.StructField(k, T.LongType()) for k in (*_COUNTS, "n_best", "count_sum")]
    schema = T.StructType([T.StructField("id", kind), *longs, T.StructField("groups", T.StringType())])
    rows = slices.select("slice", "part", "data").groupBy("slice").cogroup(asked.groupBy("of"))
    return rows.applyInArrow(total, schema).withColumnRenamed("id", id_col)
