"""SentencePiece encoding with seeded merge-dropout, and decoding (operator 8).

Encoding follows the library's merge agenda: neighbouring symbols whose
concatenation is a piece are candidates, the best-scored candidate (the
leftmost of equals) is taken from the agenda each time and merged.  With
merge-dropout a candidate taken from the agenda is skipped instead if a keyed
hash of (seed, document, unit, its place in the text, its three borders) falls below ``dropout``; it
comes back only if one of its symbols changes.  The segmentation varies and is
the same on every run, in every partitioning.  With ``dropout=0`` the result
is the library's own.

Texts are cut into units no merge can cross: before a run of spaces, and around
characters that no piece holds (checked against the vocabulary).  Every
occurrence of a unit has a hash key of its own, by seed, document key and
position.  The distinct units of a slice are segmented once without dropout; an
occurrence that skips none of these merges has this result, the others are
segmented each by itself.  Units of like length are rows of a matrix and every
round takes the best candidate of each row.  Long units go through a heap.
``variants``, if given, bounds the segmentations of a unit to so many.

Decoding is lossless: a space is written as the piece character U+2581 and
back, a literal U+2581 and every character outside the vocabulary become their
UTF-8 bytes' pieces, and the space that the model puts in front of a text is
taken off again.

Defined cases: a null or empty text has no pieces and decodes to the empty
text; a null list of pieces decodes to null.  Repeated rows with one key are
segmented alike.  Input columns named as the results are replaced.
"""

from __future__ import annotations

import heapq
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverline.llm import common as C

#: A slice needs some 60 times its size; larger ones are no faster.
SLICE_BYTES = 2 << 20
#: Longer units are segmented one by one.
MATRIX_CHARS = 64
MATRIX_ROWS = 1 << 14
_NONE = np.int32(2**31 - 1)
_SPACE, _MARK = 0x20, "▁"


class Vocabulary:
    """Pieces, merges and bytes of a byte-fallback BPE model file."""

    def __init__(self, content: bytes):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=content)
        self.size = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(self.size)]
        plain = {p: i for i, p in enumerate(pieces) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))}
        scores = np.array([model.get_score(i) for i in range(self.size)])
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        self.byte_id = np.zeros(256, np.int32)
        out_bytes = []
        for i, p in enumerate(pieces):
            if model.is_byte(i):
                self.byte_id[int(p[3:5], 16)] = i
                out_bytes.append(bytes([int(p[3:5], 16)]))
            elif p in plain:
                out_bytes.append(p.replace(_MARK, " ").encode())
            else:
                out_bytes.append(" ⁇ ".encode() if model.is_unknown(i) else b"")
        self.out = np.frombuffer(b"".join(out_bytes), np.uint8)
        self.out_at = np.cumsum([0, *map(len, out_bytes)])
        #: the piece of each single character, -1 without one
        self.char_id = np.full(0x110000, -1, np.int32)
        for p, i in plain.items():
            if len(p) == 1:
                self.char_id[ord(p)] = i
        self.char_id[_SPACE] = self.char_id[ord(_MARK)]
        self.char_id[ord(_MARK)] = -1
        if self.char_id[_SPACE] < 0 or any(_MARK in p.lstrip(_MARK) for p in plain):
            raise ValueError("a piece goes on across a space: units can't be cut there")
        merges = {}
        for p, i in plain.items():
            for k in range(1, len(p)):
                left, right = plain.get(p[:k]), plain.get(p[k:])
                if left is not None and right is not None:
                    merges[left * self.size + right] = i
        self._hash(np.array(list(merges), np.int64), np.array(list(merges.values()), np.int32))

    def _hash(self, keys: np.ndarray, ids: np.ndarray) -> None:
        """An open-addressed table of the merges."""
        self.bits = max(4, int(4 * len(keys)).bit_length())
        self.slots = np.full(1 << self.bits, -1, np.int64)
        self.slot_id = np.zeros(1 << self.bits, np.int32)
        at, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = left[self.slots[at[left]] < 0]
            _, first = np.unique(at[free], return_index=True)
            placed = free[first]
            self.slots[at[placed]], self.slot_id[at[placed]] = keys[placed], ids[placed]
            left = left[self.slots[at[left]] != keys[left]]
            at[left] = (at[left] + 1) & (len(self.slots) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def merged(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, piece) of the concatenation of two pieces; rank _NONE without one."""
        keys = left.astype(np.int64) * self.size + right
        at = self._slot(keys)
        seen = self.slots[at]
        rank = np.full(len(keys), _NONE, np.int32)
        piece = np.zeros(len(keys), np.int32)
        open_ = np.flatnonzero(seen >= 0)
        while len(open_):
            hit = self.slots[at[open_]] == keys[open_]
            found = open_[hit]
            piece[found] = self.slot_id[at[found]]
            rank[found] = self.rank[piece[found]]
            open_ = open_[~hit]
            at[open_] = (at[open_] + 1) & (len(self.slots) - 1)
            open_ = open_[self.slots[at[open_]] >= 0]
        return rank, piece


def _skips(key: np.ndarray, start: np.ndarray, mid: np.ndarray, end: np.ndarray, dropout: float) -> np.ndarray:
    """Whether the keyed hash drops the candidate with these borders."""
    borders = (start.astype(np.uint64) << np.uint64(42)) ^ (mid.astype(np.uint64) << np.uint64(21)) ^ end.astype(np.uint64)
    return (C.mix(key ^ (borders * np.uint64(0x9E3779B97F4A7C15))) >> np.uint64(11)) < np.uint64(int(dropout * (1 << 53)))


def _segment_rows(chars: np.ndarray, length: np.ndarray, key: np.ndarray, vocab: Vocabulary, dropout: float,
                  taken: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Segment units in the rows of a matrix of character pieces; (pieces row
    after row, pieces per row).  ``taken`` gets the merges: (row, borders)."""
    n, wide = chars.shape
    step = wide + 1
    sym = np.zeros(n * step, np.int32)
    sym.reshape(n, step)[:, :wide] = chars
    nxt = np.tile(np.arange(1, step + 1, dtype=np.int32), n)
    prv = np.tile(np.arange(-1, step - 1, dtype=np.int32), n)
    rank, piece = np.full((n, wide), _NONE, np.int32), np.zeros((n, wide), np.int32)
    row, col = np.nonzero(np.arange(wide)[None, :] < (length - 1)[:, None])
    rank[row, col], piece[row, col] = vocab.merged(chars[row, col], chars[row, col + 1])
    alive = np.ones((n, wide), bool)
    alive &= np.arange(wide)[None, :] < length[:, None]
    flat_rank, flat_piece, flat_alive = rank.ravel(), piece.ravel(), alive.ravel()
    rows = np.arange(n)
    while len(rows):
        part = rank[rows]
        j = part.argmin(1)
        rows_j = part[np.arange(len(rows)), j] != _NONE
        rows, j = rows[rows_j], j[rows_j]
        if not len(rows):
            break
        base = rows * step
        mid = nxt[base + j]
        end = nxt[base + mid]
        if dropout:
            drop = _skips(key[rows], j, mid, end, dropout)
            flat_rank[rows[drop] * wide + j[drop]] = _NONE
            keep = ~drop
            r, j, mid, end, base = rows[keep], j[keep], mid[keep], end[keep], base[keep]
        else:
            r = rows
        if taken is not None:
            taken.append((r, j, mid, end))
        own = r * wide
        sym[base + j] = flat_piece[own + j]
        nxt[base + j] = end
        prv[base + np.minimum(end, wide)] = j
        flat_rank[own + mid] = _NONE
        flat_alive[own + mid] = False
        # the merged symbol's candidates with its neighbours
        right = np.flatnonzero(end < length[r])
        a, p = vocab.merged(sym[base[right] + j[right]], sym[base[right] + end[right]])
        flat_rank[own + j] = _NONE
        flat_rank[own[right] + j[right]], flat_piece[own[right] + j[right]] = a, p
        before = prv[base + j]
        left = np.flatnonzero(before >= 0)
        a, p = vocab.merged(sym[base[left] + before[left]], sym[base[left] + j[left]])
        flat_rank[own[left] + before[left]], flat_piece[own[left] + before[left]] = a, p
    return sym.reshape(n, step)[:, :wide][alive], alive.sum(1)


def _segment_long(chars: np.ndarray, key: np.uint64, vocab: Vocabulary, dropout: float, taken: list | None = None) -> np.ndarray:
    """Segment one long unit with a heap as the agenda."""
    n = len(chars)
    sym = chars.astype(np.int64).tolist()
    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
    rank, piece = vocab.merged(chars[:-1], chars[1:])
    agenda = [(int(r), j, j + 1, j + 2, int(p)) for j, (r, p) in enumerate(zip(rank, piece)) if r != _NONE]
    heapq.heapify(agenda)
    alive = [True] * n
    keys = np.array([key])

    def push(a: int, b: int) -> None:
        r, p = vocab.merged(np.array([sym[a]]), np.array([sym[b]]))
        if r[0] != _NONE:
            heapq.heappush(agenda, (int(r[0]), a, b, nxt[b], int(p[0])))

    while agenda:
        _, j, mid, end, p = heapq.heappop(agenda)
        if not alive[j] or nxt[j] != mid or mid >= n or nxt[mid] != end:
            continue
        if dropout and _skips(keys, np.array([j]), np.array([mid]), np.array([end]), dropout)[0]:
            continue
        if taken is not None:
            taken.append((j, mid, end))
        sym[j], nxt[j], alive[mid] = p, end, False
        if end < n:
            prv[end] = j
            push(j, end)
        if prv[j] >= 0:
            push(prv[j], j)
    return np.array([s for s, a in zip(sym, alive) if a], np.int32)


def _segment(chars: np.ndarray, at: np.ndarray, key: np.ndarray, vocab: Vocabulary, dropout: float,
             taken: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Segment many units (spans ``at`` of character pieces): (pieces of the
    units one after another, offsets).  ``taken`` gets the merges: (unit, borders)."""
    length = np.diff(at)
    order = np.argsort(length, kind="stable")
    ranked = length[order]
    pieces, count = [], np.zeros(len(length), np.int64)
    lo = 0
    limit = 4
    while lo < len(order):
        if ranked[lo] > MATRIX_CHARS:
            for u in order[lo:]:
                merges = None if taken is None else []
                pieces.append(_segment_long(chars[at[u]:at[u + 1]], key[u], vocab, dropout, merges))
                count[u] = len(pieces[-1])
                if merges:
                    borders = np.array(merges, np.int64)
                    taken.append((np.full(len(borders), u), *borders.T))
            break
        while limit < ranked[lo]:
            limit *= 2
        hi = min(int(np.searchsorted(ranked, limit, side="right")), lo + MATRIX_ROWS)
        some = order[lo:hi]
        wide = int(ranked[hi - 1])
        cols = np.minimum(at[some][:, None] + np.arange(wide), len(chars) - 1)
        merges = None if taken is None else []
        found, n = _segment_rows(chars[cols], length[some], key[some], vocab, dropout, merges)
        if merges:
            taken += [(some[r], *borders) for r, *borders in merges]
        pieces.append(found)
        count[some] = n
        lo = hi
    # pieces lie in the order of length; put the units back into theirs
    flat = np.concatenate(pieces) if pieces else np.zeros(0, np.int32)
    start = np.zeros(len(length), np.int64)
    start[order] = np.cumsum(count[order]) - count[order]
    return flat[_runs(start, count)], np.concatenate([[0], np.cumsum(count)])


def _runs(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of every run, one run after another."""
    before = np.cumsum(length) - length
    return np.repeat(start - before, length) + np.arange(int(length.sum()))


def _dropped(word: np.ndarray, key: np.ndarray, words: int, taken: list, dropout: float) -> np.ndarray:
    """Which occurrences (of unit ``word``, with a hash key) skip a merge of their undropped unit."""
    unit = np.concatenate([u for u, *_ in taken]) if taken else np.zeros(0, np.int64)
    order = np.argsort(unit, kind="stable")
    start, mid, end = (np.concatenate([b[k] for _, *b in taken])[order].astype(np.int32) if taken else np.zeros(0, np.int32) for k in range(3))
    n = np.bincount(unit, minlength=words)
    first = np.cumsum(n) - n
    out = np.zeros(len(word), bool)
    for a in range(0, len(word), MATRIX_ROWS):
        some = word[a:a + MATRIX_ROWS]
        of, at = np.repeat(np.arange(len(some)), n[some]), _runs(first[some], n[some])
        out[a + of[_skips(key[a + of], start[at], mid[at], end[at], dropout)]] = True
    return out


def encode_slice(texts: pa.Array, doc_keys: np.ndarray, vocab: Vocabulary, dropout: float, seed: int,
                 variants: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(piece ids of all texts, offsets by text)."""
    data, off = C.text_buffers(texts)
    full = np.diff(off) > 0
    starts = C.code_points(data)[off]
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    # the model puts a space in front of every text
    points = np.insert(points, starts[:-1][full], _SPACE)
    starts = starts + np.concatenate([[0], np.cumsum(full)])
    chars = vocab.char_id[points]
    space, known = points == _SPACE, chars >= 0
    cut = np.ones(len(points) + 1, bool)
    cut[1:-1] = (space[1:] & ~space[:-1]) | ~known[1:] | ~known[:-1]
    cut[starts] = True
    bounds = np.flatnonzero(cut)
    first, size = bounds[:-1], np.diff(bounds)
    if not len(first):
        return np.zeros(0, np.int32), np.zeros(len(off), np.int64)
    row = np.searchsorted(starts, first, side="right") - 1
    # units: distinct texts of known characters
    unit = np.flatnonzero(known[first])
    coded = pc.dictionary_encode(pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer((4 * bounds).astype(np.int32)), pa.py_buffer(points.tobytes())])
                                 .take(pa.array(unit)))
    words = coded.dictionary
    raw, at = C.text_buffers(words)
    word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    letters = vocab.char_id[raw.view(np.uint32)] if len(raw) else np.zeros(0, np.int32)
    content = C.span_hash(raw, at[:-1], at[1:]) + np.uint64(seed * 0x9E3779B97F4A7C15 + 1 & (1 << 64) - 1)

    def segmented(w: np.ndarray, key: np.ndarray, drop: float, taken: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        spans = np.concatenate([[0], np.cumsum((at[w + 1] - at[w]) // 4)])
        return _segment(letters[_runs(at[w] // 4, (at[w + 1] - at[w]) // 4)], spans, key, vocab, drop, taken)

    if dropout:
        ordinal = (unit - np.searchsorted(first, starts[row[unit]])).astype(np.uint64)
        drawn = C.mix(doc_keys[row[unit]] ^ (ordinal * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(seed * 0x2545F4914F6CDD1D & (1 << 64) - 1))
    if dropout and variants:  # equal (unit, variant) pairs once
        pair = word * variants + (drawn % np.uint64(variants)).astype(np.int64)
        mark = np.zeros(len(words) * variants, bool)
        mark[pair] = True
        kinds, used = np.flatnonzero(mark), (np.cumsum(mark) - 1)[pair]
        key = C.mix(content[kinds // variants] + (kinds % variants).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
        pieces, piece_at = segmented(kinds // variants, key, dropout)
    else:
        taken: list | None = [] if dropout else None
        pieces, piece_at = segmented(np.arange(len(words)), content, 0.0, taken)
        used = word
        if dropout:
            key = C.mix(content[word] + drawn)
            own = np.flatnonzero(_dropped(word, key, len(words), taken, dropout))
            more, more_at = segmented(word[own], key[own], dropout)
            used = word.copy()
            used[own] = len(words) + np.arange(len(own))
            pieces, piece_at = np.concatenate([pieces, more]), np.concatenate([piece_at, piece_at[-1] + more_at[1:]])
    # other characters: the pieces of their bytes
    other = np.flatnonzero(~known[first])
    rare, which = np.unique(points[first[other]], return_inverse=True)
    encoded = [np.frombuffer(chr(int(p)).encode("utf-8", "replace"), np.uint8) for p in rare]
    tail = vocab.byte_id[np.concatenate(encoded)] if encoded else np.zeros(0, np.int32)
    tail_at = len(pieces) + np.cumsum([0, *map(len, encoded)])
    source, n = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
    source[unit], n[unit] = piece_at[used], np.diff(piece_at)[used]
    source[other], n[other] = tail_at[which], np.diff(tail_at)[which]
    ids = np.concatenate([pieces, tail])[_runs(source, n)]
    total = np.concatenate([[0], np.cumsum(n)])
    return ids, total[np.searchsorted(first, starts)]


def decode_slice(ids: pa.Array, vocab: Vocabulary) -> pa.Array:
    """The text of each list of pieces."""
    off = np.asarray(ids.offsets).astype(np.int64)
    flat = ids.values.to_numpy(zero_copy_only=False)[off[0]:off[-1]].astype(np.int64)
    off = off - off[0]
    width = np.diff(vocab.out_at)[flat]
    total = np.concatenate([[0], np.cumsum(width)])
    out = vocab.out[_runs(vocab.out_at[flat], width)]
    at = total[off]
    lead = np.flatnonzero((at[1:] > at[:-1]) & (out[np.minimum(at[:-1], max(len(out) - 1, 0))] == _SPACE if len(out) else False))
    keep = np.ones(len(out), bool)
    keep[at[:-1][lead]] = False
    fewer = np.zeros(len(at), np.int64)
    fewer[lead + 1] = 1
    texts = C.string_array(out[keep], at - np.cumsum(fewer))
    return pc.if_else(ids.is_valid(), texts, pa.scalar(None, texts.type)).cast(pa.string())


def _vocabulary(shared, key: str) -> Vocabulary:
    return C.held(key, lambda: Vocabulary(shared.value))


def _shared(df: DataFrame, model_file: str):
    C.prepared(df.sparkSession)
    with open(model_file, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read()), uuid.uuid4().hex


def encode_pieces(docs: DataFrame, model_file: str, text_col: str = "text", key_cols: tuple[str, ...] = ("doc_id",), dropout: float = 0.1,
                  seed: int = 1, variants: int | None = None, verify: bool = False) -> DataFrame:
    """``docs`` with ``ids``, the pieces of each whole text; ``key_cols`` name
    the document whose segmentation varies.  With ``verify`` every list is
    decoded again at once, and ``lossless`` says whether that gave the text."""
    shared, token = _shared(docs, model_file)
    new = ["ids", "lossless"] if verify else ["ids"]
    docs = C.without(docs, new)
    name = C.rename_free([*docs.columns, *new], "piece_key")
    at, n = docs.columns.index(text_col), len(docs.columns)
    # the key rides along as a column that goes away again
    keyed = docs.withColumn(name, F.xxhash64(*[F.col(f"`{c}`") for c in key_cols]) if key_cols else F.lit(0).cast("long"))
    plain = [str(i) for i in range(n + len(new))]

    def run(batches):
        for batch in batches:
            for part in C.byte_slices(batch, str(at), SLICE_BYTES):
                vocabulary, texts = _vocabulary(shared, token), part.column(at)
                keys = part.column(n).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                ids, off = encode_slice(texts, keys, vocabulary, dropout, seed, variants)
                lists = pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(ids.astype(np.int32)))
                same = [pc.equal(decode_slice(lists, vocabulary), pc.fill_null(texts, ""))] if verify else []
                yield pa.RecordBatch.from_arrays([*part.columns[:n], lists, *same], names=plain)

    kinds = [*(f.dataType for f in docs.schema.fields), T.ArrayType(T.IntegerType()), T.BooleanType()]
    schema = T.StructType([T.StructField(p, k) for p, k in zip(plain, kinds)])
    return keyed.toDF(*[str(i) for i in range(n + 1)]).mapInArrow(run, schema).toDF(*docs.columns, *new)


def decode_pieces(encoded: DataFrame, model_file: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` with the text that each list of pieces stands for."""
    shared, token = _shared(encoded, model_file)
    encoded = C.without(encoded, [out_col]) if out_col.lower() != ids_col.lower() else encoded
    at, n = encoded.columns.index(ids_col), len(encoded.columns)
    plain = [str(i) for i in range(n + 1)]

    def run(batches):
        for batch in batches:
            step = max(1, 1000 * batch.num_rows // max(1, batch.nbytes // 1000 // 4))
            for a in range(0, batch.num_rows, step):
                part = batch.slice(a, step)
                yield pa.RecordBatch.from_arrays([*part.columns, decode_slice(part.column(at), _vocabulary(shared, token))], names=plain)

    kinds = [*(f.dataType for f in encoded.schema.fields), T.StringType()]
    return encoded.toDF(*plain[:n]).mapInArrow(run, T.StructType([T.StructField(p, k) for p, k in zip(plain, kinds)])).toDF(*encoded.columns, out_col)
