"""Benchmark decontamination by pigeonhole edit matching (operator 6).

Texts become sequences of normalised words: runs of ASCII letters, digits and
bytes above 0x7F, with A-Z and the Latin-1 capitals in lower case; punctuation
and white space only separate.  A test item of ``n`` words may differ from a
passage by ``e = floor(budget * n)`` word edits (insertions, deletions,
replacements).  Cut into ``e + 1`` pieces, at least one piece must occur
unchanged, so documents are searched for exact piece hits by window hashes, and
each hit is verified by Myers' bit-parallel distance over the words around it.

Neither side is held whole anywhere.  The hashes of all pieces are a table and
set bits in one Bloom filter of ``filter_bits``, the only thing broadcast.  One
scan of the documents hashes all windows of the pieces' lengths; texts with a
window that the filter knows leave as word hashes, equal texts once.  Their
windows meet the pieces in a join on the hash, and each (text, item, place)
that hits gets the item's words from another join and is verified beside its
text's words, thousands of pairs at a time.  A full filter sends more windows
and changes no result; a piece that many items or texts share is more rows of
these joins, whose skewed partitions AQE splits.

Defined cases: null or empty texts and items without words match nothing.
Repeated items are reported each under their own id, of any type that sorts;
repeated rows get the same; of several passages of one item in a text the least
distance counts.  An empty table of documents or items gives no leaks.  A very
long text is one slice.  An input column ``leaks`` is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.llm import common as C
from silverline.session import stored

BUDGET = 0.2
FILTER_BITS = 1 << 26
#: Pairs verified together.
LANES = 4096
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the normalised words of a slice."""
    low = C.LOWER[data]
    if len(low) > 1:  # U+00C0 to U+00DE but the multiplication sign
        capital = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        low[1:][capital] += 0x20
    # what separates becomes a space, so that the word helper applies
    low[~_WORD[data]] = 0x20
    start, end = C.word_spans(low, offsets)
    return np.searchsorted(offsets, start, side="right") - 1, C.span_hash(low, start, end)


def pieces(n: int, budget: float) -> list[tuple[int, int]]:
    """(first word, length) of the error budget plus one pieces of an item of n words."""
    parts = int(budget * n) + 1
    cuts = [n * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def best_matches(patterns: list[np.ndarray], texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For each pair (least edits between the pattern and any run of the text,
    first end of such a run), by Myers' bit vectors with one bit a pattern
    word; all pairs take a text word at a time."""
    m, n = np.array([len(p) for p in patterns]), np.array([len(t) for t in texts])
    words = int(m.max(initial=1) + 63) // 64
    held, inside = np.zeros((len(m), 64 * words), np.uint64), np.arange(64 * words) < m[:, None]
    held[inside] = np.concatenate(patterns)
    text, live = np.zeros((len(n), int(n.max(initial=0))), np.uint64), np.arange(int(n.max(initial=0))) < n[:, None]
    text[live] = np.concatenate(texts)

    def bits(flags: np.ndarray) -> np.ndarray:
        return np.packbits(flags, axis=1, bitorder="little").view("<u8")

    def doubled(x: np.ndarray) -> np.ndarray:
        out = x << np.uint64(1)
        out[:, 1:] |= x[:, :-1] >> np.uint64(63)
        return out & full

    def last(x: np.ndarray) -> np.ndarray:
        return (x[lane, (m - 1) // 64] >> ((m - 1) % 64).astype(np.uint64) & np.uint64(1)).astype(np.int64)

    full, lane = bits(inside), np.arange(len(m))
    up, down = full.copy(), np.zeros_like(full)  # vertical differences +1 and -1 down the column
    score, best, at = m.copy(), m.copy(), np.zeros(len(m), np.int64)
    for j in range(text.shape[1]):
        here = bits((held == text[:, j][:, None]) & inside)
        masked, total = here & up, np.empty_like(up)
        carry = np.zeros(len(m), np.uint64)
        for k in range(words):
            part = masked[:, k] + up[:, k]
            total[:, k] = part + carry
            carry = ((part < up[:, k]) | (total[:, k] < part)).astype(np.uint64)
        zero = (total ^ up) | here | down
        plus, minus = (down | ~(zero | up)) & full, up & zero
        score = score + last(plus) - last(minus)
        plus, minus = doubled(plus), doubled(minus)  # a run may start anywhere
        up, down = (minus | ~(zero | plus)) & full, plus & zero
        better = live[:, j] & (score < best)
        best[better], at[better] = score[better], j + 1
    return best, at


def best_match(pattern: list[int], text: list[int]) -> tuple[int, int]:
    """``best_matches`` of one pair."""
    best, at = best_matches([np.array(pattern, np.uint64)], [np.array(text, np.uint64)])
    return int(best[0]), int(at[0])


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item, words): the word hashes of every item that has words."""
    for batch in batches:
        for part in C.byte_slices(batch, "text"):
            row, h = word_hashes(*C.text_buffers(part.column("text")))
            some, first = np.unique(row, return_index=True)
            words = [w.tobytes() for w in np.split(h, first[1:])] if len(h) else []
            yield pa.RecordBatch.from_arrays([part.column("item").take(pa.array(some, pa.int64())), pa.array(words, pa.binary())], names=["item", "words"])


def _item_pieces(budget: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for item, raw in zip(batch.column("item").to_pylist(), batch.column("words").to_pylist()):
                words = np.frombuffer(raw, np.uint64)
                for first, length in pieces(len(words), budget):
                    out.append((C.window_hash(words[first:first + length], length)[0].view(np.int64), length, item, first))
            columns = list(zip(*out)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(np.array(c, np.int64)) for c in columns], names=["hash", "length", "item", "first"])
    return run


def _filter(table: DataFrame, bits: int) -> np.ndarray:
    """The Bloom filter of the pieces as bytes; ``bits`` is a power of two.
    The driver sees one number for each 64 bits that are not all unset."""
    at = F.col("hash").bitwiseAND(bits - 1)
    one = F.expr(f"shiftleft(1L, cast((hash & {bits - 1}) & 63 as int))")
    words = table.select(F.shiftright(at, 6).alias("at"), one.alias("bit")).groupBy("at").agg(F.bit_or("bit").alias("bits")).toPandas()
    out = np.zeros(max(bits // 64, 1), np.int64)
    out[words["at"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return out.view(np.uint8)


_SUSPECT = "k1 long, k2 long, words binary, places array<int>, hashes array<long>, lengths array<int>"


def _suspects(shared, lengths: list[int], bits: int):
    """The texts with a window that the filter knows, as word hashes, and these windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for part in C.byte_slices(batch, "text"):
                row, h = word_hashes(*C.text_buffers(part.column("text")))
                windows, width, found = np.zeros(len(h), np.uint64), 0, []
                for length in lengths:
                    while width < length and width < len(h):  # windows of each length come from those one shorter
                        windows = C.mix(windows[:len(h) - width] * np.uint64(0x2545F4914F6CDD1D) + h[width:])
                        width += 1
                    if width < length:
                        break
                    bit = windows & np.uint64(bits - 1)
                    at = np.flatnonzero(known[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8) & 1)
                    at = at[row[at] == row[at + length - 1]]
                    found.append((row[at], at, windows[at].view(np.int64), np.full(len(at), length)))
                if not found or not sum(len(f[0]) for f in found):
                    continue
                rows, at, hashes, width_of = map(np.concatenate, zip(*found))
                order = np.argsort(rows, kind="stable")
                rows, at, hashes, width_of = rows[order], at[order], hashes[order], width_of[order]
                some, first = np.unique(rows, return_index=True)
                start, end = np.searchsorted(row, some), np.searchsorted(row, some, side="right")
                off = pa.array(np.append(first, len(rows)).astype(np.int32))
                keys = [part.column(k).take(pa.array(some)) for k in ("k1", "k2")]
                lists = [(at - np.repeat(start, np.diff(np.append(first, len(rows))))).astype(np.int32), hashes, width_of.astype(np.int32)]
                yield pa.RecordBatch.from_arrays(
                    [*keys, pa.array([h[a:b].tobytes() for a, b in zip(start, end)], pa.binary()), *[pa.ListArray.from_arrays(off, pa.array(x)) for x in lists]],
                    names=["k1", "k2", "words", "places", "hashes", "lengths"])
    return run


def _verified(budget: float):
    """Texts (without an item) each followed by its hits: the hits within budget and their distances."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(0, np.uint64)
        for batch in batches:
            lanes = []
            for k1, k2, item, start, raw in zip(*[batch.column(k).to_pylist() for k in ("k1", "k2", "item", "start", "words")]):
                held = np.frombuffer(raw, np.uint64)
                if item is None:
                    words = held
                    continue
                spare = int(budget * len(held))
                lanes.append((k1, k2, item, spare, held, words[max(0, start - spare):max(0, start + len(held) + spare)]))
            lanes.sort(key=lambda x: len(x[4]))  # patterns of like length share their bit vectors' width
            for a in range(0, len(lanes), LANES):
                k1, k2, item, spare, patterns, texts = zip(*lanes[a:a + LANES])
                best, _ = best_matches(list(patterns), list(texts))
                keep = best <= np.array(spare)
                yield pa.RecordBatch.from_arrays([pa.array(np.array(x, np.int64)[keep]) for x in (k1, k2, item, best)], names=["k1", "k2", "item", "distance"])
    return run


def find_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
               budget: float = BUDGET, filter_bits: int = FILTER_BITS) -> DataFrame:
    """``docs`` with ``leaks``: an array of (item, distance) of the items that
    each text holds within their error budget, by item and distance."""
    spark = docs.sparkSession
    C.prepared(spark)
    docs = C.without(docs, ["leaks"])
    names = docs.columns
    ids = stored(items.select(F.col(f"`{item_id}`").alias("id"), F.col(f"`{item_text}`").alias("text")).filter(F.octet_length("text") > 0)
                 .withColumn("item", F.monotonically_increasing_id()), "leak-items")
    own = stored(ids.select("item", "text").mapInArrow(_item_words, "item long, words binary"), "leak-words")
    table = stored(own.mapInArrow(_item_pieces(budget), "hash long, length long, item long, first long").withColumn("length", F.col("length").cast("int")), "leak-pieces")
    lengths = sorted(r.length for r in table.select("length").distinct().collect())  # at most one a word of the longest piece
    shared = spark.sparkContext.broadcast(_filter(table, filter_bits))

    # texts by 128 bits: a leak is a property of the text
    text = F.col(f"`{text_col}`")
    keys = [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(6), text, F.lit("leak")).alias("k2")]
    suspects = (docs.select(text.alias("text"), *keys).mapInArrow(_suspects(shared, lengths, filter_bits), _SUSPECT)
                .dropDuplicates(["k1", "k2"]))
    suspects = stored(suspects, "leak-suspects")
    window = F.explode(F.arrays_zip("places", "hashes", "lengths")).alias("w")
    hits = (suspects.select("k1", "k2", window).select("k1", "k2", F.col("w.places").alias("place"), F.col("w.hashes").alias("hash"), F.col("w.lengths").alias("length"))
            .join(table, ["hash", "length"]).select("k1", "k2", "item", (F.col("place") - F.col("first")).alias("start")).distinct().join(own, "item"))
    beside = suspects.select("k1", "k2", F.lit(None).cast("long").alias("item"), F.lit(None).cast("long").alias("start"), "words").unionByName(
        hits.select("k1", "k2", "item", "start", "words"))
    checked = (beside.repartition("k1", "k2").sortWithinPartitions("k1", "k2", F.col("item").asc_nulls_first(), "start")
               .mapInArrow(_verified(budget), "k1 long, k2 long, item long, distance long"))
    least = checked.groupBy("k1", "k2", "item").agg(F.min("distance").alias("distance")).join(ids.select("item", "id"), "item")
    leaks = stored(least.groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct(F.col("id").alias("item"), "distance"))).alias("leaks")), "leaks")
    # columns by position, as their names are the caller's
    k1, k2, found = (C.rename_free(names, n) for n in ("k1", "k2", "leaks"))
    marked = docs.withColumns({k1: keys[0], k2: keys[1]}).join(leaks.toDF(k1, k2, found), [k1, k2], "left")
    empty = F.array().cast(leaks.schema["leaks"].dataType)
    return marked.select(*[F.col(f"`{c}`") for c in names], F.coalesce(F.col(found), empty).alias("leaks"))


def decontaminate(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that leak an item."""
    return find_leaks(docs, items, **options).filter(F.size("leaks") == 0).drop("leaks")
