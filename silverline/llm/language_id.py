"""Language identification by prediction by partial matching (operator 9).

Per language, a byte context tree of order 4 with escapes: a byte is coded in
its longest context that has been seen (four bytes down to none); a byte that
this context lacks pays the context's escape and is coded one order lower; below
order 0 all 256 bytes are equally likely.  With ``n`` bytes counted in a context
and ``q`` different ones, a seen byte has ``c / (n + q)`` and the escape
``q / (n + q)``.  Statistics are frozen after training, so the code length of a
text is a sum over its bytes, and the language of the shortest code wins.
Every byte counts as itself, but for A-Z, which are taken in lower case; what
one language is judged by does not depend on the others.

Scoring needs no tree walk: for each order the code lengths of all grams that
any language has seen are worked out once and found by a hash table; a gram
that none has seen takes the escape of its context plus the length one order
lower.  A worker holds 4 bytes for every language and distinct gram of the
samples: 2 MB of a language hold some 300 thousand, so ten languages take about
100 MB where they share nothing.

Training takes the distinct texts of each language in the order of a hash of
the text, up to ``sample_bytes`` bytes; the text that crosses the bound is cut
there.  A language of fewer than ``min_texts`` distinct texts is not learned,
so that stray labels cost nothing.  Prediction sees all of every text, and
nothing but the text.

Defined cases: ``und`` with score 0 if a text is null or has no letter, or if
nothing was learned.  Ties go to the language that sorts first.  Repeated rows
are judged alike; a very long text is one slice.  An empty table gives an empty
result.  Input columns named as the results are replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverline.llm import common as C

ORDER = 4
SAMPLE_BYTES = 2 << 20
UNKNOWN = "und"
#: What precedes a text.
_BEFORE = 10
#: Above every rank of a text.
_ALL = 1 << 62


def _grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Each byte behind the ``ORDER`` bytes before it, as one number; the
    context of a text's first bytes is filled with newlines."""
    low = C.LOWER[data]
    key = low.astype(np.int64)
    first = offsets[:-1]
    for back in range(1, ORDER + 1):
        own = np.full(len(low), _BEFORE, np.uint8)
        own[back:] = low[:-back]
        for k in range(back):  # the context must not reach into the text before
            own[first[first + k < offsets[1:]] + k] = _BEFORE
        key |= own.astype(np.int64) << (8 * back)
    return key


class _Places:
    """Place of each of the rising ``keys``, by open addressing."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(3 * len(keys)).bit_length())
        self.slots, self.place = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, -1, np.int32)
        at, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = left[self.slots[at[left]] < 0]
            _, one = np.unique(at[free], return_index=True)
            self.slots[at[free[one]]], self.place[at[free[one]]] = keys[free[one]], free[one]
            left = left[self.slots[at[left]] != keys[left]]
            at[left] = (at[left] + 1) & (len(self.slots) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places of ``keys``, -1 where there is none."""
        at = self._slot(keys)
        found = self.place[at]
        open_ = np.flatnonzero((self.slots[at] != keys) & (found >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & (len(self.slots) - 1)
            found[open_] = self.place[at[open_]]
            open_ = open_[(self.slots[at[open_]] != keys[open_]) & (found[open_] >= 0)]
        return found


@dataclass(frozen=True)
class Statistics:
    """What training leaves: languages, and each language's grams (rising) with their counts."""

    languages: list[str]
    counts: list[tuple[np.ndarray, np.ndarray]]


class Model:
    """Frozen context trees of some languages, ready to score."""

    def __init__(self, statistics: Statistics):
        self.languages = statistics.languages
        #: by order: places of the grams, places of the contexts, and by language the lengths and escapes (the last one, 0, for a context never seen)
        self.grams, self.contexts, self.lengths, self.escapes = [], [], [], []
        below, below_keys = None, None
        for order in range(ORDER + 1):
            own = []
            for keys, n in statistics.counts:
                short, at = np.unique(keys & ((1 << 8 * (order + 1)) - 1), return_inverse=True)
                own.append((short, np.bincount(at, weights=n)))
            every = np.unique(np.concatenate([k for k, _ in own])) if own else np.zeros(0, np.int64)
            contexts = np.unique(every >> 8)
            suffix = None if below is None else np.searchsorted(below_keys, every & ((1 << 8 * order) - 1))
            lengths, escapes = [], []
            for i, (keys, n) in enumerate(own):
                at = np.searchsorted(contexts, keys >> 8)
                total, kinds = np.bincount(at, weights=n, minlength=len(contexts)), np.bincount(at, minlength=len(contexts))
                escape = np.where(total > 0, -np.log2(np.maximum(kinds, 1) / np.maximum(total + kinds, 1)), 0.0)
                length = escape[np.searchsorted(contexts, every >> 8)] + (8.0 if suffix is None else below[i][suffix])
                length[np.searchsorted(every, keys)] = -np.log2(n / (total + kinds)[at])
                lengths.append(length)
                escapes.append(np.append(escape, 0.0).astype(np.float32))
            below, below_keys = lengths, every
            self.grams.append(_Places(every))
            self.contexts.append(_Places(contexts))
            self.lengths.append([x.astype(np.float32) for x in lengths])
            self.escapes.append(escapes)

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each text (rows) in each language (columns)."""
        key = _grams(data, offsets)
        out = np.zeros((len(offsets) - 1, len(self.languages)))
        steps, left = [], np.arange(len(key))
        for order in range(ORDER, -1, -1):
            short = key[left] & ((1 << 8 * (order + 1)) - 1)
            at = self.grams[order].find(short)
            known = at >= 0
            steps.append((order, left[known], at[known], left[~known], self.contexts[order].find(short[~known] >> 8)))
            left = left[~known]
        for i in range(len(self.languages)):
            bits = np.zeros(len(key))
            for order, seen, at, rest, context in steps:
                bits[seen] += self.lengths[order][i][at]
                bits[rest] += self.escapes[order][i][context]
            bits[left] += 8.0
            total = np.concatenate([[0.0], np.cumsum(bits)])
            out[:, i] = total[offsets[1:]] - total[offsets[:-1]]
        return out

    def predict(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(position of the best language, its share of the likelihood)."""
        bits = self.code_lengths(*C.text_buffers(texts))
        best = bits.argmin(1)
        gap = bits - bits[np.arange(len(bits)), best][:, None]
        return best, 1 / np.exp2(-np.minimum(gap, 1000)).sum(1)


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in C.byte_slices(batch, "text"):
            for lang in pc.unique(part.column(1)).to_pylist():
                data, off = C.text_buffers(part.filter(pc.equal(part.column(1), lang)).column(0))
                key, n = np.unique(_grams(data, off), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(key), pa.string()), pa.array(key), pa.array(n)], names=["lang", "key", "n"])


def _prefix(text: Column, size: Column) -> Column:
    """The first ``size`` bytes of a longer text, less the bytes of a character that would be cut."""
    raw = text.cast("binary")

    def whole(end: Column) -> Column:
        return ~F.hex(F.substring(raw, (end + 1).cast("int"), F.lit(1))).between("80", "BF")

    end = F.when(whole(size), size).when(whole(size - 1), size - 1).when(whole(size - 2), size - 2).otherwise(size - 3)
    return F.substring(raw, F.lit(1), end.cast("int")).cast("string")


def _last_texts(rows: DataFrame, sample_bytes: int, min_texts: int) -> DataFrame:
    """(lang, last, room): for each language the rank of the last distinct text
    that the sample takes (``_ALL`` if all fit) and the bytes left for it.  Only
    the texts of the bar of a histogram over ranks, fine near zero, in which a
    language crosses the bound are ordered."""
    texts = C.stored(rows.groupBy("lang", "rank").agg(F.max(F.octet_length("text")).cast("long").alias("bytes"))
                     .withColumn("bar", F.floor(16 * F.log2(F.col("rank") + 1))), "language-texts")
    bars = texts.groupBy("lang", "bar").agg(F.sum("bytes").alias("n"))
    bars = bars.withColumn("before", F.sum("n").over(Window.partitionBy("lang").orderBy("bar")) - F.col("n"))
    crossed = bars.filter((F.col("before") < sample_bytes) & (F.col("before") + F.col("n") >= sample_bytes)).select("lang", "bar", "before")
    inner = texts.join(crossed, ["lang", "bar"])
    inner = inner.withColumn("before", F.col("before") + F.sum("bytes").over(Window.partitionBy("lang").orderBy("rank")) - F.col("bytes"))
    ends = (inner.filter((F.col("before") < sample_bytes) & (F.col("before") + F.col("bytes") >= sample_bytes))
            .select("lang", F.col("rank").alias("last"), (sample_bytes - F.col("before")).alias("room")))
    langs = texts.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_texts).select("lang")
    # a stored table: its size decides how it is joined to the texts
    return C.stored(langs.join(ends, "lang", "left").select("lang", F.coalesce("last", F.lit(_ALL)).alias("last"), F.coalesce("room", F.lit(0)).alias("room")), "language-ends")


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", sample_bytes: int = SAMPLE_BYTES, min_texts: int = 1) -> Statistics:
    """Fit the context trees on a bounded sample of the rows of ``labelled``
    that have a language and a letter.  What reaches the driver are the gram
    counts of the sample."""
    C.prepared(labelled.sparkSession)
    rows = labelled.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang")).filter(
        F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}")).withColumn("rank", F.shiftrightunsigned(F.xxhash64("text"), 2))
    chosen = rows.join(_last_texts(rows, sample_bytes, min_texts), "lang").filter(F.col("rank") <= F.col("last"))
    crossing = (F.col("rank") == F.col("last")) & (F.octet_length("text") > F.col("room"))
    cut = F.when(crossing, _prefix(F.col("text"), F.col("room"))).otherwise(F.col("text"))
    # copies count once
    sample = C.stored(chosen.select("lang", cut.alias("text"), "rank").distinct().select("text", "lang"), "language-sample")
    grams = sample.mapInArrow(_gram_counts, "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n")).toPandas()
    counts = {lang: own.sort_values("key") for lang, own in grams.groupby("lang")}
    return Statistics(sorted(counts), [(counts[k]["key"].to_numpy(np.int64), counts[k]["n"].to_numpy(np.float64)) for k in sorted(counts)])


def identify(docs: DataFrame, statistics: Statistics, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (the share of the predicted
    language in the likelihood, 0 to 1)."""
    spark = docs.sparkSession
    C.prepared(spark)
    languages = statistics.languages
    shared = spark.sparkContext.broadcast(statistics)
    name, key = C.rename_free(docs.columns, "has_letter"), uuid.uuid4().hex

    def compute(texts: pa.Array) -> list[pa.Array]:
        if not languages:
            return [pa.nulls(len(texts), pa.string()), pa.array(np.zeros(len(texts)))]
        best, score = C.held(key, lambda: Model(shared.value)).predict(texts)
        return [pa.array(languages, pa.string()).take(pa.array(best)), pa.array(score)]

    out = C.add_columns(docs, text_col, compute, [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    letter = F.coalesce(F.col(f"`{text_col}`").rlike("\\p{L}"), F.lit(False)) & F.col("lang_pred").isNotNull()
    return (out.withColumn(name, letter).withColumn("lang_pred", F.when(F.col(name), F.col("lang_pred")).otherwise(UNKNOWN))
            .withColumn("score", F.when(F.col(name), F.col("score")).otherwise(0.0)).drop(name))


def fold(id_col: Column, folds: int = 4) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(id_col.cast("string").cast("binary")) % folds
