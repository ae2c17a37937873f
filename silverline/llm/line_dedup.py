"""Drop lines that repeat across documents (operator 1).

1. Every task hashes the line keys of its documents and emits the bits they
   set in two Bloom filters, "seen once" and "seen twice", cut into segments;
   the segments are merged in a shuffle (a bit set by two tasks has been seen
   twice).  Only the twice filter reaches the tasks; its size is bounded by
   ``max_filter_bits``.
2. A second scan emits (document, 128-bit key digest) for keys in the twice
   filter alone.  One aggregate confirms them by exact counting and chooses
   the document that keeps the line.  A filter that fills up lets more keys
   through to this step and never changes a result.
3. Documents get the list of the keys they lose and drop those lines.

A line's key is the line without white space ``[\\x20\\x09-\\x0D]`` at its
ends, A-Z in lower case.  Keys under ``min_chars`` code points never count.

Defined cases: a null or empty text is one empty line.  Rows that share a
document id are one document (each loses the lines that the document loses);
rows without an id are together one document, smaller than any other.  A tie
cannot arise, as ids are compared, not rows.  Input columns whose names clash
with ``n_lines`` or ``n_dropped`` are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverline.llm import common as C

SEGMENTS = 4096
FLUSH = 1 << 21


def _keys(data: np.ndarray, offsets: np.ndarray, min_chars: int):
    """(row, line number in the slice, key start, key end, lower-cased bytes)
    of lines whose key is long enough, and the (row, start, end) of all lines."""
    row, start, end = C.line_spans(data, offsets)
    a, b = C.trimmed(data, start, end)
    points = C.code_points(data)
    long = np.flatnonzero(points[b] - points[a] >= min_chars)
    return (row[long], long, a[long], b[long], C.LOWER[data]), (row, start, end)


def _positions(h: np.ndarray, bits: int) -> np.ndarray:
    """Two bit positions of each hash, in a filter of ``bits`` (a power of two)."""
    other = C.mix(h + np.uint64(0x9E3779B97F4A7C15))
    return np.concatenate([h, other]) & np.uint64(bits - 1)


def _width(bits: int) -> int:
    """Bits of a segment: whole bytes."""
    return max(8, bits // SEGMENTS)


def _bit_rows(hashes: list[np.ndarray], bits: int) -> pa.RecordBatch:
    """Rows (segment, positions set, positions set twice) of some key hashes."""
    pos, n = np.unique(_positions(np.concatenate(hashes), bits), return_counts=True)
    width = _width(bits)
    seg, cut = np.unique(pos // np.uint64(width), return_index=True)
    cut = [*cut.tolist(), len(pos)]
    local = (pos % np.uint64(width)).astype(np.uint32)
    once = [local[a:b].tobytes() for a, b in zip(cut, cut[1:])]
    twice = [local[a:b][n[a:b] > 1].tobytes() for a, b in zip(cut, cut[1:])]
    return pa.RecordBatch.from_arrays([pa.array(seg.astype(np.int32)), pa.array(once, pa.binary()), pa.array(twice, pa.binary())],
                                      names=["segment", "once", "twice"])


def _emit_bits(bits: int, min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        C.let_go()
        held, n = [], 0
        for batch in batches:
            for part in C.byte_slices(batch, "text"):
                data, off = C.text_buffers(part.column(0))
                (row, _, a, b, low), _ = _keys(data, off, min_chars)
                h = C.span_hash(low, a, b)
                order = np.lexsort((h, row))
                h, row = h[order], row[order]
                first = np.ones(len(h), bool)
                first[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])  # a document counts once
                held.append(h[first])
                n += int(first.sum())
                if n >= FLUSH:
                    yield _bit_rows(held, bits)
                    held, n = [], 0
        if n:
            yield _bit_rows(held, bits)
    return run


def _merge_bits(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = _width(bits)
        filters: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for seg, once, twice in zip(*(c.to_pylist() for c in batch.columns)):
                if seg not in filters:
                    filters[seg] = np.zeros(width, bool), np.zeros(width, bool)
                one, two = filters[seg]
                pos = np.frombuffer(once, np.uint32)
                two[pos[one[pos]]] = True
                one[pos] = True
                two[np.frombuffer(twice, np.uint32)] = True
        for seg, (_, two) in filters.items():
            if two.any():
                yield pa.RecordBatch.from_arrays([pa.array([seg], pa.int32()), pa.array([np.packbits(two).tobytes()], pa.binary())],
                                                 names=["segment", "twice"])
    return run


def twice_filter(texts: DataFrame, bits: int, min_chars: int) -> np.ndarray:
    """The packed twice filter over a one-column frame ``text``: ``bits / 8``
    bytes, whatever the input."""
    rows = texts.mapInArrow(_emit_bits(bits, min_chars), "segment int, once binary, twice binary")
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    merged = rows.repartition(min(parts, SEGMENTS), "segment").mapInArrow(_merge_bits(bits), "segment int, twice binary")
    width = _width(bits)
    out = np.zeros(bits // 8, np.uint8)
    for seg, packed in merged.toLocalIterator(prefetchPartitions=True):
        out[seg * width // 8:seg * width // 8 + len(packed)] = np.frombuffer(packed, np.uint8)
    return out


def _hit(packed: np.ndarray, bits: int, h: np.ndarray) -> np.ndarray:
    pos = _positions(h, bits).astype(np.int64)
    at = (packed[pos >> 3] >> (7 - (pos & 7)).astype(np.uint8)) & 1
    return (at[:len(h)] & at[len(h):]).astype(bool)


def _suspects(shared, bits: int, min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            for part in C.byte_slices(batch, "text"):
                data, off = C.text_buffers(part.column(1))
                (row, _, a, b, low), _ = _keys(data, off, min_chars)
                maybe = np.flatnonzero(_hit(packed, bits, C.span_hash(low, a, b)))
                if not len(maybe):
                    continue
                raw = low.tobytes()
                found = {(int(row[i]), hashlib.md5(raw[a[i]:b[i]]).digest()) for i in maybe}
                rows, keys = zip(*sorted(found))
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(rows)), pa.array(keys, pa.binary())], names=["id", "key"])
    return run


def _drop(min_chars: int, text_col: str, n_cols: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.byte_slices(batch, text_col):
                at = part.schema.get_field_index(text_col)
                data, off = C.text_buffers(part.column(at))
                (row, line, a, b, low), (rows, start, end) = _keys(data, off, min_chars)
                lost = part.column(n_cols)
                keep = np.ones(len(rows), bool)
                raw = low.tobytes()
                for r in np.flatnonzero(lost.is_valid().to_numpy(zero_copy_only=False)):
                    keys = set(lost[int(r)].as_py())
                    for i in range(np.searchsorted(row, r), np.searchsorted(row, r, side="right")):
                        if hashlib.md5(raw[a[i]:b[i]]).digest() in keys:
                            keep[line[i]] = False
                n_lines = np.bincount(rows, minlength=part.num_rows)
                n_dropped = np.bincount(rows[~keep], minlength=part.num_rows)
                text = data.tobytes()
                texts = []
                for r in range(part.num_rows):
                    if not n_dropped[r]:
                        texts.append(text[off[r]:off[r + 1]])
                    else:
                        of = np.arange(np.searchsorted(rows, r), np.searchsorted(rows, r, side="right"))
                        texts.append(b"\n".join(text[start[i]:end[i]] for i in of[keep[of]]))
                cols = list(part.columns[:n_cols])
                cols[at] = pa.array(texts, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*cols, pa.array(n_lines.astype(np.int64)), pa.array(n_dropped.astype(np.int64))],
                                                 names=[str(i) for i in range(n_cols + 2)])
    return run


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3,
                max_filter_bits: int = 1 << 30) -> DataFrame:
    """``docs`` with lines found in ``min_docs`` documents or more kept in the
    document of the largest id alone; adds ``n_lines`` (before) and
    ``n_dropped``.  A null text comes back empty."""
    spark = docs.sparkSession
    C.prepared(spark)
    docs = C.without(docs, ["n_lines", "n_dropped"])
    ids, texts = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    total = docs.select(F.sum(F.octet_length(texts))).first()[0] or 0
    # a key has min_chars bytes at least; in prose a line takes several times that
    wanted = max(1 << 16, total // 8)
    bits = min(max_filter_bits, 1 << int(wanted - 1).bit_length())
    shared = spark.sparkContext.broadcast(twice_filter(docs.select(texts.alias("text")), bits, min_chars).tobytes())
    id_type = docs.schema[id_col].dataType
    suspects = C.stored(docs.select(ids.alias("id"), texts.alias("text")).mapInArrow(
        _suspects(shared, bits, min_chars), T.StructType([T.StructField("id", id_type), T.StructField("key", T.BinaryType())])), "line-keys")
    # null ids count as one document: it adds one and is never the largest
    counted = suspects.groupBy("key").agg(
        (F.count_distinct("id") + F.max(F.col("id").isNull().cast("int"))).alias("n"), F.max("id").alias("keeper"))
    # a table of its own, so that AQE may broadcast it or split a key's rows in the join
    repeated = C.stored(counted.filter(F.col("n") >= min_docs).select("key", "keeper"), "repeated-lines")
    lost = (suspects.join(repeated, "key").filter(~F.col("id").eqNullSafe(F.col("keeper")))
            .groupBy(F.col("id").alias("lost_id")).agg(F.collect_set("key").alias("lost_keys")))
    # columns go by position, so that no name of the input can clash
    plain_docs = docs.toDF(*[str(i) for i in range(len(docs.columns))])
    by_id = F.col(str(docs.columns.index(id_col))).eqNullSafe(F.col("lost_id"))
    joined = plain_docs.join(lost, by_id, "left").select(*plain_docs.columns, "lost_keys")
    fields = docs.schema.fields
    plain = T.StructType([T.StructField(str(i), f.dataType) for i, f in enumerate(fields)]
                         + [T.StructField(str(len(fields) + i), T.LongType()) for i in range(2)])
    out = joined.toDF(*[str(i) for i in range(len(fields) + 1)]).mapInArrow(
        _drop(min_chars, str(docs.columns.index(text_col)), len(fields)), plain)
    return out.toDF(*docs.columns, "n_lines", "n_dropped")
