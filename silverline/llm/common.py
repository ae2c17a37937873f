"""Shared helpers: Arrow string buffers as numpy arrays, spans of lines and
words, hashes of spans, tables written to the shared checkpoint folder.

All array helpers work on one bounded slice of rows at a time (``byte_slices``)
and need a small multiple of that slice in memory.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverline.session import ship_package, stored  # noqa: F401  (stored: for the operators)

#: Text bytes worked on at a time; arrays of some 30 times that go with it.
SLICE_BYTES = 2 << 20

#: White space of the line and word contracts: space and \x09-\x0D.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: A-Z to a-z, every other byte to itself.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and int64 offsets (first is 0) of a string array; nulls
    count as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    bufs = col.buffers()
    off = np.frombuffer(bufs[1], np.int64 if wide else np.int32, len(col) + 1 + col.offset)[col.offset:] \
        if bufs[1] is not None and bufs[1].size else np.zeros(len(col) + 1, np.int64)
    off = off.astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def string_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A string array over existing bytes; offsets must fit int32 (a slice does)."""
    if len(offsets) and offsets[-1] > np.iinfo(np.int32).max:
        return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1,
                                     [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
    return pa.Array.from_buffers(pa.string(), len(offsets) - 1,
                                 [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def byte_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive row slices whose texts hold at most ``limit`` bytes
    together; a longer single text is a slice of its own."""
    size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
    ends = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64))
    at, n = 0, batch.num_rows
    while at < n:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of every \\n-separated line; an empty text has one."""
    nl = np.flatnonzero(data == 10)
    row = np.repeat(np.arange(len(offsets) - 1),
                    1 + np.searchsorted(nl, offsets[1:]) - np.searchsorted(nl, offsets[:-1]))
    # both lists rise with the line number, so sorting each pairs them
    return row, np.sort(np.concatenate([offsets[:-1], nl + 1])), np.sort(np.concatenate([nl, offsets[1:]]))


def trimmed(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans without white space at either end (empty ones become (start, start))."""
    ink = np.flatnonzero(~IS_SPACE[data])
    if not len(ink):
        return start, start
    i, j = np.searchsorted(ink, start), np.searchsorted(ink, end) - 1
    some = j >= i
    return (np.where(some, ink[np.minimum(i, len(ink) - 1)], start),
            np.where(some, ink[np.maximum(j, 0)] + 1, start))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of every maximal run without white space; a run never
    crosses a text boundary."""
    ink = ~IS_SPACE[data]
    if not len(ink):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, last = ink.copy(), ink.copy()
    first[1:] &= ~ink[:-1]
    last[:-1] &= ~ink[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = ink[cuts]
    last[cuts - 1] = ink[cuts - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def code_points(data: np.ndarray) -> np.ndarray:
    """``c`` with ``c[e] - c[s]`` code points in bytes ``s:e``."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out


_MASK = (1 << 64) - 1
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
_BLOCK = 1 << 18


def _powers(base: int) -> np.ndarray:
    out = np.full(_BLOCK + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW, _INV = _powers(_BASE), _powers(_INVERSE)
_BYTE = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span; ``start`` and ``end`` rise.

    Prefix sums of a polynomial, taken block by block: memory follows the
    block and the number of spans."""
    at_start, at_end = np.zeros(len(start), np.uint64), np.zeros(len(end), np.uint64)
    carry, scale, unscale = 0, 1, 1
    for off in range(0, len(data) + 1, _BLOCK):
        block = data[off:off + _BLOCK]
        sums = np.zeros(len(block) + 1, np.uint64)
        np.cumsum(_BYTE[block] * _POW[:len(block)], out=sums[1:])
        for pos, out in ((start, at_start), (end, at_end)):
            lo, hi = np.searchsorted(pos, off), np.searchsorted(pos, off + _BLOCK)
            out[lo:hi] = np.uint64(carry) + np.uint64(scale) * sums[pos[lo:hi] - off]
            if out is at_start:
                here, back = (lo, hi), np.uint64(unscale) * _INV[pos[lo:hi] - off]
        # the start's power is divided out once its end is known
        if off == 0:
            shift = np.zeros(len(start), np.uint64)
        shift[here[0]:here[1]] = back
        carry = (carry + scale * int(sums[-1])) & _MASK
        scale = scale * int(_POW[_BLOCK]) & _MASK
        unscale = unscale * int(_INV[_BLOCK]) & _MASK
    return mix((at_end - at_start) * shift + (end - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def window_hash(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive word hashes."""
    n = max(0, len(words) - width + 1)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = mix(out * np.uint64(0x2545F4914F6CDD1D) + words[k:k + n])
    return out


_HELD: dict[str, object] = {}


def held(key: str, build):
    """What ``build`` gives, kept in this Python worker under ``key``.  A
    worker serves many stages and keeps the last object only, so models of
    operators that are done take no memory."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = build()
    return _HELD[key]


def let_go() -> None:
    """Drop what an earlier stage left in this worker."""
    _HELD.clear()


def prepared(spark: SparkSession) -> None:
    """Make this package importable in Python workers."""
    ship_package(spark)


def rename_free(taken: Sequence[str], name: str) -> str:
    """``name``, with underscores in front until no taken column has it
    (column names compare without case)."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name = "_" + name
    return name


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` without the columns that carry one of ``names`` in any case."""
    low = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in low])


def add_columns(df: DataFrame, text_col: str, compute, fields: Sequence[T.StructField], limit: int = SLICE_BYTES) -> DataFrame:
    """``df`` with the columns ``fields``, which ``compute(texts)`` gives as
    Arrow arrays for each bounded slice of rows; other columns pass through,
    those that carry one of the new names are replaced."""
    df = without(df, [f.name for f in fields])
    names, at, n = df.columns, df.columns.index(text_col), len(df.columns)
    plain = [str(i) for i in range(n + len(fields))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, str(at), limit):
                yield pa.RecordBatch.from_arrays([*part.columns, *compute(part.column(at))], names=plain)

    kinds = [*(f.dataType for f in df.schema.fields), *(f.dataType for f in fields)]
    return df.toDF(*plain[:n]).mapInArrow(run, T.StructType([T.StructField(p, k) for p, k in zip(plain, kinds)])) \
             .toDF(*names, *(f.name for f in fields))
