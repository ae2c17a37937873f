"""N-gram Jaccard join by chosen paths (operator 3).

Texts are sets of shingles of five normalised words (see
``decontaminate.word_hashes``); two texts link if the Jaccard similarity of
their sets is ``threshold`` or more.

1. One scan gives each text a key (its MD5), and a sketch: 64 minhashes, of
   which one byte each is kept.  Equal texts are one node from here on.
2. Chosen paths: in each run a node takes the path that starts with one of its
   minhashes.  Paths shared by two nodes or more are buckets.  A bucket of at
   most ``bucket`` nodes is compared by brute force on the sketches; a larger
   one is split again on ``branch`` sampled sketch positions, level by level.
   A bucket that keeps most of its parent is dense and would never shrink: it
   is compared in blocks.  The number of runs, and the sketch bytes that
   must agree, follow from ``recall``.
   A bucket emits one link per node to a root, never its pairs.
3. The components of these links are candidate groups.  Every pair inside one
   is then checked exactly on the whole sets, in blocks if the group is large;
   each block gives link counts per text and links to a root.
4. The components of the exact links are the classes.

A third of all rows may be copies, or share one passage: counting is partial
before the shuffle, large buckets split, blocks bound what a task holds.

Defined cases: texts of one to four words are one shingle; null texts and texts
without words link to nothing, equal ones included, and are classes of their
own.  Rows that share an id are one document.  The class id is the least id
in it, null ids last.  An empty table gives no rows; input columns named as the
results are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverline.llm import common as C
from silverline.llm.components import components
from silverline.llm.decontaminate import word_hashes

WIDTH = 5
SKETCH = 64
BUCKET = 4096
BLOCK_ROWS, BLOCK_BYTES = 512, 8 << 20

_FLIP, _TURN = np.random.default_rng(77).integers(1, 1 << 63, (2, SKETCH), dtype=np.uint64) | np.uint64(1)


def shingles(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every shingle of a slice, in the order of the texts."""
    row, h = word_hashes(data, offsets)
    windows = C.window_hash(h, width)
    own = np.flatnonzero(row[width - 1:] == row[:len(row) - width + 1]) if len(row) >= width else np.zeros(0, np.int64)
    n = np.bincount(row, minlength=len(offsets) - 1)
    short = np.flatnonzero((n > 0) & (n < width))
    first = np.searchsorted(row, short)
    # a short text is one shingle of all its words
    whole = np.zeros(len(short), np.uint64)
    for k in range(width - 1):
        has = n[short] > k
        whole[has] = C.mix(whole[has] * np.uint64(0x2545F4914F6CDD1D) + h[first[has] + k])
    rows = np.concatenate([row[own], short])
    hashes = np.concatenate([windows[own], C.mix(whole + np.uint64(1))])
    order = np.argsort(rows, kind="stable")
    return rows[order], hashes[order]


def minhashes(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(texts with shingles, their 64 minhashes)."""
    start = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else np.zeros(0, np.int64)
    out = np.zeros((len(start), SKETCH), np.uint64)
    if len(start):
        for k in range(SKETCH):
            out[:, k] = np.minimum.reduceat((h ^ _FLIP[k]) * _TURN[k], start)
    return row[start], out


def _sketch(runs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        C.let_go()
        for batch in batches:
            for part in C.byte_slices(batch, "text"):
                rows, least = minhashes(*shingles(*C.text_buffers(part.column(2))))
                take = pa.array(rows)
                paths = C.mix(least[:, :runs] ^ (np.arange(1, runs + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
                small = np.ascontiguousarray(C.mix(least) & np.uint64(0xFF)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(take), part.column(1).take(take), pa.FixedSizeBinaryArray.from_buffers(
                        pa.binary(SKETCH), len(rows), [None, pa.py_buffer(small.tobytes())]).cast(pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, runs * len(rows) + 1, runs, dtype=np.int32)), pa.array(paths.view(np.int64).ravel()))],
                    names=["id", "key", "sketch", "paths"])
    return run


def runs_of(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, pa.Table]]:
    """(key, rows) of each run of rows with equal values in the first ``keys``
    columns; the rows come sorted by them."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        table = table.combine_chunks()
        marks = np.zeros(table.num_rows, bool)
        for k in range(keys):
            v = table.column(k).to_numpy()
            marks[1:] |= v[1:] != v[:-1]
        cuts = [0, *np.flatnonzero(marks).tolist()]
        for a, b in zip(cuts, cuts[1:]):
            yield tuple(table.column(k)[a].as_py() for k in range(keys)), table.slice(a, b - a)
        held = table.slice(cuts[-1])
    if held is not None:
        yield tuple(held.column(k)[0].as_py() for k in range(keys)), held


def _sketch_matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, SKETCH)


def _groups(sketches: np.ndarray, side: np.ndarray | None, needed: int) -> np.ndarray:
    """Root position of each row's component, where rows link if ``needed``
    sketch bytes agree (and, with sides, only across them).  A row is compared
    with rows not yet reached alone, so dense buckets take few comparisons."""
    root = np.arange(len(sketches))
    left = np.ones(len(sketches), bool)
    for seed in range(len(sketches)):
        if not left[seed]:
            continue
        left[seed] = False
        todo = [seed]
        while todo:
            i = todo.pop()
            others = np.flatnonzero(left)
            if side is not None:
                others = others[side[others] != side[i]]
            if not len(others):
                continue
            near = others[(sketches[others] == sketches[i]).sum(1) >= needed]
            left[near] = False
            root[near] = seed
            todo += near.tolist()
    return root


def _compare(needed: int):
    """Links to a root from buckets (columns: bucket, side, key, sketch)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for _, rows in runs_of(batches, 2):
            if rows.num_rows < 2:
                continue
            sides = rows.column(2).to_numpy()
            root = _groups(_sketch_matrix(rows.column(4)), sides if sides.max() != sides.min() else None, needed)
            linked = np.flatnonzero(root != np.arange(len(root)))
            keys = rows.column(3).to_pylist()
            a += [keys[i] for i in linked]
            b += [keys[i] for i in root[linked]]
            if len(a) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])
                a, b = [], []
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])
    return run


def _compared(buckets: DataFrame, needed: int) -> DataFrame:
    """``buckets``: (bucket, pair, side, key, sketch), one task to a (bucket, pair)."""
    n = int(buckets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (buckets.select("bucket", "pair", "side", "key", "sketch").repartition(n, "bucket", "pair")
            .sortWithinPartitions("bucket", "pair").mapInArrow(_compare(needed), "a binary, b binary"))


def _blocks(rows: DataFrame, blocks: str, key: str = "key") -> DataFrame:
    """Deal the rows of each bucket over ``blocks`` blocks and each block to
    all pairs of blocks that hold it: (..., pair, side)."""
    block = F.pmod(F.xxhash64(key, F.lit(5)), F.col(blocks)).cast("int")
    dealt = rows.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), (F.col(blocks) - 1).cast("int"))))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    return dealt.withColumn("pair", low.cast("long") * F.lit(1 << 31) + high).withColumn("side", F.col("block")).drop("block", "other")


def candidate_links(nodes: DataFrame, needed: int, bucket: int, branch: int, max_levels: int = 12) -> DataFrame:
    """Links to roots inside the buckets of all runs; ``nodes``: (key, sketch, paths)."""
    rows = nodes.select(F.explode("paths").alias("bucket"), F.lit(2**62).alias("parent"), "key", "sketch")
    found = []
    for level in range(1, max_levels + 1):
        sizes = C.stored(rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.first("parent").alias("parent")).filter(F.col("n") > 1), "buckets")
        shared = C.stored(rows.drop("parent").join(sizes, "bucket"), "bucket-rows")
        found.append(_compared(shared.filter(F.col("n") <= bucket).withColumns({"pair": F.lit(0).cast("long"), "side": F.lit(0)}), needed))
        large = shared.filter(F.col("n") > bucket)
        most = sizes.agg(F.max("n")).first()[0] or 0
        if most <= bucket:
            break
        # at level 1 the parent is all rows; a bucket that keeps most of its parent is dense
        dense = F.col("n") >= 0.6 * F.col("parent") if level < max_levels else F.lit(True)
        found.append(_compared(_blocks(large.filter(dense).withColumn("blocks", F.ceil(2 * F.col("n") / bucket)), "blocks"), needed))
        sampled = F.transform(F.sequence(F.lit(1), F.lit(branch)), lambda i: F.pmod(F.xxhash64("bucket", i), F.lit(SKETCH)).cast("int"))
        child = F.transform(sampled, lambda i: F.xxhash64("bucket", i, F.substring("sketch", i + 1, F.lit(1))))
        rows = large.filter(~dense).select(F.explode(F.array_distinct(child)).alias("bucket"), F.col("n").alias("parent"), "key", "sketch")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _exact(threshold: float):
    """(key, root, links) of the texts that link to others in a (group, pair)
    of blocks; columns: group, pair, side, key, text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in runs_of(batches, 2):
            keys = rows.column(3).to_pylist()
            first = sorted({k: i for i, k in reversed(list(enumerate(keys)))}.values())  # repeated rows count once
            rows = rows.take(pa.array(first))
            if rows.num_rows < 2:
                continue
            linked = _linked(rows.column(4).combine_chunks(), rows.column(2).to_numpy(), threshold)
            degree = linked.sum(1)
            some = np.flatnonzero(degree)
            if len(some):
                root = _roots(linked)
                own = [keys[first[i]] for i in some]
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.binary()), pa.array([keys[first[i]] for i in root[some]], pa.binary()),
                                                  pa.array(degree[some].astype(np.int64))], names=["key", "root", "links"])
    return run


def _linked(texts: pa.Array, side: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of texts reach the threshold (across sides only, if there are two)."""
    n = len(texts)
    row_parts, hash_parts = [], []
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    at = 0
    for part in C.byte_slices(batch, "text"):
        row, h = shingles(*C.text_buffers(part.column(0)))
        order = np.lexsort((h, row))
        row, h = row[order], h[order]
        keep = np.concatenate([[True], (row[1:] != row[:-1]) | (h[1:] != h[:-1])]) if len(row) else np.zeros(0, bool)
        row_parts.append(row[keep] + at)
        hash_parts.append(h[keep])
        at += part.num_rows
    row, h = np.concatenate(row_parts), np.concatenate(hash_parts)
    size = np.bincount(row, minlength=n)
    order = np.argsort(h, kind="stable")
    row, h = row[order], h[order]
    new = np.concatenate([[True], h[1:] != h[:-1]]) if len(h) else np.zeros(0, bool)
    token = np.cumsum(new) - 1
    shared = np.bincount(token)[token] > 1  # a shingle of one text meets nothing
    row, token = row[shared], token[shared]
    token = np.cumsum(np.concatenate([[True], token[1:] != token[:-1]])) - 1 if len(token) else token
    common = np.zeros((n, n), np.float32)
    step = max(64, (4 << 20) // n)
    for a in range(0, int(token[-1]) + 1 if len(token) else 0, step):
        lo, hi = np.searchsorted(token, a), np.searchsorted(token, a + step)
        has = np.zeros((n, min(step, int(token[-1]) + 1 - a)), np.float32)
        has[row[lo:hi], token[lo:hi] - a] = 1
        common += has @ has.T
    union = size[:, None] + size[None, :] - common
    out = (common >= threshold * union - 1e-6) & (common > 0)
    np.fill_diagonal(out, False)
    if side.max() != side.min():
        out &= side[:, None] != side[None, :]
    return out


def _roots(linked: np.ndarray) -> np.ndarray:
    root = np.full(len(linked), -1)
    for seed in range(len(linked)):
        if root[seed] >= 0:
            continue
        root[seed], todo = seed, [seed]
        while todo:
            near = np.flatnonzero(linked[todo.pop()] & (root < 0))
            root[near] = seed
            todo += near.tolist()
    return root


def _runs_and_needed(threshold: float, recall: float) -> tuple[int, int]:
    """Runs, and sketch bytes that must agree: a pair at the threshold misses
    all paths, or the sketch, in half of ``1 - recall`` of cases each.  All
    runs see one sketch, so more of them don't make up for its misses."""
    miss = (1 - recall) / 2
    runs = max(1, math.ceil(math.log(miss) / math.log(1 - threshold)))
    same = threshold + (1 - threshold) / 256  # different minhashes may share their byte
    below, needed = 0.0, 0
    while needed < SKETCH:
        below += math.comb(SKETCH, needed) * same ** needed * (1 - same) ** (SKETCH - needed)
        if below > miss:
            break
        needed += 1
    return min(runs, SKETCH), needed


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, recall: float = 0.9999,
                 bucket: int = BUCKET, branch: int = 3, block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``class_id`` (least id of its class), ``copy_of`` (least id
    with the same text) and ``n_links`` (different texts that it links to)."""
    spark = docs.sparkSession
    C.prepared(spark)
    docs = C.without(docs, ["class_id", "copy_of", "n_links"])
    ids, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    kind = docs.schema[id_col].dataType
    runs, needed = _runs_and_needed(threshold, recall)
    texts = docs.select(ids.alias("id"), F.unhex(F.md5(text)).alias("key"), text.alias("text"))
    sketches = C.stored(texts.mapInArrow(_sketch(runs), T.StructType([
        T.StructField("id", kind), T.StructField("key", T.BinaryType()), T.StructField("sketch", T.BinaryType()),
        T.StructField("paths", T.ArrayType(T.LongType()))])), "near-sketches")
    nodes = C.stored(sketches.groupBy("key").agg(F.min("id").alias("id"), F.first("sketch").alias("sketch"), F.first("paths").alias("paths")), "near-nodes")
    groups = C.stored(components(candidate_links(nodes, needed, bucket, branch)), "near-groups")
    members = groups.join(nodes.select(F.col("key").alias("node"), "id"), "node")
    wanted = members.select(F.col("node").alias("key"), F.col("root").alias("group"), F.col("id").alias("least"))
    rows = texts.join(wanted, "key").filter(F.col("id").eqNullSafe(F.col("least"))).select("group", "key", "text")
    blocks = F.greatest(F.lit(1), F.ceil(F.col("n") / block_rows), F.least(F.col("n"), F.ceil(F.col("bytes") / block_bytes)))
    rows = C.stored(rows, "near-texts")
    size = C.stored(rows.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")).select("group", blocks.alias("blocks")), "near-sizes")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = _blocks(rows.join(size, "group"), "blocks").select("group", "pair", "side", "key", "text")
    exact = C.stored(dealt.repartition(n, "group", "pair").sortWithinPartitions("group", "pair")
                     .mapInArrow(_exact(threshold), "key binary, root binary, links long"), "near-links")
    classes = components(exact.select(F.col("key").alias("a"), F.col("root").alias("b"))).select(F.col("node").alias("key"), "root")
    links = exact.groupBy("key").agg(F.sum("links").alias("n_links"))
    linked = classes.join(links, "key").join(nodes.select("key", "id"), "key")
    least = linked.groupBy("root").agg(F.min("id").alias("class_id"))
    judged = linked.join(least, "root").select("key", "class_id", "n_links")
    result = C.stored(nodes.select("key", F.col("id").alias("copy_of")).join(judged, "key", "left").select(
        "key", "copy_of", F.coalesce("class_id", "copy_of").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")), "near-result")
    # columns go by position, so that no name of the input can clash
    cols = [str(i) for i in range(len(docs.columns))]
    own = F.col(cols[docs.columns.index(id_col)])
    keyed = docs.toDF(*cols).withColumn("text_key", F.unhex(F.md5(F.col(cols[docs.columns.index(text_col)]))))
    return keyed.join(result, F.col("text_key") == F.col("key"), "left").select(
        *cols, F.coalesce("class_id", own), F.coalesce("copy_of", own), F.coalesce("n_links", F.lit(0).cast("long"))
    ).toDF(*docs.columns, "class_id", "copy_of", "n_links")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One document of each class: the one with the least id."""
    found = near_classes(docs, id_col, **options)
    return found.filter(F.col(f"`{id_col}`").eqNullSafe(F.col("class_id"))).select(*[F.col(f"`{c}`") for c in C.without(docs, ["class_id", "copy_of", "n_links"]).columns])
