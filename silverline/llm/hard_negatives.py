"""Hard-negative mining over Hilbert-ordered blocks with zone maps (operator 11).

Vectors become whole numbers floor(scale * x), so a score, their inner product,
is exact.  Rows are laid along a Hilbert curve through all dimensions and
written as Parquet, one row per block of up to ``block_rows`` vectors with its
zone map: the least and greatest value of each dimension, and the labels if
they are few.  An anchor searches windows of scores.  Interval arithmetic bounds
its score with anything in a block, the sum over dimensions of the lesser and of
the greater product with the two ends, and a block is read for those anchors
alone that have a window meeting the bounds.

Two rounds: the best rows of an anchor's own label (its positives), then for
each positive the best rows of other labels whose score lies between ``low`` and
``high`` percent of the positive's.  A floor makes windows narrow before blocks
are chosen: for positives the best that the anchor's own block holds, for
negatives the best among ``sample_rows`` rows.  Floors only spare reading; every
row that might be among the first is scored.

At scale: anchors meet zone maps in cells of at most ``CELL_ZONES`` zones and
``CELL_PACKS`` packs of anchors (a block's anchors each), then each needed
(block, anchors) pair goes to the block, which is held once while its anchors
stream by.  No group is larger than a block.  Each block gives its first few
rows for a window, and ranks within a window merge by partial top-k.  The
sample (``sample_rows``) and two values per dimension are all that is broadcast.
The work is anchors times rows where bounds exclude nothing.

Defined cases: rows with a null id, label or vector, a null or non-finite
component, a component of 16384 or more in size, or another length than most
rows (the longer one of ties) take no part.  Repeated rows are rows of their
own; equal scores go by smaller id, then by place on the curve.  A vector
without components scores 0.  A window whose ends are the wrong way round, as
for a negative positive score, holds nothing.  An empty table gives an empty
result.  Ids and labels are whole numbers; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverline.llm import common as C
from silverline.session import stored

LARGEST = 16384.0
#: Bits of each dimension on the curve, and labels that a zone map lists.
BITS, ZONE_LABELS = 4, 64
CELL_ZONES, CELL_PACKS = 8192, 32
_PLACES = 1 << 16
_NEVER = np.int64(1) << 62


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of points (rows of ``bits``-bit cell numbers)
    as big-endian bytes: one row of bytes a point, in curve order when compared."""
    x = np.ascontiguousarray(cells.T.astype(np.uint32))
    n = len(x)
    if not n:
        return np.zeros((len(cells), 1), np.uint8)
    # undo the turns of the sub-cubes from the coarsest on, exchanging or mirroring low bits
    for level in range(bits - 1, 0, -1):
        low = np.uint32((1 << level) - 1)
        for i in range(n):
            mirrored = (x[i] >> np.uint32(level) & np.uint32(1)).astype(bool)
            swap = np.where(mirrored, np.uint32(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(mirrored, low, swap)
            x[i] ^= swap
    # Gray code across the dimensions
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[n - 1] >> np.uint32(level) & np.uint32(1), np.uint32((1 << level) - 1), np.uint32(0))
    x ^= flip
    planes = [x >> np.uint32(level) & np.uint32(1) for level in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).astype(np.uint8), axis=0).T


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """The components of equally long lists as doubles, a row each."""
    flat = lists.flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), width)


def _binary(rows: list[bytes]) -> pa.Array:
    return pa.array(rows, pa.binary())


def _first(score: np.ndarray, allowed: np.ndarray, want: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of entries that may be among the ``want`` highest allowed
    of their row, ties with the last of them included."""
    n = score.shape[1]
    if allowed.sum() > 64 * len(score) and n > want:
        masked = np.where(allowed, score, -_NEVER if score.dtype == np.int64 else -np.inf)
        allowed &= score >= np.partition(masked, n - want, axis=1)[:, n - want][:, None]
    return np.nonzero(allowed)


class _Block:
    """A block's rows as numpy arrays."""

    def __init__(self, n: int, width: int, kind: str, ids: bytes, labels: bytes, vectors: bytes):
        self.ids, self.labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
        self.vectors = np.frombuffer(vectors, kind).reshape(n, width)


class _Layout:
    """What all tasks know of the vectors: their length, the ends of each
    dimension, and the types that hold components and scores exactly."""

    def __init__(self, scale: int, ends: np.ndarray):
        self.scale, self.ends, self.width = scale, ends, len(ends)
        most = max(int(np.abs(ends).max(initial=0)), 1)
        self.kind = "<i1" if most < 1 << 7 else "<i2" if most < 1 << 15 else "<i4"
        largest = self.width * most * most
        self.exact = np.float32 if largest < 1 << 24 else np.float64 if largest < 1 << 53 else np.int64

    def whole(self, lists: pa.Array) -> np.ndarray:
        return np.floor(_matrix(lists, self.width) * self.scale).astype(self.kind)

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        low, high = self.ends[:, 0], self.ends[:, 1]
        cell = (vectors.astype(np.int64) - low) * (1 << BITS) // np.maximum(high - low + 1, 1)
        return hilbert_keys(cell, BITS)


def _usable(vectors: DataFrame, id_col: str, label_col: str, vector_col: str, anchor: Column) -> DataFrame:
    sound = F.forall("vec", lambda x: x.isNotNull() & (F.abs(x) < LARGEST))  # NaN is greater than any number
    return (vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"),
                           F.col(f"`{vector_col}`").cast("array<double>").alias("vec"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
            .filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & sound))


def _ends(rows: DataFrame, scale: int, width: int) -> np.ndarray:
    """Least and greatest whole number of each dimension."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        for batch in batches:
            if batch.num_rows and width:
                x = np.floor(_matrix(batch.column(0), width) * scale)
                low = x.min(0) if low is None else np.minimum(low, x.min(0))
                high = x.max(0) if high is None else np.maximum(high, x.max(0))
        if low is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(low.astype(np.int64)), pa.array(high.astype(np.int64))], names=["at", "low", "high"])

    found = rows.select("vec").mapInArrow(partial, "at long, low long, high long").groupBy("at").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    out = np.zeros((width, 2), np.int64)
    for r in found.collect():  # two numbers a dimension
        out[r.at] = r.low, r.high
    return out


def write_blocks(rows: DataFrame, layout: _Layout, block_rows: int) -> DataFrame:
    """The rows as a stored table of blocks in curve order: block, n, low, high,
    labels (null if many), ids, row_labels, vectors, anchors (their places)."""

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = layout.whole(batch.column("vec"))
            yield pa.RecordBatch.from_arrays(
                [_binary([k.tobytes() for k in layout.keys(whole)]), batch.column("id"), batch.column("label"), batch.column("anchor"),
                 _binary([v.tobytes() for v in whole])], names=["key", "id", "label", "anchor", "vector"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n, held, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            held.append(batch.select(["id", "label", "anchor", "vector"]))
            size += batch.num_rows
            while size >= block_rows:
                whole = pa.Table.from_batches(held)
                yield block(whole.slice(0, block_rows).combine_chunks(), task << 20 | n)
                n, held, size = n + 1, whole.slice(block_rows).to_batches(), size - block_rows
        if size:
            yield block(pa.Table.from_batches(held).combine_chunks(), task << 20 | n)

    def block(part: pa.Table, number: int) -> pa.RecordBatch:
        ids, labels, anchor = (part.column(k).to_numpy() for k in ("id", "label", "anchor"))
        raw = b"".join(part.column("vector").to_pylist())
        x = np.frombuffer(raw, layout.kind).reshape(len(ids), layout.width)
        kinds = np.unique(labels)
        ends = [x.min(0).astype("<i4").tobytes(), x.max(0).astype("<i4").tobytes()]
        places = np.flatnonzero(anchor).astype("<i4").tobytes()
        return pa.RecordBatch.from_arrays(
            [pa.array([number]), pa.array([len(ids)], pa.int32()), *[_binary([e]) for e in ends],
             pa.array([kinds if len(kinds) <= ZONE_LABELS else None], pa.list_(pa.int64())),
             *[_binary([b]) for b in (ids.astype("<i8").tobytes(), labels.astype("<i8").tobytes(), raw, places)]],
            names=["block", "n", "low", "high", "labels", "ids", "row_labels", "vectors", "anchors"])

    keyed = rows.mapInArrow(key, "key binary, id long, label long, anchor boolean, vector binary")
    # the id keeps a run of equal vectors from being one partition
    laid = keyed.repartitionByRange("key", "id").sortWithinPartitions("key", "id")
    return stored(laid.mapInArrow(pack, "block long, n int, low binary, high binary, labels array<long>, ids binary, row_labels binary, vectors binary, anchors binary"),
                  "negatives-blocks")


#: Packs of anchors: k anchors with w windows each, as bytes of int64 arrays.
_PACK = "pack long, at binary, id binary, label binary, vectors binary, low binary, high binary"


def _anchor_packs(blocks: DataFrame, layout: _Layout, want: int) -> DataFrame:
    """A pack for each block with anchors: one window from the score of the
    ``want``-th best row of the anchor's label in its own block on."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                held = _Block(r["n"], layout.width, layout.kind, r["ids"], r["row_labels"], r["vectors"])
                places = np.frombuffer(r["anchors"], np.int32).astype(np.int64)
                rows = held.vectors.astype(layout.exact)
                low = np.full(len(places), -_NEVER)
                for a in range(0, len(places), 256):
                    some = places[a:a + 256]
                    score = (rows[some] @ rows.T).astype(np.int64)
                    allowed = held.labels[some][:, None] == held.labels
                    allowed[np.arange(len(some)), some] = False
                    enough = allowed.sum(1) >= want
                    if enough.any():
                        low[a + np.flatnonzero(enough)] = np.partition(np.where(allowed[enough], score[enough], -_NEVER), r["n"] - want, axis=1)[:, r["n"] - want]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["block"]]), *[_binary([b.tobytes()]) for b in (
                        r["block"] * _PLACES + places, held.ids[places], held.labels[places], held.vectors[places], low, np.full(len(places), _NEVER))]],
                    names=["pack", "at", "id", "label", "vectors", "low", "high"])

    return stored(blocks.filter(F.length("anchors") > 0).select("block", "n", "ids", "row_labels", "vectors", "anchors").mapInArrow(pack, _PACK), "negatives-anchors")


def _windows(packs: DataFrame, positives: DataFrame, sample: list, layout: _Layout, want: int, low_pct: int, high_pct: int, width: int) -> DataFrame:
    """The packs with a window for each positive, its floor raised to the
    ``want``-th best that the sample holds in it."""
    ids, labels, rows = (np.array([r[0] for r in sample], np.int64), np.array([r[1] for r in sample], np.int64),
                         np.frombuffer(b"".join([r[2] for r in sample]), layout.kind).reshape(len(sample), layout.width))
    shared = packs.sparkSession.sparkContext.broadcast((ids, labels, rows))
    scores = positives.groupBy(F.expr(f"at div {_PLACES}").alias("pack")).agg(F.collect_list(F.struct("at", "place", "score")).alias("scores"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, seen, others = shared.value
        others = others.astype(layout.exact)
        for batch in batches:
            for r in batch.to_pylist():
                at, label = np.frombuffer(r["at"], np.int64), np.frombuffer(r["label"], np.int64)
                x = np.frombuffer(r["vectors"], layout.kind).reshape(len(at), layout.width)
                low, high = np.full((len(at), width), _NEVER), np.full((len(at), width), -_NEVER)
                got = np.array([(s["at"], s["place"], s["score"]) for s in r["scores"]], np.int64).reshape(-1, 3)
                row, place = np.searchsorted(at, got[:, 0]), got[:, 1] - 1
                low[row, place] = -(-low_pct * got[:, 2] // 100)
                high[row, place] = high_pct * got[:, 2] // 100
                for a in range(0, len(at), 256):
                    score = (x[a:a + 256].astype(layout.exact) @ others.T).astype(np.int64)
                    differ = label[a:a + 256][:, None] != seen
                    for w in range(width):
                        l, h = low[a:a + 256, w], high[a:a + 256, w]
                        inside = differ & (score >= l[:, None]) & (score <= h[:, None])
                        enough = np.flatnonzero(inside.sum(1) >= want)
                        if len(enough):
                            l[enough] = np.partition(np.where(inside[enough], score[enough], -_NEVER), len(seen) - want, axis=1)[:, len(seen) - want]
                yield pa.RecordBatch.from_arrays([pa.array([r["pack"]]), *[_binary([r[k]]) for k in ("at", "id", "label", "vectors")],
                                                  _binary([low.tobytes()]), _binary([high.tobytes()])], names=["pack", "at", "id", "label", "vectors", "low", "high"])

    return packs.drop("low", "high").join(scores, "pack").mapInArrow(build, _PACK)


def _needed(blocks: DataFrame, packs: DataFrame, layout: _Layout, width: int, same: bool) -> DataFrame:
    """The anchors of each pack that have a window meeting a block's bounds: a
    row for each block and pack with any."""
    n_blocks = blocks.count()
    n_packs = blocks.filter(F.length("anchors") > 0).count()
    groups, salts = -(-n_blocks // CELL_ZONES) or 1, -(-n_packs // CELL_PACKS) or 1
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    zones = (blocks.select(F.lit(0).alias("kind"), "block", F.col("low").alias("zone_low"), F.col("high").alias("zone_high"), "labels",
                           F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int").alias("g")).withColumn("s", every(salts)))
    asked = packs.withColumn("kind", F.lit(1)).withColumn("s", F.pmod(F.xxhash64("pack"), F.lit(salts)).cast("int")).withColumn("g", every(groups))
    cells = zones.unionByName(asked, allowMissingColumns=True).repartition("g", "s").sortWithinPartitions("g", "s", "kind")

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, zones, made = None, [], None
        for batch in batches:
            for r in batch.to_pylist():
                if (r["g"], r["s"]) != cell:
                    cell, zones, made = (r["g"], r["s"]), [], None
                if r["kind"] == 0:
                    zones.append((r["block"], r["zone_low"], r["zone_high"], r["labels"]))
                    continue
                if made is None:
                    made = [np.frombuffer(b"".join([z[k] for z in zones]), np.int32).reshape(len(zones), layout.width).astype(np.float64).T for k in (1, 2)]
                yield from meet(r, zones, *made)

    def meet(r: dict, zones: list, bottom: np.ndarray, top: np.ndarray) -> Iterator[pa.RecordBatch]:
        label = np.frombuffer(r["label"], np.int64)
        x = np.frombuffer(r["vectors"], layout.kind).reshape(len(label), layout.width).astype(np.float64)
        low, high = (np.frombuffer(r[k], np.int64).reshape(len(label), width) for k in ("low", "high"))
        up, down = np.maximum(x, 0), np.minimum(x, 0)
        # sums beyond 2^53 are rounded: widen the bounds by that
        slack = 0.0 if layout.exact is not np.int64 else layout.width * 2.0 ** 12
        least, most = up @ bottom + down @ top - slack, up @ top + down @ bottom + slack
        wanted = np.zeros(least.shape, bool)
        for w in range(width):
            wanted |= (low[:, w] <= high[:, w])[:, None] & (most >= low[:, w][:, None]) & (least <= high[:, w][:, None])
        for z in np.flatnonzero(wanted.any(0)):
            kinds = zones[z][3]
            take = wanted[:, z]
            if kinds is not None:
                take = take & (np.isin(label, kinds) if same else (len(kinds) > 1) | (label != kinds[0]))
            if not take.any():
                continue
            parts = [np.frombuffer(r[k], np.int64)[take] for k in ("at", "id", "label")]
            parts += [np.frombuffer(r["vectors"], layout.kind).reshape(len(label), layout.width)[take], low[take], high[take]]
            yield pa.RecordBatch.from_arrays([pa.array([zones[z][0]]), pa.array([r["pack"]]), *[_binary([p.tobytes()]) for p in parts]],
                                             names=["block", "pack", "at", "id", "label", "vectors", "low", "high"])

    return cells.mapInArrow(choose, "block long, " + _PACK)


def _search(blocks: DataFrame, packs: DataFrame, layout: _Layout, width: int, same: bool, want: int) -> DataFrame:
    """(at, anchor_id, window, place, other_id, score): the first ``want`` rows
    of every window, of the anchor's label or of others."""
    asked = stored(_needed(blocks, packs, layout, width, same).withColumn("kind", F.lit(1)), "negatives-asked")
    held = blocks.select("block", F.lit(0).alias("kind"), "n", "ids", "row_labels", F.col("vectors").alias("rows"))
    # a block that nobody asks for goes no further
    held = held.join(asked.select("block").distinct(), "block", "left_semi")
    both = held.unionByName(asked, allowMissingColumns=True).repartition("block").sortWithinPartitions("block", "kind", "pack")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, rows, number = None, None, None
        for batch in batches:
            for i in range(batch.num_rows):
                r = {k: batch.column(k)[i].as_py() for k in ("block", "kind")}
                r |= {k: batch.column(k)[i].as_py() for k in (("n", "ids", "row_labels", "rows") if r["kind"] == 0 else ("at", "id", "label", "vectors", "low", "high"))}
                if r["kind"] == 0:
                    number, block = r["block"], _Block(r["n"], layout.width, layout.kind, r["ids"], r["row_labels"], r["rows"])
                    rows = block.vectors.astype(layout.exact)
                    continue
                at, ids, label = (np.frombuffer(r[k], np.int64) for k in ("at", "id", "label"))
                x = np.frombuffer(r["vectors"], layout.kind).reshape(len(at), layout.width).astype(layout.exact)
                low, high = (np.frombuffer(r[k], np.int64).reshape(len(at), width) for k in ("low", "high"))
                for a in range(0, len(at), 256):
                    found = best(number, block, x[a:a + 256] @ rows.T, at[a:a + 256], ids[a:a + 256], label[a:a + 256], low[a:a + 256], high[a:a + 256])
                    if found is not None:
                        yield found

    def best(number: int, block: _Block, score: np.ndarray, at: np.ndarray, ids: np.ndarray, label: np.ndarray,
             low: np.ndarray, high: np.ndarray) -> pa.RecordBatch | None:
        fits = (label[:, None] == block.labels) == same
        if same:
            own = np.flatnonzero(at // _PLACES == number)
            fits[own, at[own] % _PLACES] = False
        out = []
        for w in range(width):
            row, col = _first(score, fits & (score >= _held(low[:, w], score)) & (score <= _held(high[:, w], score)), want)
            value = score[row, col].astype(np.int64)
            order = np.lexsort((col, block.ids[col], -value, row))
            row, col, value = row[order], col[order], value[order]
            place = np.arange(len(row)) - np.searchsorted(row, row)
            keep = place < want
            out.append((row[keep], np.full(int(keep.sum()), w + 1), col[keep], value[keep]))
        row, window, col, value = map(np.concatenate, zip(*out))
        if not len(row):
            return None
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (at[row], ids[row], window, block.ids[col], number * _PLACES + col, value)],
                                          names=["at", "anchor_id", "window", "other_id", "other_at", "score"])

    found = both.mapInArrow(scan, "at long, anchor_id long, window long, other_id long, other_at long, score long")
    order = Window.partitionBy("at", "window").orderBy(F.desc("score"), "other_id", "other_at")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= want).drop("other_at")


def _held(ends: np.ndarray, score: np.ndarray) -> np.ndarray:
    """Window ends as a column of the scores' type; scores lie well within +-2^62."""
    if score.dtype == np.int64:
        return ends[:, None]
    limit = 1 << (24 if score.dtype == np.float32 else 53)
    return np.clip(ends, -limit, limit).astype(score.dtype)[:, None]


def mine(vectors: DataFrame, anchor: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", positives: int = 5,
         negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256, block_rows: int = 8192, sample_rows: int = 4096) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score:
    for each row where ``anchor`` holds and each of its first ``positives``
    other rows of the same label, the first ``negatives`` rows of other labels
    with low * positive_score <= 100 * negative_score <= high * positive_score."""
    spark = vectors.sparkSession
    C.prepared(spark)
    rows = _usable(vectors, id_col, label_col, vector_col, anchor)
    usual = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    length = usual.n if usual else 0
    rows = rows.filter(F.size("vec") == length)
    layout = _Layout(scale, _ends(rows, scale, length))
    blocks = write_blocks(rows, layout, block_rows)
    packs = _anchor_packs(blocks, layout, positives)
    near = stored(_search(blocks, packs, layout, 1, True, positives), "negatives-positives")
    # a bounded sample for the floors: the rows with the least hashes
    drawn = rows.orderBy(F.xxhash64("id", F.lit(11)), "id").limit(sample_rows).select("id", "label", "vec").collect()
    sample = [(r.id, r.label, np.floor(np.array(r.vec, np.float64) * scale).astype(layout.kind).tobytes()) for r in drawn]
    asked = stored(_windows(packs, near, sample, layout, negatives, low, high, positives), "negatives-windows")
    far = _search(blocks, asked, layout, positives, False, negatives)
    chosen = near.select("at", F.col("place").cast("long").alias("window"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (far.withColumnRenamed("score", "negative_score").join(chosen, ["at", "window"])
            .select("anchor_id", "positive_id", F.col("place").alias("rank"), F.col("other_id").alias("negative_id"), "positive_score", "negative_score"))
