"""Hard negatives against a plain search over all pairs."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from silverline.llm import hard_negatives
from silverline.llm.hard_negatives import _first, hilbert_keys, mine

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, positives=5, negatives=3, scale=256):
    """Rows with usable vectors in the order given, ids of 50 as anchors."""
    usable = [(i, [int(np.floor(np.float64(np.float32(x)) * scale)) for x in v], y) for i, v, y in rows
              if i is not None and y is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    usual = max(Counter(len(v) for _, v, _ in usable).items(), key=lambda c: (c[1], c[0]))[0] if usable else 0
    usable = [r for r in usable if len(r[1]) == usual]
    out = []
    for k, (i, v, y) in enumerate(usable):
        if i % 50:
            continue
        scored = sorted(((sum(a * b for a, b in zip(v, w)), j, z) for n, (j, w, z) in enumerate(usable) if n != k), key=lambda s: (-s[0], s[1]))
        for ps, p, _ in [s for s in scored if s[2] == y][:positives]:
            fit = [s for s in scored if s[2] != y and 50 * ps <= 100 * s[0] <= 95 * ps]
            out += [(i, p, r, n, ps, ns) for r, (ns, n, _) in enumerate(fit[:negatives], 1)]
    return Counter(out)


def mined(spark, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    cols = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return Counter(tuple(r) for r in mine(frame, F.col("vec_id") % 50 == 0, **options).select(*cols).collect())


def clustered(n, width, seed, labels=4, spread=0.3, size=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, width))
    x = centres[rng.integers(0, 6, n)] + spread * rng.normal(size=(n, width))
    x = size * x / np.linalg.norm(x, axis=1, keepdims=True)
    return [(i, [float(c) for c in np.float32(v)], int(y)) for i, (v, y) in enumerate(zip(x, rng.integers(0, labels, n)))]


@pytest.mark.parametrize("block_rows", [16, 8192])
def test_all_pairs(spark, monkeypatch, block_rows):
    monkeypatch.setattr(hard_negatives, "CELL_ZONES", 3)
    monkeypatch.setattr(hard_negatives, "CELL_PACKS", 2)
    rows = clustered(700, 12, 1)
    # ties, repeated rows and ids, rows that take no part
    rows += [(1000 + k, rows[50][1], k % 3) for k in range(40)] + [rows[100], rows[100], (50, rows[7][1], 2)]
    rows += [(1050, None, 1), (1100, [None] * 12, 1), (1150, [float("nan")] * 12, 1), (1200, [float("inf")] * 12, 1),
             (None, rows[3][1], 1), (1250, rows[4][1], None), (1300, [1.0], 1)]
    assert mined(spark, rows, block_rows=block_rows, sample_rows=64) == brute(rows)


@pytest.mark.parametrize("size", [1.0, 60.0, 9000.0])
def test_scores_stay_exact_in_every_type(spark, size):
    rows = clustered(150, 40, 2, size=size)
    assert mined(spark, rows, block_rows=32) == brute(rows)


def test_one_label_few_rows_and_empty_table(spark):
    one = [(i, [float(i), 1.0], 3) for i in range(0, 300, 10)]
    assert mined(spark, one) == Counter()
    few = [(0, [1.0, 0.0], 1), (1, [0.9, 0.1], 1), (2, [0.7, 0.0], 2), (50, [-1.0, 0.0], 9)]
    assert mined(spark, few) == brute(few) and len(brute(few)) == 1
    assert mined(spark, []) == Counter()


def test_curve_goes_from_neighbour_to_neighbour():
    for n, bits in ((2, 4), (3, 3), (5, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n), -1).reshape(-1, n)
        keys = hilbert_keys(cells, bits)
        order = np.lexsort(keys.T[::-1])
        assert len(np.unique(keys, axis=0)) == len(cells)
        assert (np.abs(np.diff(cells[order], axis=0)).sum(1) == 1).all()


def test_first_keeps_ties():
    score = np.array([[5.0, 5, 5, 1, 9] * 100])
    row, col = _first(score, np.ones(score.shape, bool), 3)
    assert (score[row, col] >= 9).all() and len(row) == 100


def test_bounds_leave_blocks_out(spark):
    rows = clustered(2000, 8, 3, spread=0.02)
    frame = spark.createDataFrame(rows, SCHEMA)
    taken = []
    real = hard_negatives.stored

    def watched(df, what):
        out = real(df, what)
        if what == "negatives-asked":
            taken.append(out.count())
        if what == "negatives-blocks":
            taken.append(out.count() * out.filter("length(anchors) > 0").count())
        return out

    hard_negatives.stored = watched
    try:
        got = mine(frame, F.col("vec_id") % 50 == 0, block_rows=80).count()
    finally:
        hard_negatives.stored = real
    every, positives, negatives = taken
    assert got and positives < 0.5 * every and negatives < 0.9 * every
