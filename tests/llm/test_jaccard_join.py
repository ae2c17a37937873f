import random

import pytest

from silverline.llm.components import components
from silverline.llm.jaccard_join import drop_near_copies, near_classes
from tests.llm.brute import near_classes as brute


def corpus(seed=5):
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(3000)]
    docs = []
    for _ in range(40):
        base = rnd.choices(vocabulary, k=rnd.choice([6, 30, 120, 400]))
        docs.append(" ".join(base))
        for _ in range(rnd.randint(0, 4)):
            near = list(base)
            for _ in range(rnd.choice([0, 1, 1, 2, 6])):
                near[rnd.randrange(len(near))] = rnd.choice(vocabulary)
            docs.append(" ".join(near))
    shared = " ".join(rnd.choices(vocabulary, k=60))  # one passage that many share
    docs += [f"{shared} {' '.join(rnd.choices(vocabulary, k=60))}" for _ in range(40)]
    base = rnd.choices(vocabulary, k=200)  # one large group of near copies
    docs += [" ".join([*base[:k], "changed", *base[k + 1:]]) for k in range(60)]
    docs += [docs[0]] * 30 + [docs[0].upper(), docs[0].replace(" ", ",\n")]
    rnd.shuffle(docs)
    return list(enumerate(docs))


def got(df, **options):
    return {r.doc_id: (r.class_id, r.copy_of, r.n_links) for r in near_classes(df, **options).collect()}


@pytest.mark.parametrize("options", [{}, {"bucket": 8, "block_rows": 7}])
def test_against_brute_force(spark, options):
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert got(df, **options) == brute(docs)


def test_edges(spark):
    docs = [(1, None), (2, ""), (3, ""), (4, "..."), (5, "one two"), (6, "One, two!"), (7, "one two three"), (8, "a b c d e"), (9, "a b c d e"),
            (10, "x " * 40_000), (11, "x " * 50_000), (12, "one two")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert got(df) == brute(docs)
    assert got(df)[6] == (5, 6, 1) and got(df)[3] == (3, 3, 0) and got(df)[11] == (10, 11, 1)
    kept = sorted(r.doc_id for r in drop_near_copies(df).collect())
    assert kept == [1, 2, 3, 4, 5, 7, 8, 10]


def test_empty_table_null_ids_and_clashing_columns(spark):
    assert near_classes(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    df = spark.createDataFrame([(None, "a b c d e f", 1, 2), (3, "a b c d e f", 1, 2), (3, "a b c d e f", 1, 2)], "doc_id long, text string, key int, Class_Id int")
    rows = near_classes(df).collect()
    assert len(rows) == 3 and {(r.class_id, r.copy_of, r.n_links, r.key) for r in rows} == {(3, 3, 0, 1)}


def test_components_of_a_long_path_and_a_star(spark):
    links = [(k, k + 1) for k in range(100, 160)] + [(5, k) for k in range(6, 60)] + [(300, 300)]
    found = {(r.node, r.root) for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {(k, 100) for k in range(100, 161)} | {(k, 5) for k in range(5, 60)}


def test_sketches_keep_pairs_at_the_threshold(spark):
    """Pairs at 0.8 of which few sketch bytes agree are linked as well."""
    import random

    import numpy as np
    import pyarrow as pa

    from silverline.llm import common as C
    from silverline.llm import jaccard_join as J

    rnd = random.Random(5)
    word = lambda: "".join(rnd.choices("abcdefghijklmnop", k=7))
    pairs = []
    for _ in range(6000):
        words = [word() for _ in range(40)]
        pairs.append((" ".join(words + [word() for _ in range(4)]), " ".join(words + [word() for _ in range(5)])))  # 36 of 45 shingles
    texts = pa.array([t for p in pairs for t in p])
    _, least = J.minhashes(*J.shingles(*C.text_buffers(texts)))
    small = C.mix(least) & np.uint64(0xFF)
    agree = (small[::2] == small[1::2]).sum(1)
    hard = [p for p, n in zip(pairs, agree) if 38 <= n < 41]
    assert len(hard) >= 2
    df = spark.createDataFrame([(10 * i + k, t) for i, p in enumerate(hard) for k, t in enumerate(p)], "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in J.near_classes(df).collect()} == {10 * i + k: 10 * i for i in range(len(hard)) for k in (0, 1)}


def test_runs_and_sketch_share_the_recall():
    from silverline.llm.jaccard_join import _runs_and_needed

    assert _runs_and_needed(0.8, 0.9999) == (7, 38)
