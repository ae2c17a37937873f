import random

import numpy as np

from silverline.llm.decontaminate import best_match, best_matches, decontaminate, find_leaks
from tests.llm.brute import best_edits, leaks


def test_bit_parallel_distance():
    rnd = random.Random(0)
    for _ in range(1500):
        p = [rnd.randint(0, 5) for _ in range(rnd.choice([1, 3, 9, 70]))]
        t = [rnd.randint(0, 5) for _ in range(rnd.randint(0, 25))]
        assert best_match(p, t)[0] == best_edits(p, t)


def found(df, items, **options):
    return {r.doc_id: [(x["item"], x["distance"]) for x in r.leaks] for r in find_leaks(df, items, **options).collect()}


def test_against_brute_force_with_any_filter(spark):
    rnd = random.Random(1)
    vocabulary = [f"Wörd{k}" for k in range(60)]
    items = [(k, " ".join(rnd.choices(vocabulary, k=rnd.choice([1, 4, 5, 12, 40])))) for k in range(30)] + [(97, None), (98, ""), (99, "!?")]
    docs = [(1000, None), (1001, ""), (1002, "!")]
    for i in range(150):
        text = rnd.choices(vocabulary, k=rnd.randint(0, 30))
        if rnd.random() < 0.7:
            passage = items[rnd.randrange(30)][1].split()
            for _ in range(rnd.randint(0, 5)):
                at = rnd.randrange(len(passage))
                passage[at:at + rnd.randint(0, 1)] = rnd.choices(vocabulary, k=rnd.randint(0, 1))
                passage = passage or ["x"]
            text[3:3] = passage
        docs.append((i, rnd.choice([" ", ", ", "\n"]).join(text).upper() if i % 3 else " ".join(text)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    table = spark.createDataFrame(items, "item_id long, text string")
    want = {i: leaks(t, items) for i, t in docs}
    assert found(df, table) == want
    assert found(df, table, filter_bits=64) == want
    clean = sorted(r.doc_id for r in decontaminate(df, table).collect())
    assert clean == sorted(i for i, x in want.items() if not x)


def test_edges(spark):
    items = spark.createDataFrame([("a", "one two three four five six seven eight nine ten")] * 2, "item_id string, text string")
    df = spark.createDataFrame([(1, "x" * 300_000 + " one two three four FIVE six seven eight nine ten", 5), (1, "one two three", 6)], "doc_id long, text string, Leaks int")
    rows = find_leaks(df, items).collect()
    assert sorted(len(r.leaks) for r in rows) == [0, 2] and len(df.columns) == len(rows[0])
    assert find_leaks(df.limit(0), items).collect() == []
    assert [r.leaks for r in find_leaks(df, items.limit(0)).collect()] == [[], []]


def test_long_patterns_and_many_pairs_at_once():
    rnd = random.Random(3)
    p = [[rnd.randint(0, 3) for _ in range(rnd.choice([1, 63, 64, 65, 130]))] for _ in range(60)]
    t = [[rnd.randint(0, 3) for _ in range(rnd.randint(0, 90))] for _ in p]
    best, _ = best_matches([np.array(x, np.uint64) for x in p], [np.array(x, np.uint64) for x in t])
    assert best.tolist() == [best_edits(x, y) for x, y in zip(p, t)]


def test_ids_of_any_type_and_clashing_names(spark):
    words = "one two three four five six seven eight nine ten"
    df = spark.createDataFrame([(1, f"so {words} end", 2, 3, 4), (1, f"so {words} end", 2, 3, 4), (2, "none", 2, 3, 4)], "doc_id long, text string, k1 int, item int, words int")
    for kind in ("smallint", "decimal(9,2)", "date"):
        value = "date'2024-01-02'" if kind == "date" else f"cast(7 as {kind})"
        items = spark.sql(f"select {value} as item_id, '{words}' as text")
        rows = find_leaks(df, items).orderBy("doc_id").collect()
        assert [[x.distance for x in r.leaks] for r in rows] == [[0], [0], []] and rows[0].leaks[0].item == items.first().item_id
        assert rows[0].__fields__ == [*df.columns, "leaks"]


def test_one_python_stage_reads_the_documents(spark):
    items = spark.range(300).selectExpr("id as item_id", "concat('w', id, ' x', id, ' y', id, ' z', id, ' u', id, ' v', id) as text")
    docs = spark.range(50).selectExpr("id as doc_id", "concat('a w', id, ' x', id, ' y', id, ' z', id, ' u', id, ' v', id, ' b') as text")
    out = find_leaks(docs, items)
    assert out.filter("size(leaks) = 1 and leaks[0].item = doc_id").count() == 50
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") <= 1
