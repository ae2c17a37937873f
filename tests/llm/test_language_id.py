import math
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from silverline.llm.language_id import ORDER, Model, fold, identify, learn
from silverline.sources.tables import table


def brute_bits(text: bytes, statistics, lang: int) -> float:
    """Code length by walking the context tree, one byte at a time."""
    keys, n = statistics.counts[lang]
    counts: list[dict] = [{} for _ in range(ORDER + 1)]
    for key, c in zip(keys.tolist(), n.tolist()):
        s = [(key >> (8 * k)) & 255 for k in range(ORDER, -1, -1)]
        for order in range(ORDER + 1):
            tree = counts[order].setdefault(tuple(s[ORDER - order:ORDER]), {})
            tree[s[-1]] = tree.get(s[-1], 0) + c
    syms = [10] * ORDER + [b + 32 if 65 <= b <= 90 else b for b in text]
    bits = 0.0
    for i in range(ORDER, len(syms)):
        for order in range(ORDER, -1, -1):
            tree = counts[order].get(tuple(syms[i - order:i]), {})
            total, kinds = sum(tree.values()), len(tree)
            if syms[i] in tree:
                bits -= math.log2(tree[syms[i]] / (total + kinds))
                break
            if tree:
                bits -= math.log2(kinds / (total + kinds))
        else:
            bits += 8
    return bits


def labelled(spark):
    rnd = random.Random(1)
    make = lambda pool: " ".join("".join(rnd.choices(pool, k=rnd.randint(1, 4))) for _ in range(rnd.randint(3, 40)))
    pools = {"aa": ["the", "ing", "er", "on", "Th"], "bb": ["ción", "que", "la", "os"], "cc": ["keit", "ung", "ü", "sch", "er"]}
    return spark.createDataFrame([(i, make(pools[lang]), lang) for i, lang in enumerate(list(pools) * 60)], "doc_id long, text string, lang string")


def test_code_lengths_equal_a_walk_of_the_tree(spark):
    statistics = learn(labelled(spark))
    assert statistics.languages == ["aa", "bb", "cc"]
    model = Model(statistics)
    texts = ["", "the ing", "Queción la", "ünchkeit 12 zz", "日本 the\n\n", "x" * 500, "THE ing on"]
    data = pa.array(texts)
    from silverline.llm.common import text_buffers
    got = model.code_lengths(*text_buffers(data))
    want = [[brute_bits(t.encode(), statistics, k) for k in range(3)] for t in texts]
    assert np.allclose(got, want, rtol=1e-5, atol=1e-3)


def test_held_out_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    statistics = learn(docs.filter(fold(F.col("doc_id")) != 2))
    held = identify(docs.filter(fold(F.col("doc_id")) == 2), statistics)
    right, n = held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count(F.lit(1))).first()
    assert n > 200 and right > 0.98


def test_edges(spark):
    statistics = learn(labelled(spark))
    rows = [(1, None, 4), (2, "", 4), (3, "12 !? \n", 4), (4, "é", 4), (5, "the ing er on " * 20_000, 4), (6, "la que os ción", 4), (6, "la que os ción", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, Score int").withColumn("has_letter", F.lit("x"))
    found = [(r.doc_id, r.lang_pred, r.score) for r in identify(df, statistics).collect()]
    assert [x[1:] for x in found[:3]] == [("und", 0.0)] * 3
    assert found[4][1] == "aa" and found[5] == found[6] and found[5][1] == "bb" and all(0 <= x[2] <= 1 for x in found)
    assert identify(df.limit(0), statistics).collect() == []
    nothing = learn(df.limit(0).select("text", F.lit("aa").alias("lang")))
    assert {(r.lang_pred, r.score) for r in identify(df, nothing).collect()} == {("und", 0.0)}
    # unlabelled rows and rows without a letter teach nothing
    assert learn(spark.createDataFrame([("abc", None), (None, "aa"), ("1", "aa")], "text string, lang string")).languages == []


def test_sample_is_filled_from_distinct_texts(spark):
    """Copies and long texts take nothing away from a language's sample."""
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choices("abcdefgh", k=6))
    copies = spark.range(3000).selectExpr("repeat('copy of one text ', 60) as text", "'aa' as lang")
    other = [(" ".join(word() for _ in range(15)), "aa") for _ in range(400)]
    long = [("é" * 5001 + word() * 5000, "bb") for _ in range(5)]
    few = [("short text", "cc")] * 3
    statistics = learn(copies.unionByName(spark.createDataFrame(other + long + few, "text string, lang string")), sample_bytes=5001)
    assert statistics.languages == ["aa", "bb", "cc"]
    # each byte of the sample is one four-gram; no character is cut
    assert [int(n.sum()) for _, n in statistics.counts] == [5001, 5000, 10]
    assert len(statistics.counts[0][0]) > 1000  # not one text alone


def test_other_scripts_take_nothing_from_latin_languages(spark):
    """Three Latin languages keep their accuracy beside eleven other scripts, and their code lengths to the bit."""
    rnd = random.Random(4)
    latin = {"l1": "etaoinshrdlu", "l2": "aeioumnsrtlq", "l3": "enrtsihdagul"}
    starts = dict(zip("cyr gre arm heb ara dev tha geo han kan hang".split(), (0x430, 0x3B1, 0x561, 0x5D0, 0x627, 0x905, 0xE01, 0x10D0, 0x4E00, 0x30A1, 0xAC00)))
    pools = {k: [a + b for a in v for b in v[::3]] for k, v in latin.items()} | {k: [chr(c + i) + chr(c + j) for i in range(20) for j in range(0, 20, 4)] for k, c in starts.items()}
    words = {k: ["".join(rnd.choices(p, k=rnd.randint(1, 3))) for _ in range(300)] for k, p in pools.items()}
    rows = [(" ".join(rnd.choices(words[k], k=12)), k) for k in pools for _ in range(80)]
    frame = spark.createDataFrame(rows, "text string, lang string")
    everything, alone = learn(frame), learn(frame.filter("lang like 'l_'"))
    assert len(everything.languages) == 14
    held = [(" ".join(rnd.choices(words[k], k=10)), k) for k in pools for _ in range(60)]
    found = identify(spark.createDataFrame(held, "text string, lang string"), everything).collect()
    assert np.mean([r.lang == r.lang_pred for r in found if r.lang in latin]) >= 0.98
    assert np.mean([r.lang == r.lang_pred for r in found]) >= 0.98
    from silverline.llm.common import text_buffers
    texts = text_buffers(pa.array([t for t, _ in held]))
    at = [everything.languages.index(k) for k in alone.languages]
    assert np.allclose(Model(everything).code_lengths(*texts)[:, at], Model(alone).code_lengths(*texts))


def test_stray_labels_can_be_left_out(spark):
    df = labelled(spark).unionByName(spark.createDataFrame([(1000 + i, f"stray {i}", f"x{i}") for i in range(40)], "doc_id long, text string, lang string"))
    assert learn(df, min_texts=2).languages == ["aa", "bb", "cc"] and len(learn(df).languages) == 43
