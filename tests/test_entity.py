"""ENT-1..3 (names, aliases, canonical spellings, collisions)."""

import pytest
from pyspark.sql import functions as F

from silverline.operators import entity

# our own pairs, one per category of the reference's test: bare name kept,
# blank -> dash, case + blank -> dash (then alias), unrelated untouched,
# "A b,c" -> "A(b,c)", "A b_c" -> "A(b,c)", odd capitals, odd capitals + digits
ALGO_PAIRS = [
    ("CryptoNight", "CryptoNight"),
    ("CryptoNight Heavy", "CryptoNight-Heavy"),
    ("cryptonight lite", "CryptoNight-Lite"),
    ("Scrypt", "Scrypt"),
    ("Equihash 144,5", "Equihash(144,5)"),
    ("equihash 192_7", "Equihash(192,7)"),
    ("cUcKaToO", "Cuckatoo"),
    ("CUCKATOO31", "Cuckatoo31"),
]


def test_normalize_algorithm_names(spark):
    df = spark.createDataFrame(ALGO_PAIRS + [(None, None)], "input string, expected string")
    out = df.select(entity.normalize_names(F.col("input")).eqNullSafe(F.col("expected")).alias("ok"), "input",
                    entity.normalize_names(F.col("input")).alias("got"))
    bad = [(r.input, r.got) for r in out.collect() if not r.ok]
    assert bad == []


def test_alias_table_duplicates_are_deduped():
    m = entity.alias_mapping(entity.ALGORITHM_ALIASES)
    assert m["NexaPow"] == "NexaPoW"
    assert len(m) == len(set(m))
    with pytest.raises(ValueError):
        entity.alias_mapping({"A": ["x"], "B": ["x"]})


def test_normalize_with_alias_table_frame(spark):
    aliases = spark.createDataFrame([("SHA256", "SHA-256"), ("SHA256", "SHA-256"), ("Kaw Pow", "KawPow")],
                                    "alias string, standard string")
    df = spark.createDataFrame([(1, "SHA256"), (2, "kaw pow"), (3, "Kaw Pow"), (4, None)], "id int, n string")
    got = {r.id: r.out for r in entity.normalize_names_table(df, "n", "out", aliases).collect()}
    assert got == {1: "SHA-256", 2: "kaw pow", 3: "KawPow", 4: None}


SPELLINGS = ["Bit-Coin", "bitcoin", "Bitcoin", "比特币", "以太坊", None]


def test_canonical_names_keep(spark):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(SPELLINGS)], "i int, name string")
    got = {r.i: r.canonical_name for r in entity.canonical_names(df, "name").collect()}
    assert got == {0: "Bit-Coin", 1: "Bit-Coin", 2: "Bit-Coin", 3: "比特币", 4: "以太坊", 5: None}


def test_canonical_names_merge_and_empty(spark):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(SPELLINGS)], "i int, name string")
    got = {r.i: r.canonical_name for r in entity.canonical_names(df, "name", on_empty_key="merge").collect()}
    assert got[3] == got[4] == min("比特币", "以太坊")  # the reference's merge under key ""
    with_empty = spark.createDataFrame([(i, n) for i, n in enumerate(SPELLINGS + [""])], "i int, name string")
    got2 = {r.i: r.canonical_name for r in entity.canonical_names(with_empty, "name", on_empty_key="merge").collect()}
    assert got2[3] == "比特币" and got2[4] == "以太坊" and got2[6] == ""


def test_canonical_mapping_covers_every_input_once(spark):  # DQ-12
    df = spark.createDataFrame([(i, n) for i, n in enumerate(SPELLINGS * 3)], "i int, name string")
    out = entity.canonical_names(df, "name")
    assert out.count() == df.count()
    per_name = out.groupBy("name").agg(F.countDistinct("canonical_name").alias("k")).filter("k > 1")
    assert per_name.count() == 0


def test_alias_opportunities(spark):
    df = spark.createDataFrame([(n,) for n in ["SHA-256", "sha256", "SHA-256", "Scrypt", None]], "name string")
    got = [tuple(r) for r in entity.alias_opportunities(df, "name").collect()]
    assert got == [("sha256", '["SHA-256","sha256"]', 2)]


def test_alias_opportunities_skip_empty_key(spark):
    df = spark.createDataFrame([(n,) for n in ["比特币", "以太坊", "Bit-Coin", "bitcoin"]], "name string")
    assert [r.name_key for r in entity.alias_opportunities(df, "name", skip_empty_key=True).collect()] == ["bitcoin"]
    assert sorted(r.name_key for r in entity.alias_opportunities(df, "name").collect()) == ["", "bitcoin"]
    long = {(r.name_key, r.name, r.n_names) for r in entity.alias_collisions(df, "name").collect()}
    assert long == {("", "比特币", 2), ("", "以太坊", 2), ("bitcoin", "Bit-Coin", 2), ("bitcoin", "bitcoin", 2)}


def test_alias_lists_grow_in_number_not_in_length(spark):
    import json

    df = spark.range(5000).selectExpr("concat('名', repeat('字', cast(id as int) % 50 + 1), repeat('号', cast(id as int) div 50)) as name")
    rows = entity.alias_opportunities(df, "name").collect()
    lists = [json.loads(r.names_json) for r in rows]
    assert {(r.name_key, r.n_names) for r in rows} == {("", 5000)}
    assert max(map(len, lists)) < 1500 and all(x == sorted(x) for x in lists)
    assert sorted(n for x in lists for n in x) == sorted(r.name for r in df.collect())
