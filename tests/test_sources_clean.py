"""SRC-4..11, SNK-1..4, PRJ-2..14, FLT-12 with small files written here."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from silverline.operators import clean
from silverline.sources import io


def test_json_records_nested_path(spark, tmp_path):  # SRC-4 / SRC-5 / SRC-6
    doc = {"result": {"pageContext": {"coins": [
        {"name": "Foo", "algorithm": {"name": "SHA256", "type": "asic"}, "links": []},
        {"name": "Bar", "algorithm": None},
    ]}}}
    p = tmp_path / "page-data.json"
    p.write_text(json.dumps(doc))
    schema = StructType([StructField("result", StructType([StructField("pageContext", StructType([
        StructField("coins", __import__("pyspark.sql.types", fromlist=["ArrayType"]).ArrayType(StructType([
            StructField("name", StringType()),
            StructField("algorithm", StructType([StructField("name", StringType()), StructField("type", StringType())])),
        ])))]))]))])
    df = io.read_json_records(spark, str(p), schema=schema, record_path="result.pageContext.coins")
    got = sorted((r.name, r.algorithm.name if r.algorithm else None) for r in df.collect())
    assert got == [("Bar", None), ("Foo", "SHA256")]


def test_json_array_and_inference(spark, tmp_path):  # SRC-4 / SRC-7
    p = tmp_path / "algos.json"
    p.write_text(json.dumps([{"label": "SHA-256", "value": "sha256"}, {"label": "Scrypt", "value": "scrypt", "x": 1}]))
    df = io.read_json_records(spark, str(p), full_scan_inference=True)
    assert set(df.columns) == {"label", "value", "x"} and df.count() == 2


def test_csv_and_twins(spark, tmp_path):  # SRC-8 / SNK-1 / SNK-2
    df = spark.createDataFrame([(1, ["a", "b"]), (2, None)], "id int, tags array<string>")
    io.write_tables(df, str(tmp_path), "t")
    back = spark.read.parquet(str(tmp_path / "t.parquet"))
    assert back.count() == 2
    csv = io.read_csv(spark, str(tmp_path / "t.csv"), schema=StructType(
        [StructField("id", LongType()), StructField("tags", StringType())]))
    assert sorted((r.id, r.tags) for r in csv.collect()) == [(1, '["a","b"]'), (2, None)]


def test_read_pages_folder(spark, tmp_path):  # SRC-9 / SET-4
    d = tmp_path / "pages"
    d.mkdir()
    (d / "bitcoin.html").write_text("<title>Bitcoin</title>")
    (d / "litecoin.html").write_text("<title>Litecoin</title>")
    (d / "notes.txt").write_text("skip me")
    got = sorted((r.page_key, r.html) for r in io.read_pages(spark, str(d)).collect())
    assert got == [("bitcoin", "<title>Bitcoin</title>"), ("litecoin", "<title>Litecoin</title>")]


def test_ragged_keys(spark):  # SRC-10 / SRC-11
    df = spark.createDataFrame([({"algorithm": "SHA", "founded": "2009"},), ({"volume": "1"},)], "kv map<string,string>")
    out = df.select(*io.ragged_to_columns(F.col("kv"), ["algorithm", "volume"], prefix="reported_"), "kv")
    assert [tuple(r)[:2] for r in out.collect()] == [("SHA", None), (None, "1")]


def test_min_rows_guard(spark):  # FLT-12
    df = spark.range(10)
    assert io.require_min_rows(df, 10) is df
    with pytest.raises(ValueError):
        io.require_min_rows(df, 11)


def test_frame_helpers(spark):  # STR-3 frame-wide, PRJ-3..10, 13, 14
    df = spark.createDataFrame([(" a  b ", "None", 1, "2024-01-02 03:04:05")],
                               "`Coin Name` string, `Algo (main)` string, n int, ts string")
    df = df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    renamed = clean.rename_all(df)
    assert renamed.columns == ["coin_name", "algo_main", "n", "ts"]
    with pytest.raises(ValueError):
        clean.rename_all(spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int"))
    cleaned = clean.nullify_sentinels(clean.clean_strings(renamed), ["None"])
    assert tuple(cleaned.first())[:2] == ("a b", None)
    assert clean.datetimes_to_dates(cleaned).schema["ts"].dataType.simpleString() == "date"
    assert clean.rename_with_suffix(cleaned, ["coin_name", "nope"], "_url").columns[0] == "coin_name_url"
    with pytest.raises(KeyError):
        clean.drop_strict(cleaned, "nope")
    target = StructType([StructField("n", LongType()), StructField("coin_name", StringType()),
                         StructField("missing", LongType())])
    conf = clean.conform(cleaned.withColumn("n", F.lit("x")), target)
    assert conf.columns == ["n", "coin_name", "missing"] and tuple(conf.first()) == (None, "a b", None)
    like = clean.cast_like(spark.createDataFrame([("5",)], "n string"), cleaned)
    assert like.schema["n"].dataType.simpleString() == "int"


def test_stack_pins_types_per_part(spark):  # SET-1 / SET-3 / PRJ-9 trap: no silent widening or run-time cast failure
    from silverline.operators.stack import SourceSpec, stack, union_tagged
    target = StructType([StructField("site", StringType(), False), StructField("n", LongType(), True),
                         StructField("extra", StringType(), True)])
    a = spark.createDataFrame([(1,)], "v int")
    b = spark.createDataFrame([("12",), ("x",)], "v string")
    out = stack([SourceSpec(a, {"n": "v"}, {"site": "a"}), SourceSpec(b, {"n": "v"}, {"site": "b"})], target)
    assert out.schema == StructType([StructField("site", StringType(), True), StructField("n", LongType(), True),
                                     StructField("extra", StringType(), True)]) or \
        [f.dataType for f in out.schema.fields] == [StringType(), LongType(), StringType()]
    assert sorted((tuple(r) for r in out.collect()), key=repr) == sorted(
        [("a", 1, None), ("b", 12, None), ("b", None, None)], key=repr)
    with pytest.raises(KeyError):
        stack([SourceSpec(a, {"nope": "v"})], target)
    tagged = union_tagged({"x": a, "y": a}, "src")
    assert sorted(r.src for r in tagged.collect()) == ["x", "y"]
