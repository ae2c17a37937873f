import random

from pyspark.sql import functions as F

from silverline.llm.line_dedup import dedup_lines
from tests.llm.brute import line_dedup


def check(spark, docs, **options):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in dedup_lines(df, **options).collect()), key=str)
    assert got == sorted(line_dedup(docs), key=str)


def test_against_brute_force_with_any_filter_size(spark):
    rnd = random.Random(4)
    pool = [f"Line number {k} with {'Ü' * (k % 5)} enough text" for k in range(40)]
    docs = [(i, "\n".join(rnd.choice(["", " ", "\t"]) + (x.upper() if rnd.random() < 0.2 else x) + rnd.choice(["", " \r"])
                          for x in rnd.choices(pool + ["short", ""], k=rnd.randint(0, 9)))) for i in range(60)]
    check(spark, docs)
    check(spark, docs, max_filter_bits=64)  # a full filter only lets more through


def test_edges(spark):
    line = "x" * 19 + "Y"
    docs = [(1, None), (2, ""), (3, line), (4, f"{line}\n\n{line.lower()}"), (5, f" {line}\x0b\n" + "z" * 19), (None, line), (6, "\n" * 3)]
    check(spark, docs)
    # a document that repeats a line alone, and rows that share an id, are one document
    check(spark, [(1, f"{line}\n{line}\n{line}"), (2, line), (2, line + "\nother"), (2, line)])
    check(spark, [(1, "é" * 19 + "\n" + "é" * 20), (2, "é" * 20), (3, "é" * 20 + "\n" + "é" * 19)])


def test_one_line_in_most_documents_and_a_long_text(spark):
    hot = "the line that nearly every document holds"
    docs = [(i, f"{hot}\nown line of document number {i}") for i in range(300)] + [(999, "\n".join([hot] * 3000 + ["w" * 200_000]))]
    check(spark, docs)


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert dedup_lines(empty).collect() == []
    df = spark.createDataFrame([(1, "a", 7, "id")], "doc_id long, text string, N_Lines long, _lost_id string")
    row = dedup_lines(df.withColumn("key", F.lit(3))).first()
    assert row.asDict() == {"doc_id": 1, "text": "a", "_lost_id": "id", "key": 3, "n_lines": 1, "n_dropped": 0}
