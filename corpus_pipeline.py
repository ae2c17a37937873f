"""The corpus pipeline: five stages over ``documents``.

Every stage takes (spark, docs, sf_dir) and works on all that the one before
kept; ``run`` writes each stage's rows as Parquet into the shared folder of
``spark.checkpoint.dir`` and reads them again as the next one's docs.

In every stage: an empty table gives an empty table; repeated rows are judged
alike; a null in any column but ``text`` and ``doc_id`` means nothing and stays;
other columns, whatever their names, pass through all stages but the last.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.llm.decontaminate import decontaminate
from silverline.llm.jaccard_join import drop_near_copies
from silverline.llm.language_id import UNKNOWN, fold, identify, learn
from silverline.llm.line_dedup import dedup_lines
from silverline.llm.sentence_pieces import encode_pieces
from silverline.session import stored
from silverline.sources.tables import table

#: Below this share of the likelihood no learned language is clearly the best.
MIN_SCORE = 0.5


#: The columns that stages read; all others are out of the operators' way.
READ = ("doc_id", "text", "lang", "n_chars")


def _apart(docs: DataFrame, operate: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``docs`` after an operator, which sees the other columns under names
    that clash with none of its own; the columns and their names stay."""
    names = [c if c in READ else f"column {i}" for i, c in enumerate(docs.columns)]
    return operate(docs.toDF(*names)).select(*[F.col(f"`{c}`") for c in names]).toDF(*docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; those without a letter (null and empty
    texts too), or without a clear language, go.  Learns from the documents
    outside fold 2 that have an id and a language; where there are none, all go.
    Languages that score alike share the likelihood, so a tie is no clear one."""
    statistics = learn(docs.filter(fold(F.col("doc_id")) != 2).select("text", "lang"))
    clear = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= MIN_SCORE)
    return _apart(docs, lambda rows: identify(rows, statistics).filter(clear))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat across documents; ``n_chars``
    follows the text.  A null text becomes empty.  A line stays in the largest
    id that holds it, so in all rows of that id; a null id comes before all others."""
    return _apart(docs, lambda rows: dedup_lines(rows).withColumn("n_chars", F.length("text").cast("long")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the least id, and all rows
    of that id and class.  Texts without a word are like no other; a null id comes last."""
    return _apart(docs, drop_near_copies)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.  Null and empty texts hold none;
    items without a word are in no document."""
    return _apart(docs, lambda rows: decontaminate(rows, table(spark, sf_dir, "benchmark")))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces, with merge-dropout, and whether they decode to
    its text.  A null text has no pieces and is decoded to the empty text; rows
    with one id draw alike.  Other columns end here."""
    coded = encode_pieces(docs.select("doc_id", "text", "lang", "source", "n_chars"), public_tokenizers.path("piece_bpe_32k.model"), verify=True)
    return coded.select("doc_id", "lang", "source", "n_chars", F.size("ids").cast("long").alias("n_pieces"), "ids", "lossless")


STAGES = [
    ("language ID", language),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark),
    ("SentencePiece encoding and decoding", pieces),
]

#: SQL expresses neither the context trees nor the segmentation; tests/llm
#: holds the result against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.lower().replace(" ", "-"))
    return docs
