"""EXT-8 with a stored set of seen URLs that a round does not shuffle.

The set is a list of versions, each a table bucketed and sorted by URL, and one
Bloom filter over all of them: rows (part, words), a word of 64 bits for a
share of the URLs, four bits of it for each.  A round asks the filter first.
URLs with a bit missing are new; only possible repeats are dealt to the
buckets, where each version is read in place: no exchange of what was ever
seen.  A filter that has become too full lets more URLs through to the exact
step and changes no result.

Layout under ``root``: ``data/v=<n>``, then ``filter/v=<n>``, written last: a
version without it does not exist, and a rerun writes over it.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.operators.release import _files
from silverline.session import path_exists, stored

_FILTER = "part int, words array<bigint>, buckets int, parts int"


def _bits(parts: int, words: int) -> dict[str, Column]:
    """Where a URL's bits are: the part, the word in it, and the bits."""
    word = F.pmod(F.xxhash64(F.lit(1), "url"), F.lit(parts * words))
    mask = F.lit(0).cast("long")
    for i in range(4):
        at = F.shiftrightunsigned(F.xxhash64(F.lit(2), "url"), 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), at))
    return {"part": F.floor(word / words).cast("int"), "word": F.pmod(word, F.lit(words)).cast("int"), "mask": mask}


def versions(spark: SparkSession, root: str) -> list[int]:
    """The numbers of the versions, oldest first."""
    fs, path = _files(spark, root)
    folder = path(f"{root}/filter")
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(int(n[2:]) for n in names if n.startswith("v=") and path_exists(spark, f"{root}/filter/{n}/_SUCCESS"))


def _name(root: str, number: int) -> str:
    return f"seen_{hashlib.md5(root.encode()).hexdigest()[:16]}_{number}"


def _filter(spark: SparkSession, root: str, number: int) -> tuple[DataFrame, int, int, int]:
    """The filter of a version, and the buckets, parts and words of the set."""
    held = spark.read.schema(_FILTER).parquet(f"{root}/filter/v={number}")
    buckets, parts, words = held.select("buckets", "parts", F.size("words")).first()
    return held, buckets, parts, words


def _version(spark: SparkSession, root: str, number: int, buckets: int) -> DataFrame:
    """One version as a bucketed table, made known to the session's catalogue
    (as external: dropping it there leaves the files)."""
    name = _name(root, number)
    if not spark.catalog.tableExists(name):
        spark.sql(f"create table {name} (url string) using parquet clustered by (url) sorted by (url) into {buckets} buckets "
                  f"location '{root}/data/v={number}'")
    return spark.table(name)


def read(spark: SparkSession, root: str) -> DataFrame:
    """All URLs of the set."""
    found = versions(spark, root)
    paths = [f"{root}/data/v={n}" for n in found]
    return spark.read.schema("url string").parquet(*paths) if paths else spark.createDataFrame([], "url string")


def add(spark: SparkSession, root: str, urls: DataFrame, buckets: int = 64, parts: int = 16, words: int = 4096) -> int:
    """Add the column ``url`` of a frame to the set; the number of the new
    version.  Nulls are left out; URLs of the set may come again and are held
    twice.  The first call settles the sizes: ten bits a URL, that is
    ``parts * words`` of about a sixth of the URLs to come, keep the filter
    sharp, and ``words`` bounds a row of it."""
    known = versions(spark, root)
    number = known[-1] + 1 if known else 1
    before = None
    if known:
        before, buckets, parts, words = _filter(spark, root, known[-1])
    spark.sql(f"drop table if exists {_name(root, number)}")
    rows = urls.select("url").filter("url is not null").distinct()
    (rows.repartition(buckets, "url").write.bucketBy(buckets, "url").sortBy("url").mode("overwrite")
     .option("path", f"{root}/data/v={number}").saveAsTable(_name(root, number)))
    added = spark.read.schema("url string").parquet(f"{root}/data/v={number}").withColumns(_bits(parts, words)).select("part", "word", "mask")
    every = spark.range(parts * words).select(F.floor(F.col("id") / words).cast("int").alias("part"), F.pmod("id", F.lit(words)).cast("int").alias("word"), F.lit(0).cast("long").alias("mask"))
    bits = added.unionByName(every)
    if before is not None:
        bits = bits.unionByName(before.select("part", F.posexplode("words").alias("word", "mask")))
    # a word for all its URLs, then the words of a part in a row: their number is fixed
    merged = bits.groupBy("part", "word").agg(F.bit_or("mask").alias("mask"))
    packed = merged.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("word", "mask"))).alias("_w"))
    (packed.select("part", F.transform("_w", lambda x: x["mask"]).alias("words"), F.lit(buckets).alias("buckets"), F.lit(parts).alias("parts"))
     .write.mode("overwrite").parquet(f"{root}/filter/v={number}"))
    return number


def possible_repeats(spark: SparkSession, root: str, urls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new, possible repeats) among the rows of a frame with ``url``, by the filter alone."""
    known = versions(spark, root)
    if not known:
        return urls, urls.limit(0)
    held, _, parts, words = _filter(spark, root, known[-1])
    marked = urls.withColumns({f"_{k}": v for k, v in _bits(parts, words).items()})
    word = F.get("words", F.col("_word"))
    set_ = [F.col("_part") == F.col("part"), word.bitwiseAND(F.col("_mask")) == F.col("_mask")]
    held = held.select("part", "words")
    return tuple(marked.join(held, set_, how).select(*[F.col(f"`{c}`") for c in urls.columns]) for how in ("left_anti", "left_semi"))


def frontier_round(spark: SparkSession, root: str, found: DataFrame, url: str = "href") -> DataFrame:
    """One round: the distinct URLs of ``found`` that the set does not hold, as
    ``extract.frontier_round`` gives them; a null URL is never held."""
    urls = found.select(F.col(f"`{url}`").alias("url")).distinct()
    known = versions(spark, root)
    if not known:
        return urls
    urls = stored(urls, "found-urls")
    _, buckets, _, _ = _filter(spark, root, known[-1])
    new, repeats = possible_repeats(spark, root, urls)
    repeats = repeats.repartition(buckets, "url")
    for number in known:
        repeats = repeats.join(_version(spark, root, number, buckets), "url", "left_anti")
    return new.unionByName(repeats)
