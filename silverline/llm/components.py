"""Connected components of a link table by alternating large-star and
small-star steps; nothing but two figures a round reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.llm import common as C


def _large_star(links: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours the least node it knows."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours hang on the least of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    hung = links.join(least, "a")
    return (hung.filter(F.col("b") > F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b"))).distinct())


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b); the root is the least
    node of the component and is listed under itself.

    The rounds grow with the logarithm of a component's diameter.  A node with
    very many links makes a skewed join, which AQE splits."""
    links = links.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links, before = C.stored(links, "links"), None
    while True:
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % (1 << 40))).first()
        if now == before:
            break
        before = now
        # stored between the steps: either step reads its input twice
        links = C.stored(_small_star(C.stored(_large_star(links), "links")), "links")
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
