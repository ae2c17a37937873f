"""Mixing sources to target weights by Sainte-Laguë apportionment (operator 12).

Every source gets a target number of words: the whole corpus size shared by
weight, where a target stops at ``repeats`` times its source's size and the
excess is shared again by weight.  Targets are met in blocks of ``block_words``
words: a source's seats are the highest quotients target / 1, / 3, / 5, ... over
all sources.  A source is dealt into shards of about ``shard_words`` words by a
keyed hash, and its seats go to its shards in the same way, by shard size: an
integer quota of blocks for each shard.  A shard lays its documents end to end
in the order of the keyed hash and is cut into n equal blocks (the last one may
be shorter).  A quota q takes every block q // n times, and q % n blocks once
more: block j if (j + turn) * (q % n) / n passes an integer, with a turn from
the keyed hash.  So what a document gives follows from its offset alone, and no
block is ever listed.

Highest quotients without a list of all seats: with S parties of total weight
W, all quotients of at least W / (2 seats - S) are seats and none below
W / (2 seats + S) is one, so only the at most 2 S quotients between are ranked.

At scale: sizes are counted in one pass over the texts and stored without them;
sources and shards are partial sums; a source that holds a third of all rows is
cut into bounded shards before any row is ordered.  Tables of one row per
source are ordered in one task, those of one row per shard in one task per
source (some 10 million words a row).

Defined cases: a null or empty text has size 0 and gives nothing; the null
source is a source of its own, ordered last; a source of size 0 has target 0;
equal quotients go to the source or shard that comes first; repeated rows count
one by one and rows of one id lie beside each other; an empty table gives an
empty plan.  Very long texts are one row with one offset.  Only the named
columns of the input are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverline.llm import common as C
from silverline.session import stored

#: Weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
MAX_BLOCK_WORDS = 4096
SHARD_WORDS = 1 << 20


def n_words(text: Column) -> Column:
    """Runs of characters other than space and \\x09-\\x0D; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0)).cast("long")


def targets(sources: DataFrame, repeats: int = 3) -> DataFrame:
    """``sources`` (size, weight, place) with ``target``: the sum of sizes
    shared by weight, stopped at ``repeats`` times the size, the excess shared
    again until no target is above."""
    full = F.col("size") * repeats
    # with the sources in the order of what fills up first, the first one that
    # need not stop fixes the level of all after it
    order = Window.orderBy(full / F.col("weight"), "place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((F.sum("size").over(everything) - F.coalesce(F.sum(full).over(before), F.lit(0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    found = sources.withColumn("_level", level)
    found = found.withColumn("_level", F.min(F.when(F.col("_level") * F.col("weight") <= full, F.struct(F.row_number().over(order), "_level")))
                             .over(everything)["_level"])
    return found.withColumn("target", F.least(full.cast("double"), F.coalesce(F.col("_level") * F.col("weight"), F.lit(0.0)))).drop("_level")


def apportion(parties: DataFrame, weight: str, seats: str, by: list[str], order: list[Column], name: str) -> DataFrame:
    """``parties`` with a column ``name``: the seats by Sainte-Laguë of each
    party, ``seats`` for each group ``by``.  Equal quotients go to the party
    that comes first in ``order``, which must tell a group's parties apart."""
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    some = F.col(weight) > 0
    w = F.col(weight).cast("double")
    sized = parties.withColumn("_parties", F.sum(some.cast("long")).over(group)).withColumn("_total", F.sum(w).over(group))
    sure = 2 * F.col(seats) - F.col("_parties")
    above = F.when(sure > 0, F.col("_total") / sure)

    def reaching(least: Column) -> Column:
        return F.when(some & (least > 0) & (w >= least), F.floor((w / least + 1) / 2)).otherwise(0).cast("long")

    # one quotient more on either side covers the rounding of the divisions
    sized = (sized.withColumn("_sure", F.greatest(F.coalesce(reaching(above), F.lit(0)) - 1, F.lit(0)).cast("long"))
             .withColumn("_most", F.when(some & (F.col(seats) > 0), reaching(F.col("_total") / (2 * F.col(seats) + F.col("_parties"))) + 1).otherwise(0)))
    sized = sized.withColumn("_left", F.col(seats) - F.sum("_sure").over(group))
    steps = F.when(F.col("_most") > F.col("_sure"), F.sequence(F.col("_sure"), F.col("_most") - 1))
    ranked = sized.withColumn("_step", F.explode_outer(steps))
    quotient = w / (2 * F.col("_step") + 1)
    ranked = ranked.withColumn("_rank", F.row_number().over(group.orderBy(quotient.desc_nulls_last(), *order, "_step")))
    won = (F.col("_step").isNotNull() & (F.col("_rank") <= F.col("_left"))).cast("long")
    kept = [c for c in parties.columns]
    return (ranked.groupBy(*kept, "_sure").agg(F.sum(won).alias("_won"))
            .select(*kept, (F.col("_sure") + F.col("_won")).alias(name)))


def plan_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights: tuple[int, ...] = WEIGHTS, repeats: int = 3, block_words: int | None = None,
             shard_words: int = SHARD_WORDS, seed: int = 12) -> DataFrame:
    """One row per document: id, source, size, source_size, target, taken and
    the columns ``from``, ``blocks``, ``quota``, ``turn``, ``block_words`` from
    which ``taken_spans`` lists what is taken.

    ``weights`` repeat over the sources in code point order.  ``block_words``
    None takes 1 / 200 of the smallest target that is not 0, between 1 and 4096."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))))
    sized = stored(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").cast("string").alias("source"),
                               n_words(F.col(f"`{text_col}`")).alias("size"), key.alias("key")), "mix-sizes")
    totals = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    cycle = F.array(*[F.lit(w) for w in weights])
    totals = totals.withColumn("place", place).withColumn("weight", F.get(cycle, (F.col("place") - 1) % len(weights)))
    goals = targets(totals, repeats)
    whole = Window.partitionBy(F.lit(0))
    block = F.lit(block_words) if block_words else F.greatest(F.lit(1), F.least(
        F.lit(MAX_BLOCK_WORDS), F.floor(F.min(F.when(F.col("target") > 0, F.col("target"))).over(whole) / 200)))
    goals = goals.withColumn("block_words", F.coalesce(block, F.lit(1)).cast("long"))
    goals = goals.withColumn("_all", F.floor(F.sum("size").over(whole) / F.col("block_words")))
    sources = apportion(goals, "target", "_all", [], [F.col("place")], "seats")
    sources = stored(sources.select("place", F.col("source").alias("_source"), F.col("size").alias("source_size"), "target", "block_words", "seats",
                                    F.ceil((F.col("size") + F.col("rows")) / shard_words).cast("long").alias("shards")), "mix-sources")

    dealt = (sized.join(sources, F.col("source").eqNullSafe(F.col("_source")))
             .withColumn("shard", F.conv(F.substring("key", 1, 8), 16, 10).cast("long") % F.col("shards")))
    shards = dealt.groupBy("place", "shard", "block_words", "seats").agg(F.sum("size").alias("words"))
    shards = shards.withColumn("blocks", F.ceil(F.col("words") / F.col("block_words")).cast("long"))
    shards = apportion(shards, "words", "seats", ["place"], [F.col("shard")], "quota")
    turn = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), "place", "shard")), 1, 8), 16, 10).cast("long")
    shards = stored(shards.select("place", "shard", "blocks", F.least("quota", F.col("blocks") * repeats).alias("quota"),
                                  F.when(F.col("blocks") > 0, turn % F.col("blocks")).otherwise(0).alias("turn")), "mix-shards")

    lie = Window.partitionBy("place", "shard").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    laid = dealt.withColumn("from", F.coalesce(F.sum("size").over(lie), F.lit(0)).cast("long"))
    laid = laid.join(shards, ["place", "shard"])
    passes = _whole(F.col("quota"), F.greatest("blocks", F.lit(1)))
    taken = (passes * F.col("size") + _once_more(F.col("from") + F.col("size")) - _once_more(F.col("from"))).cast("long")
    return laid.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", taken.alias("taken"),
                       "from", "blocks", "quota", "turn", "block_words")


def _whole(a: Column, b: Column) -> Column:
    """a // b for whole numbers that are not negative."""
    return F.call_function("div", a, b)


def _once_more(at: Column) -> Column:
    """Words before the offset ``at`` of a shard that the last, partial pass takes."""
    blocks, extra = F.greatest("blocks", F.lit(1)), F.col("quota") % F.greatest("blocks", F.lit(1))
    block = _whole(at, F.col("block_words"))

    def chosen(before: Column) -> Column:
        return _whole((before + F.col("turn")) * extra, blocks) - _whole(F.col("turn") * extra, blocks)

    return chosen(block) * F.col("block_words") + (chosen(block + 1) - chosen(block)) * (at - block * F.col("block_words"))


def taken_spans(plan: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, start, end, times): the runs of words of each document that lie in
    one block and are taken ``times`` > 0 times."""
    blocks = F.col("blocks")
    block = F.explode(F.when(F.col("size") > 0, F.sequence(
        _whole(F.col("from"), F.col("block_words")), _whole(F.col("from") + F.col("size") - 1, F.col("block_words")))))
    cut = plan.withColumn("_block", block)
    extra = F.col("quota") % blocks
    again = _whole((F.col("_block") + 1 + F.col("turn")) * extra, blocks) - _whole((F.col("_block") + F.col("turn")) * extra, blocks)
    start = F.greatest(F.col("_block") * F.col("block_words") - F.col("from"), F.lit(0))
    end = F.least((F.col("_block") + 1) * F.col("block_words") - F.col("from"), F.col("size"))
    return cut.select(F.col(f"`{id_col}`"), start.cast("long").alias("start"), end.cast("long").alias("end"),
                      (_whole(F.col("quota"), blocks) + again).cast("long").alias("times")).filter("times > 0")


def mixed_texts(docs: DataFrame, plan: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, part, text): the text of every taken run of words, one row for each
    time it is taken.  Needs ids that occur once; rows with a null id give nothing."""
    spans = taken_spans(plan, id_col).groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct("start", "end", "times"))).alias("spans"))
    texts = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").alias("text")).join(spans, id_col)
    C.prepared(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in C.byte_slices(batch, "text"):
                data, off = C.text_buffers(rows.column(1))
                start, end = C.word_spans(data, off)
                first = np.searchsorted(start, off)
                raw = data.tobytes()
                for i, spans in enumerate(rows.column(2).to_pylist()):
                    ids, parts, out = [], [], []
                    for k, s in enumerate(spans):
                        piece = raw[start[first[i] + s["start"]]:end[first[i] + s["end"] - 1]].decode()
                        for _ in range(s["times"]):
                            ids.append(i)
                            parts.append(k)
                            out.append(piece)
                    yield pa.RecordBatch.from_arrays([rows.column(0).take(pa.array(ids, pa.int64())), pa.array(parts, pa.int64()), pa.array(out, pa.string())],
                                                     names=["id", "part", "text"])

    kind = texts.schema[id_col].dataType.simpleString()
    return texts.mapInArrow(cut, f"id {kind}, part long, text string").withColumnRenamed("id", id_col)
