"""URL filter from a path-template tree with labelled purity (operator 7).

All of it is DataFrame expressions and aggregates.

1. Rules (host, path) label the URLs that they fit; the longest rule wins.
2. Per host, the paths form a tree.  Segments that are variable by their look
   (numbers, dates, hex strings, long slugs) are wildcards from the start; then,
   from the root down, a node with many children and few URLs for each turns its
   children into one wildcard, and what lies below them merges.  All levels are
   counted in one pass by hashes of the segments above; each path widens its
   topmost such node, as those below count anew once they have merged.  So the
   passes follow the most wildcards on a path, not its length.
3. From the host's root to each template, a branch whose share of blocked
   labels is statistically like its parent's is merged into it (takes the
   parent's estimate); another takes its own share, smoothed towards the
   parent's.  The root starts from the share in all labels.  A branch of fewer
   than ``min_labels`` labelled URLs is not split, at any level: one ``**``
   stands for what lies below.
4. A template whose smoothed share of blocked labels reaches ``reject`` is
   blocked.  A rule's own verdict always holds for the URLs that it fits.

Counting is partial before each shuffle, so a host with a third of all rows
costs one row per task and path; the join back is a plain equi-join, whose
skewed partitions AQE splits.

Defined cases: a null URL, or one without ``://``, has an empty host and path
and fits no rule unless the rule's host and path are empty; such rows share the
empty host's root template.  Equal rows are judged equally; rules of equal
length rank in the order given.  An empty table gives no rows.  Columns of the
input named as the results are replaced.  A very long URL is work in proportion
to its length (to its square in the number of segments, for the hashes above
them, of 64 bits per host and level).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverline.llm import common as C

#: (verdict, host, path); paths start with a slash.
Rule = tuple[str, str, str]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Looks of variable segments, first match wins; an extension stays.
LOOKS = (
    (r"^[0-9]+$", "{n}"),
    (r"^[0-9]{4}-[0-9]{2}(-[0-9]{2})?$", "{date}"),
    (r"^(?=.*[0-9])[0-9a-fA-F-]{8,}$", "{hex}"),
)
#: Parts that make a segment a slug.
SLUG_PARTS = 4
_EXTENSION = r"\.[a-zA-Z]{1,5}$"


def url_host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Position of the longest rule that fits, or null."""
    found = F.lit(None).cast("int")
    for i, (_, rule_host, rule_path) in sorted(enumerate(rules), key=lambda x: (len(x[1][1] + x[1][2]), -x[0])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found = F.when(fits, F.lit(i)).otherwise(found)
    return found


def segment_look(segment: Column) -> Column:
    extension = F.regexp_extract(segment, _EXTENSION, 0)
    base = F.substr(segment, F.lit(1), F.length(segment) - F.length(extension))
    # at least so many parts between hyphens or underscores, none empty, no dot
    slug = ((F.length(base) - F.length(F.translate(base, "-_", "")) >= SLUG_PARTS - 1) & ~base.rlike(r"\.|^[-_]|[-_][-_]|[-_]$"))
    out = F.when(slug, F.concat(F.lit("{slug}"), extension)).otherwise(segment)
    for pattern, name in reversed(LOOKS):
        out = F.when(base.rlike(pattern), F.concat(F.lit(name), extension)).otherwise(out)
    return out


def template_segments(path: Column) -> Column:
    """The path's segments by their look."""
    return F.transform(F.split(F.regexp_replace(path, "^/", ""), "/", -1), segment_look)


def _nodes(paths: DataFrame, *kept: str) -> DataFrame:
    """(kept..., level, above, seg): the tree's node at every level of each
    path, as a hash of the segments above, and the segment that follows (NULL
    at the path's end)."""
    start = F.array(F.lit(0).cast("long"))
    above = F.aggregate("segs", start, lambda seen, seg: F.array_append(seen, F.xxhash64(F.element_at(seen, -1), seg)))
    return (paths.select(*kept, "segs", F.posexplode(above).alias("level", "above"))
            .select(*kept, "level", "above", F.get("segs", F.col("level")).alias("seg")))


def _widened(paths: DataFrame, min_children: int, max_mean: float) -> DataFrame:
    """One pass over all levels: every path's topmost node with many children
    and few URLs for each gets a wildcard; ``again`` where there was one."""
    nodes = _nodes(paths, "host", "look", "n").filter("seg is not null")
    kids = nodes.groupBy("host", "level", "above", "seg").agg(F.sum("n").alias("n"))
    # a wildcard child stands for what is merged already
    wide = (kids.groupBy("host", "level", "above").agg(F.count(F.lit(1)).alias("kids"), F.sum("n").alias("n"))
            .filter((F.col("kids") >= min_children) & (F.col("n") <= F.col("kids") * max_mean)).select("host", "level", "above"))
    topmost = nodes.select("host", "look", "level", "above").join(wide, ["host", "level", "above"]).groupBy("host", "look").agg(F.min("level").alias("at"))
    found = paths.drop("again").join(topmost, ["host", "look"], "left")
    return found.withColumn("segs", F.when(F.col("at").isNull(), F.col("segs")).otherwise(
        F.transform("segs", lambda seg, i: F.when(i == F.col("at"), "*").otherwise(seg)))).withColumn("again", F.col("at").isNotNull()).drop("at")


def template_shares(paths: DataFrame, prior: float, min_labels: int, strength: float, z: float) -> DataFrame:
    """(host, look, template, share): the estimated share of blocked labels of each path's template."""
    leaves = paths.withColumn("full", F.array_join("segs", "/")).groupBy("host", "full").agg(
        F.first("segs").alias("segs"), F.sum("blocked").alias("blocked"), F.sum("labelled").alias("labelled"))
    places = _nodes(leaves, "host", "full", "blocked", "labelled")
    counts = places.groupBy("host", "level", "above").agg(F.sum("blocked").alias("b"), F.sum("labelled").alias("l"))
    chain = (places.select("host", "full", "level", "above").join(counts, ["host", "level", "above"])
             .groupBy("host", "full").agg(F.sort_array(F.collect_list(F.struct("level", "b", "l"))).alias("chain")))

    def step(state: Column, x: Column) -> Column:
        share, n = state["share"], x["l"].cast("double")
        own = (x["b"] + strength * share) / (n + strength)
        # within z standard errors of the parent, with one label's worth of slack for tiny counts
        like = F.abs(x["b"] - n * share) <= z * F.sqrt(n * share * (1 - share)) + 0.5
        return F.struct(F.when(state["ended"] | (n == 0) | like, share).otherwise(own).alias("share"), (state["ended"] | (n < min_labels)).alias("ended"),
                        F.when(state["ended"] | (n < min_labels), state["depth"]).otherwise(state["depth"] + 1).alias("depth"))

    start = F.struct(F.lit(float(prior)).alias("share"), F.lit(False).alias("ended"), F.lit(0).alias("depth"))
    shares = chain.select("host", "full", F.aggregate("chain", start, step).alias("end"))
    named = paths.withColumn("full", F.array_join("segs", "/")).join(shares, ["host", "full"])
    # the node at ``depth`` is the first with few labels: what lies below it is one
    template = F.when(F.col("end.depth") < F.size("segs"), F.array_join(F.concat(F.slice("segs", F.lit(1), F.col("end.depth")), F.array(F.lit("**"))), "/")).otherwise(F.col("full"))
    return named.select("host", "look", template.alias("template"), F.col("end.share").alias("share"))


def judge_urls(pages: DataFrame, rules: Sequence[Rule], url_col: str = "url", min_labels: int = 5, min_children: int = 30, max_mean: float = 4.0,
               strength: float = 5.0, z: float = 2.0, reject: float = 0.8) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict`` (allow or
    block) and ``template``."""
    new = ["host", "path", "rule", "verdict", "template"]
    url = F.col(f"`{url_col}`")
    kept = C.without(pages, new) if url_col.lower() not in new else pages
    cols = kept.columns
    taken = cols + new
    rest = C.rename_free(taken, "rest")
    packed = kept.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias(rest), url_host(url).alias("host"), url_path(url).alias("path"))
    verdicts, names = F.array(*[F.lit(r[0]) for r in rules]), F.array(*[F.lit(r[1] + r[2]) for r in rules])
    rows = (packed.withColumn("at", matched_rule(F.col("host"), F.col("path"), rules) if rules else F.lit(None).cast("int"))
            .withColumn("rule", F.get(names, F.col("at")) if rules else F.lit(None).cast("string"))
            .withColumn("said", F.get(verdicts, F.col("at")) if rules else F.lit(None).cast("string"))
            .withColumn("segs", template_segments(F.col("path"))).withColumn("look", F.array_join("segs", "/")))
    paths = C.stored(rows.groupBy("host", "look", "segs").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("said") == "block").alias("blocked"), F.count("said").alias("labelled")), "url-paths")
    blocked, labelled = paths.agg(F.sum("blocked"), F.sum("labelled")).first()
    again = True
    while again:
        paths = C.stored(_widened(paths, min_children, max_mean), "url-paths")
        again = bool(paths.agg(F.max("again")).first()[0])
    prior = (blocked or 0) / labelled if labelled else 0.0
    judged = template_shares(paths, prior, min_labels, strength, z).select(
        "host", "look", "template", F.when(F.col("share") >= reject, "block").otherwise("allow").alias("method"))
    return (rows.drop("segs").join(judged, ["host", "look"], "left")
            .select(*[F.col(rest)[c].alias(c) for c in cols], "host", "path", "rule", F.coalesce("said", "method").alias("verdict"), "template"))
