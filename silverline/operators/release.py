"""UPS-6: a set of tables published in order with one commit.

The versions of all tables of a set are written first, then one small manifest
that names them.  Readers follow the newest manifest, so they see the old set
until the new one is whole; a run that dies between tables leaves no trace for
them.  A rerun works from the same manifest, takes the same version number and
writes over what the dead run left.  A table that did not change keeps the
folder that an earlier version wrote, and a set without any change writes no
manifest.

Layout under ``root``: ``tables/<name>/v<version>`` (Parquet) and
``manifests/v<version>.json`` (one line per table).  A manifest is written
beside its place and renamed into it; a version whose manifest is there already
was published by somebody else meanwhile, which is an error.  One run at a time
should publish a set.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.operators import upsert


@dataclass(frozen=True)
class Version:
    """What a manifest names: folder and schema (JSON) of each table."""

    number: int = 0
    paths: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Step:
    """One table of a set.  ``make`` gives its rows; it gets the tables of the
    version being made that come before this one, by name."""

    name: str
    key: list[str]
    make: Callable[[Mapping[str, DataFrame]], DataFrame]
    prune_missing: bool = False


def _files(spark: SparkSession, root: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, path


def _manifest(root: str, number: int) -> str:
    return f"{root}/manifests/v{number:09d}.json"


def versions(spark: SparkSession, root: str) -> list[int]:
    """The numbers of all committed versions, rising."""
    fs, path = _files(spark, root)
    folder = path(f"{root}/manifests")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))


def version(spark: SparkSession, root: str, number: int | None = None) -> Version:
    """A committed version, the newest by default; number 0 without tables if there is none."""
    if number is None:
        number = max(versions(spark, root), default=0)
    if not number:
        return Version()
    rows = spark.read.schema("name string, path string").json(_manifest(root, number)).collect()  # one row per table
    return Version(number, {r.name: r.path for r in rows})


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """(version, name, path) of every committed version."""
    number = F.regexp_extract(F.col("_metadata.file_name"), r"v(\d+)\.json$", 1).cast("int")
    return spark.read.schema("name string, path string").json(f"{root}/manifests/v*.json").select(number.alias("version"), "name", "path")


def read(spark: SparkSession, root: str, name: str, number: int | None = None) -> DataFrame:
    """A table of a committed version."""
    paths = version(spark, root, number).paths
    if name not in paths:
        raise KeyError(f"no version of {root} names a table {name!r}")
    return spark.read.parquet(f"{root}/{paths[name]}")


def _commit(spark: SparkSession, root: str, new: Version) -> None:
    fs, path = _files(spark, root)
    target, beside = path(_manifest(root, new.number)), path(f"{root}/manifests/.v{new.number:09d}.tmp")
    out = fs.create(beside, True)
    for name, at in sorted(new.paths.items()):
        out.write(bytearray((json.dumps({"name": name, "path": at}) + "\n").encode()))
    out.close()
    if fs.exists(target) or not fs.rename(beside, target):
        raise RuntimeError(f"version {new.number} of {root} was published meanwhile")


def publish(spark: SparkSession, root: str, as_of, steps: list[Step]) -> dict[str, dict[str, int]]:
    """Bring every table of the set up to date and commit the set; the change
    summary of each table.  Keys that are gone from a table's rows leave it
    where the step says ``prune_missing``."""
    before = version(spark, root)
    number, paths, summary = before.number + 1, dict(before.paths), {}
    made: dict[str, DataFrame] = {}
    for step in steps:
        new = step.make(made)
        if step.name in before.paths:
            current = spark.read.parquet(f"{root}/{before.paths[step.name]}")
        else:
            current = new.limit(0).withColumns({c: F.lit(None).cast("timestamp_ntz") for c in upsert.AUDIT_COLUMNS})
        at = f"tables/{step.name}/v{number:09d}"
        changed, summary[step.name] = upsert.publish_counted(current, new, step.key, as_of, f"{root}/{at}", prune_missing=step.prune_missing)
        if changed or step.name not in before.paths:
            paths[step.name] = at
            if not changed:  # the first version of a table without rows
                current.write.mode("overwrite").parquet(f"{root}/{at}")
        made[step.name] = spark.read.parquet(f"{root}/{paths[step.name]}")
    if paths != before.paths:
        _commit(spark, root, Version(number, paths))
    return summary
