"""UDF-3: extractors for single documents as table functions of SQL.

An extractor is a Python function from a text to rows, registered under a name
and called with ``LATERAL``, so that one page may give any number of rows and
what follows is plain SQL.  Rows travel in Arrow batches.  What Spark's own
functions can say (``operators.extract``) needs none of these.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from silverline.operators.extract import json_objects
from silverline.session import ship_package


def register_extractor(spark: SparkSession, name: str, extract: Callable[..., Iterable[tuple]], returns: str, outer: bool = False) -> None:
    """Register ``extract(text, ...)`` as the table function ``name`` with the
    columns ``returns`` (DDL).  A text that gives no rows, a null one among
    them, leaves the result, and with ``outer`` keeps one row of nulls (Spark
    treats ``LEFT JOIN LATERAL`` of a Python function as an inner join).  An
    error in ``extract`` fails the query."""
    ship_package(spark)
    nothing = (None,) * len(StructType.fromDDL(returns))

    class Extractor:
        def eval(self, text, *options):
            found = False
            for row in () if text is None else extract(text, *options):
                found = True
                yield row
            if outer and not found:
                yield nothing

    spark.udtf.register(name, F.udtf(Extractor, returnType=returns, useArrow=True))


def _numbered_objects(text: str) -> Iterable[tuple]:
    return enumerate(json_objects(text))


def register_extractors(spark: SparkSession) -> None:
    """The library's own: ``json_objects(text)`` and ``json_objects_outer(text)`` with ``obj_idx`` and ``json`` (EXT-9)."""
    for outer in (False, True):
        register_extractor(spark, "json_objects" + "_outer" * outer, _numbered_objects, "obj_idx int, json string", outer)
