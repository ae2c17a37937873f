"""Column -> Column expressions.  All are built-in Spark functions, so they
stay inside whole-stage codegen; none is a Python UDF."""

from silverline.functions import arrays, dates, numbers, predicates, strings  # noqa: F401
