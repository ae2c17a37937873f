"""Named end-to-end queries over the driver's tables, each with the DuckDB
SQL that must give the same rows (``oracle``).  Importing the package
registers every query."""

from silverline.plans.registry import ORACLE, QUERIES  # noqa: F401
from silverline.plans import entities, scalars, maintenance, pages, streams, reports, publish, files  # noqa: F401,E402
