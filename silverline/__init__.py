"""silverline: a PySpark toolkit for refining multi-source entity records.

Every operator is a DataFrame -> DataFrame or Column -> Column function so that
Catalyst plans, prunes and distributes the work.  Sub-packages:

* ``functions``  column expressions (string, number, date, array/JSON, predicates)
* ``operators``  frame operators (clean, entity, stack, dedup, contract, upsert,
  rollup, extract, joins)
* ``sources``    readers / writers and the test-table catalogue
* ``plans``      named end-to-end queries and their DuckDB oracle SQL
* ``streaming``  Structured Streaming jobs (new-key detection, incremental upsert)
"""

from silverline.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
