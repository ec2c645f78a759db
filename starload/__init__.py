"""starload: load dimensional warehouses with the Spark DataFrame API.

Subpackages:

* ``sources``   -- table readers and writers (parquet/catalog tables, JDBC, JSON)
* ``functions`` -- column-expression helpers (null fills, casts, dates, flags)
* ``operators`` -- DataFrame -> DataFrame building blocks (lookups, surrogate
  keys, dimensions, quality checks, reconciliation, nesting, profiling, layout)
* ``plans``     -- declarative table specs and the multi-table loader
* ``streaming`` -- micro-batch driver that runs the same loader on new files
"""

from starload.session import build_session, checkpoint_root, materialize, staging_path

__all__ = ["build_session", "checkpoint_root", "materialize", "staging_path"]
