"""Partitioned JDBC reads.

The reference reads every source table through one JDBC connection.  Here
the scan is split on a numeric or date column: one bounds query
(``min``/``max`` pushed to the database), then ``numPartitions`` parallel
range queries.  Filters and column selection added later on the DataFrame
are pushed into each range query by Spark's JDBC source.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, fetch_size: int = 10_000,
                 extra: Mapping[str, str] | None = None) -> dict[str, str]:
    """Connection options; credentials come from the caller (never from code)."""
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    opts.update(extra or {})
    return opts


def read_jdbc(spark: SparkSession, options: Mapping[str, str], partition_column: str | None = None,
              num_partitions: int = 8, bounds: tuple | None = None) -> DataFrame:
    """Read a table, split into ``num_partitions`` range queries on
    ``partition_column`` when given.  ``bounds`` skips the bounds query."""
    reader = spark.read.format("jdbc").options(**options)
    if partition_column is None:
        return reader.load()
    if bounds is None:
        table = options["dbtable"]
        bounds_opts = {k: v for k, v in options.items() if k != "dbtable"}
        bounds_opts["query"] = (f"SELECT MIN({partition_column}) AS lo, MAX({partition_column}) AS hi "
                                f"FROM {table}")
        # One row, computed by the database.
        row = spark.read.format("jdbc").options(**bounds_opts).load().first()
        bounds = (row["lo"] if row else None, row["hi"] if row else None)
    lo, hi = bounds
    if lo is None or hi is None:
        return reader.load()
    return (reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lo)).option("upperBound", str(hi))
            .option("numPartitions", str(num_partitions)).load())
