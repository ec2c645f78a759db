"""Intermediate tables of one operator run, below the shared checkpoint root.

Everything staged here is Parquet in the folder that ``spark.checkpoint.dir``
names, so a lost executor costs no recomputation of earlier phases, and all of
it is deleted when the run ends.  The result itself is checkpointed.
"""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starload.session import checkpoint_root, materialize


def extended(fields: list[T.StructField], ddl: str) -> T.StructType:
    """Kept fields followed by new ones."""
    return T.StructType([*fields, *T.StructType.fromDDL(ddl).fields])


class Workspace:
    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self._tables: dict[str, str] = {}
        self._n = 0

    def __enter__(self) -> "Workspace":
        return self

    def __exit__(self, *exc) -> None:
        for table in list(self._tables):
            self.drop(table)
        self._delete(self.root)

    def _delete(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

    def _path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{name}"

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write once, read many times."""
        path = self._path(name)
        df.write.parquet(path)
        self.release()
        out = self.spark.read.schema(df.schema).parquet(path)
        out._staged_at = path
        return out

    def discard(self, *staged: DataFrame) -> None:
        """Delete staged tables that nothing reads any more."""
        for df in staged:
            self._delete(df._staged_at)

    def bucketed(self, df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
        """A table hash-bucketed and sorted by ``key``: joins and groups on the key
        with tables of as many buckets need no exchange."""
        table = f"{name}_{uuid.uuid4().hex}"
        path = self._path(name)
        (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
         .option("path", path).saveAsTable(table))
        self._tables[table] = path
        self.release()
        out = self.spark.table(table)
        out._staged = table
        return out

    def drop(self, table: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self._delete(self._tables.pop(table))

    def release(self) -> None:
        """Let Spark's cleaner remove the shuffle files of finished phases."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def finish(self, df: DataFrame) -> DataFrame:
        """Checkpoint the result, so it outlives the staged tables."""
        return materialize(df)
