"""Reading source tables (parquet files or catalog tables)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One source table: ``<sf_dir>/<name>.parquet``, or a catalog table
    when ``sf_dir`` is ``None``.  Column pruning and filters reach the scan."""
    if sf_dir is None:
        return spark.read.table(name)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class LazyTables(Mapping):
    """Named source tables, each read (schema resolved) on first use only,
    so a plan that needs two of seven tables touches two."""

    def __init__(self, spark: SparkSession, sf_dir: str, names: Iterable[str]):
        self._spark, self._dir, self._names = spark, sf_dir, list(names)
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._frames:
            self._frames[name] = read_table(self._spark, self._dir, name)
        return self._frames[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def read_tables(spark: SparkSession, sf_dir: str, names: Iterable[str]) -> Mapping[str, DataFrame]:
    return LazyTables(spark, sf_dir, names)


def register_views(spark: SparkSession, sf_dir: str, names: Iterable[str] = TEST_TABLES) -> None:
    """Temp views for ``spark.sql`` over the same files."""
    for n in names:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)
