"""All-or-nothing loads: staged folders and a load log.

A load writes every table into fresh folders below ``<root>/data`` and, when all
of it is there and checked, one record to ``<root>/load_log``: which folder holds
which batch of which table.  The record is one file, which Spark's commit moves
into place whole, so readers see a load entirely or not at all.  A load that dies
on the way leaves folders that no record names; the next load starts from the
last record, and ``vacuum`` deletes them.

An entry either adds a folder to its table or replaces what the table had for the
same batch (also by nothing).  One load at a time may publish to a root; a second
one that started from the same record is refused.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

LOG, DATA = "load_log", "data"
_RECORD = ("seq long, entries array<struct<table: string, batch: string, folder: string, replace: boolean, "
           "schema: string>>")


class ConcurrentLoadError(RuntimeError):
    """Another load has published since this one began."""


@dataclass(frozen=True)
class Entry:
    table: str
    batch: str
    folder: str | None       # relative to the root; None: the batch has no rows
    replace: bool
    schema: str              # of what readers see, as JSON; files may hold more columns


def _records(spark: SparkSession, root: str) -> list:
    """The published loads in order; their number and size do not depend on rows."""
    try:
        found = spark.read.schema(_RECORD).json(f"{root}/{LOG}/*/*.json").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    records = sorted(found, key=lambda r: r.seq)
    if len({r.seq for r in records}) < len(records):
        raise ConcurrentLoadError(f"{root}: two loads were published as one number")
    return records


class Warehouse:
    """The published tables of a root, and what the running load has staged."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        records = _records(spark, self.root)
        self.seq = records[-1].seq if records else 0
        self._published = [Entry(*e) for r in records for e in r.entries]
        self.staged: list[Entry] = []

    def parts(self, table: str) -> list[tuple[str, str]] | None:
        """(batch, folder) of a table, the staged ones included; None for a table
        that no load has written."""
        mine = [e for e in [*self._published, *self.staged] if e.table == table]
        if not mine:
            return None
        held: list[tuple[str, str]] = []
        for e in mine:
            if e.replace:
                held = [(b, f) for b, f in held if b != e.batch]
            if e.folder is not None:
                held.append((e.batch, e.folder))
        return held

    def read(self, table: str, *, without: str | None = None) -> DataFrame | None:
        """The table (but for one batch), with the schema its last entry declares;
        None if no load has written it."""
        parts = self.parts(table)
        if parts is None:
            return None
        last = [e for e in [*self._published, *self.staged] if e.table == table][-1]
        schema = StructType.fromJson(json.loads(last.schema))
        folders = [f"{self.root}/{f}" for b, f in parts if b != without]
        return (self.spark.read.schema(schema).parquet(*folders) if folders
                else self.spark.createDataFrame([], schema))

    def new_folder(self, table: str) -> str:
        return f"{DATA}/{table}/{uuid.uuid4().hex}"

    def stage(self, table: str, batch: str, folder: str | None, replace: bool, schema: StructType) -> None:
        self.staged.append(Entry(table, batch, folder, replace, schema.json()))

    def publish(self) -> None:
        """The last step of a load: its entries become visible together."""
        records = _records(self.spark, self.root)
        if (records[-1].seq if records else 0) != self.seq:
            raise ConcurrentLoadError(f"{self.root}: another load was published meanwhile")
        row = [(self.seq + 1, [tuple(asdict(e).values()) for e in self.staged])]
        (self.spark.createDataFrame(row, _RECORD).coalesce(1)
         .write.json(f"{self.root}/{LOG}/{self.seq + 1:010d}-{uuid.uuid4().hex}"))
        self.seq, self._published, self.staged = self.seq + 1, [*self._published, *self.staged], []

    def orphans(self) -> list[str]:
        """Folders below ``data`` that no published entry names: remains of loads
        that died, and batches that were replaced."""
        named = {f for t in {e.table for e in self._published} for _, f in self.parts(t) or []}
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        pattern = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{DATA}/*/*")
        found = pattern.getFileSystem(conf).globStatus(pattern) or []
        folders = ["/".join(str(s.getPath().toString()).rstrip("/").split("/")[-3:]) for s in found]
        return sorted(f for f in folders if not any(n == f or n.startswith(f + "/") for n in named))

    def vacuum(self) -> list[str]:
        """Delete the orphans.  Not while a load or a reader of a replaced batch runs."""
        gone = self.orphans()
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for folder in gone:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{folder}")
            path.getFileSystem(conf).delete(path, True)
        return gone


def read_published(spark: SparkSession, target: str) -> DataFrame | None:
    """The table at ``<root>/<table>`` if loads publish to that root."""
    root, _, table = target.rstrip("/").rpartition("/")
    return Warehouse(spark, root).read(table) if root else None


__all__ = ["Warehouse", "Entry", "ConcurrentLoadError", "read_published"]
