"""Searches of a stated query set against every row of a table of vectors.

Rows are streamed into packs of a fixed number of rows, whatever partition they
lie in: a *shard* is a pack of candidates with an index built over it, a *block*
a pack of queries.  Both are staged.  A cell joins one shard with ``GROUP``
blocks, on their dense numbers, so every task holds one shard and a bounded
number of queries, the same at any size and for any value of the data.  A cell
returns the best few of each of its queries, and a rank per query merges them.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starload.llm._work import Workspace

SHARD = 4096      # candidates under one index
BLOCK = 1024      # queries in one block
GROUP = 8         # blocks that meet one shard in one task


def usable(vector: str) -> Column:
    """Neither null nor empty, no null and no non-finite component."""
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def matrix(table: pa.Table, column: str = "vector") -> np.ndarray:
    """A column of equally long lists as rows of doubles."""
    lists = table.column(column).combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(lists), -1) if len(lists) else flat.reshape(0, 0)


def dump(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def load(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all()


def arrays(table: pa.Table, **more: np.ndarray) -> pa.Table:
    """A table that carries the index's arrays in its metadata."""
    meta = {name.encode(): values.dtype.str.encode() + b" " + values.tobytes() for name, values in more.items()}
    return table.replace_schema_metadata(meta)


def array(table: pa.Table, name: str) -> np.ndarray:
    kind, _, raw = table.schema.metadata[name.encode()].partition(b" ")
    return np.frombuffer(raw, dtype=kind.decode())


def packs(ws: Workspace, rows: DataFrame, size: int, name: str,
          build: Callable[[pa.Table], pa.Table] = lambda t: t) -> tuple[DataFrame, int]:
    """``rows`` (with a list column ``vector``) as (number, blob), ``size`` rows of
    one vector length to a blob, and how many there are."""
    def run(batches):
        part, seq, held, n = TaskContext.get().partitionId(), 0, [], 0

        def flush():
            nonlocal seq
            table = pa.Table.from_batches(held)
            lengths = pc.list_value_length(table.column("vector"))
            for length in pc.unique(lengths).to_pylist():
                own = table.filter(pc.equal(lengths, length))
                yield pa.RecordBatch.from_pylist([{"part": part, "seq": seq, "blob": dump(build(own))}], schema)
                seq += 1

        schema = pa.schema([("part", pa.int64()), ("seq", pa.int64()), ("blob", pa.binary())])
        for batch in batches:
            while batch.num_rows:
                take = batch.slice(0, size - n)
                batch = batch.slice(take.num_rows)
                held.append(take)
                n += take.num_rows
                if n == size:
                    yield from flush()
                    held, n = [], 0
        if n:
            yield from flush()

    staged = ws.stage(rows.mapInArrow(run, "part long, seq long, blob binary"), name)
    # One row per input partition: the numbers of the packs before it.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = (staged.groupBy("part").agg(F.count("*").alias("n"))
              .withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n"))
    return (staged.join(before, "part").select((F.col("before") + F.col("seq")).alias("number"), "blob"),
            staged.count())


def meet(shards: tuple[DataFrame, int], blocks: tuple[DataFrame, int],
         search: Callable[[pa.Table, list[pa.Table]], pa.Table], schema: str) -> DataFrame:
    """``search(shard, blocks)`` for every shard and every ``GROUP`` blocks."""
    (left, n_shards), (right, n_blocks) = shards, blocks
    spark = left.sparkSession
    if not n_shards or not n_blocks:
        return spark.createDataFrame([], schema)
    groups = -(-n_blocks // GROUP)
    left = left.select(F.col("number").alias("shard"), "blob",
                       F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("group"))
    right = right.select(F.floor(F.col("number") / GROUP).alias("group"), "number", "blob",
                         F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_shards - 1).cast("long"))).alias("shard"))

    def run(shard: pa.Table, block: pa.Table) -> pa.Table:
        return search(load(shard.column("blob")[0].as_py()), [load(b) for b in block.column("blob").to_pylist()])

    return left.groupBy("shard", "group").cogroup(right.groupBy("shard", "group")).applyInArrow(run, schema)


def first(found: DataFrame, k: int, *by: str) -> DataFrame:
    """The ``k`` best of each query by (score, smaller vec_id), ranked from 1."""
    best = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


class Best:
    """The k best (score, smaller id) of each of ``n`` queries so far."""

    def __init__(self, n: int, k: int, kind=np.float64, least=-np.inf):
        self.k, self.least = k, least
        self.score = np.full((n, k), least, dtype=kind)
        self.id = np.full((n, k), np.iinfo(np.int64).max, dtype=np.int64)

    @property
    def bar(self) -> np.ndarray:
        """A score below this cannot be among a query's best."""
        return self.score[:, -1]

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(query):
            return
        touched = np.unique(query)
        q = np.concatenate([np.repeat(touched, self.k), query])
        s = np.concatenate([self.score[touched].ravel(), score])
        i = np.concatenate([self.id[touched].ravel(), ids])
        order = np.lexsort((i, -s, q))
        q, s, i = q[order], s[order], i[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        top = place < self.k
        self.score[q[top], place[top]] = s[top]
        self.id[q[top], place[top]] = i[top]

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        query, place = np.nonzero(self.id != np.iinfo(np.int64).max)
        return query, self.score[query, place], self.id[query, place]
