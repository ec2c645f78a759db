"""``foreachBatch`` adapter around ``run_load``.

Each micro-batch replaces one named source with the batch's rows and loads
the given specs.  The fact batch id is the epoch id: a replayed epoch (after
a failure) overwrites its own partition, so the sink stays exactly-once
together with the stream checkpoint, which lives under the shared
``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from starload.plans.load import run_load
from starload.plans.spec import TableSpec


def load_stream(stream: DataFrame, source_name: str, specs: list[TableSpec],
                static_sources: Mapping[str, DataFrame], target_root: str,
                load_ts: str | None = None, checkpoint_location: str | None = None,
                available_now: bool = True, query_name: str | None = None) -> StreamingQuery:
    """Start a streaming load of ``stream`` (standing in for ``source_name``)."""
    if not checkpoint_location:
        raise ValueError("checkpoint_location is required: a fresh one would restart epoch ids and repeat rows")

    def each_batch(batch: DataFrame, epoch_id: int) -> None:
        sources = ChainMap({source_name: batch}, static_sources)
        run_load(batch.sparkSession, specs, sources, target_root, load_ts, batch_id=f"epoch{epoch_id:010d}")

    writer = stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint_location)
    if query_name:
        writer = writer.queryName(query_name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
