"""Streaming adapter: new lineitem files loaded batch by batch."""

from pyspark.sql import functions as F

from starload.plans.load import load_gate, reconcile_load, run_load
from starload.plans.star import LOAD_TS, star_sources, star_specs
from starload.sources.warehouse import read_back
from starload.streaming import load_stream

from locations import SF_SMALL


def test_stream_of_lineitem_files_loads_every_line_once(spark, tmp_path):
    sources = star_sources(spark, SF_SMALL)
    specs = star_specs()
    dims = [s for s in specs if s.kind == "dimension"]
    fact = [s for s in specs if s.kind == "fact"]
    root = str(tmp_path / "wh")
    run_load(spark, dims, sources, root, LOAD_TS)
    load_gate(reconcile_load(spark, dims, sources, root))

    # lineitem arrives as two drops of files (split by ship year)
    incoming = str(tmp_path / "incoming")
    li = sources["lineitem"]
    li.filter(F.year("l_shipdate") < 1998).write.parquet(f"{incoming}/drop=1")
    li.filter(F.year("l_shipdate") >= 1998).write.parquet(f"{incoming}/drop=2")
    stream = spark.readStream.schema(li.schema).option("recursiveFileLookup", "true").parquet(incoming)
    q = load_stream(stream, "lineitem", fact, sources, root, LOAD_TS,
                    checkpoint_location=f"{root}-checkpoint")
    q.awaitTermination(300)
    assert q.exception() is None
    loaded = read_back(spark, f"{root}/fact_lineitem")
    assert loaded.count() == li.count()
    assert loaded.filter(F.col("sk_part") == -1).count() == 0
