"""Exact token-length histogram (operator 9).

Documents are encoded where they lie and reduced to one row per distinct
encoded length.  Suffix sums over that histogram then answer, for every context
limit, how many documents are cut, how many tokens survive truncation and which
quantile the limit is: between two observed lengths all answers are linear, so
the observed lengths (and 0) are the whole function.

Defined cases: null or empty text has length 0; no rows give no histogram;
every input row counts, repeated or not.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starload.llm._work import Workspace, extended

BLOCK = 1024      # lengths per block of the two-level suffix sum


@lru_cache(maxsize=2)
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def lengths(docs: DataFrame, path: str, pattern: str, *keep: str, text: str = "text") -> DataFrame:
    """Columns ``keep`` and the encoded length of every row's whole text."""
    narrow = docs.select(*keep, F.col(text).alias("__text"))
    schema = extended(narrow.schema.fields[:-1], "n_tokens long")

    def run(batches):
        enc = _encoding(path, pattern)
        for batch in batches:
            sizes = [len(enc.encode_to_numpy(x.as_py(), disallowed_special=())) if x.is_valid else 0
                     for x in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(batch.num_columns - 1)] + [pa.array(sizes, pa.int64())],
                names=[*keep, "n_tokens"])

    return narrow.mapInArrow(run, schema)


def histogram(sizes: DataFrame) -> DataFrame:
    """One row per distinct length: documents of it."""
    return sizes.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def limits(hist: DataFrame) -> DataFrame:
    """Answers for every context limit that equals an observed length.

    Suffix sums are taken inside blocks of lengths; the block totals, one row
    per BLOCK lengths, carry what follows a block.
    """
    rows = hist.select("n_tokens", "n_docs", (F.col("n_tokens") * F.col("n_docs")).alias("tokens"),
                       F.floor(F.col("n_tokens") / BLOCK).alias("block"))
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    blocks = (rows.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
              .select("block", F.coalesce(F.sum("d").over(later), F.lit(0)).alias("docs_after"),
                      F.coalesce(F.sum("t").over(later), F.lit(0)).alias("tokens_after"),
                      F.sum("d").over(everything).alias("all_docs"),
                      F.sum("t").over(everything).alias("total_tokens")))
    above = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    over_docs = F.col("docs_after") + F.coalesce(F.sum("n_docs").over(above), F.lit(0))
    over_tokens = F.col("tokens_after") + F.coalesce(F.sum("tokens").over(above), F.lit(0))
    return (rows.join(blocks, "block")
            .select(F.col("n_tokens").alias("context_limit"), "n_docs", "all_docs", "total_tokens",
                    over_docs.alias("n_docs_cut"), over_tokens.alias("over_tokens"))
            .withColumn("tokens_kept", F.col("total_tokens") - F.col("over_tokens")
                        + F.col("n_docs_cut") * F.col("context_limit"))
            .withColumn("tokens_cut", F.col("total_tokens") - F.col("tokens_kept"))
            .withColumn("quantile", (F.col("all_docs") - F.col("n_docs_cut")) / F.col("all_docs"))
            .drop("over_tokens"))


def answers(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``limits`` of the whole table; the histogram is written once, so every
    document is encoded once."""
    with Workspace(docs.sparkSession, "tokens") as ws:
        return ws.finish(limits(ws.stage(histogram(lengths(docs, path, pattern, text=text)), "histogram")))
