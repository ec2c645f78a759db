"""Session construction and the shared scratch location.

Lineage is cut only with reliable ``checkpoint()`` or with tables written
under the folder named by ``spark.checkpoint.dir``; that folder is read from
the session.  A private folder is created only when the setting is absent
*and* the master is local (tests, the bench); on a cluster an unset
checkpoint dir is an error rather than a silent machine-local path.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Defaults for a large cluster; tests and the bench override partitions.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
    # Remove checkpoint files once their DataFrames are garbage collected.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app_name: str = "starload",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    Order: ``spark.checkpoint.dir`` from the session conf, then a checkpoint
    dir already set on the context; when neither exists a fresh folder is
    made, but only on a local master.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        current = spark.sparkContext.getCheckpointDir()
        if current:
            # The context appends a per-application uuid folder; its parent is the root.
            root = current.rstrip("/").rsplit("/", 1)[0]
    if not root:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS/S3/ABFS) so checkpoints and staged tables survive executor loss")
        # Local master only (tests, the bench): a private folder, registered
        # on the context so later calls find it there.
        root = tempfile.mkdtemp(prefix="starload-ck-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint root."""
    root = checkpoint_root(spark)
    sep = "" if root.endswith("/") else "/"
    return f"{root}{sep}starload-stage/{uuid.uuid4().hex}/{name}"


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder.

    Used where a plan holds a non-deterministic step (range bounds are
    sampled) that must be evaluated exactly once, and before several
    actions reuse one expensive frame.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for code that needs an OS path (tests only)."""
    return path[5:] if path.startswith("file:") else path


__all__ = ["build_session", "checkpoint_root", "staging_path", "materialize",
           "local_path", "DEFAULT_CONF"]
