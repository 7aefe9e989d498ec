"""Session and checkpoint helpers.

On a cluster the session comes from the platform; nothing here overrides its
settings. ``local_session`` exists for tests and the benchmark only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dir: tempfile.TemporaryDirectory | None = None


def local_session(app: str = "tidemark", cores: str | int = 8, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "8g"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` when the cluster names one.

    Only a local master may fall back to a temporary folder; on a cluster a
    machine-local path would be lost with its executor, so that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    global _local_dir
    if _local_dir is None:
        # Removed with all checkpoints in it when the process ends.
        _local_dir = tempfile.TemporaryDirectory(prefix="tidemark-", ignore_cleanup_errors=True)
    return _local_dir.name


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared folder for one job run."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows survive the loss of any executor."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(run_dir(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def cut_counted(df: DataFrame) -> tuple[DataFrame, int]:
    """``cut_lineage`` with the number of rows, counted while they are written."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    seen = Observation()
    kept = cut_lineage(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return kept, seen.get["rows"]
