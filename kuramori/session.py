"""Session construction and the small amount of run-time plumbing the operators share."""

from __future__ import annotations

import gc
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "kuramori") -> SparkSession:
    """Local session for tests and benches; on a cluster the caller's own session is used as it is."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("KURAMORI_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder of ``spark.checkpoint.dir``. Where it is unset a local session (tests) gets a temporary one; on a cluster,
    whose machines share no such folder, that is an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="kuramori-checkpoint-"))


def checked_broadcast(df: DataFrame, most: int = 1_000_000) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``most`` rows; beyond that as it is, so that the join shuffles."""
    from pyspark.sql import functions as F

    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the checkpoint folder, so that later stages neither recompute it nor need its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def discard(df: DataFrame) -> None:
    """Have the shuffle and checkpoint files that no DataFrame needs any more deleted now, not when the driver's memory happens to fill."""
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the parquet tables of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition for Python-heavy work: as many partitions as the session has shuffle partitions or cores, whichever is more.

    Adaptive execution merges small shuffle partitions by bytes, which would put costly rows of few bytes into one task; a
    repartition by number is left as it is."""
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(n, *keys)
