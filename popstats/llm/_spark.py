"""Small Spark helpers shared by the operators of this package."""

from __future__ import annotations

import gc
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, by a path that only Spark needs to be able to open."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir`` (a local one only where unset, as in tests)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="popstats-ckpt-"))
    return sc.getCheckpointDir()


def materialise(df: DataFrame, narrow: bool = False) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it from there.

    Reliable ``checkpoint()``: the files outlive any executor, and later
    passes do not repeat the work above.  ``narrow``: a frame much smaller
    than what it was made from; its rows are rebalanced first, so it is
    written as a few files of a sensible size instead of one a task.
    """
    shared_dir(df.sparkSession)
    return (df.hint("rebalance") if narrow else df).checkpoint(eager=True)


def beside(small: DataFrame, most: int = 100_000) -> DataFrame:
    """``small`` (already materialised) for a join with wide rows: broadcast if it has at most ``most`` rows.

    A materialised frame has no size estimate, so Spark would shuffle the
    wide side before it sees how small the other one is.  A larger frame is
    returned as it is and joined by sort-merge, with AQE's skew split.
    """
    return F.broadcast(small) if small.limit(most + 1).count() <= most else small


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished, unreferenced steps now.

    The cleaner acts when the driver collects garbage, which a driver that
    only schedules seldom does; several passes would otherwise pile up on disk.
    It takes two collections: the first frees the query objects that hold the
    shuffles.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def in_arrow(df: DataFrame, run: Callable, schema: str, batch_bytes: int = 4 << 20) -> DataFrame:
    """``mapInArrow`` over rows with whole texts, in batches of a few MB.

    Replaces the session's default Arrow batch size (64 MB, held by Spark and
    again by Python for every task); a size that the session sets is kept.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if df.sparkSession.conf.get(key) in ("67108864", "67108864b", "64m", "64MB"):
        df.sparkSession.conf.set(key, str(batch_bytes))
    return df.mapInArrow(run, schema)
