"""Session helpers.

On a cluster the session is owned by whoever submits the job, and these
helpers use that session as it is.  ``get_session`` builds a local one where
none is active, with the settings below.
"""

from __future__ import annotations

import gc
import os
import pathlib
import tempfile
import time
import zipfile

from pyspark.sql import SparkSession

# Settings of a session that get_session builds (an active session keeps its own).
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "popstats") -> SparkSession:
    """Return the active session, or build a local one for tests and bench."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    master = master or os.environ.get("POPSTATS_MASTER", "local[8]")
    builder = SparkSession.builder.master(master).appName(app_name)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    if master.startswith("local"):
        # a few MB of shuffle is common in local runs: keep several partitions
        builder = builder.config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("POPSTATS_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder of reliable checkpoints: the one that ``spark.checkpoint.dir`` names.

    A cluster must name a folder that all its executors share.  Only a
    local-mode session without the setting (a test, a notebook) gets a
    scratch folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured and not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="popstats-ckpt-"))
    return sc.getCheckpointDir()


def ship_package(spark: SparkSession) -> None:
    """Send this package's modules to the executors (once per context), which may not have it installed."""
    sc = spark.sparkContext
    if getattr(sc, "_popstats_shipped", False):
        return
    root = pathlib.Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="popstats-package-"), "popstats.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, str(path.relative_to(root.parent)))
    sc.addPyFile(archive)
    sc._popstats_shipped = True


def cut_lineage(df, spark: SparkSession | None = None):
    """Materialise ``df`` with ``checkpoint()`` and return a DataFrame with short lineage.

    The files are removed when the DataFrame is garbage if the session has
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` on.
    """
    ensure_checkpoint_dir(spark or df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle and checkpoint files of steps that nobody refers to any more.

    The cleaner acts when the driver collects garbage, which a driver that only
    schedules seldom does.  It takes two collections: the first frees the query
    objects that hold the shuffles.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)
