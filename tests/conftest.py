from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    scratch = tempfile.mkdtemp(prefix="popstats-test-")
    spark = (SparkSession.builder.master("local[*]")
             .appName("popstats-tests")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.checkpoint.dir", os.path.join(scratch, "ckpt"))
             .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
             .config("spark.sql.warehouse.dir", os.path.join(scratch, "wh"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="popstats-run-")


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
