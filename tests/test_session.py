from __future__ import annotations

import os
import pathlib

from popstats import session


def test_cut_lineage_checkpoints_into_session_folder(spark):
    folder = session.ensure_checkpoint_dir(spark)
    assert folder
    out = session.cut_lineage(spark.range(100).selectExpr("id * 2 AS x"))
    assert out.count() == 100
    # a reliable checkpoint reads back from files, not from the original plan
    assert "LogicalRDD" in out._jdf.queryExecution().optimizedPlan().toString()


def test_no_local_checkpoint_anywhere():
    root = pathlib.Path(__file__).resolve().parents[1]
    for path in list((root / "popstats").rglob("*.py")) + [root / "__spark_entry__.py", root / "bench.py"]:
        assert "localCheckpoint" not in path.read_text(), path


def test_get_session_keeps_cluster_settings(spark):
    # an active session is returned as is: its own settings are never overridden
    assert session.get_session() is spark
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    assert os.path.isdir(session.ensure_checkpoint_dir(spark).replace("file:", ""))


def test_a_rewritten_table_is_read_with_its_new_schema(spark, tmp_path):
    from popstats.sources import tables

    d = tmp_path / "sf"
    spark.range(3).selectExpr("id AS o_orderkey").write.parquet(str(d / "orders.parquet"))
    assert tables.table(spark, str(d), "orders").count() == 3
    spark.range(5).selectExpr("id AS o_orderkey", "id * 2 AS o_custkey").write.mode("overwrite") \
        .parquet(str(d / "orders.parquet"))
    assert tables.table(spark, str(d), "orders").columns == ["o_orderkey", "o_custkey"]
