from __future__ import annotations

import datetime as dt

import pytest
from conftest import SF_SMALL, plan_text, rows
from pyspark.sql import functions as F

from popstats.operators import ranking


@pytest.fixture()
def ties(spark):
    # counts per (grp, item): equal counts at rank 1, at k and at k+1
    data = [("a", "x", 5), ("a", "y", 5), ("a", "z", 3), ("a", "w", 3), ("a", "v", 1),
            ("b", "x", 4), ("b", "y", 2), ("b", "z", 2), ("c", "x", 1)]
    rows_ = [(g, i) for g, i, n in data for _ in range(n)]
    return spark.createDataFrame(rows_, "grp string, item string")


def test_top_groups_first_breaks_ties_by_key(ties):
    out = ranking.top_groups(ties, "grp", k=2)
    assert rows(out) == [("a", 17), ("b", 8)]


def test_top_groups_all_keeps_ties(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), ("d",)], "k string")
    assert rows(ranking.top_groups(df, "k", k=2, ties="first")) == [("a", 2), ("b", 1)]
    assert rows(ranking.top_groups(df, "k", k=2, ties="all")) == [("a", 2), ("b", 1), ("c", 1), ("d", 1)]


def test_top_items_rank_and_row_number(ties):
    rk = ranking.top_items_per_group(ties, "grp", "item", k=2, ties="all")
    assert rows(rk.filter("grp = 'a'")) == [("a", "x", 5, 1), ("a", "y", 5, 1)]
    assert rows(rk.filter("grp = 'b'")) == [("b", "x", 4, 1), ("b", "y", 2, 2), ("b", "z", 2, 2)]
    rn = ranking.top_items_per_group(ties, "grp", "item", k=3, ties="first")
    assert rows(rn.filter("grp = 'a'")) == [("a", "w", 3, 3), ("a", "x", 5, 1), ("a", "y", 5, 2)]


def test_rank_within_topk_restricts_groups(ties):
    out = ranking.rank_within_topk(ties, "grp", "item", k_groups=1, k_items=1)
    assert rows(out) == [("a", "x", 5, 1), ("a", "y", 5, 1)]


def test_null_items_excluded_unless_asked(spark):
    df = spark.createDataFrame([("a", None)] * 3 + [("a", "x")], "g string, i string")
    assert rows(ranking.peak_item_by_group(df, "g", "i")) == [("a", "x", 1)]
    assert rows(ranking.peak_item_by_group(df, "g", "i", include_null=True)) == [("a", None, 3)]


def test_extreme_rows_keeps_ties_and_ignores_null(spark):
    d1, d2 = dt.date(1900, 1, 2), dt.date(1950, 5, 5)
    df = spark.createDataFrame(
        [(1, "M", d1), (2, "M", d1), (3, "M", d2), (4, "F", None), (5, "F", d2)],
        "id int, g string, d date")
    out = ranking.oldest_by_gender(df, gender="g", birth="d")
    assert sorted(r.id for r in out.collect()) == [1, 2, 5]
    assert out.columns == ["id", "g", "d"]
    only_m = ranking.oldest_by_gender(df, gender="g", birth="d", only="M")
    assert sorted(r.id for r in only_m.collect()) == [1, 2]


def test_modal_value_all_ties(spark):
    df = spark.createDataFrame([("s1",), ("s2",), ("s1",), ("s2",), ("s3",)], "street string")
    assert rows(ranking.modal_value(df, "street")) == [("s1", 2), ("s2", 2)]


def test_empty_input(spark):
    df = spark.createDataFrame([], "g string, i string")
    assert ranking.top_groups(df, "g").count() == 0
    assert ranking.rank_within_topk(df, "g", "i").count() == 0
    assert ranking.modal_value(df, "g").count() == 0


def test_rank_plans_limit_before_shuffle(ties):
    """A hot group is trimmed to k rows per task before the exchange."""
    plan = plan_text(ranking.top_items_per_group(ties, "grp", "item", k=2).select("grp"))
    assert "WindowGroupLimit" in plan
    many = ranking.extreme_rows(ties.withColumn("n", F.length("item")), "grp", "n")
    assert "WindowGroupLimit" in plan_text(many)
    for out in (ranking.modal_value(ties, "item"), ranking.top_groups(ties, "item", k=2, ties="all")):
        assert "Window" not in plan_text(out)  # tied groups stay where they are


def test_top_groups_semi_join_is_broadcast(ties):
    out = ranking.rank_within_topk(ties, "grp", "item", k_groups=2, k_items=1)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "LeftSemi" in plan


def test_extreme_rows_runs_no_job_while_it_is_built(spark, ties):
    sc = spark.sparkContext
    sc.setJobGroup("build", "build")
    ranking.extreme_rows(ties.withColumn("n", F.length("item")), "grp", "n")
    assert len(sc.statusTracker().getJobIdsForGroup("build")) == 0
    sc.setJobGroup("", "")


def test_extreme_rows_on_timestamps_in_another_time_zone(spark):
    import os
    import time

    before = os.environ.get("TZ")
    os.environ["TZ"] = "America/New_York"
    time.tzset()
    try:
        df = spark.sql("SELECT * FROM VALUES (1, 'a', TIMESTAMP'2020-03-08 02:30:00'), (2, 'a', TIMESTAMP'2020-03-08 02:30:00'),"
                       " (3, 'a', TIMESTAMP'2021-01-01 00:00:00') AS t(id, g, x)")
        assert sorted(r.id for r in ranking.extreme_rows(df, "g", "x").select("id").collect()) == [1, 2]
    finally:
        os.environ.pop("TZ") if before is None else os.environ.update(TZ=before)
        time.tzset()


def test_a_million_tied_keys(spark):
    df = spark.range(1_000_000).select(F.col("id").alias("key"), F.lit("g").alias("g"))
    assert ranking.modal_value(df, "key").count() == 1_000_000
    assert ranking.top_groups(df, "key", k=3, ties="all").count() == 1_000_000
    top = ranking.top_items_per_group(df, "g", "key", k=3, ties="all")
    assert top.agg(F.count("*"), F.min("rank"), F.max("rank")).first()[:] == (1_000_000, 1, 1)
    assert ranking.extreme_rows(df.withColumn("x", F.lit(1)), "g", "x").count() == 1_000_000


def test_extreme_rows_null_group_and_no_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (None, 2), ("a", 5)], "g string, v int")
    got = sorted((tuple(r) for r in ranking.extreme_rows(df, "g", "v").collect()), key=str)
    assert got == sorted([(None, 1), (None, 1), ("a", 5)], key=str)
    assert rows(ranking.extreme_rows(df, None, "v", ascending=False)) == [("a", 5)]
    empty = spark.createDataFrame([(None, None)], "g string, v int")
    assert ranking.extreme_rows(empty, "g", "v").count() == 0


def test_rank_within_topk_reads_its_source_once(spark):
    df = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("user_id", "event_type")
    out = ranking.rank_within_topk(df, "user_id", "event_type", k_groups=5, k_items=2)
    out.collect()
    assert plan_text(out).split("Initial Plan")[0].count("FileScan") == 1
