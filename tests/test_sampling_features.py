from __future__ import annotations

from pyspark.sql import functions as F

from popstats.operators import features, sampling


def test_split_disjoint_complete_and_stable(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    a = sampling.split_by_key(df, "k", weights=(0.7, 0.1, 0.2), seed=7)
    b = sampling.split_by_key(df.repartition(13), "k", weights=(0.7, 0.1, 0.2), seed=7)
    counts = {r.part: r["count"] for r in a.groupBy("part").count().collect()}
    assert sum(counts.values()) == 20000
    assert abs(counts["train"] / 20000 - 0.7) < 0.02
    assert abs(counts["valid"] / 20000 - 0.1) < 0.02
    # same key -> same part, whatever the partitioning
    joined = a.join(b.withColumnRenamed("part", "p2"), "k")
    assert joined.filter(F.col("part") != F.col("p2")).count() == 0


def test_sample_by_key_reproducible(spark):
    df = spark.range(10000).withColumnRenamed("id", "k")
    s1 = sorted(r.k for r in sampling.sample_by_key(df, "k", 0.05, seed=2018).collect())
    s2 = sorted(r.k for r in sampling.sample_by_key(df.repartition(5), "k", 0.05, seed=2018).collect())
    assert s1 == s2 and 350 < len(s1) < 650
    assert sampling.sample_by_key(df, "k", 0.0).count() == 0
    assert sampling.sample_by_key(df, "k", 1.0).count() == 10000


def test_tiny_fractions_are_not_rounded_up(spark):
    df = spark.range(2_000_000).withColumnRenamed("id", "k")
    assert sampling.sample_by_key(df, "k", 1e-8).count() <= 2
    assert 80 <= sampling.sample_by_key(df, "k", 6e-5).count() <= 170


def test_dense_index_without_exchange_reuse(spark):
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        df = spark.range(2_000_000).select(F.lit("g").alias("g"), F.xxhash64("id").alias("v"))
        got = features.dense_index(df, "g", [F.col("v").asc()]).agg(
            F.min("index"), F.max("index"), F.count_distinct("index")).first()
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")
    assert tuple(got) == (0, 1_999_999, 2_000_000)


def test_drop_incomplete(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "x int, y string")
    assert sampling.drop_incomplete(df).count() == 1
    assert sampling.drop_incomplete(df, ["x"]).count() == 2


def test_dense_index_across_many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(5000).select((F.col("id") % 3).cast("string").alias("g"),
                                      F.col("id").alias("v"))
        out = features.dense_index(df.repartition(17), "g", [F.col("v").desc()])
        got = {(r.g, r.v): r["index"] for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for g in "012":
        vs = sorted((v for (gg, v) in got if gg == g), reverse=True)
        assert [got[(g, v)] for v in vs] == list(range(len(vs)))


def test_string_index_matches_stringindexer(spark):
    from pyspark.ml.feature import StringIndexer

    vals = ["b"] * 3 + ["a"] * 3 + ["c"] * 5 + ["d"]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    ours = {r.value: r["index"] for r in features.string_index(df, ["x"]).collect()}
    labels = StringIndexer(inputCol="x", outputCol="i").fit(df).labels
    assert ours == {v: i for i, v in enumerate(labels)}
    assert ours == {"c": 0, "a": 1, "b": 2, "d": 3}


def test_dense_index_with_adaptive_coalescing(spark):
    df = spark.range(30000).select((F.col("id") % 4).cast("string").alias("g"), F.col("id").alias("v"))
    out = features.dense_index(df.repartition(11), "g", [F.col("v").asc()])
    got = out.groupBy("g").agg(F.min("index").alias("lo"), F.max("index").alias("hi"),
                               F.countDistinct("index").alias("n")).collect()
    assert sorted((r.g, r.lo, r.hi, r.n) for r in got) == [(g, 0, 7499, 7500) for g in "0123"]
    assert out.filter((F.col("index") != (F.col("v") / 4).cast("long"))).count() == 0
