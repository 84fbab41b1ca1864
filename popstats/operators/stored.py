"""Stored pipelines (M3): fitted tables saved as versions in a shared folder and applied in any later session.

A fitted ``LabelTree`` is only tables, so it is saved as Parquet: vocabularies,
classes, weights and one row of settings under ``version=N``.  A version counts
once its number is in the ``versions`` table, which is written last; a save that
is interrupted leaves files that no reader sees, and old versions stay readable.

``fit_counts`` is a closed-form fit in the same shape (a naive Bayes model: one
node, weights from smoothed counts), for which no iteration is needed.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popstats.operators.encoding import encode, vocabulary, widths
from popstats.operators.features import dense_index
from popstats.operators.label_tree import FREQUENT, INTERCEPT, LabelTree
from popstats.session import cut_lineage

_TABLES = ("vocab", "classes", "weights")
WEIGHTS_AT_ONCE = 4_000_000  # of a counted model, in one bucket


def fit_counts(train: DataFrame, features: Sequence[str], label: str, key: str, *, smooth: float = 1.0, class_limit: int = 10_000) -> LabelTree:
    """Naive Bayes: log of (rows of the class with the value + smooth) over (rows of the class + smooth x places of the column).

    Weights are one array over the classes for each value, so the classes are bounded by ``class_limit``.
    """
    features = list(features)
    train = train.select(key, *features, F.col(label).cast("string").alias("_label")).filter(F.col("_label").isNotNull())
    vocab = cut_lineage(vocabulary(train, features))
    totals = train.groupBy(F.col("_label").alias("value")).agg(F.count(F.lit(1)).alias("rows")).withColumn("_one", F.lit(1))
    classes = cut_lineage(dense_index(totals, "_one", [F.col("value").asc()], out="class").select("value", "class", "rows"))
    sizes = [r["rows"] for r in classes.orderBy("class").limit(class_limit + 1).collect()]
    if not sizes or len(sizes) > class_limit:
        raise ValueError(f"{label!r} must have 1 to {class_limit} classes in the training part")
    place = cut_lineage(widths(vocab, features))
    positions = encode(train, vocab, features, key).join(train.select(key, F.col("_label").alias("value")), key).join(classes, "value")
    cells = positions.select(F.explode("indices").alias("feature"), "class").groupBy("feature", "class").agg(F.count(F.lit(1)).alias("n"))
    held = cells.groupBy("feature").agg(F.map_from_entries(F.collect_list(F.struct("class", "n"))).alias("held"))  # at most one per class
    # the keep place of a column holds no training row unless a value was NULL: it is listed all the same
    kept = place.select((F.col("offset") + F.col("size")).alias("feature"))
    every = held.select("feature").union(kept).distinct().join(held, "feature", "left")
    p = F.broadcast(place.select("offset", (F.col("size") + 1).alias("places")))  # one row per column
    whose = (F.col("feature") >= F.col("offset")) & (F.col("feature") < F.col("offset") + F.col("places"))
    weight = F.array(*[F.log((F.coalesce(F.col("held")[F.lit(c).cast("long")], F.lit(0)) + smooth) / (n + smooth * F.col("places")))
                       for c, n in enumerate(sizes)])
    prior = F.array(*[F.lit(math.log(n / sum(sizes))) for n in sizes])
    # about WEIGHTS_AT_ONCE weights a bucket; a column's first values, its keep place and the prior are in bucket 0
    n_places = place.agg(F.sum(F.col("size") + 1).alias("n")).first()["n"]
    n_buckets = 1 if n_places * len(sizes) <= WEIGHTS_AT_ONCE else 1 + math.ceil(n_places * len(sizes) / WEIGHTS_AT_ONCE)
    index = F.col("feature") - F.col("offset")
    dealt = F.when((F.lit(n_buckets) == 1) | (index < FREQUENT) | (index >= F.col("places") - 1), F.lit(0)).otherwise(1 + F.col("feature") % max(n_buckets - 1, 1))

    def blocks(rows: DataFrame, feature, bucket, w) -> DataFrame:
        return rows.select(F.lit(0).alias("model"), F.lit(0).alias("level"), F.lit(0).cast("long").alias("node"),
                           F.lit(n_buckets).cast("long").alias("buckets"), bucket.cast("long").alias("bucket"),
                           F.array(feature.cast("long")).alias("features"), F.array(F.lit(0)).alias("at"), w.alias("w"))

    weights = blocks(every.join(p, whose), F.col("feature"), dealt, weight).unionByName(
        blocks(train.sparkSession.range(1), F.lit(INTERCEPT), F.lit(0), prior))
    return LabelTree(vocab, classes.select("value", "class"), cut_lineage(weights), features, [0.0], 1, len(sizes))


def versions(spark: SparkSession, path: str) -> list[int]:
    """The versions saved at ``path``, oldest first."""
    try:
        return sorted(r["version"] for r in spark.read.parquet(f"{path}/versions").collect())  # one row per save
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return []
        raise


def save(tree: LabelTree, path: str) -> int:
    """Save as the next version; returns its number."""
    spark = tree.vocab.sparkSession
    version = max(versions(spark, path), default=0) + 1
    folder = f"{path}/version={version}"
    for name in _TABLES:
        getattr(tree, name).write.mode("overwrite").parquet(f"{folder}/{name}")
    spark.createDataFrame([(tree.features, tree.reg_params, tree.depth, tree.fan)],
                          "features array<string>, reg_params array<double>, depth int, fan int").write.mode("overwrite").parquet(f"{folder}/settings")
    spark.createDataFrame([(version,)], "version int").coalesce(1).write.mode("append").parquet(f"{path}/versions")
    return version


def load(spark: SparkSession, path: str, version: int | None = None) -> LabelTree:
    """The saved pipeline, by default its latest version."""
    found = versions(spark, path)
    version = (found[-1] if found else None) if version is None else version
    if version not in found:
        raise ValueError(f"no version {version} at {path}")
    folder = f"{path}/version={version}"
    s = spark.read.parquet(f"{folder}/settings").first()
    return LabelTree(*[spark.read.parquet(f"{folder}/{name}") for name in _TABLES],
                     list(s["features"]), list(s["reg_params"]), s["depth"], s["fan"])
