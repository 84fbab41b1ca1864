"""Documents to a training mix: quality rules, near-duplicates, benchmark leaks, source weights, shards.

Every stage takes whole tables with any further columns and returns the columns
of its input (the last one adds ``shard``).  In all of them a NULL text counts
as empty, a text of any length is processed whole, repeated rows are rows of
their own, NULL ids, languages and sources are values like others, an empty
table stays empty, and columns named like one that a stage makes on the way are
carried unchanged.  What a stage does with ties is said at the stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from popstats.llm._spark import load, release, shared_dir
from popstats.llm.decontam import decontaminate
from popstats.llm.mixing import length_weight, mix
from popstats.llm.quality import quality_filter
from popstats.llm.sharding import with_shard
from popstats.llm.simhash import drop_near_duplicates
from popstats.sources.files import remove


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that the quality rules reject go (a value equal to a fence stays; an empty text goes)."""
    return quality_filter(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: of every component of fingerprints the document with the smallest id stays (NULL ids last)."""
    return drop_near_duplicates(docs, shingle=3, max_bits=2)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents contaminated by the benchmark go (one word in twenty or more is enough)."""
    return decontaminate(docs, load(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: every document as often (0, 1 or 2 times) as the mix takes it; longer ones are likelier to stay.

    Documents of equal rank are told apart by a hash of id and text, identical rows by their position.
    """
    return mix(docs, relative=length_weight)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: the documents' columns and the shard of each row (equal rows share a shard; a column ``shard`` is replaced)."""
    return with_shard(docs, n_shards=16, map_path=spark.conf.get("spark.popstats.slotMap.pipeline", None))


STAGES = [
    ("quality rules", keep_quality),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("mixing sources", mix_sources),
    ("sharding", shard),
]

#: Quantile sketches, Hamming components and hashed draws have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written as Parquet, read by the next and then removed (the last one stays)."""
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = load(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            remove(spark, f"{folder}/{k - 1}")
        release(spark)
    return docs
