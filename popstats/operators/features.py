"""Category vocabularies (M1): the ``StringIndexer`` ordering as a table.

``string_index`` gives, for every column and value, the value's count and
its index when values are ordered by count descending, then value
ascending -- the order ``StringIndexer(stringOrderType='frequencyDesc')``
uses.  The index is computed without sending a column's whole vocabulary
to one task or to the driver: values are range-partitioned in index order,
each partition numbers its own rows, and per-partition offsets (one row
per partition and group) are joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from popstats.session import cut_lineage


def dense_index(df: DataFrame, by: str, order: Sequence[Column], *, out: str = "index") -> DataFrame:
    """0-based position of each row within its ``by`` group under ``order``.

    ``order`` must be a total order inside a group.  Distributed form of
    ``row_number() over (partition by by order by ...) - 1``.

    The range partitioning is written to the checkpoint folder before it is
    used twice: two evaluations could draw different range bounds, and then
    positions and offsets would not belong together.
    """
    ranged = cut_lineage(df.repartitionByRange(F.col(by).asc(), *order).withColumn("_pid", F.spark_partition_id()))
    sizes = ranged.groupBy(by, "_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col(by).alias("_by"), F.col("_pid").alias("_p"),
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    local = ranged.withColumn("_local", F.row_number().over(Window.partitionBy("_pid", by).orderBy(*order)))
    # offsets have one row per (partition, group); Spark broadcasts them only under its size threshold
    return (local.join(offsets, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_pid") == F.col("_p")))
            .withColumn(out, (F.col("_off") + F.col("_local") - 1).cast("long"))
            .drop("_pid", "_local", "_by", "_p", "_off"))


def string_index(df: DataFrame, columns: Sequence[str], *, total: str = "total") -> DataFrame:
    """``column_name, value, index, total`` for every non-NULL value of every column."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                      for c in columns])
    counts = (df.select(F.inline(pairs))
              .filter(F.col("value").isNotNull())
              .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias(total)))
    return dense_index(counts, "column_name", [F.col(total).desc(), F.col("value").asc()])
