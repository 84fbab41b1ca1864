"""Association between two categorical columns (N4 second half).

* ``dense_counts`` -- zero-filled (a, b) counts over the top-k values of a;
* ``count_pivot``  -- the same counts, wide: one column per value of a;
* ``contingency_chi2`` -- Pearson's test of independence of a and b;
* ``chi_square_features`` -- the same test of every feature against a label.

The contingency statistic uses the identity
``chi2 = N * (sum over non-zero cells of O^2 / (R * C) - 1)``, so only the
observed cells are ever materialised (the dense matrix is never built),
and row/column margins are joined back as aggregates.  A margin whose number
of values the caller knows to be small (``bounded``) is broadcast, so a few
values do not become a few join tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popstats.functions.chi2 import chi2_p_value
from popstats.operators.ranking import count_by, restrict_to_top_groups


def _top_cells(df: DataFrame, a: str, b: str, k_groups: int, total: str) -> tuple[DataFrame, DataFrame]:
    cells = count_by(df.select(a, b), [a, b], total)
    kept = restrict_to_top_groups(cells, a, k=k_groups, total=total)
    return kept, kept.select(a).distinct()


def dense_counts(df: DataFrame, a: str, b: str, *, k_groups: int = 10, total: str = "total") -> DataFrame:
    """Counts for every (a, b) with a among the top-k values of a and b among
    the values seen with them; missing combinations are 0.

    The asked grid has k rows per distinct b: the k top values (a bounded
    scalar subquery) are exploded onto each distinct b, then the observed
    counts are left-joined.
    """
    kept, top = _top_cells(df, a, b, k_groups, total)
    top_values = top.agg(F.sort_array(F.collect_list(a))).scalar()  # at most k_groups values
    grid = kept.select(b).distinct().select(F.explode(top_values).alias(a), b)
    return grid.join(kept, [a, b], "left").na.fill(0, [total])


def count_pivot(df: DataFrame, row: str, column: str, values: Sequence) -> DataFrame:
    """Wide counts: one row per ``row`` value, one column per given ``column`` value.

    The values are named by the caller, so the source is read once; rows
    with another value (or NULL) in ``column`` are left out and missing
    counts are 0.
    """
    values = list(values)
    return (df.filter(F.col(column).isin(values))
            .groupBy(row).pivot(column, values).agg(F.count(F.lit(1)))
            .na.fill(0, [str(v) for v in values]))


def _chi2(cells: DataFrame, by: list[str], rows: DataFrame, cols: DataFrame, digits: int, p_value: bool) -> DataFrame:
    """Statistics per ``by`` from cells (.., _a, _b, _o) and their margins (.., _a, _r) and (.., _b, _c)."""
    o = F.col("_o").cast("double")
    joined = cells.join(rows, [*by, "_a"]).join(cols, [*by, "_b"])
    sums = joined.groupBy(*by).agg(F.sum("_o").alias("n"),
                                   F.sum(o * o / (F.col("_r").cast("double") * F.col("_c"))).alias("_s"))
    # the margins hold one row per value: count them instead of distinct values over all cells
    # (counting the sums keeps this branch equal to the other ones, so its shuffles are reused)
    nr, nc = (m.groupBy(*by).agg(F.count(v).alias(c)) for m, v, c in ((rows, "_r", "_nr"), (cols, "_c", "_nc")))
    stats = (sums.join(nr, by).join(nc, by) if by
             else sums.withColumn("_nr", nr.scalar()).withColumn("_nc", nc.scalar()))
    # clamp: for an exactly independent table rounding can leave a tiny negative value
    stat = F.greatest(F.col("n") * (F.col("_s") - 1), F.lit(0.0))
    k = F.least(F.col("_nr"), F.col("_nc")) - 1
    out = (stats
           .withColumn("statistic", F.round(stat, digits))
           .withColumn("dof", ((F.col("_nr") - 1) * (F.col("_nc") - 1)).cast("long"))
           .withColumn("cramers_v", F.round(F.sqrt(stat / (F.col("n") * F.nullif(k, F.lit(0)))), digits)))
    if p_value:
        out = out.withColumn("p_value", F.round(chi2_p_value(stat, F.col("dof")), digits))
    return out.select(*by, "statistic", "dof", "cramers_v", "n", *(["p_value"] if p_value else []))


def contingency_chi2(df: DataFrame, a: str, b: str, *, counts: str | None = None, digits: int = 9,
                     p_value: bool = False, bounded: str | None = None) -> DataFrame:
    """Pearson chi-square test of independence between columns a and b.

    One row: ``statistic, dof, cramers_v, n`` (and ``p_value`` when asked).
    Rows with a NULL in a or b are left out.  ``counts`` names a count
    column when ``df`` already holds one row per (a, b) cell; ``bounded``
    names the column (a or b) that is known to have few values.  Doubles are
    rounded to ``digits`` decimals so the result does not depend on
    summation order.  An input without any cell gives a row of NULLs.
    """
    # the same explicit NULL filter on both columns in every branch (cells,
    # row margins, column margins) keeps the three subtrees identical, so
    # the counting shuffle is computed once and reused
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    if counts:
        cells = df.filter(both).select(F.col(a).alias("_a"), F.col(b).alias("_b"), F.col(counts).alias("_o"))
    else:
        cells = count_by(df.filter(both).select(F.col(a).alias("_a"), F.col(b).alias("_b")), ["_a", "_b"], "_o")
    rows = cells.groupBy("_a").agg(F.sum("_o").alias("_r"))
    cols = cells.groupBy("_b").agg(F.sum("_o").alias("_c"))
    if bounded == a:
        rows = F.broadcast(rows)
    if bounded == b:
        cols = F.broadcast(cols)
    return _chi2(cells, [], rows, cols, digits, p_value)


def chi_square_features(df: DataFrame, features: Sequence[str], label: str, *, digits: int = 9) -> DataFrame:
    """Chi-square test of every categorical feature against the label:
    ``feature, statistic, dof, p_value``.

    All features are counted in one pass of (feature, value, label) cells;
    a row is left out of a feature's test only if that feature or the label
    is NULL.  There is no limit on the number of categories and no
    vocabulary on the driver.
    """
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("_a")) for f in features])
    cells = count_by(df.filter(F.col(label).isNotNull()).select(F.inline(pairs), F.col(label).alias("_b"))
                     .filter(F.col("_a").isNotNull()), ["feature", "_a", "_b"], "_o")
    rows = cells.groupBy("feature", "_a").agg(F.sum("_o").alias("_r"))
    cols = cells.groupBy("feature", "_b").agg(F.sum("_o").alias("_c"))
    return _chi2(cells, ["feature"], rows, cols, digits, True).select("feature", "statistic", "dof", "p_value")
