"""Counts, shares and distributions (E2, E3, E4, N2, N6, N7, H4 counts).

All of these are one grouped pass over the input: partial aggregation
before the shuffle, so hot keys cost one row per task.  Where a
denominator is the whole population it is either summed from the (small)
aggregate or taken from a scalar subquery, never from a driver-side count.
Averages are taken over exact integers (ages in hundredths) so results do
not depend on how rows fall into tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from popstats.functions.bands import AGE_EDGES, AGE_LABELS, NULL_BAND, bucketize
from popstats.operators.ranking import count_by, modal_value, top_groups


def row_count(df: DataFrame, *, total: str = "total") -> DataFrame:
    """A1: one row, the number of input rows."""
    return df.agg(F.count(F.lit(1)).alias(total))


def _population(denominator: DataFrame | None) -> Column | None:
    if denominator is None:
        return None
    return denominator.agg(F.count(F.lit(1))).scalar()


def age_distribution(df: DataFrame, age: str = "age", *, edges: Sequence[float] = AGE_EDGES,
                     labels: Sequence[str] = AGE_LABELS, null_label: str = NULL_BAND,
                     population: DataFrame | None = None, digits: int = 3) -> DataFrame:
    """Rows and share per age band: ``band, total, proportion``.

    The share's denominator is every row of ``population`` when given (the
    reference divides by all rows of the dump, malformed dates included),
    else every row of ``df``.  Ages that fall in no band (NULL, <= 0,
    >= the last edge) are counted under ``null_label``.
    """
    bands = (df.select(bucketize(F.col(age), edges, labels, null_label=null_label).alias("band"))
             .groupBy("band").agg(F.count(F.lit(1)).alias("total")))
    denom = _population(population)
    if denom is None:
        # the aggregate has at most len(labels) + 1 rows: a window over it is bounded
        denom = F.sum("total").over(Window.partitionBy())
    return bands.withColumn("proportion", F.round(F.col("total") / denom, digits))


def gender_counts(df: DataFrame, column: str = "gender", *, total: str = "total") -> DataFrame:
    """Rows per code."""
    return count_by(df.select(column), column, total)


def gender_ratio(df: DataFrame, column: str = "gender", *, numerator: str = "M",
                 denominator: str = "F", names: tuple[str, str] = ("male", "female"),
                 ratio: str = "ratio") -> DataFrame:
    """Both counts and their ratio in one pass (NULL when the denominator is 0)."""
    c = F.col(column)
    num = F.count_if(c == numerator)
    den = F.count_if(c == denominator)
    return df.agg(num.alias(names[0]), den.alias(names[1]),
                  (num.cast("double") / F.nullif(den, F.lit(0))).alias(ratio))


def city_aging(df: DataFrame, group: str = "address_city", age: str = "age", *,
               ages: Sequence[int] = (60, 65), thresholds: Sequence[float] = (0.1, 0.07),
               digits: int = 3, flag: str = "aging") -> DataFrame:
    """Per group the row count, average age and the share at or above each age.

    ``flag`` is true when any share, rounded to ``digits``, is strictly
    above its threshold.  NULL ages count in the shares' denominator (all
    rows of the group) but not in the numerators or the average.
    """
    if len(ages) != len(thresholds):
        raise ValueError("one threshold per age")
    a = F.col(age)
    cents = F.round(a * 100).cast("long")
    n = F.count(F.lit(1))
    aggs = [n.alias("count"),
            F.round(F.sum(cents) / (F.count(a) * 100.0), digits).alias("avg_age")]
    shares = []
    for limit in ages:
        name = f"gt_{limit}"
        aggs.append(F.round(F.count_if(a >= limit) / n, digits).alias(name))
        shares.append(name)
    out = df.groupBy(group).agg(*aggs)
    cond = None
    for name, t in zip(shares, thresholds):
        c = F.col(name) > t
        cond = c if cond is None else (cond | c)
    return out.withColumn(flag, cond)


def density(df: DataFrame, key: str, dim: DataFrame, *, area: str = "area", k: int = 10,
            digits: int = 2) -> DataFrame:
    """Rows per key for the top-k keys, divided by the key's area.

    ``dim`` holds ``key`` and ``area``; a key without a row there, or with
    area 0, gets a NULL density.  Only the k top keys are looked up in the
    dimension (semi join against at most k broadcast rows).
    """
    top = top_groups(df.select(key), key, k=k)
    dim_top = dim.select(key, area).join(F.broadcast(top.select(key)), key, "left_semi")
    return (top.join(dim_top, key, "left")
            .withColumn("density", F.round(F.col("total") / F.nullif(F.col(area), F.lit(0)), digits))
            .orderBy(F.col(area).asc_nulls_first(), F.col(key)))


# The two moves of the population question (registered
# district vs current district, registered city vs current city).
MIGRATION_PAIRS = {
    "district": ("origin_district", "address_district"),
    "city": ("origin_city", "address_city"),
}


def migration_share(df: DataFrame, pairs: Mapping[str, tuple[str, str]] = MIGRATION_PAIRS, *,
                    population: DataFrame | None = None, null_safe: bool = False) -> DataFrame:
    """For each named column pair, rows where the two differ and their share.

    Output ``pair, moved, total, proportion``, one row per pair, from one
    aggregate.  With ``null_safe`` a NULL against a value counts as moved.
    """
    aggs = [F.count(F.lit(1)).alias("_n")]
    for name, (a, b) in pairs.items():
        differs = ~F.col(a).eqNullSafe(F.col(b)) if null_safe else F.col(a) != F.col(b)
        aggs.append(F.count_if(differs).alias(f"_m_{name}"))
    one = df.agg(*aggs)
    denom = _population(population)
    total = denom if denom is not None else F.col("_n")
    rows = F.array(*[F.struct(F.lit(name).alias("pair"), F.col(f"_m_{name}").alias("moved"))
                     for name in pairs])
    return (one.select(F.inline(rows), total.alias("total"))
            .withColumn("proportion", F.col("moved") / F.col("total")))


def letter_frequency(df: DataFrame, columns: Sequence[str] = ("first_name", "last_name"), *,
                     total: str = "total") -> DataFrame:
    """Occurrences of every letter (Unicode category L) in the lower-cased
    concatenation of ``columns``: ``letter, total``.

    Non-letters are removed inside the row before the split, so only letters
    become rows; whole texts are processed.
    """
    text = F.concat_ws("", *[F.lower(F.col(c)) for c in columns])
    letters = F.regexp_replace(text, r"\P{L}+", "")
    return (df.select(F.explode(F.split(letters, "")).alias("letter"))
            .filter(F.col("letter") != "")
            .groupBy("letter").agg(F.count(F.lit(1)).alias(total)))


def top_letter(df: DataFrame, columns: Sequence[str] = ("first_name", "last_name")) -> DataFrame:
    """The most frequent letter(s), ties kept."""
    freq = letter_frequency(df, columns)
    w = Window.orderBy(F.col("total").desc())
    return freq.withColumn("_r", F.rank().over(w)).filter(F.col("_r") == 1).drop("_r")


def yearly_counts(df: DataFrame, date: str = "birth_date", *, min_year: int = 1700,
                  year: str = "year", total: str = "total") -> DataFrame:
    """H4: rows per calendar year of ``date``, for years above ``min_year``."""
    y = F.year(F.col(date))
    return (df.select(y.alias(year)).filter(F.col(year) > min_year)
            .groupBy(year).agg(F.count(F.lit(1)).alias(total)))


__all__ = [
    "row_count", "age_distribution", "gender_counts", "gender_ratio", "city_aging", "density",
    "migration_share", "letter_frequency", "top_letter", "yearly_counts", "modal_value",
]
