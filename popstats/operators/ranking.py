"""Counting, top-k and rank operators (E1, E5, E6, N1, N3, N4, N6 top groups).

Plan notes (what keeps these safe when one key holds a third of the rows):

* Counting is always ``groupBy().agg(count)``: partial aggregation runs
  before the shuffle, so a hot key leaves each map task as a single row.
* Top-k over a whole table is ``orderBy().limit()`` (TakeOrderedAndProject:
  every task keeps k rows).  With ties, that gives the k-th count, and every
  group that reaches it is kept by a filter: tied groups stay where they are.
* Top-k inside groups numbers rows over ``partitionBy(group)``; the partial
  WindowGroupLimit trims every map task to k rows per group before rows of a
  hot group meet in one task.  With ties, the at most k counts per group and
  their ranks are joined back to the cells on (group, count).
* Extreme rows are first cut to the extremes of each (group, salt), then to
  those of the group, by joins: tied rows never meet in one task.
* The set of top groups has at most k rows (``ties='first'``), so it is
  broadcast for the semi join with a proven bound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TIES = ("first", "all")


def _as_list(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _check_ties(ties: str) -> None:
    if ties not in TIES:
        raise ValueError(f"ties must be one of {TIES}, got {ties!r}")


def count_by(df: DataFrame, keys: str | Sequence[str], total: str = "total") -> DataFrame:
    """Rows per key combination (NULL is a group of its own)."""
    return df.groupBy(*_as_list(keys)).agg(F.count(F.lit(1)).alias(total))


def _count_items(df: DataFrame, group: list[str], item: list[str], total: str) -> DataFrame:
    """``count_by`` with a column ``_null`` that says whether an item column is NULL.

    The flag is an aggregate, so filtering by it is not pushed below the
    count, and every use of the counts shares one scan and one shuffle.
    """
    null = F.lit(False)
    for c in item:
        null = null | F.col(c).isNull()
    return df.groupBy(*group, *item).agg(F.count(F.lit(1)).alias(total), F.max(null).alias("_null"))


def _flag(cells: DataFrame) -> list[Column]:
    """The flag of ``_count_items`` as a column of group totals, where ``cells`` has it."""
    return [F.max("_null").alias("_any")] if "_null" in cells.columns else []


def _order(total: str, tie_keys: Sequence[str], descending: bool = True) -> list[Column]:
    first = F.col(total).desc() if descending else F.col(total).asc()
    return [first] + [F.col(c).asc_nulls_last() for c in tie_keys]


def top_groups(df: DataFrame, keys: str | Sequence[str], *, k: int = 10, ties: str = "first",
               total: str = "total", counted: bool = False) -> DataFrame:
    """The k key combinations with most rows: ``keys..., total``.

    ``ties='first'`` breaks equal counts by the keys ascending (NULLs last)
    and returns exactly ``min(k, groups)`` rows; ``ties='all'`` keeps every
    group whose rank is within k.  ``counted=True`` means ``df`` already
    holds one row per group with a ``total`` column.
    """
    _check_ties(ties)
    keys = _as_list(keys)
    counts = df if counted else count_by(df, keys, total)
    if ties == "first":
        return counts.orderBy(*_order(total, keys)).limit(k)
    kth = counts.orderBy(F.col(total).desc()).limit(k).agg(F.min(total)).scalar()
    return counts.filter(F.col(total) >= kth)


def top_items_per_group(df: DataFrame, group: str | Sequence[str], item: str | Sequence[str], *,
                        k: int = 3, ties: str = "all", total: str = "total",
                        include_null: bool = False, counted: bool = False) -> DataFrame:
    """Top-k items by row count inside every group: ``group..., item..., total, rank``.

    ``ties='all'`` uses ``rank`` (equal counts share a rank, so a group can
    return more than k rows); ``ties='first'`` uses ``row_number`` ordered
    by count descending then item ascending.  NULL items are dropped unless
    ``include_null``.
    """
    _check_ties(ties)
    group, item = _as_list(group), _as_list(item)
    cells = df if counted else _count_items(df, group, item, total)
    # NULL items sort after every real item, so the real items' ranks are
    # those they would have without NULLs; they are dropped after the window.
    # (A NULL filter before the window would be pushed below the counting
    # aggregation and stop its shuffle from being reused.)
    order = [] if include_null else [F.col(c).isNull().asc() for c in item]
    order += _order(total, item)
    if include_null:
        known = []
    elif "_null" in cells.columns:
        known = [~F.col("_null")]
    else:
        known = [F.col(c).isNotNull() for c in item]
    first = cells.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(
        F.col("rank") <= k)
    for c in known:
        first = first.filter(c)
    if ties == "first":
        return first.drop("_null")
    # at most k rows per group: their distinct counts with the rank each count has
    levels = first.groupBy(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col(total).alias("_t")).agg(
        F.min("rank").alias("rank"))
    on = F.col(total) == F.col("_t")
    for i, g in enumerate(group):
        on = on & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    out = cells.join(levels, on)
    for c in known:
        out = out.filter(c)
    return out.select(*[c for c in cells.columns if c != "_null"], "rank")


def restrict_to_top_groups(cells: DataFrame, group: str, *, k: int = 10, total: str = "total",
                           ties: str = "first") -> DataFrame:
    """Rows of ``cells`` (already counted per group and item) whose group is
    among the k groups with the largest summed ``total``.

    The top keys (unique, at most k rows with ``ties='first'``) are
    broadcast into an inner join; a NULL group is never among them.  An
    inner join is used rather than a semi
    join on purpose: Catalyst would push a semi join below the aggregation
    that produced ``cells``, reading the source a second time, whereas this
    way the shuffle of the counts is reused and the source is read once.
    """
    cells = cells.filter(F.col(group).isNotNull())  # an unknown group is never a top group
    group_totals = cells.groupBy(group).agg(F.sum(total).alias(total), *_flag(cells))
    if "_any" in group_totals.columns:
        group_totals = group_totals.filter(F.col("_any").isNotNull())  # keeps the flag, so both branches share the counts
    top_keys = top_groups(group_totals, group, k=k, ties=ties, total=total, counted=True).select(group)
    if ties == "first":
        top_keys = F.broadcast(top_keys)  # bounded: at most k rows
    return cells.join(top_keys, group, "inner")


def rank_within_topk(df: DataFrame, group: str, item: str | Sequence[str], *, k_groups: int = 10,
                     k_items: int = 2, ties: str = "all", group_ties: str = "first",
                     total: str = "total", include_null: bool = False) -> DataFrame:
    """Top items inside the top groups (N3: months in top cities, N4: names).

    The (group, item) counts are aggregated once; the group totals are
    summed from those counts, the top ``k_groups`` groups restrict them
    (``restrict_to_top_groups``) and a rank filter picks the items.  The
    source is scanned once.  Output: ``group, item..., total, rank``.
    """
    item = _as_list(item)
    cells = _count_items(df, [group], item, total)
    kept = restrict_to_top_groups(cells, group, k=k_groups, total=total, ties=group_ties)
    return top_items_per_group(kept, group, item, k=k_items, ties=ties, total=total,
                               include_null=include_null, counted=True)


def extreme_rows(df: DataFrame, group: str | Sequence[str] | None, order_by: str, *,
                 ascending: bool = True, salts: int = 64) -> DataFrame:
    """All rows holding the minimum (or maximum) of ``order_by`` in each group.

    Ties are kept with every input column (E1: the oldest men).  Rows whose
    ``order_by`` is NULL never match; a NULL group is a group.

    One pass over the source: a rank filter over (group, salt) leaves, through
    a partial WindowGroupLimit, only each task's local extremes to be
    shuffled; the salt (a hash of the whole row) spreads the ties of a hot
    group over ``salts`` tasks.  What is left is joined to its own extreme per
    group.  Both sides of that join hold the same columns, so the shuffle is
    computed once and reused; the result does not depend on that.
    """
    groups = _as_list(group) if group else []
    cols = df.columns
    row_hash = F.xxhash64(*[F.col(c) for c in cols])
    order = F.col(order_by).asc() if ascending else F.col(order_by).desc()
    local = Window.partitionBy(*groups, "_salt").orderBy(order)
    near = (df.filter(F.col(order_by).isNotNull())
            .withColumn("_salt", F.pmod(row_hash, F.lit(salts)))
            .withColumn("_r", F.rank().over(local)).filter(F.col("_r") == 1).drop("_r"))
    pick = F.min(order_by) if ascending else F.max(order_by)
    # _any keeps every column in this branch, so its shuffle is the same as the other one's
    extremes = near.groupBy(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)]).agg(
        pick.alias("_x"), F.max(row_hash).alias("_any")).filter(F.col("_any").isNotNull())
    on = F.col(order_by) == F.col("_x")
    for i, g in enumerate(groups):
        on = on & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return near.join(extremes, on).select(*cols)


def oldest_by_gender(df: DataFrame, *, gender: str = "gender", birth: str = "birth_date",
                     only: str | None = None) -> DataFrame:
    """The person rows with the earliest birth date, per gender code.

    ``only`` restricts to one code (the reference asked for men only).
    """
    if only is not None:
        df = df.filter(F.col(gender) == only)
    return extreme_rows(df, gender, birth, ascending=True)


def modal_value(df: DataFrame, keys: str | Sequence[str], *, total: str = "total") -> DataFrame:
    """The key value(s) with the most rows; every tied value is returned."""
    keys = _as_list(keys)
    counts = count_by(df, keys, total)
    return counts.filter(F.col(total) == counts.agg(F.max(total)).scalar())


def peak_item_by_group(df: DataFrame, group: str, item: str, *, ties: str = "first",
                       include_null: bool = False, total: str = "total") -> DataFrame:
    """E5: the most frequent item per group (month with most births per gender).

    ``ties='first'`` returns one row per group (smallest item on equal
    counts); ``ties='all'`` returns every tied item.
    """
    out = top_items_per_group(df, group, item, k=1, ties=ties, total=total, include_null=include_null)
    return out.drop("rank")


def peak_month_by_gender(df: DataFrame, *, gender: str = "gender", birth: str = "birth_date",
                         ties: str = "first", include_null: bool = False) -> DataFrame:
    months = df.select(gender, F.month(birth).alias("birth_month"))
    return peak_item_by_group(months, gender, "birth_month", ties=ties, include_null=include_null)


def top_names_by_gender(df: DataFrame, *, gender: str = "gender", name: str = "last_name",
                        k: int = 10, ties: str = "first") -> DataFrame:
    """The k most common names in each gender."""
    return top_items_per_group(df.select(gender, name), gender, name, k=k, ties=ties)
