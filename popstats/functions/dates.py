"""Date text cleaning and age arithmetic, as built-in column expressions.

The dump stores birth dates as ``d/M/yyyy`` text.  Three states are kept
apart instead of failing the job or silently mixing them:

* ``ok``         -- well shaped and a real calendar date;
* ``impossible`` -- well shaped but not a date (31/2/1950): date NULL;
* ``malformed``  -- not of the expected shape (empty, no slashes,
  two-digit year, ISO text...): date NULL.

``try_to_date`` is used because ``to_date`` raises on impossible dates
when ANSI mode is on (the Spark 4 default).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The dump's date layout and its shape test (day and month of
# one or two digits, a four-digit year).
DATE_PATTERN = "d/M/yyyy"
DATE_SHAPE = r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"
# Reference day for ages (the dump's snapshot: end of 2009).
AS_OF = _dt.date(2009, 12, 31)


def parse_date(text: Column, pattern: str = DATE_PATTERN, shape: str = DATE_SHAPE) -> Column:
    """DATE for well-shaped real dates, NULL otherwise."""
    return F.when(text.rlike(shape), F.try_to_date(text, pattern))


def date_status(text: Column, pattern: str = DATE_PATTERN, shape: str = DATE_SHAPE) -> Column:
    well_shaped = F.coalesce(text.rlike(shape), F.lit(False))
    return (F.when(~well_shaped, F.lit("malformed"))
            .when(F.try_to_date(text, pattern).isNull(), F.lit("impossible"))
            .otherwise(F.lit("ok")))


def clean_dates(df: DataFrame, column: str = "date_of_birth", *, out: str = "birth_date",
                pattern: str = DATE_PATTERN, shape: str = DATE_SHAPE,
                keep_impossible: bool = True, drop_malformed: bool = True,
                month: str | None = "birth_month", year: str | None = "birth_year",
                status: str | None = "date_status") -> DataFrame:
    """Add the parsed date (and month, year, status) to ``df``.

    Defaults follow the reference: rows of the wrong shape are removed,
    impossible dates stay with a NULL date.  The shape test is the only
    thing the malformed filter evaluates (a filter is pushed towards the
    scan and would otherwise repeat the parse); the date is parsed once
    and status, month and year are derived from it.
    """
    text = F.col(column)
    well_shaped = F.coalesce(text.rlike(shape), F.lit(False))
    out_df = df.filter(well_shaped) if drop_malformed else df
    out_df = out_df.withColumn(out, parse_date(text, pattern, shape))
    if not keep_impossible:
        out_df = out_df.filter(F.col(out).isNotNull())
    if status:
        out_df = out_df.withColumn(status, F.when(~well_shaped, F.lit("malformed"))
                                   .when(F.col(out).isNull(), F.lit("impossible"))
                                   .otherwise(F.lit("ok")))
    if month:
        out_df = out_df.withColumn(month, F.month(out))
    if year:
        out_df = out_df.withColumn(year, F.year(out))
    return out_df


def age_expr(birth: Column, as_of: _dt.date | str = AS_OF, digits: int = 2) -> Column:
    """Age in years on ``as_of``: ``round(months_between(as_of, birth) / 12, digits)``."""
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    return F.round(F.months_between(F.lit(as_of), birth) / 12, digits)


def age_years(df: DataFrame, column: str = "birth_date", *, as_of: _dt.date | str = AS_OF,
              digits: int = 2, out: str = "age") -> DataFrame:
    """Add the age (DOUBLE, NULL for a NULL date) as column ``out``."""
    return df.withColumn(out, age_expr(F.col(column), as_of, digits))
