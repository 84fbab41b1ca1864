from __future__ import annotations

import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from popstats.functions.bands import bucketize
from popstats.functions.dates import age_years, clean_dates
from popstats.operators.distribution import age_distribution


def _raw_dates(spark):
    return spark.createDataFrame([
        (1, "12/6/1988"),     # valid
        (2, "01/02/1950"),    # valid, zero padded
        (3, "123/1/1950"),    # day of 3 digits
        (4, "1/2/50"),        # 2-digit year
        (5, "1950-01-02"),    # no slash
        (6, "31/2/1950"),     # impossible
        (7, ""),              # empty
        (8, None),            # NULL
        (9, "29/2/2000"),     # leap day
        (10, "29/2/1900"),    # not a leap year
    ], "id int, date_of_birth string")


def test_clean_dates_states(spark):
    out = clean_dates(_raw_dates(spark), drop_malformed=False)
    got = {r.id: (r.birth_date, r.date_status, r.birth_month, r.birth_year) for r in out.collect()}
    assert got[1] == (dt.date(1988, 6, 12), "ok", 6, 1988)
    assert got[2] == (dt.date(1950, 2, 1), "ok", 2, 1950)
    assert got[9] == (dt.date(2000, 2, 29), "ok", 2, 2000)
    for i in (3, 4, 5, 7, 8):
        assert got[i] == (None, "malformed", None, None), i
    for i in (6, 10):
        assert got[i] == (None, "impossible", None, None), i


def test_clean_dates_defaults_drop_malformed_keep_impossible(spark):
    out = clean_dates(_raw_dates(spark))
    assert sorted(r.id for r in out.collect()) == [1, 2, 6, 9, 10]
    strict = clean_dates(_raw_dates(spark), keep_impossible=False)
    assert sorted(r.id for r in strict.collect()) == [1, 2, 9]


def test_age_years_matches_months_between(spark):
    df = spark.createDataFrame([(dt.date(1950, 12, 31),), (dt.date(1950, 1, 15),), (None,)], "d date")
    out = [r.age for r in age_years(df, "d").collect()]
    assert out[0] == 59.0
    assert out[1] == round((59 * 12 + 11 + 16 / 31) / 12, 2)
    assert out[2] is None


def test_bands_on_every_edge(spark):
    ages = [None, -1.0, 0.0, 18.0, 18.01, 28.0, 38.0, 48.0, 59.0, 59.01, 199.99, 200.0]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(ages)], "id int, age double")
    got = [r.b for r in df.orderBy("id").select(bucketize(F.col("age")).alias("b")).collect()]
    assert got == ["NULL", "NULL", "NULL", "0-18", "19-28", "19-28", "29-38", "39-48", "49-59",
                   "60+", "60+", "NULL"]


def test_age_distribution_denominator(spark):
    df = spark.createDataFrame([(10.0,), (20.0,), (20.0,), (None,)], "age double")
    out = {r.band: (r.total, r.proportion) for r in age_distribution(df).collect()}
    assert out == {"0-18": (1, 0.25), "19-28": (2, 0.5), "NULL": (1, 0.25)}
    # the whole population (e.g. malformed dates included) as denominator
    population = spark.range(8)
    out = {r.band: r.proportion for r in age_distribution(df, population=population).collect()}
    assert out == {"0-18": 0.125, "19-28": 0.25, "NULL": 0.125}
    assert sum(r.total for r in age_distribution(df).collect()) == 4


def test_custom_edges(spark):
    df = spark.createDataFrame([(5.0,), (10.0,), (15.0,)], "x double")
    b = bucketize(F.col("x"), (0, 10, 20), ("low", "high"), null_label="none", last_closed=True)
    assert rows(df.select(b.alias("b")).groupBy("b").count()) == [("high", 1), ("low", 2)]
