"""Yearly trend models (H4): linear and exponential (log-linear) fits of a
yearly count, a held-out evaluation and the next year's forecast.

Least squares with one regressor is closed-form, so the fits are the SQL
aggregates ``regr_slope`` / ``regr_intercept`` / ``regr_r2`` -- one pass,
partial aggregation, no driver loop.  The regressor is the year index
``year - origin`` (origin = first year unless given), which keeps the
numbers small.  The yearly table has one row per calendar year (a few
hundred at most), so windows over it are bounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def _origin(counts: DataFrame, year: str, origin: int | None) -> Column:
    if origin is not None:
        return F.lit(origin)
    return counts.agg(F.min(year)).scalar()


def _long(counts: DataFrame, year: str, total: str, origin: int | None) -> DataFrame:
    """One row per (model, year): the index and the modelled value."""
    base = counts.select(F.col(year).alias("year"), F.col(total).cast("double").alias("_t"))
    rows = F.array(
        F.struct(F.lit("linear").alias("model"), F.col("_t").alias("y")),
        F.struct(F.lit("log").alias("model"), F.when(F.col("_t") > 0, F.ln("_t")).alias("y")),
    )
    return (base.select("year", (F.col("year") - _origin(counts, year, origin)).alias("index"),
                        F.inline(rows))
            .filter(F.col("y").isNotNull()))


def _fit(long: DataFrame) -> DataFrame:
    return long.groupBy("model").agg(
        F.regr_slope("y", "index").alias("slope"),
        F.regr_intercept("y", "index").alias("intercept"),
        F.regr_r2("y", "index").alias("r2"),
        F.count(F.lit(1)).alias("n"),
    )


def _fit_one(counts: DataFrame, year: str, total: str, origin: int | None, log: bool,
             digits: int) -> DataFrame:
    fit = _fit(_long(counts, year, total, origin)).filter(F.col("model") == ("log" if log else "linear"))
    return fit.select(*[F.round(c, digits).alias(c) for c in ("slope", "intercept", "r2")], "n")


def yearly_trend(counts: DataFrame, *, year: str = "year", total: str = "total",
                 origin: int | None = None, digits: int = 9) -> DataFrame:
    """Linear fit ``total = intercept + slope * (year - origin)``: slope, intercept, r2, n."""
    return _fit_one(counts, year, total, origin, False, digits)


def yearly_log_trend(counts: DataFrame, *, year: str = "year", total: str = "total",
                     origin: int | None = None, digits: int = 9) -> DataFrame:
    """Exponential (Malthus) fit ``ln(total) = intercept + slope * (year - origin)``."""
    return _fit_one(counts, year, total, origin, True, digits)


def trend_eval(counts: DataFrame, *, year: str = "year", total: str = "total",
               test_fraction: float = 0.2, split: str = "time", seed: int = 2020,
               origin: int | None = None, digits: int = 9) -> DataFrame:
    """Fit both models on training years and score r2 on held-out years.

    ``split='time'`` holds out the last ``ceil(n * test_fraction)`` years
    (the future is predicted from the past); ``split='hash'`` holds out the
    years whose seeded hash falls in the top ``test_fraction`` (the
    reference's random 80/20 split, made reproducible).

    Output per model: ``model, slope, intercept, r2, n_train, n_test``; r2
    is ``1 - SSE / SST`` on the test years, in the model's own scale.
    """
    if split not in ("time", "hash"):
        raise ValueError("split must be 'time' or 'hash'")
    long = _long(counts, year, total, origin)
    if split == "time":
        n = F.count(F.lit(1)).over(Window.partitionBy("model"))
        rn = F.row_number().over(Window.partitionBy("model").orderBy("year"))
        marked = long.withColumn("_test", rn > n - F.ceil(n * F.lit(test_fraction)))
    else:
        from popstats.operators.sampling import key_draw

        marked = long.withColumn("_test", key_draw("year", seed) >= int((1 - test_fraction) * (1 << 60)))
    # the training rows' line, beside every row: no join, so the counts are made and read once
    models = Window.partitionBy("model")
    train_y, test_y = F.when(~F.col("_test"), F.col("y")), F.when(F.col("_test"), F.col("y"))
    beside = (marked.withColumn("slope", F.regr_slope(train_y, F.col("index")).over(models))
              .withColumn("intercept", F.regr_intercept(train_y, F.col("index")).over(models)))
    resid = test_y - (F.col("intercept") + F.col("slope") * F.col("index"))
    scores = beside.groupBy("model", "slope", "intercept").agg(
        F.sum(resid * resid).alias("_sse"),
        (F.var_pop(test_y) * F.count(test_y)).alias("_sst"),
        F.count(train_y).alias("n_train"),
        F.count(test_y).alias("n_test"),
    )
    return (scores.filter(F.col("n_train") > 0)
            .select("model",
                    F.round("slope", digits).alias("slope"),
                    F.round("intercept", digits).alias("intercept"),
                    F.round(1 - F.col("_sse") / F.nullif(F.col("_sst"), F.lit(0.0)), digits).alias("r2"),
                    "n_train", "n_test"))


def next_year_forecast(counts: DataFrame, *, year: str = "year", total: str = "total",
                       origin: int | None = None, model: str | None = None, digits: int = 6) -> DataFrame:
    """Fit the models on all years and forecast the year after the last one:
    ``model, year, forecast`` (the log model's forecast is ``exp`` of its fit).
    ``model`` ('linear' or 'log') keeps one model; both by default."""
    if model not in (None, "linear", "log"):
        raise ValueError("model must be 'linear', 'log' or None")
    long = _long(counts, year, total, origin)
    if model:
        long = long.filter(F.col("model") == model)
    fit = _fit(long)
    last = long.groupBy("model").agg(F.max("year").alias("_last"),
                                     F.max(F.col("year") - F.col("index")).alias("_origin"))
    nxt = F.col("_last") + 1
    value = F.col("intercept") + F.col("slope") * (nxt - F.col("_origin"))
    return (fit.join(last, "model")
            .select("model", nxt.cast("int").alias("year"),
                    F.round(F.when(F.col("model") == "log", F.exp(value)).otherwise(value), digits)
                    .alias("forecast")))
