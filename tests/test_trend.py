from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from popstats.operators import trend


def _yearly(spark, pairs):
    return spark.createDataFrame(pairs, "year int, total long")


def test_exact_line(spark):
    df = _yearly(spark, [(2000 + i, 100 + 5 * i) for i in range(10)])
    r = trend.yearly_trend(df).first()
    assert (r.slope, r.intercept, r.r2, r.n) == (5.0, 100.0, 1.0, 10)
    f = {x.model: (x.year, x.forecast) for x in trend.next_year_forecast(df).collect()}
    assert f["linear"] == (2010, 150.0)


def test_exact_exponential(spark):
    df = _yearly(spark, [(1900 + i, round(10 * 2 ** i)) for i in range(8)])
    r = trend.yearly_log_trend(df).first()
    assert r.slope == pytest.approx(math.log(2), rel=1e-9)
    assert r.intercept == pytest.approx(math.log(10), rel=1e-9)
    f = {x.model: x.forecast for x in trend.next_year_forecast(df).collect()}
    assert f["log"] == pytest.approx(10 * 2 ** 8, rel=1e-6)


def test_gap_and_origin(spark):
    # a missing year does not shift the index: index = year - first year
    df = _yearly(spark, [(1990, 10), (1991, 12), (1993, 16), (1994, 18)])
    r = trend.yearly_trend(df).first()
    assert (r.slope, r.intercept) == (2.0, 10.0)
    r0 = trend.yearly_trend(df, origin=1980).first()
    assert (r0.slope, r0.intercept) == (2.0, -10.0)


def test_trend_eval_time_split(spark):
    df = _yearly(spark, [(2000 + i, 3 * i + 7) for i in range(10)])
    out = {r.model: r for r in trend.trend_eval(df, test_fraction=0.2).collect()}
    lin = out["linear"]
    assert (lin.n_train, lin.n_test) == (8, 2)
    assert lin.r2 == pytest.approx(1.0) and lin.slope == pytest.approx(3.0)
    assert out["log"].r2 < 1.0


def test_trend_eval_hash_split(spark):
    df = _yearly(spark, [(1900 + i, 2 * i + 1) for i in range(60)])
    out = {r.model: r for r in trend.trend_eval(df, split="hash", seed=2020).collect()}
    lin = out["linear"]
    assert lin.n_train + lin.n_test == 60 and 3 <= lin.n_test <= 25
    assert lin.r2 == pytest.approx(1.0) and lin.slope == pytest.approx(2.0)
    again = {r.model: r for r in trend.trend_eval(df.repartition(7), split="hash", seed=2020).collect()}
    assert again["linear"].n_test == lin.n_test


def test_forecast_single_model(spark):
    df = _yearly(spark, [(2000 + i, 100 + 5 * i) for i in range(10)])
    out = [tuple(r) for r in trend.next_year_forecast(df, model="linear").collect()]
    assert out == [("linear", 2010, 150.0)]


def test_trend_eval_hash_split_against_least_squares(spark):
    """The line of the training years alone, scored on the others; a year without births has no logarithm."""
    pairs = [(1900 + i, (i * i * 37) % 101) for i in range(80)]
    out = {r.model: r for r in trend.trend_eval(_yearly(spark, pairs), split="hash", seed=2020).collect()}
    held = {y: int(hashlib.md5(f"{y}:2020".encode()).hexdigest()[:15], 16) >= int((1 - 0.2) * (1 << 60)) for y, _ in pairs}
    for model, value in (("linear", float), ("log", math.log)):
        rows = [(y - 1900, value(t), held[y]) for y, t in pairs if t > 0 or model == "linear"]
        train, test = ([(x, v) for x, v, h in rows if h == k] for k in (False, True))
        slope, intercept = np.polyfit(*zip(*train), 1)
        mean = sum(v for _, v in test) / len(test)
        r2 = 1 - sum((v - intercept - slope * x) ** 2 for x, v in test) / sum((v - mean) ** 2 for _, v in test)
        r = out[model]
        assert (r.n_train, r.n_test) == (len(train), len(test))
        assert (r.slope, r.intercept, r.r2) == pytest.approx((slope, intercept, r2), abs=1e-6)


@pytest.mark.parametrize("fraction, sizes", [(0.0, (10, 0)), (1.0, None)])
def test_trend_eval_without_test_or_training_years(spark, fraction, sizes):
    df = _yearly(spark, [(2000 + i, 3 * i + 7) for i in range(10)])
    out = trend.trend_eval(df, test_fraction=fraction).collect()
    assert [(r.n_train, r.n_test, r.r2) for r in out] == ([] if sizes is None else [(*sizes, None)] * 2)
