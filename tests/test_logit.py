"""Models with a known optimum: Newton steps from one aggregate, weighted fits on patterns (M6, M7)."""

from __future__ import annotations

import numpy as np
import pytest

from popstats.operators import classify, logit


def _rows(n=4000):
    rng = np.random.default_rng(11)
    x = np.round(rng.normal(size=(n, 2)), 1)
    y = (rng.random(n) < 1 / (1 + np.exp(-(0.3 + x @ [1.0, -0.5])))).astype(int)
    return x, y


@pytest.mark.parametrize("ridge", [0.0, 3.0])
def test_coefficients_are_the_optimum(spark, ridge):
    x, y = _rows()
    df = spark.createDataFrame([(float(a), float(b), int(c)) for (a, b), c in zip(x, y)] + [(None, 1.0, 1), (1.0, 1.0, None)], "a double, b double, y int")
    got = {r.term: r.coefficient for r in logit.binary_logit(df, ["a", "b"], "y", ridge=ridge, iterations=12).collect()}
    b = np.array([got[logit.CONSTANT], got["a"], got["b"]])
    wide = np.column_stack([np.ones(len(x)), x])
    slope = wide.T @ (y - 1 / (1 + np.exp(-wide @ b))) - ridge * b * [0, 1, 1]
    assert np.abs(slope).max() < 1e-6


def test_what_has_no_optimum_is_an_error(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1), (2.0, 4.0, 0), (3.0, 6.0, 1)], "a double, b double, y int")
    with pytest.raises(ValueError, match="depend"):
        logit.binary_logit(df, ["a", "b"], "y")
    with pytest.raises(ValueError, match="columns"):
        logit.binary_logit(df, ["a", "b"], "y", max_columns=2)
    with pytest.raises(ValueError, match="complete"):
        logit.binary_logit(df.filter("false"), ["a"], "y")


def test_saturated_model_is_the_conditional_frequency(spark):
    rows = [("x", "a")] * 7 + [("x", "b")] * 3 + [("y", "a")] * 2 + [("y", "b")] * 8 + [("y", "c")] * 10 + [("x", "c")] * 5 + [(None, "a")]
    got = classify.pattern_probabilities(spark.createDataFrame(rows, "v string, y string"), ["v"], "y").collect()
    assert {(r.v, r.y): r.total for r in got} == {("x", "a"): 7, ("x", "b"): 3, ("x", "c"): 5, ("y", "a"): 2, ("y", "b"): 8, ("y", "c"): 10}
    for r in got:
        assert r.probability == pytest.approx(r.total / {"x": 15, "y": 20}[r.v], abs=1e-4)
