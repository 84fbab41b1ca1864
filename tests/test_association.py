from __future__ import annotations

import math

import pytest
from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from popstats.functions.chi2 import chi2_sf
from popstats.operators import association as a
from popstats.sources.people import load_people


def test_chi2_sf_known_values():
    assert chi2_sf(3.841458820694124, 1) == pytest.approx(0.05, rel=1e-9)
    assert chi2_sf(18.307038053275146, 10) == pytest.approx(0.05, rel=1e-9)
    assert chi2_sf(0.0, 3) == 1.0
    assert chi2_sf(2.0, 2) == pytest.approx(math.exp(-1.0), rel=1e-12)
    assert chi2_sf(200.0, 168) == pytest.approx(0.0459, abs=5e-4)
    for dof in (1e6, 1e8, 1e10):                       # statistic = dof: about one half, never a partial sum
        assert chi2_sf(dof, dof) == pytest.approx(0.5, abs=1e-3)
    assert math.isnan(chi2_sf(1e16, 1e16))
    assert math.isnan(chi2_sf(1.0, 0))


def test_contingency_matches_chisquaretest(spark):
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    from pyspark.ml.stat import ChiSquareTest

    people = load_people(spark, SF_SMALL)
    ours = a.contingency_chi2(people, "address_city", "last_name", p_value=True).first()
    assert ours == a.contingency_chi2(people, "address_city", "last_name", p_value=True, bounded="address_city").first()
    one = a.chi_square_features(people, ["last_name", "gender"], "address_city").filter("feature = 'last_name'").first()
    indexed = StringIndexer(inputCols=["last_name", "address_city"], outputCols=["f", "l"]).fit(people).transform(people)
    vec = VectorAssembler(inputCols=["f"], outputCol="v").transform(indexed)
    ref = ChiSquareTest.test(vec, "v", "l", flatten=True).first()
    assert ours.statistic == pytest.approx(ref.statistic, rel=1e-9) and ours.dof == ref.degreesOfFreedom
    assert ours.p_value == pytest.approx(ref.pValue, rel=1e-6, abs=1e-9)
    assert (one.statistic, one.dof, one.p_value) == (ours.statistic, ours.dof, ours.p_value)
    assert 0 <= ours.cramers_v <= 1


def test_chi_square_of_a_feature_does_not_depend_on_others(spark):
    data = [("a", None, "x"), ("a", "p", "y"), ("b", "p", "x"), ("b", None, "y"), ("a", "q", "x"), ("b", "q", None)]
    df = spark.createDataFrame(data, "f string, g string, l string")
    alone = a.chi_square_features(df, ["f"], "l").first()
    beside = a.chi_square_features(df, ["f", "g"], "l").filter("feature = 'f'").first()
    assert alone == beside


def test_contingency_independent_table(spark):
    # perfectly independent 2x2 counts -> statistic 0
    data = [("a", "x")] * 10 + [("a", "y")] * 20 + [("b", "x")] * 5 + [("b", "y")] * 10
    r = a.contingency_chi2(spark.createDataFrame(data, "p string, q string"), "p", "q", p_value=True).first()
    assert r.statistic == pytest.approx(0.0, abs=1e-9) and r.dof == 1 and r.n == 45
    assert r.p_value == pytest.approx(1.0)


def test_dense_counts_zero_fill(spark):
    data = [("c1", "n1")] * 3 + [("c1", "n2")] + [("c2", "n3")] * 2 + [("c3", "n9")]
    df = spark.createDataFrame(data, "city string, name string")
    out = a.dense_counts(df, "city", "name", k_groups=2)
    assert rows(out, "city", "name", "total") == [
        ("c1", "n1", 3), ("c1", "n2", 1), ("c1", "n3", 0),
        ("c2", "n1", 0), ("c2", "n2", 0), ("c2", "n3", 2)]


def test_count_pivot(spark):
    data = [("c1", "n1")] * 3 + [("c2", "n1")] + [("c2", "n2")] * 2
    df = spark.createDataFrame(data, "city string, name string")
    out = a.count_pivot(df, "name", "city", values=["c1", "c2"])
    assert rows(out, "name", "c1", "c2") == [("n1", 3, 1), ("n2", 0, 2)]


def test_chi_square_features_rows(spark):
    people = load_people(spark, SF_SMALL)
    out = a.chi_square_features(people, ["origin_city", "gender"], "address_city")
    got = {r.feature: r for r in out.collect()}
    assert set(got) == {"origin_city", "gender"}
    # the view plants a dependency of current city on registered city
    assert got["origin_city"].p_value < 1e-6
    assert out.filter(F.col("dof") <= 0).count() == 0
