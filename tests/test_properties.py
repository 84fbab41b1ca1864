"""Property tests: operators against brute-force pandas/numpy on random frames."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from popstats.operators import association, ranking

_SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

pairs = st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d", None]),
                           st.sampled_from(["x", "y", "z", "w", None])), min_size=1, max_size=60)


def _brute_top_items(data, k, ties):
    df = pd.DataFrame(data, columns=["g", "i"])
    counts = df.groupby(["g", "i"], dropna=False).size().reset_index(name="total")
    counts = counts[counts["i"].notna()]
    out = set()
    for g, grp in counts.groupby("g", dropna=False):
        grp = grp.sort_values(["total", "i"], ascending=[False, True]).reset_index(drop=True)
        if ties == "all":
            ranks = grp["total"].rank(method="min", ascending=False)   # rank(): ties share
        else:
            ranks = pd.Series(range(1, len(grp) + 1))                    # row_number(): item breaks ties
        for (_, row), rank in zip(grp.iterrows(), ranks):
            if rank <= k:
                out.add((None if pd.isna(g) else g, row["i"], int(row["total"]), int(rank)))
    return out


@_SETTINGS
@given(data=pairs, k=st.integers(1, 3), ties=st.sampled_from(["all", "first"]))
def test_top_items_per_group_matches_brute_force(spark, data, k, ties):
    df = spark.createDataFrame(data, "g string, i string")
    got = {tuple(r) for r in ranking.top_items_per_group(df, "g", "i", k=k, ties=ties).collect()}
    assert got == _brute_top_items(data, k, ties)


@_SETTINGS
@given(data=pairs, k=st.integers(1, 3))
def test_top_groups_first_matches_brute_force(spark, data, k):
    df = spark.createDataFrame(data, "g string, i string")
    got = [tuple(r) for r in ranking.top_groups(df, "g", k=k).collect()]
    pdf = pd.DataFrame(data, columns=["g", "i"])
    counts = pdf.groupby("g", dropna=False).size().reset_index(name="total")
    counts["null"] = counts["g"].isna()
    want = counts.sort_values(["total", "null", "g"], ascending=[False, True, True]).head(k)
    assert sorted(got, key=str) == sorted(((None if pd.isna(g) else g, int(t)) for g, t in
                                           zip(want["g"], want["total"])), key=str)


@_SETTINGS
@given(data=pairs)
def test_contingency_matches_numpy(spark, data):
    df = spark.createDataFrame(data, "g string, i string")
    got = association.contingency_chi2(df, "g", "i").first()
    pdf = pd.DataFrame(data, columns=["g", "i"]).dropna()
    if pdf.empty:
        assert got.n is None or got.n == 0
        return
    table = pd.crosstab(pdf["g"], pdf["i"]).to_numpy().astype(float)
    n = table.sum()
    expected = table.sum(1, keepdims=True) * table.sum(0, keepdims=True) / n
    stat = float(((table - expected) ** 2 / expected).sum())
    assert got.n == int(n)
    assert got.dof == (table.shape[0] - 1) * (table.shape[1] - 1)
    assert got.statistic == pytest.approx(max(stat, 0.0), abs=1e-7)
    k = min(table.shape) - 1
    if k > 0:
        assert got.cramers_v == pytest.approx(np.sqrt(stat / (n * k)), abs=1e-7)
    else:
        assert got.cramers_v is None
