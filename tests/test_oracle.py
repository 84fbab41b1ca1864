"""Every registered query against its DuckDB oracle, on the smallest tables.

The driver runs the same comparison at sf0.01; here sf0.001 keeps the
suite quick.  Keys without an oracle must still run and return rows.
"""

from __future__ import annotations

import datetime as dt
import math

import duckdb
import pytest
from conftest import SF_SMALL, plan_text

import __spark_entry__ as entry
from popstats import plans
from popstats.sources.tables import TABLES

# model fits: SQL cannot express them
MODELS = {"classify_eval", "classify_eval_gender", "classify_eval_name", "classify_topk"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return repr(v)


def _canon(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in data)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(plans.oracles()))
def test_query_matches_oracle(spark, con, key):
    df = plans.queries()[key](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    con.execute(f"CREATE OR REPLACE TEMP VIEW _oracle AS {plans.oracles()[key]}")  # the driver makes a view of it too
    rel = con.sql("SELECT * FROM _oracle")
    assert sorted(df.columns) == sorted(rel.columns)
    assert _canon(df.columns, got) == _canon(list(rel.columns), rel.fetchall())


@pytest.mark.parametrize("key", sorted(set(plans.queries()) - set(plans.oracles())))
def test_rows_only_queries_run(spark, key):
    df = plans.queries()[key](spark, SF_SMALL)
    assert df.count() > 0


def test_every_key_has_an_oracle_or_is_non_sql():
    non_sql = set(plans.queries()) - set(plans.oracles())
    assert non_sql == MODELS


def test_entry_smoke(spark):
    out = entry.entry(spark)
    assert out.columns == ["address_city", "birth_month", "total", "rank"]
    assert out.count() > 0


def test_no_python_in_sql_checked_plans(spark):
    for key in sorted(set(plans.oracles()) - {"contingency_chi2_p", "chi_square_features"}):  # p-value of one row per test
        plan = plan_text(plans.queries()[key](spark, SF_SMALL))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, key


_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
          "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("key", sorted(plans.oracles()))
def test_oracle_types_match(spark, con, key):
    df = plans.queries()[key](spark, SF_SMALL)
    rel = con.sql(plans.oracles()[key])
    ours = {n: _TYPES.get(t, t) for n, t in df.dtypes}
    theirs = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    assert ours == theirs
