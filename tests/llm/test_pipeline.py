"""Every stage of the pipeline against SQL or brute force on the rows that the stage before it kept."""

from __future__ import annotations

import collections

import duckdb
import llm_brute as brute
import pyarrow as pa
import pytest
from conftest import SF_SMALL

import corpus_pipeline
from popstats.llm import queries as llm

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _sql(key, rows):
    """The operator's SQL over the given documents."""
    con = duckdb.connect()
    con.register("documents", pa.table({c: [r[k] for r in rows] for k, c in enumerate(COLUMNS)}))
    rel = con.sql(llm.ORACLES[key])
    return [dict(zip(rel.columns, r)) for r in rel.fetchall()]


def _bag(rows):
    return collections.Counter(tuple(r[c] for c in COLUMNS) for r in rows)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), []
    out.append(docs.collect())
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_SMALL).write.parquet(str(folder / str(k)))
        docs = spark.read.parquet(str(folder / str(k)))
        out.append(docs.collect())
        assert docs.columns[:5] == COLUMNS and (k == 4 or docs.columns == COLUMNS)
    return out


def test_order_of_stages():
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == [
        "keep_quality", "drop_near_copies", "drop_leaks", "mix_sources", "shard"]


def test_quality(stages):
    before, after = stages[0:2]
    kept = {r["doc_id"] for r in _sql("op9_adaptive_quality_rules", before) if r["kept"]}
    assert _bag(after) == _bag(r for r in before if r.doc_id in kept) and 0 < len(after) < len(before)


def test_near_copies(stages):
    before, after = stages[1:3]
    ids = [r.doc_id for r in before]
    comp = brute.hamming_components(ids, [brute.fingerprint(r.text) for r in before])
    assert _bag(after) == _bag(r for r, c in zip(before, comp) if r.doc_id == c) and len(after) < len(before)


def test_leaks(spark, stages):
    before, after = stages[2:4]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    found = brute.contamination([r.text for r in before], items)
    assert _bag(after) == _bag(r for r, f in zip(before, found) if not f[3])


def test_mix(stages):
    before, after = stages[3:5]
    copies = {r["doc_id"]: r["copies"] for r in _sql("op6_pareto_mixing", before)}
    assert _bag(after) == _bag(r for r in before for _ in range(copies[r.doc_id]))


def test_shards(stages):
    before, after = stages[4:6]
    assert _bag(after) == _bag(before)
    shards, load = collections.defaultdict(set), collections.Counter()
    for r in after:
        shards[r.doc_id].add(r.shard)
        load[r.shard] += len(r.text.encode()) + 1
    assert all(len(s) == 1 for s in shards.values()) and set(load) <= set(range(16))
    assert max(load.values()) <= min(load.values()) + 2 * 2 * max(len(r.text.encode()) for r in after)


def test_run_does_all_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF_SMALL)
    assert got.columns == [*COLUMNS, "shard"] and _bag(got.collect()) == _bag(stages[5])


@pytest.mark.parametrize("rows", [
    [], [(None, None, None, None, None)],
    [(1, "word " * 60, "en", "a", 1), (None, "", None, None, None), (1, "word " * 60, "en", "a", 1)]])
def test_awkward_documents(spark, tmp_path, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_SMALL).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
    assert docs.columns == [*COLUMNS, "shard"]
