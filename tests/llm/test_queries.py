"""The opN queries on the driver's smallest tables: against their SQL, or against brute force."""

from __future__ import annotations

import collections
import zlib

import duckdb
import llm_brute as brute
import pytest
from conftest import SF_SMALL

from popstats.llm import queries as llm

TABLES = ("documents", "benchmark", "conversations")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}


def run(spark, key):
    return llm.QUERIES[key](spark, SF_SMALL)


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    show = lambda v: round(v, 9) if isinstance(v, float) else v
    return collections.Counter(tuple(repr(show(r[i])) for i in order) for r in rows)


def test_one_query_per_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in llm.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("key", sorted(llm.ORACLES))
def test_query_matches_its_sql(spark, con, key):
    df = run(spark, key)
    con.execute(f"CREATE OR REPLACE TEMP VIEW _oracle AS {llm.ORACLES[key]}")
    rel = con.sql("SELECT * FROM _oracle")
    assert sorted(df.columns) == sorted(rel.columns)
    assert canon(df.columns, df.collect()) == canon(list(rel.columns), rel.fetchall())


def test_op1(spark, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    for r in run(spark, "op1_two_tier_token_counts").collect():
        n = len(whole.encode(texts[r.doc_id].text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].text.encode()), n, n > 512)


def test_op4(spark, texts):
    rows = run(spark, "op4_virtual_slot_sharding").collect()
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    load, slots = collections.Counter(), collections.defaultdict(list)
    for r in rows:
        b = texts[r.doc_id].text.encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(b) + 1, zlib.crc32(b), "bytes", None)
        load[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert set(load) == set(range(16)) and max(load.values()) < 1.1 * min(load.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_op5(spark):
    rows = run(spark, "op5_quotation_linking").collect()
    given = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()
    assert collections.Counter((r.conv_id, r.turn, r.role) for r in rows) == collections.Counter(
        (r.conv_id, r.turn, r.role) for r in given)
    quoting = {(r.conv_id, r.turn) for r in given if any(x.lstrip(" \t").startswith(">") for x in r.text.split("\n"))}
    assert {(r.conv_id, r.turn) for r in rows if r.n_quoted} == quoting
    assert not any(x.startswith(">") for r in rows for x in r.body.split("\n"))


def test_op7(spark, texts):
    from test_operators import check_lm

    check_lm(run(spark, "op7_deleted_interpolation").collect(), [(i, r.text) for i, r in texts.items()])


def test_op8(spark, texts):
    rows = run(spark, "op8_ecoc_language_id").collect()
    assert all(r.held_out == (brute.fold(r.doc_id, 3) == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == texts[r.doc_id].lang for r in held) >= 0.97 * len(held)


def test_op10(spark, texts):
    prints = {i: brute.fingerprint(r.text) for i, r in texts.items()}
    comp = dict(zip(prints, brute.hamming_components(list(prints), list(prints.values()))))
    for r in run(spark, "op10_simhash_vp_trees").collect():
        assert (r.fingerprint, r.component_id) == (f"{prints[r.doc_id]:016x}", comp[r.doc_id])
