"""Alignment, structure repair and packing against brute force: NULLs, empty and long texts, ties, repeats, empty tables."""

from __future__ import annotations

import collections
import random
import zlib

import llm_brute as brute
import numpy as np
import public_tokenizers
import pytest
from conftest import SF_SMALL

from popstats.llm import alignment, bpe, packing, queries, repair

A, B = (str(public_tokenizers.path(x)) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
ODD = [None, "", " ", "a ▁ b", "x <|endoftext|> <s> <unk> y <|endoftext|>", "é ﬁ 漢字 \0 \n\t  d", "hello world", "hello world", "​٣ ² 🙂",
       "aa" * 3000, " " * 500, "naıve ẞ Ɤ\U0001fae9 \U0001e030", "word, " * 900]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k if k % 5 else None, t, k, k, "x") for k, t in enumerate(ODD)]
    rows += [rows[6], (1, "same id, another text", 0, 0, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, n_a long, row int, sequence_id string").repartition(3)


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(A)


def test_fast_ids_equal_the_library():
    exact = tokenizer()
    vocabulary = [x.decode() for x in bpe.ByteBPE(A, True).bytes if x.isascii()]
    rng = random.Random(2)
    mixed = ["".join(rng.choices(vocabulary, k=30)) for _ in range(300)]
    chars = ["".join(chr(c) for c in range(at, at + 64) if not 0xD800 <= c < 0xE000) for at in range(0, 0x3000, 64)]
    every = [*filter(None, ODD), *vocabulary, *mixed, *chars]
    for added in (True, False):
        exact.encode_special_tokens = not added
        one = bpe.ByteBPE(A, added)
        assert one.fast is not None
        for text, want in zip(every, exact.encode_batch(every, add_special_tokens=False)):
            assert one.ids(text).tolist() == want.ids, text
    assert bpe.ByteBPE(A, True).ids(None).size == 0


def test_characters_on_which_the_libraries_differ_go_to_the_library():
    one = bpe.ByteBPE(A, True)
    one.known.add("q")
    one.odd.add("q")
    one.fast = None
    assert one.ids("quick fox").tolist() == tokenizer().encode("quick fox", add_special_tokens=False).ids


@pytest.mark.parametrize("table_pairs", [1 << 20, 40, 0])
def test_alignment(spark, docs, table_pairs):
    got = alignment.alignment(docs, A, B, table_pairs=table_pairs)
    assert collections.Counter(map(tuple, got.collect())) == brute.align(texts(docs), A, B)


def test_alignment_of_the_given_documents(spark):
    got = queries.QUERIES["op11_cross_tokenizer_alignment"](spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    given = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert collections.Counter(map(tuple, got.collect())) == brute.align(texts(given), A, B)


def test_identity_map_is_by_bytes():
    x = alignment.Aligner(A, B)
    for a, b in enumerate(x.same):
        assert b < 0 or x.bytes_a[a] == x.bytes_b[b]
    assert (x.same >= 0).sum() > 10_000


def test_alignment_of_nothing(spark, docs):
    none = docs.filter("false")
    assert alignment.alignment(none, A, B).collect() == []
    only_null = docs.filter("text IS NULL")
    assert [tuple(r)[1:] for r in alignment.alignment(only_null, A, B).collect()] == [(0, 0, 0, 0, 0, 0, "")]


def test_a_text_of_several_slices(spark):
    long = "".join(random.Random(1).choices(["the ", "tion", "wh\n", "12 ", "é"], k=2_000_000))
    df = spark.createDataFrame([("k", long), ("l", long[:50])], "doc_id string, text string")
    got = {r.doc_id: r for r in alignment.alignment(df, A, B).collect()}
    want = {k[0]: k for k in brute.align([("k", long), ("l", long[:50])], A, B)}
    assert {k: tuple(r) for k, r in got.items()} == want
    ids = tokenizer().encode(long, add_special_tokens=False).ids
    found = sorted(packing.packed(df.filter("doc_id = 'k'"), A).collect(), key=lambda r: r.piece)
    assert sum(r.length for r in found) == len(ids) + 1 and all(r.length == 2048 for r in found[1:])


def check_packing(rows, docs, capacity=2048):
    exact, own, bins, tokens = tokenizer(), collections.Counter(), collections.defaultdict(list), 0
    for i, text in docs:
        ids = [*exact.encode(text or "", add_special_tokens=False).ids, 0]
        tokens += len(ids)
        first = (len(ids) - 1) % capacity + 1
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            own[i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == own
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for placed in bins.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), -(-tokens // capacity)


def test_packing_of_the_given_documents(spark):
    given = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    used, least = check_packing(queries.QUERIES["op13_hierarchical_best_fit_packing"](spark, SF_SMALL).collect(), texts(given))
    assert used <= least + 2


@pytest.fixture()
def many_partitions(spark):
    keys = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("fan", [2, 3, 16])
def test_rounds_of_packing(spark, many_partitions, fan):
    given = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = packing.pack(packing.pieces(given, A), fan=fan).collect()
    assert len({r.sequence_id >> 40 for r in rows}) > 3  # sequences from several nodes
    used, least = check_packing(rows, texts(given))
    assert used <= least + 3


def test_packing_of_odd_documents(spark, docs):
    check_packing(packing.packed(docs, A).collect(), texts(docs))
    assert packing.packed(docs.filter("false"), A).collect() == []
    same = spark.createDataFrame([(1, "one two three")] * 3000, "doc_id long, text string").repartition(4)
    used, least = check_packing(packing.packed(same, A).collect(), texts(same))
    assert used == least


def test_best_fit_by_counts_equals_best_fit_by_item():
    rng = random.Random(7)
    for _ in range(200):
        capacity = rng.choice([10, 64, 2048])
        sizes = [rng.randint(1, capacity) for _ in range(rng.randint(0, 60))]
        free = []
        for s in sorted(sizes, reverse=True):
            fitting = [f for f in free if f >= s]
            if fitting:
                free.remove(min(fitting))
            free.append((min(fitting) if fitting else capacity) - s)
        got = packing.best_fit(dict(collections.Counter(sizes)), capacity)
        assert sorted(capacity - sum(s * k for s, k in c) for n, c in got for _ in range(n)) == sorted(free)
        assert collections.Counter(s for n, c in got for s, k in c for _ in range(n * k)) == collections.Counter(sizes)


def random_turns(rng, n):
    return [(rng.choice([None, 0, 1, 2, 3, 4]), rng.choice(["user", "assistant", "system", "user", "assistant", " ", "", "tool"]),
             rng.choice(["A.", "b", "", "  ", "c!", "d?\n", "e e", f"x{i}."])) for i in range(n)]


def steps_of(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), brute.hashlib.md5(r[2].encode()).hexdigest()))
    steps, seen = [], set()
    for _, role, text in rows:
        body = text.rstrip(repair.BLANKS)
        kind = repair.FORCED if not body or (role, text) in seen else repair.PLAIN if body[-1] in ".!?" else repair.CUT
        seen.add((role, text))
        steps.append((role[:1], kind, 1))
    return steps


def test_search_finds_the_cheapest_and_least_audit():
    rng = random.Random(4)
    for _ in range(1500):
        rows = random_turns(rng, rng.randint(0, 9))
        want = brute.repair(rows)[5:7]
        steps = steps_of(rows)
        assert min(repair.solve(steps, (0,), (0, 3)).values()) == want
        for cut in (1, 2, 3):  # the blocks of a long conversation
            ways = [[{"q": q, "goal": g, "cost": c, "audit": a} for (q, g), (c, a) in repair.solve(steps[i:i + cut]).items()]
                    for i in range(0, len(steps), cut)]
            best = {0: (0, "")}
            for block in ways:
                then = {}
                for w in block:
                    if w["q"] in best:
                        way = (best[w["q"]][0] + w["cost"], best[w["q"]][1] + w["audit"])
                        then[w["goal"]] = min(way, then.get(w["goal"], way))
                best = then
            assert min(best[q] for q in (0, 3) if q in best) == want


def repaired_rows(rows, planted=True):
    own = collections.defaultdict(list)
    for conv, *row in brute.damage(rows) if planted else rows:
        own[conv].append(tuple(row))
    return collections.Counter((c, *brute.repair(own[c])) for c in {r[0] for r in rows})


RESULT = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_repair_of_the_given_conversations(spark):
    given = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.QUERIES["op12_branch_and_bound_repair"](spark, SF_SMALL)
    assert got.columns == RESULT
    assert collections.Counter(map(tuple, got.collect())) == repaired_rows(given)


@pytest.mark.parametrize("block", [2048, 3, 1])
def test_repair_of_odd_conversations(spark, block):
    rng, rows = random.Random(8), []
    for c in [None, *range(30)]:
        for turn, role, text in random_turns(rng, rng.randint(1, 14)):
            rows += [(c, turn, role if rng.random() < 0.9 else None, text if rng.random() < 0.9 else None, 5, "x")] * rng.choice([1, 1, 1, 2, 5])
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, at long, digest string").repartition(5)
    got = repair.repaired(given, repair.damaged(given), block)
    assert collections.Counter(map(tuple, got.select(*RESULT).collect())) == repaired_rows([r[:4] for r in rows])


def test_repair_of_one_long_conversation(spark):
    rng = random.Random(9)
    rows = [("c", k, rng.choice(["user", "assistant"]), rng.choice(["one.", "two", f"turn {k}!", ""])) for k in range(1200)]
    rows += [("c", 5, "user", "again and again.")] * 3000
    given = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string").repartition(4)
    got = repair.repaired(given, given, block=100)
    assert collections.Counter(map(tuple, got.select(*RESULT).collect())) == repaired_rows(rows, planted=False)


def test_repair_of_nothing(spark):
    given = spark.createDataFrame([(1, 0, "user", "hi.")], "conv_id long, turn long, role string, text string")
    assert repair.repaired(given.filter("false"), repair.damaged(given.filter("false"))).collect() == []
    empty = repair.repaired(given, given.filter("false")).collect()
    assert [tuple(r)[:8] for r in empty] == [(1, 0, 0, 0, 0, 0, 0, "")]
    assert empty[0].repaired_sha256 == brute.hashlib.sha256(b"").hexdigest()
