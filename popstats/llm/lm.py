"""Language-model scores by deleted interpolation of n-gram estimates.

p(w | h) = sum over k of lambda_k(bucket of the context's count) * p_k(w | last k-1 words),
with p_k the maximum-likelihood estimate of order k over the training
documents and p_0 = 1 / (V + 1).  The weights of each bucket of context
frequency (powers of two) are learned by expectation-maximisation on a
held-out part of the training documents (fold ``EM_FOLD``), with the counts of
the other part; the scores then use the counts of all training documents.
Every bucket is learned with ``LEAN`` pseudo-tokens at the weights of all
buckets together, so a bucket with few tokens stays near those and one with
many follows its own; there is no size at which the rule changes.

N-gram counts of all documents are exact (up to 56-bit fingerprints): every
shard sends its distinct n-grams with their counts and gets the corpus counts
back (``exchange``).  The documents that EM is learned on stand in shards of
their own, so that learning moves only those.  What EM needs is a histogram over (bucket, and the
estimates of every order in eighths of an octave), summed in Spark; its size
depends on the number of cells, not on the corpus, and only it and the
weights pass through the driver.

Training documents are those whose crc32(doc_id) modulo ``parts`` is not
``held_out``; every document is scored.

Edge cases: a NULL or empty text is one end token; a NULL doc_id counts as
the empty string for the fold; repeated rows count each time; without any
training document every estimate is 1 / (V + 1) with V = 0; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popstats.llm._spark import release
from popstats.llm._text import LOWER, U64, WORD_SPACED, chain, range_hash
from popstats.llm.exchange import Shard, ask, groups, pack, ranges_for, read, send

EM_FOLD = 0
EM_ROUNDS = 60
LEAN = 200                # held-out tokens, at the weights of all buckets together, that every bucket is given besides its own
FLOOR = 1e-4              # least weight of the uniform estimate
_START, _END = U64(0x5851F42D4C957F2D), U64(0x14057B7EF767814F)
_BINS_PER_OCTAVE = 8
_KEY = ~U64(0xFF)         # the bits of a fingerprint that are sent


def _folds(ids: np.ndarray, null: np.ndarray, parts: int) -> np.ndarray:
    names = [b"" if no else str(i).encode() for i, no in zip(ids.tolist(), null.tolist())]
    return np.array([zlib.crc32(x) % parts for x in names], np.int64)


def _fold(shard: Shard, parts: int) -> np.ndarray:
    return _folds(shard.ids, shard.null, parts)


class Tokens:
    """Tokens of a shard in order, and the n-gram key that ends at each of them, per order."""

    def __init__(self, shard: Shard, order: int):
        t = shard.texts
        t.buf = LOWER[t.raw]
        starts, ends, doc = t.spans(WORD_SPACED)
        h = range_hash(t.prefix_hash(), starts, ends)
        n = np.bincount(doc, minlength=t.n) + 1                       # words and the end token
        self.n_docs, self.n_tokens = t.n, n
        self.doc = np.repeat(np.arange(t.n), n)
        token = np.full(self.doc.size, _END, U64)
        token[np.arange(starts.size) + doc] = h
        self.first = np.cumsum(n) - n
        place = np.arange(token.size) - np.repeat(self.first, n)       # position in the document
        self.keys = [chain(np.full(token.size, 1, U64), token) & _KEY]
        before = [token]
        for k in range(2, order + 1):
            prev = np.empty_like(token)
            prev[k - 1:] = token[:token.size - k + 1]
            prev[place < k - 1] = _START
            before.insert(0, prev)
            self.keys.append(chain(np.full(token.size, k, U64), *before) & _KEY)
        self.place = place


def _entries(tokens: Tokens, k: int):
    """(sorted distinct keys, entry of every token, order, starts)."""
    order, start, of = groups(tokens.keys[k])
    return tokens.keys[k][order][start], of, order, start


def _add(kind: int, keys: np.ndarray, columns: list[np.ndarray], owner: np.ndarray):
    """Corpus counts (all training, held-out part) of every entry; tokens and types of the training part."""
    order, start, of = groups(keys)
    out, total, types = [], 0, 0
    for c in columns:
        sums = np.add.reduceat(c[order], start)
        if not out:
            total, types = int(sums.sum()), int(np.count_nonzero(sums))
        out.append(sums[of])
    return out, total, types


class Counts:
    """Per token: counts of its n-grams and of their contexts, from the answers."""

    def __init__(self, tokens: Tokens, answers: dict, order: int, held_out_part: bool):
        self.grams, self.contexts = [], []
        docs = None
        for k in range(order):
            _, of, _, _ = _entries(tokens, k)
            every, part = answers[k + 1]
            c = (every - part if held_out_part else every)[of]
            if k == 0:
                # every document ends once: the count of the end token is the count of every start context
                docs = c[tokens.first[0] + tokens.n_tokens[0] - 1] if tokens.n_docs else 0
            else:
                context = np.empty_like(c)
                context[1:] = self.grams[k - 1][:-1]
                context[tokens.place == 0] = docs
                self.contexts.append(context)
            self.grams.append(c)


def _bucket(context: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + floor(log2(count))."""
    return np.where(context > 0, np.frexp(np.maximum(context, 1).astype(float))[1], 0)


def _estimates(c: Counts, n: int) -> list[np.ndarray]:
    out = [c.grams[0] / max(n, 1)]
    for gram, context in zip(c.grams[1:], c.contexts):
        out.append(np.where(context > 0, gram / np.maximum(context, 1), 0.0))
    return out


def learn_weights(histogram: list[tuple], order: int, uniform: float, rounds: int = EM_ROUNDS) -> np.ndarray:
    """(65, order + 1) weights per bucket: uniform first, then orders 1.. ; from (bucket, bins.., n) rows."""
    data = np.array(histogram, np.float64).reshape(-1, order + 2)
    bins = data[:, 1:-1]
    p = np.concatenate([np.full((len(data), 1), uniform), np.where(bins >= 0, 2.0 ** (-bins / _BINS_PER_OCTAVE), 0.0)], axis=1)

    def em(rows: np.ndarray, start: np.ndarray, lean: int) -> np.ndarray:
        lam, n = start, data[rows, -1]
        for _ in range(rounds):
            part = p[rows] * lam
            total = part.sum(1, keepdims=True)
            own = (part / np.maximum(total, 1e-300) * n[:, None]).sum(0)
            lam = (own + lean * start) / max(n.sum() + lean, 1e-300)
            lam = np.maximum(lam, np.r_[FLOOR, np.zeros(order)])
            lam /= lam.sum()
        return lam

    everything = em(np.arange(len(data)), np.full(order + 1, 1 / (order + 1)), 0) if len(data) else np.r_[1.0, np.zeros(order)]
    out = np.tile(everything, (65, 1))
    for b in np.unique(data[:, 0]).astype(int) if len(data) else []:
        out[b] = em(np.flatnonzero(data[:, 0] == b), everything, LEAN)
    return out


_SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score(docs: DataFrame, order: int = 2, parts: int = 5, held_out: int = 1) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and the model's log10 probability."""
    spark = docs.sparkSession
    shards = pack(docs, apart=lambda ids, null: _folds(ids, null, parts) == EM_FOLD)
    log2 = ranges_for(shards)

    def emit(shard: Shard):
        tokens = Tokens(shard, order)
        fold = _fold(shard, parts)
        train = (fold != held_out)[tokens.doc]
        part = (fold == EM_FOLD)[tokens.doc] & train
        for k in range(order):
            keys, _, sort, start = _entries(tokens, k)
            yield k + 1, keys, [np.add.reduceat(x[sort].astype(np.int64), start) for x in (train, part)]

    answers = ask(send(shards, emit, log2), _add)
    release(spark)
    totals = answers.filter("kind = 1").agg(F.sum("total"), F.sum("n_keys")).first()
    n_train, vocabulary = (totals[0] or 0), (totals[1] or 0)
    uniform = 1.0 / (vocabulary + 1)
    bin_names = [f"b{k}" for k in range(1, order + 1)]

    def held_out_cells(shard: Shard, reply) -> pa.Table:
        tokens = Tokens(shard, order)
        c = Counts(tokens, reply, order, True)
        chosen = np.flatnonzero((_fold(shard, parts) == EM_FOLD)[tokens.doc] & (EM_FOLD != held_out))
        context = c.contexts[-1] if order > 1 else c.grams[0]
        cols = [_bucket(context)[chosen]]
        for p in _estimates(c, n_train):
            p = p[chosen]
            cols.append(np.where(p > 0, np.rint(-np.log2(np.maximum(p, 1e-300)) * _BINS_PER_OCTAVE), -1).astype(np.int64))
        cells, n = np.unique(np.stack(cols, axis=1), axis=0, return_counts=True)
        return pa.table({"bucket": pa.array(cells[:, 0], pa.int64()),
                         **{b: pa.array(cells[:, k + 1], pa.int64()) for k, b in enumerate(bin_names)},
                         "n": pa.array(n, pa.int64())})

    learn = [x.filter("shard % 2 = 1") for x in (shards, answers)]
    cells = read(*learn, held_out_cells, ", ".join(f"{x} long" for x in ["bucket", *bin_names, "n"]))
    histogram = [tuple(r) for r in cells.groupBy("bucket", *bin_names).agg(F.sum("n").alias("n")).collect()]
    weights = learn_weights(sorted(histogram), order, uniform)
    release(spark)

    def scores(shard: Shard, reply) -> pa.Table:
        tokens = Tokens(shard, order)
        c = Counts(tokens, reply, order, False)
        lam = weights[_bucket(c.contexts[-1] if order > 1 else c.grams[0])]
        p = lam[:, 0] * uniform
        for k, estimate in enumerate(_estimates(c, n_train)):
            p += lam[:, k + 1] * estimate
        base = np.log10((c.grams[0] + 0.5) / (n_train + 0.5 * (vocabulary + 1)))
        add = lambda x: np.add.reduceat(x, tokens.first) if tokens.n_docs else np.zeros(0)
        return pa.table({
            "doc_id": shard.id_column(), "held_out": pa.array(_fold(shard, parts) == held_out),
            "n_tokens": pa.array(tokens.n_tokens.astype(np.int64)),
            "n_known": pa.array(add((c.grams[0] > 0).astype(np.int64)).astype(np.int64)),
            "train_tokens": pa.array(np.full(tokens.n_docs, n_train, np.int64)),
            "base_score": pa.array(add(base).astype(float)), "score": pa.array(add(np.log10(p)).astype(float))})

    return read(shards, answers, scores, _SCORES)
