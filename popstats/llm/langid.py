"""Language identification by error-correcting output codes over hashed byte n-grams.

Every language gets a codeword of bits; bit b is predicted by a binary
n-gram classifier (log-odds of the n-grams of the languages whose codeword
has a 1 against the others, each language weighing the same).  Decoding is
loss-weighted: a codeword's loss is the weighted sum of its bits' logistic
losses, where a bit weighs, for each language, as much as its classifier was
right on that language's training texts.  The codeword with the least loss
wins, the share it takes of exp(-loss) over all codewords is the score,
and a text whose two nearest codewords are closer than ``AMBIGUOUS`` (or that
disagrees with its codeword in half of the minimum distance) is flagged.

Learning is two passes over all labelled training texts: n-gram counts per
language, then per language and bit how many texts its classifier gets right.
Both are partial sums (one row per task and language and bucket or bit).
The languages x ``BUCKETS`` count table comes to the driver (256 KB a
language) and the weights (``BUCKETS`` x bits) are broadcast; neither grows
with the documents.  More than ``MAX_LANGUAGES`` labels are an error.

Edge cases: a NULL text or one without a letter is ``und`` with score 0; with
no labelled training text every prediction is ``und``; with one language all
others are that language with score 1; rows without a label are predicted
and not learned from; a NULL doc_id counts as the empty string for the fold;
empty tables and repeated or very long texts need no special care; of equal
losses the language that sorts first wins; the label and source columns, and
others of any name, never enter a prediction.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popstats.llm._spark import in_arrow
from popstats.llm._text import LOWER, Texts, slices

BUCKETS = 1 << 15
ORDERS = (2, 3, 4)
SMOOTHING = 0.5
EVIDENCE = 20.0        # n-grams that count as independent evidence, at most
AMBIGUOUS = 0.2        # score distance of the two nearest codewords below which a text is flagged
MAX_LANGUAGES = 500
_STEP = 1 << 20

_LETTER = LOWER.copy()  # letters (and bytes of non-ASCII characters) stay, lower-cased; all else is one separator
_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[0x41:0x5B] = _IS_LETTER[0x61:0x7B] = _IS_LETTER[0x80:] = True
_LETTER[~_IS_LETTER] = 0x20


def fold(doc_id, parts: int):
    """crc32 of doc_id as text, modulo ``parts``."""
    return F.crc32(F.encode(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), "UTF-8")) % parts


def _grams(t: Texts) -> list[np.ndarray]:
    """Per order, the bucket of the n-gram that starts at each byte (``BUCKETS`` where it would leave its text)."""
    b = _LETTER[t.buf].astype(np.uint32)
    out = []
    code = b.copy()
    for k in range(1, max(ORDERS)):
        nxt = np.zeros_like(b)
        nxt[:-k or None] = b[k:] if b.size > k else 0
        code = code * np.uint32(0x01000193) ^ (nxt * np.uint32(0x9E3779B1))
        if k + 1 in ORDERS:
            h = code ^ np.uint32((k + 1) * 0x85EBCA6B & 0xFFFFFFFF)
            h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            g = (h >> np.uint32(17)).astype(np.int32)
            for j in range(1, k + 1):
                last = t.off[1:] - j
                g[last[last >= t.off[:-1]]] = BUCKETS
            out.append(g)
    return out


def _per_text(t: Texts, values: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``values`` (one per byte) over each text."""
    out = np.zeros((t.n, values.shape[1]), np.float64)
    full = np.flatnonzero(np.diff(t.off))
    if full.size:
        out[full] = np.add.reduceat(values, t.off[full], axis=0)
    return out


def _lettered(t: Texts) -> np.ndarray:
    """Which texts hold a letter."""
    ascii_ = t.per_text(np.flatnonzero(_IS_LETTER[t.buf] & (t.buf < 0x80))) > 0
    for i in np.flatnonzero(~ascii_):
        ascii_[i] = any(c.isalpha() for c in t.bytes_of(i).decode("utf-8", "replace"))
    return ascii_


def gram_counts(labelled: DataFrame) -> DataFrame:
    """(lang, bucket, n) over all texts of (lang, text) rows."""

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch):
                t = Texts(part.column("text"))
                langs = part.column("lang").to_pylist()
                grams = _grams(t)
                names = sorted(set(langs))
                number = np.array([names.index(x) for x in langs])
                of_byte = np.repeat(number, t.lengths())
                for k, name in enumerate(names):
                    own = of_byte == k
                    total = sums.setdefault(name, np.zeros(BUCKETS + 1, np.int64))
                    for g in grams:
                        total += np.bincount(g[own], minlength=BUCKETS + 1)
        for name, total in sums.items():
            at = np.flatnonzero(total[:BUCKETS])
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * at.size, pa.string()), pa.array(at, pa.int32()), pa.array(total[at])],
                ["lang", "bucket", "n"])

    parts = in_arrow(labelled.select("lang", "text"), run, "lang string, bucket int, n long")
    return parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def codewords(n: int, seed: int = 11) -> np.ndarray:
    """(n, bits) of 0/1: all splits for few languages, else the best of many random codes of 10 log2(n) bits."""
    if n < 2:
        return np.zeros((n, 0), np.int8)
    if n <= 5:
        splits = np.arange(1, 1 << (n - 1))
        return np.array([[(int(s) >> i) & 1 if i < n - 1 else 0 for s in splits] for i in range(n)], np.int8)
    bits = math.ceil(10 * math.log2(n))
    rng = np.random.Generator(np.random.PCG64(seed))
    best, best_distance = None, -1
    for _ in range(200):
        code = rng.integers(0, 2, (n, bits), dtype=np.int8)
        if (code.sum(0) % n == 0).any():
            continue
        distance = min(int(np.abs(code[i] - code[j]).sum()) for i in range(n) for j in range(i))
        if distance > best_distance:
            best, best_distance = code, distance
    return best


class Model:
    """Languages, codewords, and the (BUCKETS + 1, bits) weights of the binary classifiers."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        self.code = codewords(len(langs))
        p = counts + SMOOTHING
        p = p / p.sum(axis=1, keepdims=True)
        w = np.zeros((BUCKETS + 1, self.code.shape[1]), np.float32)
        for b in range(self.code.shape[1]):
            one = self.code[:, b] == 1
            w[:BUCKETS, b] = np.log(p[one].mean(0)) - np.log(p[~one].mean(0))
        self.weights = w
        d = (self.code[:, None, :] != self.code[None, :, :]).sum(2) + 10_000 * np.eye(len(langs), dtype=int)
        self.distance = int(d.min()) if len(langs) > 1 else 0
        #: per language and bit the weight in decoding; a language's weights have mean 1
        self.trust = np.ones(self.code.shape)

    def weigh(self, right: np.ndarray, texts: np.ndarray) -> None:
        """Set ``trust`` from how many of each language's ``texts`` each bit got ``right`` (one right and one wrong added)."""
        share = (right + 1) / (texts[:, None] + 2)
        self.trust = share / share.mean(1, keepdims=True)

    def margins(self, t: Texts) -> np.ndarray:
        """The bits' log-odds for every text, as much as ``EVIDENCE`` independent n-grams would give."""
        margin = np.zeros((t.n, self.code.shape[1]))
        used = np.zeros(t.n)
        for g in _grams(t):
            used += np.diff(np.concatenate([[0], np.cumsum(g != BUCKETS)])[t.off])
            for a, b in self._steps(t):
                piece = _Window(t, a, b)
                margin[a:b] += _per_text(piece, self.weights[g[t.off[a]:t.off[b]]])
        return margin / np.maximum(used, 1)[:, None] * np.minimum(used, EVIDENCE)[:, None]

    def predict(self, t: Texts) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and ambiguity of every text of a slice."""
        n = t.n
        if not self.langs:
            return ["und"] * n, np.zeros(n), np.zeros(n, bool)
        lettered = _lettered(t)
        if len(self.langs) == 1:
            return [self.langs[0] if x else "und" for x in lettered], lettered.astype(float), ~lettered
        z = self.margins(t)
        sign = 2.0 * self.code - 1
        loss = (np.logaddexp(0, -z[:, None, :] * sign[None, :, :]) * self.trust[None, :, :]).sum(2)
        share = np.exp(loss.min(1, keepdims=True) - loss)
        share /= share.sum(1, keepdims=True)
        best = loss.argmin(1)
        ranked = np.sort(share, axis=1)
        wrong = ((z > 0) != (self.code[best] == 1)).sum(1)
        unsure = (ranked[:, -1] - ranked[:, -2] < AMBIGUOUS) | (2 * wrong >= max(1, self.distance))
        langs = [self.langs[k] if ok else "und" for k, ok in zip(best.tolist(), lettered.tolist())]
        return langs, np.where(lettered, ranked[:, -1], 0.0), unsure | ~lettered

    @staticmethod
    def _steps(t: Texts):
        """Row ranges of about ``_STEP`` bytes (at least one row)."""
        a = 0
        while a < t.n:
            b = max(a + 1, int(np.searchsorted(t.off, t.off[a] + _STEP, side="right")) - 1)
            yield a, min(b, t.n)
            a = min(b, t.n)


class _Window:
    """Offsets of a row range of a slice."""

    def __init__(self, t: Texts, a: int, b: int):
        self.n = b - a
        self.off = t.off[a:b + 1] - t.off[a]


def _hits(labelled: DataFrame, model: Model) -> DataFrame:
    """(lang, bit, n): training texts of every language whose bit is predicted right; bit -1: all texts."""
    shared = labelled.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        n_bits = m.code.shape[1]
        right, of = np.zeros((len(m.langs), n_bits + 1), np.int64), {x: k for k, x in enumerate(m.langs)}
        for batch in batches:
            for part in slices(batch):
                which = np.array([of[x] for x in part.column("lang").to_pylist()])
                ok = (m.margins(Texts(part.column("text"))) > 0) == (m.code[which] == 1)
                np.add.at(right, which, np.column_stack([ok, np.ones(which.size, bool)]))
        lang, bit = np.nonzero(right)
        yield pa.RecordBatch.from_arrays([pa.array([m.langs[k] for k in lang], pa.string()),
                                          pa.array(np.where(bit == n_bits, -1, bit).astype(np.int32)), pa.array(right[lang, bit])],
                                         ["lang", "bit", "n"])

    return in_arrow(labelled.select("lang", "text"), run, "lang string, bit int, n long").groupBy("lang", "bit").agg(F.sum("n").alias("n"))


def fit(labelled: DataFrame) -> Model:
    """A model from (lang, text) rows; rows without a label are left out."""
    labelled = labelled.filter(F.col("lang").isNotNull())
    found = labelled.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    rows = gram_counts(labelled).toPandas()
    langs = sorted(r["lang"] for r in found)
    counts = np.zeros((len(langs), BUCKETS))
    if langs:
        where = {x: k for k, x in enumerate(langs)}
        counts[rows["lang"].map(where).to_numpy(int), rows["bucket"].to_numpy(int)] = rows["n"].to_numpy()
    model = Model(langs, counts)
    if len(langs) > 1:
        right, texts = np.zeros(model.code.shape), np.zeros(len(langs))
        for r in _hits(labelled, model).collect():  # languages x bits
            if r["bit"] < 0:
                texts[where[r["lang"]]] = r["n"]
            else:
                right[where[r["lang"]], r["bit"]] = r["n"]
        model.weigh(right, texts)
    return model


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: doc_id, lang_pred, score, ambiguous; reads only doc_id and text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch in batches:
            for part in slices(batch):
                langs, score, unsure = m.predict(Texts(part.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(langs, pa.string()), pa.array(score, pa.float64()),
                     pa.array(unsure, pa.bool_())], ["doc_id", "lang_pred", "score", "ambiguous"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return in_arrow(docs.select("doc_id", "text"), run,
                    f"doc_id {id_type}, lang_pred string, score double, ambiguous boolean")
