"""Quality rules with adaptive thresholds.

Every document gets a few measures in one pass over its whole text.  For
each adaptive measure a mergeable quantile sketch is kept per (lang, source):
counts over logarithmic bins, so merging is addition, the result does not
depend on task order, and a quantile is right to ``ACCURACY`` relative error.
To each group's sketch ``PRIOR`` pseudo-documents are added, placed at as many
quantiles of its language's merged sketch: a small source is judged mostly like
its language, a large one by itself, without a size at which the rule changes.
Languages are not mixed (scripts differ), so a rare one is judged by its own
documents alone.  The quartiles give the group's fences (``q25 - k * spread``,
``q75 + k * spread``), which are joined back to the documents.  The spread is
the interquartile range, but at least the measure's ``SPREADS``: in a uniform
group small differences are no fault.  No cutoff is fixed but the base rule's.

Scale: the text is read once; what is shuffled is one counter per
(group, measure, bin) and task, then one row per document without its text.
The fence table has one row per (lang, source); it is counted and broadcast
beside whole rows only if it is small, and otherwise joined by sort-merge, in
which AQE splits a hot source.

Edge cases: a NULL or empty text has no words and fails the base rule; NULL
lang or source are groups of their own; repeated rows are kept as they are;
an empty table gives an empty result; other columns (of any name) do not
take part and are not returned by ``measure``.  Very long texts are measured
whole.  A document alone in its language lies inside its own fences.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popstats.llm._spark import beside, in_arrow, materialise
from popstats.llm._text import U64, WORD_SPACED, Texts, chain, mix, range_hash, slices

ACCURACY = 0.01
# Fixed value: symbols that count.
SYMBOLS = "#*$%&|<>"
#: The adaptive measures: which side is held against a document, and the least spread of a group.
SPREADS = {
    "symbols_per_word": ("high", 0.05),
    "dup_line_share": ("high", 0.15),
    "repeat_share": ("high", 0.15),
    "mean_word_chars": ("both", 0.5),
}
PRIOR = 32
FENCE = 3.0
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[[ord(c) for c in SYMBOLS]] = True

MEASURES = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"


def _repeats(keys: np.ndarray) -> np.ndarray:
    """True for every key that occurs at least twice."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    same = np.zeros(s.size, bool)
    if s.size > 1:
        eq = s[1:] == s[:-1]
        same[1:] |= eq
        same[:-1] |= eq
    out = np.zeros(keys.size, bool)
    out[order] = same
    return out


def _later(keys: np.ndarray) -> np.ndarray:
    """True for every key equal to an earlier one."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    out = np.zeros(keys.size, bool)
    if s.size > 1:
        out[order[1:]] = s[1:] == s[:-1]
    return out


def text_measures(t: Texts) -> dict[str, np.ndarray]:
    """The measures of every text of a slice."""
    starts, ends, doc = t.spans(WORD_SPACED)
    prefix = t.prefix_hash()
    n_words = np.bincount(doc, minlength=t.n).astype(np.int64)

    char_start = ((t.buf & 0xC0) != 0x80) & WORD_SPACED[t.buf]
    word_chars = t.per_text(np.flatnonzero(char_start))
    n_symbols = t.per_text(np.flatnonzero(_IS_SYMBOL[t.buf]))

    # lines: split at \n, only those with a word
    breaks = np.flatnonzero(t.buf == 0x0A)
    line_start = np.union1d(t.off[:-1], breaks + 1)
    line_start = line_start[line_start < t.buf.size]
    line_doc = t.text_of(line_start)
    next_break = np.concatenate([breaks, [t.buf.size]])[np.searchsorted(breaks, line_start)]
    line_end = np.minimum(next_break, t.off[line_doc + 1])
    worded = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
    line_start, line_end, line_doc = line_start[worded], line_end[worded], line_doc[worded]
    line_key = mix(range_hash(prefix, line_start, line_end) + line_doc.astype(U64) * U64(0x9E3779B97F4A7C15))
    n_lines = np.bincount(line_doc, minlength=t.n).astype(np.int64)
    n_dup = np.bincount(line_doc[_later(line_key)], minlength=t.n).astype(np.int64)

    # three-word windows that occur twice or more in their text
    repeat = np.zeros(t.n, np.int64)
    if starts.size >= 3:
        words = range_hash(prefix, starts, ends)
        inside = doc[2:] == doc[:-2]
        at = np.flatnonzero(inside)
        key = chain(doc[at].astype(U64), words[at], words[at + 1], words[at + 2])
        hit = at[_repeats(key)]
        covered = np.zeros(starts.size, bool)
        for k in range(3):
            covered[hit + k] = True
        repeat = np.bincount(doc[covered], minlength=t.n).astype(np.int64)
    return {"n_words": n_words, "word_chars": word_chars.astype(np.int64), "n_symbols": n_symbols.astype(np.int64),
            "n_lines": n_lines, "n_dup_lines": n_dup, "n_repeat_words": repeat}


def measure(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """One row per document: the ``keep`` columns and the measures of its whole text."""
    fields = {f.name: f.dataType.simpleString() for f in docs.select(*keep).schema.fields}
    schema = ", ".join(f"`{n}` {t}" for n, t in fields.items()) + ", " + MEASURES
    names = [*keep, *(x.split()[0] for x in MEASURES.split(", "))]

    def run(batches):
        for batch in batches:
            for part in slices(batch, text):
                m = text_measures(Texts(part.column(text)))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k) for k in keep), *(pa.array(v, pa.int64()) for v in m.values())], names)

    return in_arrow(docs.select(*dict.fromkeys([*keep, text])), run, schema)


def with_base(measures: DataFrame) -> DataFrame:
    n = F.col("n_words")
    return measures.withColumn(
        "base_failed", (n < MIN_WORDS) | (F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * n))


def _ratios(df: DataFrame) -> DataFrame:
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return (df.withColumn("symbols_per_word", F.col("n_symbols") / words)
            .withColumn("dup_line_share", F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)))
            .withColumn("repeat_share", F.col("n_repeat_words") / words)
            .withColumn("mean_word_chars", F.col("word_chars") / words))


def sketches(df: DataFrame, keys: list[str], values: list[str], accuracy: float = ACCURACY) -> DataFrame:
    """Mergeable quantile sketches: (keys, measure, bin, n).  Adding ``n`` over bins merges two sketches.

    Bin b >= 1 holds values in (gamma^(b-1), gamma^b] * 1e-6; bin 0 holds zero (and below).
    """
    gamma = (1 + accuracy) / (1 - accuracy)
    long = df.select(*keys, F.inline(F.array(*(
        F.struct(F.lit(v).alias("measure"), F.col(v).cast("double").alias("value")) for v in values))))
    scaled = F.col("value") * 1e6
    bin_ = F.when(scaled <= 1, 0).otherwise(F.ceil(F.log(scaled) / float(np.log(gamma)))).cast("int")
    return (long.filter(F.col("value").isNotNull()).groupBy(*keys, "measure", bin_.alias("bin"))
            .agg(F.count(F.lit(1)).alias("n")))


def merge(sketch: DataFrame, keys: list[str]) -> DataFrame:
    return sketch.groupBy(*keys, "measure", "bin").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, keys: list[str], probs: dict[str, float], accuracy: float = ACCURACY) -> DataFrame:
    """(keys, measure, n, one column per prob) from sketches."""
    from pyspark.sql import Window

    gamma = (1 + accuracy) / (1 - accuracy)
    w = Window.partitionBy(*keys, "measure")
    run = sketch.withColumn("below", F.sum("n").over(w.orderBy("bin"))).withColumn("total", F.sum("n").over(w))
    value = F.when(F.col("bin") == 0, 0.0).otherwise(2e-6 * F.pow(F.lit(gamma), F.col("bin")) / (gamma + 1))
    return run.groupBy(*keys, "measure").agg(
        F.max("total").alias("total"),
        *(F.min(F.when(F.col("below") >= p * F.col("total"), value)).alias(c) for c, p in probs.items()))


def with_prior(own: DataFrame, prior: int = PRIOR) -> DataFrame:
    """The sketches of (lang, source) with ``prior`` pseudo-documents at the quantiles of their language."""
    from pyspark.sql import Window

    w = Window.partitionBy("lang", "measure")
    whole = (merge(own, ["lang"]).withColumn("below", F.sum("n").over(w.orderBy("bin")))
             .withColumn("total", F.sum("n").over(w)))
    at = [(i + 0.5) / prior for i in range(prior)]
    points = whole.groupBy("lang", "measure").agg(
        F.array(*(F.min(F.when(F.col("below") >= p * F.col("total"), F.col("bin"))) for p in at)).alias("bins"))
    points = points.select(F.col("lang").alias("l"), F.col("measure").alias("m"), F.explode("bins").alias("bin"))
    groups = own.select("lang", "source", "measure").distinct()
    pseudo = (groups.join(points, F.col("lang").eqNullSafe(F.col("l")) & (F.col("measure") == F.col("m")))
              .select("lang", "source", "measure", "bin", F.lit(1).cast("long").alias("n")))
    return merge(own.select("lang", "source", "measure", "bin", "n").unionByName(pseudo), ["lang", "source"])


def fences(measures: DataFrame, k: float = FENCE, prior: int = PRIOR) -> DataFrame:
    """(lang, source, one high fence per adaptive measure, and a low one where both sides count)."""
    # one pass over the measures feeds both levels
    own = materialise(sketches(_ratios(measures), ["lang", "source"], list(SPREADS)))
    q = quantiles(with_prior(own, prior), ["lang", "source"], {"q1": 0.25, "q3": 0.75})
    cols = []
    for name, (side, least) in SPREADS.items():
        mine, spread = F.col("measure") == name, F.greatest(F.col("q3") - F.col("q1"), F.lit(least))
        cols.append(F.max(F.when(mine, F.col("q3") + k * spread)).alias(f"{name}_high"))
        if side == "both":
            cols.append(F.max(F.when(mine, F.col("q1") - k * spread)).alias(f"{name}_low"))
    return q.groupBy("lang", "source").agg(*cols)


def judge(measures: DataFrame, limits: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """``measures`` plus ``base_failed``, ``kept`` and the fences of each row's group."""
    f = limits.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    joined = _ratios(with_base(measures)).join(
        f, F.col(lang).eqNullSafe(F.col("_lang")) & F.col(source).eqNullSafe(F.col("_source")), "left")
    out = F.lit(False)
    for name, (side, _) in SPREADS.items():
        out = out | F.coalesce(F.col(name) > F.col(f"{name}_high"), F.lit(False))
        if side == "both":
            out = out | F.coalesce(F.col(name) < F.col(f"{name}_low"), F.lit(False))
    return joined.withColumn("kept", ~F.col("base_failed") & ~out).drop("_lang", "_source")


def quality_rules(docs: DataFrame, k: float = FENCE, prior: int = PRIOR) -> DataFrame:
    """Per document: its measures, ``base_failed``, ``kept`` and the fences of its group."""
    m = materialise(measure(docs, ["doc_id", "lang", "source"]), narrow=True)
    return judge(m, fences(m, k, prior))


def quality_filter(docs: DataFrame, k: float = FENCE, prior: int = PRIOR) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns.

    The fences come from a first pass; the second pass measures each row
    again beside its columns and joins the small fence table, so no text is
    shuffled (unless the fence table has more than 100,000 rows).
    """
    names = docs.columns
    safe = [f"_c{i}" for i in range(len(names))]  # an input column may have the name of a measure
    at = {n: safe[names.index(n)] for n in ("text", "lang", "source")}
    limits = materialise(fences(materialise(measure(docs, ["lang", "source"]), narrow=True), k, prior))
    rows = measure(docs.toDF(*safe), safe, at["text"])
    kept = judge(rows, beside(limits), at["lang"], at["source"]).filter("kept")
    return kept.select(*(F.col(s).alias(n) for s, n in zip(safe, names)))
