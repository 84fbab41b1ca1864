"""Mixing sources to target weights by Pareto order sampling.

Targets: the sources share ``share`` of all words by weight; a source stops
at ``most`` times its own words and the excess is dealt again by weight.  A
source whose target is r times its words takes floor(r) certain copies of
every document; the rest, (r - floor(r)) times its words, is a sample without
replacement.  Document i is included with probability p_i = min(1, c w_i): w_i
is its relative weight (``length_weight``: of a source that has to be cut,
longer documents are likelier to stay; 1 where none is given) and c is solved
for each source so that the expected words are the rest (weights whose c w
reaches 1 are certain).  A document has the rank (u / (1 - u)) / (p_i / (1 - p_i))
with u a hash of its id, and the documents of smallest rank are taken until
their words come nearest to the rest of the target: a sample of fixed size,
with unequal probabilities, the same at every run.  The cut is kept as one place in the order per source, so
taking is a row-wise test.

Scale: only narrow columns are shuffled.  Ranks are cut into ``BINS`` bins
per source; the sums per (source, bin) are a partial aggregation and show
the one bin in which a source's sample ends.  Documents of lower bins are
taken, of higher ones not, and only that bin is put in order, so a source
that holds a third of all rows is spread like any other.

Edge cases: a NULL text has no words and nothing of it is taken; NULL source
is a source of its own, last in order; repeated rows share a draw and, where the
cut falls between them, are told apart by their position in the input; NULL
ids are hashed by text; very long texts are counted whole; relative weights are rounded to two decimals
and held between 0.01 and 100 (a NULL one is 0.01), which bounds their number; an
empty table gives an empty result; extra columns are carried by ``mix`` and
never collide with its own (they are renamed on the way).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from popstats.llm._spark import beside, materialise

WEIGHTS = (3.0, 1.0, 2.0)
BINS = 4096
WORD = r"[^\x20\x09-\x0D]+"


def words(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def length_weight(size: Column) -> Column:
    """The relative weight of a document of ``size`` words: 1 to 4."""
    return F.when(size < 100, 1.0).when(size < 400, 2.0).when(size < 1600, 3.0).otherwise(4.0)


def targets(sources: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size) -> plus weight and target.

    Filling by weight with a cap is a water level: source s gets
    min(most * size, level * weight).  Sorted by most * size / weight, the
    sources below the level are a prefix, found by running sums.
    """
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())  # one row per source
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    w = sources.withColumn("weight", F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(weights) + 1)))
    w = w.withColumn("cap", F.lit(float(most)) * F.col("source_size")).withColumn("full_at", F.col("cap") / F.col("weight"))
    order = Window.partitionBy(F.lit(0)).orderBy("full_at", F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(0))
    w = (w.withColumn("budget", F.lit(float(share)) * F.sum("source_size").over(everything))
         .withColumn("capped_before", F.sum("cap").over(order) - F.col("cap"))
         .withColumn("weight_left", F.sum("weight").over(everything) - F.sum("weight").over(order) + F.col("weight"))
         .withColumn("level", (F.col("budget") - F.col("capped_before")) / F.col("weight_left"))
         .withColumn("open_level", F.max(F.when(F.col("level") < F.col("full_at"), F.col("level"))).over(everything)))
    filled = F.when(F.col("level") < F.col("full_at"), F.col("open_level") * F.col("weight")).otherwise(F.col("cap"))
    return w.select("source", "source_size", "weight", filled.alias("target"))


def drawn(docs: DataFrame, keep: list[str], source: str, text: str, doc_id: str, relative: str | Callable | None,
          seed: int) -> DataFrame:
    """The kept columns (renamed apart by the caller), _source, _size, the draw _u in (0, 1), weight _w, tie-breaks _tie, _at."""
    key = F.concat(F.coalesce(F.col(doc_id).cast("string"), F.col(text), F.lit("")), F.lit(f":{seed}"))
    draw = F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long")  # 52 bits
    size = words(F.col(text))
    weight = relative(size) if callable(relative) else F.col(relative).cast("double") if relative else F.lit(1.0)
    return docs.select(*keep, F.col(source).alias("_source"), size.alias("_size"),
                       ((draw + F.lit(0.5)) / float(1 << 52)).alias("_u"),
                       F.least(F.greatest(F.round(weight, 2), F.lit(0.01)), F.lit(100.0)).alias("_w"),
                       F.xxhash64(doc_id, text).alias("_tie"), F.monotonically_increasing_id().alias("_at"))


def _with_rank(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Join the plan (one row per source) and add each document's rank.

    The plan is broadcast if it has few rows, else the join is a sort-merge
    in which AQE splits a hot source.
    """
    p = F.least(F.greatest(F.col("c") * F.col("_w"), F.lit(1e-12)), F.lit(1 - 1e-12))
    return (rows.join(beside(plan), F.col("_source").eqNullSafe(F.col("_s")))
            .withColumn("_rank", (F.col("_u") / (1 - F.col("_u"))) / (p / (1 - p))))


def _bin():
    """Bin of a rank, by its draw at the source's own odds: uniform over the bins for any p."""
    odds = F.col("_rank") * F.col("odds")
    return F.floor(F.lit(BINS) * odds / (1 + odds)).cast("int")


def _level(kinds: DataFrame, plan: DataFrame) -> DataFrame:
    """(_k: source, c) with sum of min(1, c w) x words = rest over the source's weights.

    If the weights above w are certain, c is what is left of the rest over the
    sum of w x words from w down; the largest such c that keeps w itself
    below 1 is the solution.
    """
    k = kinds.withColumnRenamed("source", "_k").join(plan.select("_s", "rest"), F.col("_k").eqNullSafe(F.col("_s")))
    down = Window.partitionBy("_k").orderBy(F.col("_w").desc())
    every = Window.partitionBy("_k")
    mass, words_ = F.col("_w") * F.col("words"), F.col("words").cast("double")
    below = F.sum(mass).over(every) - (F.sum(mass).over(down) - mass)
    c = (F.col("rest") - (F.sum(words_).over(down) - words_)) / F.nullif(below, F.lit(0.0))
    return (k.withColumn("_c", c).groupBy("_k")
            .agg(F.coalesce(F.max(F.when(F.col("_c") * F.col("_w") < 1, F.col("_c"))), F.lit(0.0)).alias("c")))


def cuts(rows: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(one row per source) its size, target, certain copies, p, and the last place that is sampled.

    The place is (rank, tie); only if some of several identical rows stand on
    either side of the cut does the row position ``_at`` decide among them.
    """
    # as many rows per source as there are weights
    kinds = materialise(rows.groupBy(F.col("_source").alias("source"), "_w").agg(F.sum("_size").alias("words")), narrow=True)
    sums = kinds.groupBy("source").agg(F.sum("words").alias("source_size"))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = (targets(sums, weights, share, most)
            .withColumn("certain", F.floor(ratio + 1e-12).cast("int"))
            .withColumn("p", F.greatest(ratio - F.col("certain"), F.lit(0.0)))
            .withColumn("rest", F.col("p") * F.col("source_size"))
            .withColumn("odds", F.greatest(F.col("p"), F.lit(1e-12)) / F.greatest(1 - F.col("p"), F.lit(1e-12)))
            .withColumnRenamed("source", "_s"))
    plan = materialise(plan.join(_level(kinds, plan), F.col("_s").eqNullSafe(F.col("_k"))).drop("_k"))
    r = _with_rank(rows, plan).withColumn(
        "_bin", _bin())
    bins = r.groupBy("_s", "rest", "_bin").agg(F.sum("_size").alias("n"))
    run = F.sum("n").over(Window.partitionBy("_s").orderBy("_bin"))  # at most BINS rows per source
    edge = (bins.withColumn("run", run).withColumn("before", F.col("run") - F.col("n"))
            .filter((F.col("before") < F.col("rest")) & (F.col("run") >= F.col("rest")))
            .select(F.col("_s").alias("_e"), F.col("_bin").alias("edge_bin"), "before"))
    inside = r.join(edge, F.col("_s").eqNullSafe(F.col("_e")) & (F.col("_bin") == F.col("edge_bin")))
    order = Window.partitionBy("_s").orderBy("_rank", "_tie", "_at").rowsBetween(Window.unboundedPreceding, 0)
    fits = F.col("run") - F.col("_size") / 2.0 <= F.col("rest")
    last = (inside.withColumn("run", F.col("before") + F.sum("_size").over(order))
            .groupBy(F.col("_s").alias("_e")).agg(
                F.max(F.when(fits, F.struct("_rank", "_tie", "_at"))).alias("last"),
                F.min(F.when(~fits, F.struct("_rank", "_tie"))).alias("next"),
                F.min("edge_bin").alias("edge_bin"))
            .withColumn("split", F.coalesce((F.col("next._rank") == F.col("last._rank"))
                                            & (F.col("next._tie") == F.col("last._tie")), F.lit(False))))
    return materialise(plan.join(last, F.col("_s").eqNullSafe(F.col("_e")), "left").drop("_e"))


def _copies(r: DataFrame) -> DataFrame:
    """Adds ``_copies``: certain copies and the sampled one."""
    bin_ = _bin()
    sampled = (F.when(F.col("rest") <= 0, 0)
               .when(F.col("edge_bin").isNull(), 1)     # rounding: all of the source is below its rest
               .when(F.col("last").isNull(), (bin_ < F.col("edge_bin")).cast("int"))
               .otherwise((F.when(F.col("split"), F.struct("_rank", "_tie", "_at") <= F.col("last"))
                           .otherwise(F.struct("_rank", "_tie") <= F.struct("last._rank", "last._tie"))).cast("int")))
    return r.withColumn("_copies", F.col("certain") + sampled)


def mix_plan(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0, relative: str | Callable | None = None,
             seed: int = 7) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, copies, taken."""
    rows = materialise(drawn(docs, ["doc_id"], "source", "text", "doc_id", relative, seed), narrow=True)
    t = _copies(_with_rank(rows, cuts(rows, weights, share, most)))
    return t.select("doc_id", F.col("_source").alias("source"), F.col("_size").alias("size"), "source_size", "target",
                    F.col("_copies").alias("copies"), (F.col("_copies") * F.col("_size")).cast("long").alias("taken"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0, relative: str | Callable | None = None,
        seed: int = 7) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; all columns kept, no text shuffled."""
    names = docs.columns
    safe = [f"_c{i}" for i in range(len(names))]
    of = dict(zip(names, safe))
    weight = relative if callable(relative) else of.get(relative)
    narrow = drawn(docs.toDF(*safe), [], of["source"], of["text"], of["doc_id"], weight, seed)
    table = cuts(materialise(narrow, narrow=True), weights, share, most)
    wide = drawn(docs.toDF(*safe), safe, of["source"], of["text"], of["doc_id"], weight, seed)
    t = _copies(_with_rank(wide, table)).filter("_copies > 0")
    return (t.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
            .select(*(F.col(s).alias(n) for s, n in zip(safe, names))))
