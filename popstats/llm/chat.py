"""Reply-ordered conversations from quoted messages ("> ..."), with DataFrame functions only.

A message's lines are read with their quote level (number of leading ``>``);
maximal runs of one level are passages.  Passages, their paragraphs and their
lines are normalised (lower case, letters and digits only, single spaces) and
hashed.  The same is done with the unquoted text of every message of a
conversation that quotes at all; the first turn that wrote a piece is its
original.  A message replies to the original of its outermost linked quote
(then the longest, then the latest).  Reply paths (turns from the thread's
first message down) order a conversation depth first; a message without a
linked quote starts a thread at its turn.  Quoted lines and attribution
lines directly above them are removed from the text.

Scale: pieces are pre-aggregated to (conversation, hash, first turn) before
they are joined, so a line that everyone writes is one row per conversation;
joins are on (conversation, hash) or (conversation, turn), so a conversation
with a third of all rows is spread.  Paths are found by pointer doubling, in
log2(longest reply chain) rounds, each written to the checkpoint folder.  No
conversation is collected into one row or task: the result has one row per
message, and sorting by (conv_id, reply_path) gives the reply order.

Edge cases: a NULL text stays NULL and quotes nothing; an empty text is
empty; a message that is all quote has an empty body; a single line of fewer
than ``min_chars`` normalised characters does not link unless it is a whole
passage or paragraph, both as quoted and where it was written; pieces without
letters or digits do not link; NULL conv_ids form one conversation; a NULL turn has no replies, replies to nothing and has an empty
path; several rows with one (conv_id, turn) share their links and each keeps
its own row; very long texts are taken whole; an empty table gives an empty result;
other columns of any name are carried through, but those named like an added one
(body, n_quoted, n_linked, reply_to, root_turn, depth, reply_path) are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from popstats.llm._spark import materialise

_MARK = r"^(?:[ \t]*>)+"
_QUOTES = r"(?m)^[ \t]*>"
ATTRIBUTION = r"(?i)^on\b.*\bwrote:\s*$"
MIN_CHARS = 12


def normalised(x: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(x), r"[^\p{L}\p{N}]+", " "))


def _parsed(text: str) -> Column:
    """array of (level, content) of the lines."""
    lines = F.split(F.regexp_replace(F.col(text), r"\r\n?", "\n"), "\n", -1)
    return F.transform(lines, lambda x: F.struct(
        F.length(F.regexp_replace(F.regexp_extract(x, _MARK, 0), "[^>]", "")).alias("level"),
        F.regexp_replace(x, _MARK + r"[ \t]?", "").alias("content")))


def _runs(parsed: str) -> Column:
    """array of (level, passage): maximal runs of lines of one level."""
    p = F.col(parsed)
    level = lambda i: F.element_at(p, (i + 1).cast("int"))["level"]
    starts = F.filter(F.sequence(F.lit(0), F.size(p) - 1), lambda i: (i == 0) | (level(i) != F.when(i > 0, level(i - 1))))
    ends = F.concat(F.slice(starts, 2, F.greatest(F.size(starts), F.lit(1))), F.array(F.size(p)))
    return F.transform(F.arrays_zip(starts.alias("s"), ends.alias("e")), lambda r: F.struct(
        level(r["s"]).alias("level"),
        F.array_join(F.transform(F.slice(p, (r["s"] + 1).cast("int"), (r["e"] - r["s"]).cast("int")), lambda x: x["content"]),
                     "\n").alias("passage")))


def _pieces(passage: Column, min_chars: int) -> Column:
    """Distinct normalised pieces of a passage: itself and its paragraphs of any length, its lines from ``min_chars`` on."""
    pieces = lambda x, least: F.filter(F.transform(x, normalised), lambda p: F.length(p) >= least)
    return F.array_distinct(F.concat(pieces(F.concat(F.array(passage), F.split(passage, r"\n[ \t]*\n")), 1),
                                     pieces(F.split(passage, r"\n"), max(1, min_chars))))


def _body(parsed: str) -> Column:
    """Unquoted lines, without the attribution line directly above a quote."""
    p = F.col(parsed)
    kept = F.filter(p, lambda x, i: (x["level"] == 0) & ~(
        x["content"].rlike(ATTRIBUTION) & F.coalesce(F.get(p, i + 1)["level"] > 0, F.lit(False))))
    return F.regexp_replace(F.array_join(F.transform(kept, lambda x: x["content"]), "\n"), r"^\s+|\s+$", "")


def _links(m: DataFrame, min_chars: int) -> DataFrame:
    """(_conv, _turn, reply_to, n_linked) of the turns that quote an earlier turn of their conversation."""
    quoting = (m.filter("_quotes and _turn is not null")
               .select("_conv", "_turn", F.posexplode(F.filter("_runs", lambda r: r["level"] > 0)).alias("run", "r"))
               .select("_conv", "_turn", "run", F.col("r.level").alias("level"),
                       F.explode(_pieces(F.col("r.passage"), min_chars)).alias("piece"))
               .select("_conv", "_turn", "run", "level", F.sha2("piece", 256).alias("hash"),
                       F.length("piece").alias("chars")))
    quoting = materialise(quoting)
    own = (m.filter("_turn is not null").join(quoting.select("_conv").distinct(), "_conv", "left_semi")
           .withColumn("own", F.when(~F.col("_quotes"), F.array("_body")).otherwise(F.concat(F.array("_body"), F.transform(
               F.filter("_runs", lambda r: r["level"] == 0), lambda r: r["passage"]))))
           .select("_conv", "_turn", F.explode("own").alias("passage"))
           .select("_conv", "_turn", F.explode(_pieces(F.col("passage"), min_chars)).alias("piece"))
           .groupBy("_conv", F.sha2("piece", 256).alias("hash")).agg(F.min("_turn").alias("origin")))
    hits = quoting.join(own, ["_conv", "hash"]).filter("origin < _turn")
    rank = F.struct(F.col("level"), -F.col("chars"), -F.col("origin"))
    per_run = hits.groupBy("_conv", "_turn", "run").agg(F.min(rank).alias("rank"), F.min_by("origin", rank).alias("origin"))
    return per_run.groupBy("_conv", "_turn").agg(
        F.min_by("origin", "rank").alias("reply_to"), F.count(F.lit(1)).alias("n_linked"))


def _paths(links: DataFrame) -> DataFrame:
    """(_conv, _turn, reply_path) of linked turns, by doubling the distance that every pointer spans."""
    state = materialise(links.select("_conv", "_turn", F.col("reply_to").alias("up"),
                                     F.array("reply_to", "_turn").alias("path")))
    while True:
        above = state.select(F.col("_conv").alias("c"), F.col("_turn").alias("t"), F.col("up").alias("up2"),
                             F.col("path").alias("path2"))
        joined = state.join(above, (F.col("_conv") == F.col("c")) & (F.col("up") == F.col("t")), "left")
        if joined.filter("t is not null").limit(1).count() == 0:
            return state.select("_conv", "_turn", F.col("path").alias("reply_path"))
        # a path starts with the turn its pointer stands at, so the first element is not repeated
        state = materialise(joined.select(
            "_conv", "_turn", F.when(F.col("t").isNull(), F.col("up")).otherwise(F.col("up2")).alias("up"),
            F.when(F.col("t").isNull(), F.col("path")).otherwise(
                F.concat("path2", F.slice("path", F.lit(2), F.size("path")))).alias("path")))


def link_quotes(messages: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Every message's columns, and its ``body`` without quotes, ``n_quoted`` and ``n_linked`` passages,
    ``reply_to`` (turn), ``root_turn``, ``depth`` and ``reply_path``."""
    names = messages.columns
    safe = [f"_c{i}" for i in range(len(names))]
    of = dict(zip(names, safe))
    conv, turn, text = (F.col(of[n]) for n in ("conv_id", "turn", "text"))
    m = (messages.toDF(*safe)
         .withColumn("_conv", F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit("")))
         .withColumn("_turn", turn.cast("long"))
         .withColumn("_quotes", F.coalesce(text.rlike(_QUOTES), F.lit(False)))
         .withColumn("_parsed", F.when(F.col("_quotes"), _parsed(of["text"])))  # only messages that quote are taken apart
         .withColumn("_runs", F.when(F.col("_quotes"), _runs("_parsed")))
         .withColumn("_body", F.when(~F.col("_quotes"), text).otherwise(_body("_parsed"))))
    links = materialise(_links(m, min_chars))
    paths = _paths(links)
    found = links.join(paths, ["_conv", "_turn"]).withColumnsRenamed({"_conv": "_lc", "_turn": "_lt"})
    plain = (m.withColumn("_n_quoted", F.when(F.col("_quotes"), F.size(F.filter("_runs", lambda r: r["level"] > 0)))
                          .otherwise(0).cast("long"))
             .drop("_parsed", "_runs"))
    out = plain.join(found, (F.col("_conv") == F.col("_lc")) & (F.col("_turn") == F.col("_lt")), "left")
    path = F.coalesce("reply_path", F.when(F.col("_turn").isNotNull(), F.array("_turn")), F.array().cast("array<bigint>"))
    own = {"body", "n_quoted", "n_linked", "reply_to", "root_turn", "depth", "reply_path"}
    return out.select(
        *(F.col(s).alias(n) for s, n in zip(safe, names) if n not in own),
        F.col("_body").alias("body"), F.col("_n_quoted").alias("n_quoted"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), "reply_to",
        F.get(path, F.lit(0)).alias("root_turn"), F.greatest(F.size(path) - 1, F.lit(0)).cast("long").alias("depth"),
        path.alias("reply_path"))


def reply_ordered(messages: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``link_quotes``, sorted by conversation and reply path (a range partitioning: a large conversation is split)."""
    return link_quotes(messages, min_chars).orderBy("conv_id", "reply_path")
