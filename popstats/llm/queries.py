"""The opN queries: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popstats.llm._spark import load

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@register
def op9_adaptive_quality_rules(spark, sf_dir):
    from popstats.llm.quality import quality_rules

    return quality_rules(load(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "lang", "source", "symbols_per_word", "dup_line_share", "repeat_share", "mean_word_chars")


@register
def op10_simhash_vp_trees(spark, sf_dir):
    from popstats.llm.simhash import near_duplicates

    return near_duplicates(load(spark, sf_dir, "documents"), shingle=3, max_bits=2)


@register
def op2_suffix_array_decontamination(spark, sf_dir):
    from popstats.llm.decontam import contamination

    found = contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


ORACLES["op2_suffix_array_decontamination"] = r"""
WITH low AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents)
, dw AS (SELECT doc_id, regexp_extract_all(x, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM low)
, bw AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark)
, win AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS s FROM (
            SELECT item_id, w, least(len(w), 13) AS m, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i
            FROM bw WHERE len(w) > 0))
, lens AS (SELECT DISTINCT m FROM win)
, grams AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS s FROM (
              SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM dw, lens WHERE len(w) >= m))
, hit AS (SELECT g.doc_id, g.m, g.i, win.item_id FROM grams g JOIN win ON win.m = g.m AND win.s = g.s)
, words AS (SELECT doc_id, count(*) AS n_hit FROM (
              SELECT DISTINCT doc_id, unnest(range(i, i + m)) AS p FROM hit) GROUP BY doc_id)
, items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS l FROM (
              SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(l, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@register
def op4_virtual_slot_sharding(spark, sf_dir):
    from popstats.llm.sharding import shard_documents

    return shard_documents(load(spark, sf_dir, "documents"), n_shards=16,
                           map_path=spark.conf.get("spark.popstats.slotMap.op4", None))


@register
def op6_pareto_mixing(spark, sf_dir):
    from popstats.llm.mixing import length_weight, mix_plan

    return mix_plan(load(spark, sf_dir, "documents"), relative=length_weight).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies")


@register
def op1_two_tier_token_counts(spark, sf_dir):
    import public_tokenizers

    from popstats.llm.token_counts import token_counts

    return token_counts(load(spark, sf_dir, "documents"), str(public_tokenizers.path("byte_bpe_50k.json")))


@register
def op8_ecoc_language_id(spark, sf_dir):
    from popstats.llm.langid import fit, fold, identify

    docs = load(spark, sf_dir, "documents")
    model = fit(docs.filter(fold("doc_id", 3) != 1).select("lang", "text"))
    return identify(docs, model).select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "ambiguous")


@register
def op3_prefix_free_parsing_dedup(spark, sf_dir):
    from popstats.llm.sa_dedup import remove_repeats

    return remove_repeats(load(spark, sf_dir, "documents")).drop("removed")


@register
def op7_deleted_interpolation(spark, sf_dir):
    from popstats.llm.lm import score

    return score(load(spark, sf_dir, "documents"), order=2)


@register
def op5_quotation_linking(spark, sf_dir):
    from popstats.llm.chat import link_quotes

    linked = link_quotes(load(spark, sf_dir, "conversations"))
    return linked.select("conv_id", "turn", "role", "body", "n_quoted", "n_linked", "reply_to", "root_turn", "depth",
                         F.array_join(F.transform("reply_path", lambda x: x.cast("string")), ".").alias("reply_path"))


# ---------------------------------------------------------------- DuckDB SQL

ORACLES["op3_prefix_free_parsing_dedup"] = """
WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents)
, g AS (SELECT doc_id, i, substr(h, 2 * i - 1, 100) AS s FROM (
          SELECT doc_id, h, unnest(range(1, len(h) // 2 - 48)) AS i FROM b WHERE len(h) >= 100))
, m AS (SELECT s, min(doc_id) AS first_doc FROM g GROUP BY s)
, hit AS (SELECT g.doc_id, g.i FROM g JOIN m ON g.s = m.s WHERE m.first_doc < g.doc_id)
, gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM hit)
, runs AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (WHERE before IS NULL OR before < p - 1) AS n_spans FROM (
             SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM gone) GROUP BY doc_id)
, kept AS (SELECT doc_id, string_agg(substr(h, 2 * p - 1, 2), '' ORDER BY p) AS k FROM (
             SELECT doc_id, h, unnest(range(1, len(h) // 2 + 1)) AS p FROM b) x
           WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.doc_id = x.doc_id AND gone.p = x.p) GROUP BY doc_id)
SELECT b.doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(k, ''))) AS kept_sha256
FROM b LEFT JOIN runs ON runs.doc_id = b.doc_id LEFT JOIN kept ON kept.doc_id = b.doc_id
"""

ORACLES["op6_pareto_mixing"] = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                  (CAST('0x' || substr(md5(concat(coalesce(CAST(doc_id AS VARCHAR), text, ''), ':7')), 1, 13) AS BIGINT) + 0.5::DOUBLE)
                    / 4503599627370496::DOUBLE AS u,
                  CASE WHEN size < 100 THEN 1 WHEN size < 400 THEN 2 WHEN size < 1600 THEN 3 ELSE 4 END::DOUBLE AS w FROM documents)
, s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source)
, w AS (SELECT *, [3::DOUBLE, 1::DOUBLE, 2::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM s)
, c AS (SELECT *, 2::DOUBLE * source_size AS cap, 2::DOUBLE * source_size / weight AS full_at FROM w)
, l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - (sum(cap) OVER o - cap))
                    / (sum(weight) OVER () - sum(weight) OVER o + weight) AS level
        FROM c WINDOW o AS (ORDER BY full_at, source NULLS LAST))
, t AS (SELECT source, source_size, CASE WHEN level < full_at THEN weight * max(level) FILTER (WHERE level < full_at) OVER ()
                                         ELSE cap END AS target FROM l)
, r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS ratio FROM t)
, p AS (SELECT *, CAST(floor(ratio + 1e-12::DOUBLE) AS INTEGER) AS certain,
               greatest(ratio - floor(ratio + 1e-12::DOUBLE), 0::DOUBLE) AS p FROM r)
, g AS (SELECT d.source, w, any_value(p * source_size) AS rest, sum(size)::DOUBLE AS s FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
        GROUP BY d.source, w)
, h AS (SELECT source, w, (rest - (sum(s) OVER o - s)) / nullif(sum(w * s) OVER e - (sum(w * s) OVER o - w * s), 0) AS c
        FROM g WINDOW o AS (PARTITION BY source ORDER BY w DESC), e AS (PARTITION BY source))
, f AS (SELECT source, coalesce(max(c) FILTER (WHERE c * w < 1), 0) AS c FROM h GROUP BY source)
, q AS (SELECT d.*, p.source_size, p.target, p.certain, p.p * p.source_size AS rest,
               least(greatest(c * w, 1e-12::DOUBLE), 1 - 1e-12::DOUBLE) AS odds_p
        FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source JOIN f ON d.source IS NOT DISTINCT FROM f.source)
, k AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY (u / (1 - u)) / (odds_p / (1 - odds_p)), doc_id ROWS UNBOUNDED PRECEDING) AS run FROM q)
, x AS (SELECT *, certain + CASE WHEN rest > 0 AND run - size / 2::DOUBLE <= rest THEN 1 ELSE 0 END AS copies FROM k)
SELECT doc_id, size, source_size, target, CAST(copies * size AS BIGINT) AS taken, source, copies FROM x
"""


def _op9_sql() -> str:
    import math

    from popstats.llm.quality import ACCURACY, FENCE, PRIOR, SPREADS

    gamma = (1 + ACCURACY) / (1 - ACCURACY)
    number = lambda x: f"{float(x)!r}::DOUBLE"
    high, low = list(SPREADS), [m for m, (side, _) in SPREADS.items() if side == "both"]
    spread = {m: f"{number(FENCE)} * greatest(q3 - q1, {number(x)})" for m, (_, x) in SPREADS.items()}
    fences = ", ".join([f"max(CASE WHEN measure = '{m}' THEN q3 + {spread[m]} END) AS {m}_high" for m in high]
                       + [f"max(CASE WHEN measure = '{m}' THEN q1 - {spread[m]} END) AS {m}_low" for m in low])
    rejects = " OR ".join([f"coalesce({m} > {m}_high, false)" for m in high] + [f"coalesce({m} < {m}_low, false)" for m in low])
    long = " UNION ALL ".join(f"SELECT lang, source, '{m}' AS measure, {m} AS v FROM ratios" for m in SPREADS)
    return rf"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents)
, lines AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n_dup_lines FROM (
              SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d)
            WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY doc_id)
, win AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM (
            SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS s FROM (
              SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)))
, rep AS (SELECT doc_id, count(*) AS n_repeat_words FROM (
            SELECT DISTINCT doc_id, unnest(range(i, i + 3)) AS p FROM win WHERE n > 1) GROUP BY doc_id)
, m AS (SELECT d.doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
               CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
               coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
        FROM d LEFT JOIN lines ON lines.doc_id = d.doc_id LEFT JOIN rep ON rep.doc_id = d.doc_id)
, ratios AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
                    n_symbols / greatest(n_words, 1)::DOUBLE AS symbols_per_word,
                    n_dup_lines / greatest(n_lines, 1)::DOUBLE AS dup_line_share,
                    n_repeat_words / greatest(n_words, 1)::DOUBLE AS repeat_share,
                    word_chars / greatest(n_words, 1)::DOUBLE AS mean_word_chars FROM m)
, long AS ({long})
, own AS (SELECT lang, source, measure, CASE WHEN v * 1e6 <= 1 THEN 0 ELSE ceil(ln(v * 1e6) / {number(math.log(gamma))}) END AS bin,
                 count(*) AS n FROM long GROUP BY ALL)
, whole AS (SELECT lang, measure, bin, sum(sum(n)) OVER (PARTITION BY lang, measure ORDER BY bin) AS below,
                  sum(sum(n)) OVER (PARTITION BY lang, measure) AS total FROM own GROUP BY lang, measure, bin)
, points AS (SELECT lang, measure, p, min(bin) AS bin FROM whole, (SELECT (unnest(range({PRIOR})) + 0.5::DOUBLE) / {PRIOR} AS p)
             WHERE below >= p * total GROUP BY lang, measure, p)
, mixed AS (SELECT lang, source, measure, bin, sum(n) AS n FROM (
              SELECT lang, source, measure, bin, n FROM own
              UNION ALL SELECT g.lang, g.source, g.measure, p.bin, 1 FROM (SELECT DISTINCT lang, source, measure FROM own) g
                JOIN points p ON g.lang IS NOT DISTINCT FROM p.lang AND g.measure = p.measure) GROUP BY ALL)
, run AS (SELECT *, sum(n) OVER (PARTITION BY lang, source, measure ORDER BY bin) AS below,
                 sum(n) OVER (PARTITION BY lang, source, measure) AS total,
                 CASE WHEN bin = 0 THEN 0::DOUBLE ELSE 2e-6::DOUBLE * pow({number(gamma)}, bin) / ({number(gamma)} + 1::DOUBLE) END AS v FROM mixed)
, chosen AS (SELECT lang, source, measure, min(v) FILTER (WHERE below >= 0.25::DOUBLE * total) AS q1,
                    min(v) FILTER (WHERE below >= 0.75::DOUBLE * total) AS q3 FROM run GROUP BY lang, source, measure)
, fence AS (SELECT lang, source, {fences} FROM chosen GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT ({rejects}) AS kept,
       r.lang, r.source, symbols_per_word, dup_line_share, repeat_share, mean_word_chars
FROM ratios r LEFT JOIN fence f ON r.lang IS NOT DISTINCT FROM f.lang AND r.source IS NOT DISTINCT FROM f.source
"""


ORACLES["op9_adaptive_quality_rules"] = _op9_sql()

ORACLES["op5_quotation_linking"] = r"""
WITH RECURSIVE m AS (
  SELECT row_number() OVER () AS rid, conv_id, coalesce('=' || CAST(conv_id AS VARCHAR), '') AS conv, CAST(turn AS BIGINT) AS turn,
         role, text, coalesce(regexp_matches(text, '(?m)^[ \t]*>'), false) AS q FROM conversations)
, line AS (
  SELECT rid, i, len(regexp_replace(regexp_extract(x, '^([ \t]*>)+'), '[^>]', '', 'g')) AS level,
         regexp_replace(x, '^([ \t]*>)+[ \t]?', '') AS content
  FROM (SELECT rid, unnest(l) AS x, generate_subscripts(l, 1) AS i
        FROM (SELECT rid, string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10)) AS l FROM m WHERE q)))
, marked AS (SELECT *, lead(level) OVER w AS below, CASE WHEN level IS DISTINCT FROM lag(level) OVER w THEN 1 ELSE 0 END AS new
             FROM line WINDOW w AS (PARTITION BY rid ORDER BY i))
, numbered AS (SELECT *, sum(new) OVER (PARTITION BY rid ORDER BY i) AS run FROM marked)
, run AS (SELECT rid, run, level, string_agg(content, chr(10) ORDER BY i) AS passage FROM numbered GROUP BY rid, run, level)
, unquoted AS (
  SELECT rid, regexp_replace(string_agg(content, chr(10) ORDER BY i), '^\s+|\s+$', '', 'g') AS body FROM marked
  WHERE level = 0 AND NOT (regexp_matches(content, '(?i)^on\b.*\bwrote:\s*$') AND coalesce(below, 0) > 0) GROUP BY rid)
, msg AS (SELECT m.*, CASE WHEN q THEN coalesce(body, '') ELSE text END AS body FROM m LEFT JOIN unquoted USING (rid))
, passages AS (
  SELECT conv, turn, rid, run, level, passage, true AS quoting FROM run JOIN m USING (rid) WHERE level > 0 AND turn IS NOT NULL
  UNION ALL SELECT conv, turn, rid, run, 0, passage, false FROM run JOIN m USING (rid) WHERE level = 0 AND turn IS NOT NULL
  UNION ALL SELECT conv, turn, rid, 0, 0, body, false FROM msg WHERE turn IS NOT NULL AND body IS NOT NULL
            AND conv IN (SELECT conv FROM m WHERE q))
, pieces AS (
  SELECT DISTINCT conv, turn, rid, run, level, quoting, piece FROM (
    SELECT *, trim(regexp_replace(lower(x), '[^\p{L}\p{N}]+', ' ', 'g')) AS piece FROM (
      SELECT *, unnest([passage] || regexp_split_to_array(passage, '\n[ \t]*\n')) AS x, 1 AS least FROM passages
      UNION ALL SELECT *, unnest(string_split(passage, chr(10))) AS x, 12 AS least FROM passages)) WHERE length(piece) >= least)
, origin AS (SELECT conv, piece, min(turn) AS origin FROM pieces WHERE NOT quoting GROUP BY conv, piece)
, hits AS (SELECT p.conv, p.turn, p.run, p.level, length(p.piece) AS chars, o.origin
           FROM pieces p JOIN origin o ON o.conv = p.conv AND o.piece = p.piece
           WHERE quoting AND o.origin < p.turn)
, links AS (SELECT conv, turn, count(DISTINCT run) AS n_linked FROM hits GROUP BY conv, turn)
, chosen AS (SELECT conv, turn, origin AS reply_to FROM (
               SELECT *, row_number() OVER (PARTITION BY conv, turn ORDER BY level, chars DESC, origin DESC) AS k FROM hits) WHERE k = 1)
, path AS (
  SELECT conv, turn, reply_to AS up, [reply_to, turn] AS p FROM chosen
  UNION ALL SELECT path.conv, path.turn, c.reply_to, [c.reply_to] || path.p FROM path JOIN chosen c ON c.conv = path.conv AND c.turn = path.up)
, paths AS (SELECT conv, turn, p FROM (
              SELECT *, row_number() OVER (PARTITION BY conv, turn ORDER BY len(p) DESC) AS k FROM path) WHERE k = 1)
, full_path AS (SELECT msg.*, n_linked, reply_to, coalesce(p, CASE WHEN msg.turn IS NULL THEN [] ELSE [msg.turn] END) AS p
                FROM msg LEFT JOIN links ON links.conv = msg.conv AND links.turn = msg.turn
                LEFT JOIN chosen ON chosen.conv = msg.conv AND chosen.turn = msg.turn
                LEFT JOIN paths ON paths.conv = msg.conv AND paths.turn = msg.turn)
SELECT conv_id, turn, role, body, (SELECT count(*) FROM run WHERE run.rid = full_path.rid AND run.level > 0) AS n_quoted,
       coalesce(n_linked, 0) AS n_linked, reply_to, p[1] AS root_turn, CAST(greatest(len(p) - 1, 0) AS BIGINT) AS depth,
       array_to_string(p, '.') AS reply_path
FROM full_path
"""


def _crc32_table() -> str:
    """The 256 steps of CRC-32 (reflected polynomial 0xEDB88320), from their rule."""
    out = []
    for n in range(256):
        for _ in range(8):
            n = (n >> 1) ^ 0xEDB88320 if n & 1 else n >> 1
        out.append(n)
    return "[" + ", ".join(map(str, out)) + "]::BIGINT[]"


# identical rows are numbered; crc32 byte by byte; slots, heaviest first, each to the lightest shard (a recursion over the
# non-empty slots)
ORACLES["op4_virtual_slot_sharding"] = f"""
WITH RECURSIVE m AS (
  SELECT doc_id, coalesce(text, '') AS t, md5(concat(coalesce(CAST(doc_id AS VARCHAR), ''), '|', coalesce(text, ''))) AS digest,
         row_number() OVER (PARTITION BY doc_id, coalesce(text, '')) - 1 AS copy FROM documents)
, d AS (
  SELECT doc_id, t, hex(encode(t)) AS h,
         CAST(CAST('0x' || substr(CASE WHEN copy = 0 THEN digest ELSE md5(concat(digest, '|', copy)) END, 1, 8) AS BIGINT)
              % 8192 AS INTEGER) AS virtual_slot FROM m)
, r AS (SELECT doc_id, virtual_slot, CAST(len(h) // 2 + 1 AS BIGINT) AS size,
               xor(list_reduce([4294967295::BIGINT] || list_transform(range(0, len(h) // 2),
                     lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)),
                   lambda c, b: xor(c // 256, steps[xor(c % 256, b) + 1])), 4294967295::BIGINT) AS text_crc32
        FROM d, (SELECT {_crc32_table()} AS steps))
, w AS (SELECT virtual_slot, CAST(sum(size) AS BIGINT) AS bytes FROM r GROUP BY virtual_slot)
, o AS (SELECT *, row_number() OVER (ORDER BY bytes DESC, virtual_slot) AS k FROM w)
, deal AS (
  SELECT 0::BIGINT AS k, list_transform(range(0, 16), lambda x: 0::BIGINT) AS loads, 0::BIGINT AS shard
  UNION ALL
  SELECT o.k, list_transform(loads, lambda x, i: CASE WHEN i = p THEN x + o.bytes ELSE x END), CAST(p - 1 AS BIGINT)
  FROM (SELECT *, list_position(loads, list_min(loads)) AS p FROM deal) s JOIN o ON o.k = s.k + 1)
SELECT doc_id, size, text_crc32, 'bytes' AS law, CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY r.virtual_slot, doc_id NULLS FIRST, text_crc32, size) - 1 AS slot,
       CAST(NULL AS INTEGER) AS grown_shard, r.virtual_slot
FROM r JOIN o ON o.virtual_slot = r.virtual_slot JOIN deal ON deal.k = o.k
"""


@register
def op11_cross_tokenizer_alignment(spark, sf_dir):
    import public_tokenizers

    from popstats.llm.alignment import alignment

    return alignment(load(spark, sf_dir, "documents"), str(public_tokenizers.path("byte_bpe_50k.json")),
                     str(public_tokenizers.path("piece_bpe_32k.model")))


@register
def op13_hierarchical_best_fit_packing(spark, sf_dir):
    import public_tokenizers

    from popstats.llm.packing import packed

    return packed(load(spark, sf_dir, "documents"), str(public_tokenizers.path("byte_bpe_50k.json")))


@register
def op12_branch_and_bound_repair(spark, sf_dir):
    from popstats.llm.repair import damaged, repaired

    given = load(spark, sf_dir, "conversations")
    return repaired(given, damaged(given))


def _best(*ways: str) -> str:
    """The least (cost, audit, text) of several, NULL ones left out."""
    return f"list_min([{', '.join(ways)}])"


def _after(state: str, cost: str, letter: str, line: str | None) -> str:
    """A state's best after an edit: cost and letter added, and the line if one stays."""
    text = f"{state}.t" if line is None else f"{state}.t || CASE WHEN {state}.t = '' THEN '' ELSE chr(10) END || {line}"
    return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {text}}} END"


def _op12_sql() -> str:
    """Shortest paths over (rows done, state): a recursion that carries the best (cost, audit, text) of the four states."""
    keep = lambda q, initial: (f"CASE WHEN kind != 'forced' AND initial = '{initial}' THEN " + _after(q, "extra", "K", "role || ':' || text") + " END")
    rerole = lambda q, role: "CASE WHEN kind != 'forced' THEN " + _after(q, "3 + extra", "R", f"'{role}:' || text") + " END"
    user = [f(q) for q in ("s0", "s1", "s3") for f in (lambda q: keep(q, "u"), lambda q: rerole(q, "user"))]
    states = {"x0": _after("s0", "4", "D", None), "x1": _best(_after("s1", "4", "D", None), keep("s0", "s")),
              "x2": _best(_after("s2", "4", "D", None), *user),
              "x3": _best(_after("s3", "4", "D", None), keep("s2", "a"), rerole("s2", "assistant"))}
    insert2 = _best("x2", *(_after(q, "3", "I", "'user:'") for q in ("x0", "x1", "x3")))
    insert3 = _best("x3", _after("s2", "3", "I", "'assistant:'"))
    struct = "STRUCT(c BIGINT, a VARCHAR, t VARCHAR)"
    return rf"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         hex(encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))) AS h FROM conversations)
, planted AS (
  SELECT *, xor(list_reduce([4294967295::BIGINT] || list_transform(range(0, len(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)),
                            lambda c, b: xor(c // 256, steps[xor(c % 256, b) + 1])), 4294967295::BIGINT) % 20 AS fault
  FROM given, (SELECT {_crc32_table()} AS steps))
, damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) FROM planted))
, ordered AS (
  SELECT *, substr(role, 1, 1) AS initial, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS k FROM damaged)
, judged AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 'duplicate'
                 WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'sound' END AS state,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY k) AS before FROM ordered)
, counted AS (
  SELECT conv_id, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps, count(*) FILTER (WHERE state = 'blank') AS blank,
         count(*) FILTER (WHERE state = 'duplicate') AS duplicate, count(*) FILTER (WHERE state = 'truncated') AS truncated,
         count(*) FILTER (WHERE before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(k) AS n FROM judged GROUP BY conv_id)
, steps AS (SELECT conv_id, k, role, text, initial, CASE WHEN state IN ('blank', 'duplicate') THEN 'forced' ELSE 'free' END AS kind,
                   CASE WHEN state = 'truncated' THEN 3 ELSE 0 END AS extra FROM judged)
, walk AS (
  SELECT conv_id, 0::BIGINT AS k, {{'c': 0::BIGINT, 'a': '', 't': ''}}::{struct} AS s0, NULL::{struct} AS s1,
         {{'c': 3::BIGINT, 'a': 'I', 't': 'user:'}}::{struct} AS s2, {{'c': 6::BIGINT, 'a': 'II', 't': 'user:' || chr(10) || 'assistant:'}}::{struct} AS s3
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, k, x0 AS s0, x1 AS s1, s2, {insert3} AS s3 FROM (
    SELECT *, {insert2} AS s2 FROM (
      SELECT w.conv_id, p.k, {", ".join(f"({x})::{struct} AS {name}" for name, x in states.items())}
      FROM walk w JOIN steps p ON p.conv_id IS NOT DISTINCT FROM w.conv_id AND p.k = w.k + 1)))
, ended AS (SELECT w.conv_id, CASE WHEN s0 <= s3 THEN s0 ELSE s3 END AS best FROM walk w LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM w.conv_id
            WHERE w.k = coalesce(n, 0))
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, best.c AS cost, best.a AS audit, sha256(best.t) AS repaired_sha256
FROM ended e LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""


ORACLES["op12_branch_and_bound_repair"] = _op12_sql()
