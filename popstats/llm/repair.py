"""Conversation structure repair by depth-first branch and bound.

``damaged`` plants faults in conversations (by a hash of conversation and
turn); ``repaired`` finds, for every conversation, the cheapest edits after
which the roles read ``(s?(ua)+)?`` (an optional system turn, then user and
assistant in turn).  Rows stand by turn (NULLs first), rows of one turn by role
and digest of the text.  Edits: Keep 0, Rerole to user or assistant 3, Delete 4
(the only edit of a blank or repeated row), Insert an empty user or assistant
turn 3; a truncated row that stays adds 3.  Of equally cheap repairs the one
whose edits' initials come first in ASCII is taken.

Search.  A state is what the roles read so far allow (nothing yet, after s,
after u, after a).  ``_search`` walks depth first with an explicit stack and
tries edits in ASCII order.  A prefix is dropped if its cost plus the suffix's
lower bound (the least cost of the remaining rows from this state, whatever
state they end in) is above the incumbent's cost, or if the node's dominance
entry is as cheap: prefixes reach a node in ASCII order, so an earlier one of
equal cost has the smaller audit, and only a cheaper one is followed.  The
stack running empty proves the incumbent (cost, audit) optimal.

Plan.  Only a narrow skeleton (role initial, digest, flags) is shuffled to be
ordered: equal rows of one turn become one with a number, positions are found
by ranges, not per conversation, and ``BLOCK`` rows in order are one task's
unit.  A block is searched from every state to every state; the blocks of a
conversation are then joined by cost and audit, so a conversation that holds a
third of all rows is searched by many tasks.  Texts are moved once, to be
hashed as a stream in their final order: no conversation's texts are held, only
its audit, which is a single cell by contract (as the hash is one chain).

Edge cases: NULLs in any column count as one space (in the hash that chooses the damage,
in roles and in texts); NULL turns come first, and gaps leave them out; NULL
conversation ids are one conversation; empty and blank texts are blank rows;
very long texts pass whole; a repeated row is a duplicate, tied turns are
ordered as above; conversations without rows after damage have zeros, an empty
audit and the hash of the empty string; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from popstats.llm._spark import in_arrow
from popstats.operators.features import dense_index

BLOCK = 2048
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BLANKS = "\t\n\x0b\x0c\r "
_LEGAL = {"su", "ua", "au"}
# States: 0 nothing yet, 1 after s, 2 after u, 3 after a.  Fixed values: the state after a role's initial.
_AFTER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_NEXT = (2, 2, 3, 2)                     # after the user or assistant turn that may follow
_TURN = ("user", "user", "assistant", "user")
_INSERTS = {(0, 2): 1, (0, 3): 2, (1, 2): 1, (1, 3): 2, (2, 2): 0, (2, 3): 1, (3, 3): 0, (3, 2): 1}
FORCED, PLAIN, CUT = 0, 1, 2             # kinds of rows: to be deleted, sound, truncated


def damaged(conversations: DataFrame, parts: int = 20) -> DataFrame:
    """conv_id, turn, role, text, NULL roles and texts as one space, after planted faults (a repeated row is two rows)."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.pmod(F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn"))), F.lit(parts))
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(name("text"), "[.!?]", "")).otherwise(name("text"))
    times = F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (conversations.filter(fault != 0)
            .select("conv_id", "turn", F.when(fault == 4, "user").otherwise(name("role")).alias("role"),
                    text.alias("text"), F.explode(times).alias("_copy")).drop("_copy"))


def _row_order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("digest").asc()]


def skeleton(rows: DataFrame) -> DataFrame:
    """Per distinct row of a turn: conv_id, turn, role, digest, n, kind, blank, and its position in the conversation."""
    trimmed = F.rtrim(F.col("text"), F.lit(BLANKS))
    narrow = rows.select(
        "conv_id", "turn", "role", F.md5("text").alias("digest"),
        F.when(trimmed == "", FORCED).when(F.right(trimmed, F.lit(1)).isin(".", "!", "?"), PLAIN).otherwise(CUT).alias("kind"))
    once = narrow.groupBy("conv_id", "turn", "role", "digest", "kind").agg(F.count(F.lit(1)).alias("n"))
    placed = dense_index(once, "conv_id", _row_order(), out="at")
    first = (placed.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"))
             .agg(F.min("at").alias("first")))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    return placed.join(first, same).withColumn("seen", F.col("at") > F.col("first")).drop("c", "r", "d", "first")


def _bounds(steps: list[tuple]) -> list[tuple]:
    """Of every suffix, the least cost from each state, whatever state it ends in (audits left out)."""
    out = [(0, 0, 0, 0)]
    for initial, kind, n in reversed(steps):
        rest = out[-1]
        if kind == FORCED:
            out.append(tuple(_through_inserts([DELETE * n + rest[q] for q in range(4)])))
            continue
        extra = TRUNCATED if kind == CUT else 0
        costs = []
        for q in range(4):
            ways = [DELETE + rest[q], REROLE + extra + rest[_NEXT[q]]]
            if (q, initial) in _AFTER:
                ways.append(extra + rest[_AFTER[q, initial]])
            costs.append(min(ways))
        out.append(tuple(_through_inserts(costs)))
    return out[::-1]


def _through_inserts(costs: list[int]) -> list[int]:
    for _ in range(2):  # after two inserted turns a state repeats
        costs = [min(costs[q], INSERT + costs[_NEXT[q]]) for q in range(4)]
    return costs


def _edits(step: tuple, q: int):
    """A row's edits from a state, in ASCII order: letters, cost, state after it."""
    initial, kind, n = step
    if kind == FORCED:
        yield "D" * n, DELETE * n, q
        return
    extra = TRUNCATED if kind == CUT else 0
    yield "D", DELETE, q
    if (q, initial) in _AFTER:
        yield "K", extra, _AFTER[q, initial]
    yield "R", REROLE + extra, _NEXT[q]


def _dive(steps: list[tuple], bounds: list[tuple], q: int, goal: int) -> int:
    """The cost of one repair that ends after u or a: the first incumbent."""
    cost = 0
    for i, step in enumerate(steps):
        ways = [(c + bounds[i + 1][to], c, to) for _, c, to in _edits(step, q)]
        ways += [(INSERT + c + bounds[i + 1][to], INSERT + c, to) for _, c, to in _edits(step, _NEXT[q])]
        _, c, q = min(ways)
        cost += c
    return cost + INSERT * (_INSERTS[q, goal])


def _search(steps: list[tuple], bounds: list[tuple], start: int, goal: int) -> tuple[int, str]:
    """The best (cost, audit) from a state to a state after u or a."""
    end = len(steps)
    best, found = _dive(steps, bounds, start, goal), None
    least: dict[tuple[int, int], int] = {}                      # dominance: a node's cheapest prefix
    trail: list[tuple[int, str]] = []                           # letters and the entry before
    stack = [(0, start, 0, -1)]
    while stack:
        i, q, cost, at = stack.pop()
        bound = cost + (bounds[i][q] if i < end else INSERT * _INSERTS[q, goal])
        if bound > best or (bound == best and found is not None) or least.get((i, q), 1 << 62) <= cost:
            continue  # a later prefix must be cheaper than the incumbent, its audit is not smaller
        least[i, q] = cost
        if i == end and q == goal:
            best, found = cost, at
            continue
        moves = [(letters, c, i + 1, to) for letters, c, to in (_edits(steps[i], q) if i < end else ())]
        moves.append(("I", INSERT, i, _NEXT[q]))
        moves.sort(key=lambda m: m[0])
        for letters, c, j, to in reversed(moves):               # the first in ASCII order is on top
            trail.append((at, letters))
            stack.append((j, to, cost + c, len(trail) - 1))
    letters = []
    while found is not None and found >= 0:
        found, x = trail[found]
        letters.append(x)
    return best, "".join(reversed(letters))


def solve(steps: list[tuple], starts=(0, 1, 2, 3), goals=(0, 1, 2, 3)) -> dict[tuple[int, int], tuple[int, str]]:
    """(start, goal) -> best (cost, audit) of a run of rows (initial, kind, number of equal rows), where there is one."""
    bounds = _bounds(steps)
    gone = sum(DELETE * n for _, _, n in steps)
    every = "".join("D" * n for _, _, n in steps)
    out = {}
    for q in starts:
        for goal in goals:
            if goal >= 2:
                out[q, goal] = _search(steps, bounds, q, goal)
            elif q == goal:
                out[q, goal] = (gone, every)                    # nothing stays
            elif goal == 1 and q == 0:                          # one system turn stays
                one = [(gone - DELETE + (TRUNCATED if k == CUT else 0), i) for i, (r, k, _) in enumerate(steps) if k != FORCED and r == "s"]
                if one:
                    cost, _ = min(one)
                    i = max(j for c, j in one if c == cost)     # D comes before K, so the last one
                    before = sum(n for _, _, n in steps[:i])
                    out[q, goal] = (cost, "D" * before + "K" + "D" * (len(every) - before - 1))
    return out


def _block(rows: list[dict], first: bool, last: bool) -> dict:
    """Digest of a block: counts, ends (for what crosses into the next block) and its table of repairs."""
    steps, blank, duplicate, truncated, illegal, turns = [], 0, 0, 0, 0, 0
    before = None
    for r in rows:
        initial, n = r["role"][:1], r["n"]
        if before is None or r["turn"] != before["turn"]:
            turns += r["turn"] is not None
        if before is not None:
            illegal += before["role"][:1] + initial not in _LEGAL
        illegal += (n - 1) * (initial * 2 not in _LEGAL)
        before = r
        if r["kind"] == FORCED:
            blank += n
            steps.append((initial, FORCED, n))
            continue
        copies = n if r["seen"] else n - 1
        duplicate += copies
        if not r["seen"]:
            truncated += r["kind"] == CUT
            steps.append((initial, r["kind"], 1))
        if copies:
            steps.append((initial, FORCED, copies))
    table = solve(steps, (0,) if first else (0, 1, 2, 3), (0, 3) if last else (0, 1, 2, 3))
    seen = [r["turn"] for r in rows if r["turn"] is not None]
    return {"blank": blank, "duplicate": duplicate, "truncated": truncated, "illegal": illegal, "turns": turns,
            "low": seen[0] if seen else None, "high": seen[-1] if seen else None,
            "head": rows[0]["role"][:1], "tail": rows[-1]["role"][:1], "head_turn": rows[0]["turn"], "tail_turn": rows[-1]["turn"],
            "ways": [{"q": q, "goal": g, "cost": c, "audit": a} for (q, g), (c, a) in table.items()]}


_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_DIGEST = ("blank long, duplicate long, truncated long, illegal long, turns long, low long, high long, head string, tail string, "
           "head_turn long, tail_turn long, ways array<struct<q:int,goal:int,cost:bigint,audit:string>>")


def blocks(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per block of the skeleton: conv_id, block, ``part`` (its digest)."""
    id_type = rows.schema["conv_id"].dataType.simpleString()
    last = rows.groupBy(F.col("conv_id").alias("c")).agg(F.max("at").alias("last"))
    fields = F.struct("at", F.col("turn").cast("long").alias("turn"), "role", "kind", "n", "seen")
    grouped = (rows.groupBy("conv_id", F.floor(F.col("at") / block).alias("block"))   # at most ``block`` rows each
               .agg(F.sort_array(F.collect_list(fields)).alias("rows"))
               .join(last, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c"))

    def run(batches):
        for batch in batches:
            out = [_block(x, k == 0, x[-1]["at"] == end) for x, k, end in
                   zip(batch.column("rows").to_pylist(), batch.column("block").to_pylist(), batch.column("last").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("block"), pa.array(out, part)], ["conv_id", "block", "part"])

    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    part = to_arrow_type(_parse_datatype_string(_DIGEST))
    return in_arrow(grouped.select("conv_id", "block", "rows", "last"), run, f"conv_id {id_type}, block long, part struct<{_struct(_DIGEST)}>")


def _struct(fields: str) -> str:
    return ", ".join(f.replace(" ", ":", 1) for f in fields.split(", "))


def _join_blocks(parts: list[dict]) -> dict:
    """A conversation's digest from its blocks in order."""
    out = dict.fromkeys((*_COUNTS, "gaps", "cost"), 0) | {"audit": ""}
    if not parts:
        return out
    best: dict[int, tuple[int, str]] = {0: (0, "")}
    turns, before = 0, None
    for x in parts:
        for k in _COUNTS:
            out[k] += x[k]
        turns += x["turns"]
        if before is not None:
            out["illegal"] += before["tail"] + x["head"] not in _LEGAL
            turns -= x["head_turn"] is not None and x["head_turn"] == before["tail_turn"]
        before = x
        then: dict[int, tuple[int, str]] = {}
        for w in x["ways"]:
            if w["q"] in best:
                way = (best[w["q"]][0] + w["cost"], best[w["q"]][1] + w["audit"])
                then[w["goal"]] = min(way, then.get(w["goal"], way))
        best = then
    out["cost"], out["audit"] = min(best[q] for q in (0, 3) if q in best)
    low = [x["low"] for x in parts if x["low"] is not None]
    high = [x["high"] for x in parts if x["high"] is not None]
    if low:
        out["gaps"] = max(high) - min(low) + 1 - turns
    return out


def repairs(conversations: DataFrame, rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per conversation of ``conversations``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit of ``rows``."""
    id_type = conversations.schema["conv_id"].dataType.simpleString()
    found = blocks(skeleton(rows), block).select("conv_id", F.struct("block", "part").alias("piece"))
    every = conversations.select("conv_id").distinct().select("conv_id", F.lit(None).cast(found.schema["piece"].dataType).alias("piece"))
    one = found.unionByName(every).groupBy("conv_id").agg(F.sort_array(F.collect_list("piece")).alias("pieces"))
    names = ("gaps", *_COUNTS, "cost", "audit")

    def run(batches):
        for batch in batches:
            out = [_join_blocks([p["part"] for p in x]) for x in batch.column("pieces").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), *(pa.array([r[k] for r in out], pa.string() if k == "audit" else pa.int64()) for k in names)],
                ["conv_id", *names])

    return in_arrow(one, run, f"conv_id {id_type}, " + ", ".join(f"{k} {'string' if k == 'audit' else 'long'}" for k in names))


def apply_audit(audit: str, rows):
    """The repaired turns (role, text); ``rows`` gives the conversation's (role, text) in order."""
    q = 0
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(rows)
        if letter == "D":
            continue
        if letter == "K":
            q = _AFTER[q, role[:1]]
        else:
            role, q = _TURN[q], _NEXT[q]
        yield role, text


def repaired(conversations: DataFrame, rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """``repairs`` with ``repaired_sha256``: the hash of the repaired ``role:text`` lines."""
    id_type = conversations.schema["conv_id"].dataType.simpleString()
    counts = ["gaps", *_COUNTS, "cost"]
    head = repairs(conversations, rows, block)
    none = lambda c, t: F.lit(None).cast(t).alias(c)
    heads = head.select("conv_id", *counts, "audit", F.lit(0).alias("part"), none("turn", rows.schema["turn"].dataType),
                        none("role", "string"), none("digest", "string"), none("text", "string"))
    lines = rows.select("conv_id", *[none(c, "long") for c in counts], none("audit", "string"), F.lit(1).alias("part"),
                        "turn", "role", F.md5("text").alias("digest"), "text")
    # a conversation's digest, then its rows in order: read as a stream
    stream = (heads.unionByName(lines).repartition("conv_id")
              .sortWithinPartitions("conv_id", "part", *_row_order())
              .select("conv_id", "part", *counts, "audit", "role", "text"))

    def run(batches):
        from itertools import groupby

        def read():
            for batch in batches:
                for r in zip(*(batch.column(c).to_pylist() for c in batch.schema.names)):
                    yield r

        out = []
        for _, group in groupby(read(), key=lambda r: r[0]):
            first = next(group)
            digest, begun = hashlib.sha256(), False
            for role, text in apply_audit(first[-3], ((r[-2], r[-1]) for r in group)):
                digest.update(("\n" if begun else "").encode() + f"{role}:{text}".encode())
                begun = True
            out.append((first[0], *first[2:-2], digest.hexdigest()))
            if len(out) == 1000:
                yield _result(out)
                out = []
        if out:
            yield _result(out)

    def _result(out):
        cols = list(zip(*out))
        kinds = [conv_type, *[pa.int64()] * len(counts), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, kinds)], ["conv_id", *counts, "audit", "repaired_sha256"])

    from pyspark.sql.pandas.types import to_arrow_type

    conv_type = to_arrow_type(conversations.schema["conv_id"].dataType)
    return in_arrow(stream, run, f"conv_id {id_type}, " + ", ".join(f"{c} long" for c in counts) + ", audit string, repaired_sha256 string")
