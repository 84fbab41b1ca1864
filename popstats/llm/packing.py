"""Packing documents into sequences by hierarchical residual best fit.

``pieces`` turns every document into ids (its tokens, then an end id) and cuts
only documents longer than a sequence, so that every piece but the first is a
whole sequence.  ``pack`` then fills sequences:

* every partition packs its own pieces by best fit, longest first, and emits
  the sequences that are nearly full;
* the underfull rest becomes items as long as they are filled.  ``fan``
  partitions at a time merge theirs by the same best fit, emit, and hand on
  what is still underfull, round by round up a tree.

Bins that are filled alike are interchangeable, so a round sees *counts by
fill*: at most ``capacity`` numbers from each node, however many bins there
are, and writes down which run of bins goes where.  No piece moves in a round,
no task holds more than ``fan`` such tables, and nothing is capped.  The runs
are composed from the root down; one join by (partition, fill) then gives each
piece its sequence and place.  The local best fit also works by counts.

Edge cases: NULL and empty texts are one end id; a very long text is cut into
as many pieces as it needs; repeated rows (and repeated or NULL ids) are packed
row by row; equal lengths keep the row order of their partition; an empty table
gives an empty result; ids of any type are carried, other columns not read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from popstats.llm._spark import in_arrow, materialise, shared_dir
from popstats.llm._text import slices
from popstats.llm.bpe import ByteBPE

CAPACITY = 2048
SLACK = 16   # a sequence with so few free places is nearly full
FAN = 16
SLICE_BYTES = 1 << 20
_NODE_BITS = 40  # a sequence's number is its node << 40 | its number there


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32 (of its ids as little-endian unsigned 32-bit numbers)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        bpe = ByteBPE(path, added=True)
        end = np.array([end_id], np.uint32)
        for batch in batches:
            for part in slices(batch, limit=SLICE_BYTES):
                rows, out = [], []
                for i, text in enumerate(part.column("text").to_pylist()):
                    ids = np.concatenate([bpe.ids(text), end]).astype("<u4")
                    cuts = [0, *range((ids.size - 1) % capacity + 1, ids.size + 1, capacity)]
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        rows.append(i)
                        out.append((k, a, b - a, zlib.crc32(ids[a:b])))
                piece, start, length, crc = (pa.array(x, t) for x, t in zip(
                    zip(*out), (pa.int32(), pa.int64(), pa.int64(), pa.int64())))
                yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(rows, pa.int64())), piece, start, length, crc],
                                                 ["doc_id", "piece", "start", "length", "ids_crc32"])

    return in_arrow(docs.select("doc_id", "text"), run, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long")


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Best fit, longest first, of ``counts[s]`` items of each length s: ``(bins, [(length, copies in each bin), ...])``.

    Each item goes where the fewest places stay free.  An item of the length
    just placed fits its bin even more tightly than before, so a bin takes as
    many copies as it can before the next one is opened.
    """
    free: dict[int, list] = defaultdict(list)  # free places -> kinds of bins [number, content]
    mask = 0                                    # bit f: there are bins with f places free

    def put(places, number, content):
        nonlocal mask
        free[places].append((number, content))
        mask |= 1 << places

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            fitting = mask >> size
            if fitting:
                places = size + (fitting & -fitting).bit_length() - 1
                number, content = free[places].pop()
                if not free[places]:
                    mask ^= 1 << places
            else:
                places, number, content = capacity, left, []
            most = places // size
            filled = min(number, left // most)
            if filled:
                put(places - most * size, filled, [*content, (size, most)])
                left -= filled * most
                number -= filled
            if left and number:
                put(places - left * size, 1, [*content, (size, left)])
                left, number = 0, number - 1
            if number and content:
                put(places, number, content)
    return [(n, c) for kinds in free.values() for n, c in kinds]


def _places(counts: dict[int, int], capacity: int):
    """``(length, first, number, fill, first bin, offset)``: items [first, first + number) of a length go, one each,
    into bins [first bin, ...) of those filled alike, at ``offset``."""
    used, bins = defaultdict(int), defaultdict(int)
    for number, content in best_fit(counts, capacity):
        fill, offset = sum(s * k for s, k in content), 0
        for size, copies in content:
            for _ in range(copies):
                yield size, used[size], number, fill, bins[fill], offset
                used[size] += number
                offset += size
        bins[fill] += number


def _local(items: DataFrame, length: str, capacity: int) -> DataFrame:
    """The items with their partition's best fit: node, fill and number of the bin among those filled alike, offset."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema.fields)

    def run(batches):
        from pyspark import TaskContext

        batches = [b for b in batches if b.num_rows]  # a partition of narrow rows
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        size = table.column(length).to_numpy()
        order = np.argsort(size, kind="stable")
        lengths, first, counts = np.unique(size[order], return_index=True, return_counts=True)
        begins = dict(zip(lengths.tolist(), first.tolist()))
        fill, number, offset = (np.zeros(size.size, np.int64) for _ in range(3))
        for s, at, n, filled, bin_at, place in _places(dict(zip(lengths.tolist(), counts.tolist())), capacity):
            rows = order[begins[s] + at:begins[s] + at + n]
            fill[rows], number[rows], offset[rows] = filled, np.arange(bin_at, bin_at + n), place
        node = np.full(size.size, TaskContext.get().partitionId(), np.int64)
        for name, values in (("_node", node), ("_fill", fill), ("_bin", number), ("_at", offset)):
            table = table.append_column(name, pa.array(values))
        yield from table.to_batches(max_chunksize=100_000)

    return items.mapInArrow(run, f"{fields}, _node long, _fill long, _bin long, _at long")


def _merge(capacity: int, fan: int):
    """One node of a round: its children's counts by fill to runs of bins (see ``_places``)."""

    def run(key, rows):
        rows = rows.sort_values(["_fill", "_node"])
        runs: dict[int, list] = {}
        for fill, group in rows.groupby("_fill"):
            ends = group["n"].cumsum()
            runs[fill] = list(zip(ends - group["n"], ends, group["_node"]))  # [begin, end) of each child in the pool
        out = []
        for size, first, n, fill, bin_at, offset in _places({s: r[-1][1] for s, r in runs.items()}, capacity):
            for begin, end, child in runs[size]:
                a, b = max(first, begin), min(first + n, end)
                if a < b:
                    out.append((child, size, a - begin, b - begin, key[0], fill, bin_at + a - first, offset))
        return pd.DataFrame(out, columns=["_node", "_fill", "lo", "hi", "up", "up_fill", "up_bin", "shift"])

    return run


_RUNS = "_node long, _fill long, lo long, hi long, up long, up_fill long, up_bin long, shift long"


def _finals(bins: DataFrame, first_node: int) -> DataFrame:
    """Emitted bins (node, fill, n) as runs with their sequences' numbers."""
    earlier = Window.partitionBy("_node").orderBy("_fill").rowsBetween(Window.unboundedPreceding, -1)  # a node's fills
    return bins.select("_node", "_fill", F.lit(0).cast("long").alias("lo"), F.col("n").alias("hi"),
                       (F.shiftleft(F.col("_node") + first_node, _NODE_BITS) + F.coalesce(F.sum("n").over(earlier), F.lit(0))).alias("seq"),
                       F.lit(0).cast("long").alias("add"))


def pack(items: DataFrame, length: str = "length", capacity: int = CAPACITY, slack: int = SLACK, fan: int = FAN) -> DataFrame:
    """The items (lengths 1 to ``capacity``) with ``sequence_id`` and ``offset``."""
    shared_dir(items.sparkSession)
    # rows spread evenly whatever their keys; written, so that rounds and result see the same partitions
    local = materialise(_local(items.hint("rebalance"), length, capacity))
    bins = local.groupBy("_node", "_fill").agg((F.max("_bin") + 1).alias("n"))
    n_nodes = (local.agg(F.max("_node")).first()[0] or 0) + 1
    full, first_node, levels = F.col("_fill") > capacity - slack, 0, []
    while n_nodes > 1:
        bins = materialise(bins, narrow=True)
        moves = materialise(bins.filter(~full).groupBy(F.floor(F.col("_node") / fan).alias("up"))
                            .applyInPandas(_merge(capacity, fan), _RUNS), narrow=True)
        levels.append((_finals(bins.filter(full), first_node), moves))
        bins = (moves.groupBy("up", "up_fill").agg(F.max(F.col("up_bin") + F.col("hi") - F.col("lo")).alias("n"))
                .select(F.col("up").alias("_node"), F.col("up_fill").alias("_fill"), "n"))
        first_node += n_nodes
        n_nodes = -(-n_nodes // fan)
    runs = _finals(bins, first_node)
    for finals, moves in reversed(levels):
        # a run of a child's bins lies in its parent's bins [up_bin, up_bin + hi - lo): cut it where the parent's runs are cut
        u = runs.select(F.col("_node").alias("up"), F.col("_fill").alias("up_fill"), F.col("lo").alias("ulo"),
                        F.col("hi").alias("uhi"), F.col("seq").alias("useq"), F.col("add").alias("uadd"))
        end = F.col("up_bin") + F.col("hi") - F.col("lo")
        both = moves.join(u, ["up", "up_fill"]).filter((F.col("ulo") < end) & (F.col("uhi") > F.col("up_bin")))
        a, b = F.greatest("up_bin", "ulo"), F.least(end, F.col("uhi"))
        cut = both.select("_node", "_fill", (F.col("lo") + a - F.col("up_bin")).alias("lo"), (F.col("lo") + b - F.col("up_bin")).alias("hi"),
                          (F.col("useq") + a - F.col("ulo")).alias("seq"), (F.col("shift") + F.col("uadd")).alias("add"))
        runs = materialise(finals.unionByName(cut), narrow=True)
    r = runs.select(F.col("_node").alias("rn"), F.col("_fill").alias("rf"), "lo", "hi", "seq", "add")
    found = local.join(r, (F.col("_node") == F.col("rn")) & (F.col("_fill") == F.col("rf"))
                       & (F.col("_bin") >= F.col("lo")) & (F.col("_bin") < F.col("hi")))
    return found.select(*[F.col(c) for c in items.columns], (F.col("seq") + F.col("_bin") - F.col("lo")).alias("sequence_id"),
                        (F.col("_at") + F.col("add")).alias("offset"))


def packed(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """Per piece of every document: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(pieces(docs, path, capacity, end_id), capacity=capacity)
