"""Shards of whole texts, and questions that all shards answer together.

Two operators need statistics of very many small keys (n-grams, phrases) for
every occurrence of a key.  A shuffle of one row per occurrence and the join
back would move many times the input.  Instead:

* ``pack`` puts whole documents into compressed shards of a bounded size,
  written once to the checkpoint folder;
* ``ask`` sends each shard's *distinct* keys (pre-aggregated, sorted,
  delta-coded), hashed into key ranges; a range's task merges what the shards
  sent and answers every shard in the order of its keys;
* ``read`` brings shards and answers together again.

A key that a third of all rows hold is one entry per shard, so no task gets
more than the number of shards for it, and ranges are even because keys are
hashes.  The number of ranges follows the number of shards.  Lost executors
cost only the recomputation of their tasks; shards and answers are files in
the checkpoint folder.
"""

from __future__ import annotations

import struct
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popstats.llm._spark import in_arrow, materialise
from popstats.llm._text import SLICE_BYTES, Texts, U64, slices


def dump(*arrays: np.ndarray, level: int = 1) -> bytes:
    """Arrays as one compressed block; bytes of equal significance stand together, so small numbers cost little."""
    parts = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        planes = a.view(np.uint8).reshape(-1, a.dtype.itemsize).T if a.dtype.itemsize > 1 else a.view(np.uint8)
        parts.append(struct.pack("<2sq", a.dtype.str[1:].encode(), a.size) + planes.tobytes())
    return zstandard.ZstdCompressor(level=level).compress(b"".join(parts))


def undump(block: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(block)
    out, at = [], 0
    while at < len(data):
        kind, n = struct.unpack_from("<2sq", data, at)
        at += 10
        dtype = np.dtype(kind.decode())
        raw = np.frombuffer(data, np.uint8, n * dtype.itemsize, at)
        out.append(np.ascontiguousarray(raw.reshape(dtype.itemsize, -1).T).view(dtype).ravel() if dtype.itemsize > 1
                   else raw.view(dtype))
        at += n * dtype.itemsize
    return out


def _deltas(keys: np.ndarray) -> np.ndarray:
    return np.diff(keys, prepend=U64(0))


class Shard:
    """Documents of one shard: ids (with a mask of NULLs) and texts; for pieces of a cut text its row and their number."""

    def __init__(self, block: bytes):
        self.ids, self.null, off, raw, *cut = undump(block)
        self.row, self.piece = cut or (None, None)
        t = Texts(pa.array([], pa.string()))
        t.raw = t.buf = raw
        t.off, t.n = off, off.size - 1
        self.texts = t

    def id_column(self) -> pa.Array:
        return pa.array(self.ids, pa.int64(), mask=self.null.astype(bool))


def _cut(rows: DataFrame, size: int, overlap: int) -> DataFrame:
    """(doc_id, text as bytes, row, piece): texts over ``size`` bytes in pieces that share ``overlap`` bytes, row -1 for others."""
    n = F.octet_length("text")
    pieces = F.when(n > size, F.ceil((n - overlap) / (size - overlap))).otherwise(1).cast("int")
    row = F.when(n > size, F.monotonically_increasing_id()).otherwise(-1)
    part = F.substring("text", F.col("piece") * (size - overlap) + 1, F.lit(size))
    return (rows.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"), row.alias("row"), pieces.alias("n"))
            .select("doc_id", "text", "row", F.explode(F.sequence(F.lit(0), F.coalesce("n", F.lit(1)) - 1)).alias("piece"))
            .select("doc_id", F.when(F.col("row") < 0, F.col("text")).otherwise(part).alias("text"), "row", "piece"))


def pack(docs: DataFrame, shard_bytes: int = SLICE_BYTES, apart: Callable | None = None, overlap: int | None = None) -> DataFrame:
    """(shard, block): whole documents (doc_id as long, text), at most about ``shard_bytes`` of text a shard.

    ``apart(ids, null)`` tells which documents go into shards of their own; those shards have odd numbers.
    With ``overlap`` a text longer than a shard is cut into pieces of a shard each, which share so many bytes
    with the next one; then the pieces, and only they, stand in the shards with odd numbers.
    """

    def run(batches):
        base, count = TaskContext.get().partitionId() << 32, 0
        kinds = {0: ([], 0), 1: ([], 0)}

        def flush(kind):
            nonlocal count
            table = pa.Table.from_batches(kinds[kind][0]).combine_chunks()
            t = Texts(table.column("text"))
            ids = table.column("doc_id").combine_chunks()
            null = np.asarray(ids.is_null().to_numpy(zero_copy_only=False), np.uint8)
            cut = [table.column(c).to_numpy() for c in ("row", "piece")] if overlap else []
            block = dump(ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), null, t.off, t.raw, *cut, level=3)
            count += 1
            kinds[kind] = ([], 0)
            return pa.RecordBatch.from_arrays([pa.array([base + 2 * count + kind]), pa.array([block], pa.binary())], ["shard", "block"])

        for batch in batches:
            for both in slices(batch, "text", shard_bytes):
                ids = both.column("doc_id")
                own = np.zeros(both.num_rows, bool)
                if apart is not None:
                    own = apart(ids.fill_null(0).to_numpy(zero_copy_only=False), np.asarray(ids.is_null().to_numpy(zero_copy_only=False)))
                elif overlap:
                    own = both.column("row").to_numpy() >= 0
                for kind, rows in ((0, ~own), (1, own)):
                    if not rows.any():
                        continue
                    part = both if rows.all() else both.filter(pa.array(rows))
                    n = int(Texts(part.column("text")).off[-1])
                    if kinds[kind][0] and kinds[kind][1] + n > shard_bytes:
                        yield flush(kind)
                    kinds[kind][0].append(part)
                    kinds[kind] = (kinds[kind][0], kinds[kind][1] + n)
        for kind in kinds:
            if kinds[kind][0]:
                yield flush(kind)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if overlap:
        rows = _cut(rows, shard_bytes, overlap)
    return materialise(in_arrow(rows, run, "shard long, block binary"))


def ranges_for(shards: DataFrame, shards_per_range: int = 1) -> int:
    """log2 of the number of key ranges, so that a range holds about so many shards' worth of keys."""
    return max(3, int(np.ceil(np.log2(max(1, shards.count() / shards_per_range)))))


def _sent(shard: int, kind: int, keys: np.ndarray, columns: list[np.ndarray], log2_ranges: int):
    """Messages (range, shard, kind, block) for sorted distinct keys with their columns."""
    edges = np.searchsorted(keys >> U64(64 - log2_ranges), np.arange((1 << log2_ranges) + 1, dtype=U64))
    for r in np.flatnonzero(np.diff(edges)).tolist():
        a, b = edges[r], edges[r + 1]
        yield r, shard, kind, dump(_deltas(keys[a:b]), *(c[a:b] for c in columns))


_MESSAGE = "key_range int, shard long, kind int, block binary"
_ANSWER = "shard long, kind int, key_range int, block binary, total long, n_keys long"


def _messages(rows: list) -> pa.Table:
    r, s, k, b = zip(*rows) if rows else ((), (), (), ())
    return pa.table({"key_range": pa.array(r, pa.int32()), "shard": pa.array(s, pa.int64()),
                     "kind": pa.array(k, pa.int32()), "block": pa.array(b, pa.binary())})


def ask(messages: DataFrame, answer: Callable) -> DataFrame:
    """Merge the messages of each key range and write the answers.

    ``answer(kind, keys, columns, owner)`` gets the concatenated entries of a
    kind (unsorted; ``owner`` numbers the message) and returns (answer arrays
    aligned with the entries, total, number of keys).
    """

    def merge(table: pa.Table) -> pa.Table:
        out = []
        kinds = table["kind"].to_numpy()
        shards = table["shard"].to_numpy()
        blocks = table["block"]
        r = int(table["key_range"][0].as_py())
        for kind in np.unique(kinds).tolist():
            at = np.flatnonzero(kinds == kind)
            parts = [undump(blocks[int(i)].as_py()) for i in at]
            sizes = np.array([p[0].size for p in parts])
            keys = np.concatenate([np.cumsum(p[0], dtype=U64) for p in parts])
            columns = [np.concatenate(c) for c in zip(*(p[1:] for p in parts))]
            owner = np.repeat(np.arange(at.size), sizes)
            del parts
            answers, total, n_keys = answer(kind, keys, columns, owner)
            ends = np.cumsum(sizes)
            for j, i in enumerate(at.tolist()):
                a, b = ends[j] - sizes[j], ends[j]
                out.append((int(shards[i]), kind, r, dump(*(x[a:b] for x in answers)),
                            total if j == 0 else 0, n_keys if j == 0 else 0))
        cols = list(zip(*out))
        types = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64()]
        names = ["shard", "kind", "key_range", "block", "total", "n_keys"]
        return pa.table({n: pa.array(c, t) for n, c, t in zip(names, cols, types)})

    return materialise(messages.groupBy("key_range").applyInArrow(merge, _ANSWER), narrow=True)


def _answers(table: pa.Table) -> dict[int, list[np.ndarray]]:
    """Per kind, the answer arrays in the order of the shard's sorted keys."""
    out = {}
    order = np.lexsort((table["key_range"].to_numpy(), table["kind"].to_numpy()))
    kinds = table["kind"].to_numpy()[order]
    for kind in np.unique(kinds).tolist():
        parts = [undump(table["block"][int(i)].as_py()) for i in order[kinds == kind]]
        out[kind] = [np.concatenate(c) for c in zip(*parts)]
    return out


def send(shards: DataFrame, emit: Callable, log2_ranges: int) -> DataFrame:
    """Messages of every shard; ``emit(shard)`` yields (kind, sorted distinct keys, columns)."""

    def run(batches):
        for batch in batches:
            for shard, block in zip(batch.column("shard").to_pylist(), batch.column("block")):
                rows = [m for kind, keys, columns in emit(Shard(block.as_py()))
                        for m in _sent(shard, kind, keys, columns, log2_ranges)]
                yield from _messages(rows).to_batches()

    return in_arrow(shards, run, _MESSAGE)


def read(shards: DataFrame, answers: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``fn(shard, answers by kind) -> pa.Table`` on every shard with all its answers."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return fn(Shard(left["block"][0].as_py()), _answers(right))

    return shards.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(run, schema)


def send_after(shards: DataFrame, answers: DataFrame, emit: Callable, log2_ranges: int) -> DataFrame:
    """``send`` for a second question that depends on earlier answers: ``emit(shard, answers)``."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        number = int(left["shard"][0].as_py())
        return _messages([m for kind, keys, columns in emit(Shard(left["block"][0].as_py()), _answers(right))
                          for m in _sent(number, kind, keys, columns, log2_ranges)])

    return shards.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(run, _MESSAGE)


def groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sort order, starts of the groups of equal keys in it, group of every entry)."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    new = np.ones(s.size, bool)
    new[1:] = s[1:] != s[:-1]
    of = np.empty(s.size, np.int64)
    of[order] = np.cumsum(new) - 1
    return order, np.flatnonzero(new), of
