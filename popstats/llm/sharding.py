"""Sharding over fixed virtual slots.

Records are hashed into ``n_slots`` virtual slots; a slot never changes.
Bytes are aggregated per slot, and a small versioned table maps slots to
shards.  The first version deals slots, largest first, to the shard with the
fewest bytes; ``rebalanced`` edits an existing map (for grown data or another
number of shards) by moving as few bytes as the balance needs, so records
move only with their slot.  Every run stores its version as a table and
assigns from that table: version 1 in a new folder of the shared one, or,
given the path of earlier versions (``map_path``), the next version there.
The map has ``n_slots`` rows whatever the data's
size; it alone passes through the driver.

Scale: no text is shuffled.  The slot sums are a partial aggregation, the
map is broadcast (``n_slots`` rows), and the place of a record in its shard
is its slot's offset plus its place in the slot, so a window never spans more
than one slot.  The hash covers doc_id and text, so NULL ids or an id that a
third of the rows carry are spread over all slots.

Edge cases: a NULL text has size 1 and crc32 0; NULL ids are ordered first;
identical rows are numbered and their copies spread over the slots by
``shard_documents``, however many (``with_shard``, whose rows may differ in other
columns, leaves them in one slot); an empty table gives an empty result and a map with empty slots; a stored map of another number of
slots is an error; very long texts are only measured and hashed; other columns
of any name are carried by ``with_shard``, but for one named ``shard``, which is
replaced.
"""

from __future__ import annotations

import heapq
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from popstats.llm._spark import shared_dir

N_SLOTS = 8192
COPIES = 1 << 16
MAP_SCHEMA = "virtual_slot int, shard int, bytes long, version int"


def _digest(doc_id: str = "doc_id", text: str = "text"):
    return F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit("|"), F.coalesce(text, F.lit(""))))


def _slot(digest, n_slots: int):
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % n_slots).cast("int")


def slot_of(n_slots: int = N_SLOTS, doc_id: str = "doc_id", text: str = "text"):
    """Virtual slot: 32 bits of the MD5 of doc_id and text, modulo ``n_slots``."""
    return _slot(_digest(doc_id, text), n_slots)


def _measures():
    return ["doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).cast("long").alias("text_crc32")]


def sized(docs: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot of every record; identical records share a slot."""
    return docs.select(*_measures(), slot_of(n_slots).alias("virtual_slot"))


def spread(docs: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """``sized``, but identical records are numbered, and every copy after the first has a slot of its own number.

    The copies are counted first (partial aggregation), then made again from
    their count in blocks of ``COPIES``, so no task gathers them.
    """
    key = ["doc_id", "size", "text_crc32", "digest"]
    counted = docs.select(*_measures(), _digest().alias("digest")).groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    last = F.col("n") - 1
    blocks = counted.select(*key, "n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / COPIES))).alias("block"))
    start = F.col("block") * COPIES
    copies = blocks.select(*key, F.explode(F.sequence(start, F.least(last, start + COPIES - 1))).alias("copy"))
    again = F.md5(F.concat_ws("|", "digest", F.col("copy").cast("string")))
    return copies.select("doc_id", "size", "text_crc32",
                         _slot(F.when(F.col("copy") == 0, F.col("digest")).otherwise(again), n_slots).alias("virtual_slot"))


def slot_bytes(records: DataFrame) -> dict[int, int]:
    """Bytes per non-empty slot: at most ``n_slots`` numbers."""
    rows = records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes")).collect()
    return {r["virtual_slot"]: r["bytes"] for r in rows}


def first_map(weights: dict[int, int], n_shards: int, n_slots: int = N_SLOTS) -> list[tuple[int, int, int, int]]:
    """Version 1: (slot, shard, bytes, version) rows; largest slot first to the lightest shard."""
    heap = [(0, s) for s in range(n_shards)]
    out = []
    for slot in sorted(range(n_slots), key=lambda k: (-weights.get(k, 0), k)):
        load, shard = heapq.heappop(heap)
        heapq.heappush(heap, (load + weights.get(slot, 0), shard))
        out.append((slot, shard, weights.get(slot, 0), 1))
    return sorted(out)


def rebalanced(old: list[tuple[int, int, int, int]], weights: dict[int, int], n_shards: int):
    """The next version of a map: slots of removed shards and of overfull ones move to the lightest shards."""
    version = max((r[3] for r in old), default=0) + 1
    shard_of = {slot: shard for slot, shard, _, _ in old}
    load = [0] * n_shards
    held: list[list[int]] = [[] for _ in range(n_shards)]
    moving = []
    for slot in sorted(shard_of):
        if shard_of[slot] < n_shards:
            load[shard_of[slot]] += weights.get(slot, 0)
            held[shard_of[slot]].append(slot)
        else:
            moving.append(slot)
    target = sum(weights.values()) / n_shards
    for shard in range(n_shards):
        for slot in sorted(held[shard], key=lambda k: (-weights.get(k, 0), k)):
            w = weights.get(slot, 0)
            if w and load[shard] - w >= target:
                load[shard] -= w
                moving.append(slot)
    heap = [(b, s) for s, b in enumerate(load)]
    heapq.heapify(heap)
    for slot in sorted(moving, key=lambda k: (-weights.get(k, 0), k)):
        b, shard = heapq.heappop(heap)
        heapq.heappush(heap, (b + weights.get(slot, 0), shard))
        shard_of[slot] = shard
    return [(slot, shard, weights.get(slot, 0), version) for slot, shard in sorted(shard_of.items())]


def map_frame(spark: SparkSession, rows: list[tuple[int, int, int, int]]) -> DataFrame:
    return spark.createDataFrame(rows, MAP_SCHEMA)


def save_map(spark: SparkSession, rows: list[tuple[int, int, int, int]], path: str) -> None:
    """Add one version to the stored maps (Parquet, one folder per version)."""
    map_frame(spark, rows).coalesce(1).write.mode("error").parquet(f"{path.rstrip('/')}/version={rows[0][3]:06d}")


def load_map(spark: SparkSession, path: str, version: int) -> list[tuple[int, int, int, int]]:
    return sorted(tuple(r) for r in spark.read.schema(MAP_SCHEMA).parquet(f"{path.rstrip('/')}/version={version:06d}").collect())


def latest_version(spark: SparkSession, path: str) -> int:
    """The highest stored version, 0 where there is none."""
    try:
        return spark.read.schema(MAP_SCHEMA).parquet(path).agg(F.max("version")).first()[0] or 0
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return 0
        raise


def stored_map(spark: SparkSession, weights: dict[int, int], n_shards: int, n_slots: int = N_SLOTS,
               map_path: str | None = None) -> DataFrame:
    """(virtual_slot, shard) of a version stored now: the first, or the one after the latest at ``map_path``."""
    path = (map_path or f"{shared_dir(spark)}/slot-map-{uuid.uuid4().hex}").rstrip("/")
    latest = latest_version(spark, path) if map_path else 0
    if latest:
        old = load_map(spark, path, latest)
        if len(old) != n_slots:
            raise ValueError(f"the map at {path} has {len(old)} slots, not {n_slots}")
        rows = rebalanced(old, weights, n_shards)
    else:
        rows = first_map(weights, n_shards, n_slots)
    save_map(spark, rows, path)
    return spark.read.schema(MAP_SCHEMA).parquet(f"{path}/version={latest + 1:06d}").select("virtual_slot", "shard")


def assign(records: DataFrame, slot_map: DataFrame) -> DataFrame:
    """``records`` (with virtual_slot) plus ``shard`` of the map."""
    return records.join(F.broadcast(slot_map), "virtual_slot")


def placed(records: DataFrame) -> DataFrame:
    """``slot``: the record's place in its shard, gapless from 0 (by virtual slot, then doc_id)."""
    counts = records.groupBy("shard", "virtual_slot").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("virtual_slot"), F.coalesce(F.sum("n").over(w), F.lit(0)).alias("offset"))
    within = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return (records.withColumn("place", F.row_number().over(within) - 1)
            .join(F.broadcast(offsets), "virtual_slot")  # at most n_slots rows
            .withColumn("slot", (F.col("offset") + F.col("place")).cast("long")).drop("offset", "place"))


def shard_documents(docs: DataFrame, n_shards: int = 16, n_slots: int = N_SLOTS, map_path: str | None = None) -> DataFrame:
    """Per document: doc_id, size, text_crc32, law, shard, slot, grown_shard and its virtual slot (law ``bytes``)."""
    records = spread(docs, n_slots)
    slot_map = stored_map(docs.sparkSession, slot_bytes(records), n_shards, n_slots, map_path)
    return placed(assign(records, slot_map)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


def with_shard(docs: DataFrame, n_shards: int = 16, n_slots: int = N_SLOTS, map_path: str | None = None) -> DataFrame:
    """All columns of ``docs`` (one named ``shard`` is replaced) plus ``shard``; the text is never shuffled."""
    slot_map = stored_map(docs.sparkSession, slot_bytes(sized(docs, n_slots)), n_shards, n_slots, map_path)
    names = docs.columns
    safe = [f"_c{i}" for i in range(len(names))]  # an input column may have the name of one made here
    of = dict(zip(names, safe))
    rows = docs.toDF(*safe).withColumn("virtual_slot", slot_of(n_slots, of["doc_id"], of["text"]))
    return assign(rows, slot_map).select(*[F.col(s).alias(n) for s, n in zip(safe, names) if n != "shard"], "shard")
