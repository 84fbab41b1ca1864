"""SimHash near-duplicates, with exact neighbour search in vantage-point trees.

Fingerprint: a bit is 1 if it is set in over half of the XXH64 values of a
text's word shingles.  Equal fingerprints are merged by a partial
aggregation first, so a group of copies of any size is one point.  The
distinct fingerprints are partitioned by a vantage-point tree over Hamming
distance: inner nodes hold a vantage point and a radius; a point lives in
exactly one leaf (shard) and, as a query, also visits every leaf whose ball
or shell its own ball of ``max_bits`` reaches (triangle bound).  A shard's
task builds its own tree below and prunes by the same bound, so every pair
within ``max_bits`` is found; it returns a spanning forest of the links it
saw, not the pairs, and components are then contracted over all shards.

Only the vantage points come from a bounded sample (``SAMPLE`` to
``MOST_SAMPLE`` distinct fingerprints, the smallest by hash; about 8 a leaf);
they decide the balance of the shards, never which links are found.  Every
level of the tree makes more points visit both sides (about 1.4 times as many
for random fingerprints), so a leaf has far more visitors than points; past
``VISITORS`` of them a leaf's visitors are dealt over several tasks, each of
which holds the leaf's points.

Edge cases: NULL and empty texts have fingerprint zero and link like any
other; fewer words than a shingle are one shingle; NULL doc_ids take part
but never name a component that has another id (a component of NULL ids
alone has a NULL id); repeated rows give one result row each; an empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popstats.llm._spark import in_arrow, materialise
from popstats.llm._text import LOWER, Texts, mix, slices
from popstats.llm.graph import components

SAMPLE = 8192
MOST_SAMPLE = 1 << 18
VISITORS = 2_000_000
SEED = 42
_LOWER = LOWER.tobytes()


def _shingle_hashes(text: bytes, width: int) -> list[int]:
    words = text.translate(_LOWER).split()  # splits at \x20 and \x09-\x0D
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= width:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    end = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *end[:-1].tolist()]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts, (end[width - 1:] - 1).tolist())]


def fingerprints_of(t: Texts, width: int) -> np.ndarray:
    """One uint64 fingerprint per text of a slice."""
    out = np.zeros(t.n, np.uint64)
    weight = np.uint64(1) << np.arange(63, -1, -1, dtype=np.uint64)
    for i in range(t.n):
        h = _shingle_hashes(t.bytes_of(i), width)
        if h:
            bits = np.unpackbits(np.array(h, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
            ones = bits.sum(axis=0, dtype=np.int64)
            out[i] = weight[ones * 2 > len(h)].sum(dtype=np.uint64)
    return out


def fingerprint(docs: DataFrame, keep: list[str], shingle: int = 3, text: str = "text", out: str = "fp") -> DataFrame:
    """The ``keep`` columns and the fingerprint (as a signed long) of every row."""
    types = {f.name: f.dataType.simpleString() for f in docs.select(*keep).schema.fields}
    schema = ", ".join([*(f"`{n}` {t}" for n, t in types.items()), f"`{out}` long"])

    def run(batches):
        for batch in batches:
            for part in slices(batch, text):
                fp = fingerprints_of(Texts(part.column(text)), shingle).view(np.int64)
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keep), pa.array(fp)], [*keep, out])

    return in_arrow(docs.select(*dict.fromkeys([*keep, text])), run, schema)


# ---------------------------------------------------------------- vantage-point trees


def _distance(points: np.ndarray, p) -> np.ndarray:
    return np.bitwise_count(points ^ np.uint64(p))


def _split(points: np.ndarray) -> tuple[np.uint64, int] | None:
    """Vantage point and the radius that halves ``points`` best; None if nothing divides them."""
    best = None
    for at in (0, points.size // 3, points.size // 2, points.size - 1):  # the widest of a few candidates
        d = _distance(points, points[at])
        below = np.cumsum(np.bincount(d, minlength=65))
        radius = int(np.argmin(np.abs(below - points.size / 2)))
        inside = int(below[radius])
        if 0 < inside < points.size:
            overlap = int(np.count_nonzero(np.abs(d.astype(np.int64) - radius) <= 2))
            score = (overlap + abs(inside - points.size / 2), at)
            if best is None or score < best[0]:
                best = (score, points[at], radius)
    return best and best[1:]


def build_tree(points: np.ndarray, depth: int) -> tuple:
    """Nested (vantage, radius, inside, outside) nodes; a leaf is its number in depth-first order."""
    count = [0]

    def node(pts: np.ndarray, left: int):
        cut = _split(pts) if left > 0 and pts.size > 1 else None
        if cut is None:
            count[0] += 1
            return count[0] - 1
        vantage, radius = cut
        inside = _distance(pts, vantage) <= radius
        return (int(vantage), radius, node(pts[inside], left - 1), node(pts[~inside], left - 1))

    return node(points, depth)


def _route(tree, points: np.ndarray, reach: int):
    """(leaf, positions of the points whose ball of ``reach`` meets it); reach 0: the home leaf."""
    stack = [(tree, np.arange(points.size))]
    while stack:
        node, at = stack.pop()
        if not at.size:
            continue
        if isinstance(node, int):
            yield node, at
            continue
        vantage, radius, inside, outside = node
        d = _distance(points[at], vantage).astype(np.int64)
        stack.append((inside, at[d - reach <= radius]))
        stack.append((outside, at[d + reach > radius]))


def _pairs(points: np.ndarray, queries: np.ndarray, reach: int, small: int = 48):
    """Index pairs (point, query) within ``reach`` bits, by a tree over the points built on the way down."""
    stack = [(np.arange(points.size), np.arange(queries.size))]
    while stack:
        p, q = stack.pop()
        if not p.size or not q.size:
            continue
        cut = _split(points[p]) if p.size > small else None
        if cut is None:
            for a in range(0, q.size, 4096):
                for b in range(0, p.size, 512):
                    pb, qa = p[b:b + 512], q[a:a + 4096]
                    i, j = np.nonzero(np.bitwise_count(points[pb][:, None] ^ queries[qa][None, :]) <= reach)
                    if i.size:
                        yield pb[i], qa[j]
            continue
        vantage, radius = cut
        dp = _distance(points[p], vantage).astype(np.int64)
        dq = _distance(queries[q], vantage).astype(np.int64)
        stack.append((p[dp <= radius], q[dq - reach <= radius]))
        stack.append((p[dp > radius], q[dq + reach > radius]))


def _union(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Merge the classes of u[i] and v[i]; ``label`` points to smaller positions and ends flat."""
    while u.size:
        a, b = label[u], label[v]
        low, high = np.minimum(a, b), np.maximum(a, b)
        np.minimum.at(label, high, low)
        while True:
            flat = label[label]
            if np.array_equal(flat, label):
                break
            label[:] = flat
        open_ = label[u] != label[v]
        u, v = u[open_], v[open_]


def _forest(points: np.ndarray, queries: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    nodes = np.union1d(points, queries)
    where_p, where_q = np.searchsorted(nodes, points), np.searchsorted(nodes, queries)
    label = np.arange(nodes.size)
    hold_u, hold_v, held = [], [], 0
    for i, j in _pairs(points, queries, reach):
        hold_u.append(where_p[i])
        hold_v.append(where_q[j])
        held += i.size
        if held > 1_000_000:
            _union(label, np.concatenate(hold_u), np.concatenate(hold_v))
            hold_u, hold_v, held = [], [], 0
    if held:
        _union(label, np.concatenate(hold_u), np.concatenate(hold_v))
    linked = np.flatnonzero(label != np.arange(nodes.size))
    return nodes[linked], nodes[label[linked]]


def links(distinct: DataFrame, max_bits: int = 2, leaf_size: int = 2048, visitors: int = VISITORS) -> DataFrame:
    """Spanning links (u, v) of all fingerprints (column ``fp``, distinct) within ``max_bits`` bits."""
    n = distinct.count()
    wanted = min(MOST_SAMPLE, max(SAMPLE, 8 * n // leaf_size))
    sample = distinct.orderBy(F.xxhash64("fp")).limit(wanted).toPandas()["fp"].to_numpy(np.int64).view(np.uint64)
    depth = max(0, int(np.ceil(np.log2(max(1, n / leaf_size)))))
    tree = build_tree(np.sort(sample), depth)
    visits = [at.size for _, at in _route(tree, sample, max_bits)]  # of the sample, per leaf
    parts = int(np.ceil(max(visits, default=0) / max(1, sample.size) * n / visitors)) or 1

    def route(batches):
        for batch in batches:
            fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            home = np.empty(fp.size, np.int64)
            for leaf, at in _route(tree, fp, 0):
                home[at] = leaf
            part = (mix(fp) % np.uint64(parts)).astype(np.int32)  # which of a leaf's tasks a visitor goes to
            for leaf, at in _route(tree, fp, max_bits):
                lives = home[at] == leaf
                for k in range(parts):                             # the leaf's points go to all of them
                    some = at if parts == 1 else at[lives | (part[at] == k)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(some.size, leaf * parts + k, np.int64)), pa.array(fp[some].view(np.int64)),
                         pa.array(home[some] == leaf)], ["leaf", "fp", "lives"])

    def search(table: pa.Table) -> pa.Table:
        fp = table["fp"].to_numpy().view(np.uint64)
        lives = table["lives"].to_numpy()
        u, v = _forest(fp[lives], fp, max_bits)
        return pa.table({"u": u.view(np.int64), "v": v.view(np.int64)})

    shards = distinct.select("fp").mapInArrow(route, "leaf long, fp long, lives boolean")
    return shards.groupBy("leaf").applyInArrow(search, "u long, v long")


def group(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """(doc_id, fp) rows -> one row per distinct fingerprint: fp, first_id, root, component_id (smallest id reachable)."""
    distinct = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = components(materialise(links(distinct.select("fp"), max_bits)))
    rooted = (distinct.join(roots, distinct["fp"] == roots["vertex"], "left")
              .select("fp", "first_id", F.coalesce("root", "fp").alias("root")))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(least, "root").select("fp", "first_id", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits), component_id."""
    prints = materialise(fingerprint(docs, ["doc_id"], shingle), narrow=True)
    return (prints.join(group(prints, max_bits).select("fp", "component_id"), "fp")
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows of ``docs``, one per component: a row with the component's smallest doc_id.

    The text moves once, hashed by (doc_id, fingerprint), which spreads any
    group of copies.  Rows repeated under one id and fingerprint are reduced
    on that same partitioning; which of them stays is arbitrary only in
    columns other than doc_id and the words of the text.
    """
    names = docs.columns
    safe = [f"_c{i}" for i in range(len(names))]
    id_, text = safe[names.index("doc_id")], safe[names.index("text")]
    rows = fingerprint(docs.toDF(*safe), safe, shingle, text, "_fp")
    prints = materialise(fingerprint(docs, ["doc_id"], shingle), narrow=True)
    firsts = group(prints, max_bits)
    # the fingerprint that holds the component's id; of several (repeated ids), the smallest
    keep = (firsts.filter(F.col("first_id").eqNullSafe(F.col("component_id"))).groupBy("root")
            .agg(F.min("fp").alias("k_fp"), F.first("component_id").alias("k_id")))
    joined = rows.join(keep, rows[id_].eqNullSafe(F.col("k_id")) & (rows["_fp"] == F.col("k_fp")))
    return (joined.dropDuplicates([id_, "_fp"]).select(*(F.col(s).alias(n) for s, n in zip(safe, names))))
