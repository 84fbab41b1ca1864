"""Benchmark decontamination with suffix arrays over the training documents.

Documents are scanned in shards (slices of a task's Arrow batches, whole
documents each).  A shard's words become numbers of the benchmark's
vocabulary (0: a word that no item has, and the end of a document), and its
suffixes are sorted into a suffix array.  A suffix that does not start with
the first words (``ANCHOR``, or the whole window where that is shorter) of
some test suffix can match no window, so only the others are put into the
array; this leaves every match of a window in place.  Windows are
binary-searched in it: the range of a window's words gives all locations.
The test suffixes are sorted too, by all their words up to their item's end;
every place of the array is binary-searched among them, and its neighbours
give its longest verbatim match (of several, the first item's).

Scale: the documents are neither shuffled nor sorted globally, and a shard's
memory is bounded.  The benchmark is sent to the tasks in blocks of at most
about ``block_bytes`` (hashed by item, sized before they are collected).
Every block but the first is a pass of its own, whose findings are written to
the checkpoint folder by the digest of the text; equal texts have equal
findings.  They are joined to the documents by that digest (broadcast where
they are at most ``block_bytes``) and united with those of the first block.
The driver and a task hold one block at a time, never a whole large benchmark.

Edge cases: a NULL or empty text (either table) has no words and no windows;
an item with fewer words than the window is one window; a NULL item_id
counts as the empty string; repeated items and rows do not change counts of
distinct ids; empty tables give no hits or no rows; other columns of the
documents, whatever their names, are carried through by ``decontaminate``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popstats.llm._spark import in_arrow, materialise
from popstats.llm._text import U64, WORD_ALNUM, Texts, chain, range_hash, slices

WINDOW = 13
ANCHOR = 3
BLOCK_BYTES = 16 << 20

_RESULT = [
    ("_n_words", "long", pa.int64()),
    ("_hits", "array<struct<a:int,b:int>>", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))),
    ("_items", "array<string>", pa.list_(pa.string())),
    ("_longest", "struct<n_words:long,item_id:string,start:long,end:long>",
     pa.struct([("n_words", pa.int64()), ("item_id", pa.string()), ("start", pa.int64()), ("end", pa.int64())])),
]


def _isin_sorted(values: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in the sorted table, whether it is there)."""
    if not table.size:
        return np.zeros(values.size, np.int64), np.zeros(values.size, bool)
    at = np.minimum(np.searchsorted(table, values), table.size - 1)
    return at, table[at] == values


class _Lookup:
    """Membership in a set of 64-bit hashes, with a bitmap in front of the binary search."""

    def __init__(self, values: np.ndarray):
        self.table = np.unique(values)
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(self.table >> U64(44)).astype(np.int64)] = True

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions of the members among ``values``, their places in the table)."""
        maybe = np.flatnonzero(self.bits[(values >> U64(44)).astype(np.int64)])
        at, ok = _isin_sorted(values[maybe], self.table)
        return maybe[ok], at[ok]


def _records(ids: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """The ``width`` word numbers from each position as fixed-width byte strings that sort like the sequences."""
    take = np.minimum(at[:, None] + np.arange(width), ids.size - 1)
    words = ids[take].astype(">u4")
    words[at[:, None] + np.arange(width) >= ids.size] = 0
    return np.ascontiguousarray(words).view(f"S{4 * width}").ravel()


class TestSuffixes:
    """The benchmark's side: vocabulary, windows, suffixes."""

    __test__ = False

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.window = window
        names = sorted({i for i, _ in items})
        number = {n: k for k, n in enumerate(names)}
        self.names = names
        t = Texts(pa.array([x for _, x in items], pa.string()), lower=True)
        starts, ends, owner = t.spans(WORD_ALNUM)
        h = range_hash(t.prefix_hash(), starts, ends)
        self.vocab = _Lookup(h)
        word = np.searchsorted(self.vocab.table, h).astype(np.int64) + 1
        n = np.bincount(owner, minlength=t.n)
        first = np.concatenate([[0], np.cumsum(n)])[:-1]
        self.ids = np.zeros(word.size + t.n + 1, np.int64)      # a 0 after every item
        place = np.arange(word.size) + owner
        self.ids[place] = word
        self.item_of = np.zeros(self.ids.size, np.int64)
        self.item_of[place] = np.array([number[i] for i, _ in items], np.int64)[owner] if word.size else 0
        self.left = np.zeros(self.ids.size, np.int64)           # words from here to the item's end
        self.left[place] = (first + n)[owner] - np.arange(word.size)
        length = np.minimum(n, window)[owner]
        self.win_at = place[self.left[place] >= length]
        self.win_len = length[self.left[place] >= length]
        self.suffix_at = place
        self.grams = {}
        for g in range(1, ANCHOR + 1):
            own = self.win_at[np.minimum(self.win_len, ANCHOR) == g]
            if g == ANCHOR:
                own = np.union1d(own, place[self.left[place] >= g])
            if own.size:
                self.grams[g] = _Lookup(_gram(self.ids, own, g))
        # windows by content: range bounds for the binary search, and the items of each
        rec = _records(self.ids, self.win_at, window)
        raw = np.frombuffer(rec.tobytes(), np.uint8).reshape(-1, 4 * window).copy()
        beyond = np.arange(4 * window) >= 4 * self.win_len[:, None]
        low, high = raw.copy(), raw
        low[beyond] = 0
        high[beyond] = 255
        key = np.concatenate([low, high], axis=1) if raw.size else np.zeros((0, 8 * window), np.uint8)
        both = np.ascontiguousarray(key).view(f"S{8 * window}").ravel()
        _, one, inverse = np.unique(both, return_index=True, return_inverse=True)
        self.low = np.ascontiguousarray(low[one]).view(f"S{4 * window}").ravel()
        self.high = np.ascontiguousarray(high[one]).view(f"S{4 * window}").ravel()
        self.w_len = self.win_len[one]
        pair = np.unique(np.stack([inverse, self.item_of[self.win_at]], axis=1), axis=0) if inverse.size else np.zeros((0, 2), np.int64)
        self.w_items = pair[:, 1]
        self.w_first = np.searchsorted(pair[:, 0], np.arange(one.size + 1))
        # every suffix, in the order of all its words, for the longest matches
        at = place[self.left[place] >= ANCHOR]
        at = at[np.argsort(_whole_order(self.ids, self.left)[at], kind="stable")]
        raw = np.frombuffer(_records(self.ids, at, window).tobytes(), np.uint8).reshape(-1, 4 * window).copy()
        raw[np.arange(4 * window) >= 4 * self.left[at][:, None]] = 0
        self.s_at = at
        self.s_item = self.item_of[at]
        self.s_rec = raw.view(f"S{4 * window}").ravel()


def _whole_order(ids: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Rank of the suffix at every position, up to its item's end, by prefix doubling (equal suffixes share a rank)."""
    rank, k, most = ids, 1, left.max(initial=0)
    while k < most:
        far = np.minimum(np.arange(ids.size) + k, ids.size - 1)
        values, rank = np.unique(rank * (ids.size + 1) + np.where(left > k, rank[far], 0), return_inverse=True)
        k *= 2
        if values.size == ids.size:
            break
    return rank


def _gram(ids: np.ndarray, at: np.ndarray, g: int) -> np.ndarray:
    return chain(*(ids[np.minimum(at + k, ids.size - 1)].astype(U64) for k in range(g)), np.full(at.size, g, U64))


def _expand(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the range, element) for all elements of the ranges [first, last)."""
    n = last - first
    owner = np.repeat(np.arange(n.size), n)
    return owner, np.arange(owner.size) - np.repeat(np.cumsum(n) - n, n) + first[owner]


def _runs(flag: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs [start, end) of True that stay within one owner."""
    if not flag.size:
        z = np.zeros(0, np.int64)
        return z, z
    change = np.ones(flag.size, bool)
    change[1:] = (flag[1:] != flag[:-1]) | (owner[1:] != owner[:-1])
    edge = np.flatnonzero(change)
    ends = np.append(edge[1:], flag.size)
    return edge[flag[edge]], ends[flag[edge]]


def search_shard(t: Texts, test: TestSuffixes):
    """Per text: word count, hit flags per word, (text, item) pairs, and the longest match."""
    starts, ends, doc = t.spans(WORD_ALNUM)
    n_words = np.bincount(doc, minlength=t.n).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(n_words)])
    place = np.arange(starts.size) + doc
    ids = np.zeros(starts.size + t.n + 1, np.int64)
    member, number = test.vocab.find(range_hash(t.prefix_hash(), starts, ends))
    ids[place[member]] = number + 1
    # suffixes that share their first words with a test suffix, in order: the shard's suffix array
    known = np.flatnonzero(ids)
    chosen = np.zeros(ids.size, bool)
    for g, lookup in test.grams.items():
        at = known
        for k in range(1, g):
            at = at[ids[np.minimum(at + k, ids.size - 1)] > 0]
        hit, _ = lookup.find(_gram(ids, at, g))
        chosen[at[hit]] = True
    at = np.flatnonzero(chosen)
    hit_words = np.zeros(starts.size, bool)
    longest = np.zeros((t.n, 4), np.int64)  # words, item, first word, end word
    pairs = np.zeros((0, 2), np.int64)
    if not at.size:
        return n_words, first, hit_words, doc, pairs, longest, starts, ends
    rec = _records(ids, at, test.window)
    order = np.argsort(rec, kind="stable")
    array, sorted_rec = at[order], rec[order]
    owner_of = np.zeros(ids.size, np.int64)
    owner_of[place] = doc
    # windows: all locations
    lo = np.searchsorted(sorted_rec, test.low, "left")
    hi = np.searchsorted(sorted_rec, test.high, "right")
    win, element = _expand(lo, np.maximum(hi, lo))
    if win.size:
        pos = array[element]
        delta = np.zeros(starts.size + 1, np.int64)
        word0 = pos - owner_of[pos]
        np.add.at(delta, word0, 1)
        np.add.at(delta, word0 + test.w_len[win], -1)
        hit_words = np.cumsum(delta[:-1]) > 0
        seen = np.unique(owner_of[pos] * len(test.low) + win)
        d, w = seen // len(test.low), seen % len(test.low)
        k, e = _expand(test.w_first[w], test.w_first[w + 1])
        code = np.unique(d[k] * len(test.names) + test.w_items[e])
        pairs = np.stack([code // len(test.names), code % len(test.names)], axis=1)
    # every place of the array: its neighbours among the test suffixes hold its longest match
    if not test.s_at.size:
        return n_words, first, hit_words, doc, pairs, longest, starts, ends
    spot = np.searchsorted(test.s_rec, sorted_rec, "left")
    length = np.zeros(spot.size, np.int64)
    for side in (-1, 0):
        k = np.clip(spot + side, 0, test.s_at.size - 1)
        length = np.maximum(length, _common(ids, array, test.ids, test.s_at[k], test.window))
    # as long as the records: on among all suffixes with these words
    lo, hi = np.zeros((2, spot.size), np.int64)
    full = np.flatnonzero(length == test.window)
    length[full], lo[full], hi[full] = _extended(
        ids, array[full], test, spot[full], np.searchsorted(test.s_rec, sorted_rec[full], "right"))
    d = owner_of[array]
    top = np.zeros(t.n, np.int64)
    np.maximum.at(top, d, length)
    best = np.flatnonzero((length == top[d]) & (length >= ANCHOR))
    if best.size:
        short = best[length[best] < test.window]
        raw = np.frombuffer(sorted_rec[short].tobytes(), np.uint8).reshape(-1, 4 * test.window).copy()
        beyond = np.arange(4 * test.window) >= 4 * length[short][:, None]
        for fill, side, bound in ((0, "left", lo), (255, "right", hi)):
            raw[beyond] = fill
            bound[short] = np.searchsorted(test.s_rec, raw.view(f"S{4 * test.window}").ravel(), side)
        # the first item of each distinct range of suffixes
        span, which = np.unique(np.stack([lo[best], hi[best]], axis=1), axis=0, return_inverse=True)
        item = np.minimum.reduceat(np.append(test.s_item, len(test.names)), span.ravel())[::2][which.ravel()]
        word0 = array[best] - d[best]
        keep = np.lexsort((word0, item, d[best]))
        keep = keep[np.unique(d[best][keep], return_index=True)[1]]
        n = length[best][keep]
        longest[d[best][keep]] = np.stack([n, item[keep], word0[keep], word0[keep] + n], axis=1)
    return n_words, first, hit_words, doc, pairs, longest, starts, ends


def _common(a: np.ndarray, at_a: np.ndarray, b: np.ndarray, at_b: np.ndarray, limit: int | None) -> np.ndarray:
    """Number of equal words from both positions on (0 ends a text and matches nothing)."""
    out = np.zeros(at_a.size, np.int64)
    live = np.arange(at_a.size)
    k = 0
    while live.size and (limit is None or k < limit):
        x = a[np.minimum(at_a[live] + k, a.size - 1)]
        y = b[np.minimum(at_b[live] + k, b.size - 1)]
        live = live[(x == y) & (x > 0)]
        k += 1
        out[live] = k
    return out


def _extended(ids: np.ndarray, pos: np.ndarray, test: TestSuffixes, lo: np.ndarray, hi: np.ndarray):
    """(words, first, end): the longest match from each position, and the range of test suffixes that have it.

    ``[lo, hi)`` are the suffixes that share the first ``window`` words; they
    are in order, so every further word narrows the range by binary search.
    """
    n, lo, hi = np.full(pos.size, test.window, np.int64), lo.copy(), hi.copy()
    live = np.arange(pos.size)
    k = test.window
    while live.size:
        x = ids[np.minimum(pos[live] + k, ids.size - 1)]
        live, x = live[x > 0], x[x > 0]
        a, b = (_first_place(test, k, lo[live], hi[live], y) for y in (x, x + 1))
        live, a, b = live[a < b], a[a < b], b[a < b]
        k += 1
        n[live], lo[live], hi[live] = k, a, b
    return n, lo, hi


def _first_place(test: TestSuffixes, k: int, lo: np.ndarray, hi: np.ndarray, least: np.ndarray) -> np.ndarray:
    """The first suffix of each range [lo, hi) whose word ``k`` is at least ``least``."""
    lo, hi = lo.copy(), hi.copy()
    wide = np.flatnonzero(lo < hi)
    while wide.size:
        mid = (lo[wide] + hi[wide]) // 2
        less = test.ids[test.s_at[mid] + k] < least[wide]
        lo[wide[less]] = mid[less] + 1
        hi[wide[~less]] = mid[~less]
        wide = wide[lo[wide] < hi[wide]]
    return lo


def _united(first: np.ndarray, hit: np.ndarray, previous) -> np.ndarray:
    """``hit`` with the runs that earlier blocks found."""
    if previous is None:
        return hit
    hit = hit.copy()
    for i, runs in enumerate(previous.to_pylist()):
        for r in runs:
            hit[first[i] + r["a"]:first[i] + r["b"]] = True
    return hit


def _pass(items: list[tuple[str, str]], keep: list[str], text: str, window: int, again: bool):
    names = [*keep, *(n for n, _, _ in _RESULT)]

    def run(batches):
        test = TestSuffixes(items, window)
        for batch in batches:
            for part in slices(batch, text):
                t = Texts(part.column(text), lower=True)
                n_words, first, hit, doc, pairs, longest, starts, ends = search_shard(t, test)
                hit = _united(first, hit, part.column("_hits") if again else None)
                a, b = _runs(hit, doc)
                per = np.searchsorted(a, first)
                base = np.repeat(first[:-1], np.diff(per))
                hits = pa.ListArray.from_arrays(
                    pa.array(per, pa.int32()),
                    pa.StructArray.from_arrays([pa.array(a - base, pa.int32()), pa.array(b - base, pa.int32())], ["a", "b"]))
                found: list[list[str]] = [[] for _ in range(t.n)]
                for d, i in pairs.tolist():
                    found[d].append(test.names[i])
                top = [None] * t.n
                for d in np.flatnonzero(longest[:, 0]).tolist():
                    n, i, w0, w1 = longest[d].tolist()
                    top[d] = {"n_words": n, "item_id": test.names[i], "start": int(starts[w0] - t.off[d]),
                              "end": int(ends[w1 - 1] - t.off[d])}
                if again:
                    for d, old in enumerate(part.column("_items").to_pylist()):
                        found[d] = sorted({*found[d], *old})
                    for d, old in enumerate(part.column("_longest").to_pylist()):
                        top[d] = min((x for x in (old, top[d]) if x), key=lambda x: (-x["n_words"], x["item_id"], x["start"]), default=None)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k) for k in keep), pa.array(n_words), hits.cast(_RESULT[1][2]),
                     pa.array(found, _RESULT[2][2]), pa.array(top, _RESULT[3][2])], names)

    return run


def _blocks(benchmark: DataFrame, block_bytes: int):
    """The items, in blocks whose size is known before they are collected."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("i"),
                             F.col("text").alias("x")).filter(F.length("x") > 0).distinct()
    size = items.agg(F.sum(F.octet_length("x") + 16)).first()[0] or 0
    n = max(1, -(-size // block_bytes))
    for k in range(n):
        rows = items.filter(F.pmod(F.xxhash64("i", "x"), F.lit(n)) == k) if n > 1 else items
        yield [(r["i"], r["x"]) for r in rows.collect()]


def _schema(keep: dict[str, str]) -> str:
    return ", ".join([*(f"`{n}` {t}" for n, t in keep.items()), *(f"{n} {t}" for n, t, _ in _RESULT)])


def _found(rows: DataFrame, items: list[tuple[str, str]], text: str, window: int) -> DataFrame:
    """What one block finds, per distinct text (``_key``, its digest) that has anything of it."""
    keyed = rows.select(F.sha2(F.col(text), 256).alias("_key"), F.col(text).alias("_text"))
    found = in_arrow(keyed, _pass(items, ["_key"], "_text", window, False), _schema({"_key": "string"}))
    return materialise(found.drop("_n_words").filter(F.col("_longest").isNotNull() | (F.size("_items") > 0))
                       .dropDuplicates(["_key"]), narrow=True)


def _with_found(rows: DataFrame, found: list[DataFrame], text: str, block_bytes: int) -> DataFrame:
    """``rows`` with the findings of several blocks as ``_hits`` (runs may overlap), ``_items`` and ``_longest``."""
    union = found[0]
    for f in found[1:]:
        union = union.unionByName(f)
    longest = F.when(F.col("_longest").isNotNull(), F.struct(-F.col("_longest.n_words"), "_longest.item_id", "_longest.start"))
    # a text has at most one row per block
    per_text = materialise(union.groupBy("_key").agg(
        F.flatten(F.collect_list("_hits")).alias("_hits"), F.flatten(F.collect_list("_items")).alias("_items"),
        F.min_by("_longest", longest).alias("_longest")), narrow=True)
    item_bytes = F.aggregate("_items", F.lit(0).cast("long"), lambda n, i: n + F.octet_length(i) + 16)
    size = per_text.agg(F.sum(F.size("_hits") * 16 + item_bytes + 256)).first()[0] or 0
    joined = rows.withColumn("_key", F.sha2(F.col(text), 256)).join(
        F.broadcast(per_text) if size <= block_bytes else per_text, "_key", "left")
    for name, kind, _ in _RESULT[1:3]:
        joined = joined.withColumn(name, F.coalesce(name, F.array().cast(kind)))
    return joined


def scan(docs: DataFrame, benchmark: DataFrame, keep: list[str], text: str = "text", window: int = WINDOW,
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``keep`` columns and, per row, ``_n_words``, hit word runs ``_hits``, ``_items`` and the ``_longest`` match."""
    types = {f.name: f.dataType.simpleString() for f in docs.select(*dict.fromkeys([*keep, text])).schema.fields}
    rows = docs.select(*types)
    blocks = _blocks(benchmark, block_bytes)
    first = next(blocks)
    found = [_found(rows, items, text, window) for items in blocks]
    out = _with_found(rows, found, text, block_bytes) if found else rows
    return (in_arrow(out, _pass(first, list(types), text, window, bool(found)), _schema(types))
            .select(*keep, *(n for n, _, _ in _RESULT)))


def _n_hit():
    return F.aggregate("_hits", F.lit(0).cast("long"), lambda s, r: s + r["b"] - r["a"])


def _contaminated(n_hit, n_words, share: int = 20):
    return (n_hit > 0) & (F.lit(share) * n_hit >= n_words)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: word and hit counts, the items found, the verdict, hit runs and the longest verbatim match."""
    s = scan(docs, benchmark, ["doc_id"], "text", window, block_bytes).withColumn("n_hit", _n_hit())
    return s.select("doc_id", F.col("_n_words").alias("n_words"), "n_hit", F.array_sort("_items").alias("items"),
                    _contaminated(F.col("n_hit"), F.col("_n_words")).alias("contaminated"),
                    F.col("_hits").alias("hit_runs"), F.col("_longest").alias("longest"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns kept."""
    names = docs.columns
    safe = [f"_c{i}" for i in range(len(names))]
    s = scan(docs.toDF(*safe), benchmark, safe, safe[names.index("text")], window, block_bytes)
    return (s.filter(~_contaminated(_n_hit(), F.col("_n_words")))
            .select(*(F.col(c).alias(n) for c, n in zip(safe, names))))
