"""Cross-tokenizer alignment with an identity fast path.

Every text is encoded by tokenizer A (a byte-level BPE, which gets a leading
space) and by tokenizer B (a piece model, which adds one).  Byte offsets at
which tokens of both end cut the tokens into groups, and the two tokens that
end there are linked.  How often an id pair is linked in the whole corpus is
the pair's count; a document reports the sum of its links' counts and how many
of its links are the best of their B id.

Method.  ``same`` is an array over A's vocabulary: the B id with the same bytes.
A group of one A and one B token with the same bytes is counted in a vector as
long as that vocabulary, one vector a task; only the links of all other groups
("irregular") enter the shuffle that counts pairs.

Plan.  Texts are read and encoded once and never shuffled: each leaves a narrow
row (digest columns, 2 bytes an identity link, 4 bytes an irregular one; twice
that for vocabularies over 65,536), which is checkpointed.  A second pass counts, a third looks the counts up.  What the
lookup needs is broadcast in a size that a vocabulary or a parameter bounds:
the identity vector (A ids), the highest count of each B id, and the most
frequent irregular pairs, at most ``table_pairs`` of them.  Links of rarer pairs
find their counts in an ordinary join on the pair, so the result is exact at
every size; on skewed text they are few.

Edge cases: NULL and empty texts, and texts whose joined token bytes are not
the space and the text (as where B's pieces lose or replace a character), have
no tokens: zeros and an empty digest.  Very long texts are encoded whole;
repeated rows are rows of their own and each counts; tied counts of one B id
are all its best; an empty table gives an empty result; ids of any type are
carried, other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popstats.llm._spark import in_arrow, materialise
from popstats.llm._text import slices
from popstats.llm.bpe import ByteBPE

SLICE_BYTES = 1 << 20
TABLE_PAIRS = 1 << 20
_B_BITS = 31  # in a lookup, a pair is A id << 31 | B id


def piece_bytes(model) -> list[bytes]:
    """The bytes of every B id: the piece in UTF-8 with U+2581 as space, byte pieces as their byte."""
    return [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
            for i in range(model.get_piece_size())]


def _digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0..n-1 from the left, 0-padded and one column wider, and how many each has."""
    text = np.arange(n).astype(bytes)
    width = text.dtype.itemsize
    table = np.zeros((n, width + 1), np.uint8)
    table[:, :width] = text.view(np.uint8).reshape(n, width)
    return table, np.char.str_len(text).astype(np.int64)


@dataclass
class Aligned:
    """Groups of a slice of texts (those without tokens left out)."""

    a: np.ndarray            # A ids of all texts, one after the other
    b: np.ndarray
    last_a: np.ndarray       # index of each group's last A token
    last_b: np.ndarray
    docs: np.ndarray         # index of each text in the slice
    end_a: np.ndarray        # number of A tokens up to the end of each text
    end_b: np.ndarray
    end_g: np.ndarray        # number of groups up to the end of each text


class Aligner:
    """Both tokenizers of one worker, their ids' bytes and the identity map."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.tok_a = ByteBPE(path_a, added=False)
        self.tok_b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a, self.bytes_b = self.tok_a.bytes, piece_bytes(self.tok_b)
        self.len_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.len_b = np.array([len(x) for x in self.bytes_b], np.int64)
        first: dict[bytes, int] = {}
        for i, x in enumerate(self.bytes_b):
            if not self.tok_b.is_control(i) and not self.tok_b.is_unknown(i) and (x not in first or self.tok_b.is_byte(first[x])):
                first[x] = i
        #: A id -> the B id with the same bytes, or -1
        self.same = np.array([first.get(x, -1) for x in self.bytes_a], np.int64)
        size = max(len(self.bytes_a), len(self.bytes_b))
        self.digits, self.n_digits = _digits(size)
        #: the type in which ids are stored
        self.width = "<u2" if size <= 1 << 16 else "<u4"

    def align(self, texts: list[str | None]) -> Aligned:
        found_a, found_b, docs = [], [], []
        full = [i for i, t in enumerate(texts) if t]
        pieces = self.tok_b.encode([texts[i] for i in full], num_threads=1) if full else []
        for i, b in zip(full, pieces):
            whole = (" " + texts[i]).encode()
            a = self.tok_a.ids(" " + texts[i])
            if (b"".join(map(self.bytes_a.__getitem__, a.tolist())) == whole
                    and b"".join(map(self.bytes_b.__getitem__, b)) == whole):
                found_a.append(a.astype(np.int64))
                found_b.append(np.array(b, np.int64))
                docs.append(i)
        none = np.zeros(0, np.int64)
        a, b = (np.concatenate(x) if x else none for x in (found_a, found_b))
        end_a, end_b = (np.cumsum([x.size for x in xs], dtype=np.int64) for xs in (found_a, found_b))
        # texts have equal byte lengths on both sides, so offsets run on from text to text
        off_a, off_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        at = np.searchsorted(off_a, off_b)
        both = off_a[np.minimum(at, max(0, off_a.size - 1))] == off_b if a.size else np.zeros(0, bool)
        last_a, last_b = at[both], np.flatnonzero(both)
        return Aligned(a, b, last_a, last_b, np.array(docs, np.int64), end_a, end_b, np.searchsorted(last_a, end_a))

    def digests(self, x: Aligned) -> Iterator[str]:
        """SHA-256 of every text's groups, written ``a1,a2|b1;a3|b2``."""
        groups = np.arange(x.last_a.size)
        size_a, size_b = np.diff(x.last_a, prepend=-1), np.diff(x.last_b, prepend=-1)
        group_a, group_b = np.repeat(groups, size_a), np.repeat(groups, size_b)
        place_a = np.arange(x.a.size) + (x.last_b - size_b + 1)[group_a]   # behind the B tokens of earlier groups
        place_b = np.arange(x.b.size) + (x.last_a + 1)[group_b]
        ids = np.empty(x.a.size + x.b.size, np.int64)
        ids[place_a], ids[place_b] = x.a, x.b
        sep = np.full(ids.size, ord(","), np.uint8)
        sep[place_a[x.last_a]], sep[place_b[x.last_b]] = ord("|"), ord(";")
        rows = self.digits[ids]
        rows[:, -1] = sep
        flat = rows[rows != 0]
        ends = np.cumsum(self.n_digits[ids] + 1)[x.end_a + x.end_b - 1]
        for start, end in zip([0, *ends[:-1]], ends):
            yield hashlib.sha256(flat[start:end - 1]).hexdigest()


def encoded(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per document: its id, counts and digest, and its links as packed numbers (``ident``: A ids, ``odd``: pairs)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {id_type}, n_a long, n_b long, n_groups long, groups_sha256 string, row long, ident binary, odd binary")

    def run(batches):
        from pyspark import TaskContext

        aligner = Aligner(path_a, path_b)
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            for part in slices(batch, limit=SLICE_BYTES):
                x = aligner.align(part.column("text").to_pylist())
                la, lb = x.a[x.last_a], x.b[x.last_b]
                single = (np.diff(x.last_a, prepend=-1) == 1) & (np.diff(x.last_b, prepend=-1) == 1)
                fast = single & (aligner.same[la] == lb)
                n = part.num_rows
                out = {k: np.zeros(n, np.int64) for k in ("n_a", "n_b", "n_groups")}
                sha, ident, odd = [""] * n, [b""] * n, [b""] * n
                before = (0, 0, 0)
                for i, ea, eb, eg, digest in zip(x.docs, x.end_a, x.end_b, x.end_g, aligner.digests(x)):
                    out["n_a"][i], out["n_b"][i], out["n_groups"][i] = ea - before[0], eb - before[1], eg - before[2]
                    at = slice(before[2], eg)
                    f, a, b = fast[at], la[at], lb[at]
                    ident[i] = a[f].astype(aligner.width).tobytes()
                    odd[i] = np.stack([a[~f], b[~f]], axis=1).astype(aligner.width).tobytes()
                    sha[i], before = digest, (ea, eb, eg)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(out[k]) for k in ("n_a", "n_b", "n_groups")), pa.array(sha),
                     pa.array(np.arange(row, row + n)), pa.array(ident, pa.binary()), pa.array(odd, pa.binary())],
                    ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "row", "ident", "odd"])
                row += n

    return in_arrow(docs.select("doc_id", "text"), run, schema)


def _ids(blob: bytes, width: str) -> np.ndarray:
    return np.frombuffer(blob, width).astype(np.int64)


def _pairs(blob: bytes, width: str) -> np.ndarray:
    both = _ids(blob, width)
    return both[::2] << _B_BITS | both[1::2]


def pair_counts(rows: DataFrame, same: np.ndarray, width: str) -> DataFrame:
    """``a, b, n, fast``: how often every pair is linked; identity pairs come from the tasks' vectors."""
    vector = same.size

    def run(batches):
        total = np.zeros(vector, np.int64)
        for batch in batches:
            total += np.bincount(_ids(b"".join(batch.column("ident").to_pylist()), width), minlength=vector)
            pairs, n = np.unique(_pairs(b"".join(batch.column("odd").to_pylist()), width), return_counts=True)
            yield _batch(pairs >> _B_BITS, pairs & ((1 << _B_BITS) - 1), n, False)
        used = np.flatnonzero(total)
        yield _batch(used, same[used], total[used], True)

    def _batch(a, b, n, fast):
        return pa.RecordBatch.from_arrays([pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(n.astype(np.int64)),
                                           pa.array(np.full(a.size, fast))], ["a", "b", "n", "fast"])

    counted = in_arrow(rows.select("ident", "odd"), run, "a int, b int, n long, fast boolean")
    return counted.groupBy("a", "b", "fast").agg(F.sum("n").alias("n"))


def _frequent(pairs: DataFrame, most: int) -> int:
    """The least count such that at most ``most`` pairs have it or more (a power of two; from a histogram of few rows)."""
    bucket = F.floor(F.log2("n")).cast("int")
    total, least = 0, 62
    for r in sorted(pairs.groupBy(bucket.alias("k")).count().collect(), reverse=True):
        total += r["count"]
        if total > most:
            break
        least = r["k"]
    return 1 << least


def alignment(docs: DataFrame, path_a: str, path_b: str, table_pairs: int = TABLE_PAIRS) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    sc = docs.sparkSession.sparkContext
    rows = materialise(encoded(docs, path_a, path_b))
    aligner = Aligner(path_a, path_b)
    same, width = aligner.same, aligner.width
    counts = materialise(pair_counts(rows, same, width), narrow=True)
    n_b = int(same.max(initial=0)) + 1
    best_of = {r["b"]: r["m"] for r in counts.groupBy("b").agg(F.max("n").alias("m")).collect()}  # at most B's vocabulary
    best = np.zeros(max([n_b, *(b + 1 for b in best_of)]), np.int64)
    best[list(best_of)] = list(best_of.values())
    identity = np.zeros(same.size, np.int64)
    for r in counts.filter("fast").select("a", "n").collect():  # at most A's vocabulary
        identity[r["a"]] = r["n"]
    odd = counts.filter("NOT fast").select(F.shiftleft(F.col("a").cast("long"), _B_BITS).bitwiseOR(F.col("b")).alias("pair"), "n")
    least = _frequent(odd, table_pairs)
    table = odd.filter(F.col("n") >= least).toPandas().sort_values("pair")  # at most table_pairs rows
    known = sc.broadcast((same, identity, best, table["pair"].to_numpy(np.int64), table["n"].to_numpy(np.int64)))
    mask = (1 << _B_BITS) - 1

    def run(batches):
        same, identity, best, pairs, numbers = known.value
        for batch in batches:
            n_best, total, rare = [], [], []
            for ident, links in zip(batch.column("ident").to_pylist(), batch.column("odd").to_pylist()):
                a, pair = _ids(ident, width), _pairs(links, width)
                at = np.minimum(np.searchsorted(pairs, pair), max(0, pairs.size - 1))
                hit = pairs[at] == pair if pairs.size else np.zeros(pair.size, bool)
                n = numbers[at[hit]]
                n_best.append(int((identity[a] == best[same[a]]).sum() + (n == best[pair[hit] & mask]).sum()))
                total.append(int(identity[a].sum() + n.sum()))
                rare.append(pair[~hit])
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(n_best, pa.int64()), pa.array(total, pa.int64()),
                                                   pa.array(rare, pa.list_(pa.int64()))],
                [*kept, "n_best", "count_sum", "rare"])

    kept = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "row"]
    id_type = docs.schema["doc_id"].dataType.simpleString()
    found = in_arrow(rows, run, f"doc_id {id_type}, n_a long, n_b long, n_groups long, groups_sha256 string, row long, "
                                "n_best long, count_sum long, rare array<long>")
    if odd.filter(F.col("n") < least).limit(1).count():
        # the links that the table lacks: counted per document, joined to their pairs' counts, summed per document
        links = found.select("row", F.explode("rare").alias("pair")).groupBy("row", "pair").agg(F.count(F.lit(1)).alias("times"))
        top = counts.groupBy("b").agg(F.max("n").alias("top"))  # at most B's vocabulary
        priced = odd.filter(F.col("n") < least).withColumn("b", F.col("pair").bitwiseAND(F.lit(mask)).cast("int")).join(F.broadcast(top), "b")
        extra = (links.join(priced, "pair").groupBy("row")
                 .agg(F.sum(F.col("times") * F.col("n")).alias("more_sum"),
                      F.sum(F.when(F.col("n") == F.col("top"), F.col("times")).otherwise(0)).alias("more_best")))
        found = (found.join(extra, "row", "left")
                 .withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0)))
                 .withColumn("count_sum", F.col("count_sum") + F.coalesce("more_sum", F.lit(0))))
    return found.select("doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256")
