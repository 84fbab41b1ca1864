"""Removal of repeated substrings by prefix-free parsing.

Every byte that lies in a ``length``-byte string which also starts in a
document with a smaller doc_id is removed; strings are judged on the input.

Parse.  A rolling hash of ``WIDTH``-byte windows places triggers: a position
is a trigger if its window hash is the least among the windows of some
``length``-byte string (the leftmost, if several are equal).  So every string
of that length holds a trigger that depends on its own bytes alone, and the
strings that share one trigger are the suffixes, cut at ``length``, of one
phrase (the bytes from the first such string's start to the last one's end).
Phrases overlap by less than ``length`` bytes, about one per 16 bytes.

Corpus order of the suffixes is needed only as far as ``length`` bytes, that
is up to which of them are equal, and is put together in two questions to all
shards (``exchange``):

1. parse: each shard sends its distinct triggers with the phrase's
   fingerprint and the smallest doc_id.  Where all shards hold the same
   phrase at a trigger, its suffixes all have the same documents: one
   comparison of doc_ids decides the whole phrase.
2. dictionary: where one trigger has several phrases, a shard sorts the
   suffixes of its distinct phrases (each phrase once, however often it
   occurs; the smallest doc_id of a phrase comes from the parse), and the
   runs of equal ``length``-byte suffixes are compared between shards.

Copies of any number are one dictionary phrase per shard, so the work beyond
the parse follows the size of the dictionary of the places where texts part.

Between shards equal strings are recognised by 56-bit fingerprints, phrases at
one trigger by 48 bits more than the trigger's own 48 (triggers that collide
only count as having several phrases), and, in a
shard, suffixes are sorted by them (not letter by letter: only equality at
``length`` bytes matters).

Edge cases: NULL and empty texts have nothing to remove; a document shorter
than ``length`` is kept whole; documents with the same doc_id do not count as
earlier for each other; NULL doc_ids count as later than all others and not
earlier than each other; matches never cross documents; an empty table gives
an empty result; other columns are not read.  A text longer than a shard is
cut into pieces of a shard each that share ``length - 1`` bytes, so every string
stands in one piece; the removed ranges of its pieces are united at the end.  A
task's memory is about 100 times its shard, and a few times one whole text where
a cut text is put together again.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from popstats.llm._spark import release
from popstats.llm._text import U64, Texts, _powers_to, mix, range_hash
from popstats.llm.exchange import Shard, ask, groups, pack, ranges_for, read, send, send_after

LENGTH = 50
WIDTH = 19
_LAST = np.int64(2**63 - 1)
PARSE, DICTIONARY = 1, 2
SHARD_BYTES = 1 << 20
_SHORT, _LONG = ~U64(0xFFFF), ~U64(0xFF)  # the bits of fingerprints that are sent
SHARDS_PER_RANGE = 4


class Parse:
    """The phrases of one shard: first and last string start, trigger fingerprint, phrase fingerprint, document."""

    def __init__(self, t: Texts, length: int):
        n = t.buf.size
        self.prefix = t.prefix_hash()
        empty = np.zeros(0, np.int64)
        self.first = self.last = self.doc = empty
        self.trigger = self.phrase = np.zeros(0, U64)
        if n < length:
            return
        _, inverse = _powers_to(n + 1)
        windows = mix((self.prefix[WIDTH:] - self.prefix[:-WIDTH]) * inverse[:n - WIDTH + 1])
        # window hash (its high bits) and position in one number: the least is the leftmost trigger
        bits = U64(max(1, int(n).bit_length()))
        key = (windows >> bits) << bits
        key |= np.arange(windows.size, dtype=U64)
        span, have = length - WIDTH + 1, 1
        while 2 * have <= span:
            key = np.minimum(key[:-have], key[have:])
            have *= 2
        if have < span:
            key = np.minimum(key[:key.size - (span - have)], key[span - have:])
        # strings that end inside their document
        delta = np.zeros(n + 1, np.int8)
        size = t.lengths()
        long_ = size >= length
        starts = t.off[:-1][long_]
        delta[starts] += 1
        np.add.at(delta, starts + size[long_] - length + 1, -1)
        valid = np.flatnonzero(np.cumsum(delta[:key.size], dtype=np.int8))
        if not valid.size:
            return
        at = (key[valid] & ((U64(1) << bits) - U64(1))).astype(np.int64)
        del key, delta
        new = np.ones(at.size, bool)
        new[1:] = at[1:] != at[:-1]
        edge = np.flatnonzero(new)
        self.first = valid[edge]
        self.last = valid[np.append(edge[1:], at.size) - 1]
        where = at[edge]
        self.doc = t.text_of(self.first)
        self.trigger = mix(windows[where] + U64(0x9E3779B97F4A7C15)) & _SHORT  # triggers are small hashes: spread them evenly
        self.phrase = mix(range_hash(self.prefix, self.first, self.last + length) + (where - self.first).astype(U64)) & _SHORT | U64(1 << 16)


def _ids(shard: Shard) -> np.ndarray:
    return np.where(shard.null.astype(bool), _LAST, shard.ids)


class Triggers:
    """Distinct triggers of a shard: sorted keys, the one phrase (0: several), least and greatest doc_id."""

    def __init__(self, p: Parse, ids: np.ndarray):
        order, start, self.of = groups(p.trigger)
        self.keys = p.trigger[order][start]
        doc = ids[p.doc][order]
        phrase = p.phrase[order]
        if start.size:
            self.least = np.minimum.reduceat(doc, start)
            self.greatest = np.maximum.reduceat(doc, start)
            low, high = np.minimum.reduceat(phrase, start), np.maximum.reduceat(phrase, start)
            self.phrase = np.where(low == high, low, U64(0))
        else:
            self.least = self.greatest = np.zeros(0, np.int64)
            self.phrase = np.zeros(0, U64)


class Suffixes:
    """Sorted suffixes of the distinct phrases at the triggers that have several phrases."""

    def __init__(self, p: Parse, t: Triggers, ids: np.ndarray, answer: np.ndarray, length: int):
        split = (answer == 2) | ((t.phrase == 0) & (t.least != t.greatest))
        self.at = np.flatnonzero(split[t.of]) if t.of.size else np.zeros(0, np.int64)
        order, start, self.entry = groups(p.phrase[self.at])       # dictionary: each phrase once
        one = self.at[order[start]]
        doc = ids[p.doc[self.at]][order]
        least = np.minimum.reduceat(doc, start) if start.size else np.zeros(0, np.int64)
        n = p.last[one] - p.first[one] + 1
        self.n = n
        self.begin = np.cumsum(n) - n                              # place of a phrase's first suffix
        owner = np.repeat(np.arange(n.size), n)
        s = np.arange(owner.size) - np.repeat(self.begin, n) + p.first[one][owner]
        order, start, self.run = groups(range_hash(p.prefix, s, s + length) & _LONG)
        self.keys = range_hash(p.prefix, s[order[start]], s[order[start]] + length) & _LONG if start.size else np.zeros(0, U64)
        self.least = np.minimum.reduceat(least[owner][order], start) if start.size else np.zeros(0, np.int64)


def _answer(kind: int, keys: np.ndarray, columns: list[np.ndarray], owner: np.ndarray):
    """PARSE: 1 the phrase also stands in a smaller document, 2 the trigger has several phrases, 0 neither.

    DICTIONARY: 1 the suffix also stands in a smaller document.
    """
    least = columns[-1]
    order, start, of = groups(keys)
    lowest = np.minimum.reduceat(least[order], start)[of]
    smaller = lowest < least
    if kind == DICTIONARY:
        return [smaller.astype(np.uint8)], 0, 0
    phrase = columns[0][order]
    low, high = np.minimum.reduceat(phrase, start), np.maximum.reduceat(phrase, start)
    shared = np.diff(np.append(start, keys.size)) > 1
    several = (shared & ((low != high) | (low == 0)))[of]
    return [np.where(several, 2, smaller).astype(np.uint8)], 0, 0


def _runs(covered: np.ndarray, t: Texts):
    """(first, end, text) of the maximal covered runs inside each text."""
    change = np.zeros(covered.size, bool)
    if covered.size:
        change[0] = True
        change[1:] = covered[1:] != covered[:-1]
        inner = t.off[:-1]
        change[inner[inner < covered.size]] = True
    edge = np.flatnonzero(change)
    end = np.append(edge[1:], covered.size)
    keep = covered[edge] if edge.size else np.zeros(0, bool)
    return edge[keep], end[keep], t.text_of(edge[keep])


def _ranges(t: Texts, a: np.ndarray, b: np.ndarray, of: np.ndarray) -> pa.ListArray:
    """Per text, its runs as places in it."""
    base = t.off[of]
    return pa.ListArray.from_arrays(
        pa.array(np.searchsorted(of, np.arange(t.n + 1)), pa.int32()),
        pa.StructArray.from_arrays([pa.array(a - base), pa.array(b - base)], ["start", "end"]))


def _digests(ids, t: Texts, covered: np.ndarray) -> pa.Table:
    """The result rows of texts whose removed bytes are known."""
    a, b, of = _runs(covered, t)
    n_spans = np.bincount(of, minlength=t.n)
    n_removed = np.bincount(of, weights=b - a, minlength=t.n).astype(np.int64)
    sha = []
    for i in range(t.n):
        x, y = t.off[i], t.off[i + 1]
        kept = t.raw[x:y] if not n_spans[i] else t.raw[x:y][~covered[x:y]]
        sha.append(hashlib.sha256(kept.tobytes()).hexdigest())
    return pa.table({"doc_id": ids, "n_bytes": pa.array(t.lengths()), "n_removed": pa.array(n_removed),
                     "n_spans": pa.array(n_spans.astype(np.int64)), "kept_sha256": pa.array(sha, pa.string()),
                     "removed": _ranges(t, a, b, of)})


_SCHEMA = ("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
           "removed array<struct<start:long,end:long>>")


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the removed byte ranges."""
    if not WIDTH < length <= SHARD_BYTES:
        raise ValueError(f"length must be above {WIDTH}, and no more than a shard")
    spark = docs.sparkSession
    shards = pack(docs, SHARD_BYTES, overlap=length - 1)
    log2 = ranges_for(shards, SHARDS_PER_RANGE)

    def emit_parse(shard: Shard):
        t = Triggers(Parse(shard.texts, length), _ids(shard))
        yield PARSE, t.keys, [t.phrase, t.least]

    def emit_dictionary(shard: Shard, answers):
        if PARSE in answers:
            ids, p = _ids(shard), Parse(shard.texts, length)
            s = Suffixes(p, Triggers(p, ids), ids, answers[PARSE][0], length)
            yield DICTIONARY, s.keys, [s.least]

    def covered(shard: Shard, answers) -> np.ndarray:
        t = shard.texts
        delta = np.zeros(t.buf.size + 1, np.int32)
        if PARSE in answers:
            ids, p = _ids(shard), Parse(t, length)
            own, reply = Triggers(p, ids), answers[PARSE][0]
            doc = ids[p.doc]
            several = ((reply == 2) | ((own.phrase == 0) & (own.least != own.greatest)))[own.of]
            gone = ~several & ((reply[own.of] == 1) | (doc > own.least[own.of]))
            np.add.at(delta, p.first[gone], 1)
            np.add.at(delta, p.last[gone] + length, -1)
            if DICTIONARY in answers:
                s = Suffixes(p, own, ids, reply, length)
                n = s.n[s.entry]
                owner = np.repeat(np.arange(s.at.size), n)
                step = np.arange(owner.size) - np.repeat(np.cumsum(n) - n, n)
                run = s.run[s.begin[s.entry][owner] + step]
                hit = (answers[DICTIONARY][0][run] == 1) | (doc[s.at][owner] > s.least[run])
                where = p.first[s.at][owner][hit] + step[hit]
                np.add.at(delta, where, 1)
                np.add.at(delta, where + length, -1)
        return np.cumsum(delta[:-1]) > 0

    def finish(shard: Shard, answers) -> pa.Table:
        return _digests(shard.id_column(), shard.texts, covered(shard, answers))

    def finish_pieces(shard: Shard, answers) -> pa.Table:
        t = shard.texts
        ranges = _ranges(t, *_runs(covered(shard, answers), t))
        return pa.table({"doc_id": shard.id_column(), "row": pa.array(shard.row, pa.int64()), "piece": pa.array(shard.piece, pa.int32()),
                         "bytes": pa.array([t.bytes_of(i) for i in range(t.n)], pa.binary()), "removed": ranges})

    step = SHARD_BYTES - (length - 1)

    def whole(pieces: pa.Table) -> pa.Table:
        pieces = pieces.sort_by("piece")
        raw = [np.frombuffer(x.as_buffer(), np.uint8) for x in pieces["bytes"]]
        t = Texts(pa.array([], pa.string()))
        t.raw = t.buf = np.concatenate([x[:step] for x in raw[:-1]] + raw[-1:])
        t.off, t.n = np.array([0, t.raw.size]), 1
        gone = np.zeros(t.raw.size, bool)
        for k, ranges in enumerate(pieces["removed"].to_pylist()):
            for r in ranges:
                gone[k * step + r["start"]:k * step + r["end"]] = True
        return _digests(pieces["doc_id"].slice(0, 1), t, gone)

    parse = ask(send(shards, emit_parse, log2), _answer)
    release(spark)
    dictionary = ask(send_after(shards, parse, emit_dictionary, log2), _answer)
    release(spark)
    answers = parse.unionByName(dictionary)
    rest, cut = ([x.filter(f"shard % 2 = {k}") for x in (shards, answers)] for k in (0, 1))
    pieces = read(*cut, finish_pieces, "doc_id long, row long, piece int, bytes binary, removed array<struct<start:long,end:long>>")
    return read(*rest, finish, _SCHEMA).unionByName(pieces.groupBy("row").applyInArrow(whole, _SCHEMA))
