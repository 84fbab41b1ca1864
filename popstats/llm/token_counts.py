"""Token counts of a byte-level BPE vocabulary by a map-side two-tier lookup.

A byte-level BPE encodes every pre-token by itself, so a text's count is the
sum of its pre-tokens' lengths.  First tier: a table of the lengths of
frequent pre-tokens, broadcast with a fixed number of entries.  Second tier:
a bounded cache in each Python worker; what both miss is encoded once per
slice by the tokenizer.  No pre-token is shuffled and no text is moved.

The table is only a cache: which pre-tokens are in it decides the speed,
never a count.  It is chosen from at most about ``sample_docs`` documents,
drawn by hash over the whole input (the one place where a sample is used).

Where the pre-token pattern and the tokenizer's own splitter could disagree
on a character (another Unicode version), the character is compared once per
worker and texts that hold a differing one are encoded whole.  Strings of
added tokens inside a text are counted as the library counts them.

Edge cases: NULL and empty text count 0 bytes and 0 tokens; very long texts
are read whole; repeated rows give one row each; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import os
from collections import Counter

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popstats.llm._spark import in_arrow
from popstats.llm._text import slices

# Fixed value: the byte-level pre-token pattern that such vocabularies are made with.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
TABLE_SIZE = 65_536
TABLE_KEY_CHARS = 32
CACHE_SIZE = 400_000
SAMPLE_DOCS = 4_000


class _Lengths(dict):
    """First tier; a miss asks the worker's cache, and what that lacks is noted in ``open`` and counts 0 for now."""

    def __init__(self, table):
        super().__init__(table)
        self.cache: dict[str, int] = {}
        self.open: list[str] = []

    def __missing__(self, token: str) -> int:
        n = self.cache.get(token)
        if n is None:
            self.open.append(token)
            return 0
        return n


class Counting:
    """The tokenizer of one worker with its two tiers."""

    def __init__(self, path: str, table: dict[str, int]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        import json

        spec = json.loads(self.tokenizer.to_str())
        pre = spec.get("pre_tokenizer") or {}
        added = spec.get("added_tokens") or []
        plain = not any(a[k] for a in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
        self.splits = (pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
                       and not spec.get("normalizer") and plain)
        names = sorted((a["content"] for a in added), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.names = names
        self.find = regex.compile(PATTERN).findall
        self.spans = regex.compile(PATTERN).finditer
        self.tiers = _Lengths(table)
        self.known: set[str] = set()
        self.odd: set[str] = set()
        self._check({chr(i) for i in range(128)})

    def _check(self, chars: set[str]) -> None:
        """Compare pattern and tokenizer on characters not seen before."""
        for c in chars:
            probe = f"a{c}a 1{c}1 .{c}. {c}{c} "
            own = [m.span() for m in self.spans(probe)]
            theirs = [s for _, s in self.tokenizer.pre_tokenizer.pre_tokenize_str(probe)] if self.splits else own
            if own != theirs:
                self.odd.add(c)
        self.known |= chars

    def _whole(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def counts(self, texts: list[str | None]) -> list[int]:
        """Token counts of a slice of texts."""
        tiers, find, out, later = self.tiers, self.find, [], []
        for i, text in enumerate(texts):
            if not text:
                out.append(0)
                continue
            if not text.isascii():
                new = set(text) - self.known
                if new:
                    self._check(new)
            if not self.splits or (self.odd and not self.odd.isdisjoint(text)):
                out.append(self._whole(text))
                continue
            parts, n = [text], 0
            if self.added is not None and any(x in text for x in self.names):
                parts = self.added.split(text)
                n = len(parts) - 1
            at = len(tiers.open)
            for part in parts:
                n += sum(map(tiers.__getitem__, find(part)))
            if len(tiers.open) > at:
                later.append((i, at, len(tiers.open)))
            out.append(n)
        if tiers.open:
            misses = list(dict.fromkeys(tiers.open))
            if len(tiers.cache) + len(misses) > CACHE_SIZE:
                tiers.cache.clear()
            encoded = {t: len(e.ids) for t, e in zip(
                misses, self.tokenizer.encode_batch(misses, add_special_tokens=False))}
            for i, a, b in later:
                out[i] += sum(map(encoded.__getitem__, tiers.open[a:b]))
            if len(misses) <= CACHE_SIZE:
                tiers.cache.update(encoded)
            tiers.open.clear()
        return out


def frequent_lengths(docs: DataFrame, path: str, size: int = TABLE_SIZE, sample_docs: int = SAMPLE_DOCS) -> dict[str, int]:
    """The first tier: lengths of the ``size`` most frequent pre-tokens of a bounded hash sample of documents."""
    n = docs.count()
    steps = 1 << 30
    share = min(steps, steps * sample_docs // max(1, n) + 1)
    sample = docs.select("doc_id", "text").filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(steps)) < share)

    def count(batches):
        find, seen = regex.compile(PATTERN).findall, Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                seen.update(t for t in find(text or "") if len(t) <= TABLE_KEY_CHARS)
        top = sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:size]
        lengths = Counting(path, {})
        yield pa.RecordBatch.from_arrays(
            [pa.array([t for t, _ in top], pa.string()), pa.array(lengths.counts([t for t, _ in top]), pa.int32())],
            ["token", "n"])

    rows = sample.select("text").repartition(1).mapInArrow(count, "token string, n int").collect() if n else []
    return {r["token"]: r["n"] for r in rows}


def token_counts(docs: DataFrame, path: str, limit: int = 512, table_size: int = TABLE_SIZE,
                 sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit."""
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path, table_size, sample_docs))

    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        counting = Counting(path, table.value)
        for batch in batches:
            for part in slices(batch):
                texts = part.column("text").to_pylist()
                size = [len(t.encode()) if t and not t.isascii() else len(t or "") for t in texts]
                n = counting.counts(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(size, pa.int64()), pa.array(n, pa.int64()),
                     pa.array([x > limit for x in n])], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return in_arrow(docs.select("doc_id", "text"), run, f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean")
