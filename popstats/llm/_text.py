"""Vectorised byte-level text helpers used inside tasks (numpy over Arrow buffers).

A batch of texts is one byte array plus document offsets.  ``prefix_hash``
gives 64-bit polynomial prefix sums, from which the hash of any byte range
costs one subtraction and one multiplication.  Memory is a small multiple of
one slice; ``slices`` cuts Arrow batches to a byte bound (a single longer
text is a slice of its own and is always processed whole).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
SLICE_BYTES = 4 << 20

# Byte classes.
_SPACE = [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]
WORD_SPACED = np.ones(256, bool)          # [^\x20\x09-\x0D]
WORD_SPACED[_SPACE] = False
WORD_ALNUM = np.zeros(256, bool)          # 0-9 A-Z a-z and every byte of a non-ASCII character
WORD_ALNUM[0x30:0x3A] = True
WORD_ALNUM[0x41:0x5B] = True
WORD_ALNUM[0x61:0x7B] = True
WORD_ALNUM[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)    # A-Z to a-z, nothing else
LOWER[0x41:0x5B] += 0x20

_BASE = 0x9E3779B97F4A7C15 | 5            # odd multiplier of the polynomial hash
_BASE_INV = pow(_BASE, -1, 1 << 64)
_VALUES = np.random.Generator(np.random.PCG64(20240517)).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_powers = [np.ones(1, U64), np.ones(1, U64)]


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers[0].size < n:
        size = max(n, SLICE_BYTES // 2 + 1)
        for k, base in enumerate((_BASE, _BASE_INV)):
            steps = np.full(size, base, U64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=U64)
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every input bit over all 64 output bits (a bijection)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


class Texts:
    """Concatenated UTF-8 bytes of a slice of texts (strings, or bytes that may be part of one); NULL counts as empty."""

    def __init__(self, column, lower: bool = False):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        raw_bytes = pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)
        column = pc.fill_null(column.cast(pa.large_binary() if raw_bytes else pa.large_string()), b"" if raw_bytes else "")
        n = len(column)
        off = np.frombuffer(column.buffers()[1], np.int64, n + 1 + column.offset)[column.offset:]
        data = column.buffers()[2]
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        raw = raw[off[0]:off[-1]]
        self.raw = raw
        self.buf = LOWER[raw] if lower else raw
        self.off = off - off[0]
        self.n = n

    def bytes_of(self, i: int) -> bytes:
        return self.raw[self.off[i]:self.off[i + 1]].tobytes()

    def lengths(self) -> np.ndarray:
        return np.diff(self.off)

    def spans(self, is_member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal runs of member bytes that stay inside one text: start, end, text index."""
        m = is_member[self.buf]
        if not m.size:
            z = np.zeros(0, np.int64)
            return z, z, z
        full = self.off[:-1][np.diff(self.off) > 0]
        before = np.empty_like(m)
        before[0] = False
        before[1:] = m[:-1]
        before[full] = False
        starts = np.flatnonzero(m & ~before)
        after = np.empty_like(m)
        after[-1] = False
        after[:-1] = m[1:]
        after[full[1:] - 1] = False
        ends = np.flatnonzero(m & ~after) + 1
        return starts, ends, self.text_of(starts)

    def text_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.off, positions, side="right") - 1

    def per_text(self, positions: np.ndarray) -> np.ndarray:
        """How many of the (sorted) positions lie in each text."""
        return np.diff(np.searchsorted(positions, self.off))

    def prefix_hash(self) -> np.ndarray:
        power, _ = _powers_to(self.buf.size + 1)
        out = np.zeros(self.buf.size + 1, U64)
        np.cumsum(_VALUES[self.buf] * power[:self.buf.size], out=out[1:])
        return out


def range_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes [start, end); equal bytes give equal hashes wherever they stand."""
    _, inverse = _powers_to(prefix.size)
    return mix((prefix[ends] - prefix[starts]) * inverse[starts] + (ends - starts).astype(U64))


def chain(*hashes: np.ndarray) -> np.ndarray:
    """Order-dependent hash of a sequence of 64-bit hashes."""
    h = hashes[0]
    for x in hashes[1:]:
        h = mix(h * U64(0xD6E8FEB86659FD93) + x)
    return h


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive row slices with at most ``limit`` text bytes each (at least one row)."""
    n = batch.num_rows
    if not n:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
    total = np.concatenate([[0], np.cumsum(np.asarray(lengths.to_numpy(zero_copy_only=False), np.int64))])
    at = 0
    while at < n:
        end = int(np.searchsorted(total, total[at] + limit, side="right")) - 1
        end = min(n, max(end, at + 1))
        yield batch.slice(at, end - at)
        at = end
