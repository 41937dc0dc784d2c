"""Vectorised text helpers used inside tasks: words, hashes and shingles of a
whole Arrow batch of texts, without a Python object per word.

A word is ``[^\\x20\\x09-\\x0D]+``. Hashes are 64-bit; two different words,
lines or shingles of one corpus are taken as equal only if all 64 bits meet.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
_RNG = np.random.default_rng(20240229)
BYTE_CODE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
BASE = U64(0x9E3779B97F4A7C15)
BASE_INVERSE = U64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser: spreads every input bit over all bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, dtype=np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


def slices(table: pa.RecordBatch, column: str, max_bytes: int = 3_000_000):
    """Cut a batch into row ranges of about ``max_bytes`` of text (a longer
    text stands alone), so that the arrays made per byte stay bounded."""
    lengths = np.asarray(_lengths(table.column(column)))
    total, first = 0, 0
    for i, n in enumerate(lengths):
        if total and total + n > max_bytes:
            yield table.slice(first, i - first)
            total, first = 0, i
        total += int(n)
    if first < table.num_rows:
        yield table.slice(first, table.num_rows - first)


def _lengths(col: pa.Array) -> list[int]:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)


class Texts:
    """Bytes of a batch of texts (nulls as empty) and their offsets."""

    def __init__(self, col: pa.Array):
        col = (col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col).cast(pa.large_string()).fill_null("")
        _, offsets, data = col.buffers()
        offs = np.frombuffer(offsets, dtype=np.int64, count=len(col) + 1 + col.offset)[col.offset :]
        self.raw = (
            np.frombuffer(data, dtype=np.uint8)[offs[0] : offs[-1]] if data is not None else np.zeros(0, dtype=np.uint8)
        )
        self.offsets = offs - offs[0]
        self.n = len(col)
        self._pow = None

    def count(self, flags: np.ndarray) -> np.ndarray:
        """Per text: how many of its bytes are flagged."""
        return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[self.offsets])

    def n_chars(self) -> np.ndarray:
        return self.count((self.raw & 0xC0) != 0x80)

    def span_hashes(self, start: np.ndarray, end: np.ndarray, lower: bool) -> np.ndarray:
        """64-bit hash of every byte span [start, end): equal spans of bytes
        (A-Z lower-cased if asked for) have equal hashes."""
        with np.errstate(over="ignore"):
            if self._pow is None:
                self._pow = powers(BASE, len(self.raw)), powers(BASE_INVERSE, len(self.raw))
            up, down = self._pow
            code = BYTE_CODE[LOWER[self.raw] if lower else self.raw]
            total = np.concatenate([[U64(0)], np.cumsum(code * up[:-1], dtype=np.uint64)])
            return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64) * BASE)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Byte starts and ends of all words, and per text the index of its
        first word (with the total at the end)."""
        solid = ~IS_SPACE[self.raw]
        first = np.zeros(len(solid) + 1, dtype=bool)
        first[self.offsets] = True
        before = np.concatenate([[False], solid[:-1]]) if len(solid) else solid
        after = np.concatenate([solid[1:], [False]]) if len(solid) else solid
        start = np.flatnonzero(solid & (~before | first[:-1]))
        end = np.flatnonzero(solid & (~after | first[1:])) + 1
        return start, end, np.searchsorted(start, self.offsets)


def word_hashes(texts: Texts, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and per text the index of its first word."""
    start, end, at = texts.words()
    return texts.span_hashes(start, end, lower), at


def shingles(hashes: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingle hash, text index, word index in the batch) of every run of
    ``size`` words within one text; texts with fewer words give none."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        acc = np.zeros(n, dtype=np.uint64)
        for j in range(size):
            acc = acc * BASE + hashes[j : j + n]
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    ok = owner[:n] == owner[size - 1 :]
    return mix(acc[ok]), owner[:n][ok], np.flatnonzero(ok)


def text_keys(doc_ids) -> np.ndarray:
    """64-bit keys of row ids (null as -1) that seed per-row random numbers."""
    ids = np.array([-1 if x is None else int(x) for x in doc_ids], dtype=np.int64)
    return mix(ids.view(np.uint64) + BASE)
