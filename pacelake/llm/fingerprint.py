"""Document fingerprints by Order MinHash (operator 2).

The k-mers of a text's code points are numbered by occurrence, so equal k-mers
at different places differ. Each of ``m`` hash functions selects the ``l``
numbered k-mers of smallest hash and keeps them in text order; the hash of that
tuple is one component of the signature. Two components agree when the same
k-mers are selected in the same order, so their share of agreement follows the
edit distance and not only the sets of k-mers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacelake.llm.common import documents, partitions
from pacelake.llm.text import BASE, U64, mix

K, L, M = 6, 2, 32
NO_ID = -(2**63)
PAD = 0x110000  # no code point
PARTS = 20_000  # at most so many ranges of ids are cut; beyond that they grow with the corpus
NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_FACTORS = mix(np.arange(1, M + 1, dtype=np.uint64) * BASE) | U64(1)


def numbered_kmers(points: np.ndarray, k: int = K) -> np.ndarray:
    """Hashes of the occurrence-numbered k-mers of a text's code points, in
    text order. Every text is taken with k - 1 paddings on either side, so that
    its first and last points are in as many k-mers as others and short texts
    are compared like long ones; an empty text has none."""
    if not len(points):
        return np.zeros(0, np.uint64)
    pad = np.full(k - 1, PAD, np.uint32)
    points = np.concatenate([pad, points.astype(np.uint32), pad])
    n = len(points)
    with np.errstate(over="ignore"):
        x = (points.astype(np.uint64) + U64(1)) * U64(0xD6E8FEB86659FD93)
        h = np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            h = h * BASE + x[j : n - k + 1 + j]
        h = mix(h)
        # sorted with their places in the lowest bits: equal k-mers in text order
        at, bits = np.arange(len(h)), U64(len(h).bit_length())
        s = np.sort(h >> bits << bits | at.astype(np.uint64))
        order, same = (s & ((U64(1) << bits) - U64(1))).astype(np.int64), s >> bits
        new = np.concatenate([[True], same[1:] != same[:-1]])
        nth = np.empty(len(h), np.uint64)
        nth[order] = at - np.maximum.accumulate(np.where(new, at, 0))
        return mix(h + nth * BASE + U64(k))


def signature(kmers: np.ndarray, l: int = L, m: int = M) -> np.ndarray:
    """m components of 32 bits; zeros for no k-mers."""
    n = len(kmers)
    if not n:
        return np.zeros(m, np.uint32)
    l = min(l, n)
    room = 16.0 + l
    while True:
        bound = U64(2**64 - 1) if room >= n else U64(int(room / n * 2**64))
        rows, cols, vals = [], [], []
        step = 32_768
        for a in range(0, n, step):
            with np.errstate(over="ignore"):
                v = kmers[None, a : a + step] * _FACTORS[:m, None]  # the high bits of a product by an odd factor
            hit = np.flatnonzero(v <= bound)
            r, c = np.divmod(hit, v.shape[1])
            rows.append(r)
            cols.append(c + a)
            vals.append(v.ravel()[hit])
        r, c, v = np.concatenate(rows), np.concatenate(cols), np.concatenate(vals)
        count = np.bincount(r, minlength=m)
        if count.min() >= l:
            break
        room *= 4
    order = np.lexsort((v, r))  # numbered k-mers differ, and so do their products
    first = np.cumsum(count) - count
    picked = np.sort(c[order][first[:, None] + np.arange(l)], axis=1)  # in text order
    out = np.zeros(m, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(l):
            out = mix(out * BASE + kmers[picked[:, j]])
    return (out >> U64(32)).astype(np.uint32)


def fingerprint(text: str) -> str:
    """Signature of a text as lowercase hex, 8 digits a component."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return signature(numbered_kmers(points)).astype(">u4").tobytes().hex()


def likeness(a: str, b: str) -> float:
    """Share of equal components of two fingerprints (0 to 1)."""
    return sum(a[i : i + 8] == b[i : i + 8] for i in range(0, 8 * M, 8)) / M


def in_order(docs: DataFrame) -> DataFrame:
    """Rows (part, flag, id, text), sorted by part, id and text within their
    partitions, so that the next row of a part is the next document.

    Parts are ranges of ids cut at ids that occur (approximate quantiles, a
    bounded list). The rows of a range's first id are also sent, flagged, to
    the end of the part before (those of the first range to the last part): no
    part needs to look into another.
    """
    want = min(PARTS, 4 * partitions(docs.sparkSession))
    own = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    shares = [k / want for k in range(1, want)]
    found = own.agg(F.min("id").alias("low"), F.percentile_approx("id", shares, 10 * want).alias("cuts")).first()
    bounds = np.array(sorted({found["low"], *found["cuts"]}) if found["cuts"] else [0], np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy()
            part = np.searchsorted(bounds, ids, side="right") - 1
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(np.zeros(len(ids), np.int8)), *batch.columns], names=["part", "flag", "id", "text"])
            first = np.flatnonzero(bounds[part] == ids)
            if len(first):
                before = (part[first] - 1) % len(bounds)
                again = [c.take(pa.array(first)) for c in batch.columns]
                yield pa.RecordBatch.from_arrays([pa.array(before, pa.int32()), pa.array(np.ones(len(first), np.int8)), *again], names=["part", "flag", "id", "text"])

    dealt = own.mapInArrow(deal, "part int, flag byte, id long, text string")
    return dealt.repartition("part").sortWithinPartitions("part", "flag", "id", "text")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.

    The edited text replaces the last quarter of the code points by the first
    as many (or all) of the next document by doc_id, nulls first; rows with the
    same doc_id follow one another by text, and a single document is its own
    next. Null texts count as empty; two empty texts are alike (1.0), an empty
    and another text are not. Extra columns are ignored.
    """
    rows = in_order(docs)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (part, id, text, fingerprint) of the row that waits for its next
        for batch in batches:
            out = []
            for part, flag, i, text in zip(*(batch.column(c).to_pylist() for c in ("part", "flag", "id", "text"))):
                if held is None and flag:
                    continue  # a further row of the next range's first id
                mark = fingerprint(text)
                if held is not None:
                    _, held_id, own, own_mark = held
                    k = len(own) // 4
                    edited = own[: len(own) - k] + text[:k]
                    edited_mark = own_mark if edited == own else fingerprint(edited)
                    out.append((held_id, len(own), hashlib.sha256(edited.encode()).hexdigest(), own_mark, edited_mark, likeness(own_mark, edited_mark), likeness(own_mark, mark)))
                held = None if flag else (part, i, text, mark)
            if out:
                ids, *rest = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array([None if i == NO_ID else i for i in ids], pa.int64()), *map(pa.array, rest)], names=NAMES)

    return rows.mapInArrow(work, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op2_fingerprint(spark, sf_dir: str) -> DataFrame:
    """Order MinHash fingerprints of all documents and their edited texts."""
    return fingerprints(documents(spark, sf_dir))
