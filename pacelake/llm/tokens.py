"""Token ids in binary columns (operator 4).

Documents are dealt out by ranges of ``doc_id``, encoded in that order and
written as Parquet: one row per document with its ids as a list column. Row
groups and pages are small and bounded, the ids are dictionary-encoded (or
delta-encoded), and the page indexes let a reader fetch the ids of some
documents, or only the counts, without reading the rest. Where a document's
ids start in the whole stream follows from the files' order and the counts.

Encoding: the pre-tokenizer of byte-level BPE never joins a non-space with a
space after it, nor a letter with punctuation after it, nor a single line feed
with what follows. A batch is cut at these places by vectorised comparisons of
bytes; every distinct piece is encoded once by the tokenizers library and the
ids are gathered. Texts with other white space or with the text of a special
token are encoded whole by the library.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pacelake.llm.common import documents, ship, written
from pacelake.llm.text import U64, Texts, slices
from pacelake.session import scratch_path

END_ID = 2
CACHE = 1_000_000  # distinct pieces a worker remembers between batches and tasks
_ODD = np.zeros(256, dtype=bool)
_ODD[[0x09, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F]] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_PUNCT = np.zeros(256, dtype=bool)
_PUNCT[0x21:0x7F] = True
_PUNCT[0x30:0x3A] = _PUNCT[65:91] = _PUNCT[97:123] = False
_PUNCT[0x27] = False  # an apostrophe may start a contraction


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _spans(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of spans, one after the other."""
    ends = np.cumsum(size)
    return np.repeat(begin - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


class _Column:
    """Values that are appended to."""

    def __init__(self, kind):
        self.held, self.n = np.empty(1024, kind), 0

    def append(self, values: np.ndarray) -> None:
        if self.n + len(values) > len(self.held):
            self.held = np.concatenate([self.held[: self.n], np.empty(max(self.n // 2, len(values)), self.held.dtype)])
        self.held[self.n : self.n + len(values)] = values
        self.n += len(values)


class _Known:
    """Pieces and their ids in flat arrays (a dict of strings and bytes takes
    ten times the memory), found by the pieces' hashes; a piece whose bytes are
    not those that were kept is not found."""

    def __init__(self):
        self.slots = np.full(1 << 12, -1, np.int32)
        self.hash, self.raw, self.ids = _Column(np.uint64), _Column(np.uint8), _Column(np.int32)
        self.raw_end, self.ids_end = _Column(np.int64), _Column(np.int64)

    def __len__(self) -> int:
        return self.hash.n

    def _home(self, h: np.ndarray) -> np.ndarray:
        return (h >> U64(65 - len(self.slots).bit_length())).astype(np.int64)

    def _settle(self, h: np.ndarray, number: np.ndarray) -> None:
        at = self._home(h)
        while len(at):
            free = self.slots[at] < 0
            self.slots[at[free]] = number[free]
            left = self.slots[at] != number
            at, number = (at[left] + 1) & (len(self.slots) - 1), number[left]

    def find(self, h: np.ndarray, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Numbers of pieces (hashes, bytes, offsets in them), -1 if not known."""
        out, todo, at = np.full(len(h), -1, np.int64), np.arange(len(h)), self._home(h)
        while len(todo):
            i = self.slots[at]
            hit = (i >= 0) & (self.hash.held[i] == h[todo])
            out[todo[hit]] = i[hit]
            on = (i >= 0) & ~hit
            todo, at = todo[on], (at[on] + 1) & (len(self.slots) - 1)
        found = np.flatnonzero(out >= 0)
        begin, size = self.span(self.raw_end, out[found])
        same = size == np.diff(offsets)[found]
        out[found[~same]] = -1
        found, begin, size = found[same], begin[same], size[same]
        differ = np.flatnonzero(self.raw.held[_spans(begin, size)] != raw[_spans(offsets[found], size)])
        out[found[np.searchsorted(np.cumsum(size), differ, side="right")]] = -1
        return out

    @staticmethod
    def span(ends: _Column, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(begin, size) of the pieces' spans."""
        begin = np.where(i > 0, ends.held[i - 1], 0)
        return begin, ends.held[i] - begin

    def add(self, h: np.ndarray, raw: np.ndarray, raw_size: np.ndarray, ids: np.ndarray, ids_size: np.ndarray) -> np.ndarray:
        """Numbers of the new pieces."""
        number = np.arange(len(self), len(self) + len(h))
        for column, values in ((self.hash, h), (self.raw_end, self.raw.n + np.cumsum(raw_size)), (self.ids_end, self.ids.n + np.cumsum(ids_size)), (self.raw, raw), (self.ids, ids)):
            column.append(values)
        if 2 * len(self) > len(self.slots):
            self.slots = np.full(1 << (2 * len(self)).bit_length(), -1, np.int32)
            self._settle(self.hash.held[: len(self)], np.arange(len(self)))
        else:
            self._settle(h, number)
        return number


class PieceEncoder:
    """Ids of whole texts, by the tokenizers library on distinct pieces."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.recent, self.older = _Known(), _Known()

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of each text's)."""
        ids, size = array("i"), []
        for i in range(0, len(texts), 10_000):
            for e in self.tokenizer.encode_batch_fast(texts[i : i + 10_000], add_special_tokens=False):
                ids.extend(own := e.ids)
                size.append(len(own))
        return np.frombuffer(ids, np.int32) if ids else np.zeros(0, np.int32), np.array(size, np.int64)

    def _look_up(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of each piece's); the two generations hold about
        CACHE pieces, and what was used lately outlives the rest."""
        t = Texts(pieces)
        h, size = t.span_hashes(t.offsets[:-1], t.offsets[1:], lower=False), np.diff(t.offsets)
        number = self.recent.find(h, t.raw, t.offsets)
        new = np.flatnonzero(number < 0)
        raw = t.raw[_spans(t.offsets[new], size[new])]
        back = self.older.find(h[new], raw, np.concatenate([[0], np.cumsum(size[new])]))
        old, fresh = new[back >= 0], new[back < 0]
        begin, n = self.older.span(self.older.ids_end, back[back >= 0])
        kept = self.older.ids.held[_spans(begin, n)], n
        for own, (ids, n) in ((old, kept), (fresh, self._whole(pieces.take(pa.array(fresh)).to_pylist()))):
            number[own] = self.recent.add(h[own], t.raw[_spans(t.offsets[own], size[own])], size[own], ids, n)
        begin, n = self.recent.span(self.recent.ids_end, number)
        out = self.recent.ids.held[_spans(begin, n)], n
        if len(self.recent) > CACHE // 2:
            self.older, self.recent = self.recent, _Known()
        return out

    def encode(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, offsets of texts in them); a null text has no ids."""
        t = Texts(col)
        raw = t.raw
        nxt = np.concatenate([raw[1:], [0]]) if len(raw) else raw
        odd = (
            _ODD[raw]
            | ((raw == 0xC2) & ((nxt == 0x85) | (nxt == 0xA0)))
            | ((raw == 0xE1) & (nxt == 0x9A))
            | ((raw == 0xE2) & ((nxt == 0x80) | (nxt == 0x81)))
            | ((raw == 0xE3) & (nxt == 0x80))
        )
        whole = np.zeros(t.n, bool)
        whole[np.searchsorted(t.offsets, np.flatnonzero(odd), side="right") - 1] = True
        filled = col.fill_null("")
        for s in self.special:
            whole |= pc.match_substring(filled, s).to_numpy(zero_copy_only=False)
        # places to cut, before byte i
        prev = np.concatenate([[0], raw[:-1]]).astype(np.uint8) if len(raw) else raw
        prev2 = np.concatenate([[0, 0], raw[:-2]]).astype(np.uint8)[: len(raw)]
        space, prev_space = (raw == 32) | (raw == 10), (prev == 32) | (prev == 10)
        cut = space & ~prev_space
        cut |= ~space & (prev == 10) & ~((prev2 == 32) | (prev2 == 10))
        cut |= _PUNCT[raw] & (_LETTER[prev] | ((prev2 == 0xC3) & (prev >= 0x80) & (prev != 0x97) & (prev != 0xB7)))
        owner_whole = np.repeat(whole, np.diff(t.offsets))
        cut &= ~owner_whole
        starts = t.offsets[:-1][np.diff(t.offsets) > 0]
        cut[starts] = True
        at = np.append(np.flatnonzero(cut), len(raw))
        first = np.searchsorted(at, t.offsets)
        pieces = pa.Array.from_buffers(pa.large_string(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(raw)])
        coded = pieces.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        words = coded.dictionary
        apart = np.zeros(len(words), bool)
        apart[codes[first[:-1][whole & (np.diff(t.offsets) > 0)]]] = True
        parts, size = [], np.zeros(len(words), np.int64)
        begin = size.copy()
        for own, look in ((~apart, self._look_up), (apart, lambda x: self._whole(x.to_pylist()))):
            if own.any():
                ids, size[own] = look(words.filter(pa.array(own)) if apart.any() else words)
                begin[own] = sum(map(len, parts)) + np.cumsum(size[own]) - size[own]
                parts.append(ids)
        flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        n = size[codes]
        return flat[_spans(begin[codes], n)], np.concatenate([[0], np.cumsum(n)])[first]


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder_of(path: str) -> PieceEncoder:
    """The worker's encoder for a tokenizer file, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def encoded(docs: DataFrame, tokenizer: str, end_id: int | None = END_ID) -> DataFrame:
    """(doc_id, n_tokens, ids) in the order and partitions of ``docs``
    (doc_id, text). Null and empty texts hold the end id alone."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, offsets = encoder.encode(part.column("text"))
                if end_id is not None:
                    ids = np.insert(ids, offsets[1:], end_id)
                    offsets = offsets + np.arange(len(offsets))
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(offsets)), lists], names=["doc_id", "n_tokens", "ids"]
                )

    return docs.mapInArrow(encode, "doc_id long, n_tokens long, ids array<int>")


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, row_group_bytes: int = 8 << 20, page_bytes: int = 256 << 10, delta: bool = False) -> None:
    """Encode documents and write the token files in ascending doc_id order
    (null ids first). ``delta`` writes delta-packed instead of dictionary
    pages. Extra columns are left out."""
    ship(docs.sparkSession)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = own.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    options = {
        "compression": "zstd",
        "parquet.block.size": row_group_bytes,
        "parquet.page.size": page_bytes,
        "parquet.page.row.count.limit": 2000,
        "parquet.enable.dictionary": str(not delta).lower(),
        "parquet.writer.version": "v2" if delta else "v1",
    }
    encoded(ordered, tokenizer or default_tokenizer()).write.options(**options).parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids, part): a selection of columns or of ids reads
    only their pages. ``part`` is the number of the file in the order."""
    part = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("int")
    return spark.read.schema("doc_id long, n_tokens long, ids array<int>").parquet(path).select("*", part.alias("part"))


def token_stream(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files.

    Counts and checksums are taken from the ids read back. Starts are running
    sums within a file (its documents only) on top of the running sum of the
    files' totals (a row per file), in the order of the files' rows, so that
    starts are right for rows of equal or null doc_id, too.
    """

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            flat, offsets = ids.flatten().to_numpy().astype("<u4", copy=False), ids.offsets.to_numpy()
            offsets = offsets - offsets[0]
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("part"), batch.column("row"), batch.column("doc_id"), pa.array(np.diff(offsets).astype(np.int64)), pa.array(crc, pa.int64())],
                names=["part", "row", "doc_id", "n_tokens", "ids_crc32"],
            )

    read = read_tokens(spark, path).select("part", F.col("_metadata.row_index").alias("row"), "doc_id", "ids")
    rows = written(read.mapInArrow(check, "part int, row long, doc_id long, n_tokens long, ids_crc32 long"), "token_rows")
    before = W.rowsBetween(W.unboundedPreceding, -1)
    files = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    files = files.select("part", F.coalesce(F.sum("total").over(before.orderBy("part")), F.lit(0)).alias("base"))
    inside = before.partitionBy("part").orderBy("row")
    return (
        rows.withColumn("within", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(files, "part")
        .select("doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")
    )


def op4_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the token files of all documents and read them back."""
    path = scratch_path(spark, "llm", "tokens")
    write_tokens(documents(spark, sf_dir), path)
    return token_stream(spark, path)
