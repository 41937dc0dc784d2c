"""Sampled SentencePiece encoding by forward filtering and backward sampling
(operator 3), and lossless decoding.

All pieces that match at a place of a word are edges of a lattice; an edge's
weight is the piece's probability to the power ``alpha``. Forward filtering
sums, for every place, the weight of all paths to it; backward sampling starts
at the word's end and draws the last piece in proportion to the weights of the
paths through it, and so on. That draws a segmentation from the exact posterior
over all segmentations. Random numbers depend on the row's key and the word's
number only, so reruns, other partitionings and other batches agree.

The model's words begin with the space mark, which no piece has inside, so the
lattice of a text falls apart into those of its words. The lattices of a
batch's distinct words are filtered together, place by place, and all its words
are sampled together, piece by piece, in numpy. A character that no piece
covers is written as its UTF-8 bytes, also the space mark itself, so that
decoding restores every text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacelake.llm.common import documents
from pacelake.llm.text import BASE, U64, Texts, mix, powers, slices, text_keys

MARK = "▁"
ALPHA = 0.2
TOP = U64(44)  # a hash's bits below those that the table of pieces is indexed by
LONG = 64  # characters of a lattice; a longer word is cut into lattices of this length


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PieceModel:
    """Pieces of a SentencePiece model with byte fallback. Where scores are
    ranks (merge order), a piece's log-probability is -log(rank + 10)."""

    def __init__(self, path: str, alpha: float = ALPHA):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(size)]
        self.byte_ids = np.full(256, -1, np.int64)
        normal = []
        for i, p in enumerate(self.pieces):
            if sp.is_byte(i):
                self.byte_ids[int(p[3:-1], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)) and MARK not in p[1:]:
                normal.append(i)
        if (self.byte_ids < 0).any():
            raise ValueError("the model has no byte fallback: decoding would lose characters")
        score = np.array([sp.get_score(i) for i in normal])
        ranks = len(score) and score.min() < -1000
        logp = -np.log(10.0 - score) if ranks else score
        code, length = [], []
        for i in normal:
            points = np.frombuffer(self.pieces[i].encode("utf-32-le"), "<u4")
            code.append(points)
            length.append(len(points))
        self.longest = max(length)
        length = np.array(length)
        hashes = _span_hashes(np.concatenate(code), np.cumsum(length) - length, np.cumsum(length))
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], np.array(normal)[order]
        self.weight = np.exp(alpha * logp)[order]
        # the first piece of each value of a hash's top bits, and the most that share one: most spans are no piece
        top = (self.hashes >> TOP).astype(np.int64)
        self.table = np.full(1 << (64 - int(TOP)), -1, np.int32)
        self.table[top[::-1]] = np.arange(len(top), dtype=np.int32)[::-1]
        self.shared = int(np.bincount(top).max())
        floor = (logp.min() if len(logp) else 0.0) - 2.0
        self.byte_weight = float(np.exp(alpha * floor))
        self.lengths = np.unique(length)
        raw = [p.replace(MARK, " ").encode() for p in self.pieces]
        for value, i in enumerate(self.byte_ids):
            raw[i] = bytes([value])
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_size = np.fromiter(map(len, raw), np.int32, size)
        self.raw_start = np.cumsum(self.raw_size, dtype=np.int32) - self.raw_size

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which hashes are a piece's, the pieces' places)."""
        i = self.table[h >> TOP]
        ok = np.flatnonzero(i >= 0)
        i, h = i[ok], h[ok]
        hit = self.hashes[i] == h
        for k in range(1, self.shared):
            j = np.minimum(i + k, len(self.hashes) - 1)
            more = ~hit & (self.hashes[j] == h)
            i, hit = np.where(more, j, i), hit | more
        return ok[hit], i[hit]

    def bytes_of(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all ids, with a mark in front of a text; per id where its bytes end)."""
        size = self.raw_size[ids]
        ends = np.cumsum(size)
        at = np.repeat((self.raw_start[ids] - (ends - size)).astype(np.int32), size)
        at += np.arange(len(at), dtype=np.int32)
        return self.raw[at], ends

    def decode(self, ids: np.ndarray) -> str:
        """The text that ids were encoded from."""
        if not len(ids):
            return ""
        out = self.bytes_of(np.asarray(ids))[0].tobytes().decode("utf-8", "replace")
        return out[1:]  # the mark in front


def _span_hashes(points: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of code points."""
    with np.errstate(over="ignore"):
        up, down = powers(BASE, len(points)), powers(U64(pow(int(BASE), -1, 2**64)), len(points))
        code = mix(points.astype(np.uint64) + U64(1))
        total = np.concatenate([[U64(0)], np.cumsum(code * up[:-1], dtype=np.uint64)])
        return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64) * BASE)


class Lattices:
    """Lattices of distinct words. Nodes stand place by place, the words of a
    place by falling length, so that the nodes of a place and of all later ones
    are slices. Edges are sorted by the node they end in, with the chance of
    each or an earlier edge of that node."""

    def __init__(self, model: PieceModel, points: np.ndarray, size: np.ndarray):
        words = np.argsort(-size, kind="stable")
        longest = int(size[words[0]])
        many = np.searchsorted(-size[words], -np.arange(longest + 1), side="right")  # words that have a place
        level = np.concatenate([[0], np.cumsum(many)])
        n_word, n_node = int(many[0]), int(level[-1])
        self.inner = n_word  # nodes below are words' beginnings
        column = np.empty(len(size), np.int64)
        column[words] = np.arange(len(size))
        self.end = level[size] + column  # node of each word's end
        place = np.repeat(np.arange(longest + 1, dtype=np.int32), many)
        column = (np.arange(n_node) - np.repeat(level[:-1], many)).astype(np.int32)
        begin = (np.cumsum(size) - size)[words]
        code = points[begin[column[n_word:]] + place[n_word:] - 1]  # the character before every inner node
        literal = code == ord(MARK)  # in the text itself: never a space
        marked = np.where(code == 32, np.uint32(ord(MARK)), code)
        with np.errstate(over="ignore"):
            up, down = powers(BASE, longest), powers(U64(pow(int(BASE), -1, 2**64)), longest)
            total = np.zeros(n_node, np.uint64)
            total[n_word:] = mix(marked.astype(np.uint64) + U64(1)) * up[place[n_word:] - 1]
        barred = np.zeros(n_node, np.int32)
        barred[n_word:] = literal
        for k in range(1, longest + 1):  # sums from the word's beginning to every node
            own, last = slice(level[k], level[k + 1]), slice(level[k - 1], level[k - 1] + many[k])
            total[own] += total[last]
            barred[own] += barred[last]
        any_barred = literal.any()
        frm, to, piece, weight, rank = [], [], [], [], []
        edges = np.zeros(n_node, np.int32)
        single = np.zeros(n_node, bool)

        def add(v, u, pieces, weights):
            to.append(v.astype(np.int32))
            frm.append(u.astype(np.int32))
            piece.append(pieces.astype(np.int32))
            weight.append(weights)
            rank.append(edges[v])
            edges[v] += 1

        for n in map(int, model.lengths[::-1]):  # long pieces first: they are drawn most often
            if n > longest:
                continue
            begun = place[level[n] :] - n
            u = level[begun] + column[level[n] :]
            with np.errstate(over="ignore"):
                h = mix((total[level[n] :] - total[u]) * down[begun] + U64(n) * BASE)
            ok, i = model.find(h)
            v, u = ok + level[n], u[ok]
            if any_barred:
                free = barred[v] == barred[u]
                v, u, i = v[free], u[free], i[free]
            if n == 1:
                single[v] = True
            add(v, u, model.ids[i], model.weight[i])
        # one character as bytes, where no piece covers it alone
        v = n_word + np.flatnonzero(~single[n_word:])
        add(v, level[place[v] - 1] + column[v], -1 - code[v - n_word].astype(np.int64), np.full(len(v), model.byte_weight))
        to, frm, piece, weight, rank = map(np.concatenate, (to, frm, piece, weight, rank))
        self.first = np.concatenate([[0], np.cumsum(edges)])
        put = self.first[to] + rank
        self.frm, self.piece, through = np.empty_like(frm), np.empty_like(piece), np.empty_like(weight)
        self.frm[put], self.piece[put], through[put] = frm, piece, weight
        # forward filtering, all words in step: a place of every word at once
        alpha = np.zeros(n_node)
        alpha[:n_word] = 1.0
        for k in range(1, longest + 1):
            e = slice(self.first[level[k]], self.first[level[k + 1]])
            through[e] *= alpha[self.frm[e]]
            alpha[level[k] : level[k + 1]] = np.add.reduceat(through[e], self.first[level[k] : level[k + 1]] - e.start)
        # sums within each node, so that they do not depend on the other words
        self.upto = through
        v, sums = np.arange(n_word, n_node), np.zeros(n_node - n_word)
        alpha = np.maximum(alpha[n_word:], 1e-300)
        for k in range(int(edges.max())):
            e = self.first[v] + k
            sums += self.upto[e] / alpha
            self.upto[e] = sums
            more = edges[v] > k + 1
            v, sums, alpha = v[more], sums[more], alpha[more]
        self.upto[self.first[n_word + 1 :] - 1] = 2.0


def _words(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the words of texts (each with a space in front) begin: at every
    space, and in a longer word after every ``LONG`` characters."""
    start = np.flatnonzero(raw == 32)
    lead = (raw & 0xC0) != 0x80
    chars = np.add.reduceat(lead, start, dtype=np.int64)
    parts = -(-chars // LONG)
    if parts.max() == 1:
        return start
    points = np.flatnonzero(lead)
    nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    return points[np.repeat(np.cumsum(chars) - chars, parts) + nth * LONG]


def encode_batch(model: PieceModel, texts: pa.Array | list[str | None], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, offsets); null and empty texts have no ids."""
    ids, offsets, _ = _encoded(model, texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string()), keys)
    return ids, offsets


def _encoded(model: PieceModel, texts: pa.Array, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids of all texts, offsets, whether decoding gives each text again)."""
    own = Texts(texts)
    if not len(own.raw):
        return np.zeros(0, np.int64), np.zeros(own.n + 1, np.int64), np.ones(own.n, bool)
    filled = np.diff(own.offsets) > 0
    offsets = own.offsets + np.concatenate([[0], np.cumsum(filled)])
    raw, text = np.full(offsets[-1], 32, np.uint8), np.ones(offsets[-1], bool)
    text[offsets[:-1][filled]] = False  # a space in front of every text
    raw[text] = own.raw
    start = _words(raw, offsets)
    first = np.searchsorted(start, offsets)
    number = np.arange(len(start)) - np.repeat(first[:-1], np.diff(first))
    with np.errstate(over="ignore"):
        seed = mix(np.repeat(keys, np.diff(first)) + number.astype(np.uint64) * BASE)
    words = pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(np.append(start, len(raw))), pa.py_buffer(raw)]).dictionary_encode()
    distinct, word = Texts(words.dictionary), words.indices.to_numpy(zero_copy_only=False)
    points = np.frombuffer(distinct.raw.tobytes().decode().encode("utf-32-le"), "<u4")
    lattice = Lattices(model, points, distinct.n_chars())
    # backward sampling, all words in step
    node, active = lattice.end[word], np.arange(len(start))
    many = np.zeros(len(start), np.int32)
    who, edge = [], []
    step = 0
    while len(active):
        with np.errstate(over="ignore"):
            u = (mix(seed[active] + U64(step)) >> U64(11)).astype(float) / 2.0**53
        e = lattice.first[node]
        more = np.flatnonzero(lattice.upto[e] <= u)
        while len(more):
            e[more] += 1
            more = more[lattice.upto[e[more]] <= u[more]]
        who.append(active.astype(np.int32))
        edge.append(e.astype(np.int32))
        node = lattice.frm[e]
        inner = node >= lattice.inner
        many[active] = step + 1
        active, node = active[inner], node[inner]
        step += 1
    ends = np.cumsum(many, dtype=np.int64)  # the last drawn stands first in its word
    ids = np.empty(ends[-1], np.int32)
    for k, (w, e) in enumerate(zip(who, edge)):
        ids[ends[w] - 1 - k] = lattice.piece[e]
    ends = np.concatenate([[0], ends])[first]
    bare = np.flatnonzero(ids < 0)
    if len(bare):
        ids, longer = _as_bytes(model, ids, bare)
        ends = longer[ends]
    back, at = model.bytes_of(ids)
    at = np.concatenate([[0], at])[ends]
    same = np.diff(at) == np.diff(offsets)
    if same.all():
        same[np.searchsorted(offsets, np.flatnonzero(back != raw), side="right") - 1] = False
    else:
        for k in np.flatnonzero(same):
            same[k] = np.array_equal(back[at[k] : at[k + 1]], raw[offsets[k] : offsets[k + 1]])
    return ids, ends, same


def _as_bytes(model: PieceModel, ids: np.ndarray, bare: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids with the byte pieces of bare code points c, noted as -1 - c; the
    new place of every old one)."""
    point = -1 - ids[bare]
    size = 1 + (point >= 0x80) + (point >= 0x800) + (point >= 0x10000)
    many = np.ones(len(ids), np.int32)
    many[bare] = size
    put = np.concatenate([[0], np.cumsum(many, dtype=np.int64)])
    out = np.repeat(ids, many)
    for n, head in ((1, 0), (2, 0xC0), (3, 0xE0), (4, 0xF0)):
        own, c = put[bare[size == n]], point[size == n]
        for k in range(n):
            bits = c >> 6 * (n - 1 - k)
            out[own + k] = model.byte_ids[head | bits if k == 0 else 0x80 | bits & 0x3F]
    return out, put


_MODELS: dict[tuple[str, float], PieceModel] = {}


def model_of(path: str, alpha: float) -> PieceModel:
    if (path, alpha) not in _MODELS:
        _MODELS[path, alpha] = PieceModel(path, alpha)
    return _MODELS[path, alpha]


def sampled(docs: DataFrame, model: str | None = None, alpha: float = ALPHA) -> DataFrame:
    """(doc_id, n_tokens, ids, lossless) of every row: a segmentation sampled
    with the row's key, and whether decoding the ids gives the text again.
    Null and empty texts have no ids; rows with the same id and text get the
    same segmentation; an empty table gives an empty result."""
    path = model or default_model()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model_of(path, alpha)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, offsets, same = _encoded(m, part.column("text"), text_keys(part.column("doc_id").to_pylist()))
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(offsets)), lists, pa.array(same)], names=["doc_id", "n_tokens", "ids", "lossless"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(work, "doc_id long, n_tokens long, ids array<int>, lossless boolean")


def decoded(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids); null ids give a null text."""
    path = model or default_model()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model_of(path, ALPHA)
        for batch in batches:
            texts = [None if x is None else m.decode(np.array(x, np.int64)) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(work, "doc_id long, text string")


def op3_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """A sampled segmentation of every document."""
    return sampled(documents(spark, sf_dir))
