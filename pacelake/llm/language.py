"""Language identification by a bidirectional gated recurrent network over
bytes (operator 1).

The network reads windows of bytes from both ends. In each direction a gate
decides per unit how much of the state is kept, the rest is replaced by a
candidate:

    z = s(Z[byte] + U h),  n = a(N[byte] + V h),  h' = n + z (h - n)

with a(u) = u / (1 + |u|) and s = (1 + a) / 2. Both states together give a
distribution over the languages at every position; a document's probabilities
are the mean over its letters' positions, over all windows of the whole text.
Weights are trained in numpy by backpropagation through time on a bounded
sample of labelled rows (``PER_LANGUAGE`` documents of each of at most
``MAX_LANGUAGES`` languages); prediction covers every byte of every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacelake.llm.common import crc_bucket, documents
from pacelake.llm.text import Texts, slices

HIDDEN = 8
WINDOW = 64
BATCH = 1024
PER_LANGUAGE = 400
SAMPLE = 64 * PER_LANGUAGE  # documents of a fit about, shared by all languages
EXCERPT = 2000  # code points of a training document that are used
UNKNOWN = "und"
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


@dataclass
class Network:
    """table[d]: (256, 4H) inputs of direction d in the columns of both
    directions' gates and candidates; recur: (2H, 4H); out: (2H, L), bias."""

    languages: list[str]
    table: np.ndarray
    recur: np.ndarray
    out: np.ndarray
    bias: np.ndarray


def _masks(hidden: int) -> tuple[np.ndarray, np.ndarray]:
    """Which entries exist: columns [z fwd, z bwd, n fwd, n bwd]."""
    side = np.tile(np.repeat([0, 1], hidden), 2)
    table = np.stack([side == 0, side == 1])
    recur = np.repeat([0, 1], hidden)[:, None] == side[None, :]
    return table.astype(np.float32), recur.astype(np.float32)


def _steps(net: Network, window: np.ndarray, keep: bool):
    """Run over (T, B) bytes. Returns the states at every position of both
    directions, (T, B, 2H) with the backward half aligned to its position, and
    with ``keep`` what backpropagation needs."""
    t_max, b = window.shape
    h2 = net.recur.shape[0]
    hidden = h2 // 2
    states = np.empty((t_max, b, h2), np.float32)
    h = np.zeros((b, h2), np.float32)
    x, y, g = (np.empty((b, 2 * h2), np.float32) for _ in range(3))
    tape = []
    for t in range(t_max):
        np.take(net.table[0], window[t], axis=0, out=x, mode="clip")
        np.take(net.table[1], window[t_max - 1 - t], axis=0, out=y, mode="clip")
        np.matmul(h, net.recur, out=g)
        g += x
        g += y
        np.abs(g, out=x)
        x += 1
        g /= x
        z = g[:, :h2] * np.float32(0.5)
        z += np.float32(0.5)
        n = g[:, h2:]
        if keep:
            tape.append((h.copy(), x.copy(), z, n.copy()))
        h -= n
        h *= z
        h += n
        states[t, :, :hidden] = h[:, :hidden]
        states[t_max - 1 - t, :, hidden:] = h[:, hidden:]
    return states, tape


def _softmax(logits: np.ndarray) -> np.ndarray:
    logits -= logits.max(-1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(-1, keepdims=True)
    return logits


def _gradients(net: Network, window: np.ndarray, label: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    """Backpropagation through time of the weighted mean cross-entropy over
    positions. window, weight: (T, B); label: (B,)."""
    t_max, b = window.shape
    h2 = net.recur.shape[0]
    hidden = h2 // 2
    states, tape = _steps(net, window, True)
    p = _softmax(states @ net.out + net.bias)
    p[:, np.arange(b), label] -= 1
    p *= (weight / max(1.0, float(weight.sum())))[..., None]
    d_out = states.reshape(-1, h2).T @ p.reshape(-1, p.shape[-1])
    d_bias = p.sum((0, 1))
    d_states = p @ net.out.T
    d_table, d_recur = np.zeros_like(net.table), np.zeros_like(net.recur)
    d_h = np.zeros((b, h2), np.float32)
    for t in range(t_max - 1, -1, -1):
        d_h[:, :hidden] += d_states[t, :, :hidden]
        d_h[:, hidden:] += d_states[t_max - 1 - t, :, hidden:]
        h, slope, z, n = tape[t]
        d_u = np.concatenate([d_h * (h - n) * np.float32(0.5), d_h * (1 - z)], axis=1) / (slope * slope)
        d_recur += h.T @ d_u
        np.add.at(d_table[0], window[t], d_u)
        np.add.at(d_table[1], window[t_max - 1 - t], d_u)
        d_h = d_h * z + d_u @ net.recur.T
    return [d_table, d_recur, d_out, d_bias]


def train(texts: list[str], labels: list[str], steps: int = 300, batch: int = 96, rate: float = 0.02, hidden: int = HIDDEN, seed: int = 7) -> Network:
    """Fit on texts with labels, every language drawn as often. With a single
    language the network always answers it; without any it has none."""
    languages = sorted(set(labels))
    rng = np.random.default_rng(seed)
    table_mask, recur_mask = _masks(hidden)
    net = Network(
        languages,
        (rng.normal(0, 0.5, (2, 256, 4 * hidden)) * table_mask[:, None]).astype(np.float32),
        (rng.normal(0, 0.6, (2 * hidden, 4 * hidden)) * recur_mask).astype(np.float32),
        rng.normal(0, 0.3, (2 * hidden, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    coded = [np.frombuffer(x.encode(), dtype=np.uint8) for x in texts]
    by = [[i for i, y in enumerate(labels) if y == lang and len(coded[i])] for lang in languages]
    usable = [k for k, x in enumerate(by) if x]
    if len(usable) < 2:
        return net
    moments = [(np.zeros_like(x), np.zeros_like(x)) for x in (net.table, net.recur, net.out, net.bias)]
    for step in range(1, steps + 1):
        label = rng.choice(usable, batch)
        window = np.full((WINDOW, batch), 32, np.intp)
        for j, y in enumerate(label):
            raw = coded[by[y][rng.integers(len(by[y]))]]
            at = rng.integers(max(1, len(raw) - WINDOW + 1))
            cut = raw[at : at + WINDOW]
            window[: len(cut), j] = cut
        grads = _gradients(net, window, label, _LETTER[window].astype(np.float32))
        grads[0] *= table_mask[:, None]
        grads[1] *= recur_mask
        speed = rate * min(1.0, 2.0 * (1 - step / (steps + 1)))
        for x, g, (m, v) in zip((net.table, net.recur, net.out, net.bias), grads, moments):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x -= (speed * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def predict(net: Network, col: pa.Array) -> tuple[list[str], np.ndarray]:
    """(language, score) of every text of a batch; ``und`` and 0.0 for texts
    that are null or have no letter, or if no language was learned."""
    t = Texts(col)
    n_lang = len(net.languages)
    counted = _LETTER[t.raw]
    ascii_letter = t.count(counted & (t.raw < 128)) > 0
    known = np.array([bool(a) or (x is not None and any(c.isalpha() for c in x)) for a, x in _plain(ascii_letter, col)], dtype=bool)
    total = np.zeros((t.n, max(1, n_lang)))
    length = np.diff(t.offsets)
    pieces = np.where(known & (n_lang > 1), -(-length // WINDOW), 0)
    owner = np.repeat(np.arange(t.n), pieces)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = t.offsets[:-1][owner] + nth * WINDOW
    stop = t.offsets[1:][owner]
    for a in range(0, len(owner), BATCH):
        at = begin[None, a : a + BATCH] + np.arange(WINDOW)[:, None]
        real = at < stop[None, a : a + BATCH]
        window = np.where(real, t.raw[np.minimum(at, len(t.raw) - 1)], 32).astype(np.intp)
        states, _ = _steps(net, window, False)
        p = net.out.T @ states.reshape(-1, states.shape[-1]).T  # a row per language: reductions run along positions
        p += net.bias[:, None]
        p -= p.max(0)
        np.exp(p, out=p)
        p *= _LETTER[window].reshape(-1) / p.sum(0)
        np.add.at(total, owner[a : a + BATCH], p.reshape(n_lang, *window.shape).sum(1).T)
    if n_lang == 1:
        total[known] = 1.0
    weight = total.sum(1)
    best = total.argmax(1)
    ok = known & (weight > 0)
    score = np.where(ok, total[np.arange(t.n), best] / np.maximum(weight, 1e-30), 0.0)
    return [net.languages[b] if k else UNKNOWN for b, k in zip(best, ok)], np.clip(score, 0, 1)


def _plain(flags: np.ndarray, col: pa.Array):
    """Pairs (flag, text), the text only where the flag doesn't decide."""
    for i, f in enumerate(flags):
        yield f, None if f else col[i].as_py()


def training_sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> tuple[list[str], list[str]]:
    """Excerpts and labels of a bounded, repeatable sample: of every label the
    rows with the smallest hashes of their ids, cut at a random place. Bounded
    by 1.5 * per_language expected rows of EXCERPT code points a label, and less
    where labels are many: by 1.5 * SAMPLE rows, or one or two a label. Repeated
    rows count once; null and empty texts and null labels are left out."""
    rows = docs.where("lang is not null and text is not null and text <> ''")
    counts = rows.groupBy("lang").count().orderBy("lang").collect()  # a row per language
    if not counts:
        return [], []
    whole, each = 1 << 30, max(1, min(per_language, SAMPLE // len(counts)))
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(whole, int(1.5 * each / r["count"] * whole) + 1))])
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.xxhash64("text")), F.lit(whole))
    picked = rows.where(draw < share[F.col("lang")])
    at = F.pmod(F.hash("doc_id"), F.greatest(F.length("text") - EXCERPT, F.lit(1))) + 1
    got = picked.select("lang", draw.alias("draw"), F.substr("text", at, F.lit(EXCERPT)).alias("part")).distinct().orderBy("lang", "draw", "part").collect()
    return [r["part"] for r in got], [r["lang"] for r in got]


def predictions(docs: DataFrame, net: Network) -> DataFrame:
    """(doc_id, lang_pred, score) of every row, from its text alone."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                lang, score = predict(net, part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(lang, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(work, "doc_id long, lang_pred string, score double")


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows not held out. Rows
    without doc_id are not held out, nor learned from."""
    docs = documents(spark, sf_dir)
    texts, labels = training_sample(docs.where(crc_bucket("doc_id", 4) != 2))
    out = predictions(docs, train(texts, labels))
    return out.withColumn("held_out", F.coalesce(crc_bucket("doc_id", 4) == 2, F.lit(False))).select("doc_id", "held_out", "lang_pred", "score")
