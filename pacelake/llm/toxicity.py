"""Toxicity by a subsequence-string-kernel support vector machine with Nyström
landmarks (operator 6).

A text is cut into units: its words, lower-cased, folded to 31 symbols and
without punctuation (runs of single characters joined, long words in
overlapping windows of eight symbols). Two units are compared by the
gap-weighted subsequence kernel: every common subsequence of three symbols
counts with ``DECAY`` to the power of its spans, so letters put into an insult
only weaken the match. The kernel is normalised and raised to ``POWER``.

Landmarks are units of the training texts that tell toxic from other texts,
and their nearest harmless neighbours. A text's similarity to a landmark is
that of its most similar unit; the Nyström map (inverse square root of the
landmarks' own kernel matrix) turns the similarities into features of a linear
support vector machine, whose margin a logistic curve turns into a score.

Fitted on a bounded sample (``MAX_TRAIN`` texts of each label); scoring covers
every unit of every text. Similarities under ``FLOOR`` count as none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacelake.llm.common import crc_bucket, documents
from pacelake.llm.text import IS_SPACE, Texts, slices
from pacelake.sources.tables import read_table

UNIT, STRIDE, ORDER_SPAN = 8, 4, 5
DECAY, POWER, FLOOR = 0.7, 3, 0.45
LANDMARKS, NEIGHBOURS = 48, 24
MAX_TRAIN = 2500
PART_TEXTS = 250  # texts that the fit looks at together
SIMILAR_UNITS = 500  # units compared with all landmarks together: 4 MB
NOISE = 0.34  # share of toxic training texts repeated with characters put into their telling units

_FOLD = np.zeros(256, dtype=np.uint8)
_FOLD[97:123] = np.arange(1, 27)
_FOLD[65:91] = np.arange(1, 27)
_FOLD[48:58] = 27
_FOLD[0x80:0xC0] = 28 + np.arange(64) % 4
_AT = [(i, j, k) for i in range(UNIT) for j in range(i + 1, UNIT) for k in range(j + 1, UNIT) if k - i < ORDER_SPAN]
_WEIGHT = np.array([DECAY ** (k - i + 1) for i, _, k in _AT], dtype=np.float32)


def units(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(unit key, text index) of all units: five bits a symbol, first lowest."""
    t = Texts(col)
    raw = t.raw
    prev = np.concatenate([[0], raw[:-1]]).astype(np.uint8) if len(raw) else raw
    code = _FOLD[np.where((prev == 0xC3) & (raw >= 0x80) & (raw < 0x9F), raw + 0x20, raw).astype(np.uint8)]
    word = np.cumsum(IS_SPACE[raw]) + np.repeat(np.arange(t.n), np.diff(t.offsets))  # grows at spaces and at texts
    owner = np.repeat(np.arange(t.n), np.diff(t.offsets))
    solid = code > 0
    code, word, owner = code[solid], word[solid], owner[solid]
    if not len(code):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    length = np.diff(np.append(first, len(code)))
    # join neighbouring words of one symbol
    single = length == 1
    joined = np.concatenate([[False], single[1:] & single[:-1] & (owner[first][1:] == owner[first][:-1])])
    first = first[~joined]
    length = np.diff(np.append(first, len(code)))
    windows = np.maximum(1, -(-(length - UNIT) // STRIDE) + 1)
    nth = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    start = np.repeat(first, windows) + nth * STRIDE
    stop = np.minimum(start + UNIT, np.repeat(first + length, windows))
    keys = np.zeros(len(start), np.uint64)
    for i in range(UNIT):
        at = np.minimum(start + i, len(code) - 1)
        keys |= np.where(start + i < stop, code[at], 0).astype(np.uint64) << np.uint64(5 * i)
    return keys, owner[start]


def spell(key: int) -> str:
    """A unit's symbols as letters, for reading."""
    return "".join(" abcdefghijklmnopqrstuvwxyz0äéñü"[key >> 5 * i & 31] for i in range(UNIT)).strip()


def triples(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (n, triples; 0 for none) of the subsequences of three symbols of
    every unit, and the kernel of each unit with itself."""
    c = np.stack([(keys >> np.uint64(5 * i) & np.uint64(31)).astype(np.int32) for i in range(UNIT)])
    out = np.stack([np.where(c[k] > 0, c[i] << 10 | c[j] << 5 | c[k], 0) for i, j, k in _AT])
    own = ((out > 0) * (_WEIGHT**2)[:, None]).sum(0)
    for a in range(len(_AT)):
        for b in range(a + 1, len(_AT)):
            own += 2 * _WEIGHT[a] * _WEIGHT[b] * ((out[a] == out[b]) & (out[a] > 0))
    return out.T, own


@dataclass
class Machine:
    landmarks: np.ndarray  # unit keys
    table: np.ndarray  # (32768, landmarks) kernel weight of each triple, normalised by the landmark
    weights: np.ndarray  # of the Nyström features, already times the whitening
    bias: float
    slope: float
    shift: float

    def __getstate__(self) -> dict:
        """Without the table (9 MB), which its reader makes again."""
        return {**self.__dict__, "table": None}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state, table=landmark_table(state["landmarks"]))


def landmark_table(keys: np.ndarray) -> np.ndarray:
    code, own = triples(keys)
    table = np.zeros((1 << 15, len(keys)), np.float32)
    for j in range(len(keys)):
        np.add.at(table[:, j], code[j], _WEIGHT)
        table[:, j] /= np.sqrt(max(own[j], 1e-9))
    table[0] = 0
    return table


def similarities(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    """(n, landmarks) powered normalised kernel, 0 under the floor. Units whose
    bound stays under the floor for all landmarks are not worked out."""
    out = np.zeros((len(keys), table.shape[1]), np.float32)
    highest = table.max(1)
    for a in range(0, len(keys), 50_000):
        part = keys[a : a + 50_000]
        code, own = triples(part)
        norm = np.sqrt(np.maximum(own, 1e-9))
        near = np.flatnonzero((highest[code] * _WEIGHT).sum(1) >= FLOOR * norm)
        for b in range(0, len(near), SIMILAR_UNITS):
            rows = near[b : b + SIMILAR_UNITS]
            k = np.einsum("ntl,t->nl", table[code[rows]], _WEIGHT) / norm[rows, None]
            out[a + rows] = np.where(k >= FLOOR, k, 0) ** POWER
    return out


def pooled(keys: np.ndarray, owner: np.ndarray, n: int, table: np.ndarray) -> np.ndarray:
    """(n texts, landmarks): similarity of each text's most similar unit."""
    out = np.zeros((n, table.shape[1]), np.float32)
    if not len(keys) or not table.shape[1]:
        return out
    distinct, code = np.unique(keys, return_inverse=True)
    sim = similarities(distinct, table)
    used = np.flatnonzero(sim.any(1)[code])
    if len(used):
        who = owner[used]
        first = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]]))
        for a in range(0, len(first), 2000):
            lo, hi = first[a], first[a + 2000] if a + 2000 < len(first) else len(used)
            out[who[first[a : a + 2000]]] = np.maximum.reduceat(sim[code[used[lo:hi]]], first[a : a + 2000] - lo, axis=0)
    return out


def _stems(keys: np.ndarray) -> np.ndarray:
    return keys & np.uint64((1 << 25) - 1)


def _counts(keys: np.ndarray, owner: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit, toxic texts with it, texts with it) of every unit and stem."""
    # a unit has 40 bits, the number of a text of a part at most 24
    pairs = np.unique(np.concatenate([keys, _stems(keys)]) << np.uint64(24) | np.tile(owner, 2).astype(np.uint64))
    unit, first = np.unique(pairs >> np.uint64(24), return_index=True)
    hits = np.add.reduceat(toxic[(pairs & np.uint64((1 << 24) - 1)).astype(int)].astype(float), first) if len(first) else np.zeros(0)
    return unit, hits, np.diff(np.append(first, len(pairs))).astype(float)


def telling_units(parts: Iterator[tuple[int, np.ndarray, np.ndarray]], toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(candidates by falling evidence for label 1, frequent harmless units)
    of the parts of a sample (see ``_in_parts``), counted part by part.
    Evidence is the log-likelihood ratio of a unit's (or its first five
    symbols') share of toxic texts against other texts."""
    unit, hits, seen = np.zeros(0, np.uint64), np.zeros(0), np.zeros(0)
    for at, keys, owner in parts:
        more = _counts(keys, owner, toxic[at : at + PART_TEXTS])
        unit, where = np.unique(np.concatenate([unit, more[0]]), return_inverse=True)
        hits, seen = (np.bincount(where, np.concatenate(x), len(unit)) for x in ((hits, more[1]), (seen, more[2])))
    if not len(unit):
        return unit, unit
    n1, n = float(toxic.sum()), float(len(toxic))
    p, q, r = hits / n1, (seen - hits) / (n - n1), seen / n
    with np.errstate(divide="ignore", invalid="ignore"):
        g = np.nan_to_num(hits * np.log(p / r)) + np.nan_to_num((seen - hits) * np.log(q / r))
        g += np.nan_to_num((n1 - hits) * np.log((1 - p) / (1 - r))) + np.nan_to_num((n - n1 - seen + hits) * np.log((1 - q) / (1 - r)))
    longer = unit >= np.uint64(1 << 15)  # four symbols at least
    good = np.flatnonzero((p > 4 * q) & (hits >= 2) & (g > 10) & longer)
    order = good[np.lexsort((unit[good], -np.round(g[good], 6)))]
    harmless = np.flatnonzero((q >= p) & longer)
    harmless = harmless[np.lexsort((unit[harmless], -(seen - hits)[harmless]))][:20_000]
    return unit[order], unit[harmless]


def choose_landmarks(candidates: np.ndarray, count: int = LANDMARKS) -> np.ndarray:
    """Candidates in order, leaving out near copies of a chosen one."""
    chosen: list[int] = []
    for key in candidates[: 40 * count]:
        if len(chosen) == count:
            break
        if not chosen or similarities(np.array([key]), landmark_table(np.array(chosen, np.uint64))).max() < 0.8**POWER:
            chosen.append(key)
    return np.array(chosen, np.uint64)


def with_neighbours(keys: np.ndarray, harmless: np.ndarray, count: int = NEIGHBOURS) -> np.ndarray:
    """Landmarks and the harmless units most similar to them."""
    near = similarities(harmless, landmark_table(keys)).max(1) if len(harmless) else np.zeros(0)
    return np.concatenate([keys, harmless[np.argsort(-near, kind="stable")[:count]]])


def _noisy(keys: np.ndarray, telling: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Copies of units; the telling ones (of at most seven symbols) get one
    random symbol put in."""
    out = keys.copy()
    hit = np.flatnonzero(np.isin(keys, telling) & (keys < np.uint64(1 << 35)))
    size = np.ceil(np.log2(keys[hit].astype(float) + 1) / 5).astype(int)
    at = (rng.integers(1, np.maximum(size, 2)) * 5).astype(np.uint64) if len(hit) else np.zeros(0, np.uint64)
    low = keys[hit] & ((np.uint64(1) << at) - np.uint64(1))
    new = rng.integers(1, 27, len(hit)).astype(np.uint64)
    out[hit] = low | new << at | (keys[hit] >> at) << (at + np.uint64(5))
    return out


def _in_parts(texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, unit keys, text index from there) of parts of the sample,
    made when asked for: all units take several times the texts' memory."""
    for at in range(0, len(texts), PART_TEXTS):
        yield at, *units(pa.array(texts[at : at + PART_TEXTS], pa.large_string()))


def fit(texts: list[str], labels: list[int], seed: int = 11, rounds: int = 4000) -> Machine | None:
    """Landmarks, Nyström map, support vector machine (class-balanced hinge
    loss by averaged subgradient descent) and the score's logistic curve.
    None if a label is missing or no unit tells the labels apart."""
    y = np.array([1 if x else 0 for x in labels])
    if not len(y) or y.min() == y.max():
        return None
    rng = np.random.default_rng(seed)
    candidates, harmless = telling_units(_in_parts(texts), y)
    chosen = choose_landmarks(candidates)
    if not len(chosen):
        return None
    landmarks = with_neighbours(chosen, harmless)
    table = landmark_table(landmarks)
    again = (y == 1) & (rng.random(len(y)) < NOISE)
    x, noisy = [], []
    for at, k, o in _in_parts(texts):
        n = min(PART_TEXTS, len(texts) - at)
        mine = again[at : at + n]
        x.append(pooled(k, o, n, table))
        noisy.append(pooled(_noisy(k[mine[o]], chosen, rng), o[mine[o]], n, table)[mine])
    x, noisy, again = np.concatenate(x), np.concatenate(noisy), np.flatnonzero(again)
    gram = similarities(landmarks, table).astype(float)
    value, vector = np.linalg.eigh((gram + gram.T) / 2)
    white = vector @ np.diag(1 / np.sqrt(np.maximum(value, 0.05))) @ vector.T
    # a telling unit is a toxic sentence of its own, also with a symbol put in
    alone = similarities(np.concatenate([chosen, *(_noisy(chosen, chosen, rng) for _ in range(3))]), table)
    z = np.concatenate([x, noisy, alone]) @ white
    sign = np.concatenate([2.0 * y - 1, np.ones(len(again) + len(alone))])
    cost = np.concatenate([np.where(y > 0, 0.3 / (y > 0).sum(), 0.5 / (y == 0).sum()), np.full(len(again), 0.1 / max(1, len(again))), np.full(len(alone), 0.1 / len(alone))])
    w, b, w_sum, b_sum, decay = np.zeros(z.shape[1]), 0.0, np.zeros(z.shape[1]), 0.0, 1e-3
    for step in range(1, rounds + 1):
        inside = sign * (z @ w + b) < 1
        rate = 2.0 / np.sqrt(step)
        w -= rate * (decay * w - (cost * sign * inside) @ z)
        b += rate * float((cost * sign * inside).sum())
        if step > rounds // 2:
            w_sum, b_sum = w_sum + w, b_sum + b
    w, b = w_sum / (rounds - rounds // 2), b_sum / (rounds - rounds // 2)
    margin = z @ w + b
    slope, shift = 1.0, 0.0
    for _ in range(500):  # logistic curve over margins, both labels weighing the same
        error = cost * (1 / (1 + np.exp(-(slope * margin + shift))) - np.where(sign > 0, 0.98, 0.02))
        slope, shift = slope - 4.0 * float(error @ margin), shift - 4.0 * float(error.sum())
    return Machine(landmarks, table, white @ w, b, max(slope, 0.1), shift)


def scores(machine: Machine | None, col: pa.Array) -> np.ndarray:
    """Score of every text of a batch; a null or empty text has no unit and
    gets the score of a text like no landmark."""
    if machine is None:
        return np.zeros(len(col))
    keys, owner = units(col)
    margin = pooled(keys, owner, len(col), machine.table) @ machine.weights + machine.bias
    return 1 / (1 + np.exp(-np.clip(machine.slope * margin + machine.shift, -60, 60)))


def training_sample(docs: DataFrame, labels: DataFrame, each: int = MAX_TRAIN) -> tuple[list[str], list[int]]:
    """Texts and labels of a bounded, repeatable sample: of each label about
    ``each`` rows, by the smallest hashes of their ids. Rows labelled more than
    once count as toxic if any label says so; null labels are left out."""
    marks = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("y"))
    counts = {r["y"]: r["count"] for r in marks.groupBy("y").count().collect() if r["y"] in (0, 1)}
    if len(counts) < 2:
        return [], []
    whole = 1 << 30
    bound = F.when(F.col("y") == 1, int(each / counts[1] * whole)).otherwise(int(each / counts[0] * whole))
    picked = marks.where("y in (0, 1)").where(F.pmod(F.xxhash64("doc_id"), F.lit(whole)) <= bound)
    ids = {r["doc_id"]: r["y"] for r in picked.collect()}  # about 2 * each rows
    rows = docs.where("text is not null").where(F.col("doc_id").isin(sorted(ids))).select("doc_id", "text").orderBy("doc_id", "text").collect()
    return [r["text"] for r in rows], [ids[r["doc_id"]] for r in rows]


def scored(docs: DataFrame, machine: Machine | None, keep: list[str]) -> DataFrame:
    """``keep`` columns and the score of every row, from its text alone."""
    from pyspark.sql import types as T

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_t"):
                s = scores(machine, part.column("_t"))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(s.astype(float))], names=[*part.schema.names[:-1], "_score"])

    own = docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], F.col("text").cast("string").alias("_t"))
    schema = T.StructType([*own.drop("_t").schema.fields, T.StructField("_score", T.DoubleType())])
    return own.mapInArrow(work, schema).select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], F.col("_score").alias("score"))


def without_toxic(docs: DataFrame, machine: Machine | None, threshold: float = 0.5) -> DataFrame:
    """Rows (all columns) whose text scores under the threshold."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield part.filter(pa.array(scores(machine, part.column("text")) < threshold))

    return docs.mapInArrow(work, docs.schema)


def trained(spark, docs: DataFrame, sf_dir: str) -> Machine | None:
    """The machine learned from the labelled rows that are not held out."""
    labels = read_table(spark, sf_dir, "labels").where(crc_bucket("doc_id", 5) != 0)
    return fit(*training_sample(docs, labels))


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    docs = documents(spark, sf_dir)
    out = scored(docs, trained(spark, docs, sf_dir), ["doc_id"])
    held = F.coalesce(crc_bucket("doc_id", 5) == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
