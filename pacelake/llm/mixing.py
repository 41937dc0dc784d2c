"""Mixing sources to target weights by the cube method (operator 9).

Every source's target is its weight's share of all words, but never more than
``cap`` times its own words; what a stopped source leaves goes to the others by
weight (water filling). A document then has the expected number of copies
``target / source_size``: its whole part is taken for certain, its fraction is
an inclusion probability of a balanced sample.

The cube method moves the fractions of a block of documents along vectors that
change neither the block's expected words nor its expected documents (the
null space of two constraints), until at most two documents, and a small
reserve kept for the landing, stay fractional. Those go on to wider blocks of
the same source; the handful that is left lands on the choice whose words come
nearest to the expected. Blocks are bounded, so a
source with a third of all rows is worked on by many tasks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pacelake.llm.common import WORD, documents, written

BLOCK = 2048  # documents that a flight takes at once
RESERVE = 12  # documents that a block keeps for the landing
ROUND = 1e-9


def source_targets(sizes: DataFrame, cap: float = 3.0) -> DataFrame:
    """(source, source_size, n_docs, target) of documents (source, size).

    Sources in code-point order, null last, weigh 1, 2, 3, 1, 2, ... The
    level ``t`` with sum(min(cap * size, weight * t)) = total is found from
    running sums over the sources ordered by where they stop: it is that of
    the first source that does not stop below it. The windows
    without keys see one row per source, never documents. A source without
    words has target 0.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    rank = F.row_number().over(W.orderBy(F.col("source").isNull(), F.col("source").cast("binary")))
    per = per.withColumn("weight", (rank - 1) % 3 + 1).withColumn("stop", cap * F.col("source_size"))
    at = F.col("stop") / F.col("weight")
    before = W.orderBy(at, F.col("source").isNull(), "source").rowsBetween(W.unboundedPreceding, -1)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    level = (F.col("total") - F.col("stopped")) / (F.col("weights") - F.col("passed"))
    per = (
        per.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("weights", F.sum("weight").over(everything))
        .withColumn("stopped", F.coalesce(F.sum("stop").over(before), F.lit(0.0)))
        .withColumn("passed", F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("level", F.min_by(F.when(level <= at, level), F.when(level <= at, at)).over(everything))
    )
    target = F.least(F.col("stop"), F.col("weight") * F.coalesce("level", F.lit(float("inf"))))
    return per.select("source", "source_size", "n_docs", target.cast("double").alias("target"))


def flight(prob: np.ndarray, size: np.ndarray, rng: np.random.Generator, reserve: int = 0) -> np.ndarray:
    """Move fractional probabilities to 0 or 1 three at a time, keeping the
    sums of probabilities and of probability times size, until at most two
    (and ``reserve`` others, evenly spread over the sizes and left untouched
    for the landing) stay fractional."""
    p = prob.astype(float).copy()
    x = size / max(1.0, float(size.max(initial=1)))
    queue = [int(i) for i in np.argsort(-size, kind="stable") if ROUND < p[i] < 1 - ROUND]
    if reserve:
        spared = {queue[int(k)] for k in np.linspace(0, len(queue) - 1, min(reserve, len(queue)))} if queue else set()
        queue = [i for i in queue if i not in spared]
    hand: list[int] = []
    for i, coin in zip(queue, rng.random(len(queue))):
        hand.append(i)
        if len(hand) < 3:
            continue
        a, b, c = hand
        v = (x[c] - x[b], x[a] - x[c], x[b] - x[a])  # null space of the two constraints
        if not any(v):
            v = (1.0, -1.0, 0.0)
        up = min((1 - p[j]) / d if d > 0 else -p[j] / d for j, d in zip(hand, v) if d)
        down = min(p[j] / d if d > 0 else (p[j] - 1) / d for j, d in zip(hand, v) if d)
        step = up if coin * (up + down) < down else -down
        for j, d in zip(hand, v):
            p[j] += step * d
        nearest = min((j for j, d in zip(hand, v) if d), key=lambda j: min(p[j], 1 - p[j]))
        p[nearest] = round(p[nearest])  # the one that met its bound
        for j in hand:
            if p[j] <= ROUND or p[j] >= 1 - ROUND:
                p[j] = round(p[j])
        hand = [j for j in hand if 0 < p[j] < 1]
    return p


def landing(prob: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Decide what is left: all but ``RESERVE`` documents by another flight,
    the rest by trying every choice. Of the choices whose words come nearest to
    the expected, one is drawn by its probability."""
    p = flight(prob, size, rng, RESERVE)
    left = np.flatnonzero((p > ROUND) & (p < 1 - ROUND))
    if len(left):
        want = float((p[left] * size[left]).sum())
        sums, chance = np.zeros(1), np.zeros(1)
        for z, q in zip(size[left], p[left]):
            sums = np.concatenate([sums, sums + z])
            chance = np.concatenate([chance + np.log(1 - q), chance + np.log(q)])
        away = np.abs(sums - want)
        near = np.flatnonzero(away <= away.min() + 0.02 * size[left].mean())
        weight = np.exp(chance[near] - chance[near].max())
        best = int(near[np.searchsorted(np.cumsum(weight), rng.random() * weight.sum())])
        p[left] = [best >> k & 1 for k in range(len(left))]
    return np.round(p)


def _settle(rows: DataFrame, final: bool, level: int) -> DataFrame:
    """One flight over every (sid, block), or the landing."""

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["key", "size", "p"], kind="stable").reset_index(drop=True)
        rng = np.random.default_rng([level, len(pdf), int(pdf["key"].iloc[0]) & 0x7FFFFFFF])
        p = landing(pdf["p"].to_numpy(), pdf["size"].to_numpy(), rng) if final else flight(pdf["p"].to_numpy(), pdf["size"].to_numpy(), rng, RESERVE)
        return pdf.assign(p=p)[["sid", "key", "size", "p"]]

    return rows.groupBy("sid", "block").applyInPandas(work, "sid int, key long, size long, p double")


NO_KEY = -(2**63)


def mix(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", cap: float = 3.0) -> DataFrame:
    """(key, source, size, source_size, target, copies, taken), one per row.

    Null and empty texts have size 0 and take no words. Null sources are one
    source, sorted last. Equal rows are separate documents; which of them gets
    a copy makes no difference. An empty table gives an empty result. Random
    numbers are seeded by the keys in a block, so reruns agree.
    """
    rows = written(
        docs.select(
            F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)).alias("key"),
            F.col(source).cast("string").alias("source"),
            F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        ),
        "mix_sizes",
    )
    ratio = F.when(F.col("source_size") > 0, F.round(F.col("target") / F.col("source_size"), 12)).otherwise(F.lit(0.0))
    targets = written(
        source_targets(rows, cap)
        .withColumn("ratio", ratio)
        .withColumn("whole", F.floor("ratio"))
        .withColumn("sid", F.row_number().over(W.orderBy(F.col("source").isNull(), "source")))
        .withColumn("blocks", F.ceil(F.col("n_docs") / BLOCK)),
        "mix_targets",
    )
    on = F.col("source").eqNullSafe(F.col("s"))
    open_ = rows.join(targets.withColumnRenamed("source", "s"), on).select(
        "sid", "key", "size", (F.col("ratio") - F.col("whole")).alias("p"), "blocks"
    )
    done, level = None, 0
    while True:
        most = 1 if not level else (open_.groupBy("sid").count().agg(F.max("count")).first()[0] or 0)
        final = bool(level) and most <= BLOCK
        block = F.lit(0) if final else F.pmod(F.xxhash64("key", "size", F.lit(level)), F.col("blocks") if not level else F.lit(-(-most // BLOCK)))
        got = written(_settle(open_.withColumn("block", block.cast("long")), final, level), "mix_flight")
        settled = got if final else got.where(f"p < {ROUND} or p > 1 - {ROUND}")
        done = settled if done is None else done.union(settled)
        if final:
            break
        open_, level = got.where(f"p >= {ROUND} and p <= 1 - {ROUND}"), level + 1
    out = done.join(targets, "sid").withColumn("copies", (F.col("whole") + F.round("p")).cast("int"))
    return out.select(
        F.when(F.col("key") != NO_KEY, F.col("key")).alias("key"),
        "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"),
    )


def mixed_documents(docs: DataFrame, cap: float = 3.0) -> DataFrame:
    """The documents themselves, each as often as the mix takes it (not at all
    to ``cap`` times); the columns are those of ``docs``."""
    counts = written(mix(docs, cap=cap).select(F.coalesce("key", F.lit(NO_KEY)).alias("k"), F.col("source").alias("s"), F.col("size").alias("z"), "copies"), "mix_counts")
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_KEY))
    if not counts.groupBy("k").count().where("count > 1").limit(1).count():
        taken = docs.join(counts.where("copies > 0").select("k", "copies"), key == F.col("k"))
    else:  # rows of the same id, source and size are numbered on both sides
        size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
        numbered = counts.withColumn("m", F.row_number().over(W.partitionBy("k", "s", "z").orderBy("copies")))
        here = docs.withColumns({"_key": key, "_size": size, "_source": F.col("source").cast("string")})
        here = here.withColumn("_nth", F.row_number().over(W.partitionBy("_key", "_source", "_size").orderBy("text")))
        on = [F.col("_key") == F.col("k"), F.col("_source").eqNullSafe(F.col("s")), F.col("_size") == F.col("z"), F.col("_nth") == F.col("m")]
        taken = here.join(numbered.where("copies > 0"), on)
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), "copies"))).select(*[docs[c] for c in docs.columns])


def op9_mixing(spark, sf_dir: str) -> DataFrame:
    """Every document with its source's target and the words the mix takes."""
    out = mix(documents(spark, sf_dir))
    return out.select(F.col("key").alias("doc_id"), "size", "source_size", "target", "taken", "source", "copies")
