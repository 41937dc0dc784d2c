"""Exact discrete quantiles per group, in which no task grows with its group.

1. A mergeable sketch gives, for every probability, a bracket of two values that
   hold the answer between them.
2. While some bracket may hold more than ``limit`` values, one more pass counts,
   per group and probability, the rows below, at and between the bracket's ends,
   and cuts the rows between into ``GRID`` parts of about the same size; the part
   of the rank becomes the bracket. Every pass divides a bracket by about
   ``GRID / 4``, whatever the values' distribution; many equal values end up as
   a bracket's ends and count as one.
3. The values of the brackets, one row each, and the numbers of rows outside are
   ranked by a running sum: at most ``limit`` rows a bracket.

Brackets are one row a group, written between the passes, so that Spark knows
their size and chooses the join by it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from pacelake.session import scratch_path

#: The sketch's rank error is at most 1/accuracy of the rows.
ACCURACY = 10_000
#: So many distinct values of a bracket are ranked by one task at most.
BRACKET_VALUES = 1_000_000
GRID = 1_000


def _stored(brackets: DataFrame) -> tuple[DataFrame, int]:
    """Brackets written and read again, and the most values that one may hold
    (an observation of the write, no further job)."""
    spark, seen = brackets.sparkSession, Observation()
    path = scratch_path(spark, "quantiles")
    brackets.observe(seen, F.max("_w").alias("w")).write.parquet(path)
    return spark.read.schema(brackets.schema).parquet(path), seen.get["w"] or 0


def _rows_with_brackets(src: DataFrame, brackets: DataFrame, keys: list[str]) -> DataFrame:
    state = ["_n", "_lo", "_hi"]
    if not keys:  # one group: its row is a scalar subquery, not a join
        return src.withColumns({x: brackets.select(x).scalar() for x in state})
    there = brackets.select(*[F.col(k).alias(f"{k}b") for k in keys], *state)
    return src.join(there, [F.col(k).eqNullSafe(F.col(f"{k}b")) for k in keys]).select(*keys, "_v", *state)


def _rank(p: float) -> Column:
    return F.greatest(F.ceil(F.lit(float(p)) * F.col("_n")), F.lit(1))


def first_brackets(src: DataFrame, keys: list[str], ps: list[float], accuracy: int) -> DataFrame:
    """keys, _n, _lo, _hi (an end per probability), _w."""
    ends = [min(1.0, max(0.0, p + d)) for p in ps for d in (-2.0 / accuracy, 2.0 / accuracy)]
    sketch = src.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("_v", ends, accuracy).alias("_e")).where("_n > 0")
    e = F.col("_e")
    # between the ends: 4/accuracy of the rows, and the error of both ends
    return sketch.select(
        *keys, "_n", F.array(*[e[2 * i] for i in range(len(ps))]).alias("_lo"), F.array(*[e[2 * i + 1] for i in range(len(ps))]).alias("_hi"),
        F.ceil(F.col("_n") * F.lit(6.0 / accuracy)).cast("long").alias("_w"),
    )


def narrowed(src: DataFrame, brackets: DataFrame, keys: list[str], ps: list[float], accuracy: int) -> DataFrame:
    """Brackets after one more pass over the rows."""
    rows, v = _rows_with_brackets(src, brackets, keys), F.col("_v")
    grid = [k / GRID for k in range(GRID + 1)]
    counts = [F.max("_n").alias("_n"), F.max("_lo").alias("_lo"), F.max("_hi").alias("_hi")]
    for i in range(len(ps)):
        lo, hi = F.col("_lo")[i], F.col("_hi")[i]
        between = (v > lo) & (v < hi)
        counts += [
            F.count_if(v < lo).alias(f"_b{i}"), F.count_if(v == lo).alias(f"_a{i}"), F.count_if(between).alias(f"_c{i}"),
            F.percentile_approx(F.when(between, v), grid, accuracy).alias(f"_q{i}"),
        ]
    seen = rows.groupBy(*keys).agg(*counts)
    los, his, widths = [], [], []
    for i, p in enumerate(ps):
        lo, hi, c, q = F.col("_lo")[i], F.col("_hi")[i], F.col(f"_c{i}"), F.col(f"_q{i}")
        at = _rank(p) - F.col(f"_b{i}") - F.col(f"_a{i}")  # rank among the rows between the ends
        share = at / F.nullif(c, F.lit(0))
        low = F.greatest(F.lit(0), F.floor((share - 2.0 / accuracy) * GRID)).cast("int")
        high = F.least(F.lit(GRID), F.ceil((share + 2.0 / accuracy) * GRID)).cast("int")
        at_low, at_high = at <= 0, at > c
        los.append(F.when(at_low, lo).when(at_high, hi).when(low > 0, F.get(q, low)).otherwise(lo))
        his.append(F.when(at_low, lo).when(at_high, hi).when(high < GRID, F.get(q, high)).otherwise(hi))
        part = F.ceil(c * ((high - low) / F.lit(float(GRID)) + F.lit(2.0 / accuracy)))
        widths.append(F.when(at_low | at_high, F.lit(0)).otherwise(F.least(part, c)).cast("long"))
    return seen.select(*keys, "_n", F.array(*los).alias("_lo"), F.array(*his).alias("_hi"), F.greatest(*widths, F.lit(0)).cast("long").alias("_w"))


def brackets_of(src: DataFrame, keys: list[str], ps: list[float], accuracy: int, limit: int) -> DataFrame:
    """Brackets that hold at most ``limit`` values between their ends."""
    brackets, width = _stored(first_brackets(src, keys, ps, accuracy))
    while width > limit:
        brackets, now = _stored(narrowed(src, brackets, keys, ps, accuracy))
        if now >= width:
            raise ValueError(f"brackets of {width} values do not get narrower at accuracy {accuracy}")
        width = now
    return brackets


def counted(src: DataFrame, brackets: DataFrame, keys: list[str], n: int) -> DataFrame:
    """Rows to rank: _k (a value), _in (of a bracket; else the rows above it and
    below the next bracket), _c (how many). Reduced on every mapper."""
    rows, v = _rows_with_brackets(src, brackets, keys), F.col("_v")
    inside, below = F.lit(False), F.lit(None).cast(src.schema["_v"].dataType)
    for i in range(n):
        lo, hi = F.col("_lo")[i], F.col("_hi")[i]
        inside = inside | ((v >= lo) & (v <= hi))
        below = F.when(v > hi, hi).otherwise(below)
    return rows.groupBy(*keys, "_n", inside.alias("_in"), F.when(inside, v).otherwise(below).alias("_k")).agg(F.count(F.lit(1)).alias("_c"))


def quantiles(df: DataFrame, by: Sequence[str], value: str, probs: dict[str, float], accuracy: int = ACCURACY, limit: int = BRACKET_VALUES) -> DataFrame:
    """Exact discrete quantiles of ``value`` per group, one row per group with
    a non-NULL value: ``by`` columns, ``n`` and one column per name in ``probs``
    (the smallest value with at least ``ceil(p * n)`` values up to it)."""
    ps = sorted(set(probs.values()))
    keys = [f"_g{i}" for i in range(len(by))]
    src = df.select(*[F.col(k).alias(g) for k, g in zip(by, keys)], F.col(value).alias("_v")).where("_v is not null")
    brackets = brackets_of(src, keys, ps, accuracy, limit)
    rows = counted(src, brackets, keys, len(ps)).withColumn("_one", F.lit(0))
    # a bracket's values come before the rows counted at its upper end
    order = Window.partitionBy("_one", *keys).orderBy(F.col("_k").asc_nulls_first(), F.col("_in").desc())
    ranked = rows.withColumn("_r", F.sum("_c").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    reached = lambda p: F.col("_in") & (F.col("_r") >= _rank(p))
    out = ranked.groupBy("_one", *keys).agg(F.max("_n").alias("n"), *[F.min(F.when(reached(p), F.col("_k"))).alias(name) for name, p in probs.items()])
    return out.select(*[F.col(g).alias(k) for k, g in zip(by, keys)], "n", *probs)
