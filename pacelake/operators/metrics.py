"""Column-parameterised analytics operators.

Each operator is a DataFrame -> DataFrame composition of built-in Spark
operators. The shapes they are built for, and how they behave at scale:

* aggregations use partial (map-side) aggregation, so a hot key – one group
  holding a third of all rows – is pre-reduced on every mapper before the
  shuffle and never lands whole in one task;
* windows without partition keys (year-over-year, running totals) are only
  ever applied *after* an aggregation to one row per ordering value, so the
  single window partition holds one row per year/bucket, not the raw rows; for
  many periods they run as scans over ranges (``operators.scans``);
* top-k is ``orderBy + limit``, planned as TakeOrderedAndProject (per-task
  top-k then a k-row merge), with a deterministic tie-break;
* quantiles are exact (``operators.exact_quantiles``): brackets are narrowed until
  few values are left to rank; the column itself never meets in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pacelake.operators.exact_quantiles import quantiles
from pacelake.operators.scans import scan

ColumnLike = Column | str


def _c(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: ColumnLike, digits: int) -> Column:
    """Spark's round (HALF_UP on the decimal text of the double)."""
    return F.round(_c(c), digits)


def stable_round(c: ColumnLike, digits: int) -> Column:
    """A mean of doubles rounded so that the order of its summands, which shows
    in the last digits, does not: to ten decimals first."""
    return F.round(F.round(_c(c), 10), digits)


def count_where(cond: Column) -> Column:
    """SUM(CASE WHEN cond THEN 1 ELSE 0 END) as a bigint."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("long")


def pct_where(cond: Column, digits: int = 1) -> Column:
    """100 * share of rows where cond holds (NULL for an empty group)."""
    return F.round(
        F.lit(100.0) * count_where(cond) / F.nullif(F.count(F.lit(1)), F.lit(0)), digits
    )


def bucket(c: ColumnLike, width: int) -> Column:
    """floor(c / width) * width as bigint (e.g. 5-year age buckets, decades)."""
    return (F.floor(_c(c) / F.lit(width)) * F.lit(width)).cast("long")


def top_k(
    df: DataFrame,
    k: int,
    order_by: Sequence[Column],
    tie_break: Sequence[ColumnLike] = (),
) -> DataFrame:
    """First k rows by ``order_by`` then ``tie_break`` (unique keys make it stable)."""
    return df.orderBy(*order_by, *[_c(t).asc_nulls_first() for t in tie_break]).limit(k)


def latest_by_key(
    df: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    order: ColumnLike,
    tie_break: Sequence[ColumnLike] = (),
) -> DataFrame:
    """Per key, each value column taken from the row with the greatest ``order``.

    Rows whose order is NULL are ignored; a key with no ordered row gets
    NULLs. Ties on ``order`` are broken by ``tie_break`` (struct ordering).
    The value is taken even when it is NULL on that row (MAX_BY semantics).
    """
    o = _c(order)
    ordering = F.when(o.isNotNull(), F.struct(o, *[_c(t) for t in tie_break])) if tie_break else o
    # one buffer for all values: the ordering is kept once
    latest = df.groupBy(*keys).agg(F.max_by(F.struct(*values), ordering).alias("_latest"))
    return latest.select(*keys, *[F.col("_latest")[v].alias(v) for v in values])


def growth_over_prior(
    df: DataFrame,
    period: str,
    value: str,
    partition_by: Sequence[str] = (),
    digits: int = 1,
    prev_name: str | None = None,
    growth_name: str = "growth_pct",
    drop_null_period: bool = False,
    distributed: bool = False,
) -> DataFrame:
    """Adds the previous period's value and the % change against it.

    ``df`` must already be one row per (partition_by, period) – aggregate
    first – so the window is small even without partition keys; where periods
    are many, ``distributed`` runs it as a scan over ranges. A NULL
    period sorts first and so becomes the "previous" of the earliest real
    period; ``drop_null_period`` removes that row instead.
    """
    if drop_null_period:
        df = df.filter(F.col(period).isNotNull())
    columns = df.columns
    if distributed:
        df = scan(df, period, {"_prior": ("prior", value)}, partition_by)
        prev = F.col("_prior")
    else:
        prev = F.lag(value).over(Window.partitionBy(*partition_by).orderBy(F.col(period).asc_nulls_first()))
    return df.select(
        *columns,
        prev.alias(prev_name or f"prev_{value}"),
        F.round(F.lit(100.0) * (F.col(value) - prev) / F.nullif(prev, F.lit(0)), digits).alias(
            growth_name
        ),
    )


def debut_cohorts(
    df: DataFrame,
    entity: str,
    period: str,
    period_name: str | None = None,
    new_name: str = "new_entities",
    cumulative_name: str = "cumulative_entities",
    partition_by: Sequence[str] = (),
    distributed: bool = False,
) -> DataFrame:
    """Entities counted in the period of their first appearance, plus running
    total, per ``partition_by`` group (an entity debuts once in each group).

    Two aggregations (min period per entity, then count per period); the
    running sum runs over one row per group and period, as a scan over ranges
    with ``distributed``.
    """
    out = period_name or period
    firsts = df.filter(F.col(period).isNotNull()).groupBy(*partition_by, entity).agg(F.min(period).alias(out))
    per = firsts.groupBy(*partition_by, out).agg(F.count(F.lit(1)).alias(new_name))
    if distributed:
        return scan(per, out, {cumulative_name: ("sum", new_name)}, partition_by).select(*partition_by, out, new_name, cumulative_name)
    w = Window.partitionBy(*partition_by).orderBy(F.col(out)).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return per.select(*partition_by, out, new_name, F.sum(new_name).over(w).cast("long").alias(cumulative_name))


def running_best(
    df: DataFrame,
    period: str,
    value: str,
    best: str = "min",
    partition_by: Sequence[str] = (),
    best_name: str = "period_best",
    running_name: str = "best_to_date",
    drop_null_period: bool = False,
    distributed: bool = False,
) -> DataFrame:
    """Best value per period and the best seen up to and including it.

    A NULL period sorts first, so its best seeds the running best of every
    later period; ``drop_null_period`` leaves those rows out. ``distributed``
    runs the window as a scan over ranges.
    """
    agg = F.min if best == "min" else F.max
    if drop_null_period:
        df = df.filter(F.col(period).isNotNull())
    per = df.groupBy(*partition_by, period).agg(agg(value).alias(best_name))
    if distributed:
        return scan(per, period, {running_name: (best, best_name)}, partition_by).select(*partition_by, period, best_name, running_name)
    w = (
        Window.partitionBy(*partition_by)
        .orderBy(F.col(period).asc_nulls_first())
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return per.select(*partition_by, period, best_name, agg(best_name).over(w).alias(running_name))


def bucket_counts(
    df: DataFrame, c: ColumnLike, width: int, name: str = "bucket", count_name: str = "n"
) -> DataFrame:
    """Histogram: rows per ``floor(c / width) * width`` bucket (NULL values form their own row)."""
    return df.groupBy(bucket(c, width).alias(name)).agg(F.count(F.lit(1)).alias(count_name))


def band_label(c: ColumnLike, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """CASE band: labels[i] for c < edges[i]; labels[-1] from the last edge on;
    NULL for NULL."""
    x = _c(c)
    expr = F.when(x.isNull(), F.lit(None).cast("string"))
    for e, lab in zip(edges, labels):
        expr = expr.when(x < e, F.lit(lab))
    return expr.otherwise(F.lit(labels[len(edges)]))


def band_stats(df: DataFrame, band: Column, value: str, order_by: ColumnLike, digits: int = 2) -> DataFrame:
    """Per band: count, mean and exact median of ``value``; rows ordered by
    min(order_by)."""
    rows = df.select(band.alias("band"), F.col(value).alias("_value"), _c(order_by).alias("_by"))
    stats = rows.groupBy("band").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("_value"), digits).alias("mean"), F.min("_by").alias("_order")
    )
    mid = quantiles(rows, ["band"], "_value", {"_median": 0.5}).select(F.col("band").alias("_band"), "_median")
    return (
        stats.join(mid, F.col("band").eqNullSafe(F.col("_band")), "left")
        .select("band", "n", "mean", F.round("_median", digits).alias("median"), "_order")
        .orderBy("_order")
        .drop("_order")
    )


def distinct_per_group(
    df: DataFrame, group: Sequence[str], value: str, name: str = "n_distinct"
) -> DataFrame:
    """Exact COUNT(DISTINCT value) per group (two-phase distinct aggregation);
    a group without a non-NULL value has 0."""
    return df.groupBy(*group).agg(F.count_distinct(value).alias(name))


def share_pct(
    df: DataFrame, group: Sequence[str], category: str, digits: int = 1, name: str = "share_pct"
) -> DataFrame:
    """Count per (group, category) and its % of the group total.

    The group totals come from a window over the already-aggregated
    (group, category) rows, not from the raw rows.
    """
    counts = df.groupBy(*group, category).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(*group))
    return counts.select(
        *group, category, "n", F.round(F.lit(100.0) * F.col("n") / total, digits).alias(name)
    )


def lookup_label(df: DataFrame, lookup: DataFrame, key: str, lookup_key: str, label: str, out: str) -> DataFrame:
    """Left-join a label from a lookup; unmatched keys fall back to the key text.

    No hint and no counting job: AQE broadcasts the lookup when its measured
    size is under the session's threshold and sort-merge joins it otherwise.
    """
    lk = lookup.select(F.col(lookup_key).alias("_lk"), F.col(label).alias("_label"))
    return (
        df.join(lk, F.col(key) == F.col("_lk"), "left")
        .withColumn(out, F.coalesce(F.col("_label"), F.col(key).cast("string")))
        .drop("_lk", "_label")
    )


def stratified_sample(df: DataFrame, strata: Sequence[str], key: str, k: int, draw_name: str = "weight") -> DataFrame:
    """Exactly ``k`` rows per stratum (all, if there are no more), the same ones
    in every run: those whose key has the smallest hashes. Every task keeps its
    own k + 1 smallest per stratum, so a hot stratum is cut before the shuffle.

    ``draw_name`` is the weight of a row, one over its chance to be drawn, given
    by the next smallest hash: weighted sums estimate totals without another
    scan. ``key`` is unique within a stratum.
    """
    # 48 bits of a hash that any engine has, as a number between 0 and 1
    draw = (F.conv(F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 12), 16, 10).cast("double") + 1) / float(1 << 48)
    order = Window.partitionBy(*strata).orderBy("_draw", key)
    near = df.withColumn("_draw", draw).withColumn("_at", F.row_number().over(order)).where(F.col("_at") <= k + 1)
    edge = F.max(F.when(F.col("_at") == k + 1, F.col("_draw"))).over(Window.partitionBy(*strata))
    return near.withColumn(draw_name, 1.0 / F.coalesce(edge, F.lit(1.0))).where(F.col("_at") <= k).select(*df.columns, draw_name)
