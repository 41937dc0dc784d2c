"""Running values over a global order without a task that holds all rows.

A window without partition keys moves every row into one task. Here the rows are
dealt into ranges of the order; each range gives one aggregate row; the carry-in
of a range is the running value of the ranges before it (a row a range); and the
windows run within the ranges, on top of their carry-in. With partition keys, a
key of many rows is spread over ranges in the same way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pacelake.session import scratch_path


def _stored(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "scan")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _plus(a: Column, b: Column) -> Column:
    return F.coalesce(a + b, a, b)


def scan(df: DataFrame, order: str, columns: dict[str, tuple[str, str]], keys: Sequence[str] = ()) -> DataFrame:
    """``df`` with running columns: name -> (how, column), how one of ``sum``,
    ``min``, ``max`` (over the rows up to and with this one, NULLs left out) and
    ``prior`` (the row before). Rows are unique per ``keys`` and ``order``; a NULL
    order comes first."""
    c = F.col
    first = c(order).asc_nulls_first()
    stored = _stored(df)  # dealing out by ranges reads its input twice
    rows = _stored(stored.repartitionByRange(*[c(k).asc_nulls_first() for k in keys], first).withColumn("_part", F.spark_partition_id()))
    place = F.struct(c(order).isNotNull(), c(order))
    merge = {"sum": F.sum, "min": F.min, "max": F.max}
    aggregates = [
        (F.max_by(F.struct(c(v).alias("v")), place) if how == "prior" else merge[how](v)).alias(f"_a{i}") for i, (how, v) in enumerate(columns.values())
    ]
    parts = rows.groupBy("_part", *keys).agg(*aggregates)
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = [
        (F.last(f"_a{i}", ignorenulls=True) if how == "prior" else merge[how](f"_a{i}")).over(before).alias(f"_b{i}") for i, (how, _) in enumerate(columns.values())
    ]
    carry = _stored(parts.select(c("_part").alias("_p"), *[c(k).alias(f"_k{i}") for i, k in enumerate(keys)], *carried))
    on = c("_part") == c("_p")
    for i, k in enumerate(keys):
        on = on & c(k).eqNullSafe(c(f"_k{i}"))
    own = Window.partitionBy("_part", *keys).orderBy(first)
    upto = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    join = {"sum": _plus, "min": F.least, "max": F.greatest}
    out = []
    for i, (name, (how, v)) in enumerate(columns.items()):
        if how == "prior":
            out.append(F.when(F.row_number().over(own) == 1, c(f"_b{i}")["v"]).otherwise(F.lag(v).over(own)).alias(name))
        else:
            out.append(join[how](c(f"_b{i}"), merge[how](v).over(upto)).alias(name))
    return rows.join(carry, on).select(*df.columns, *out)
