"""Clustering of a table along a space-filling curve.

Rows that are near in several columns at once are stored near each other, so the
minima and maxima of a file's row groups are narrow in each of these columns, and
a filter on any of them skips most row groups. A column's values are cut into
cells of about the same number of rows; the cells' numbers are interleaved bit by
bit (Morton code), all by built-in expressions.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 4  # of a column: 16 cells
_PREFIX = 6  # bytes of a text that decide about its cell


def image(df: DataFrame, column: str) -> Column:
    """A number in the order of the column's values (of texts: their first bytes)."""
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, T.StringType):
        return F.conv(F.hex(F.substring(F.rpad(c.cast("binary"), _PREFIX, F.unhex(F.lit("00"))), 1, _PREFIX)), 16, 10).cast("double")
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.unix_date(c.cast("date")).cast("double")
    return c.cast("double")


def cell_cuts(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list[float]]:
    """Per column the values at which cells begin: one aggregation, one row."""
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    row = df.agg(*[F.percentile_approx(image(df, x), shares, 1000).alias(x) for x in columns]).first()
    return {x: sorted(set(row[x] or [])) for x in columns}


def morton(df: DataFrame, cuts: dict[str, list[float]], bits: int = BITS) -> Column:
    """The interleaved cell numbers of the columns (a NULL is in the first cell)."""
    cells = []
    for x, ends in cuts.items():
        v = image(df, x)
        cells.append(reduce(lambda a, e: a + F.when(v >= F.lit(float(e)), 1).otherwise(0), ends, F.lit(0)))
    n = len(cells)
    code = F.lit(0)
    for b in range(bits):
        for j, cell in enumerate(cells):
            code = code + F.shiftleft(F.shiftright(cell, b).bitwiseAND(F.lit(1)), b * n + n - 1 - j)
    return code


def clustered(df: DataFrame, cuts: dict[str, list[float]], within: Sequence[str], bits: int = BITS) -> DataFrame:
    """Rows dealt out as ranges of the curve and sorted along it within them."""
    z = df.withColumn("_z", morton(df, cuts, bits))
    return z.repartitionByRange("_z", *within).sortWithinPartitions("_z", *within).drop("_z")
