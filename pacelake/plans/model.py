"""Gold star schema: one fact table, event/athlete/date dimensions, country lookup.

All functions take the silver DataFrame (batch or stream for the fact;
batch for the dimensions, which aggregate and are recomputed per refresh).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacelake.functions.parsing import hash_key
from pacelake.operators.metrics import latest_by_key
from pacelake.schema import FACT_COLUMNS

# The plan of every dimension is a single partially-aggregated shuffle on
# its key; none of them needs more than the key plus a few attribute columns
# of silver, which column pruning reads from the parquet scan.


def date_id(c: Column) -> Column:
    """yyyyMMdd as int (NULL date -> NULL id)."""
    return F.date_format(c, "yyyyMMdd").cast("int")


def fct_results(silver: DataFrame) -> DataFrame:
    """One row per result; narrow projection, works on a stream."""
    return silver.select(
        *[
            date_id(F.col("event_start_date")).alias("date_id") if c == "date_id" else c
            for c in FACT_COLUMNS
        ]
    )


def dim_event(silver: DataFrame) -> DataFrame:
    """Per event (keyed by name): each attribute is its own MAX.

    An event name seen with several lengths becomes one row whose
    attributes may come from different lengths (string max of the text,
    'time' > 'distance'); that is the documented grain.
    """
    attributes = ["event_type", "event_distance_length", "event_distance_km", "event_duration_hours", "event_number_of_finishers"]
    # rows are first reduced to the distinct attribute rows of an event by a
    # hash aggregate (a count keeps it apart from the one that follows); the
    # string maxima, which need a sort, only see those few
    shapes = silver.groupBy("event_id", "event_name", *attributes).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 0")
    return shapes.groupBy("event_id", "event_name").agg(
        F.max("event_type").alias("event_type"),
        F.max("event_distance_length").alias("event_distance_length"),
        F.max("event_distance_km").alias("event_distance_km"),
        F.max("event_duration_hours").alias("event_duration_hours"),
        F.max("event_number_of_finishers").alias("event_number_of_finishers"),
    )


def dim_athlete(silver: DataFrame) -> DataFrame:
    """Latest known attributes per athlete (by year, then start date, then result id)."""
    # grouped by the short source id; the hash key is a function of it
    latest = latest_by_key(
        silver,
        keys=["athlete_source_id"],
        values=["athlete_country", "athlete_club", "athlete_gender", "athlete_year_of_birth"],
        order="year_of_event",
        tie_break=["event_start_date", "result_id"],
    )
    return latest.select(
        hash_key("athlete_source_id").alias("athlete_id"),
        "athlete_source_id",
        "athlete_country",
        "athlete_club",
        "athlete_gender",
        "athlete_year_of_birth",
    )


def dim_date(dates: DataFrame, date_col: str = "event_start_date") -> DataFrame:
    """One row per distinct non-NULL date. Distinct runs on the bare date column
    (one small aggregation); the calendar attributes are derived afterwards."""
    d = F.col("full_date")
    dow = F.dayofweek(d)
    return (
        dates.select(F.col(date_col).cast("date").alias("full_date"))
        .filter(d.isNotNull())
        .distinct()
        .select(
            date_id(d).alias("date_id"),
            d.alias("full_date"),
            F.year(d).alias("year"),
            F.quarter(d).alias("quarter"),
            F.month(d).alias("month"),
            F.date_format(d, "MMMM").alias("month_name"),
            F.dayofmonth(d).alias("day"),
            dow.alias("day_of_week"),
            F.date_format(d, "EEEE").alias("day_name"),
            dow.isin(1, 7).alias("is_weekend"),
        )
    )
