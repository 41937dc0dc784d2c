"""Serving views over the star schema (materialised per refresh)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacelake.schema import ENRICHED_COLUMNS


def results_enriched(fact: DataFrame, event: DataFrame, athlete: DataFrame, date: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Flattened star: fact ⋈ event ⋈ athlete ⟕ date, with the fact's columns
    in ``keep`` besides.

    Join strategy is left to AQE: dimensions whose measured size is under
    the broadcast threshold are broadcast, the rest are sort-merge joined
    with skewed keys (for example the one athlete all unknown ids fold into)
    split by the skew-join rule.
    """
    d = date.select("date_id", F.col("full_date").alias("event_date"), F.col("year").alias("event_year"))
    return (
        fact.join(event, "event_id")
        .join(athlete, "athlete_id")
        .join(d, "date_id", "left")
        .select(*ENRICHED_COLUMNS, *keep)
    )


def _hours(c):
    return c / F.lit(3600.0)


# The six serving views are aggregations of the enriched view. Every fact row
# has its event and athlete rows (all dimensions are rebuilt from the same
# silver table the facts stream from), so grouping the stored enriched rows
# gives the same result as re-joining the fact with the dimensions - without
# six more joins of the fact table per refresh. The three views of an event
# type share one GROUPING SETS aggregation over that type's rows only.

VIEW_KEYS = {
    "distance": {
        "vw_distance_top_events": ["event_name", "event_distance_length", "event_distance_km"],
        "vw_distance_gender_split": ["event_distance_length", "event_distance_km", "athlete_gender"],
        "vw_distance_country_leaderboard": ["athlete_country", "event_distance_length"],
    },
    "time": {
        "vw_time_top_events": ["event_name", "event_duration_hours"],
        "vw_time_country_leaderboard": ["athlete_country", "event_duration_hours"],
        "vw_time_yearly_progression": ["event_year", "event_duration_hours"],
    },
}


def _finishes(alias: str):
    return F.col("n").alias(alias)


def _measures(name: str) -> list:
    c = F.col
    avg_hours, best_hours = _hours(c("avg_secs")), _hours(c("min_secs"))
    return {
        "vw_distance_top_events": [
            _finishes("n_finishers_total"), avg_hours.alias("avg_finish_hours"), best_hours.alias("fastest_finish_hours"),
        ],
        "vw_distance_gender_split": [
            _finishes("n_finishes"), F.round("avg_speed", 3).alias("avg_speed_kmh"),
            F.round(avg_hours, 2).alias("avg_finish_hours"), F.round(best_hours, 2).alias("fastest_finish_hours"),
        ],
        "vw_distance_country_leaderboard": [
            _finishes("n_finishes"), c("avg_speed").alias("avg_speed_kmh"), best_hours.alias("fastest_finish_hours"),
        ],
        "vw_time_top_events": [
            _finishes("n_finishers_total"), c("avg_km").alias("avg_distance_km"), c("max_km").alias("max_distance_km"),
        ],
        "vw_time_country_leaderboard": [
            _finishes("n_finishes"), c("avg_km").alias("avg_distance_km"), c("max_km").alias("max_distance_km"),
        ],
        "vw_time_yearly_progression": [
            _finishes("n_finishes"), F.round("avg_km", 2).alias("avg_distance_km"), F.round("max_km", 2).alias("max_distance_km"),
        ],
    }[name]


# a view's groups that it leaves out: other genders, undated results
_KEPT = {
    "vw_distance_gender_split": "athlete_gender in ('M', 'W')",
    "vw_time_yearly_progression": "event_year is not null",
}


def view_groups(enriched: DataFrame, event_type: str) -> DataFrame:
    """All groups of an event type's views with their measures (partial
    aggregation, one shuffle); ``gid`` tells the views apart."""
    keys = sorted({k for cols in VIEW_KEYS[event_type].values() for k in cols})
    rows = enriched.filter(F.col("event_type") == event_type)
    return rows.groupingSets([list(cols) for cols in VIEW_KEYS[event_type].values()], *keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("performance_time_seconds").alias("avg_secs"),
        F.min("performance_time_seconds").alias("min_secs"),
        F.avg("athlete_average_speed").alias("avg_speed"),
        F.avg("performance_distance_km").alias("avg_km"),
        F.max("performance_distance_km").alias("max_km"),
        F.grouping_id().alias("gid"),
    )


def view_of(groups: DataFrame, event_type: str, name: str) -> DataFrame:
    """One serving view out of its event type's groups."""
    cols = VIEW_KEYS[event_type][name]
    keys = sorted({k for x in VIEW_KEYS[event_type].values() for k in x})
    gid = sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in cols)
    return groups.filter(F.col("gid") == gid).filter(_KEPT.get(name, "true")).select(*cols, *_measures(name))


def serving_view(enriched: DataFrame, name: str) -> DataFrame:
    """A serving view by its name."""
    event_type = next(t for t, views in VIEW_KEYS.items() if name in views)
    return view_of(view_groups(enriched, event_type), event_type, name)
