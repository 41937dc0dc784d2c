"""The analytics catalogue over the gold layer.

A1-F4 are the dashboard widgets, Q1-Q8 the ground-truth validation
questions. Each function takes a ``Lake`` and returns a DataFrame; the
enriched view is a stored table, so each query is a pruned, filtered parquet
scan followed by (partial) aggregation. Top-k queries add a unique
tie-break so the rows at the cut are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacelake.operators.metrics import (
    band_label,
    band_stats,
    bucket,
    bucket_counts,
    count_where,
    debut_cohorts,
    distinct_per_group,
    growth_over_prior,
    lookup_label,
    pct_where,
    quantiles,
    running_best,
    top_k,
)
from pacelake.plans.lake import Lake

c = F.col

# --- fixed values (query parameters) -----------------------------------------
KM100_LOW, KM100_HIGH = 99, 101
DIST_BAND_EDGES = [60, 110, 170]
DIST_BAND_LABELS_E1 = ["50-59 km", "60-109 km", "110-169 km (100mi range)", "170+ km"]
DIST_BAND_LABELS_E2 = ["50-59 km", "60-109 km", "110-169 km", "170+ km"]
# ------------------------------------------------------------------------------


def _hours(x):
    return x / F.lit(3600.0)


def _km100(df: DataFrame) -> DataFrame:
    return df.filter(
        c("event_distance_km").between(KM100_LOW, KM100_HIGH) & c("performance_time_seconds").isNotNull()
    )


def _with_country_name(df: DataFrame, lake: Lake, out: str = "country") -> DataFrame:
    return lookup_label(df, lake.countries(), "athlete_country", "country_code", "country_name", out)


# --- Section A: headline counters --------------------------------------------

def a1_total_finishes(lake: Lake) -> DataFrame:
    return lake.table("fct_results").agg(F.count(F.lit(1)).alias("total_finishes"))


def a2_distinct_athletes(lake: Lake) -> DataFrame:
    return lake.table("dim_athlete").agg(F.count(F.lit(1)).alias("distinct_athletes"))


def a3_distinct_events(lake: Lake) -> DataFrame:
    return lake.table("dim_event").agg(F.count(F.lit(1)).alias("distinct_events"))


def a4_countries_represented(lake: Lake) -> DataFrame:
    return (
        lake.table("dim_athlete")
        .filter(c("athlete_country").isNotNull())
        .agg(F.count_distinct("athlete_country").alias("countries_represented"))
    )


def a5_median_100k_hours(lake: Lake) -> DataFrame:
    r = _km100(lake.enriched().filter(c("event_type") == "distance"))
    mid = quantiles(r, [], "performance_time_seconds", {"mid": 0.5})
    # a row even if no result matches
    return mid.agg(F.round(_hours(F.max("mid")), 2).alias("median_100k_finish_hours"))


def a6_female_participation(lake: Lake) -> DataFrame:
    r = lake.enriched().filter(c("athlete_gender").isin("M", "W"))
    return r.agg(pct_where(c("athlete_gender") == "W").alias("female_participation_pct"))


# --- Section B: growth --------------------------------------------------------

def _finishes_per_year(lake: Lake) -> DataFrame:
    return lake.enriched().groupBy("event_year").agg(F.count(F.lit(1)).alias("n_finishes"))


def b1_finishes_per_year(lake: Lake) -> DataFrame:
    return _finishes_per_year(lake).orderBy(c("event_year").asc_nulls_first())


def b2_yoy_growth(lake: Lake, exclude_null_year: bool = False) -> DataFrame:
    """Undated results form a NULL-year row that sorts first and becomes the
    prior year of the earliest real year (kept by default, as defined)."""
    return growth_over_prior(
        _finishes_per_year(lake),
        period="event_year",
        value="n_finishes",
        prev_name="prev_year_finishes",
        growth_name="yoy_growth_pct",
        drop_null_period=exclude_null_year,
    ).orderBy(c("event_year").asc_nulls_first())


def b3_debut_cohorts(lake: Lake) -> DataFrame:
    dated = lake.table("fct_results").join(lake.table("dim_date").select("date_id", "year"), "date_id")
    return debut_cohorts(
        dated,
        entity="athlete_id",
        period="year",
        period_name="event_year",
        new_name="new_athletes",
        cumulative_name="cumulative_athletes",
    ).orderBy("event_year")


def b4_top_events(lake: Lake) -> DataFrame:
    g = lake.enriched().groupBy("event_name", "event_distance_length").agg(
        F.count(F.lit(1)).alias("n_finishes"),
        F.round(F.avg("athlete_average_speed"), 2).alias("avg_speed_kmh"),
    )
    return top_k(g, 15, [c("n_finishes").desc()], ["event_name", "event_distance_length"])


# --- Section C: footprint -----------------------------------------------------

def c1_top_countries(lake: Lake) -> DataFrame:
    """Aggregate per country code first (a few hundred rows), then attach the
    country name: the lookup join touches one row per code, not per result."""
    per_code = (
        lake.enriched()
        .filter(c("athlete_country").isNotNull())
        .groupBy("athlete_country")
        .agg(
            F.count(F.lit(1)).alias("n_finishes"),
            F.round(F.avg("athlete_average_speed"), 2).alias("avg_speed_kmh"),
        )
    )
    g = _with_country_name(per_code, lake).select(
        "country", c("athlete_country").alias("ioc_code"), "n_finishes", "avg_speed_kmh"
    )
    return top_k(g, 25, [c("n_finishes").desc()], ["ioc_code"])


def c2_country_diversity(lake: Lake) -> DataFrame:
    return distinct_per_group(
        lake.enriched().filter(c("athlete_country").isNotNull()), ["event_year"], "athlete_country", "countries_represented"
    ).orderBy(c("event_year").asc_nulls_first())


def c3_fastest_100k_nations(lake: Lake, min_finishes: int = 50) -> DataFrame:
    """Grouped by country *name* (two codes can share one). Partial sums per
    code are computed first, then merged per name after the lookup."""
    per_code = (
        _km100(lake.enriched())
        .filter(c("athlete_country").isNotNull())
        .groupBy("athlete_country")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("performance_time_seconds").alias("s"),
            F.min("performance_time_seconds").alias("m"),
        )
    )
    g = (
        _with_country_name(per_code, lake)
        .groupBy("country")
        .agg(
            F.sum("n").alias("n_100k_finishes"),
            F.round(_hours(F.sum("s") / F.sum("n")), 2).alias("avg_finish_hours"),
            F.round(_hours(F.min("m")), 2).alias("fastest_finish_hours"),
        )
        .filter(c("n_100k_finishes") >= min_finishes)
    )
    return top_k(g, 25, [c("avg_finish_hours").asc()], ["country"])


# --- Section D: demographics --------------------------------------------------

def d1_age_histogram(lake: Lake) -> DataFrame:
    r = lake.enriched().filter(c("athlete_age").between(18, 80))
    return bucket_counts(r, "athlete_age", 5, "age_bucket", "n_finishes").orderBy("age_bucket")


def d2_gender_by_decade(lake: Lake) -> DataFrame:
    r = lake.enriched().filter(c("athlete_gender").isin("M", "W") & c("event_year").isNotNull())
    return (
        r.groupBy(bucket("event_year", 10).alias("decade"))
        .agg(
            count_where(c("athlete_gender") == "M").alias("men"),
            count_where(c("athlete_gender") == "W").alias("women"),
            pct_where(c("athlete_gender") == "W").alias("pct_women"),
        )
        .orderBy("decade")
    )


def d3_mean_age_per_year(lake: Lake) -> DataFrame:
    r = lake.enriched().filter(c("athlete_age").between(18, 80))
    return (
        r.groupBy("event_year")
        .agg(F.round(F.avg("athlete_age"), 1).alias("avg_finisher_age"))
        .orderBy(c("event_year").asc_nulls_first())
    )


# --- Section E: event profile -------------------------------------------------

def _distance_rows(lake: Lake) -> DataFrame:
    return lake.enriched().filter((c("event_type") == "distance") & c("event_distance_km").isNotNull())


def e1_distance_band_mix(lake: Lake) -> DataFrame:
    km = c("event_distance_km")
    order = (
        F.when(km < 60, 1).when(km < 110, 2).when(km < 170, 3).when(km.isNotNull(), 4).otherwise(99)
    )
    label = band_label(km, DIST_BAND_EDGES, DIST_BAND_LABELS_E1)
    return (
        _distance_rows(lake)
        .groupBy(label.alias("distance_band"), order.alias("band_order"))
        .agg(F.count(F.lit(1)).alias("n_finishes"))
        .orderBy("band_order")
    )


def e2_speed_by_band(lake: Lake) -> DataFrame:
    r = _distance_rows(lake).filter(c("athlete_average_speed").isNotNull())
    return band_stats(
        r,
        band_label("event_distance_km", DIST_BAND_EDGES, DIST_BAND_LABELS_E2),
        "athlete_average_speed",
        order_by="event_distance_km",
    ).select(
        c("band").alias("distance_band"),
        c("n").alias("n_finishes"),
        c("mean").alias("avg_speed_kmh"),
        c("median").alias("median_speed_kmh"),
    )


def e3_speed_per_year(lake: Lake) -> DataFrame:
    r = lake.enriched().filter((c("event_type") == "distance") & c("athlete_average_speed").isNotNull())
    return (
        r.groupBy("event_year")
        .agg(F.round(F.avg("athlete_average_speed"), 3).alias("avg_speed_kmh"))
        .orderBy(c("event_year").asc_nulls_first())
    )


def _h24(lake: Lake) -> DataFrame:
    return lake.enriched().filter(c("event_distance_length") == "24h")


def e4_24h_distance_per_year(lake: Lake) -> DataFrame:
    r = _h24(lake).filter(c("performance_distance_km").isNotNull())
    return (
        r.groupBy("event_year")
        .agg(
            F.round(F.avg("performance_distance_km"), 2).alias("avg_distance_km"),
            F.round(F.max("performance_distance_km"), 2).alias("max_distance_km"),
        )
        .orderBy(c("event_year").asc_nulls_first())
    )


# --- Section F: records -------------------------------------------------------

def f1_fastest_100k(lake: Lake) -> DataFrame:
    # top-k first (k rows leave each task), then the lookup on those 10 rows
    best = top_k(_km100(lake.enriched()), 10, [c("performance_time_seconds").asc()], ["result_id"])
    return _with_country_name(best, lake).orderBy(
        c("performance_time_seconds").asc(), c("result_id").asc()
    ).select(
        "event_name",
        "event_year",
        "country",
        "athlete_gender",
        "athlete_age",
        F.round(_hours(c("performance_time_seconds")), 2).alias("finish_hours"),
    )


def f2_longest_24h(lake: Lake) -> DataFrame:
    r = _h24(lake).filter(c("performance_distance_km").isNotNull())
    best = top_k(r, 10, [c("performance_distance_km").desc()], ["result_id"])
    return _with_country_name(best, lake).orderBy(
        c("performance_distance_km").desc(), c("result_id").asc()
    ).select(
        "event_name",
        "event_year",
        "country",
        "athlete_gender",
        "athlete_age",
        F.round("performance_distance_km", 2).alias("distance_km"),
    )


def f3_record_progression(lake: Lake, exclude_null_year: bool = False) -> DataFrame:
    """An undated best time sorts first and seeds the record of every year
    (kept by default, as defined; ``exclude_null_year`` drops it)."""
    r = _km100(lake.enriched()).select("event_year", _hours(c("performance_time_seconds")).alias("h"))
    rb = running_best(
        r, "event_year", "h", "min", best_name="year_best_hours", running_name="wrtd",
        drop_null_period=exclude_null_year,
    )
    return rb.select(
        "event_year",
        F.round("year_best_hours", 2).alias("year_best_hours"),
        F.round("wrtd", 2).alias("world_record_to_date"),
    ).orderBy(c("event_year").asc_nulls_first())


def f4_gender_speed_gap(lake: Lake) -> DataFrame:
    r = lake.enriched().filter(
        (c("event_type") == "distance")
        & c("athlete_gender").isin("M", "W")
        & c("athlete_average_speed").isNotNull()
        & c("event_year").isNotNull()
    )
    return (
        r.groupBy(bucket("event_year", 10).alias("decade"), "athlete_gender")
        .agg(
            F.count(F.lit(1)).alias("n_finishes"),
            F.round(F.avg("athlete_average_speed"), 3).alias("avg_speed_kmh"),
        )
        .orderBy("decade", "athlete_gender")
    )


# --- Validation questions -----------------------------------------------------

def q1_finishes_per_year(lake: Lake) -> DataFrame:
    return b1_finishes_per_year(lake)


def q2_top_events_by_name(lake: Lake) -> DataFrame:
    g = lake.enriched().groupBy("event_name").agg(F.count(F.lit(1)).alias("n_finishes"))
    return top_k(g, 10, [c("n_finishes").desc()], ["event_name"])


def q3_fastest_100km_literal(lake: Lake) -> DataFrame:
    r = lake.enriched().filter(
        (c("event_distance_length") == "100km") & c("performance_time_seconds").isNotNull()
    )
    best = top_k(r, 10, [c("performance_time_seconds").asc()], ["result_id"])
    return best.select(
        "event_name",
        "event_date",
        "athlete_country",
        "athlete_gender",
        "athlete_age",
        _hours(c("performance_time_seconds")).alias("finish_hours"),
    )


def q4_distance_averages(lake: Lake) -> DataFrame:
    g = (
        lake.enriched()
        .filter(c("event_type") == "distance")
        .groupBy("event_distance_length")
        .agg(
            F.count(F.lit(1)).alias("n_finishes"),
            _hours(F.avg("performance_time_seconds")).alias("avg_finish_hours"),
            F.avg("athlete_average_speed").alias("avg_speed_kmh"),
        )
    )
    return top_k(g, 20, [c("n_finishes").desc()], ["event_distance_length"])


def q5_top_countries_raw(lake: Lake) -> DataFrame:
    g = lake.enriched().groupBy("athlete_country").agg(
        F.count(F.lit(1)).alias("n_finishes"),
        F.avg("athlete_average_speed").alias("avg_speed_kmh"),
    )
    return top_k(g, 15, [c("n_finishes").desc()], ["athlete_country"])


def q6_gender_per_year(lake: Lake) -> DataFrame:
    return (
        lake.enriched()
        .filter(c("athlete_gender").isNotNull())
        .groupBy("event_year", "athlete_gender")
        .agg(F.count(F.lit(1)).alias("n_finishes"))
        .orderBy(c("event_year").asc_nulls_first(), "athlete_gender")
    )


def q7_age_histogram_10_100(lake: Lake) -> DataFrame:
    r = lake.enriched().filter(c("athlete_age").between(10, 100))
    return bucket_counts(r, "athlete_age", 5, "age_bucket_start", "n_finishes").orderBy("age_bucket_start")


def q8_24h_per_year(lake: Lake) -> DataFrame:
    return (
        _h24(lake)
        .groupBy("event_year")
        .agg(
            F.avg("performance_distance_km").alias("avg_distance_km"),
            F.max("performance_distance_km").alias("max_distance_km"),
            F.count(F.lit(1)).alias("n_finishes"),
        )
        .orderBy(c("event_year").asc_nulls_first())
    )


# --- Star-schema audit ----------------------------------------------------------

def race_star_audit(lake: Lake) -> DataFrame:
    """Key checks of the gold star: duplicate result ids (kept by design),
    facts without event/athlete/date rows (undated results), athlete
    country codes missing from the lookup."""
    from pacelake.operators.quality import audit_star_schema

    names = ["fct_results", "dim_event", "dim_athlete", "dim_date", "dim_country"]
    return audit_star_schema(
        {n: lake.table(n) for n in names},
        primary_keys={
            "fct_results": "result_id",
            "dim_event": "event_id",
            "dim_athlete": "athlete_id",
            "dim_date": "date_id",
            "dim_country": "country_code",
        },
        foreign_keys=[
            ("fct_results", "event_id", "dim_event", "event_id"),
            ("fct_results", "athlete_id", "dim_athlete", "athlete_id"),
            ("fct_results", "date_id", "dim_date", "date_id"),
            ("dim_athlete", "athlete_country", "dim_country", "country_code"),
        ],
        not_null={
            "fct_results": ["event_id", "athlete_id", "date_id"],
            "dim_event": ["event_name"],
            "dim_date": ["full_date"],
        },
        counted={n: lake.metrics(n) for n in names},
    )
