"""Exploratory profile of the raw (bronze) result rows: X1-X8."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacelake.operators.metrics import quantiles, top_k
from pacelake.operators.quality import null_counts, numeric_summary, shape
from pacelake.plans.lake import Lake
from pacelake.schema import BRONZE_COLUMNS

c = F.col

# --- fixed values -------------------------------------------------------------
NUMERIC_COLUMNS = [
    "year_of_event",
    "event_number_of_finishers",
    "athlete_year_of_birth",
    "athlete_average_speed",
    "athlete_source_id",
]
AGE_PERCENTILES = {"p05": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95}
SAMPLE_FRACTION, SAMPLE_SEED, SAMPLE_ROWS = 0.0001, 42, 30
# ------------------------------------------------------------------------------


def _raw(lake: Lake) -> DataFrame:
    """The 13 source columns of the landed result rows (lineage left out)."""
    return lake.table("bronze").select(*BRONZE_COLUMNS)


def _ages(lake: Lake) -> DataFrame:
    age = c("year_of_event") - c("athlete_year_of_birth").cast("int")
    return _raw(lake).select(age.alias("age")).filter(c("age").between(10, 100))


def x1_shape(lake: Lake) -> DataFrame:
    return shape(_raw(lake))


def x2_numeric_summary(lake: Lake) -> DataFrame:
    return numeric_summary(_raw(lake), NUMERIC_COLUMNS)


def x3_null_counts(lake: Lake) -> DataFrame:
    return null_counts(_raw(lake))


def x4_unique_events(lake: Lake) -> DataFrame:
    """Distinct event names, NULL counted as one value (distinct rows semantics)."""
    return _raw(lake).select("event_name").distinct().agg(F.count(F.lit(1)).alias("n_events"))


def x4_top_events(lake: Lake, k: int = 20) -> DataFrame:
    g = _raw(lake).groupBy("event_name").agg(F.count(F.lit(1)).alias("n_results"))
    return top_k(g, k, [c("n_results").desc()], ["event_name"])


def x5_age_percentiles(lake: Lake) -> DataFrame:
    return quantiles(_ages(lake), [], "age", AGE_PERCENTILES).drop("n")


def x6_age_buckets(lake: Lake) -> DataFrame:
    b = ((c("age") / 5).cast("int") * 5).alias("age_bucket")
    return _ages(lake).groupBy(b).agg(F.count(F.lit(1)).alias("n_results")).orderBy("age_bucket")


def x7_top_countries_raw(lake: Lake, k: int = 25) -> DataFrame:
    g = _raw(lake).groupBy("athlete_country").agg(F.count(F.lit(1)).alias("n_results"))
    return top_k(g, k, [c("n_results").desc()], ["athlete_country"])


HASH_SAMPLE_BUCKETS = 10_000


def x8_hash_sample(lake: Lake, keep: int = 100) -> DataFrame:
    """Repeatable sample: rows whose athlete and performance hash (md5, the
    first seven hex digits) falls into the first ``keep`` of 10,000 buckets.
    The decision depends on the row alone, so any engine picks the same rows."""
    text = F.concat_ws("|", c("athlete_source_id").cast("string"), "event_name", "athlete_performance")
    bucket = F.conv(F.substring(F.md5(text.cast("binary")), 1, 7), 16, 10).cast("long") % HASH_SAMPLE_BUCKETS
    return _raw(lake).filter(bucket < keep).select("athlete_source_id", "event_distance_length", "athlete_performance")


def x8_sample_pairs(lake: Lake) -> DataFrame:
    """Bernoulli sample of (length, performance) text pairs; the sample and
    the row cap are the feature (a quick look at raw formats)."""
    return (
        _raw(lake)
        .select("event_distance_length", "athlete_performance")
        .sample(fraction=SAMPLE_FRACTION, seed=SAMPLE_SEED)
        .limit(SAMPLE_ROWS)
    )
