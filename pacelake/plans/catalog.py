"""Registry of named queries: name -> (spark, input folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pacelake.operators.quality import compare_results
from pacelake.plans import base_queries as bq
from pacelake.plans import dashboard as d
from pacelake.plans import eda
from pacelake.plans.lake import GOLD_VIEWS, lake_for
from pacelake.streaming.replay import (
    bitmap_athletes_per_span,
    bitmap_athletes_per_year,
    bitmap_country_diversity,
    births_as_of_today,
    incremental_table,
    landed_batch_profile,
    landed_text_profile,
    quarantined_rows,
    replayed_lake,
    single_file_drop,
    stream_bronze_lineage,
)

Query = Callable[[SparkSession, str], DataFrame]


def _on_lake(fn: Callable) -> Query:
    def run(spark: SparkSession, base_dir: str) -> DataFrame:
        return fn(lake_for(spark, base_dir))

    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def _table(name: str) -> Query:
    return _on_lake(lambda lake: lake.table(name))


RACE_QUERIES: dict[str, Query] = {
    "silver_races_obt": _table("silver"),
    "gold_fct_results": _table("fct_results"),
    "gold_dim_event": _table("dim_event"),
    "gold_dim_athlete": _table("dim_athlete"),
    "gold_dim_date": _table("dim_date"),
    "vw_results_enriched": _table("vw_results_enriched"),
    "vw_distance_top_events": _table("vw_distance_top_events"),
    "vw_distance_gender_split": _table("vw_distance_gender_split"),
    "vw_distance_country_leaderboard": _table("vw_distance_country_leaderboard"),
    "vw_time_top_events": _table("vw_time_top_events"),
    "vw_time_country_leaderboard": _table("vw_time_country_leaderboard"),
    "vw_time_yearly_progression": _table("vw_time_yearly_progression"),
    "a1_total_finishes": _on_lake(d.a1_total_finishes),
    "a2_distinct_athletes": _on_lake(d.a2_distinct_athletes),
    "a3_distinct_events": _on_lake(d.a3_distinct_events),
    "a4_countries_represented": _on_lake(d.a4_countries_represented),
    "a5_median_100k_hours": _on_lake(d.a5_median_100k_hours),
    "a6_female_participation": _on_lake(d.a6_female_participation),
    "b1_finishes_per_year": _on_lake(d.b1_finishes_per_year),
    "b2_yoy_growth": _on_lake(d.b2_yoy_growth),
    "b3_debut_cohorts": _on_lake(d.b3_debut_cohorts),
    "b4_top_events": _on_lake(d.b4_top_events),
    "c1_top_countries": _on_lake(d.c1_top_countries),
    "c2_country_diversity": _on_lake(d.c2_country_diversity),
    "c3_fastest_100k_nations": _on_lake(d.c3_fastest_100k_nations),
    "d1_age_histogram": _on_lake(d.d1_age_histogram),
    "d2_gender_by_decade": _on_lake(d.d2_gender_by_decade),
    "d3_mean_age_per_year": _on_lake(d.d3_mean_age_per_year),
    "e1_distance_band_mix": _on_lake(d.e1_distance_band_mix),
    "e2_speed_by_band": _on_lake(d.e2_speed_by_band),
    "e3_speed_per_year": _on_lake(d.e3_speed_per_year),
    "e4_24h_distance_per_year": _on_lake(d.e4_24h_distance_per_year),
    "f1_fastest_100k": _on_lake(d.f1_fastest_100k),
    "f2_longest_24h": _on_lake(d.f2_longest_24h),
    "f3_record_progression": _on_lake(d.f3_record_progression),
    "f4_gender_speed_gap": _on_lake(d.f4_gender_speed_gap),
    "q1_finishes_per_year": _on_lake(d.q1_finishes_per_year),
    "q2_top_events_by_name": _on_lake(d.q2_top_events_by_name),
    "q3_fastest_100km_literal": _on_lake(d.q3_fastest_100km_literal),
    "q4_distance_averages": _on_lake(d.q4_distance_averages),
    "q5_top_countries_raw": _on_lake(d.q5_top_countries_raw),
    "q6_gender_per_year": _on_lake(d.q6_gender_per_year),
    "q7_age_histogram_10_100": _on_lake(d.q7_age_histogram_10_100),
    "q8_24h_per_year": _on_lake(d.q8_24h_per_year),
    "race_star_audit": _on_lake(d.race_star_audit),
    "stream_silver_races_obt": lambda spark, base: replayed_lake(spark, base).table("silver"),
    "stream_results_enriched": lambda spark, base: replayed_lake(spark, base).enriched(),
}


def stream_batch_compare(spark: SparkSession, base: str) -> DataFrame:
    """Silver of the batch build against silver of the streamed files: no row."""
    return compare_results(lake_for(spark, base).table("silver"), replayed_lake(spark, base).table("silver"), "batch", "stream")


INGEST_QUERIES: dict[str, Query] = {
    "stream_batch_compare": stream_batch_compare,
    "stream_bronze_lineage": stream_bronze_lineage,
    "landed_text_profile": landed_text_profile,
    **{f"incremental_{x}": incremental_table(x) for x in ("dim_event", "dim_athlete", "dim_date", "vw_results_enriched", *GOLD_VIEWS)},
    "landed_batch_profile": landed_batch_profile,
    "single_file_drop": single_file_drop,
    "births_as_of_today": births_as_of_today,
    "quarantined_rows": quarantined_rows,
    "bitmap_country_diversity": bitmap_country_diversity,
    "bitmap_athletes_per_year": bitmap_athletes_per_year,
    "bitmap_athletes_per_span": bitmap_athletes_per_span,
}


EDA_QUERIES: dict[str, Query] = {
    "x1_shape": _on_lake(eda.x1_shape),
    "x2_numeric_summary": _on_lake(eda.x2_numeric_summary),
    "x3_null_counts": _on_lake(eda.x3_null_counts),
    "x4_unique_events": _on_lake(eda.x4_unique_events),
    "x4_top_events": _on_lake(eda.x4_top_events),
    "x5_age_percentiles": _on_lake(eda.x5_age_percentiles),
    "x6_age_buckets": _on_lake(eda.x6_age_buckets),
    "x7_top_countries_raw": _on_lake(eda.x7_top_countries_raw),
    "x8_sample_pairs": _on_lake(eda.x8_sample_pairs),
    "x8_hash_sample": _on_lake(eda.x8_hash_sample),
}

BASE_QUERIES: dict[str, Query] = {
    "orders_yoy_growth": bq.orders_yoy_growth,
    "customer_debut_cohorts": bq.customer_debut_cohorts,
    "orders_record_low_price": bq.orders_record_low_price,
    "customer_latest_order": bq.customer_latest_order,
    "orders_date_dim": bq.orders_date_dim,
    "nation_customer_top": bq.nation_customer_top,
    "nations_per_year": bq.nations_per_year,
    "returnflag_share": bq.returnflag_share,
    "part_size_buckets": bq.part_size_buckets,
    "quantity_band_price": bq.quantity_band_price,
    "orders_hash_keys": bq.orders_hash_keys,
    "events_props_validated": bq.events_props_validated,
    "event_specs_validated": bq.event_specs_validated,
    "segment_debut_cohorts": bq.segment_debut_cohorts,
    "tpch_star_audit": bq.tpch_star_audit,
    "orders_compare": bq.orders_compare,
    "lineitem_profile": bq.lineitem_profile,
    "lineitem_frequent_parts": bq.lineitem_frequent_parts,
    "events_record_value": bq.events_record_value,
    "events_growth": bq.events_growth,
    "events_user_debuts": bq.events_user_debuts,
    "events_sample": bq.events_sample,
}


def all_queries() -> dict[str, Query]:
    return {**RACE_QUERIES, **INGEST_QUERIES, **EDA_QUERIES, **BASE_QUERIES}
