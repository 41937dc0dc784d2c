"""A third of all results on one athlete key: the enriched join must split
the hot partition (AQE skew join) and give the same rows as without it."""

from conftest import SF_SMALL
from pyspark.sql import functions as F

from pacelake.functions.clean import clean_results
from pacelake.operators.quality import compare_results
from pacelake.plans import model, views
from pacelake.sources.feed import race_feed


def _skewed_silver(spark):
    feed = race_feed(spark, SF_SMALL)
    # unknown athlete ids for a third of the rows: they all hash to one key
    hot = feed.withColumn(
        "athlete_source_id",
        F.when(F.abs(F.hash("event_dates", "athlete_performance")) % 3 == 0, F.lit(None).cast("int")).otherwise(
            F.col("athlete_source_id")
        ),
    )
    return clean_results(hot, as_of_year=2026)


def test_hot_athlete_key_is_split(spark, tmp_dir):
    silver_path = f"{tmp_dir}/silver"
    _skewed_silver(spark).write.parquet(silver_path)
    silver = spark.read.parquet(silver_path)
    fact, ev, ath, dd = (model.fct_results(silver), model.dim_event(silver), model.dim_athlete(silver), model.dim_date(silver))
    share = fact.groupBy("athlete_id").count().agg(F.max("count") / F.sum("count")).first()[0]
    assert share > 0.3

    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    saved = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        enriched = views.results_enriched(fact, ev, ath, dd)
        rows = enriched.collect()
        plan = enriched._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "SortMergeJoin" in plan and "skew=true" in plan
    plain = views.results_enriched(fact, ev, ath, dd)
    assert len(rows) == fact.count()
    assert compare_results(spark.createDataFrame(rows, plain.schema), plain).count() == 0
