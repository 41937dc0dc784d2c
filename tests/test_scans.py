"""Running windows over ranges of the order equal one global window."""

import random

import pytest
from conftest import SF_SMALL
from pyspark.sql import Window
from pyspark.sql import functions as F

from pacelake.operators import metrics as m
from pacelake.operators.scans import scan
from pacelake.plans import base_queries as bq


@pytest.fixture(scope="module")
def periods(spark):
    rng = random.Random(2)
    rows = [(k, t, rng.choice([None, rng.randrange(-50, 50)])) for k in ("a", "b", None) for t in rng.sample(range(2000), {"a": 900, "b": 3}.get(k, 40))]
    return spark.createDataFrame([*rows, ("a", None, 7), ("b", None, None)], "k string, t int, v int").repartition(6)


@pytest.mark.parametrize("keys", [["k"], []])
def test_scan_equals_a_window(spark, periods, keys):
    df = periods if keys else periods.where("k = 'a'")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = scan(df, "t", {"s": ("sum", "v"), "lo": ("min", "v"), "hi": ("max", "v"), "was": ("prior", "v")}, keys).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    own = Window.partitionBy(*keys).orderBy(F.col("t").asc_nulls_first())
    upto = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = df.select("*", F.sum("v").over(upto).alias("s"), F.min("v").over(upto).alias("lo"), F.max("v").over(upto).alias("hi"), F.lag("v").over(own).alias("was")).collect()
    assert set(got) == set(want) and len(got) == len(want)


def test_empty(spark, periods):
    assert scan(periods.where("false"), "t", {"s": ("sum", "v")}).count() == 0


def test_operators_agree_with_their_windows(spark):
    rows = bq._events_by_second(spark, SF_SMALL)
    per = rows.groupBy("second").agg(F.count(F.lit(1)).alias("n"))
    for a, b in (
        (m.running_best(rows, "second", "value", "max"), m.running_best(rows, "second", "value", "max", distributed=True)),
        (m.growth_over_prior(per, "second", "n"), m.growth_over_prior(per, "second", "n", distributed=True)),
        (m.debut_cohorts(rows, "user_id", "second", partition_by=["event_type"]), m.debut_cohorts(rows, "user_id", "second", partition_by=["event_type"], distributed=True)),
    ):
        assert a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


@pytest.mark.parametrize("query", [bq.events_record_value, bq.events_growth, bq.events_user_debuts])
def test_no_single_partition(spark, query):
    plan = query(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "SinglePartition" not in plan


def test_sample_sizes_and_weights(spark):
    df = spark.range(60_000).select("id", F.when(F.col("id") % 10 < 8, "big").otherwise(F.concat(F.lit("s"), F.col("id") % 10)).alias("g"), (F.col("id") % 100).alias("v"))
    few = spark.createDataFrame([(10**6 + i, "few", 1) for i in range(4)], "id long, g string, v long")
    drawn = m.stratified_sample(df.union(few), ["g"], "id", 400).collect()
    by = {}
    for r in drawn:
        by.setdefault(r.g, []).append(r)
    assert {g: len(x) for g, x in by.items()} == {"big": 400, "s8": 400, "s9": 400, "few": 4}
    assert all(r.weight == 1.0 for r in by["few"])
    for g, n in (("big", 48_000), ("s8", 6000)):
        assert abs(sum(r.weight for r in by[g]) / n - 1) < 0.15
    total = 48_000 * (sum(v for v in range(100) if v % 10 < 8) / 80)
    assert abs(sum(r.weight * r.v for r in by["big"]) / total - 1) < 0.2
    assert {r.id for r in m.stratified_sample(df.union(few).repartition(7), ["g"], "id", 400).collect()} == {r.id for r in drawn}
    plan = m.stratified_sample(df, ["g"], "id", 400)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
