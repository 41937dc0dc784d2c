"""The generic operators applied directly to the star-schema input tables.

The same operators that drive the race dashboard (growth, cohorts, running
records, latest value per key, lookups, shares, buckets, bands, hashing,
JSON checks, audits, comparisons, profiles) run here on orders, lineitem,
customer, part and events, to show they are table-agnostic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacelake.functions.parsing import hash_key
from pacelake.operators.metrics import (
    band_label,
    band_stats,
    bucket_counts,
    debut_cohorts,
    distinct_per_group,
    growth_over_prior,
    latest_by_key,
    lookup_label,
    running_best,
    share_pct,
    stable_round,
    stratified_sample,
    top_k,
)
from pacelake.operators.quality import (
    audit_star_schema,
    compare_results,
    frequent_values,
    profile_table,
    validate_event_specs,
    validate_json_specs,
)
from pacelake.plans.model import dim_date
from pacelake.sources.tables import read_table

c = F.col

# --- fixed values (query parameters) ----------------------------------------------
QTY_BAND_EDGES = [10, 25, 40]
QTY_BAND_LABELS = ["1-9", "10-24", "25-39", "40+"]
EVENT_K_RANGE = (10, 90)
# ------------------------------------------------------------------------------------


def _orders_by_year(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, base, "orders").withColumn("o_year", F.year("o_orderdate"))


def orders_yoy_growth(spark: SparkSession, base: str) -> DataFrame:
    yearly = _orders_by_year(spark, base).groupBy("o_year").agg(F.count(F.lit(1)).alias("n_orders"))
    return growth_over_prior(yearly, "o_year", "n_orders", prev_name="prev_n_orders").orderBy("o_year")


def customer_debut_cohorts(spark: SparkSession, base: str) -> DataFrame:
    return debut_cohorts(
        _orders_by_year(spark, base), "o_custkey", "o_year",
        new_name="new_customers", cumulative_name="cumulative_customers",
    ).orderBy("o_year")


def orders_record_low_price(spark: SparkSession, base: str) -> DataFrame:
    return running_best(
        _orders_by_year(spark, base), "o_year", "o_totalprice", "min",
        best_name="year_min_price", running_name="record_to_date",
    ).orderBy("o_year")


def customer_latest_order(spark: SparkSession, base: str) -> DataFrame:
    return latest_by_key(
        read_table(spark, base, "orders"),
        keys=["o_custkey"],
        values=["o_orderpriority", "o_orderstatus"],
        order="o_orderkey",
    )


def orders_date_dim(spark: SparkSession, base: str) -> DataFrame:
    return dim_date(read_table(spark, base, "orders"), "o_orderdate")


def nation_customer_top(spark: SparkSession, base: str, k: int = 10) -> DataFrame:
    per_nation = read_table(spark, base, "customer").groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("n_customers"),
        F.round(F.avg("c_acctbal"), 2).alias("avg_acctbal"),
    )
    labelled = lookup_label(per_nation, read_table(spark, base, "nation"), "c_nationkey", "n_nationkey", "n_name", "nation")
    return top_k(labelled, k, [c("n_customers").desc()], ["c_nationkey"]).select("nation", "c_nationkey", "n_customers", "avg_acctbal")


def nations_per_year(spark: SparkSession, base: str) -> DataFrame:
    o = _orders_by_year(spark, base).select("o_custkey", "o_year")
    cu = read_table(spark, base, "customer").select("c_custkey", "c_nationkey")
    j = o.join(cu, c("o_custkey") == c("c_custkey"))
    return distinct_per_group(j, ["o_year"], "c_nationkey", "n_nations").orderBy("o_year")


def returnflag_share(spark: SparkSession, base: str) -> DataFrame:
    li = read_table(spark, base, "lineitem").withColumn("ship_year", F.year("l_shipdate"))
    return share_pct(li, ["ship_year"], "l_returnflag").orderBy("ship_year", "l_returnflag")


def part_size_buckets(spark: SparkSession, base: str) -> DataFrame:
    return bucket_counts(read_table(spark, base, "part"), "p_size", 5, "size_bucket", "n_parts").orderBy(
        "size_bucket"
    )


def quantity_band_price(spark: SparkSession, base: str) -> DataFrame:
    li = read_table(spark, base, "lineitem")
    return band_stats(
        li, band_label("l_quantity", QTY_BAND_EDGES, QTY_BAND_LABELS), "l_extendedprice", "l_quantity"
    ).select(
        c("band").alias("quantity_band"),
        c("n").alias("n_lines"),
        c("mean").alias("avg_price"),
        c("median").alias("median_price"),
    )


def orders_hash_keys(spark: SparkSession, base: str) -> DataFrame:
    o = read_table(spark, base, "orders")
    return o.select(
        "o_orderkey",
        hash_key("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority").alias("order_hash"),
        hash_key("o_custkey").alias("customer_hash"),
    )


def events_props_validated(spark: SparkSession, base: str) -> DataFrame:
    ev = read_table(spark, base, "events")
    return validate_json_specs(ev, "props", ["k"], {"k": EVENT_K_RANGE}, keep=["event_id"])


def spec_texts(spark: SparkSession, base: str) -> DataFrame:
    """(c_custkey, spec): race event specs as free text, one per customer, in
    fourteen kinds of right and wrong ones."""
    rows = read_table(spark, base, "customer").join(read_table(spark, base, "nation"), c("c_nationkey") == c("n_nationkey"))
    key = c("c_custkey")
    name = F.concat_ws(" ", F.upper("c_mktsegment"), F.lit("Trail,"), key.cast("string"))
    code = F.concat(F.lit(" n"), F.substring("n_name", 2, 2))
    km, runners = (key % 300).cast("string"), (key % 400).cast("string")
    good = F.format_string('{"event_name": "%s", "country": "%s", "distance_km": %s, "n_finishers": "%s.9"}', name, code, km, runners)
    kinds = [
        good,
        F.concat(F.lit("Here it is:\n```json\n"), good, F.lit("\n``` Enjoy")),
        F.regexp_replace(good, '"country"', '"land"'),
        F.regexp_replace(good, '"country": "[^"]*"', '"country": null'),
        F.regexp_replace(good, '"distance_km": [0-9]+', '"distance_km": "100d"'),
        F.concat(good, F.lit(" trailing }")),
        F.concat(good, F.lit(' {"a": 1}')),
        F.regexp_replace(good, '"', "'"),
        F.lit("no object here"),
        F.regexp_replace(good, '"event_name": "[^"]*"', '"event_name": null'),
        F.regexp_replace(good, '"distance_km": [0-9]+', '"distance_km": 1e12'),
        F.lit(None).cast("string"),
        F.concat(F.substring(good, 1, F.length(good) - 1), F.lit(', "n_finishers": 9}')),
        F.concat(F.lit('{"distance_km": "far", '), F.substring(good, 2, F.length(good))),
    ]
    spec = F.lit(None).cast("string")
    for i, kind in enumerate(kinds):
        spec = F.when(key % len(kinds) == i, kind).otherwise(spec)
    return rows.select("c_custkey", spec.alias("spec"))


def event_specs_validated(spark: SparkSession, base: str) -> DataFrame:
    return validate_event_specs(spec_texts(spark, base), "spec", keep=["c_custkey"])


def segment_debut_cohorts(spark: SparkSession, base: str) -> DataFrame:
    """Customers by the year of their first order, with a running total, per market segment."""
    cu = read_table(spark, base, "customer").select("c_custkey", "c_mktsegment")
    o = _orders_by_year(spark, base).select("o_custkey", "o_year").join(cu, c("o_custkey") == c("c_custkey"))
    return debut_cohorts(
        o, "o_custkey", "o_year", new_name="new_customers", cumulative_name="cumulative_customers", partition_by=["c_mktsegment"]
    ).orderBy("c_mktsegment", "o_year")


def tpch_star_audit(spark: SparkSession, base: str) -> DataFrame:
    t = {n: read_table(spark, base, n) for n in ["lineitem", "orders", "customer", "nation", "region", "part", "supplier"]}
    return audit_star_schema(
        t,
        primary_keys={"orders": "o_orderkey", "customer": "c_custkey", "nation": "n_nationkey",
                      "region": "r_regionkey", "part": "p_partkey", "supplier": "s_suppkey",
                      "lineitem": ["l_orderkey", "l_linenumber"]},
        foreign_keys=[
            ("lineitem", "l_orderkey", "orders", "o_orderkey"),
            ("lineitem", "l_partkey", "part", "p_partkey"),
            ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
            ("orders", "o_custkey", "customer", "c_custkey"),
            ("customer", "c_nationkey", "nation", "n_nationkey"),
            ("supplier", "s_nationkey", "nation", "n_nationkey"),
            ("nation", "n_regionkey", "region", "r_regionkey"),
        ],
        not_null={"lineitem": ["l_orderkey", "l_partkey", "l_shipdate"], "orders": ["o_custkey", "o_orderdate"]},
    )


def orders_compare(spark: SparkSession, base: str) -> DataFrame:
    o = read_table(spark, base, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    left = o.filter(c("o_orderstatus") != "P")
    right = o.filter(c("o_orderpriority") != "5-LOW")
    return compare_results(left, right, "not_pending", "not_low_priority")


def lineitem_profile(spark: SparkSession, base: str) -> DataFrame:
    profile = profile_table(read_table(spark, base, "lineitem"))
    return profile.withColumns({x: stable_round(x, 6) for x in ("mean", "stddev")})


def lineitem_frequent_parts(spark: SparkSession, base: str, k: int = 20) -> DataFrame:
    """The parts with the most order lines."""
    return frequent_values(read_table(spark, base, "lineitem"), "l_partkey", k).select(c("value").alias("l_partkey"), c("n").alias("n_lines"))


def _events_by_second(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, base, "events").withColumn("second", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


def events_record_value(spark: SparkSession, base: str) -> DataFrame:
    """Greatest value per second and so far: a running window over as many
    periods as there are seconds, without a task that holds them all."""
    return running_best(_events_by_second(spark, base), "second", "value", "max", best_name="second_max", running_name="max_to_date", distributed=True)


def events_growth(spark: SparkSession, base: str) -> DataFrame:
    """Events per second and the change against the second with events before."""
    per = _events_by_second(spark, base).groupBy("second").agg(F.count(F.lit(1)).alias("n_events"))
    return growth_over_prior(per, "second", "n_events", prev_name="prev_n_events", distributed=True)


def events_user_debuts(spark: SparkSession, base: str) -> DataFrame:
    """Users by the second of their first event of a type, with a running total
    per type."""
    return debut_cohorts(
        _events_by_second(spark, base), "user_id", "second", new_name="new_users", cumulative_name="cumulative_users", partition_by=["event_type"], distributed=True
    )


EVENT_SAMPLE = 25


def events_sample(spark: SparkSession, base: str) -> DataFrame:
    """So many events of every type, with their weights."""
    rows = read_table(spark, base, "events").select("event_type", "event_id", "value")
    return stratified_sample(rows, ["event_type"], "event_id", EVENT_SAMPLE)
