"""Plan-level guards over every registered query: no Python evaluation,
no cartesian or nested-loop joins, and no unchecked broadcast of a fact."""

import pytest
from conftest import SF_SMALL

from pacelake.plans.catalog import all_queries

FORBIDDEN = ["BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
             "CartesianProduct", "BroadcastNestedLoopJoin"]


@pytest.fixture(scope="module")
def plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")  # untruncated scan details
    out = {}
    try:
        for name, q in all_queries().items():
            qe = q(spark, SF_SMALL)._jdf.queryExecution()
            out[name] = qe.executedPlan().toString() + qe.optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    return out


def test_no_python_and_no_cross_joins(plans):
    bad = {n: [f for f in FORBIDDEN if f in p] for n, p in plans.items()}
    assert not {n: f for n, f in bad.items() if f}


LARGE = ("lineitem", "orders", "silver", "fct_results", "vw_results_enriched")


def broadcast_inputs(plan: str) -> list[str]:
    """The scans below each BroadcastExchange of a plan's text (by indent)."""
    lines, out = plan.splitlines(), []
    for i, line in enumerate(lines):
        at = line.find("BroadcastExchange")
        if at < 0:
            continue
        for below in lines[i + 1 :]:
            depth = len(below) - len(below.lstrip(" :+-"))
            if depth <= at:
                break
            if "FileScan" in below:
                out.append(below)
    return out


def test_no_hint_broadcasts_a_large_table(spark):
    # sizes decide at run time; with the threshold off, only a hint could broadcast
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hinted = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
        from pyspark.sql import functions as F

        probe = hinted.join(F.broadcast(hinted.withColumnRenamed("o_orderkey", "k")), F.col("o_orderkey") == F.col("k"))
        assert any("orders" in x for x in broadcast_inputs(probe._jdf.queryExecution().executedPlan().toString()))
        for name, q in all_queries().items():
            plan = q(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
            assert not [x for x in broadcast_inputs(plan) if any(f"{t}.parquet" in x or f"/{t}" in x for t in LARGE)], name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_dashboard_scans_are_pruned(plans):
    # aggregating dashboard queries read a handful of the 15 enriched columns
    import re

    for name in [n for n in plans if n[0] in "abcdef" and n[1].isdigit()]:
        widths = [len(s.split(",")) for s in re.findall(r"ReadSchema: struct<([^>]*)>", plans[name])]
        assert widths and max(widths) <= 9, (name, widths)
