"""Summarise the final (AQE) physical plan of every registered query.

For each query: shuffles (by kind), joins (by strategy), the pushed filters
and read schema of every parquet scan, and whether any Python evaluation
appears. Writes PLANS.md. Usage: python tools/plan_report.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pacelake.plans.catalog import all_queries  # noqa: E402
from pacelake.session import build_session  # noqa: E402


def summarise(plan: str) -> dict:
    shuffles = re.findall(r"Exchange (hashpartitioning|SinglePartition|rangepartitioning|RoundRobinPartitioning)", plan)
    shuffles += ["hash" for _ in re.findall(r"ShuffleExchange", plan)]
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)", plan)
    scans = re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters: \[(.*?)\], ReadSchema", plan)
    parts = [p for p, _ in scans]
    pushed = [q for _, q in scans]
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    python = bool(re.search(r"(BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas)", plan))
    return {
        "shuffles": shuffles,
        "joins": joins,
        "pushed": [p for p in pushed if p],
        "partition_filters": [p for p in parts if p],
        "read_cols": [len(s.split(",")) for s in schemas],
        "python": python,
        "topk": "TakeOrderedAndProject" in plan,
        "window": "Window" in plan,
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=16, extra={"spark.sql.maxMetadataStringLength": "100000"})
    lines = [
        "# Physical plans of the registered queries",
        "",
        f"Final adaptive plans after execution on `{sf}` (local[8]), generated by",
        "`tools/plan_report.py`. Shuffles are counted per kind; joins per strategy",
        "(broadcasts are AQE decisions from measured",
        "sizes); columns read is the width of each parquet scan's ReadSchema.",
        "",
        "| query | shuffles | joins | scans: columns read | pushed filters | top-k / window | python |",
        "|---|---|---|---|---|---|---|",
    ]
    for name, q in all_queries().items():
        df = q(spark, sf)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        sh = ", ".join(f"{k}×{s['shuffles'].count(k)}" for k in sorted(set(s["shuffles"]))) or "none"
        jn = ", ".join(f"{k}×{s['joins'].count(k)}" for k in sorted(set(s["joins"]))) or "none"
        pf = "; ".join(
            [f"partition: {p[:60]}" for p in s["partition_filters"][:1]] + [p[:90] for p in s["pushed"][:2]]
        ) or "–"
        pf = re.sub(r"#\d+", "", pf).replace("|", "/")
        tw = "/".join(x for x, f in [("top-k", s["topk"]), ("window", s["window"])] if f) or "–"
        lines.append(
            f"| {name} | {sh} | {jn} | {s['read_cols'] or '–'} | {pf} | {tw} | {'yes' if s['python'] else 'no'} |"
        )
    lines += detail_sections(spark, sf)
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(lines) + "\n")
    spark.stop()


def _formatted(df) -> str:
    """The physical plan tree and per-node details of ``explain("formatted")``,
    with expression ids removed for readability."""
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    text = re.sub(r"#\d+L?", "", text)
    # scratch folders differ per run: show them relative to the lake root
    text = re.sub(r"file:\S*?/lake/[0-9a-f]{32}", "<lake>", text)
    return re.sub(r"/mv/v_\d+_[0-9a-f]+", "/mv/<version>", text).strip()


def detail_sections(spark, sf: str) -> list[str]:
    from pacelake.functions.clean import clean_results
    from pacelake.operators.metrics import quantiles
    from pacelake.plans import dashboard, model, views
    from pacelake.plans.lake import lake_for

    lake = lake_for(spark, sf)
    cases = [
        ("Silver cleaning (one map stage, no exchange)", clean_results(lake.table("bronze"), as_of_year=2026)),
        (
            "Enriched star join (as built by a refresh)",
            views.results_enriched(
                lake.table("fct_results"), lake.table("dim_event"), lake.table("dim_athlete"), lake.table("dim_date")
            ),
        ),
        ("dim_event build (hash aggregate on the scan, sort only after it)", model.dim_event(lake.table("silver"))),
        ("dim_athlete build (one max_by, grouped by the integer id)", model.dim_athlete(lake.table("silver"))),
        ("Serving views of distance events (one aggregation)", views.view_groups(lake.enriched(), "distance")),
        (
            "Exact median per distance band (sketch, bracket counts, rank)",
            quantiles(lake.enriched(), ["event_distance_length"], "athlete_average_speed", {"mid": 0.5}),
        ),
        ("F3 record progression (aggregate, then a window over one row per year)", dashboard.f3_record_progression(lake)),
        ("C1 top countries (aggregate per code before the lookup join)", dashboard.c1_top_countries(lake)),
    ]
    out = ["", "## Formatted plans of representative stages", ""]
    for title, df in cases:
        out += [f"### {title}", "", "```", _formatted(df), "```", ""]
    return out


if __name__ == "__main__":
    main()
