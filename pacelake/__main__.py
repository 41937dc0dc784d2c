"""Command line: build a lake, run a refresh, or run a named query.

    python -m pacelake init    --root /data/races        (raw/historical, raw/simulated, lake)
    python -m pacelake build   --input /data/tables --lake /data/lake
    python -m pacelake refresh --landing /data/landing --lake /data/lake
    python -m pacelake query   f3_record_progression --input /data/tables [--show 20] [--explain]
    python -m pacelake sql     "SELECT ... FROM vw_results_enriched" --lake /data/lake
    python -m pacelake validate --specs /data/specs.txt    (one event-spec text per line)
    python -m pacelake drop    --input rows.parquet --landing /data/races/raw/simulated --name 2026-12-02_aurora
    python -m pacelake list
"""

from __future__ import annotations

import argparse

from pacelake.session import build_session


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="pacelake")
    p.add_argument("--master", default="local[*]")
    p.add_argument("--cluster", action="store_true", help="cluster settings; master from spark-submit")
    p.add_argument("--shuffle-partitions", type=int, default=200)
    sub = p.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build")
    b.add_argument("--input", required=True)
    b.add_argument("--lake", required=True)
    b.add_argument("--as-of-year", type=int, default=None)
    b.add_argument("--strict", action="store_true")
    r = sub.add_parser("refresh")
    r.add_argument("--landing", required=True)
    r.add_argument("--lake", required=True)
    r.add_argument("--as-of-year", type=int, default=None)
    r.add_argument("--strict", action="store_true")
    r.add_argument("--archive", default=None, help="move ingested files here")
    q = sub.add_parser("query")
    q.add_argument("name")
    q.add_argument("--input", required=True)
    q.add_argument("--show", type=int, default=20)
    q.add_argument("--explain", action="store_true", help="print the formatted physical plan")
    s = sub.add_parser("sql")
    s.add_argument("text")
    s.add_argument("--lake", required=True)
    s.add_argument("--show", type=int, default=20)
    sub.add_parser("list")
    v = sub.add_parser("validate")
    v.add_argument("--specs", required=True)
    v.add_argument("--show", type=int, default=20)
    dr = sub.add_parser("drop")
    dr.add_argument("--input", required=True, help="parquet with the 13 snake_case result columns")
    dr.add_argument("--landing", required=True)
    dr.add_argument("--name", required=True)
    dr.add_argument("--single-file", action="store_true", help="merge the batch into one file (small drops)")
    i = sub.add_parser("init")
    i.add_argument("--root", required=True)
    a = p.parse_args(argv)

    if a.cmd == "list":
        from pacelake.plans.catalog import all_queries

        print("\n".join(all_queries()))
        return
    spark = build_session(a.master, shuffle_partitions=a.shuffle_partitions, cluster=a.cluster)
    if a.cmd == "build":
        from pacelake.plans.lake import build_lake

        build_lake(spark, a.input, a.lake, a.as_of_year, strict=a.strict)
    elif a.cmd == "refresh":
        from pacelake.streaming import refresh

        refresh(spark, a.landing, a.lake, as_of_year=a.as_of_year, strict=a.strict, archive_dir=a.archive)
    elif a.cmd == "query":
        from pacelake.plans.catalog import all_queries

        df = all_queries()[a.name](spark, a.input)
        if a.explain:
            df.explain("formatted")
        df.show(a.show, truncate=False)
    elif a.cmd == "validate":
        from pacelake.operators.quality import validate_event_specs

        texts = spark.read.text(a.specs).withColumnRenamed("value", "spec")
        validate_event_specs(texts, "spec", keep=["spec"]).show(a.show, truncate=60)
    elif a.cmd == "drop":
        from pacelake.sources.sinks import drop_batch

        out = drop_batch(spark.read.parquet(a.input), a.landing, a.name, single_file=a.single_file)
        print(f"landed {out}")
    elif a.cmd == "init":
        from pacelake.sources.fs import mkdirs

        root = a.root.rstrip("/")
        mkdirs(spark, f"{root}/raw/historical", f"{root}/raw/simulated", f"{root}/lake")
        print(f"landing: {root}/raw   lake: {root}/lake")
    elif a.cmd == "sql":
        from pacelake.plans.lake import open_lake

        open_lake(spark, a.lake).register()
        spark.sql(a.text).show(a.show, truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
