"""Generic operators on small literal tables."""

import pytest
from pyspark.sql import functions as F

from pacelake.operators import metrics as m
from pacelake.operators import quality as q


def test_growth_over_prior(spark):
    df = spark.createDataFrame([(2000, 10), (2001, 15), (2002, 0), (2003, 5)], "y int, n long")
    rows = m.growth_over_prior(df, "y", "n").orderBy("y").collect()
    assert [r.prev_n for r in rows] == [None, 10, 15, 0]
    assert [r.growth_pct for r in rows] == [None, 50.0, -100.0, None]


def test_growth_partitioned(spark):
    df = spark.createDataFrame([("a", 1, 2), ("a", 2, 4), ("b", 1, 5), ("b", 2, 5)], "k string, y int, n long")
    rows = {(r.k, r.y): r.growth_pct for r in m.growth_over_prior(df, "y", "n", partition_by=["k"]).collect()}
    assert rows == {("a", 1): None, ("a", 2): 100.0, ("b", 1): None, ("b", 2): 0.0}


def test_debut_cohorts(spark):
    df = spark.createDataFrame(
        [("x", 2000), ("x", 2001), ("y", 2001), ("z", 2003), ("z", None), ("w", None)], "e string, y int"
    )
    rows = m.debut_cohorts(df, "e", "y").orderBy("y").collect()
    assert [(r.y, r.new_entities, r.cumulative_entities) for r in rows] == [(2000, 1, 1), (2001, 1, 2), (2003, 1, 3)]


def test_running_best(spark):
    df = spark.createDataFrame([(2000, 5.0), (2000, 4.0), (2001, 6.0), (2002, 3.0), (None, 7.0)], "y int, v double")
    rows = m.running_best(df, "y", "v").collect()
    got = sorted([(r.y, r.period_best, r.best_to_date) for r in rows], key=lambda t: (t[0] is not None, t[0] or 0))
    assert got == [(None, 7.0, 7.0), (2000, 4.0, 4.0), (2001, 6.0, 4.0), (2002, 3.0, 3.0)]


def test_latest_by_key(spark):
    df = spark.createDataFrame(
        [(1, 1, "a"), (1, 3, None), (1, 2, "b"), (2, None, "c"), (3, 5, "d"), (3, 5, "e")],
        "k int, o int, v string",
    )
    got = {r.k: r.v for r in m.latest_by_key(df, ["k"], ["v"], "o", tie_break=["v"]).collect()}
    assert got == {1: None, 2: None, 3: "e"}


def test_top_k_tie_break(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 1), ("d", 3)], "k string, n int")
    rows = m.top_k(df, 2, [F.col("n").desc()], ["k"]).collect()
    assert [r.k for r in rows] == ["d", "a"]


def test_share_pct_and_buckets(spark):
    df = spark.createDataFrame([(1, "A"), (1, "A"), (1, "B"), (2, "B")], "g int, c string")
    got = {(r.g, r.c): (r.n, r.share_pct) for r in m.share_pct(df, ["g"], "c").collect()}
    assert got == {(1, "A"): (2, 66.7), (1, "B"): (1, 33.3), (2, "B"): (1, 100.0)}
    b = spark.createDataFrame([(0,), (4,), (5,), (12,), (None,)], "v int")
    got = {r.bucket: r.n for r in m.bucket_counts(b, "v", 5).collect()}
    assert got == {0: 2, 5: 1, 10: 1, None: 1}


def test_band_stats_median(spark):
    df = spark.createDataFrame([(float(i), float(i * 10)) for i in range(1, 11)], "x double, v double")
    band = m.band_label("x", [5], ["low", "high"])
    rows = m.band_stats(df, band, "v", "x").collect()
    assert [(r.band, r.n, r.mean, r.median) for r in rows] == [("low", 4, 25.0, 20.0), ("high", 6, 75.0, 70.0)]


def test_pct_where_and_lookup(spark):
    df = spark.createDataFrame([("W",), ("M",), ("M",)], "g string")
    assert df.agg(m.pct_where(F.col("g") == "W").alias("p")).first().p == 33.3
    facts = spark.createDataFrame([("BEL",), ("ZZZ",)], "code string")
    lk = spark.createDataFrame([("BEL", "Belgium")], "cc string, name string")
    got = {r.code: r.label for r in m.lookup_label(facts, lk, "code", "cc", "name", "label").collect()}
    assert got == {"BEL": "Belgium", "ZZZ": "ZZZ"}


def test_distinct_per_group(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (1, None), (2, None)], "g int, v string")
    got = {r.g: r.n_distinct for r in m.distinct_per_group(df, ["g"], "v").collect()}
    assert got == {1: 2, 2: 0}  # a group of NULLs only has none


def test_compare_results(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "z")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, None), (4, "w")], "k int, v string")
    assert q.compare_results(a, a).count() == 0
    got = sorted((r.side, r.k, r.v, r.n) for r in q.compare_results(a, b, "a", "b").collect())
    assert got == [("a", 1, "x", 1), ("a", 3, "z", 1), ("b", 4, "w", 1)]


def test_audit_star_schema(spark):
    fact = spark.createDataFrame([(1, 10), (1, 11), (2, 99), (None, None)], "id int, dim int")
    dim = spark.createDataFrame([(10,), (11,), (11,)], "dim int")
    rep = q.audit_star_schema(
        {"fact": fact, "dim": dim},
        primary_keys={"fact": "id", "dim": "dim"},
        foreign_keys=[("fact", "dim", "dim", "dim")],
        not_null={"fact": ["id", "dim"]},
    )
    got = {(r.check_name, r.table_name, r.column_name): r.n_violations for r in rep.collect()}
    assert got == {
        ("primary_key", "fact", "id"): 2,
        ("primary_key", "dim", "dim"): 1,
        ("foreign_key", "fact", "dim->dim.dim"): 1,
        ("not_null", "fact", "id"): 1,
        ("not_null", "fact", "dim"): 1,
    }


def test_profiles(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (2, None, None), (3, "c", 4.0)], "i int, s string, d double")
    assert q.shape(df).first().asDict() == {"n_rows": 3, "n_columns": 3}
    assert q.null_counts(df).first().asDict() == {"i": 0, "s": 1, "d": 1}
    summ = {r.column_name: r for r in q.numeric_summary(df, ["i", "d"]).collect()}
    assert (summ["i"]["count"], summ["i"].mean, summ["i"].min, summ["i"].p50, summ["i"].max) == (3, 2.0, 1.0, 2.0, 3.0)
    assert summ["d"].stddev == pytest.approx(2 ** 0.5)
    prof = {r.column_name: r for r in q.profile_table(df).collect()}
    assert prof["s"].n_nulls == 1 and prof["s"].min is None and prof["s"].data_type == "string"
    assert prof["d"].mean == 3.0 and prof["i"].max == 3.0
    assert (prof["s"].n_distinct, prof["s"].min_text, prof["s"].max_text, prof["s"].top_text, prof["s"].top_count) == (2, "a", "c", "a", 1)
    assert (prof["i"].p50, prof["i"].top_text, prof["i"].stddev, prof["d"].p25, prof["d"].top_number) == (2.0, "1", 1.0, 2.0, 2.0)
    empty = {r.column_name: r for r in q.profile_table(df.filter("i > 9")).collect()}
    assert empty["i"].n_rows == 0 and empty["i"].n_distinct == 0 and empty["s"].top_text is None


def test_lookup_has_no_hint(spark):
    facts = spark.createDataFrame([(i % 60,) for i in range(200)], "k int")
    lk = spark.createDataFrame([(i, f"n{i}") for i in range(50)], "k2 int, name string")
    out = m.lookup_label(facts, lk, "k", "k2", "name", "label")
    assert "hint" not in out._jdf.queryExecution().analyzed().toString().lower()
    assert {r.label for r in out.collect()} == {f"n{i}" for i in range(50)} | {str(i) for i in range(50, 60)}


def test_quantiles_are_exact(spark):
    import math
    import random

    rng = random.Random(3)
    rows = [(k, rng.choice([rng.random() * 100, float(rng.randrange(5)), None])) for k in ("a", "b", None) for _ in range(700)]
    rows.append(("c", None))
    probs = {"lo": 0.0, "q1": 0.25, "mid": 0.5, "hi": 1.0}
    got = {r.k: r for r in m.quantiles(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", probs, accuracy=50).collect()}
    assert set(got) == {"a", "b", None}
    for k, r in got.items():
        values = sorted(v for g, v in rows if g == k and v is not None)
        assert r.n == len(values)
        for name, p in probs.items():
            assert r[name] == values[max(1, math.ceil(p * len(values))) - 1], (k, name)
    assert m.quantiles(spark.createDataFrame([], "k string, v double"), [], "v", probs).count() == 0


def test_null_bands_and_null_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None)], "g string, v double")
    assert [r[0] for r in df.select(m.band_label("v", [5], ["low", "high"])).collect()] == ["low", None, None]
    assert {r.g: r.n_distinct for r in m.distinct_per_group(df, ["g"], "v").collect()} == {"a": 1, "b": 0}


def test_compare_reports_columns(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "k int, v string")
    assert q.compare_results(a, a).count() == 0
    got = {(r.side, r.k, r.v, r.n) for r in q.compare_results(a, spark.createDataFrame([(1, "x"), (3, None)], "k int, v string")).collect()}
    assert got == {("left", 1, "x", 1), ("left", 2, None, 1), ("right", 3, None, 1)}
    for other in ("k int, v string, extra int", "k int", "k long, v string"):
        with pytest.raises(ValueError, match="columns"):
            q.compare_results(a, spark.createDataFrame([], other))


def test_composite_keys_and_empty_foreign_keys(spark):
    fact = spark.createDataFrame([(1, 1, None), (1, 1, None), (1, 2, None), (2, None, None)], "a int, b int, d int")
    rep = q.audit_star_schema({"fact": fact, "dim": spark.createDataFrame([(1,)], "d int")}, {"fact": ["a", "b"]}, [("fact", "d", "dim", "d")])
    assert {(r.check_name, r.column_name): r.n_violations for r in rep.collect()} == {("primary_key", "a,b"): 2, ("foreign_key", "d->dim.d"): 0}


def test_profile_of_long_integers_and_ties(spark):
    """Longs that are the same as doubles are different values."""
    big = 2**53
    rows = [(big, "x", 1.5), (big + 1, "y", 1.5), (big + 2, "y", -0.0), (big + 1, "x", 0.0), (None, None, None), (-big - 1, "z", 2.5)]
    prof = {r.column_name: r for r in q.profile_table(spark.createDataFrame(rows, "i long, s string, d double")).collect()}
    assert (prof["i"].n_distinct, prof["i"].top_text, prof["i"].top_count) == (4, str(big + 1), 2)
    assert (prof["i"].min_text, prof["i"].max_text) == (str(-big - 1), str(big + 2))
    assert (prof["s"].n_distinct, prof["s"].top_text, prof["s"].top_count) == (3, "x", 2)  # of equals the smallest
    assert (prof["d"].n_distinct, prof["d"].top_number, prof["d"].top_count) == (3, 0.0, 2)
    assert prof["i"].n_nulls == 1 and prof["i"].n_rows == 6
    nested = spark.createDataFrame([([1, 2],), (None,), ([1, 2],)], "a array<int>")
    assert q.profile_table(nested).first().top_count == 2


def test_compare_looks_at_differing_buckets_only(spark):
    rows = [(i, f"v{i % 7}", None if i % 3 else float(i)) for i in range(5000)]
    a = spark.createDataFrame(rows, "k int, v string, d double")
    b = spark.createDataFrame([*rows[:40], (40, "other", 1.0), *rows[41:], rows[9]], "k int, v string, d double").repartition(5)
    assert q.checksum_differences(a, a.repartition(3), a.columns).count() == 0
    assert 1 <= q.checksum_differences(a, b, a.columns).count() <= 3
    got = {(r.side, r.k, r.v, r.n) for r in q.compare_results(a, b, "a", "b").collect()}
    assert got == {("a", 40, "v5", 1), ("b", 40, "other", 1), ("b", 9, "v2", 1)}
    # a NULL that moves to another column is a difference, in one bucket too
    x, y = (spark.createDataFrame([r], "a string, b string") for r in ((None, "z"), ("z", None)))
    assert q.compare_results(x, y).count() == 2 and q.compare_results(x, y, buckets=1).count() == 2
    assert {r.n for r in q.compare_results(a, a.union(a), buckets=2).collect()} == {1}


def test_frequent_values(spark):
    import random

    rng = random.Random(11)
    skewed = [(min(int(rng.paretovariate(0.9)), 4000),) for _ in range(20_000)] + [(None,)] * 30_000
    flat = [(i % 3000,) for i in range(9001)]
    for rows in (skewed, flat, flat[:2], [(None,)]):
        counts = {}
        for (v,) in rows:
            if v is not None:
                counts[v] = counts.get(v, 0) + 1
        want = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:5]
        for buckets in (1 << 16, 64):
            df = spark.createDataFrame(rows, "x int")
            assert [tuple(r) for r in q.frequent_values(df, "x", 5, buckets).collect()] == want
