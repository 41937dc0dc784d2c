"""Exact quantiles whose ranking never grows with a group."""

import math
import random

import pytest
from pyspark.sql import functions as F

from pacelake.operators import exact_quantiles as qu


def expected(values, p):
    return sorted(values)[max(1, math.ceil(p * len(values))) - 1]


def test_two_million_values_of_one_group(spark):
    """No bracket holds more values than the stated number, at every width of
    the first sketch; the answers are those of sorted values."""
    n, ps = 2_000_000, [0.05, 0.5, 0.999]
    df = spark.range(n).select(((F.col("id") * 7919) % n).cast("double").alias("_v"))
    for accuracy, limit in ((1000, 2000), (100, 5000)):
        brackets = qu.brackets_of(df, [], ps, accuracy, limit)
        rows = qu.counted(df, brackets, [], len(ps))
        assert rows.count() <= len(ps) * (limit + 3)
        assert rows.agg(F.sum("_c")).first()[0] == n
        got = qu.quantiles(df, [], "_v", {f"p{i}": p for i, p in enumerate(ps)}, accuracy, limit).first()
        assert [got[f"p{i}"] for i in range(3)] == [math.ceil(p * n) - 1 for p in ps]


@pytest.mark.parametrize("limit", [1, 8, 10**6])
def test_narrowing_equals_sorting(spark, limit):
    rng = random.Random(limit)
    kinds = {
        "wide": lambda: 10.0 ** rng.uniform(-200, 200),
        "ties": lambda: float(rng.choice([1, 1, 1, 2])),
        "mixed": lambda: rng.choice([rng.gauss(0, 1), 0.0, 5.0]),
        None: lambda: float(rng.randrange(900)),
    }
    rows = [(k, make()) for k, make in kinds.items() for _ in range(3000)] + [("lone", 4.0), ("none", None)]
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.75, "e": 0.99, "f": 1.0}
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    got = {r.k: r for r in qu.quantiles(df, ["k"], "v", probs, accuracy=200, limit=limit).collect()}
    assert set(got) == {*kinds, "lone"}
    for k, r in got.items():
        values = [v for g, v in rows if g == k and v is not None]
        assert r.n == len(values)
        for name, p in probs.items():
            assert r[name] == expected(values, p), (k, name)


def test_whole_table_and_empty(spark):
    df = spark.createDataFrame([(float(i % 50),) for i in range(5000)], "v double")
    r = qu.quantiles(df, [], "v", {"q": 0.31}, accuracy=100, limit=2).collect()
    assert [(x.n, x.q) for x in r] == [(5000, expected([float(i % 50) for i in range(5000)], 0.31))]
    assert qu.quantiles(df.where("v < 0"), [], "v", {"q": 0.5}, limit=2).count() == 0
