import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from pacelake.llm.mixing import flight, landing, mix, mixed_documents, op9_mixing, source_targets

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def water_fill(sizes, cap=3.0):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, free, left = {}, list(names), float(sum(sizes.values()))
    while free:
        unit = left / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * unit > cap * sizes[s]]
        if not over:
            target.update({s: weight[s] * unit for s in free})
            break
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
            free.remove(s)
    return target


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 10}, {"a": 1000, "b": 1, "c": 2, None: 5, "": 3}, {"a": 0, "b": 7}, {None: 4}])
def test_targets_by_water_filling(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in source_targets(rows).collect()}
    want = water_fill(sizes)
    assert got.keys() == want.keys()
    for s in want:
        assert got[s] == pytest.approx(want[s])


def test_flight_keeps_the_balance():
    rng = np.random.default_rng(5)
    p, size = rng.random(300), rng.integers(0, 2000, 300)
    out = flight(p, size, np.random.default_rng(1))
    assert ((out > 1e-9) & (out < 1 - 1e-9)).sum() <= 2
    assert out.sum() == pytest.approx(p.sum()) and (out * size).sum() == pytest.approx((p * size).sum())
    ends = landing(p, size, np.random.default_rng(1))
    assert set(ends) <= {0.0, 1.0} and abs((ends * size).sum() - (p * size).sum()) < 20


def test_inclusion_follows_the_probabilities():
    p, size = np.array([0.2, 0.5, 0.8, 0.3, 0.7] * 8), np.arange(40) + 1
    mean = np.mean([landing(p, size, np.random.default_rng(s)) for s in range(400)], axis=0)
    assert abs(mean - p).mean() < 0.12


def test_query_contract(spark):
    rows = op9_mixing(spark, SF_SMALL).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    sizes = defaultdict(int)
    for r in docs.values():
        sizes[r.source] += len(WORD.findall(r.text or ""))
    target, taken = water_fill(sizes), Counter()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.size == len(WORD.findall(docs[r.doc_id].text or "")) and r.source_size == sizes[docs[r.doc_id].source]
        assert r.target == pytest.approx(target[docs[r.doc_id].source]) and 0 <= r.taken <= 3 * r.size and r.taken % max(1, r.size) == 0
        taken[docs[r.doc_id].source] += r.taken
    assert abs(sum(taken.values()) - sum(sizes.values())) < 0.1 * sum(sizes.values())
    assert sorted(rows) == sorted(op9_mixing(spark, SF_SMALL).collect())


def test_awkward_rows(awkward, empty):
    rows = mix(awkward).collect()
    assert len(rows) == awkward.count()
    assert all(r.taken == 0 for r in rows if r.size == 0) and {r.source for r in rows} == {"s", None}
    assert sum(1 for r in rows if r.key is None) == 2
    assert mix(empty).count() == 0 and mixed_documents(empty).count() == 0


def test_documents_are_taken_as_often_as_the_mix_says(small):
    counts = Counter({r.key: r.copies for r in mix(small).collect() if r.copies})
    assert Counter(r.doc_id for r in mixed_documents(small).collect()) == counts
    assert mixed_documents(small).columns == small.columns


def test_many_blocks(spark):
    rows = spark.range(9000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 37).cast("int")).alias("text"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 4)).alias("source"))
    taken = {r.source: (r.t, r.target) for r in mix(rows).groupBy("source").agg(F.sum("taken").alias("t"), F.max("target").alias("target")).collect()}
    for got, want in taken.values():
        assert abs(got - want) < 40
