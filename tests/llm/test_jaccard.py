import random
import re
from collections import defaultdict

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from pacelake.llm.common import components
from pacelake.llm.jaccard import jaccard_components, one_of_each, op5_jaccard_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(docs, k, num):
    """{row number: (size, component)} by comparing all pairs."""
    sets = [shingles(t, k) for _, t in docs]
    up = list(range(len(docs)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and min(len(a), len(b)) * 100 >= num * max(len(a), len(b)) and 100 * len(a & b) >= num * len(a | b):
                up[find(i)] = find(j)
    names = defaultdict(list)
    for i, (d, _) in enumerate(docs):
        names[find(i)].append(d)
    return [(d, len(s), min(names[find(i)]) if s else d) for i, ((d, _), s) in enumerate(zip(docs, sets))]


def near_copies(seed=4):
    """Groups of copies with a few changed, dropped or added words, a chain of
    links, common lines and short texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    line = [word() for _ in range(12)]
    texts = []
    for _ in range(8):
        base = [word() for _ in range(rng.choice((6, 40, 120)))]
        for _ in range(14):
            t = list(base)
            for _ in range(rng.randrange(6)):
                at = rng.randrange(len(t))
                t[at : at + rng.randrange(2)] = [word()] * rng.randrange(2)
            texts.append(" ".join((line if rng.random() < 0.5 else []) + t))
    step = [word() for _ in range(100)]
    for i in range(10):
        texts.append(" ".join(step[3 * i : 3 * i + 70]))
    return list(enumerate([*texts, texts[3].upper(), texts[5], "a b", "A  b", "a b c", "", None]))


@pytest.mark.parametrize("k, num", [(4, 85), (2, 60)])
def test_equals_all_pairs(spark, make, k, num):
    docs = near_copies()
    df = make([(d, t, None, None, None) for d, t in docs]).repartition(3)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(df, k, num, 100).collect())
    assert got == sorted(brute(docs, k, num))


def test_query_contract(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in op5_jaccard_join(spark, SF_SMALL).collect())
    assert got == sorted(brute(docs, 4, 85))


def test_awkward_rows(awkward, empty):
    rows = jaccard_components(awkward).collect()
    assert len(rows) == awkward.count()
    assert all(r.component_id == r.doc_id for r in rows if r.n_shingles == 0)
    assert jaccard_components(empty).count() == 0 and one_of_each(empty).count() == 0
    kept = one_of_each(awkward)
    assert kept.columns == awkward.columns and kept.count() < awkward.count()


def test_one_document_of_each_group_stays(spark, make):
    docs = near_copies()
    want = {c for _, _, c in brute(docs, 5, 80)}
    assert {r.doc_id for r in one_of_each(make([(d, t, None, None, None) for d, t in docs])).collect()} == want


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 60)]
    edges = spark.createDataFrame([*path, *star, (5, 5)], "a long, b long")
    got = {r.node: r.component for r in components(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}
    assert components(edges.where("a < 0")).count() == 0
