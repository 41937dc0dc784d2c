import hashlib
import re

import duckdb
from conftest import AWKWARD, SF_MID, SF_SMALL
from pyspark.sql import functions as F

from pacelake.llm import decontamination as dc

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOW = {c: c + 32 for c in range(65, 91)}


def cut(text):
    return WORD.findall((text or "").translate(LOW))


def brute(docs, items, window=10):
    """Per (doc_id, text) the result, by looking for every window at every place."""
    wins = {}
    for i, t in items:
        w = cut(t)
        n = min(window, len(w))
        for j in range(len(w) - n + 1) if w else ():
            wins.setdefault(tuple(w[j : j + n]), set()).add("" if i is None else str(i))
    out = []
    for d, t in docs:
        w, hit, got = cut(t), set(), set()
        for n in {len(x) for x in wins}:
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in wins:
                    hit |= set(range(j, j + n))
                    got |= wins[tuple(w[j : j + n])]
        sha = hashlib.sha256(",".join(sorted(got)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(got), sha, bool(hit)))
    return out


def key(x):
    return (x[0] is not None, *x)


def same(df, docs, items, window=10):
    assert sorted((tuple(r) for r in df.collect()), key=key) == sorted(brute(docs, items, window), key=key)


def pairs(df, i):
    return [(r[0], r[1]) for r in df.select(i, "text").collect()]


def test_equals_brute_force(spark):
    docs, items = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    same(dc.op12_decontamination(spark, SF_SMALL), pairs(docs, "doc_id"), pairs(items, "item_id"))


def test_equals_sql(spark):
    got = dc.op12_decontamination(spark, SF_MID)
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF_MID}/{t}.parquet'")
    want = con.sql(dc.ORACLE_SQL)
    assert want.columns == got.columns
    rows = sorted(tuple(r) for r in got.collect())
    assert rows == sorted(want.fetchall()) and any(r[5] for r in rows)


def test_planted_cases(spark, make):
    item = "Alpha beta, gamma delta-epsilon zeta eta THETA iota kappa lambda mu"
    other = "beta gamma delta epsilon zeta eta theta iota kappa lambda nu"  # shares a window with item
    short, one = "only four words here", "solitary"
    items = [(1, item), (10, other), (2, short), (3, one), (4, None), (5, "..."), (6, short), (None, "no id at all"), (2, short)]
    base = " ".join(f"w{i}" for i in range(30))
    docs = [
        base,
        f"{base} {item.lower()} {base}",
        f"{item} {item}",
        "alpha beta gamma delta epsilon zeta eta theta iota",  # a word too few
        "x beta gamma delta epsilon zeta eta theta iota kappa lambda y",
        "beta gamma delta epsilon ZETA éta theta iota kappa lambda",
        "only four words here solitary only four words",
        "Solitary, SOLITARY; solitary!",
        "no id at all",
        None,
        "",
        base + " only four words here",
        base + " only four words here",
    ]
    df = make(docs)
    b = spark.createDataFrame(items, "item_id long, text string")
    same(dc.contamination(df, b), list(enumerate(docs)), items)
    for window in (3, 5, 7):
        same(dc.contamination(df, b, window), list(enumerate(docs)), items, window)


def test_awkward_rows(spark, awkward, empty):
    items = [(i, t) for i, t in enumerate(AWKWARD)]
    b = spark.createDataFrame(items, "item_id long, text string")
    clash = b.withColumns({c: F.lit(1) for c in ("doc_id", "len", "size", "wtext", "token", "w", "n")})
    docs = awkward.withColumns({c: F.lit(1) for c in ("row_key", "spans", "pos", "at", "wtext", "len", "w", "n_words", "item_id")})
    same(dc.contamination(docs, clash), pairs(awkward, "doc_id"), items)
    assert dc.contamination(empty, b).count() == 0
    none = b.where("false")
    same(dc.contamination(docs, none), pairs(awkward, "doc_id"), [])


def test_native(spark):
    """No Python in the plan."""
    plan = dc.op12_decontamination(spark, SF_SMALL)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
