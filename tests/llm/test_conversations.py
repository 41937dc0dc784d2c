import hashlib
import itertools
import random
import re
import sys
import zlib
from functools import lru_cache

from conftest import SF_MID, SF_SMALL
from pyspark.sql import functions as F

from pacelake.llm import conversations as cv

sys.setrecursionlimit(20_000)  # the brute force goes down a row at a time
SOLID = re.compile("[^\x20\x09-\x0d]")


def damaged(rows):
    out = []
    for c, t, role, text in rows:
        name = lambda x: " " if x is None else x
        kind = zlib.crc32(f"{name(c)}:{name(t)}".encode()) % 20
        role, text = name(role), name(text)
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(c, t, role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(rows):
    """(cost, audit) over all edits, rows: (initial, must go, truncated)."""
    to = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}

    @lru_cache(None)
    def best(k, state, added):
        found = [(0, "")] if k == len(rows) and state in ("", "a") else []
        give = "a" if state == "u" else "u"
        if added < 2:
            cost, rest = best(k, give, added + 1)
            found.append((cost + 5, "I" + rest))
        if k < len(rows):
            initial, gone, cut = rows[k]
            cost, rest = best(k + 1, state, 0)
            found.append((cost + 2, "D" + rest))
            if not gone:
                if (state, initial) in to:
                    cost, rest = best(k + 1, to[state, initial], 0)
                    found.append((cost + 5 * cut, "K" + rest))
                cost, rest = best(k + 1, give, 0)
                found.append((cost + 1 + 5 * cut, "R" + rest))
        return min(found, default=(10**9, ""))

    return best(0, "", 0)


def report(rows, ids):
    """The contract for damaged rows and all ids."""
    out = []
    for c in ids:
        own = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).digest()))
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, faults, n = set(), [], [0, 0, 0]
        for _, _, role, text in own:
            solid = SOLID.findall(text)
            fault = 0 if not solid else 1 if (role, text) in seen else 2 if solid[-1] not in ".!?" else 3
            seen.add((role, text))
            if fault < 3:
                n[fault] += 1
            faults.append((role[:1], fault < 2, fault == 2))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in itertools.pairwise(faults))
        cost, audit = cheapest(tuple(faults))
        lines, k, state = [], 0, ""
        for x in audit:
            give = "a" if state == "u" else "u"
            if x == "I":
                lines.append(("user" if give == "u" else "assistant") + ":")
                state = give
                continue
            _, _, role, text = own[k]
            k += 1
            if x == "K":
                lines.append(f"{role}:{text}")
                state = role[0]
            elif x == "R":
                lines.append(("user" if give == "u" else "assistant") + f":{text}")
                state = give
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
        out.append((c, gaps, *n, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def key(x):
    return (x[0] is not None, *x)


def same(df, rows, ids):
    assert sorted((tuple(r) for r in df.collect()), key=key) == sorted(report(rows, ids), key=key)


def plain(df):
    return [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]


def test_query_equals_brute_force(spark):
    for folder in (SF_SMALL, SF_MID):
        rows = plain(spark.read.parquet(f"{folder}/conversations.parquet"))
        same(cv.op11_conversation_repair(spark, folder), damaged(rows), {r[0] for r in rows})


def test_repair_equals_all_edits():
    rng = random.Random(5)
    for _ in range(600):
        rows = [(rng.choice("ssuuaax"), rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.randrange(9))]
        if rng.random() < 0.4:
            rows = [r for r in rows for _ in range(rng.randrange(1, 4))]
        runs = [(cv.MUST_GO if gone else "suax".index(i) + 4 * cut, len(list(g))) for (i, gone, cut), g in itertools.groupby(rows)]
        assert cv.repair(runs) == cheapest(tuple(rows))


def test_long_runs(monkeypatch):
    rows = [("u", False, False)] * 700 + [("a", False, True)] * 3 + [("x", False, False)] * 50
    runs = [(cv.U, 700), (cv.A + 4, 3), (cv.OTHER, 50)]
    want = cv.repair(runs)
    monkeypatch.setattr(cv, "BLOCK", 64)
    assert cv.repair(runs) == want
    cost = 0
    for x in want[1]:
        cost += {"K": 0, "R": 1, "D": 2, "I": 5}[x]
    letters = [x for x in want[1] if x != "I"]
    assert len(letters) == len(rows) and want[0] == cost + 5 * sum(x != "D" for x in letters[700:703])
    assert cv.advance(cv.U, 1000, cv.AT_END) == cv.advance(cv.U, 488, cv.advance(cv.U, 512, cv.AT_END))
    assert cv.repair([(cv.U, 10**6)])[0] == 5 * 10**5  # every other turn becomes an assistant's


SCHEMA = "conv_id long, turn long, role string, text string"
ROWS = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hi!"), (1, 2, "assistant", "Hello"), (1, 2, "assistant", "Hello"), (1, 5, None, None),
    (1, None, "user", "first?"), (1, None, "user", "first?"), (1, 9, "user", "first?"),
    (2, None, None, None), (2, None, "", ""),
    (None, 3, "user", "no id."), (None, 4, "assistant", "none."), (None, None, "tool", "odd"),
    (3, 7, "user", "x" * 100_000), (3, 8, "assistant", "same turn."), (3, 8, "assistant", "other text."), (3, 8, "user", "same turn."),
    (4, 1, "assistant", " \t\n"),
]


def test_awkward_rows(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).withColumns({c: F.lit(1) for c in ("kind", "mark", "n", "part", "seg", "cls", "copy", "audit")})
    same(cv.repair_report(df, df), [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in ROWS], {r[0] for r in ROWS})
    same(cv.repair_report(cv.damage(df), df), damaged(ROWS), {r[0] for r in ROWS})
    none = df.where("false")
    assert cv.repair_report(none, none).count() == 0
    left = cv.repair_report(none, df).collect()
    assert {(r.cost, r.audit, r.repaired_sha256) for r in left} == {(0, "", hashlib.sha256().hexdigest())} and len(left) == 5


def test_one_conversation_over_many_parts(spark):
    """A conversation with nearly all rows lies in many ranges."""
    rng = random.Random(9)
    rows = [(7, t, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", "No", f"t{t}."])) for t in range(400)] + [(8, 1, "user", "a."), (8, 2, "assistant", "b.")]
    df = spark.createDataFrame(rows, SCHEMA)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        same(cv.repair_report(df, df), rows, {7, 8})
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_repaired_rows_are_what_is_hashed(spark):
    df = cv.damage(spark.read.parquet(f"{SF_SMALL}/conversations.parquet"))
    texts = {}
    for r in sorted(cv.repaired_rows(df).collect(), key=lambda r: (r.conv_id, r.place)):
        texts.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for r in cv.repair_report(df, df).collect():
        assert hashlib.sha256("\n".join(texts.get(r.conv_id, [])).encode()).hexdigest() == r.repaired_sha256
