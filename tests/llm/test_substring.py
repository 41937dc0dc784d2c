import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from conftest import SF_MID

from pacelake.llm.common import documents
import pacelake.llm.substring as sub
from pacelake.llm.substring import repeated_passages, without_passages
from pacelake.llm.text import mix

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def exact_cover(docs, n=50):
    """Words in a run of n words that an earlier document has, too."""
    seen, cover = {}, defaultdict(set)
    for d, text in sorted(docs):
        w = WORD.findall((text or "").translate(LOWER))
        runs = [tuple(w[i : i + n]) for i in range(len(w) - n + 1)]
        for i, run in enumerate(runs):
            if seen.get(run, d) < d:
                cover[d].update(range(i, i + n))
        for run in runs:
            seen.setdefault(run, d)
    return cover


def cover_of(rows):
    out = defaultdict(set)
    for r in rows:
        assert r.first_doc_id < r.doc_id and r.n_words >= 50
        out[r.doc_id].update(range(r.first_word, r.first_word + r.n_words))
    return out


def test_compact_windows_are_the_nodes_of_the_cartesian_tree(monkeypatch):
    """Place and width of every node that is wide enough, under all functions,
    also when minima are looked for a few shingles at a time."""
    texts = [" ".join(random.Random(k).choices([f"w{i}" for i in range(12)], k=n)) for k, n in enumerate((130, 3, 190, 15))]
    for step in (sub.STEP, 16):
        monkeypatch.setattr(sub, "STEP", step)
        p = sub.Part(pa.array(texts), 3, 9)
        found = p.compact()
        assert len(found) == sub.HASHES
        for f, (at, first, last, key) in enumerate(found):
            v = [int(x) >> 24 for x in mix(p.g ^ sub._SEEDS[f])]

            def nodes(lo, hi, v=v):
                if hi - lo < 9:
                    return set()
                c = min(range(lo, hi), key=lambda i: (v[i], i))
                return {(c, max(lo, c - 8), min(hi - 1, c + 8))} | nodes(lo, c) | nodes(c + 1, hi)

            want = set().union(*(nodes(a, b) for a, b in zip(p.first, p.first[1:])))
            assert set(zip(at.tolist(), first.tolist(), last.tolist())) == want
            assert len(set(zip(at.tolist(), key.tolist()))) == len(want)


def test_exact_passages_are_all_found(spark):
    df = documents(spark, SF_MID)
    want = exact_cover([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])
    got = cover_of(repeated_passages(df).collect())
    assert not {d: len(w - got[d]) for d, w in want.items() if w - got[d]}


def make_texts():
    rng = random.Random(9)
    fresh = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    common, passage = fresh(60), fresh(80)
    texts = {}
    for i in range(30):
        texts[i] = fresh(rng.randrange(100))
        texts[i] += (common if i % 2 else []) + fresh(30) + (passage if i % 5 == 0 else []) + fresh(20)
    changed = list(passage)
    changed[40] = "other"
    texts[40] = fresh(10) + changed + fresh(10)  # one word changed
    texts[41] = fresh(200)  # clean
    texts[42] = fresh(20) + passage[:45] + fresh(20)  # too short a repeat
    texts[43] = list(texts[41])  # a copy
    return {i: " ".join(t) for i, t in texts.items()}, set(common + passage)


def test_planted_passages_and_clean_documents(make):
    texts, shared = make_texts()
    rows = repeated_passages(make([(i, t, None, None, len(t)) for i, t in texts.items()])).collect()
    got, want = cover_of(rows), exact_cover(texts.items())
    for d, w in want.items():
        assert w <= got[d]
    assert 42 not in got and 41 not in got and len(got[43]) == 200 and len(got[40]) >= 79
    for d, places in got.items():
        if d < 40:
            w = texts[d].split()
            assert sum(w[p] not in shared for p in places) <= 1


def test_removal(make):
    texts, shared = make_texts()
    df = make([(i, t, None, None, len(t)) for i, t in texts.items()])
    left = {r.doc_id: r for r in without_passages(df, repeated_passages(df)).collect()}
    assert 43 not in left and left[41].text == texts[41] and left[42].text == texts[42]
    firsts = [d for d in sorted(texts) if any(w in shared for w in texts[d].split())][:2]
    for d, r in left.items():
        assert r.n_chars == len(r.text)
        if d not in firsts and d != 42:
            assert sum(w in shared for w in r.text.split()) <= 2, d


def test_awkward_rows(awkward, empty):
    found = repeated_passages(awkward)
    rows = found.collect()
    assert {(r.doc_id, r.first_doc_id) for r in rows} <= {(None, None)} or rows == []
    assert without_passages(awkward, found).columns == awkward.columns
    assert without_passages(awkward, found).count() == awkward.count()
    assert repeated_passages(empty).count() == 0 and without_passages(empty, repeated_passages(empty)).count() == 0


def test_passages_by_definition():
    """Unions of windows with 4 of 5 agreeing shingles, cut to agreeing ends."""
    rng = np.random.default_rng(4)
    for _ in range(60):
        n = rng.integers(1, 60, 5)
        flags = [rng.random(k) < rng.choice([0.6, 0.8, 0.95]) for k in n]
        want = []
        for r, x in enumerate(flags):
            cover = np.zeros(len(x), bool)
            for i in range(len(x) - 9):
                if 5 * x[i : i + 10].sum() >= 40:
                    cover[i : i + 10] = True
            i = 0
            while i < len(x):
                j = i
                while j < len(x) and cover[j] == cover[i]:
                    j += 1
                hit = [k for k in range(i, j) if x[k]] if cover[i] else []
                if hit and hit[-1] - hit[0] + 1 >= 10:
                    want.append((r, hit[0], hit[-1]))
                i = j
        got = sub.passages(np.concatenate(flags), n, 10)
        assert list(zip(*(x.tolist() for x in got))) == want


def test_agreement_and_interval_join():
    rng = np.random.default_rng(8)
    a, b = ([rng.integers(1, 90, k).astype("<u2") for k in ks] for ks in ((20, 35), (60, 80)))
    base = np.array([17, 20])
    got = sub.agreeing(a, b, base)
    want = []
    for r in range(2):
        has = [x in b[r][base[r] + i - sub.SHIFT : base[r] + i + sub.SHIFT + 1] for i, x in enumerate(a[r])]
        want += [x and (has[i - 1 : i] == [True] or has[i + 1 : i + 2] == [True]) for i, x in enumerate(has)]
    assert got.tolist() == want and not all(want)
    group, lo, hi = np.array([0, 0, 0, 1, 1]), np.array([0, 5, 30, 0, 40]), np.array([20, 50, 80, 45, 90])
    assert sub._joined(group, lo, hi, 10)[0].tolist() == [0, 0, 0, 1, 2] and sub._joined(group, lo, hi, 5)[0].tolist() == [0, 0, 0, 1, 1]
