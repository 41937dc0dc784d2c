import hashlib
import zlib

import pytest
from conftest import SF_MID, SF_SMALL

from pacelake.llm import manifest as mm


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(r, text):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return H(*(field(v) for v in (r.doc_id, r.source, r.lang, r.n_chars, text)))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        x = levels[-1]
        levels.append([H(*x[i : i + 16]) for i in range(0, len(x), 16)])
    return levels


def path(levels, i):
    out = []
    for x in levels[:-1]:
        run = x[i // 16 * 16 :][:16]
        out.append((run, i % 16))
        i //= 16
    return out


def brute(rows):
    """doc_id, leaf, subroot, root, proof, folded, verified of every row."""
    rows = sorted(rows, key=lambda r: (r.source is not None, (r.source or "").encode(), r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.text)))
    sources = list(dict.fromkeys(r.source for r in rows))
    own = {s: [r for r in rows if r.source == s] for s in sources}
    trees = {s: tree([leaf_of(r, r.text) for r in own[s]]) for s in sources}
    top = tree([trees[s][-1][0] for s in sources])
    root, out = top[-1][0], []
    for k, s in enumerate(sources):
        for i, r in enumerate(own[s]):
            steps = path(trees[s], i) + path(top, k)
            proof = H(*(x for run, at in steps for j, x in enumerate(run) if j != at))
            text = r.text
            if r.doc_id is not None and text is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0:
                text = text.translate({c: c + 32 for c in range(65, 91)})
            node = leaf_of(r, text)
            for run, at in steps:
                node = H(*run[:at], node, *run[at + 1 :])
            out.append((r.doc_id, leaf_of(r, r.text), trees[s][-1][0], root, proof, node, node == root))
    return out


def same(df, rows):
    key = lambda x: (x[0] is not None, *x)
    assert sorted((tuple(r) for r in df.collect()), key=key) == sorted(brute(rows), key=key)


@pytest.mark.parametrize("unit", [mm.UNIT, 7])
def test_equals_brute_force(spark, monkeypatch, unit):
    """Also with units so small that a run of 16 is in several of them."""
    monkeypatch.setattr(mm, "UNIT", unit)
    docs = spark.read.parquet(f"{SF_MID if unit > 7 else SF_SMALL}/documents.parquet")
    same(mm.tamper_report(docs), docs.collect())


def test_query(spark):
    got = mm.op13_merkle_manifest(spark, SF_SMALL)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    rows = got.collect()
    assert len({r.root for r in rows}) == 1 and not all(r.verified for r in rows)
    assert all(r.verified for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5)


def test_awkward_rows(spark, awkward, empty, make):
    same(mm.tamper_report(awkward), awkward.collect())
    assert mm.tamper_report(empty).count() == 0 and mm.manifest(empty) is None
    one = make(["ABC"])
    r = mm.tamper_report(one).first()
    assert r.leaf == r.subroot == r.root and r.proof_sha256 == H()
    rows = [(i, f"Text {i}", "en", f"é{i % 40}" if i % 3 else None, 5) for i in range(300)]
    many = make(rows)
    same(mm.tamper_report(many), many.collect())


def test_missing_nodes_are_least():
    for n, a, b in [(1, 0, 0), (16, 0, 15), (17, 16, 16), (300, 5, 40), (5000, 255, 256), (5000, 0, 4999)]:
        want, level = set(), 0
        levels = [n]
        while levels[-1] > 1:
            levels.append(-(-levels[-1] // 16))
        known, need = set(range(a, b + 1)), set()
        for level, count in enumerate(levels[:-1]):
            runs = {i // 16 for i in known}
            need |= {(level, i) for r in runs for i in range(r * 16, min(count, r * 16 + 16)) if i not in known}
            known = runs
        want = need
        assert set(mm.missing(a, b, n)) == want and len(mm.missing(a, b, n)) == len(want)


def test_siblings_fold_to_the_root(spark, make):
    docs = make([(i, f"t{i}", "en", "s" if i % 4 else "r", 2) for i in range(100)])
    m = mm.manifest(docs)
    for r in mm.proofs(m, with_siblings=True).collect():
        assert H(r.siblings) == r.proof_sha256 and len(r.siblings) % 64 == 0 and r.verified and r.folded_root == m.root
