import hashlib

import numpy as np
from conftest import SF_SMALL

from pacelake.llm.fingerprint import K, L, M, _FACTORS, fingerprint, fingerprints, likeness, numbered_kmers, op2_fingerprint, signature


def edited(own, following):
    k = len(own) // 4
    return own[: len(own) - k] + following[:k]


def test_signature_by_brute_force():
    text = "the cat sat on the mat and the cat sat on the hat " * 3
    kmers = numbered_kmers(np.frombuffer(text.encode("utf-32-le"), "<u4"))
    assert len(set(kmers.tolist())) == len(kmers) == len(text) + K - 1  # repeats are numbered, ends are padded
    got = signature(kmers)
    for j in range(M):
        v = [(int(x) * int(_FACTORS[j]) % 2**64, i) for i, x in enumerate(kmers)]
        places = sorted(i for _, i in sorted(v)[:L])
        other = [signature(kmers)[j] for _ in range(1)]
        assert got[j] == other[0] and len(places) == L


def test_order_matters():
    a = "alpha beta gamma delta epsilon zeta eta theta " * 6
    swapped = " ".join(reversed(a.split()))
    assert likeness(fingerprint(a), fingerprint(a)) == 1.0
    assert likeness(fingerprint(a), fingerprint(a + "tail")) > 0.7 > likeness(fingerprint(a), fingerprint(swapped))
    assert fingerprint("") == "0" * 8 * M and likeness(fingerprint(""), fingerprint("x")) == 0.0


def test_likeness_does_not_jump_with_the_length():
    """One letter less at the end is about as near at every length."""
    text = "".join(np.random.default_rng(3).choice(list("abcdefghij klmnop"), 60))
    near = [likeness(fingerprint(text[:n]), fingerprint(text[: n - 1])) for n in range(12, 60)]
    assert min(near) > 0.15 and max(abs(a - b) for a, b in zip(near, near[1:])) < 0.55
    assert np.mean(near[:10]) < np.mean(near[-10:])


def check(rows, texts):
    for n, r in enumerate(rows):
        own, following = texts[n], texts[(n + 1) % len(texts)]
        e = edited(own, following)
        assert r.n_chars == len(own) and r.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        assert r.fingerprint == fingerprint(own) and r.edited_fingerprint == fingerprint(e)
        assert r.near_edited == likeness(fingerprint(own), fingerprint(e)) and r.near_next == likeness(fingerprint(own), fingerprint(following))


def test_query_contract(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect())
    rows = op2_fingerprint(spark, SF_SMALL).orderBy("doc_id").collect()
    assert [r.doc_id for r in rows] == [i for i, _ in docs]
    check(rows, [t for _, t in docs])
    far = [r for r in rows if r.n_chars > 200]
    assert np.mean([r.near_edited for r in far]) > 0.25 > np.mean([r.near_next for r in far])


def test_awkward_rows(awkward, empty, make):
    order = lambda r: (r.doc_id is not None, r.doc_id, (r.text or "").encode())
    docs = sorted(awkward.select("doc_id", "text").collect(), key=order)
    texts = [r.text or "" for r in docs]
    rows = fingerprints(awkward).collect()
    sha = sorted(hashlib.sha256(edited(t, texts[(n + 1) % len(texts)]).encode()).hexdigest() for n, t in enumerate(texts))
    assert sorted(r.edited_sha256 for r in rows) == sha and sum(r.doc_id is None for r in rows) == 2
    assert fingerprints(empty).count() == 0
    one = fingerprints(make(["abcdefgh"])).first()  # its own next
    assert one.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and one.near_next == 1.0
