import pickle
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_MID
from hypothesis import given, settings
from hypothesis import strategies as st

from pacelake.llm import toxicity as tox
from pacelake.sources.tables import read_table


def keys_of(*texts):
    return tox.units(pa.array(list(texts), pa.string()))


def kernel(a, b):
    """Gap-weighted subsequences of three symbols, by definition."""
    def weights(s):
        out = {}
        for i in range(len(s)):
            for j in range(i + 1, len(s)):
                for k in range(j + 1, min(len(s), i + tox.ORDER_SPAN)):
                    out[s[i] + s[j] + s[k]] = out.get(s[i] + s[j] + s[k], 0) + tox.DECAY ** (k - i + 1)
        return out

    x, y = weights(a), weights(b)
    dot = lambda u, v: sum(w * v.get(t, 0) for t, w in u.items())
    return dot(x, y) / (dot(x, x) * dot(y, y)) ** 0.5 if x and y else 0.0


@settings(max_examples=80, deadline=None, derandomize=True)
@given(st.text(alphabet="abcd", min_size=1, max_size=8), st.text(alphabet="abcd", min_size=3, max_size=8))
def test_kernel_by_definition(a, b):
    got = tox.similarities(keys_of(a)[0], tox.landmark_table(keys_of(b)[0]))[0, 0]
    want = kernel(a, b)
    assert got == pytest.approx(want**tox.POWER if want >= tox.FLOOR else 0.0, abs=2e-3) or abs(want - tox.FLOOR) < 1e-3


def test_units():
    spell = lambda t: [tox.spell(int(k)) for k in keys_of(t)[0]]
    assert spell("An I-d.i*o!t here") == ["an", "idiot", "here"]
    assert spell("an i d i o t") == ["an", "idiot"]
    assert spell("abcdefghijkl") == ["abcdefgh", "efghijkl"]
    assert spell("") == [] and spell(None) == []


def sentences(n, seed):
    rng = np.random.default_rng(seed)
    plain = ["".join(rng.choice(list("aeiounrstlm"), 6)) for _ in range(300)]
    texts, labels = [], []
    for i in range(n):
        words = list(rng.choice(plain, 12))
        if i % 4 == 0:
            words[rng.integers(12)] = str(rng.choice(["blockhead", "nitwit", "dumbbell"]))
        texts.append(" ".join(words))
        labels.append(int(i % 4 == 0))
    return texts, labels


def test_gapped_and_inserted_characters():
    machine = tox.fit(*sentences(800, 1))
    texts, labels = sentences(400, 2)
    right = (tox.scores(machine, pa.array(texts)) >= 0.5) == np.array(labels)
    assert right.mean() > 0.98
    score = dict(zip(hard := ["a nitwit", "a n-i-t-w-i-t", "a n i t w i t", "a nitxwit", "a river", ""], tox.scores(machine, pa.array(hard))))
    assert min(score["a nitwit"], score["a n-i-t-w-i-t"], score["a n i t w i t"]) > 0.5
    assert score["a nitxwit"] > score["a river"] + 0.1 and max(score["a river"], score[""]) < 0.5


def test_held_out_accuracy(spark):
    rows = tox.op6_toxicity(spark, SF_MID).collect()
    labels = {r.doc_id: r.toxic for r in read_table(spark, SF_MID, "labels").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) / len(held) > 0.9


def test_awkward_rows(spark, awkward, empty):
    machine = tox.fit(*sentences(400, 1))
    rows = tox.scored(awkward, machine, ["doc_id", "score", "_t"]).toDF("doc_id", "own", "t", "score").collect()
    assert len(rows) == awkward.count() and len({r.score for r in rows if r.doc_id in (0, 1, 2)}) == 1
    assert tox.scored(empty, machine, ["doc_id"]).count() == 0
    assert tox.scored(awkward, None, ["doc_id"]).where("score <> 0").count() == 0
    kept = tox.without_toxic(awkward, machine)
    assert kept.columns == awkward.columns and kept.count() == awkward.count()
    assert tox.fit([], []) is None and tox.fit(["a"], [1]) is None and tox.fit(["same text", "same text"], [0, 1]) is None
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (3, None), (4, 0)], "doc_id long, toxic int")
    assert tox.training_sample(awkward, labels)[1] in ([1, 0, 0], [1, 0])


def test_fit_takes_no_memory_per_unit():
    """Four times the texts, with the same words: little more memory at once."""
    def peak(texts, labels):
        tracemalloc.start()
        try:
            assert tox.fit(texts, labels, rounds=2) is not None
            return tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()

    texts, labels = sentences(800, 3)
    texts = [" ".join([t] * 48) for t in texts]
    few, many = peak(texts, labels), peak(texts * 4, labels * 4)
    assert many < 1.5 * few


def test_parts_of_the_sample_count_as_the_whole(monkeypatch):
    texts, labels = sentences(700, 4)
    found = [tox.telling_units(tox._in_parts(texts), np.array(labels))]
    monkeypatch.setattr(tox, "PART_TEXTS", 10_000)
    found.append(tox.telling_units(tox._in_parts(texts), np.array(labels)))
    assert len(found[0][0]) and len(found[0][1])
    assert all(np.array_equal(a, b) for a, b in zip(*found))


def test_machine_travels_without_its_table():
    machine, texts = tox.fit(*sentences(400, 1)), pa.array(sentences(50, 2)[0])
    sent = pickle.dumps(machine)
    assert len(sent) < 100_000
    assert np.array_equal(tox.scores(pickle.loads(sent), texts), tox.scores(machine, texts))
