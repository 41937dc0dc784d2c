import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_MID

from pacelake.llm import language as lang


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    table_mask, recur_mask = lang._masks(3)
    net = lang.Network(["a", "b"], (rng.normal(0, 0.5, (2, 256, 12)) * table_mask[:, None]), rng.normal(0, 0.5, (6, 12)) * recur_mask, rng.normal(0, 0.5, (6, 2)), np.zeros(2))
    for name in ("table", "recur", "out", "bias"):
        setattr(net, name, getattr(net, name).astype(np.float32))
    window, label = rng.integers(97, 100, (7, 4)), np.array([0, 1, 1, 0])
    weight = np.ones((7, 4), np.float32)

    def loss():
        states, _ = lang._steps(net, window, False)
        p = lang._softmax(states @ net.out + net.bias)
        return -np.log(p[:, np.arange(4), label]).mean()

    grads = lang._gradients(net, window, label, weight)
    for array, grad, at in ((net.recur, grads[0 + 1], (0, 0)), (net.recur, grads[1], (1, 7)), (net.out, grads[2], (4, 1)), (net.table, grads[0], (0, 98, 1)), (net.table, grads[0], (1, 97, 10)), (net.bias, grads[3], (1,))):
        if array is net.recur and not recur_mask[at] or array is net.table and not table_mask[at[0], at[2]]:
            continue
        old, step = array[at], 1e-2
        array[at] = old + step
        up = loss()
        array[at] = old - step
        down = loss()
        array[at] = old
        assert (up - down) / (2 * step) == pytest.approx(grad[at], abs=2e-3)


def test_held_out_accuracy(spark):
    rows = lang.op1_language_id(spark, SF_MID).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    assert len(rows) == len(docs) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r.lang_pred == docs[r.doc_id].lang for r in rows if r.held_out]
    assert sum(held) / len(held) > 0.97


def test_awkward_rows(awkward, empty):
    net = lang.train(["the cat and the dog " * 9, "der Hund und die Katze " * 9], ["en", "de"], steps=60)
    rows = lang.predictions(awkward, net).collect()
    assert len(rows) == awkward.count()
    words = {r.doc_id: r.text for r in awkward.collect()}
    for r in rows:
        if r.doc_id is not None:
            assert (r.lang_pred == "und") == (not any(c.isalpha() for c in words[r.doc_id] or ""))
    assert lang.predictions(empty, net).count() == 0
    assert lang.training_sample(empty) == ([], [])
    again = lang.predictions(awkward, net).collect()
    assert sorted(rows, key=str) == sorted(again, key=str)


def test_no_or_one_language():
    texts = pa.array(["abc", "", None, "12"])
    assert lang.predict(lang.train([], []), texts)[0] == ["und"] * 4
    got, score = lang.predict(lang.train(["abc"], ["xx"]), texts)
    assert got == ["xx", "und", "und", "und"] and list(score) == [1, 0, 0, 0]
    assert lang.predict(lang.train(["abc", "def"], ["x", "y"], steps=3), pa.array(["日本"]))[0] != ["und"]


def test_every_label_is_learned_from(spark, make, monkeypatch):
    """No cap on the number of labels; the sample shrinks with them, and copies
    of a row count once."""
    monkeypatch.setattr(lang, "SAMPLE", 600)
    rows = [(i, f"text of {i} in language {i % 150}", f"l{i % 150:03}", None, 1) for i in range(3000)]
    texts, labels = lang.training_sample(make(rows + rows[:150] * 20))
    assert len(set(labels)) > 130 and len(labels) < 1500 and len(set(texts)) == len(texts)
    few, _ = lang.training_sample(make(rows[:30] * 3))
    assert sorted(few) == sorted({t for _, t, *_ in rows[:30]})
