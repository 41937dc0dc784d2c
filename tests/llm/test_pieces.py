import tracemalloc
from collections import Counter

import pyarrow as pa
import pytest
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from pacelake.llm.pieces import LONG, PieceModel, decoded, default_model, encode_batch, op3_sentencepiece, sampled
from pacelake.llm.text import text_keys

MODEL = PieceModel(default_model())
TEXT = st.text(alphabet="ab the\n\t▁éß日😀<0x41>\u0000 ", max_size=60)


def pieces(ids, a, b):
    return tuple(MODEL.pieces[i] for i in ids[a:b])


@settings(max_examples=80, deadline=None, derandomize=True)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=6))
def test_round_trip(texts):
    ids, offsets = encode_batch(MODEL, texts, text_keys(range(len(texts))))
    assert [MODEL.decode(ids[a:b]) for a, b in zip(offsets[:-1], offsets[1:])] == [t or "" for t in texts]


def test_draws_follow_the_posterior():
    at, weight = {p: i for i, p in enumerate(MODEL.pieces)}, dict(zip(MODEL.ids.tolist(), MODEL.weight.tolist()))

    def paths(rest):
        if not rest:
            yield (), 1.0
        for n in range(1, len(rest) + 1):
            if at.get(rest[:n]) in weight:
                for tail, w in paths(rest[n:]):
                    yield (rest[:n], *tail), w * weight[at[rest[:n]]]

    want = dict(paths("▁there"))
    total, n = sum(want.values()), 6000
    ids, offsets = encode_batch(MODEL, ["there"] * n, text_keys(range(n)))
    got = Counter(pieces(ids, a, b) for a, b in zip(offsets[:-1], offsets[1:]))
    assert set(got) <= set(want)
    for path, w in want.items():
        assert got[path] / n == pytest.approx(w / total, abs=0.025)


def test_seeds_are_the_rows_own():
    texts = ["the river runs down to the sea", "another text", "the river runs down to the sea"]
    ids, o = encode_batch(MODEL, texts, text_keys([5, 6, 5]))
    alone, _ = encode_batch(MODEL, texts[:1], text_keys([5]))
    assert list(ids[: o[1]]) == list(ids[o[2] :]) == list(alone)
    many = {tuple(encode_batch(MODEL, texts[:1], text_keys([i]))[0]) for i in range(30)}
    assert len(many) > 20


def test_query_contract(spark):
    rows = op3_sentencepiece(spark, SF_SMALL).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    assert len(rows) == len(docs) and all(r.lossless and r.n_tokens == len(r.ids) for r in rows)
    back = decoded(spark.createDataFrame(rows)).collect()
    assert {r.doc_id: r.text for r in back} == docs
    other = {r.doc_id: r.ids for r in sampled(spark.read.parquet(f"{SF_SMALL}/documents.parquet").repartition(7)).collect()}
    assert all(other[r.doc_id] == r.ids for r in rows)


def test_awkward_rows(awkward, empty):
    rows = sampled(awkward).collect()
    assert len(rows) == awkward.count() and all(r.lossless for r in rows)
    assert all(r.n_tokens == 0 for r in rows if r.doc_id in (0, 1)) and sampled(empty).count() == 0


def test_memory_of_a_batch():
    """A batch of texts takes a bounded multiple of its bytes."""
    texts = [" ".join(f"word{(i * 7919 + k * k) % 9973} the" for k in range(300)) for i in range(400)]
    size = sum(map(len, texts))
    keys = text_keys(range(len(texts)))
    col = pa.array(texts)
    encode_batch(MODEL, texts, keys)
    tracemalloc.start()
    encode_batch(MODEL, col, keys)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 * size


def test_long_words_and_marks():
    """Words without spaces are cut by characters, not by bytes; a mark in the
    text itself is no space."""
    texts = ["日本語" * 100, "é" * LONG, "é" * (LONG - 1), "é" * (LONG - 1) + " x", "▁ ▁▁ a▁b", "😀" * 200 + "  " + "ab" * 200]
    ids, offsets = encode_batch(MODEL, texts, text_keys(range(len(texts))))
    assert [MODEL.decode(ids[a:b]) for a, b in zip(offsets[:-1], offsets[1:])] == texts
    for k, t in enumerate(texts):
        alone, _ = encode_batch(MODEL, [t], text_keys([k]))
        assert list(alone) == list(ids[offsets[k] : offsets[k + 1]])
