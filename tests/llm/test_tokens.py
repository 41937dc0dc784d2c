import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from pacelake.llm import tokens
from pacelake.llm.common import BATCH_BYTES
from pacelake.llm.tokens import PieceEncoder, default_tokenizer, op4_token_output, read_tokens, token_stream, write_tokens
from pacelake.session import scratch_path
from pacelake.sources import fs

ENCODER = PieceEncoder(default_tokenizer())
PLAIN = ENCODER.tokenizer


def ids_of(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


_text = st.text(alphabet="abZé ñ,.'!\n\t0 9#_- 日<|endoftext|>s", max_size=40)


@settings(max_examples=60, deadline=None, derandomize=True)
@given(st.lists(st.one_of(st.none(), _text), max_size=8))
def test_pieces_equal_whole_texts(texts):
    ids, offsets = ENCODER.encode(pa.array(texts, pa.string()))
    for t, a, b in zip(texts, offsets[:-1], offsets[1:]):
        assert list(ids[a:b]) == ids_of(t), t


def check(rows, docs, exact=True):
    start = 0
    for r, (i, text) in zip(rows, docs):
        ids = [*ids_of(text), 2]
        assert r.doc_id == i and r.n_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        assert r.start == start
        start += len(ids)


def test_query_contract(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect())
    check(op4_token_output(spark, SF_SMALL).orderBy("doc_id").collect(), docs)


def test_awkward_rows(spark, awkward, empty):
    path = scratch_path(spark, "tokens-test")
    write_tokens(awkward, path, delta=True)
    rows = token_stream(spark, path).orderBy("start").collect()
    assert len(rows) == awkward.count() and [r.doc_id for r in rows][:2] == [None, None]
    assert sum(r.n_tokens for r in rows) == sum(len(ids_of(r.text)) + 1 for r in awkward.collect())
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:]))
    path = scratch_path(spark, "tokens-test")
    write_tokens(empty, path)
    assert token_stream(spark, path).count() == 0


def test_selective_reads(spark, small):
    path = scratch_path(spark, "tokens-test")
    write_tokens(small, path)
    plan = read_tokens(spark, path).where("doc_id = 7").select("n_tokens")._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan.split("ReadSchema:")[1] and "EqualTo(doc_id,7)" in plan
    text = small.where("doc_id = 7").first().text
    assert read_tokens(spark, path).where("doc_id = 7").first().ids == [*ids_of(text), 2]


def test_starts_under_equal_and_null_ids(spark, make):
    """At every start the files, one after the other, hold the ids that the
    row's checksum says."""
    texts = ["b b b b b", "a", "longer text of the same id " * 9, "zz", None, "x y", "q" * 50, "c"]
    ids = [1, 1, 1, 1, 2, None, None, None]
    path = scratch_path(spark, "tokens-test")
    write_tokens(make([(i, t, None, None, 1) for i, t in zip(ids * 5, texts * 5)]), path)
    files = sorted(p for p in fs.list_files(spark, path) if p.endswith(".parquet"))
    flat = np.concatenate([x for f in files for r in pq.read_table(f"{path.removeprefix('file:')}/{f}").column("ids").to_pylist() for x in [np.array(r, "<u4")]])
    rows = token_stream(spark, path).collect()
    assert len(rows) == 40 and sorted(r.start for r in rows) == np.cumsum([0, *(r.n_tokens for r in sorted(rows, key=lambda r: r.start))])[:-1].tolist()
    for r in rows:
        assert zlib.crc32(flat[r.start : r.start + r.n_tokens].tobytes()) == r.ids_crc32


def test_known_pieces_are_small():
    """A worker keeps up to a million pieces: they take few bytes each."""
    encoder = PieceEncoder(default_tokenizer())
    words = pa.array([" ".join(f"{i:x}q" for i in range(60_000))])
    encoder.encode(words)  # what is made once
    encoder.recent, encoder.older = type(encoder.recent)(), type(encoder.older)()
    tracemalloc.start()
    want = encoder.encode(words)
    held = tracemalloc.get_traced_memory()[0] - sum(x.nbytes for x in want)
    tracemalloc.stop()
    assert len(encoder.recent) >= 60_000 and held < 120 * len(encoder.recent)
    assert all(np.array_equal(a, b) for a, b in zip(want, encoder.encode(words)))


def test_forgotten_pieces(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE", 60)
    encoder = PieceEncoder(default_tokenizer())
    for k in range(30):
        texts = [f"all {k % 7} of it, word{i * k % 23} don't {'z' * i}" for i in range(k)]
        ids, offsets = encoder.encode(pa.array(texts, pa.string()))
        assert [list(ids[a:b]) for a, b in zip(offsets[:-1], offsets[1:])] == [ids_of(t) for t in texts]


def test_pieces_of_one_hash(monkeypatch):
    """Pieces whose hashes are equal keep their own ids."""
    monkeypatch.setattr(tokens.Texts, "span_hashes", lambda self, start, end, lower: (start % 3).astype(np.uint64) << np.uint64(62))
    encoder = PieceEncoder(default_tokenizer())
    for text in ["one two three of the of one", "two of ten", "one two three"] * 2:
        assert list(encoder.encode(pa.array([text]))[0]) == ids_of(text)


def test_batches_are_bounded(make):
    """Workers get long texts a few at a time."""

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    docs = make([f"{i} " * 2000 for i in range(800)]).coalesce(1)
    assert max(r.n for r in docs.mapInArrow(sizes, "n long").collect()) < 1.1 * BATCH_BYTES
