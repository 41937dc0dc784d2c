import pytest
from conftest import SF_SMALL

from pacelake.llm.flatfiles import END_ID, count_tokens, op8_token_counts, write_flat
from pacelake.llm.tokens import default_tokenizer
from pacelake.session import scratch_path


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(default_tokenizer())
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def lengths(rows):
    return [r.n_tokens for r in sorted(rows, key=lambda r: (r.file, r.doc))]


@pytest.mark.parametrize("block", [2, 6, 1000, 1 << 20])
def test_blocks_are_stitched(spark, awkward, plain, block):
    path = scratch_path(spark, "flat-test")
    short = awkward.where("text is null or length(text) < 2000")
    write_flat(short.coalesce(1), path)
    rows = count_tokens(spark, path, block=block).collect()
    assert lengths(rows) == [len(plain(r.text)) + 1 for r in short.coalesce(1).collect()]
    rows.sort(key=lambda r: r.start)
    assert rows[0].start == 0 and all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:])) and all(r.ended for r in rows)


def test_query_contract(spark, plain):
    want = sorted(len(plain(r.text)) + 1 for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect())
    assert sorted(r.n_tokens for r in op8_token_counts(spark, SF_SMALL).collect()) == want


def test_files_that_others_wrote(spark, tmp_path):
    def put(name, ids, width=2):
        (tmp_path / name).write_bytes(b"".join(i.to_bytes(width, "little") for i in ids))

    put("a", [5, 6, END_ID, END_ID, 7])  # the last document is not closed
    put("b", [])
    put("c", [END_ID])
    put("d", [8, 9])
    got = sorted(tuple(r) for r in count_tokens(spark, str(tmp_path), block=4).collect())
    assert got == [(0, 0, 0, 3, True), (0, 1, 3, 1, True), (0, 2, 4, 1, False), (1, 0, 5, 1, True), (2, 0, 6, 2, False)]


def test_empty_table(spark, empty):
    path = scratch_path(spark, "flat-test")
    write_flat(empty, path)
    assert count_tokens(spark, path).count() == 0
