import corpus_pipeline as cp
import pytest
from conftest import AWKWARD, SF_SMALL, rows_of

from pacelake.llm.common import documents, written


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = documents(spark, SF_SMALL), []
    for name, stage in cp.STAGES:
        docs = written(stage(spark, docs, SF_SMALL), f"test-{name}")
        out.append((name, docs))
    return out


def test_stages_in_order(spark, stages):
    assert [n for n, _ in stages] == ["toxicity", "jaccard_join", "substring_dedup", "mixing", "sentencepiece"]
    columns = documents(spark, SF_SMALL).columns
    assert all(df.columns == columns for _, df in stages[:-1])
    assert cp.ORACLE_SQL is None


def test_decisions_take_effect(spark, stages):
    from test_jaccard import brute
    from test_substring import exact_cover

    from pacelake.llm import toxicity

    frames = dict(stages)
    first = documents(spark, SF_SMALL)
    scores = {r.doc_id: r.score for r in toxicity.scored(first, toxicity.trained(spark, first, SF_SMALL), ["doc_id"]).collect()}
    kept = {r.doc_id: r.text for r in frames["toxicity"].collect()}
    assert set(kept) == {d for d, s in scores.items() if s < 0.5}
    left = {r.doc_id: r.text for r in frames["jaccard_join"].collect()}
    assert left == {c: kept[c] for _, _, c in brute(sorted(kept.items()), 5, 80)}
    clear = {r.doc_id: r.text for r in frames["substring_dedup"].collect()}
    assert set(clear) <= set(left) and not exact_cover(clear.items())
    touched = exact_cover(left.items())
    assert all(clear[d] == t for d, t in left.items() if d in clear and len(clear[d]) == len(t))
    assert all(len(clear.get(d, "")) < len(left[d]) for d in touched)
    mixed = frames["mixing"].collect()
    assert {r.doc_id for r in mixed} <= set(clear) and all(r.text == clear[r.doc_id] for r in mixed)


def test_run_equals_the_stages(spark, stages):
    got = sorted((r.doc_id, tuple(r.ids)) for r in cp.run(spark, SF_SMALL).collect())
    assert got == sorted((r.doc_id, tuple(r.ids)) for r in stages[-1][1].collect())
    assert stages[-1][1].where("not lossless").count() == 0


def test_empty_documents(spark, empty):
    docs = empty
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, SF_SMALL)
    assert docs.count() == 0


def test_awkward_documents(spark, make):
    """Null, empty, very long and repeated rows through all stages: nothing
    breaks, what has words stays, and copies of a text go but for one."""
    rows = rows_of(AWKWARD) + rows_of(AWKWARD) + rows_of(AWKWARD[-3:], start=50) + [(None, None, None, None, None), (None, "a row without an id", None, None, 19)]
    docs = first = make(rows)
    for name, stage in cp.STAGES:
        docs = written(stage(spark, docs, SF_SMALL), f"awkward-{name}")
        if name != "sentencepiece":
            assert docs.columns == first.columns
        if name == "substring_dedup":
            left = [r.text for r in docs.collect()]
            assert all(left.count(t) == 1 for t in AWKWARD if t and len(t.split()) > 4) and "a row without an id" in left
    assert docs.count() > 0 and docs.where("not lossless").count() == 0
