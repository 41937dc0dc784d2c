import re
from collections import Counter

from conftest import SF_SMALL

from pacelake.llm.quality import fit_votes, op10_quality_rules, quality_filter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count, inside = Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            inside.update(range(i, i + 5))
    n = len(words)
    failed = n < 10 or 100 * len(inside) > 20 * n
    return n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside), failed


def check(rows, texts):
    for r in rows:
        want = brute(texts[r.doc_id] if not isinstance(texts, list) else None)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want, r.doc_id
        assert not (r.base_failed and r.kept)


def test_counts_equal_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = op10_quality_rules(spark, SF_SMALL).collect()
    assert len(rows) == len(texts)
    check(rows, texts)


def test_awkward_rows(awkward, empty):
    rows = quality_filter(awkward, ["doc_id"]).collect()
    assert len(rows) == awkward.count()
    check([r for r in rows if r.doc_id is not None], {r.doc_id: r.text for r in awkward.collect() if r.doc_id is not None})
    assert quality_filter(empty, ["doc_id"]).count() == 0


def test_agrees_with_labels(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/labels.parquet").collect()}
    rows = [r for r in op10_quality_rules(spark, SF_SMALL.replace("0.001", "0.01")).collect() if r.doc_id in labels and not r.base_failed]
    clean = [r.kept for r in rows if labels[r.doc_id] == 1]
    junk = [r.kept for r in rows if labels[r.doc_id] == 0]
    assert sum(clean) / len(clean) > 0.97
    assert sum(junk) / len(junk) < 0.3


def test_expectation_maximisation():
    assert fit_votes([]) == {}
    noisy = [((1, 1, 1), 900), ((1, 1, -1), 3), ((-1, -1, 1), 60), ((-1, 1, -1), 50), ((0, 0, 0), 5)]
    post = fit_votes(noisy)
    assert post[1, 1, 1] > 0.95 and post[-1, -1, 1] < 0.2 and post[-1, 1, -1] < 0.2
    assert all(0 <= p <= 1 for p in post.values())
