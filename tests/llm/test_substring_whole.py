import random

import pytest

from pacelake.llm.substring import repeated_passages


def fresh(rng, n):
    return [f"w{rng.randrange(10**9)}" for _ in range(n)]


def lost(make, trials, passage_of, earlier=lambda p, k, rng: []):
    """Trials of which the last document's changed passage is not found."""
    rng, rows = random.Random(5), []
    for k in range(trials):
        base = k * 10
        p, q = passage_of(rng)
        for i, part in enumerate(earlier(p, k, rng)):
            rows.append((base + i, fresh(rng, 30) + part + fresh(rng, 30)))
        rows.append((base + 8, fresh(rng, 40) + p + fresh(rng, 40)))
        rows.append((base + 9, fresh(rng, 25) + q + fresh(rng, 55)))
    found = repeated_passages(make([(i, " ".join(t), None, None, 1) for i, t in rows])).collect()
    good = {r.doc_id for r in found if r.doc_id % 10 == 9 and r.first_doc_id // 10 == r.doc_id // 10 and r.n_words >= 50}
    assert all(r.doc_id % 10 in (8, 9) or r.n_words >= 50 for r in found)
    return [k for k in range(trials) if k * 10 + 9 not in good]


def changed(n, places, how):
    def passage_of(rng):
        p = fresh(rng, n)
        q = list(p)
        for x in sorted(places, reverse=True):
            q[x : x + (how != "insert")] = fresh(rng, 1) if how != "delete" else []
        return p, q

    return passage_of


@pytest.mark.parametrize(("n", "places"), [(60, [30]), (60, [20]), (80, [40]), (100, [33, 66]), (100, [25, 50, 75])])
def test_replaced_words(make, n, places):
    assert lost(make, 60, changed(n, places, "replace")) == []


@pytest.mark.parametrize("how", ["insert", "delete"])
def test_inserted_and_deleted_words(make, how):
    assert lost(make, 60, changed(60, [30], how)) == []
    assert lost(make, 30, changed(100, [33, 66], how)) == []


def test_earlier_documents_with_a_part(make):
    same = lambda rng: (lambda p: (p, p))(fresh(rng, 60))
    assert lost(make, 60, same, lambda p, k, rng: [p[:40]]) == []
    assert lost(make, 60, same, lambda p, k, rng: [p[:48], p[-48:]]) == []
    assert lost(make, 60, same, lambda p, k, rng: [p[:48] + fresh(rng, 9) + p[12:]]) == []


def test_near_passage_behind_a_part(make):
    assert lost(make, 30, changed(60, [30], "replace"), lambda p, k, rng: [p[:28], p[-28:]]) == []
