"""JSON event-spec validation (FIXTURES §4 cases)."""

import pytest

from pacelake.operators.quality import validate_event_specs, validate_json_specs

GOOD = '{"event_name": "Aurora Trail", "country": "nor", "distance_km": 100, "n_finishers": 80}'

CASES = [
    ("```json\n" + GOOD + "\n```", ("Aurora Trail (NOR)", "NOR", 100, 80, None)),
    ("no object here", (None, None, None, None, "no JSON object")),
    ('{"event_name": "x", "country": }', (None, None, None, None, "invalid JSON")),
    ('{"event_name": "x", "country": "NOR", "distance_km": 100}', (None, None, None, None, "missing keys")),
    ('{"event_name": "A, \\"B\\"\\n\\tC", "country": "NOR", "distance_km": 100, "n_finishers": 80}',
     ("A B C (NOR)", "NOR", 100, 80, None)),
    ('{"event_name": " , ", "country": "NOR", "distance_km": 100, "n_finishers": 80}',
     (None, None, None, None, "empty event_name")),
    ('{"event_name": "X", "country": "NO", "distance_km": 100, "n_finishers": 80}',
     (None, None, None, None, "bad country code")),
    ('{"event_name": "X", "country": "NOR", "distance_km": 49, "n_finishers": 80}',
     (None, None, None, None, "distance_km out of range")),
    ('{"event_name": "X", "country": "NOR", "distance_km": 50, "n_finishers": 30}', ("X (NOR)", "NOR", 50, 30, None)),
    ('{"event_name": "X", "country": "NOR", "distance_km": 250, "n_finishers": 300}',
     ("X (NOR)", "NOR", 250, 300, None)),
    ('{"event_name": "X", "country": "NOR", "distance_km": 251, "n_finishers": 80}',
     (None, None, None, None, "distance_km out of range")),
    ('{"event_name": "X", "country": "NOR", "distance_km": 100, "n_finishers": 29}',
     (None, None, None, None, "n_finishers out of range")),
    ('{"event_name": "X", "country": "NOR", "distance_km": 100, "n_finishers": 301}',
     (None, None, None, None, "n_finishers out of range")),
    ('{"event_name": "X", "country": "NOR", "distance_km": "100", "n_finishers": 100.9}',
     ("X (NOR)", "NOR", 100, 100, None)),
    ('{"event_name": "X", "country": "NOR", "distance_km": "far", "n_finishers": 80}',
     (None, None, None, None, "non-numeric distance_km")),
    ('{"event_name": "Polar Run (NOR)", "country": "NOR", "distance_km": 100, "n_finishers": 80}',
     ("Polar Run (NOR)", "NOR", 100, 80, None)),
    # of a repeated key the last value counts
    ('{"event_name": "X", "country": "NOR", "distance_km": 100, "n_finishers": 80, "n_finishers": 9}',
     (None, None, None, None, "n_finishers out of range")),
    ('{"event_name": "X", "distance_km": "far", "country": "NOR", "distance_km": 100, "n_finishers": 80, "event_name": "Y"}',
     ("Y (NOR)", "NOR", 100, 80, None)),
    ('{"event_name": "Polar Run (SWE)", "country": "NOR", "distance_km": 100, "n_finishers": 80}',
     ("Polar Run (NOR)", "NOR", 100, 80, None)),
]


@pytest.mark.parametrize("text,expected", CASES)
def test_event_specs(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    r = validate_event_specs(df, "t").first()
    assert (r.event_name, r.country, r.distance_km, r.n_finishers, r.reject_reason) == expected


def test_generic_specs(spark):
    df = spark.createDataFrame([(1, '{"k": 5}'), (2, '{"k": 50}'), (3, "{}"), (4, '{"k": "x"}')], "id int, p string")
    got = {r.id: (r.k, r.reject_reason) for r in validate_json_specs(df, "p", ["k"], {"k": (10, 90)}, keep=["id"]).collect()}
    assert got == {1: (5, "k out of range"), 2: (50, None), 3: (None, "missing keys"), 4: (None, "non-numeric k")}


def test_unicode_whitespace_in_name(spark):
    text = '{"event_name": "\\u00a0Fjord\\u2003 Run\\u00a0", "country": " nor\\u00a0", "distance_km": 60, "n_finishers": 40}'
    r = validate_event_specs(spark.createDataFrame([(text,)], "t string"), "t").first()
    assert (r.event_name, r.country, r.reject_reason) == ("Fjord Run (NOR)", "NOR", None)
