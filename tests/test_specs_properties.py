"""Property test: validate_event_specs agrees with a plain-Python reading of
the event-spec rules on generated spec texts."""

import json
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pacelake.operators.quality import validate_event_specs

_name = st.one_of(st.text(alphabet="AbcZ ,\"\t\n-()NORSWE\u00a0\u2003", min_size=0, max_size=14), st.none())
_country = st.sampled_from(["NOR", "nor", " swe ", "NO", "NORX", "n0r", "", "Fin", "\u00a0nor\u2003", None, [], True])
_num = st.one_of(
    st.integers(0, 400),
    st.floats(0, 400, allow_nan=False).map(lambda x: round(x, 1)),
    st.integers(0, 400).map(str),
    st.sampled_from(["far", "100d", "80f", "1e2", "1e12", 1e12, 10**12, " 90 ", "", None, [100], {"km": 100}, "+100.", "1_0_0", "nan", "0x64"]),
)
_spec = st.fixed_dictionaries(
    {},
    optional={"event_name": _name, "country": _country, "distance_km": _num, "n_finishers": _num},
)
_twice = st.lists(st.sampled_from([("n_finishers", 9), ("n_finishers", 70), ("distance_km", "far"), ("country", "SWE"), ("event_name", None)]), max_size=2)
_wrap = st.sampled_from(["{}", "```json\n{}\n```", "Here you go: {} thanks", "{}   ", "{} trailing }", '{} {"a": 1}', "{},{}", "['{}']", "none"])

# What a spec must satisfy, in the order in which reasons are given: (reason, rule on the parsed fields)
NUMBERS = {"distance_km": range(50, 251), "n_finishers": range(30, 301)}


def number(value):
    """The whole number a JSON value stands for, None if it is no number."""
    if isinstance(value, (list, dict, type(None))):
        return None
    try:
        found = float(value)
    except ValueError:
        return None
    return int(found) if found == found and abs(found) != float("inf") else None


def squeezed(text):
    return " ".join("".join(" " if ch in ',"\r\n\t' else ch for ch in text).split())


RULES = [
    ("missing keys", lambda s: set(s) >= {"event_name", "country", *NUMBERS}),
    ("empty event_name", lambda s: squeezed(str(s["event_name"])) != ""),
    ("bad country code", lambda s: re.fullmatch("[A-Z]{3}", str(s["country"]).strip().upper())),
    *[
        (reason, rule)
        for key, allowed in NUMBERS.items()
        for reason, rule in (
            (f"non-numeric {key}", lambda s, key=key: number(s[key]) is not None),
            (f"{key} out of range", lambda s, key=key, allowed=allowed: number(s[key]) in allowed),
        )
    ],
]


def expected(text):
    """((name, code, km, finishers) or None, first broken rule or None)."""
    first, last = text.find("{"), text.rfind("}")
    if first < 0 or last < first:
        return None, "no JSON object"
    try:
        spec = json.loads(text[first : last + 1])
    except ValueError:
        return None, "invalid JSON"
    for reason, rule in RULES:
        if not rule(spec):
            return None, reason
    code, name = str(spec["country"]).strip().upper(), squeezed(str(spec["event_name"]))
    if not name.endswith(f"({code})"):
        name = f"{re.sub(r'[ ]*[(][A-Z]{3}[)] *$', '', name).strip()} ({code})"
    return (name, code, *(number(spec[k]) for k in NUMBERS)), None


@settings(max_examples=8, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(_spec, _twice, _wrap), min_size=200, max_size=200))
def test_specs_match_python(spark, cases):
    # some keys come twice
    texts = [w.replace("{}", "{" + ", ".join(f"{json.dumps(k)}: {json.dumps(v)}" for k, v in (*s.items(), *more)) + "}") for s, more, w in cases]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = {r.i: r for r in validate_event_specs(df, "t", keep=["i"]).collect()}
    for i, t in enumerate(texts):
        r = rows[i]
        fields, reason = expected(t)
        assert r.reject_reason == reason, (t, r, reason)
        if fields:
            assert (r.event_name, r.country, r.distance_km, r.n_finishers) == fields, (t, r)
