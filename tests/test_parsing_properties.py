"""Property test: the Spark column helpers agree with a plain-Python reading
of the same rules on generated distance and performance texts."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pacelake.functions import parsing as P

_num = st.one_of(
    st.integers(0, 999).map(str),
    st.tuples(st.integers(0, 999), st.integers(0, 999)).map(lambda t: f"{t[0]}.{t[1]}"),
    st.just(".5"),
)
_unit = st.sampled_from(["km", "KM", "mi", "h", "H", "d", "km/3Etappen", "", " ", "kmh", "Km "])
_dist = st.tuples(_num, _unit).map(lambda t: t[0] + t[1])
_hms = st.tuples(st.integers(0, 99), st.integers(0, 99), st.integers(0, 99)).map(
    lambda t: f"{t[0]}:{t[1]:02d}:{t[2]:02d}"
)
_perf = st.one_of(
    st.tuples(st.sampled_from(["", "1 ", "2d ", "12 "]), _hms, st.sampled_from([" h", "h", " H", " h ", "", " km"])).map(
        lambda t: "".join(t)
    ),
    st.tuples(st.sampled_from(["", "-", " "]), _num, st.sampled_from([" km", "km", " KM", " kmh", " m", ",5 km"])).map(
        lambda t: "".join(t)
    ),
    st.text(alphabet="0123456789:. hkmHK,-dD\t", max_size=14),
)


def py_first_number(s):
    m = re.search(r"([0-9]*\.?[0-9]+)", s)
    return float(m.group(1)) if m else None


def py_unit(s):
    m = re.search(r"([a-zA-Z]+)$", s)
    return m.group(1).lower() if m else ""


def py_perf(s):
    t = s.strip(" ")
    if re.search(r"(?i)\s*h\s*$", t):
        unit = "h"
    elif re.search(r"(?i)km\s*$", t):
        unit = "km"
    else:
        return None, None, None
    if unit == "km":
        return unit, None, py_first_number(t)
    m = re.search(r"(\d+:\d+:\d+)\s*h", t)
    if not m:
        return unit, None, None
    d = re.search(r"^(\d+)\s+\d+:\d+:\d+", t)
    h, mi, se = (float(x) for x in m.group(1).split(":"))
    return unit, (float(d.group(1)) if d else 0.0) * 86400 + h * 3600 + mi * 60 + se, None


@settings(max_examples=5, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(_dist, _perf), min_size=300, max_size=300))
def test_helpers_match_python(spark, pairs):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(pairs, "d string, p string")
    perf = F.trim("p")
    rows = df.select(
        "d",
        "p",
        P.first_number("d").alias("num"),
        P.trailing_unit("d").alias("unit"),
        P.performance_unit(perf).alias("pu"),
        F.when(P.performance_unit(perf) == "h", P.hms_seconds(perf)).alias("secs"),
        F.when(P.performance_unit(perf) == "km", P.first_number(perf)).alias("km"),
        P.has_hms(perf).alias("has_hms"),
        P.has_number(perf).alias("has_num"),
    ).collect()
    for r in rows:
        assert r.num == py_first_number(r.d), r
        assert r.unit == py_unit(r.d), r
        unit, secs, km = py_perf(r.p)
        assert (r.pu, r.secs, r.km) == (unit, secs, km), r
        # the cheap validity tests are exact stand-ins for "parse succeeded"
        if unit == "h":
            assert r.has_hms == (secs is not None), r
        if unit == "km":
            assert r.has_num == (km is not None), r
