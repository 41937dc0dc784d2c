"""Gold model semantics on hand-made rows."""

from helpers import bronze
from pacelake.functions.clean import clean_results
from pacelake.plans import model
from pacelake.plans.countries import COUNTRIES


def _silver(spark, rows):
    return clean_results(bronze(spark, rows), as_of_year=2026)


def test_dim_event_mixed_grain(spark):
    s = _silver(
        spark,
        [
            dict(event_name="Mix", event_distance_length="50km", athlete_performance="5:00:00 h"),
            dict(event_name="Mix", event_distance_length="100km", athlete_performance="9:00:00 h"),
            dict(event_name="Mix", event_distance_length="24h", athlete_performance="200 km"),
        ],
    )
    rows = model.dim_event(s).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.event_type == "time"
    assert r.event_distance_length == "50km"
    assert r.event_distance_km == 100.0 and r.event_duration_hours == 24.0


def test_dim_athlete_latest_and_ties(spark):
    s = _silver(
        spark,
        [
            dict(athlete_source_id=1, year_of_event=2017, athlete_country="FRA", athlete_performance="5:00:00 h"),
            dict(athlete_source_id=1, year_of_event=2019, athlete_country="GER", event_dates="01.05.2019",
                 athlete_performance="5:00:01 h"),
            dict(athlete_source_id=1, year_of_event=2019, athlete_country="ITA", event_dates="02.05.2019",
                 athlete_performance="5:00:02 h"),
            dict(athlete_source_id=2, year_of_event=2019, athlete_country=None, athlete_performance="5:00:03 h"),
            dict(athlete_source_id=2, year_of_event=2015, athlete_country="ESP", athlete_performance="5:00:04 h"),
            dict(athlete_source_id=3, year_of_event=None, athlete_country="USA", athlete_performance="5:00:05 h"),
        ],
    )
    d = {r.athlete_source_id: r for r in model.dim_athlete(s).collect()}
    assert d[1].athlete_country == "ITA"  # same year: later start date wins
    assert d[2].athlete_country is None  # latest value is NULL -> NULL (MAX_BY)
    assert d[3].athlete_country is None  # no dated row -> NULL attributes
    assert len(d) == 3


def test_duplicates_kept_and_date_dim(spark):
    s = _silver(spark, [{}, {}])
    f = model.fct_results(s).collect()
    assert len(f) == 2 and f[0].result_id == f[1].result_id
    assert f[0].date_id == 20180106
    dd = model.dim_date(s).collect()
    assert len(dd) == 1
    r = dd[0]
    assert (r.year, r.quarter, r.month, r.day) == (2018, 1, 1, 6)
    assert r.month_name == "January" and r.day_name == "Saturday"
    assert r.day_of_week == 7 and r.is_weekend is True


def test_country_lookup_fixed_values():
    rows = COUNTRIES
    assert len(rows) == 174
    codes = [r[0] for r in rows]
    assert len(set(codes)) == 174
    named = {r[0]: r[1] for r in rows}
    assert named["SIN"] == named["SGP"] == "Singapore"
    assert named["BRN"] == "Bahrain" and named["BRU"] == "Brunei"
    assert rows[-1][2] == "" and rows[-1][0] == "XXX"
