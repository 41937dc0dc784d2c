"""Incremental maintenance equals a full rebuild, and rewrites few buckets."""

import math

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from pacelake.functions.clean import clean_results
from pacelake.plans import model, views
from pacelake.plans.lake import AS_OF_YEAR, GOLD_VIEWS
from pacelake.sources.feed import race_feed
from pacelake.streaming import incremental as inc
from pacelake.streaming.replay import incremental_lake

BUCKETS = 32
ROUNDED = ("vw_distance_gender_split", "vw_time_yearly_progression")


def rebuilt(silver):
    """All tables out of all silver rows. Means that lie on the edge of their
    rounding may come out on either side: they are compared to a unit of it."""
    event, athlete, date = model.dim_event(silver), model.dim_athlete(silver), model.dim_date(silver)
    enriched = views.results_enriched(model.fct_results(silver), event, athlete, date)
    return {"dim_event": event, "dim_athlete": athlete, "dim_date": date, "vw_results_enriched": enriched, **{v: views.serving_view(enriched, v) for v in GOLD_VIEWS}}


def rows_of(df):
    cell = lambda x: (x is not None, float(f"{x:.9g}") if isinstance(x, float) else str(x))
    return sorted(tuple(cell(r[c]) for c in sorted(df.columns)) for r in df.collect())


def same(lake, silver):
    for name, df in rebuilt(silver).items():
        got, want = rows_of(lake.table(name)), rows_of(df)
        assert len(got) == len(want), name
        for a, b in zip(got, want):
            for (x_there, x), (y_there, y) in zip(a, b):
                assert x_there == y_there and (x == y or isinstance(x, float) and math.isclose(x, y, rel_tol=1e-7, abs_tol=0.00101 if name in ROUNDED else 0)), (name, a, b)


def distinct(df, name):
    return {r[0]: r[1] for r in df.where(F.col(name).isNotNull()).groupBy("event_year").agg(F.count_distinct(name)).collect()}


@pytest.fixture(scope="module")
def drops(spark):
    """A history, 80 rows of known athletes at known events, and 80 rows that
    change athletes' latest year and country, one event's attributes, and bring
    a new athlete and one without id."""
    silver = clean_results(race_feed(spark, SF_SMALL), as_of_year=AS_OF_YEAR)
    known = silver.where("event_type = 'distance'").orderBy("result_id").limit(80)
    plain = known.withColumns({"result_id": F.concat(F.lit("again-"), "result_id"), "year_of_event": F.lit(1900)})
    later = known.withColumns({"result_id": F.concat(F.lit("later-"), "result_id"), "year_of_event": F.lit(2020), "athlete_country": F.lit("XYZ")})
    first = silver.orderBy("event_id").first()
    source = F.when(F.col("result_id") == F.lit("later-new"), F.lit(10**9))
    odd = known.limit(2).withColumns({"result_id": F.lit("later-new"), "event_id": F.lit(first.event_id), "event_name": F.lit(first.event_name), "event_type": F.lit("time"), "event_distance_length": F.lit("99h"), "event_duration_hours": F.lit(99.0)})
    odd = odd.withColumn("athlete_source_id", source).withColumn("athlete_id", F.sha2(F.col("athlete_source_id").cast("string"), 256))
    nobody = known.limit(1).withColumns({"result_id": F.lit("nobody"), "athlete_source_id": F.lit(None).cast("long"), "athlete_id": F.sha2(F.lit(""), 256), "year_of_event": F.lit(None).cast("int"), "event_start_date": F.lit(None).cast("date")})
    parts = [silver, plain, later.limit(77).unionByName(odd).unionByName(nobody)]
    return [spark.createDataFrame(p.collect(), silver.schema) for p in parts]


def test_three_drops_equal_a_rebuild(spark, drops, tmp_path):
    root, so_far = str(tmp_path / "lake"), None
    touched = []
    for batch, rows in enumerate(drops):
        before = inc.State(spark, root, BUCKETS)
        state = inc.fold(spark, root, rows, batch, BUCKETS)
        so_far = rows if so_far is None else so_far.unionByName(rows)
        lake = inc.open_state(spark, root)
        same(lake, so_far)
        touched.append(state.rewritten)
        # what a batch does not touch stays the same files
        for table in ("athletes", "events", "enriched"):
            kept = sum(state.tables[table].get(b) == held for b, held in before.tables.get(table, {}).items())
            assert kept >= len(before.tables.get(table, {})) - state.rewritten.get(table, state.rewritten["enriched_again"] + state.rewritten["enriched_added"])
    assert touched[0]["enriched_again"] == 0
    # 80 rows of known athletes and events rewrite no older rows at all
    assert touched[1]["enriched_again"] == 0 and touched[1]["athletes"] <= 80
    assert touched[2]["enriched_again"] > 0
    years = {r.event_year: r.n for r in inc.distinct_from_bitmaps(lake.table("year_countries"), F.col("event_year"), "event_year", "n", False).collect()}
    enriched = lake.table("vw_results_enriched")
    assert years == distinct(enriched, "athlete_country")
    facts = so_far.select(F.year("event_start_date").alias("event_year"), "athlete_id")
    people = {r.event_year: r.n for r in inc.distinct_from_bitmaps(lake.table("year_athletes"), F.col("event_year"), "event_year", "n", True).collect()}
    assert people == distinct(facts, "athlete_id")


def test_a_batch_is_folded_once(spark, drops, tmp_path):
    root = str(tmp_path / "lake")
    inc.fold(spark, root, drops[1], 0, BUCKETS)
    first = inc.State(spark, root)
    inc.fold(spark, root, drops[1], 0, BUCKETS)
    assert inc.State(spark, root).tables == first.tables
    assert inc.open_state(spark, root).table("fct_results").count() == 80


def test_pieces_are_merged(spark, drops, tmp_path, monkeypatch):
    monkeypatch.setattr(inc, "MAX_PIECES", 2)
    root, so_far, held = str(tmp_path / "lake"), None, []
    for batch in range(5):
        rows = drops[1].withColumn("result_id", F.concat(F.lit(f"{batch}-"), "result_id"))
        state = inc.fold(spark, root, rows, batch, 4)
        so_far = rows if so_far is None else so_far.unionByName(rows)
        held.append({v.split("/")[0] for v in state.versions()})
        assert all(len(x) <= 3 for t in ("facts", "enriched", "groups_distance") for x in state.tables[t].values())
    same(inc.open_state(spark, root), so_far)
    # only what the last two states refer to is left
    assert {p.name for p in (tmp_path / "lake" / "state").iterdir()} == held[-1] | held[-2]


def test_streamed_drops(spark):
    """The registered replay: landed files, streams and folding."""
    lake = incremental_lake(spark, SF_SMALL)
    same(lake, clean_results(race_feed(spark, SF_SMALL), as_of_year=AS_OF_YEAR))


def test_empty_batch(spark, drops, tmp_path):
    root = str(tmp_path / "lake")
    inc.fold(spark, root, drops[0].where("false"), 0, 4)
    lake = inc.open_state(spark, root)
    assert all(lake.table(x).count() == 0 for x in ("dim_event", "dim_athlete", "vw_results_enriched", "year_athletes", *GOLD_VIEWS))
