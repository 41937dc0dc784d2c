"""Streaming refresh: incremental, idempotent, and equal to the batch path."""

import glob
import os

from conftest import SF_SMALL
from pyspark.sql import functions as F

from pacelake.operators.quality import compare_results
from pacelake.plans.lake import lazy_lake
from pacelake.schema import SILVER_COLUMNS
from pacelake.sources.feed import race_feed
from pacelake.sources.results_csv import read_results, read_results_text
from pacelake.sources.sinks import drop_batch
from pacelake.streaming import refresh


def test_incremental_refresh_equals_batch(spark, tmp_dir):
    feed = race_feed(spark, SF_SMALL)
    landing, lake_dir = f"{tmp_dir}/landing", f"{tmp_dir}/lake"
    drop_batch(feed.filter(F.col("year_of_event") <= 1997), f"{landing}/historical", "a", single_file=False)
    lake = refresh(spark, landing, lake_dir, as_of_year=2026)
    n_a = lake.table("bronze").count()
    assert 0 < n_a < 6000

    drop_batch(feed.filter(F.col("year_of_event") > 1997), f"{landing}/simulated", "b")
    lake = refresh(spark, landing, lake_dir, as_of_year=2026)
    assert lake.table("bronze").count() == 6000

    # nothing new -> nothing added
    lake = refresh(spark, landing, lake_dir, as_of_year=2026)
    assert lake.table("bronze").count() == 6000
    # two refreshes with new files published two versions; the third found
    # nothing new and rebuilt nothing
    assert len(glob.glob(f"{lake_dir}/mv/v_*")) == 2
    landed = glob.glob(f"{landing}/**/*.csv", recursive=True)
    assert lake.table("bronze").select("source_file").distinct().count() == len(landed)

    batch = lazy_lake(spark, SF_SMALL, as_of_year=2026)
    streamed = lake.table("silver").select(*SILVER_COLUMNS)
    assert compare_results(streamed, batch.table("silver")).count() == 0
    assert compare_results(
        lake.table("vw_results_enriched"), batch.table("vw_results_enriched")
    ).count() == 0
    assert lake.table("fct_results").count() == streamed.count()


def test_csv_positional_and_header_check(spark, tmp_dir):
    feed = race_feed(spark, SF_SMALL).limit(5)
    out = drop_batch(feed, tmp_dir, "drop")
    rows = read_results(spark, out).collect()
    assert len(rows) == 5 and rows[0].source_file.endswith(".csv")
    raw = read_results_text(spark, out)
    assert raw.columns[0] == "Year of event" and dict(raw.dtypes)["Year of event"] == "string"

    # a file with other columns is read positionally (wrongly) unless checked
    spark.createDataFrame([(5, "x")], "a int, b string").coalesce(1).write.option("header", True).csv(
        f"{tmp_dir}/other"
    )
    r = read_results(spark, f"{tmp_dir}/other", lineage=False).first()
    assert r.year_of_event == 5 and r.event_name is None
    try:
        read_results(spark, f"{tmp_dir}/other", lineage=False, check_header=True).collect()
        raised = False
    except Exception:  # noqa: BLE001
        raised = True
    assert raised


def test_csv_bad_cells_and_short_rows(spark, tmp_dir):
    from pacelake.schema import SOURCE_HEADERS

    header = ",".join(f'"{h}"' for h in SOURCE_HEADERS)
    lines = [
        header,
        '2018,06.01.2018,"Ridge, Loop (BEL)",50km,22,4:51:39 h,,BEL,1978.0,M,M35,10.3,7',
        "notayear,06.01.2018,Short Run,50km",
        "2019,07.01.2019,Other,100km,x,9:00:00 h,Club,FRA,abc,W,,11.1,8",
    ]
    import os

    os.makedirs(f"{tmp_dir}/raw", exist_ok=True)
    with open(f"{tmp_dir}/raw/results.csv", "w") as fh:
        fh.write("\n".join(lines) + "\n")
    rows = sorted(read_results(spark, f"{tmp_dir}/raw", lineage=False).collect(), key=lambda r: r.event_name)
    other, ridge, short = rows
    assert ridge.event_name == "Ridge, Loop (BEL)" and ridge.athlete_club is None and ridge.athlete_source_id == 7
    assert short.year_of_event is None and short.event_distance_length == "50km"
    assert short.athlete_performance is None and short.athlete_source_id is None
    assert other.event_number_of_finishers is None and other.athlete_year_of_birth is None
    assert other.athlete_average_speed == 11.1


def test_refresh_before_any_file_lands(spark, tmp_dir):
    lake = refresh(spark, f"{tmp_dir}/landing", f"{tmp_dir}/lake", as_of_year=2026)
    assert lake.table("bronze").count() == 0
    assert lake.enriched().count() == 0 and lake.table("vw_time_yearly_progression").count() == 0
    assert lake.enriched().columns == lake.table("vw_results_enriched").columns


def test_run_that_died_after_bronze_is_completed(spark, tmp_dir):
    from pacelake.streaming.refresh import ingest_bronze

    feed = race_feed(spark, SF_SMALL)
    landing, lake_dir = f"{tmp_dir}/landing", f"{tmp_dir}/lake"
    drop_batch(feed, f"{landing}/historical", "all", single_file=False)
    ingest_bronze(spark, landing, lake_dir)  # ... and the driver dies here
    ingest_bronze(spark, landing, lake_dir)  # a retry of the same hop adds nothing
    lake = refresh(spark, landing, lake_dir, as_of_year=2026)
    batch = lazy_lake(spark, SF_SMALL, as_of_year=2026)
    assert lake.table("bronze").count() == 6000
    assert compare_results(lake.table("silver"), batch.table("silver")).count() == 0
    assert compare_results(lake.table("fct_results"), batch.table("fct_results")).count() == 0


def test_views_rebuilt_only_when_facts_move(spark, tmp_dir):
    from pacelake.sources.sinks import current_version

    feed = race_feed(spark, SF_SMALL)
    landing, lake_dir = f"{tmp_dir}/landing", f"{tmp_dir}/lake"
    drop_batch(feed.filter(F.col("year_of_event") <= 1996), f"{landing}/h", "a")
    refresh(spark, landing, lake_dir, as_of_year=2026)
    v1 = current_version(spark, lake_dir)
    refresh(spark, landing, lake_dir, as_of_year=2026)
    assert current_version(spark, lake_dir) == v1  # nothing new: no rebuild
    drop_batch(feed.filter(F.col("year_of_event") == 1997), f"{landing}/h", "b")
    lake = refresh(spark, landing, lake_dir, as_of_year=2026)
    assert current_version(spark, lake_dir) != v1
    assert lake.enriched().count() == lake.table("fct_results").count()
    for v in glob.glob(f"{lake_dir}/mv/v_*"):
        assert os.path.isdir(v)
    assert len(glob.glob(f"{lake_dir}/mv/v_*")) == 2


def test_two_lakes_refresh_concurrently(spark, tmp_dir):
    from concurrent.futures import ThreadPoolExecutor

    feed = race_feed(spark, SF_SMALL)
    for i in range(2):
        drop_batch(feed.filter(F.col("year_of_event") % 2 == i), f"{tmp_dir}/landing{i}", "a")
    with ThreadPoolExecutor(2) as pool:
        lakes = list(pool.map(lambda i: refresh(spark, f"{tmp_dir}/landing{i}", f"{tmp_dir}/lake{i}", as_of_year=2026), range(2)))
    assert sum(lk.table("bronze").count() for lk in lakes) == 6000


def test_ingested_files_are_archived(spark, tmp_dir):
    """Files of a committed batch are moved out of the landing folder when the
    next batch is planned, so the folder listed on every trigger stays small."""
    import time

    feed = race_feed(spark, SF_SMALL)
    landing, lake_dir, archive = f"{tmp_dir}/landing", f"{tmp_dir}/lake", f"{tmp_dir}/archive"
    drop_batch(feed.filter(F.col("year_of_event") <= 1997), f"{landing}/h", "a", single_file=True)
    refresh(spark, landing, lake_dir, as_of_year=2026, archive_dir=archive)
    drop_batch(feed.filter(F.col("year_of_event") > 1997), f"{landing}/h", "b")
    lake = refresh(spark, landing, lake_dir, as_of_year=2026, archive_dir=archive)
    assert lake.table("bronze").count() == 6000
    for _ in range(20):  # the move runs on a background cleaner thread
        if glob.glob(f"{archive}/**/a/*.csv", recursive=True):
            break
        time.sleep(0.5)
    assert len(glob.glob(f"{archive}/**/a/*.csv", recursive=True)) == 1
    assert glob.glob(f"{landing}/h/a/*.csv") == []


def test_run_folder_is_written_once(spark, tmp_dir):
    import pytest as _pytest

    feed = race_feed(spark, SF_SMALL).limit(10)
    drop_batch(feed, tmp_dir, "run")
    with _pytest.raises(Exception):
        drop_batch(feed, tmp_dir, "run")
    drop_batch(feed, tmp_dir, "run", replace=True)


def test_refresh_refuses_a_batch_built_lake(spark, tmp_dir):
    import pytest as _pytest

    from pacelake.plans.lake import build_lake

    build_lake(spark, SF_SMALL, f"{tmp_dir}/lake")
    with _pytest.raises(ValueError, match="written in batch"):
        refresh(spark, f"{tmp_dir}/landing", f"{tmp_dir}/lake")


def test_backlog_in_bounded_micro_batches(spark, tmp_dir):
    from pacelake.sources.sinks import sink_batch_id

    feed = race_feed(spark, SF_SMALL)
    landing, lake_dir = f"{tmp_dir}/landing", f"{tmp_dir}/lake"
    for y in (1995, 1996, 1997):
        drop_batch(feed.filter(F.col("year_of_event") == y), f"{landing}/h", f"y{y}", single_file=True)
    lake = refresh(spark, landing, lake_dir, as_of_year=2026, max_files_per_trigger=1)
    assert sink_batch_id(spark, f"{lake_dir}/bronze") == 2  # three files, one per micro-batch
    expected = feed.filter(F.col("year_of_event").isin(1995, 1996, 1997)).count()
    assert lake.table("bronze").count() == expected
    assert lake.enriched().count() == lake.table("fct_results").count()
