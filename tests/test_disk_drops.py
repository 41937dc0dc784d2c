"""Landed files of the replays: gzipped, the same rows; no shuffle file is left."""

import pytest
from conftest import SF_SMALL
from disk_helpers import gone, shuffle_files
from helpers import bronze

from pacelake.sources import fs
from pacelake.sources.feed import race_feed
from pacelake.sources.results_csv import read_results
from pacelake.sources.sinks import ANY_RESULTS, drop_batch
from pacelake.streaming import replay
from pacelake.streaming.refresh import ingest_bronze


@pytest.fixture
def shuffled_joins(spark):
    """Joins that shuffle, as those of tables too large to broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_a_build_leaves_no_shuffle_files(spark, tmp_path, shuffled_joins):
    before = shuffle_files(spark)
    lake = replay.build_replay(spark, SF_SMALL, str(tmp_path))
    assert gone(spark, before)
    assert lake.enriched().count() == lake.table("fct_results").count() > 0
    # the landed files were gzipped, and are not kept beside bronze
    bronze_rows, feed = lake.table("bronze"), race_feed(spark, SF_SMALL)
    assert bronze_rows.where("source_file not like '%.csv.gz'").count() == 0
    assert bronze_rows.count() == feed.count()
    assert not fs.exists(spark, f"{lake.root}/landing/historical/feed")


def test_gzipped_drops_are_the_same_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("pacelake.sources.sinks.GZIPPED_ROWS", 7)
    rows = bronze(spark, [dict(athlete_source_id=i, athlete_club=" a,\"b\" " if i % 2 else None) for i in range(40)]).repartition(2)
    plain = drop_batch(rows, f"{tmp_path}/plain", "one")
    packed = drop_batch(rows, f"{tmp_path}/packed", "one", gzipped=True)
    files = [x for x in fs.list_files(spark, packed) if not x.startswith(("_", "."))]
    assert len(files) >= 6 and all(x.endswith(".csv.gz") for x in files)
    a = read_results(spark, plain, lineage=False)
    b = read_results(spark, packed, lineage=False, glob=ANY_RESULTS)
    assert b.count() == 40 and a.exceptAll(b).count() == b.exceptAll(a).count() == 0
    ingest_bronze(spark, f"{tmp_path}/packed", f"{tmp_path}/lake", glob=ANY_RESULTS)
    ingest_bronze(spark, f"{tmp_path}/plain", f"{tmp_path}/lake2", glob=ANY_RESULTS)
    assert [spark.read.parquet(f"{tmp_path}/{x}/bronze").count() for x in ("lake", "lake2")] == [40, 40]
