"""The incremental build: facts of a batch are joined in slices, what has landed
is not kept twice, no shuffle file is left."""

import pytest
from conftest import SF_SMALL
from disk_helpers import gone, joins_of, shuffle_files
from helpers import bronze

from pacelake.functions.clean import clean_results
from pacelake.plans import lake as lk
from pacelake.plans.lake import AS_OF_YEAR
from pacelake.sources import fs
from pacelake.streaming import incremental as inc
from pacelake.streaming import replay


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
    lake = replay.build_incremental(spark, SF_SMALL, str(tmp_path))
    assert gone(spark, before)
    assert lake.enriched().count() == lake.table("fct_results").count() > 0
    landed = [x for i in range(3) for x in fs.list_files(spark, f"{lake.root}/landing/drop_{i}") if x.startswith("part-")]
    assert landed and all(x.endswith(".csv.gz") for x in landed)
    assert not fs.exists(spark, f"{lake.root}/feed")


def test_slices_keep_duplicates_nulls_and_a_hot_athlete(spark, tmp_path, monkeypatch):
    hot = [dict(athlete_source_id=None, athlete_performance=f"{i % 9 + 1}:00:00 h") for i in range(30)]
    rows = hot + [dict(athlete_source_id=i, event_name=None if i % 3 else "E") for i in range(10)] * 2
    silver = clean_results(bronze(spark, rows), as_of_year=AS_OF_YEAR)
    plain = inc.fold(spark, f"{tmp_path}/a", silver, 0, 4)
    monkeypatch.setattr(lk, "SLICE_BYTES", fs.total_bytes(spark, *plain.paths("facts")) // 4)
    seen = joins_of(monkeypatch)
    inc.fold(spark, f"{tmp_path}/b", silver, 0, 4)
    assert len(seen) >= 4
    a, b = (inc.open_state(spark, f"{tmp_path}/{x}") for x in "ab")
    assert b.enriched().count() == 50
    for name in ("vw_results_enriched", "dim_athlete", "year_athletes", *lk.GOLD_VIEWS):
        assert a.table(name).exceptAll(b.table(name)).count() == b.table(name).exceptAll(a.table(name)).count() == 0, name
