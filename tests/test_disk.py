"""The lake's build: shuffle files of finished steps go, facts are joined in slices."""

import pytest
from conftest import SF_SMALL
from disk_helpers import gone, joins_of, shuffle_files

from pacelake.plans import lake as lk
from pacelake.plans.lake import AS_OF_YEAR
from pacelake.sources import fs


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
    lake = lk.build_lake(spark, SF_SMALL, str(tmp_path), AS_OF_YEAR)
    assert gone(spark, before)
    assert lake.enriched().count() == lake.table("fct_results").count() > 0


def test_facts_are_joined_in_slices(spark, tmp_path, monkeypatch):
    whole = lk.build_lake(spark, SF_SMALL, f"{tmp_path}/a", AS_OF_YEAR)
    nbytes = fs.total_bytes(spark, f"{tmp_path}/a/fct_results")
    monkeypatch.setattr(lk, "SLICE_BYTES", nbytes // 3)
    seen = joins_of(monkeypatch)
    lk.build_views(spark, f"{tmp_path}/a")
    assert len(seen) >= 3 and max(x.count() for x in seen) < whole.enriched().count() * 2 // 3
    sliced = lk.open_lake(spark, f"{tmp_path}/a")
    for name in ("vw_results_enriched", *lk.GOLD_VIEWS):
        a, b = whole.table(name), sliced.table(name)
        assert a.count() == b.count()
        if name == "vw_results_enriched":
            assert a.exceptAll(b).count() == 0
    assert whole.enriched().inputFiles() != sliced.enriched().inputFiles()
