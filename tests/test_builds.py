"""How builds are run: sized tasks, one join of the feed, one write of a batch."""

import pytest
from conftest import SF_SMALL
from helpers import bronze

from pacelake import session
from pacelake.functions.clean import clean_results
from pacelake.plans.lake import AS_OF_YEAR
from pacelake.sources import fs
from pacelake.sources.sinks import drop_batch
from pacelake.streaming import incremental as inc
from pacelake.streaming import replay


def test_single_file_is_one_task_of_the_write_only(spark, tmp_path):
    rows = bronze(spark, [dict(athlete_source_id=i) for i in range(40)]).repartition(5, "athlete_source_id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.sparkContext.setJobGroup("single", "single")
    try:
        out = drop_batch(rows, str(tmp_path), "one", single_file=True)
    finally:
        spark.sparkContext.setJobGroup("", "")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(x.endswith(".csv") for x in fs.list_files(spark, out)) == 1
    assert spark.read.option("header", True).csv(out).count() == 40
    tracker = spark.sparkContext.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup("single") for s in tracker.getJobInfo(j).stageIds]
    # the five partitions are a stage of their own, before the one task that writes
    tasks = [i.numTasks for i in map(tracker.getStageInfo, stages) if i]
    assert 5 in tasks and 1 in tasks, tasks


class Seen(Exception):
    pass


@pytest.mark.parametrize("build", [replay.build_incremental, replay.ingested_drops])
def test_drops_read_the_stored_feed(spark, tmp_path, monkeypatch, build):
    """Every drop is a filter of the feed that was joined and stored once."""
    def caught(df, *args, **kw):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and plan.rstrip().endswith("parquet"), plan
        raise Seen

    monkeypatch.setattr(replay, "drop_batch", caught)
    monkeypatch.setattr(replay, "_once", lambda spark, kind, base, params, make: make(str(tmp_path)))
    with pytest.raises(Seen):
        build(spark, SF_SMALL, *([str(tmp_path)] if build is replay.build_incremental else []))


def test_a_batch_is_written_once(spark, tmp_path):
    """The facts' pieces are the batch: the dimensions are folded from them."""
    rows = [dict(athlete_source_id=i % 5, athlete_performance=f"{4 + i}:00:00 h", event_distance_length="50km") for i in range(12)]
    silver = clean_results(bronze(spark, rows), as_of_year=AS_OF_YEAR)
    state = inc.fold(spark, str(tmp_path), silver, 0, 4)
    stored = spark.read.parquet(*state.paths("facts"))
    assert {*silver.columns} <= {*stored.columns} and stored.count() == 12
    lake = inc.open_state(spark, str(tmp_path))
    assert lake.table("fct_results").count() == lake.enriched().count() == 12
    assert lake.table("dim_athlete").count() == 5
    inc.fold(spark, str(tmp_path), silver, 1, 4)
    assert inc.open_state(spark, str(tmp_path)).enriched().count() == 24


def test_build_settings(spark, monkeypatch):
    keys = [session._SHUFFLES, *session.build_conf(0)]
    before = {k: spark.conf.get(k, None) for k in keys}
    monkeypatch.setattr(session, "input_bytes", lambda *a: 1 << 30)
    with session.sized_shuffles(spark, "x"):
        assert int(spark.conf.get(session._SHUFFLES)) >= 128
        assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"
        with session.sized_shuffles(spark, "x"):
            pass
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "16m"
    assert {k: spark.conf.get(k, None) for k in keys} == before
    # many tasks become larger ones
    assert session.shuffle_partitions_for(spark, 1 << 38) == session.MANY_PARTITIONS
    assert session.build_conf(1 << 38)["spark.sql.files.maxPartitionBytes"] == "128m"
