"""Every registered query against its DuckDB oracle (what the driver checks)."""

import pytest
from conftest import SF_SMALL

from compare import compare


@pytest.fixture(scope="module")
def results(spark):
    from pacelake.plans.catalog import all_queries

    return compare(spark, SF_SMALL, list(all_queries()))


def test_all_queries_match(results):
    bad = {k: v for k, v in results.items() if v[0] not in ("EXACT", "APPROX", "NO_ORACLE")}
    assert not bad, bad


def test_only_sampling_lacks_oracle(results):
    assert {k for k, v in results.items() if v[0] == "NO_ORACLE"} == {"x8_sample_pairs"}


def test_entry_runs(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.columns == ["event_year", "year_best_hours", "world_record_to_date"]
    assert df.count() > 0
