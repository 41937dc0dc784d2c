"""Clustering along the curve narrows the row groups in every column of it."""

import random

import pyarrow.parquet as pq
import pytest
from conftest import SF_MID
from pyspark.sql import functions as F

from pacelake.plans import clustering as cl
from pacelake.plans.lake import ENRICHED_CLUSTER, ENRICHED_CURVE, lake_for

FILES = 128


def test_code_interleaves_cells(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["A", "Bé", "ZZ", None]), rng.randrange(1000), rng.random()) for _ in range(400)]
    df = spark.createDataFrame(rows, "a string, b int, c double")
    cuts = {"a": [float(int.from_bytes(x.encode().ljust(6, b"\0"), "big")) for x in ("B", "Z")], "b": [100.0, 500.0, 900.0], "c": [0.5]}
    for r in df.withColumn("z", cl.morton(df, cuts, 2)).collect():
        cells = [(r.a is not None) * ((r.a or "") >= "B") + (r.a == "ZZ"), sum(r.b >= x for x in cuts["b"]), int(r.c >= 0.5)]
        want = int("".join(str(cell >> b & 1) for b in (1, 0) for cell in cells), 2)
        assert r.z == want
    assert cl.cell_cuts(df.where("false"), ["a", "b"]) == {"a": [], "b": []}


def test_images_keep_the_order(spark):
    words = ["", "a", "aa", "ab", "b", "é", "日本", "zzzzzzz", "24h", "100km"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r.w for r in df.orderBy(cl.image(df, "w")).collect()]
    assert got == sorted(words, key=lambda w: w.encode())


def groups_to_read(folder, column, value):
    """Row groups whose statistics do not exclude the value, and all."""
    read = total = 0
    for path in folder.rglob("*.parquet"):
        meta = pq.ParquetFile(path).metadata
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(names.index(column)).statistics
            total += 1
            read += bool(s.has_min_max and s.min <= value <= s.max)
    return read, total


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The enriched rows in 128 files: sorted within tasks, and along the curve."""
    lake = lake_for(spark, SF_MID)
    rows, out = lake.enriched(), tmp_path_factory.mktemp("stored")
    cuts = cl.cell_cuts(lake.table("silver"), list(ENRICHED_CURVE.values()))
    rows.repartition(FILES).sortWithinPartitions(*ENRICHED_CLUSTER).write.parquet(f"{out}/plain")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(FILES))
    try:
        cl.clustered(rows, {x: cuts[y] for x, y in ENRICHED_CURVE.items()}, ENRICHED_CLUSTER).write.parquet(f"{out}/curve")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    return rows, out


@pytest.mark.parametrize(("column", "factor"), [("event_year", 2), ("athlete_country", 2), ("event_distance_length", 2)])
def test_fewer_row_groups(stored, column, factor):
    """A filter on a year, a country or a length reads at least so many times
    fewer row groups than of files that are only sorted within tasks."""
    rows, out = stored
    values = [r[0] for r in rows.where(F.col(column).isNotNull()).groupBy(column).count().orderBy(F.desc("count")).limit(5).collect()]
    plain = sum(groups_to_read(out / "plain", column, v)[0] for v in values)
    curve = sum(groups_to_read(out / "curve", column, v)[0] for v in values)
    assert groups_to_read(out / "curve", column, values[0])[1] >= FILES // 2
    assert curve * factor <= plain, (column, curve, plain)
