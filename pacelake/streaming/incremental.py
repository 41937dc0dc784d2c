"""Incremental maintenance of dimensions, enriched view and serving views.

All tables are dealt into hash buckets of their key. A micro-batch of silver rows
is folded into mergeable state, and only the buckets that it touches are written
anew; a small manifest names the version folder of every bucket, and replacing it
publishes the refresh.

* ``events`` (by event) and ``athletes`` (by athlete) keep per key the maxima and
  the latest struct: merging a batch is the same aggregate over both.
* ``facts`` lie in their athlete's bucket, and so do their ``enriched`` rows; a
  batch adds a piece to the buckets it has rows for, joined with the dimensions.
* ``groups_*`` hold counts, sums, minima and maxima of the serving views' groups,
  ``year_*`` bitmaps of countries and athletes by year, a piece beside each piece
  of enriched rows. A view is the merge of all pieces: no fact is read again.
* A bucket is joined anew from its facts, and its pieces replaced, only if older
  rows of it are no longer right (an athlete's country or gender, or an attribute
  of an event, has changed) or it has more than ``MAX_PIECES`` pieces. Replacing
  all pieces of a bucket takes back what they had added to groups and bitmaps.

Folding is idempotent: the manifest carries the last batch it holds, so a batch
that is replayed after a crash is folded once.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pacelake.functions.parsing import hash_key
from pacelake.plans import model, views
from pacelake.plans.countries import dim_country
from pacelake.plans.lake import ENRICHED_CLUSTER, Lake, fact_slices, silver_schema, table_schemas
from pacelake.schema import ENRICHED_COLUMNS, FACT_COLUMNS
from pacelake.session import sized_shuffles
from pacelake.sources import fs
from pacelake.sources.sinks import mkdirs, new_version
from pacelake.streaming.refresh import bronze_to_silver, ingest_bronze

MANIFEST = "_STATE"
BUCKETS = 64
MAX_PIECES = 8
EVENT_ATTRIBUTES = ["event_type", "event_distance_length", "event_distance_km", "event_duration_hours"]
ATHLETE_VALUES = ["athlete_country", "athlete_club", "athlete_gender", "athlete_year_of_birth"]
ENRICHED_ATHLETE = ["athlete_country", "athlete_gender"]
LATEST = ["year_of_event", "event_start_date", "result_id"]
BITMAP = "event_year int, block long, bits binary"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


class State:
    """The published state of a lake: which version folders hold which bucket."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root = spark, root
        text = fs.read_small_text(spark, f"{root}/{MANIFEST}")
        known = json.loads(text) if text else {}
        self.batch = known.get("batch", -1)
        self.buckets = known.get("buckets", buckets)
        self.tables: dict[str, dict[str, list[str]]] = known.get("tables", {})
        self.rewritten: dict[str, int] = known.get("rewritten", {})
        self.previous: list[str] = known.get("versions", [])

    def paths(self, table: str, only: Iterable[int] | None = None) -> list[str]:
        held = self.tables.get(table, {})
        wanted = held if only is None else [str(b) for b in only if str(b) in held]
        return [f"{self.root}/state/{v}/{table}/bucket={b}" for b in wanted for v in held[b]]

    def read(self, table: str, schema, only: Iterable[int] | None = None) -> DataFrame:
        paths = self.paths(table, only)
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def versions(self) -> set[str]:
        return {v for held in self.tables.values() for pieces in held.values() for v in pieces}

    def publish(self, batch: int, rewritten: dict[str, int]) -> None:
        """Make these tables the current ones, and delete the version folders
        that neither they nor the state before refer to."""
        now = sorted({v.split("/")[0] for v in self.versions()})
        keep = {*now, *self.previous}
        text = json.dumps({"batch": batch, "buckets": self.buckets, "tables": self.tables, "rewritten": rewritten, "versions": now})
        fs.write_small_text(self.spark, f"{self.root}/{MANIFEST}", text)
        newest = max(keep, default="")
        for v in fs.list_dirs(self.spark, f"{self.root}/state"):
            if v not in keep and v < newest:
                fs.delete(self.spark, f"{self.root}/state/{v}")


# --- state per key ---------------------------------------------------------------------


def _event_state(rows: DataFrame) -> DataFrame:
    """Rows or state -> state; the same aggregate, so it merges."""
    return model.dim_event(rows)


def _athlete_rows(silver: DataFrame) -> DataFrame:
    ordered = F.when(F.col("year_of_event").isNotNull(), F.struct(*LATEST))
    return silver.select("athlete_source_id", ordered.alias("at"), F.when(ordered.isNotNull(), F.struct(*ATHLETE_VALUES)).alias("latest"), F.lit(None).cast("long").alias("num"))


def _athlete_state(rows: DataFrame) -> DataFrame:
    """(athlete_source_id, at, latest, num): the values of the latest row of
    each athlete, what makes it the latest, and the athlete's number in its
    bucket; merges."""
    best = F.max(F.when(F.col("at").isNotNull(), F.struct("at", "latest"))).alias("best")
    return rows.groupBy("athlete_source_id").agg(best, F.min("num").alias("num")).select("athlete_source_id", "best.at", "best.latest", "num")


def _numbered(athletes: DataFrame) -> DataFrame:
    """Athletes (with their bucket) without a number get the next ones."""
    own = Window.partitionBy("bucket")
    last = F.coalesce(F.max("num").over(own), F.lit(0))
    # numbered ones come last, so the others' places are 1, 2, ...
    place = F.row_number().over(own.orderBy(F.col("num").isNotNull(), "athlete_source_id"))
    return athletes.withColumns({"_last": last, "_place": place}).withColumn("num", F.coalesce("num", F.col("_last") + F.col("_place"))).drop("_last", "_place")


def athletes_of(state: DataFrame) -> DataFrame:
    """dim_athlete out of its state, with the athletes' numbers."""
    return state.select(hash_key("athlete_source_id").alias("athlete_id"), "athlete_source_id", *[F.col("latest")[x].alias(x) for x in ATHLETE_VALUES], "num")


# --- groups of the serving views -------------------------------------------------------

_SUMS = {"secs": "performance_time_seconds", "speed": "athlete_average_speed", "km": "performance_distance_km"}


def _group_keys(event_type: str) -> list[str]:
    return sorted({k for cols in views.VIEW_KEYS[event_type].values() for k in cols})


def _partial_groups(enriched: DataFrame, event_type: str) -> DataFrame:
    """Mergeable measures of the groups of an event type's views, per bucket."""
    rows = enriched.where(F.col("event_type") == event_type)
    sets = [["bucket", *cols] for cols in views.VIEW_KEYS[event_type].values()]
    measures = [F.count(F.lit(1)).alias("n"), F.min(_SUMS["secs"]).alias("min_secs"), F.max(_SUMS["km"]).alias("max_km"), F.grouping_id().alias("gid")]
    for name, column in _SUMS.items():
        measures += [F.sum(column).alias(f"sum_{name}"), F.count(column).alias(f"n_{name}")]
    return rows.groupingSets(sets, "bucket", *_group_keys(event_type)).agg(*measures)


def _merged_groups(partial: DataFrame, event_type: str) -> DataFrame:
    """All buckets' groups as ``views.view_groups`` gives them."""
    add = [F.sum(x).alias(x) for x in ("n", *(f"{a}_{name}" for name in _SUMS for a in ("sum", "n")))]
    groups = partial.groupBy("gid", *_group_keys(event_type)).agg(*add, F.min("min_secs").alias("min_secs"), F.max("max_km").alias("max_km"))
    # sums of doubles depend on their order in the last digits; ten decimals do not
    means = {f"avg_{name}": F.round(F.col(f"sum_{name}") / F.nullif(F.col(f"n_{name}"), F.lit(0)), 10) for name in _SUMS}
    return groups.withColumns(means)


# --- bitmaps ----------------------------------------------------------------------------


def _bitmaps(ids: DataFrame) -> DataFrame:
    """(bucket, event_year, block, bits) of rows (bucket, event_year, id)."""
    return ids.groupBy("bucket", "event_year", F.bitmap_bucket_number("id").alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))


def distinct_from_bitmaps(bitmaps: DataFrame, group: Column, name: str, value: str, by_bucket: bool) -> DataFrame:
    """Exact distinct counts per group of years out of stored bitmaps: the
    bitmaps of a group are or-ed, block by block, and their bits counted. Ids are
    numbered per bucket (``by_bucket``) or for the whole table."""
    keys = [group.alias(name), *(["bucket"] if by_bucket else []), "block"]
    blocks = bitmaps.groupBy(*keys).agg(F.bitmap_or_agg("bits").alias("bits"))
    return blocks.groupBy(name).agg(F.sum(F.bitmap_count("bits")).alias(value))


# --- folding ----------------------------------------------------------------------------


def _touched(df: DataFrame) -> list[int]:
    """Numbers of the buckets of a table (at most as many as there are buckets)."""
    return sorted(r[0] for r in df.select("bucket").distinct().collect())


def fold(spark: SparkSession, root: str, silver: DataFrame, batch: int, buckets: int = BUCKETS) -> State:
    """Fold a batch of silver rows into the state under ``root``; a batch that
    the state already holds changes nothing."""
    state = State(spark, root, buckets)
    if batch <= state.batch:
        return state
    version, n = new_version(), state.buckets
    out = f"{root}/state/{version}"
    schemas = table_schemas(spark)

    def put(table: str, df: DataFrame | Sequence[DataFrame], replace: Iterable[int] = (), add: Iterable[int] = ()) -> None:
        for part in [df] if isinstance(df, DataFrame) else df:
            part.write.mode("append").option("compression", "zstd").partitionBy("bucket").parquet(f"{out}/{table}")
        there = {d.split("=")[1] for d in fs.list_dirs(spark, f"{out}/{table}")}
        held = state.tables.setdefault(table, {})
        for b in map(str, replace):
            held.pop(b, None)
        for b in map(str, (*replace, *add)):
            if b in there:
                held[b] = [*held.get(b, []), version]

    # the batch is written once, as the facts' pieces: these have the other
    # silver columns besides, for the dimensions that are folded from them
    fact_schema, fact_bucket = schemas["fct_results"], bucket_of("athlete_id", n)
    rows = silver.withColumns({"date_id": model.date_id(F.col("event_start_date")), "bucket": fact_bucket})
    put("facts", rows, add=range(n))
    delta = spark.read.schema(rows.schema).parquet(f"{out}/facts")
    of_events = _touched(delta.select(bucket_of("event_id", n).alias("bucket")))
    of_athletes = _touched(delta)

    # dimensions: the batch's state merged with that of its buckets
    before = state.read("events", schemas["dim_event"], of_events)
    merged = _event_state(before.unionByName(_event_state(delta)))
    put("events", merged.withColumn("bucket", bucket_of("event_id", n)), of_events)
    fresh = _athlete_state(_athlete_rows(delta))
    old_athletes = state.read("athletes", fresh.schema, of_athletes)
    athletes = _athlete_state(old_athletes.unionByName(fresh)).withColumn("_id", hash_key("athlete_source_id"))
    put("athletes", _numbered(athletes.withColumn("bucket", bucket_of("_id", n)).drop("_id")), of_athletes)
    dates = model.dim_date(delta)
    year_bucket = F.pmod(F.col("year"), F.lit(n)).cast("int")
    of_dates = _touched(dates.select(year_bucket.alias("bucket")))
    put("dates", state.read("dates", schemas["dim_date"], of_dates).unionByName(dates).distinct().withColumn("bucket", year_bucket), of_dates)

    # the buckets whose older enriched rows are no longer right
    new_events = _changed(before, state.read("events", schemas["dim_event"], of_events), ["event_id", "event_name"], EVENT_ATTRIBUTES)
    new_athletes = _changed(athletes_of(old_athletes), athletes_of(state.read("athletes", fresh.schema, of_athletes)), ["athlete_id"], ENRICHED_ATHLETE)
    again = set(_touched(new_athletes.select(fact_bucket.alias("bucket"))))
    if new_events.limit(1).count():
        theirs = state.read("facts", fact_schema).select("event_id", "athlete_id").join(new_events, "event_id", "left_semi")
        again.update(_touched(theirs.select(fact_bucket.alias("bucket"))))
    long = {b for b in of_athletes if len(state.tables["facts"].get(str(b), [])) > MAX_PIECES}
    again, added = sorted(again | long), sorted({*of_athletes} - again - long)
    if long:
        whole = state.read("facts", fact_schema, long).withColumn("bucket", fact_bucket)
        whole.write.option("compression", "zstd").partitionBy("bucket").parquet(f"{out}/merged/facts")
        state.tables["facts"].update({str(b): [f"{version}/merged"] for b in long})

    facts = delta.where(F.col("bucket").isin(added)).select(*FACT_COLUMNS)
    if again:
        facts = facts.unionByName(state.read("facts", fact_schema, again))
    dim_athlete = athletes_of(state.read("athletes", fresh.schema, [*again, *added]))
    dim_event = state.read("events", schemas["dim_event"], None if again else of_events)
    dim_date = state.read("dates", schemas["dim_date"], None if again else of_dates)
    nbytes = fs.total_bytes(spark, *[f"{out}/facts/bucket={b}" for b in added], *state.paths("facts", again))
    joined = [
        views.results_enriched(part, dim_event, dim_athlete, dim_date, keep=["athlete_id", "num"]).withColumn("bucket", fact_bucket)
        for part in fact_slices(facts, nbytes)
    ]
    # every task writes a file for each bucket it has rows of, as for the facts:
    # no shuffle, and a bucket with a hot athlete is written by several tasks
    put("enriched", [x.sortWithinPartitions("bucket", *ENRICHED_CLUSTER) for x in joined], again, added)
    enriched = spark.read.schema(joined[0].schema).parquet(f"{out}/enriched")

    # mergeable groups and bitmaps of these pieces
    for event_type in views.VIEW_KEYS:
        put(f"groups_{event_type}", _partial_groups(enriched, event_type), again, added)
    codes = state.read("codes", "code string, id long")
    unseen = enriched.select(F.col("athlete_country").alias("code")).where("code is not null").distinct().join(codes, "code", "left_anti")
    last = codes.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    unseen = unseen.select("code", (F.row_number().over(Window.orderBy("code")) + F.lit(last)).cast("long").alias("id"))
    put("codes", unseen.withColumn("bucket", F.lit(0)), add=[0])
    codes = state.read("codes", "code string, id long")
    countries = enriched.select("bucket", "event_year", F.col("athlete_country").alias("code")).join(codes, "code")
    put("year_countries", _bitmaps(countries), again, added)
    put("year_athletes", _bitmaps(enriched.withColumnRenamed("num", "id")), again, added)
    state.publish(batch, {"events": len(of_events), "athletes": len(of_athletes), "dates": len(of_dates), "enriched_again": len(again), "enriched_added": len(added)})
    return State(spark, root, buckets)


def _changed(before: DataFrame, after: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """The first key of rows that were there before with other values."""
    old = before.select(*[F.col(x).alias(f"_{x}") for x in (*keys, *values)])
    same = [F.col(x).eqNullSafe(F.col(f"_{x}")) for x in (*keys, *values)]
    on, equal = reduce(Column.__and__, same[: len(keys)]), reduce(Column.__and__, same[len(keys) :])
    return after.join(old, on).where(~equal).select(keys[0])


def open_state(spark: SparkSession, root: str) -> Lake:
    """The lake of a state: stored dimensions and enriched rows, and serving
    views and distinct counts merged from the buckets' groups and bitmaps."""
    state, lake, schemas = State(spark, root), Lake(spark, root), table_schemas(spark)
    rows = lambda table, name: lambda: state.read(table, schemas[name])
    athlete_schema = _athlete_state(_athlete_rows(spark.createDataFrame([], silver_schema(spark)))).schema
    lake._tables.update(
        {
            "fct_results": lambda: state.read("facts", schemas["fct_results"]).select(*FACT_COLUMNS),
            "dim_event": rows("events", "dim_event"),
            "dim_athlete": lambda: athletes_of(state.read("athletes", athlete_schema)).drop("num"),
            "dim_date": rows("dates", "dim_date"),
            "dim_country": lambda: dim_country(spark),
            "vw_results_enriched": lambda: state.read("enriched", schemas["vw_results_enriched"]).select(*ENRICHED_COLUMNS),
        }
    )

    def group_schema(event_type: str):
        empty = spark.createDataFrame([], schemas["vw_results_enriched"]).withColumn("bucket", F.lit(0))
        return _partial_groups(empty, event_type).drop("bucket").schema

    def view(event_type: str, name: str):
        groups = _merged_groups(state.read(f"groups_{event_type}", group_schema(event_type)), event_type)
        return views.view_of(groups, event_type, name)

    for event_type, names in views.VIEW_KEYS.items():
        for name in names:
            lake._tables[name] = (lambda t, x: lambda: view(t, x))(event_type, name)

    def bitmaps(table: str) -> DataFrame:
        parts = state.paths(table)
        found = F.regexp_extract(F.col("_metadata.file_path"), r"/bucket=([0-9]+)/", 1).cast("int")
        read = spark.read.schema(BITMAP).parquet(*parts) if parts else None
        return read.select("event_year", "block", "bits", found.alias("bucket")) if parts else spark.createDataFrame([], f"{BITMAP}, bucket int")

    lake._tables["year_countries"] = lambda: bitmaps("year_countries")
    lake._tables["year_athletes"] = lambda: bitmaps("year_athletes")
    return lake


def refresh_incremental(spark: SparkSession, landing_dir: str, lake_dir: str, as_of_year: int | None = None, buckets: int = BUCKETS, max_files_per_trigger: int | None = 1000, glob: str = "*.csv") -> Lake:
    """One pipeline run: landed files -> bronze -> silver as streams, and every
    micro-batch of silver folded into the state. Its cost follows the batch and
    the buckets it touches, not the history."""
    with sized_shuffles(spark, landing_dir):
        ingest_bronze(spark, landing_dir, lake_dir, max_files_per_trigger, glob=glob)
        bronze_to_silver(spark, lake_dir, as_of_year)
        mkdirs(spark, f"{lake_dir}/silver", f"{lake_dir}/state")
        rows = spark.readStream.schema(silver_schema(spark)).parquet(f"{lake_dir}/silver")
        (
            rows.writeStream.foreachBatch(lambda df, batch: fold(df.sparkSession, lake_dir, df, batch, buckets) and None)
            .option("checkpointLocation", f"{lake_dir}/_checkpoints/state")
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
    return open_state(spark, lake_dir)
