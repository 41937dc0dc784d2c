"""Replay the race feed derived from the input tables through the streaming
pipeline: the rows are landed as result files and ingested by ``refresh``.

This is the production path end to end (CSV files -> bronze -> silver ->
fact -> views), used to check that it produces the same tables as the batch
build. Built once per Spark application and input folder.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacelake.plans.lake import AS_OF_YEAR, Lake, lake_for, open_lake, reuse_or_build
from pacelake.sources.feed import FEED_TABLES, race_feed
from pacelake.sources.tables import table_path
from pacelake.functions.clean import clean_results
from pacelake.operators.metrics import stable_round
from pacelake.sources import fs
from pacelake.sources.results_csv import read_results, read_results_text
from pacelake.schema import BRONZE_COLUMNS, FEED_SCHEMA, SOURCE_HEADERS
from pacelake.session import scratch_path, sized_shuffles
from pacelake.sources.sinks import ANY_RESULTS, POINTER, drop_batch
from pacelake.streaming.incremental import MANIFEST, distinct_from_bitmaps, open_state, refresh_incremental
from pacelake.streaming.quarantine import ingest_marked, marked_rows, reconcile
from pacelake.streaming.refresh import ingest_bronze, refresh

_REPLAYS: dict[tuple, Lake] = {}
_LOCK = threading.Lock()


def _sized(spark: SparkSession, base_dir: str) -> sized_shuffles:
    """Shuffles sized from the tables that the feed joins."""
    return sized_shuffles(spark, *[table_path(base_dir, t) for t in FEED_TABLES])


def _stored_feed(spark: SparkSession, base_dir: str, path: str) -> DataFrame:
    """The feed written once, for builds that land it in several drops: each
    would join all tables anew."""
    race_feed(spark, base_dir).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(FEED_SCHEMA).parquet(path)


def build_replay(spark: SparkSession, base_dir: str, root: str, as_of_year: int | None = AS_OF_YEAR) -> Lake:
    """Land the feed as gzipped CSV files under ``root/landing`` and run the streaming
    refresh into ``root`` (always builds). The landed files are this build's own
    copy of the feed: they go once all of them are in bronze."""
    with _sized(spark, base_dir):
        landed = drop_batch(race_feed(spark, base_dir), f"{root}/landing/historical", "feed", gzipped=True)
    with sized_shuffles(spark, f"{root}/landing"):
        ingest_bronze(spark, f"{root}/landing", root, glob=ANY_RESULTS)
    fs.delete(spark, landed)
    refresh(spark, f"{root}/landing", root, as_of_year=as_of_year, glob=ANY_RESULTS)
    return open_lake(spark, root)


def replayed_lake(spark: SparkSession, base_dir: str, as_of_year: int | None = AS_OF_YEAR) -> Lake:
    key = (spark.sparkContext.applicationId, base_dir.rstrip("/"), as_of_year)
    with _LOCK:
        lake = _REPLAYS.get(key)
        if lake is None:
            inputs = [table_path(base_dir, t) for t in FEED_TABLES]
            lake = reuse_or_build(
                spark, "replay", inputs, f"as_of_year={as_of_year}",
                lambda root: build_replay(spark, base_dir, root, as_of_year),
            )
            _REPLAYS[key] = lake
        return lake


FIRST_DROP_UNTIL = 1996  # years of the first of two drops


def ingested_drops(spark: SparkSession, base_dir: str) -> Lake:
    """The feed landed in two drops (years up to ``FIRST_DROP_UNTIL`` as
    ``historical``, later ones as ``simulated``), with a refresh after each and
    one more with nothing new."""
    def build(root: str) -> Lake:
        with _sized(spark, base_dir):
            feed, landing = _stored_feed(spark, base_dir, f"{root}/feed"), f"{root}/landing"
            drop_batch(feed.filter(F.col("year_of_event") <= FIRST_DROP_UNTIL), f"{landing}/historical", "drop", gzipped=True)
            refresh(spark, landing, root, as_of_year=AS_OF_YEAR, glob=ANY_RESULTS)
            drop_batch(feed.filter(F.col("year_of_event") > FIRST_DROP_UNTIL), f"{landing}/simulated", "drop", gzipped=True)
            fs.delete(spark, f"{root}/feed")  # all of it has landed
            refresh(spark, landing, root, as_of_year=AS_OF_YEAR, glob=ANY_RESULTS)
            refresh(spark, landing, root, as_of_year=AS_OF_YEAR, glob=ANY_RESULTS)
        return open_lake(spark, root)

    return _once(spark, "drops", base_dir, f"two drops, {FIRST_DROP_UNTIL}", build)


def stream_bronze_lineage(spark: SparkSession, base_dir: str) -> DataFrame:
    """Bronze rows after two drops and a rerun, per landing folder (read from
    the rows' file names) and year; rows without lineage would show as ''."""
    bronze = ingested_drops(spark, base_dir).table("bronze")
    folder = F.when(F.col("ingest_ts").isNotNull(), F.regexp_extract("source_file", r"/landing/([a-z]+)/drop/[^/]+\.csv(?:\.gz)?$", 1)).otherwise("")
    return bronze.groupBy(folder.alias("landing_folder"), "year_of_event").agg(F.count(F.lit(1)).alias("n_rows"))


def landed_text_profile(spark: SparkSession, base_dir: str) -> DataFrame:
    """The landed files read by their headers alone, all columns as text: rows,
    columns and distinct countries of each landing folder."""
    lake = ingested_drops(spark, base_dir)
    parts = []
    for folder in ("historical", "simulated"):
        rows = read_results_text(spark, f"{lake.root}/landing/{folder}/drop")
        if set(dict(rows.dtypes).values()) != {"string"}:
            raise ValueError("a header-only read gives text columns")
        parts.append(rows.agg(F.lit(folder).alias("landing_folder"), F.count(F.lit(1)).alias("n_rows"), F.lit(len(rows.columns)).alias("n_columns"), F.count_distinct(F.upper(F.trim("Athlete country"))).alias("n_countries")))
    return parts[0].union(parts[1])


REPLAY_BUCKETS = 16
DROP_YEARS = [(None, 1994), (1995, 1996), (1997, None)]


_OPEN: dict[tuple, Lake] = {}


def _once(spark: SparkSession, kind: str, base_dir: str, params: str, build, reopen=open_lake, published: str = POINTER) -> Lake:
    """A build of the feed, opened once per application."""
    key = (spark.sparkContext.applicationId, kind, base_dir.rstrip("/"))
    with _LOCK:
        if key not in _OPEN:
            inputs = [table_path(base_dir, t) for t in FEED_TABLES]
            _OPEN[key] = reuse_or_build(spark, kind, inputs, params, build, reopen, published)
        return _OPEN[key]


def build_incremental(spark: SparkSession, base_dir: str, root: str) -> Lake:
    """Land the feed in three drops by year and fold each into the stored state
    by an incremental refresh (always builds)."""
    with _sized(spark, base_dir):
        feed, landing, year = _stored_feed(spark, base_dir, f"{root}/feed"), f"{root}/landing", F.col("year_of_event")
        for i, (first, last) in enumerate(DROP_YEARS):
            rows = feed.where(year >= first) if first else feed
            drop_batch(rows.where(year <= last) if last else rows, landing, f"drop_{i}", gzipped=True)
            if i == len(DROP_YEARS) - 1:
                fs.delete(spark, f"{root}/feed")  # all of it has landed
            refresh_incremental(spark, landing, root, as_of_year=AS_OF_YEAR, buckets=REPLAY_BUCKETS, glob=ANY_RESULTS)
    return open_state(spark, root)


def incremental_lake(spark: SparkSession, base_dir: str) -> Lake:
    """The lake that ``build_incremental`` keeps."""
    params = f"{DROP_YEARS} {REPLAY_BUCKETS}"
    return _once(spark, "incremental", base_dir, params, lambda root: build_incremental(spark, base_dir, root), open_state, MANIFEST)


def incremental_table(name: str):
    """Query: a table of the lake that incremental refreshes have kept, its means
    to six decimals."""
    def run(spark: SparkSession, base_dir: str) -> DataFrame:
        df = incremental_lake(spark, base_dir).table(name)
        return df.withColumns({x: stable_round(x, 6) for x, kind in df.dtypes if kind == "double" and x.startswith("avg_")})

    return run


def bitmap_country_diversity(spark: SparkSession, base_dir: str) -> DataFrame:
    """C2 from stored bitmaps: distinct countries per year, no fact read."""
    bits = incremental_lake(spark, base_dir).table("year_countries")
    return distinct_from_bitmaps(bits, F.col("event_year"), "event_year", "n_countries", by_bucket=False)


def bitmap_athletes_per_year(spark: SparkSession, base_dir: str) -> DataFrame:
    """Distinct athletes with results per year, from stored bitmaps."""
    bits = incremental_lake(spark, base_dir).table("year_athletes")
    return distinct_from_bitmaps(bits, F.col("event_year"), "event_year", "n_athletes", by_bucket=True)


def bitmap_athletes_per_span(spark: SparkSession, base_dir: str) -> DataFrame:
    """Distinct athletes per span of three years: the years' bitmaps merged."""
    bits = incremental_lake(spark, base_dir).table("year_athletes")
    span = F.floor(F.col("event_year") / 3).cast("int") * 3
    return distinct_from_bitmaps(bits, span, "first_year", "n_athletes", by_bucket=True)


def _with_broken_cells(feed: DataFrame) -> DataFrame:
    """The feed as text under its source headers, with cells that are not of
    their column's type: by the athlete's number, a year, a number of finishers,
    a year of birth or a speed."""
    c, who = F.col, F.col("athlete_source_id")
    broken = {
        "year_of_event": F.when(who % 41 == 7, F.concat(F.lit("y"), c("year_of_event").cast("string"))),
        "event_number_of_finishers": F.when(who % 43 == 5, F.lit("many")),
        "athlete_year_of_birth": F.when(who % 47 == 3, F.lit("19x0")),
        "athlete_average_speed": F.when(who % 53 == 2, F.lit("fast")),
    }
    cells = [F.coalesce(broken[x], c(x).cast("string")) if x in broken else c(x).cast("string") for x in BRONZE_COLUMNS]
    return feed.select(*[cell.alias(h) for cell, h in zip(cells, SOURCE_HEADERS)])


MARKED = "_MARKED"


def _marked_lake(spark: SparkSession, base_dir: str) -> Lake:
    """Landed files with malformed rows, in two drops, through the marking
    stream."""
    def build(root: str) -> Lake:
        with _sized(spark, base_dir):
            feed, landing, year = _stored_feed(spark, base_dir, f"{root}/feed"), f"{root}/landing", F.col("year_of_event")
            for folder, part in (("historical", feed.where(year <= FIRST_DROP_UNTIL)), ("simulated", feed.where(year > FIRST_DROP_UNTIL))):
                text = _with_broken_cells(part).write.option("header", True)
                text.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{landing}/{folder}/drop")
                ingest_marked(spark, landing, f"{root}/rows", f"{root}/_checkpoints/rows")
            fs.delete(spark, f"{root}/feed")
        fs.write_small_text(spark, f"{root}/{MARKED}", "complete")
        return Lake(spark, root)

    return _once(spark, "marked", base_dir, f"two drops, {FIRST_DROP_UNTIL}", build, Lake, MARKED)


def quarantined_rows(spark: SparkSession, base_dir: str) -> DataFrame:
    """Rows of the landed files per folder and reason why they are set aside
    (kept rows: 'kept'), and rows that the table lacks against the files
    ('missing', 0)."""
    root = _marked_lake(spark, base_dir).root
    table = marked_rows(spark, f"{root}/rows")
    folder = F.regexp_extract("source_file", r"/landing/([a-z]+)/", 1).alias("landing_folder")
    seen = table.groupBy(folder, F.coalesce("reason", F.lit("kept")).alias("outcome")).agg(F.count(F.lit(1)).alias("n_rows"))
    missing = reconcile(spark, f"{root}/landing", table).groupBy(folder).agg(F.sum("n_missing").alias("n_rows"))
    return seen.union(missing.select("landing_folder", F.lit("missing"), "n_rows"))


def landed_batch_profile(spark: SparkSession, base_dir: str) -> DataFrame:
    """The landed files read in batch with the typed schema: rows, finishers,
    known years of birth and speeds of each landing folder."""
    lake = ingested_drops(spark, base_dir)
    rows = read_results(spark, f"{lake.root}/landing", glob=ANY_RESULTS)
    folder = F.regexp_extract("source_file", r"/landing/([a-z]+)/", 1)
    return rows.groupBy(folder.alias("landing_folder")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("event_number_of_finishers").alias("n_finishers"),
        F.count("athlete_year_of_birth").alias("n_births"), F.max("athlete_average_speed").alias("max_speed"),
    )


def single_file_drop(spark: SparkSession, base_dir: str) -> DataFrame:
    """The finishers of one event (the first by name) dropped as one file and
    read back: files, the header as it was written, rows and athletes."""
    feed = race_feed(spark, base_dir)
    with _sized(spark, base_dir):
        first = feed.agg(F.min("event_name")).first()[0]  # one name
        path = drop_batch(feed.where(F.col("event_name") == F.lit(first)), scratch_path(spark, "drops"), "event", single_file=True)
    n_files = sum(name.endswith(".csv") for name in fs.list_files(spark, path))
    header = spark.read.text(path).where(F.col("value").startswith(SOURCE_HEADERS[0])).agg(F.min("value").alias("header"))
    rows = read_results(spark, path).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("athlete_source_id").alias("n_athletes"))
    return rows.select(F.lit(n_files).cast("long").alias("n_files"), header.scalar().alias("header"), "n_rows", "n_athletes")


def births_as_of_today(spark: SparkSession, base_dir: str) -> DataFrame:
    """Silver cleaned with today's year: results per year of birth, as far as
    the year is plausible today."""
    silver = clean_results(lake_for(spark, base_dir).table("bronze"))
    return silver.groupBy("athlete_year_of_birth").agg(F.count(F.lit(1)).alias("n_results"))
