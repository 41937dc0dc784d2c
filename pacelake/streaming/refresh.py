"""Incremental pipeline run: landed result files -> bronze -> silver -> fact
as three triggered streams, then the dimensions and views recomputed.

* bronze: file stream over the landing folder (CSV, fixed schema, lineage).
* silver: stream over the bronze table, ``clean_results`` (narrow and
  stateless: projection + filter, no shuffle, no state store).
* fact:   stream over the silver table, narrow projection.

Each stream has its own checkpoint, so every landed file flows through each
layer exactly once, a run with no new files adds nothing, and a run that dies
mid-way (lost executors, lost driver) resumes from its last committed batch.
The dimensions and serving views aggregate over all history, so they are
batch-recomputed into a new version folder and published atomically.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from pacelake.functions.clean import clean_results
from pacelake.plans.lake import Lake, build_views, open_lake, silver_schema
from pacelake.plans.model import fct_results
from pacelake.session import sized_shuffles
from pacelake.sources import fs
from pacelake.sources.results_csv import BRONZE_SCHEMA, read_results
from pacelake.sources.sinks import append_stream, current_stamp, current_version, mkdirs, sink_batch_id


def _check_streamed(spark: SparkSession, lake_dir: str) -> None:
    """A lake root is either built in batch or maintained by streams: once a
    stream sink owns a folder, readers only see the files in its log, so
    batch-written layers would silently disappear."""
    for layer in ("bronze", "silver", "fct_results"):
        path = f"{lake_dir}/{layer}"
        has_files = any(n.endswith(".parquet") for n in fs.list_files(spark, path))
        if has_files and not fs.exists(spark, f"{path}/_spark_metadata"):
            raise ValueError(f"{path} was written in batch (build_lake); refresh needs its own lake folder")


def ingest_bronze(
    spark: SparkSession,
    landing_dir: str,
    lake_dir: str,
    max_files_per_trigger: int | None = 1000,
    archive_dir: str | None = None,
    glob: str = "*.csv",
) -> None:
    """Landed result files -> bronze (each file once per checkpoint); with
    ``archive_dir``, ingested files are moved out of the landing folder."""
    mkdirs(spark, landing_dir, f"{lake_dir}/bronze")
    bronze = read_results(
        spark, landing_dir, stream=True, glob=glob, max_files_per_trigger=max_files_per_trigger, archive_dir=archive_dir
    )
    append_stream(bronze, f"{lake_dir}/bronze", f"{lake_dir}/_checkpoints/bronze").awaitTermination()


def bronze_to_silver(spark: SparkSession, lake_dir: str, as_of_year: int | None = None, strict: bool = False) -> None:
    """New bronze rows -> cleaned silver rows."""
    mkdirs(spark, f"{lake_dir}/bronze", f"{lake_dir}/silver")
    bronze_in = spark.readStream.schema(BRONZE_SCHEMA).parquet(f"{lake_dir}/bronze")
    silver = clean_results(bronze_in, as_of_year=as_of_year, strict=strict)
    append_stream(silver, f"{lake_dir}/silver", f"{lake_dir}/_checkpoints/silver").awaitTermination()


def silver_to_fact(spark: SparkSession, lake_dir: str) -> None:
    """New silver rows -> fact rows."""
    mkdirs(spark, f"{lake_dir}/silver", f"{lake_dir}/fct_results")
    silver_in = spark.readStream.schema(silver_schema(spark)).parquet(f"{lake_dir}/silver")
    append_stream(fct_results(silver_in), f"{lake_dir}/fct_results", f"{lake_dir}/_checkpoints/fct_results").awaitTermination()


def refresh(
    spark: SparkSession,
    landing_dir: str,
    lake_dir: str,
    as_of_year: int | None = None,
    max_files_per_trigger: int | None = 1000,
    strict: bool = False,
    archive_dir: str | None = None,
    glob: str = "*.csv",
) -> Lake:
    """One pipeline run. Each hop only processes what its checkpoint has not
    seen, so a run that died part-way is completed by the next one."""
    # the rebuild runs over all history: size from what is landed plus what
    # bronze already holds (the landing folder alone may be archived away)
    _check_streamed(spark, lake_dir)
    with sized_shuffles(spark, landing_dir, f"{lake_dir}/bronze"):
        ingest_bronze(spark, landing_dir, lake_dir, max_files_per_trigger, archive_dir, glob)
        bronze_to_silver(spark, lake_dir, as_of_year, strict)
        silver_to_fact(spark, lake_dir)
        # the views are rebuilt only when the fact table moved on since the
        # published version was built (a run that adds nothing costs a
        # listing, not a rebuild; a run that died before its rebuild is
        # caught up by the next one)
        stamp = f"fact_batch={sink_batch_id(spark, f'{lake_dir}/fct_results')}"
        if current_version(spark, lake_dir) is None or current_stamp(spark, lake_dir) != stamp:
            build_views(spark, lake_dir, stamp=stamp)
    return open_lake(spark, lake_dir)
