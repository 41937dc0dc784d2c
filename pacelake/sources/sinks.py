"""Sinks: result-file drops, stream sinks, and versioned materialised tables."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pacelake.schema import BRONZE_COLUMNS, SOURCE_HEADERS
from pacelake.sources import fs


GZIPPED_ROWS = 500_000
#: File names of result files, gzipped ones included.
ANY_RESULTS = "{*.csv,*.csv.gz}"


def drop_batch(
    df: DataFrame, landing_dir: str, run_name: str, single_file: bool = False, replace: bool = False, gzipped: bool = False
) -> str:
    """Land result rows as CSV with the source header, in their own run folder.

    The column order is pinned to the source order because readers match
    columns by position. A batch keeps its partitions, a file each;
    ``single_file`` merges it into one file by one task, which is only meant
    for small drops such as one event's finishers. Values are written as they are (no whitespace
    trimming), so the file is exactly what a producer would send.
    A run folder is written once: re-using a run name is an error unless
    ``replace`` is set, because rewritten files get new names and a stream
    that already ingested the old ones would ingest the rows again.
    ``gzipped`` lands ``.csv.gz`` files (a quarter of the bytes); a task reads
    such a file as a whole, so they have at most ``GZIPPED_ROWS`` rows.
    Returns the folder written.
    """
    out = f"{landing_dir.rstrip('/')}/{run_name}"
    rows = df.select(*[df[c].alias(h) for c, h in zip(BRONZE_COLUMNS, SOURCE_HEADERS)])
    if single_file:
        # behind a shuffle: only the write is one task, not the joins before it
        rows = rows.repartition(1)
    w = rows.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    if gzipped:
        w = w.option("compression", "gzip")
        if not single_file:
            w = w.option("maxRecordsPerFile", GZIPPED_ROWS)
    w.mode("overwrite" if replace else "errorifexists").csv(out)
    return out


def append_stream(
    df: DataFrame, path: str, checkpoint: str, name: str | None = None, partition_by: Sequence[str] = ()
) -> StreamingQuery:
    """Append a stream to a parquet folder, exactly once per input file.

    Runs as a triggered job (``availableNow``): it processes everything that
    arrived since the last run, in bounded micro-batches, then stops.
    """
    w = (
        df.writeStream.format("parquet")
        .option("compression", "zstd")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if partition_by:
        w = w.partitionBy(*partition_by)
    if name:
        w = w.queryName(name)
    return w.start()


# --- versioned materialised tables -----------------------------------------------------
# A refresh writes every recomputed table into a new version folder and then
# publishes the version name in a small pointer file, so readers never see a
# half-rewritten table.

POINTER = "_CURRENT"


def new_version() -> str:
    """Sortable by creation time (zero-padded epoch milliseconds first)."""
    return f"v_{int(time.time() * 1000):015d}_{uuid.uuid4().hex[:8]}"


def publish_version(spark: SparkSession, root: str, version: str, stamp: str = "") -> None:
    """Point readers at ``version``; ``stamp`` records what it was built from."""
    fs.write_small_text(spark, f"{root}/{POINTER}", f"{version} {stamp}".strip())


def _pointer(spark: SparkSession, root: str) -> list[str]:
    text = fs.read_small_text(spark, f"{root}/{POINTER}")
    return text.split(" ", 1) if text else []


def current_version(spark: SparkSession, root: str) -> str | None:
    p = _pointer(spark, root)
    return p[0] if p else None


def current_stamp(spark: SparkSession, root: str) -> str | None:
    p = _pointer(spark, root)
    return p[1] if len(p) > 1 else None


def sink_batch_id(spark: SparkSession, path: str) -> int | None:
    """Last batch committed by a streaming file sink (from its metadata log)."""
    ids = [
        int(n.split(".")[0])
        for n in fs.list_files(spark, f"{path}/_spark_metadata")
        if n.split(".")[0].isdigit()
    ]
    return max(ids) if ids else None


def prune_versions(spark: SparkSession, root: str, versions_dir: str, keep: int = 2) -> list[str]:
    """Delete version folders that were made before the published one, except
    the ``keep - 1`` newest of them.

    What the pointer names, and everything newer (another builder's folder that
    is not published yet), stays. The default also keeps the version before the
    published one, so a reader that opened it just before the swap can finish.
    Without a published version nothing is deleted. Returns the names deleted.
    """
    published = current_version(spark, root)
    if published is None:
        return []
    older = [n for n in fs.list_dirs(spark, versions_dir) if n.startswith("v_") and n < published]
    doomed = older[: max(0, len(older) - max(0, keep - 1))]
    for name in doomed:
        fs.delete(spark, f"{versions_dir}/{name}")
    return doomed


def mkdirs(spark: SparkSession, *paths: str) -> None:
    fs.mkdirs(spark, *paths)
