"""Result files (CSV with a header row) as batch or streaming DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pacelake.schema import FEED_SCHEMA, RENAME, SOURCE_SCHEMA

# Bronze = the 13 renamed source columns plus row lineage.
BRONZE_SCHEMA = T.StructType(
    FEED_SCHEMA.fields
    + [
        T.StructField("source_file", T.StringType(), True),
        T.StructField("ingest_ts", T.TimestampType(), True),
    ]
)


def read_results(
    spark: SparkSession,
    path: str,
    stream: bool = False,
    glob: str = "*.csv",
    recursive: bool = True,
    check_header: bool = False,
    lineage: bool = True,
    max_files_per_trigger: int | None = None,
    archive_dir: str | None = None,
) -> DataFrame:
    """Read result CSVs with the fixed source schema.

    Columns are matched by position (the files' header row is skipped), so a
    file with other columns is read wrongly without an error unless
    ``check_header`` is set, which makes Spark fail on a header that does not
    name the schema's columns. Cells that do not parse as their type become
    NULL and short rows are NULL-padded (PERMISSIVE mode).

    stream: an unbounded file stream; each file is read once per checkpoint,
        so re-running a query only picks up files that arrived since.
    lineage: adds ``source_file`` (the file's path) and ``ingest_ts``.
    archive_dir: (streams) move each file there once its batch is committed,
        so the landing folder – listed on every trigger – stays small.
    """
    reader = spark.readStream if stream else spark.read
    reader = (
        reader.format("csv")
        .schema(SOURCE_SCHEMA)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", str(recursive).lower())
        .option("enforceSchema", str(not check_header).lower())
    )
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if stream and archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    df = reader.load(path)
    if lineage:
        df = df.withColumns(
            {"source_file": F.col("_metadata.file_path"), "ingest_ts": F.current_timestamp()}
        )
    return df.withColumnsRenamed(RENAME)


def read_results_text(spark: SparkSession, path: str) -> DataFrame:
    """Header-only read: every column a string, names from the file (quick look
    at a landed file before its types are trusted)."""
    return spark.read.option("header", True).csv(path)
