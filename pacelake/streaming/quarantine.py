"""Malformed result rows set aside instead of silently losing their cells.

The reader keeps the raw text of a row that does not fit the schema. One stream
writes all rows into one table, partitioned by whether they are set aside: both
kinds of a micro-batch are committed together, exactly once. Readers of good rows
read one partition, the quarantine is the other, with the reason of each row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pacelake.schema import RENAME, SOURCE_SCHEMA
from pacelake.sources.sinks import append_stream, mkdirs

RAW = "_raw"
SHORT, LONG = "too few columns", "too many columns"
_TEXT_SCHEMA = T.StructType([T.StructField(f"c{i}", T.StringType(), True) for i in range(len(SOURCE_SCHEMA.fields) + 1)])
TABLE_SCHEMA = T.StructType(
    [
        *[T.StructField(RENAME.get(f.name, f.name), f.dataType, True) for f in SOURCE_SCHEMA.fields],
        T.StructField(RAW, T.StringType(), True),
        T.StructField("reason", T.StringType(), True),
        T.StructField("source_file", T.StringType(), True),
        T.StructField("ingest_ts", T.TimestampType(), True),
        T.StructField("set_aside", T.BooleanType(), True),
    ]
)


def reason_of(raw: Column) -> Column:
    """Why a raw row does not fit the source schema: its number of columns, or
    the first cell that is not of its column's type (NULL: it fits)."""
    cells = F.from_csv(raw, _TEXT_SCHEMA.simpleString()[len("struct<") : -1].replace(":", " "), {"mode": "PERMISSIVE"})
    n = F.size(F.split(F.regexp_replace(raw, '"[^"]*"', ""), ",", -1))
    fields = SOURCE_SCHEMA.fields
    reason = F.when(n < len(fields), F.lit(SHORT)).when(n > len(fields), F.lit(LONG))
    for i, f in enumerate(fields):
        if not isinstance(f.dataType, T.StringType):
            cell = F.trim(cells[f"c{i}"])
            reason = reason.when((cell != "") & cell.try_cast(f.dataType).isNull(), F.lit(f"bad {RENAME.get(f.name, f.name)}"))
    return F.when(raw.isNotNull(), F.coalesce(reason, F.lit("malformed")))


def read_marked(spark: SparkSession, path: str, stream: bool = False, max_files_per_trigger: int | None = None) -> DataFrame:
    """Result CSVs with ``_raw`` and ``reason`` of malformed rows (NULL for
    others), lineage and ``set_aside``."""
    schema = T.StructType([*SOURCE_SCHEMA.fields, T.StructField(RAW, T.StringType(), True)])
    reader = spark.readStream if stream else spark.read
    reader = reader.format("csv").schema(schema).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RAW)
    reader = reader.option("pathGlobFilter", "*.csv").option("recursiveFileLookup", "true")
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.load(path).withColumns({"source_file": F.col("_metadata.file_path"), "ingest_ts": F.current_timestamp()})
    rows = rows.withColumnsRenamed(RENAME).withColumn("reason", reason_of(F.col(RAW))).withColumn("set_aside", F.col(RAW).isNotNull())
    return rows.select(*TABLE_SCHEMA.fieldNames())


def ingest_marked(spark: SparkSession, landing_dir: str, table_dir: str, checkpoint: str, max_files_per_trigger: int | None = 1000) -> DataFrame:
    """Run the stream over what has landed since the last run; returns the table."""
    mkdirs(spark, landing_dir, table_dir)
    rows = read_marked(spark, landing_dir, stream=True, max_files_per_trigger=max_files_per_trigger)
    append_stream(rows, table_dir, checkpoint, partition_by=["set_aside"]).awaitTermination()
    return marked_rows(spark, table_dir)


def marked_rows(spark: SparkSession, table_dir: str) -> DataFrame:
    """The table of kept (``not set_aside``) and quarantined rows."""
    return spark.read.schema(TABLE_SCHEMA).parquet(table_dir)


def reconcile(spark: SparkSession, landing_dir: str, table: DataFrame) -> DataFrame:
    """Per landed file: rows in the file (read again, every cell as text), rows
    kept, rows set aside, and what is missing (0 when all are accounted for)."""
    landed = spark.read.option("header", True).option("pathGlobFilter", "*.csv").option("recursiveFileLookup", "true").schema(_TEXT_SCHEMA).csv(landing_dir)
    landed = landed.select(F.col("_metadata.file_path").alias("source_file")).groupBy("source_file").agg(F.count(F.lit(1)).alias("n_in"))
    seen = table.groupBy("source_file").agg(F.count_if(~F.col("set_aside")).alias("n_kept"), F.count_if("set_aside").alias("n_set_aside"))
    none = lambda x: F.coalesce(x, F.lit(0))
    both = landed.join(seen, "source_file", "full_outer")
    return both.select("source_file", *[none(x).alias(x) for x in ("n_in", "n_kept", "n_set_aside")], (none("n_in") - none("n_kept") - none("n_set_aside")).alias("n_missing"))
