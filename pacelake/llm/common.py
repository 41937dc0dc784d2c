"""Helpers shared by the operators: inputs, written intermediate tables,
ranges of document ids, and components of a graph of links."""

from __future__ import annotations

import gc
import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pacelake.session import scratch_path
from pacelake.sources.tables import read_table

WORD = r"[^\x20\x09-\x0D]+"


_SHIPPED: set[str] = set()

ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 1_900_000  # just below the least bytes of text that tasks work on at a time


def ship(spark: SparkSession) -> None:
    """Send this package's code to the Python workers, once per application,
    by Spark's own file distribution. Where the session does not say how large
    the batches sent to them may be, they end at ``BATCH_BYTES``: 10,000 whole
    texts take tens of MB, in the executor and again in the worker."""
    if spark.conf.get(ARROW_BYTES, None) is None:
        spark.conf.set(ARROW_BYTES, str(BATCH_BYTES))
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="pacelake-code-"), "pacelake_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return read_table(spark, sf_dir, "documents")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: the lineage ends here,
    and a lost executor recomputes nothing before it."""
    path = scratch_path(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tidy(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of steps whose results are written:
    its cleaner does so once the driver has collected their plans, which an
    idle driver does rarely."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def crc_bucket(column: str, n: int) -> Column:
    """crc32 of an id's decimal text, modulo n (the held-out rule)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(node, component) of the graph of links (a, b): component is the
    smallest node reachable. Nodes without links are not listed.

    Each round takes the smallest label among a node's neighbours, then the
    label of that label, so the rounds grow with the logarithm of the longest
    path. Rows are joined and aggregated (partial minimum first); no group of
    neighbours is ever gathered. Links of a node to itself count as none.
    """
    both = written(
        edges.where("a <> b").select("a", "b").union(edges.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "links",
    )
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")), "labels")
    for _ in range(max_rounds):
        near = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        step = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("best"))
        jump = labels.select(F.col("node").alias("best"), F.col("label").alias("further"))
        new = written(
            step.join(jump, "best", "left").select(
                "node", F.least("best", F.coalesce("further", "best")).alias("next"), "label"
            ),
            "labels",
        )
        changed = new.where("next < label").limit(1).count()
        labels = new.select("node", F.col("next").alias("label"))
        if not changed:
            return labels.select("node", F.col("label").alias("component"))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
