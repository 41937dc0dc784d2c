"""Token counts by a separator scan of flat token files (operator 8).

A flat file holds nothing but token ids, all of the same width, with an
end-of-document id after every document: no index, no lengths, no names. Files
are cut into blocks that tasks search for the end id by one vectorised
comparison. A prefix scan over the blocks of a file (running sums of ids and of
ends, running maximum of the last end) says where the document that a block
begins in the middle of has started, and so stitches documents that span
blocks, however many. Sums over the files' totals give places in the whole
stream.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pacelake.llm.common import documents, ship, written
from pacelake.llm.text import slices
from pacelake.llm.tokens import PieceEncoder, default_tokenizer
from pacelake.session import scratch_path

END_ID = 50256
WIDTH = 2  # bytes of an id
BLOCK = 1 << 20  # bytes of a block, a multiple of the width
FILE_DOCS = 4000  # documents of a file

_PLAIN: dict[str, PieceEncoder] = {}


def _encoder(path: str) -> PieceEncoder:
    """The worker's encoder that reads special tokens' texts as ordinary text:
    no document may hold the end id."""
    if path not in _PLAIN:
        encoder = PieceEncoder(path)
        encoder.tokenizer.encode_special_tokens = True
        encoder.special = []
        _PLAIN[path] = encoder
    return _PLAIN[path]


def write_flat(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID) -> None:
    """Encode documents (text) in their order in the input and write flat files
    of little-endian 16-bit ids; every document is closed by the end id, a null
    or empty one is the end id alone. Spark's text writer puts the end id
    between the rows' bytes."""
    ship(docs.sparkSession)
    model = tokenizer or default_tokenizer()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, offsets = encoder.encode(part.column("text"))
                if len(ids) and (ids.max() > 0xFFFF or (ids == end_id).any()):
                    raise ValueError("ids need 16 bits and must differ from the end id")
                raw = ids.astype("<u2").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer((offsets * WIDTH).astype(np.int32)), pa.py_buffer(raw)])], names=["value"]
                )

    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(encode, "value binary")
    end = end_id.to_bytes(WIDTH, "little").decode("latin-1")
    rows.select(F.col("value").cast("string")).write.options(lineSep=end, encoding="ISO-8859-1", maxRecordsPerFile=FILE_DOCS).text(path)


def count_tokens(spark: SparkSession, path: str, end_id: int = END_ID, width: int = WIDTH, block: int = BLOCK) -> DataFrame:
    """(file, doc, start, n_tokens, ended) of every document in flat files:
    the file's number in the order of names, the document's number in the file,
    the place of its first id in the whole stream and its number of ids with
    the end id. Ids after a file's last end id make a last row with ``ended``
    false. Empty files give no rows."""
    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "[!_.]*").load(path).where("length > 0")
    size = F.floor(F.col("length") / width).cast("long")
    # names and sizes only: the content is not read here
    listed = files.select("path", size.alias("ids"))
    order = W.orderBy("path")
    named = written(listed.select("path", (F.row_number().over(order) - 1).alias("file"), F.coalesce(F.sum("ids").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("base"), "ids"), "files")
    cut = files.select("path", F.posexplode(F.sequence(F.lit(0), F.floor((F.col("length") - 1) / block))).alias("block", "b"), "content")
    cut = cut.select("path", "block", F.expr(f"substring(content, int(block) * {block} + 1, {block})").alias("bytes"))
    kind = f"<u{width}"

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, ends = [], []
            for raw in batch.column("bytes"):
                ids = np.frombuffer(raw.as_buffer(), kind, count=len(raw.as_buffer()) // width)
                n.append(len(ids))
                ends.append(np.flatnonzero(ids == end_id).astype("<i8"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("path"), batch.column("block"), pa.array(n, pa.int64()), pa.array([len(e) for e in ends], pa.int64()),
                    pa.array([int(e[-1]) if len(e) else None for e in ends], pa.int64()), pa.array([e.tobytes() for e in ends], pa.binary()),
                ],
                names=["path", "block", "n", "n_ends", "last", "ends"],
            )

    blocks = written(cut.mapInArrow(search, "path string, block int, n long, n_ends long, last long, ends binary"), "blocks")
    before = W.partitionBy("path").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    scan = blocks.withColumn("ids_before", F.coalesce(F.sum("n").over(before), F.lit(0))).withColumn("docs_before", F.coalesce(F.sum("n_ends").over(before), F.lit(0)))
    scan = scan.withColumn("begun", F.coalesce(F.max(F.col("ids_before") + F.col("last") + 1).over(before), F.lit(0)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ends = np.frombuffer(r["ends"], "<i8") + r["ids_before"]
                starts = np.concatenate([[r["begun"]], ends[:-1] + 1])[: len(ends)]
                k = len(ends)
                yield pa.RecordBatch.from_arrays([pa.array([r["path"]] * k, pa.string()), pa.array(r["docs_before"] + np.arange(k)), pa.array(starts, pa.int64()), pa.array(ends - starts + 1)], names=["path", "doc", "at", "n_tokens"])

    found = scan.select("path", "ids_before", "docs_before", "begun", "ends").mapInArrow(place, "path string, doc long, at long, n_tokens long")
    rest = blocks.groupBy("path").agg(F.sum("n_ends").alias("doc"), F.max("block").alias("top"))
    open_end = scan.groupBy("path").agg(F.max(F.greatest(F.col("begun"), F.coalesce(F.col("ids_before") + F.col("last") + 1, F.lit(0)))).alias("at"))
    rest = rest.join(open_end, "path").join(named.select("path", "ids"), "path").where("at < ids")
    rest = rest.select("path", "doc", "at", (F.col("ids") - F.col("at")).alias("n_tokens"), F.lit(False).alias("ended"))
    rows = found.withColumn("ended", F.lit(True)).union(rest)
    return rows.join(named.select("path", "file", "base"), "path").select("file", "doc", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ended")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents as flat token files and count by scanning them."""
    path = scratch_path(spark, "llm", "flat")
    write_flat(documents(spark, sf_dir), path)
    return count_tokens(spark, path)
