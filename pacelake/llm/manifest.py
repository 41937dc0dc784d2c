"""Merkle manifest of a dataset and a proof for every row (operator 13).

A row's leaf is the SHA-256 of its fields. The leaves of a source, by id, are
hashed in runs of ``FAN`` until one node is left, the subroot; the subroots, by
source, likewise give the root.

Proofs are octopus multiproofs. The leaves are dealt out as ranges ("units").
A unit names the smallest set of nodes that its leaves' proofs need and that it
cannot derive itself, all of them are fetched in one join, the interior nodes
that its proofs share are derived once, and the proof of each leaf is expanded
from them where the leaf is. Texts never leave the scan: only hashes move.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pacelake.llm.common import crc_bucket, documents, written

FAN = 16
UNIT = 32_768  # leaves of a unit at most
TOP = -1  # the tree of the subroots; a source's tree is its rank
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
A_Z, a_z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_hash(**values: Column) -> Column:
    """SHA-256 (hex) of the fields: ``-`` for a null, else UTF-8 byte count,
    ``:`` and value."""
    texts = {k: values.get(k, F.col(k)).cast("string") for k in FIELDS}
    parts = [F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts.values()]
    return F.sha2(F.concat(*parts), 256)


def lower_tampered(docs: DataFrame) -> Column:
    """The text after tampering: A-Z lower-cased where 5 divides the id's crc32."""
    return F.when(crc_bucket("doc_id", 5) == 0, F.translate(F.col("text").cast("string"), A_Z, a_z))


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def missing(first: int, last: int, n: int) -> list[tuple[int, int]]:
    """The least set of (level, index) of nodes that the proofs of the leaves
    first..last of a tree of n leaves need and those leaves cannot give."""
    out, level = [], 0
    while n > 1:
        start, end = first // FAN * FAN, min(n, (last // FAN + 1) * FAN)
        out += [(level, i) for i in (*range(start, first), *range(last + 1, end))]
        first, last, n, level = first // FAN, last // FAN, -(-n // FAN), level + 1
    return out


def climb(own: list[str], first: int, n: int, fetched: dict[tuple[int, int], str]) -> tuple[list[tuple[int, list[str]]], str]:
    """Per level (index of the first node, nodes of all runs that the leaves
    touch), and the tree's root: own nodes, fetched ones and what they give."""
    levels, level = [], 0
    while n > 1:
        last = first + len(own) - 1
        start, end = first // FAN * FAN, min(n, (last // FAN + 1) * FAN)
        runs = [*(fetched[level, i] for i in range(start, first)), *own, *(fetched[level, i] for i in range(last + 1, end))]
        levels.append((start, runs))
        own = [_sha("".join(runs[i : i + FAN])) for i in range(0, len(runs), FAN)]
        first, n, level = first // FAN, -(-n // FAN), level + 1
    return levels, own[0]


def _run(level: tuple[int, list[str]], index: int) -> tuple[list[str], int]:
    """The run that holds a node, and the node's place in it."""
    start, nodes = level
    at = (index - start) // FAN * FAN
    return nodes[at : at + FAN], index - start - at


def siblings(levels: list[tuple[int, list[str]]], index: int) -> str:
    """A leaf's siblings, level by level, left to right."""
    out = []
    for level in levels:
        run, place = _run(level, index)
        out += run[:place] + run[place + 1 :]
        index //= FAN
    return "".join(out)


def fold(node: str, levels: list[tuple[int, list[str]]], index: int) -> str:
    """The root that a leaf's hash and the siblings of its place give."""
    for level in levels:
        run, place = _run(level, index)
        node = _sha("".join([*run[:place], node, *run[place + 1 :]]))
        index //= FAN
    return node


@dataclass
class Manifest:
    """Written tables of a manifest.

    leaves: unit, key, at (place within unit and key), id, leaf, tampered
    segments: unit, key, tree, first (leaf index), n, total (leaves of the tree)
    nodes: tree, level, idx, node, left (nodes of that level); level 0 only where
        a unit's neighbour needs it
    """

    leaves: DataFrame
    segments: DataFrame
    nodes: DataFrame
    subroots: DataFrame
    root: str


def _numbered(rows: DataFrame) -> DataFrame:
    """Unit and place of every row of sorted range partitions."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done, last, run = TaskContext.get().partitionId(), 0, None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            key = batch.column("key").to_numpy(zero_copy_only=False)
            unit = (part << 32) + (done + np.arange(n)) // UNIT
            new = np.concatenate([[(unit[0], key[0]) != last], (key[1:] != key[:-1]) | (unit[1:] != unit[:-1])]).astype(bool)
            place = np.arange(n)
            begin = np.maximum.accumulate(np.where(new, place, -1))
            at = np.where(begin < 0, run + place, place - begin)
            done, last, run = done + n, (unit[-1], key[-1]), int(at[-1]) + 1
            yield pa.RecordBatch.from_arrays([pa.array(unit), pa.array(at.astype(np.int32)), *batch.columns], names=["unit", "at", *batch.schema.names])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(work, f"unit long, at int, {kinds}")


def _parents(nodes: DataFrame) -> DataFrame:
    """The next level of all trees that have more than one node in this one."""
    up = nodes.where("left > 1").groupBy("tree", "level", F.expr(f"idx div {FAN}").alias("idx"), "left").agg(F.sort_array(F.collect_list(F.struct(F.col("idx").alias("i"), "node"))).alias("run"))
    text = F.array_join(F.transform("run", lambda x: F.lower(F.hex(x["node"]))), "")
    return up.select("tree", (F.col("level") + 1).alias("level"), "idx", F.unhex(F.sha2(text, 256)).alias("node"), F.expr(f"(left + {FAN - 1}) div {FAN}").alias("left"))


def _levels(leaves: DataFrame, most: int) -> list[DataFrame]:
    """The levels above the leaves of trees of at most ``most`` leaves."""
    out = []
    while most > 1:
        leaves = written(_parents(leaves), "manifest-level")
        out.append(leaves)
        most = -(-most // FAN)
    return out


def manifest(docs: DataFrame, tampered: Column | None = None) -> Manifest | None:
    """Leaves, nodes and root of documents (doc_id, source, lang, n_chars,
    text); None for an empty table.

    Null fields are hashed as ``-``. Leaves ascend by id, null ids first, rows of
    the same id by leaf hash; a null source is the first source. Repeated rows
    are leaves of their own. Extra columns are ignored. ``tampered`` is another
    text whose leaf is kept beside the original (null: none).
    """
    text = F.lit(None).cast("string") if tampered is None else tampered
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("key"),
        F.col("doc_id").alias("id"),
        F.unhex(leaf_hash()).alias("leaf"),
        F.unhex(F.when(text.isNotNull(), leaf_hash(text=text))).alias("tampered"),
    )
    rows = written(rows, "manifest-hashes")  # dealing out by ranges reads its input twice
    ordered = rows.repartitionByRange("key", "id", "leaf").sortWithinPartitions("key", "id", "leaf")
    leaves = written(_numbered(ordered), "manifest-leaves")
    own = Window.partitionBy("key")
    counts = leaves.groupBy("unit", "key").agg(F.count(F.lit(1)).alias("n"))
    placed = counts.select(
        "unit", "key", "n", F.coalesce(F.sum("n").over(own.orderBy("unit").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"), F.sum("n").over(own).alias("total")
    )
    placed = written(placed, "manifest-segments")
    # ranks of the sources: units are in order, so a running sum over units (not rows) suffices
    begins = F.when(F.col("first") == 0, 1).otherwise(0)
    units = placed.groupBy("unit").agg(F.sum(begins).alias("begin"))
    units = units.select("unit", F.coalesce(F.sum("begin").over(Window.orderBy("unit").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    ranked = placed.join(units, "unit").withColumn("tree", F.col("before") + F.sum(begins).over(Window.partitionBy("unit").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)) - 1)
    segments = written(ranked.drop("before"), "manifest-segments")
    most, sources = segments.agg(F.max("total"), F.max("tree") + 1).first()
    if most is None:
        return None
    at = leaves.select("unit", "key", "at", "leaf").join(segments, ["unit", "key"])
    index = F.col("first") + F.col("at")
    end = F.col("first") + F.col("n")
    level0 = at.select("tree", F.lit(0).alias("level"), index.alias("idx"), F.col("leaf").alias("node"), F.col("total").alias("left"), "first", end.alias("end"))
    # leaves of runs that reach into a neighbour: all that another unit can ask for
    shared = (F.expr(f"idx div {FAN} = first div {FAN}") & (F.col("first") % FAN != 0)) | (F.expr(f"idx div {FAN} = end div {FAN}") & (F.col("end") % FAN != 0) & (F.col("end") < F.col("left")))
    edges = written(level0.where(shared).drop("first", "end"), "manifest-edges")
    trees = _levels(level0.drop("first", "end"), most)
    lone = level0.where("left = 1").drop("first", "end")
    subroots = reduce(DataFrame.union, [x.where("left = 1") for x in trees], lone)
    subroots = written(subroots.select("tree", "node"), "manifest-subroots")
    top = subroots.select(F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("idx"), "node", F.lit(sources).cast("long").alias("left"))
    tops = _levels(top, sources)
    nodes = reduce(DataFrame.union, [edges, *trees, top, *tops])
    root = bytes((tops[-1] if tops else top).first()["node"]).hex()
    return Manifest(leaves, segments, nodes, subroots, root)


def fetched(m: Manifest) -> DataFrame:
    """(unit, tree, level, idx, node): what each unit's proofs are missing."""
    spans = m.segments.select("unit", "tree", "first", (F.col("first") + F.col("n") - 1).alias("last"), "total")
    sources = m.segments.agg((F.max("tree") + 1).alias("total"))
    tops = m.segments.groupBy("unit").agg(F.lit(TOP).cast("long").alias("tree"), F.min("tree").alias("first"), F.max("tree").alias("last"))
    spans = spans.union(tops.select("*", sources.scalar()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(u, t, *x) for u, t, a, b, n in zip(*(c.to_pylist() for c in batch.columns)) for x in missing(a, b, n)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int64()))], names=["unit", "tree", "level", "idx"])

    wanted = spans.mapInArrow(work, "unit long, tree long, level int, idx long")
    return wanted.join(m.nodes.drop("left"), ["tree", "level", "idx"]).select("unit", "tree", "level", "idx", "node")


def proofs(m: Manifest, with_siblings: bool = False) -> DataFrame:
    """Per leaf: doc_id, leaf, subroot, root, proof_sha256, folded_root and
    verified; ``with_siblings`` adds the proof itself (concatenated hex of the
    siblings, level by level). Where a leaf has a tampered hash, the root is
    folded from that one. A tree of one leaf has no siblings."""
    none = lambda kind: F.lit(None).cast(kind)
    got = fetched(m).select("unit", "tree", "level", "idx", "node", none("string").alias("key"), none("long").alias("total"))
    spans = m.segments.join(m.subroots, "tree").select("unit", "tree", F.lit(-1).alias("level"), F.col("first").alias("idx"), "node", "key", "total")
    sources = m.segments.agg((F.max("tree") + 1).alias("total"))
    tops = m.segments.groupBy("unit").agg(F.lit(TOP).cast("long").alias("tree"), F.min("tree").alias("idx")).select(
        "unit", "tree", F.lit(-1).alias("level"), "idx", F.unhex(F.lit(m.root)).alias("node"), none("string").alias("key"), sources.scalar().alias("total")
    )
    info = got.union(spans).union(tops)

    def expand(leaves: pa.Table, info: pa.Table) -> pa.Table:
        given: dict[int, dict[tuple[int, int], str]] = {}
        spans, top = {}, None
        for tree, level, idx, node, key, total in zip(*(info.column(c).to_pylist() for c in ("tree", "level", "idx", "node", "key", "total"))):
            if level >= 0:
                given.setdefault(tree, {})[level, idx] = node.hex()
            elif tree == TOP:
                top = idx, total, node.hex()
            else:
                spans[key] = tree, idx, total, node.hex()
        leaves = leaves.sort_by([("key", "ascending"), ("at", "ascending")])
        keys = leaves.column("key").to_pylist()
        own, other = ([None if x is None else x.hex() for x in leaves.column(c).to_pylist()] for c in ("leaf", "tampered"))
        cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
        climbed = []
        for a, b in zip(cuts, cuts[1:]):
            tree, first, total, subroot = spans[keys[a]]
            climbed.append((a, b, tree, first, subroot, *climb(own[a:b], first, total, given.get(tree, {}))))
        climbed.sort(key=lambda x: x[2])
        first_rank, sources, root = top
        top_levels, derived = climb([x[-1] for x in climbed], first_rank, sources, given.get(TOP, {}))
        n = len(own)
        subroots, digests, folded, texts = [""] * n, [""] * n, [""] * n, [""] * n
        for a, b, tree, first, subroot, levels, _ in climbed:
            above = siblings(top_levels, tree)
            rest: dict[int, str] = {}  # what the leaves of a run share
            for i in range(a, b):
                index = first + i - a
                if levels:
                    run, place = _run(levels[0], index)
                    if index // FAN not in rest:
                        rest[index // FAN] = siblings(levels[1:], index // FAN) + above
                    proof = "".join(run[:place]) + "".join(run[place + 1 :]) + rest[index // FAN]
                else:
                    proof = above
                subroots[i], digests[i] = subroot, _sha(proof)
                folded[i] = derived if other[i] is None or other[i] == own[i] else fold(fold(other[i], levels, index), top_levels, tree)
                texts[i] = proof if with_siblings else ""
        columns = [leaves.column("id"), pa.array(own), pa.array(subroots), pa.array([root] * n), pa.array(digests), pa.array(folded), pa.array([x == root for x in folded])]
        names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
        return pa.Table.from_arrays([*columns, *([pa.array(texts)] if with_siblings else [])], names=[*names, *(["siblings"] if with_siblings else [])])

    kind = m.leaves.schema["id"].dataType.simpleString()
    schema = _schema(kind) + (", siblings string" if with_siblings else "")
    info = written(info, "manifest-fetched")
    return m.leaves.groupBy("unit").cogroup(info.groupBy("unit")).applyInArrow(expand, schema)


def _schema(kind: str) -> str:
    return f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def tamper_report(docs: DataFrame) -> DataFrame:
    """Proofs of all rows, folded from tampered texts where 5 divides the id's
    crc32 (a null id or text is not tampered); no rows for an empty table."""
    m = manifest(docs, lower_tampered(docs))
    if m is None:
        return docs.sparkSession.createDataFrame([], _schema(docs.schema["doc_id"].dataType.simpleString()))
    return proofs(m)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle manifest of all documents, with the proof of every document."""
    return tamper_report(documents(spark, sf_dir))
