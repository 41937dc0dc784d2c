"""Benchmark decontamination (operator 12): DataFrame functions only.

A window is ``WINDOW`` consecutive words of a benchmark item (a shorter item is
one window). A document contains a window when its words stand there in a row.
The join is a prefix-filtered set join on word shingles:

1. The shingles of all windows are looked up in the documents; only their
   occurrences are kept and counted.
2. Shingles are ordered by rarity. Containment needs every shingle of a window,
   so the first in that order, its rarest, is the prefix that a document must
   hold; a window with a shingle that occurs nowhere is out.
3. An occurrence of a prefix fixes where the window would start: it must start
   and end inside the document (positional and length bounds).
4. What is left is verified over the window's whole span: every shingle of the
   window must stand at its place in the document.

Texts are read once, and only occurrences are shuffled. Shingles are compared by
64-bit hashes; a window of ten words is equal in six of them, one by one place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pacelake.llm.common import documents, written
from pacelake.sources.tables import read_table

WINDOW = 10
SHINGLE = 5
PRESENT = 0  # stands for a row itself among its shingles
#: What separates words once A-Z are lower-cased.
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
A_Z, a_z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words of a text (null: none), A-Z lower-cased."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    # Spark's lower is fast, and on ASCII it is the same
    low = F.when(F.octet_length(t) == F.char_length(t), F.lower(t)).otherwise(F.translate(t, A_Z, a_z))
    return F.array_remove(F.split(low, SEPARATOR), "")


def shingle_hashes(of: Column, size: int) -> Column:
    """64-bit hashes of all runs of ``size`` words, in order."""
    runs = F.transform(F.sequence(F.lit(0), F.size(of) - size), lambda i: F.xxhash64(F.lit(size), *[F.get(of, i + k) for k in range(size)]))
    return F.when(F.size(of) >= size, runs).otherwise(F.array().cast("array<bigint>"))


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id text, wtext, len, size): every window of every item with words.
    Items without id are one item with an empty id."""
    own = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), words(F.col("text")).alias("w")).where(F.size("w") > 0)
    own = own.withColumn("len", F.least(F.size("w"), F.lit(window)))
    cut = F.transform(F.sequence(F.lit(1), F.size("w") - F.col("len") + 1), lambda j: F.array_join(F.slice("w", j, F.col("len")), " "))
    return own.select("item_id", "len", F.least("len", F.lit(min(SHINGLE, window))).alias("size"), F.explode(cut).alias("wtext")).distinct()


def _occurrences(rows: DataFrame, tokens: DataFrame, sizes: list[int]) -> DataFrame:
    """(doc_id, row_key, n_words, pos, token): where a document has one of the
    tokens, and once per row, at place -1, the token ``PRESENT`` that all rows
    have. The tokens are a written table, so Spark knows their size and
    broadcasts them, or shuffles behind a runtime filter."""
    split = rows.select("doc_id", "row_key", words(F.col("text")).alias("w"))
    per_size = []
    for k, size in enumerate(sizes):
        hashes = shingle_hashes(F.col("w"), size)
        if k == 0:
            hashes = F.concat(F.array(F.lit(PRESENT)), hashes)
        runs = split.select("doc_id", "row_key", F.size("w").alias("n_words"), F.posexplode(hashes).alias("pos", "token"))
        per_size.append(runs.join(tokens, "token").withColumn("pos", F.col("pos") - (1 if k == 0 else 0)))
    return reduce(DataFrame.unionByName, per_size)


def prefixes(windows: DataFrame, found: DataFrame) -> DataFrame:
    """(token, at, wtext, len): per distinct window its rarest shingle and the
    shingle's place in it; windows with a shingle that is nowhere are left out."""
    rarity = found.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    listed = windows.select("wtext", "len", F.posexplode("tokens").alias("at", "token")).join(rarity, "token", "left")
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "at")).alias("rarest")
    picked = listed.groupBy("wtext", "len").agg(rarest).where("rarest.n > 0")
    return picked.select("rarest.token", "rarest.at", "wtext", "len")


def _hit_words(spans: Column) -> Column:
    """Number of places that the spans (start, len, ..) cover."""
    merged = F.aggregate(
        F.array_sort(spans),
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda a, s: F.struct(
            F.greatest(a["end"], s["start"] + s["len"]).alias("end"),
            (a["n"] + F.greatest(F.lit(0), s["start"] + s["len"] - F.greatest(a["end"], s["start"]))).alias("n"),
        ),
    )
    return merged["n"]


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_words, n_hit, n_items,
    items_sha256, contaminated, for items (item_id, text).

    Null and empty texts have no words, items without words no window. Repeated
    rows and rows of the same id get a result each, items of the same id count
    once. Extra columns are ignored. Without documents there are no rows, without
    items no hits.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.xxhash64("doc_id", "text").alias("row_key"))
    windows = written(item_windows(items, window), "windows")
    sizes = sorted(r[0] for r in windows.select("size").distinct().collect())  # SHINGLE values at most
    w = F.split("wtext", " ")
    tokens = reduce(lambda c, s: F.when(F.col("size") == s, shingle_hashes(w, s)).otherwise(c), sizes, F.array().cast("array<bigint>"))
    distinct = written(windows.select("wtext", "len", "size").distinct().select("wtext", "len", tokens.alias("tokens")), "windows")
    known = distinct.select(F.explode("tokens").alias("token")).union(spark.range(1).select(F.lit(PRESENT).cast("long"))).distinct()
    known = written(known, "tokens")
    seen = written(_occurrences(rows, known, sizes or [SHINGLE]), "occurrences")
    found = written(seen.where("pos >= 0").distinct(), "occurrences")
    prefix = written(prefixes(distinct, found), "prefixes")
    start = F.col("pos") - F.col("at")
    inside = (start >= 0) & (start + F.col("len") <= F.col("n_words"))
    asked = found.join(prefix, "token").where(inside).select("doc_id", "row_key", start.alias("start"), "wtext", "len")
    parts = asked.join(distinct.select("wtext", "tokens"), "wtext").select("doc_id", "row_key", "start", "wtext", "len", F.size("tokens").alias("n"), F.posexplode("tokens").alias("k", "token"))
    there = found.select(F.col("doc_id").alias("_id"), F.col("row_key").alias("_key"), F.col("pos").alias("_pos"), F.col("token").alias("_token"))
    here = lambda df: (F.col("row_key") == df["_key"]) & F.col("doc_id").eqNullSafe(df["_id"])
    at_place = here(there) & (F.col("start") + F.col("k") == there["_pos"]) & (F.col("token") == there["_token"])
    held = parts.join(there, at_place, "left_semi").groupBy("doc_id", "row_key", "start", "wtext", "len", "n").agg(F.count(F.lit(1)).alias("equal")).where("equal = n")
    verified = written(held.select("doc_id", "row_key", "start", "len", "wtext"), "verified")
    named = lambda df, *cols: df.select(F.col("doc_id").alias("_id"), F.col("row_key").alias("_key"), *cols)
    hits = named(verified.groupBy("doc_id", "row_key").agg(F.collect_set(F.struct("start", "len")).alias("spans")), _hit_words(F.col("spans")).cast("long").alias("n_hit"))
    which = verified.select("doc_id", "row_key", "wtext").distinct().join(windows.select("wtext", "item_id"), "wtext")
    listed = which.groupBy("doc_id", "row_key").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    listed = named(listed, F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("sha"))
    results = hits.join(listed, (hits["_key"] == listed["_key"]) & hits["_id"].eqNullSafe(listed["_id"])).select(hits["_id"], hits["_key"], "n_hit", "n_items", "sha")
    results = written(results, "contaminated")
    none = F.lit(0).cast("long")
    return seen.where("pos < 0").join(results, here(results), "left").select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.coalesce("n_hit", none).alias("n_hit"), F.coalesce("n_items", none).alias("n_items"),
        F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"),
    )


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in all documents."""
    return contamination(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


ORACLE_SQL = r"""
WITH cut AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), item AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL
), win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS l, array_to_string(w[j : j + least(10, len(w)) - 1], ' ') AS t
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS j FROM item WHERE len(w) > 0)
), lengths AS (SELECT DISTINCT l FROM win
), place AS (
  SELECT doc_id, l, j, array_to_string(w[j : j + l - 1], ' ') AS t
  FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS j FROM cut, lengths WHERE len(w) >= l)
), hit AS (SELECT p.doc_id, p.l, p.j, win.item_id FROM place p JOIN win ON p.l = win.l AND p.t = win.t
), hit_words AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(j, j + l)) AS k FROM (SELECT DISTINCT doc_id, l, j FROM hit)) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(i, ',' ORDER BY i)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM cut LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""
