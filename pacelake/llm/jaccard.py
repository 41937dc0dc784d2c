"""N-gram Jaccard self-join by multiple-global-order prefix filtering
(operator 5).

A document is its set of distinct word shingles; two documents link when the
Jaccard similarity of their sets reaches ``num / den``. The result is, per
document, the size of its set and the smallest id reachable by links.

1. Documents with equal sets are one class, known by a hash of the set.
2. Shingles are exchanged in packed arrays, a row per bucket of shingles and
   block of documents, to learn which of them occur in more than one block or
   class and how often. Shingles so frequent that at most ``HOT`` of them can
   exist are found first (by counts within blocks) and known to every task, so
   no bucket gathers one row per document for them.
3. A class can only link if the shingles it shares with others fill the
   required overlap; all others are done. This is the prefix filter under the
   first order: unshared shingles first, then by rising frequency.
4. Two classes that link share a shingle within the prefixes of *every* global
   order. Candidates come from the rarest-first order and must also meet in the
   prefixes under two hash orders before they are verified on whole sets.
5. A shingle's classes are first compared with one of them only (a hub), twice;
   links make components. What is left, classes of one shingle in different
   components, is compared pair by pair under the size and position bounds, so
   no link between different components is missed and no pairs within a
   component are made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacelake.llm.common import components, documents, tidy, written
from pacelake.llm.text import BASE, U64, Texts, mix, shingles, slices, word_hashes

NO_ID = -(2**63)
HOT = 1 << 16  # bound of the number of shingles known to every task
BLOCK_DOCS = 250  # documents of a packed block, at most 256
BUCKET_SHINGLES = 1 << 20  # expected shingles of a bucket
LOW_BYTES = 5  # of a shingle in an exchange; with its bucket 40 bits and more for each million shingles


def shingle_sets(col: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingle, text index) of the distinct shingles of every text, sorted by
    both. A text with fewer words has its whole sequence as one shingle, an
    empty or null text none. A-Z are lower-cased."""
    t = Texts(col)
    words, at = word_hashes(t)
    h, owner, _ = shingles(words, at, size)
    count = np.diff(at)
    short_h, short_o = [], np.flatnonzero((count > 0) & (count < size))
    with np.errstate(over="ignore"):
        for i in short_o:
            acc = U64(count[i])
            for w in words[at[i] : at[i + 1]]:
                acc = acc * BASE + w
            short_h.append(acc)
    h = np.concatenate([h, mix(np.array(short_h, np.uint64))])
    owner = np.concatenate([owner, short_o])
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[keep], owner[keep]


def classes(h: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(size, hash of the whole set) per text; equal sets have equal hashes."""
    size = np.bincount(owner, minlength=n)
    with np.errstate(over="ignore"):
        total = np.concatenate([[U64(0)], np.cumsum(mix(h ^ BASE), dtype=np.uint64)])
        ends = np.cumsum(size)
        return size, mix((total[ends] - total[ends - size]) + size.astype(np.uint64) * BASE).view(np.int64)


def _needed(n, num: int, den: int):
    """Smallest overlap of a set of n shingles with a partner: ceil(num n / den)."""
    return -(-(n * num) // den)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            for a in range(0, part.num_rows, BLOCK_DOCS):
                yield part.slice(a, BLOCK_DOCS)


def _sizes(docs: DataFrame, size: int) -> DataFrame:
    """Rows (doc_id, n, cls) of documents, and rows (token, count) of shingles
    that are frequent within some part of about 3 MB of text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                h, owner = shingle_sets(part.column("text"), size)
                n, cls = classes(h, owner, part.num_rows)
                token, count = np.unique(h, return_counts=True)
                often = count >= max(3, len(h) // (2 * HOT))
                token, count = token[often].view(np.int64), count[often]
                none, pad = pa.nulls(len(token), pa.int64()), pa.nulls(part.num_rows, pa.int64())
                cols = [
                    pa.concat_arrays([part.column("doc_id"), none]),
                    pa.concat_arrays([pa.array(n, pa.int64()), none]),
                    pa.concat_arrays([pa.array(cls, pa.int64()), none]),
                    pa.concat_arrays([pad, pa.array(token)]),
                    pa.concat_arrays([pad, pa.array(count, pa.int64())]),
                ]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n", "cls", "token", "count"])

    return docs.mapInArrow(work, "doc_id long, n long, cls long, token long, count long")


def _packed(docs: DataFrame, size: int, hot: np.ndarray, buckets: int) -> DataFrame:
    """Per block: a row per bucket with the block's shingles (40 bits) and the
    block's classes they are of (8 bits), and a head row (bucket below 0, dealt
    by the block) with the classes, their sizes and their hot shingles (as
    places in ``hot``)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _blocks(batches):
            h, owner = shingle_sets(part.column("text"), size)
            n, cls = classes(h, owner, part.num_rows)
            _, first = np.unique(cls, return_index=True)
            first = first[n[first] > 0]
            if not len(first):
                continue
            local = np.full(part.num_rows, -1)
            local[first] = np.arange(len(first))
            mine = local[owner] >= 0
            h, who = h[mine], local[owner[mine]]
            place = np.minimum(np.searchsorted(hot, h), max(0, len(hot) - 1))
            is_hot = hot[place] == h if len(hot) else np.zeros(len(h), bool)
            block = int(mix(np.array([np.bitwise_xor.reduce(mix(cls[first].view(np.uint64)))], np.uint64)).view(np.int64)[0])
            rows = {"bucket": [-1 - (block & 0xFFFF)], "a": [cls[first].astype("<i8").tobytes()], "b": [n[first].astype("<i4").tobytes()]}
            rows["c"], rows["d"] = [who[is_hot].astype("u1").tobytes()], [place[is_hot].astype("<i4").tobytes()]
            h, who = h[~is_hot], who[~is_hot]
            bucket = (h >> U64(48)).astype(np.int64) % buckets
            order = np.lexsort((h, bucket))
            h, who, bucket = h[order], who[order].astype("u1"), bucket[order]
            low = h.view("u1").reshape(-1, 8)[:, :LOW_BYTES]
            edge = np.searchsorted(bucket, np.arange(buckets + 1))
            for k in np.flatnonzero(np.diff(edge)):
                rows["bucket"].append(int(k))
                rows["a"].append(low[edge[k] : edge[k + 1]].tobytes())
                rows["b"].append(who[edge[k] : edge[k + 1]].tobytes())
                rows["c"].append(None)
                rows["d"].append(None)
            k = len(rows["bucket"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows["bucket"], pa.int32()), pa.array([block] * k, pa.int64()), *(pa.array(rows[x], pa.binary()) for x in "abcd")],
                names=["bucket", "block", "a", "b", "c", "d"],
            )

    return docs.mapInArrow(work, "bucket int, block long, a binary, b binary, c binary, d binary")


def _unpacked(packed: bytes) -> np.ndarray:
    out = np.zeros((len(packed) // LOW_BYTES, 8), "u1")
    out[:, :LOW_BYTES] = np.frombuffer(packed, "u1").reshape(-1, LOW_BYTES)
    return out.view("<u8").ravel()


def _shared(table: pa.Table) -> pa.Table:
    """A bucket's shingles that occur twice or more, back to their blocks, with
    their numbers of occurrences; heads as they are."""
    bucket = table.column("bucket")[0].as_py()
    if bucket < 0:
        return table
    parts = [_unpacked(x) for x in table.column("a").to_pylist()]
    who = [np.frombuffer(x, "u1") for x in table.column("b").to_pylist()]
    every = np.concatenate(parts)
    distinct, count = np.unique(every, return_counts=True)
    distinct, count = distinct[count > 1], count[count > 1]
    blocks, a, b, c = [], [], [], []
    for block, p, w in zip(table.column("block").to_pylist(), parts, who):
        place = np.minimum(np.searchsorted(distinct, p), max(0, len(distinct) - 1))
        ok = distinct[place] == p if len(distinct) else np.zeros(len(p), bool)
        if ok.any():
            blocks.append(block)
            a.append(p[ok].view("u1").reshape(-1, 8)[:, :LOW_BYTES].tobytes())
            b.append(w[ok].tobytes())
            c.append(np.minimum(count[place[ok]], 0xFFFF).astype("<u2").tobytes())
    return pa.table({"bucket": pa.array([bucket] * len(blocks), pa.int32()), "block": pa.array(blocks, pa.int64()), "a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary()), "c": pa.array(c, pa.binary()), "d": pa.nulls(len(blocks), pa.binary())})


def _survivors(num: int, den: int, hot_count: np.ndarray):
    def work(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        head = next(r for r in rows if r["bucket"] < 0)
        cls, n = np.frombuffer(head["a"], "<i8"), np.frombuffer(head["b"], "<i4").astype(np.int64)
        token, who, freq = [], [], []
        for r in rows:
            if r["bucket"] >= 0:
                token.append(_unpacked(r["a"]) | U64(r["bucket"]) << U64(48))
                who.append(np.frombuffer(r["b"], "u1"))
                freq.append(np.frombuffer(r["c"], "<u2").astype(np.int64))
        place = np.frombuffer(head["d"], "<i4")
        # hot shingles come after all others, by their counts: named by their place, above any bucket's names
        token.append(place.astype(np.uint64) | U64(1 << 63))
        who.append(np.frombuffer(head["c"], "u1"))
        freq.append(hot_count[place] + (1 << 40))
        token, who, freq = np.concatenate(token), np.concatenate(who).astype(np.int64), np.concatenate(freq)
        shared = np.bincount(who, minlength=len(cls))
        keep = shared >= _needed(n, num, den)
        mine = keep[who]
        token, who, freq = token[mine], who[mine], freq[mine]
        order = np.lexsort((token, freq, who))
        token, who = token[order].view(np.int64), who[order]
        left = np.flatnonzero(keep)
        offsets = np.searchsorted(who, np.append(left, len(cls)))
        lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(token))
        return pa.table({"cls": pa.array(cls[left]), "n": pa.array(n[left]), "tokens": lists})

    return work


def _inside(n: Column, tokens: Column, num: int, den: int) -> Column:
    """How many of a class's shared shingles lie in its prefix (the unshared
    ones come first in every order)."""
    prefix = n - F.ceil(n * num / den) + 1
    return F.greatest(F.least(prefix - (n - F.size(tokens)), F.size(tokens)), F.lit(0)).cast("int")


def _prefix(n: Column, tokens: Column, seed: int, num: int, den: int) -> Column:
    """The prefix's shared shingles in the order of a hash."""
    drawn = F.array_sort(F.transform(tokens, lambda x: F.struct(F.xxhash64(x, F.lit(seed)).alias("o"), x.alias("x"))))
    return F.transform(F.slice(drawn, F.lit(1), _inside(n, tokens, num, den)), lambda s: s["x"])


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of classes that meet under the other orders and link."""
    pairs = written(pairs, "pairs")  # its size is then known: few pairs travel to the sets, not the sets to them
    left, right = (sets.select(F.col("cls").alias(x), F.col("n").alias(f"n_{x}"), F.col("tokens").alias(f"tokens_{x}")) for x in "ab")
    met = pairs.join(left, "a").join(right, "b")
    for seed in (2, 3):
        met = met.where(F.arrays_overlap(*(_prefix(F.col(f"n_{x}"), F.col(f"tokens_{x}"), seed, num, den) for x in "ab")))
    same = F.size(F.array_intersect("tokens_a", "tokens_b")).cast("long")
    return met.where((num + den) * same >= num * (F.col("n_a") + F.col("n_b"))).select("a", "b")


def linked_classes(sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links (a, b) between classes (cls, n, tokens in the first order) that
    connect exactly the classes that all links connect."""
    n, tokens = F.col("n"), F.col("tokens")
    front = F.slice(tokens, F.lit(1), _inside(n, tokens, num, den))
    rows = sets.select("cls", "n", (n - F.size(tokens)).alias("alone"), F.posexplode(front).alias("k", "token"))
    rows = rows.select("token", "cls", "n", (F.col("alone") + F.col("k") + 1).alias("pos"))
    shared = rows.groupBy("token").agg(F.count("*").alias("m")).where("m > 1").select("token")
    rows = written(rows.join(shared, "token"), "prefixes")
    fits = lambda x, y: (F.least(x, y) * den >= F.greatest(x, y) * num)

    def with_hub(members: DataFrame, order) -> DataFrame:
        hub = members.groupBy("token").agg(F.min(F.struct(order.alias("o"), "cls", "n")).alias("h"))
        got = members.join(hub.select("token", F.col("h.cls").alias("hub"), F.col("h.n").alias("hub_n")), "token")
        return got.where((F.col("cls") != F.col("hub")) & fits(F.col("n"), F.col("hub_n")))

    # first: the class where the shingle stands first, the one nearest to what the others have in common
    pairs = with_hub(rows, F.col("pos")).select(F.col("cls").alias("a"), F.col("hub").alias("b")).distinct()
    links = written(_verified(pairs, sets, num, den), "links")
    del pairs
    tidy(sets.sparkSession)
    for last in (False, True):
        comp = components(links)
        named = rows.join(comp.select(F.col("node").alias("cls"), "component"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
        main = named.groupBy("token").agg(F.min(F.struct("pos", "component")).alias("m"), F.min("component").alias("lo"), F.max("component").alias("hi"))
        main = main.where("lo <> hi").select("token", F.col("m.component").alias("main"))
        open_ = written(named.join(main, "token"), "open")
        if not last:
            found = with_hub(open_.where("component <> main"), F.xxhash64("cls", "token")).select("token", "hub", "hub_n").distinct()
            hub_comp = comp.select(F.col("node").alias("hub"), F.col("component").alias("hub_component"))
            met = open_.join(found, "token").join(hub_comp, "hub", "left").withColumn("hub_component", F.coalesce("hub_component", "hub"))
            pairs = met.where((F.col("component") != F.col("hub_component")) & fits(F.col("n"), F.col("hub_n"))).select(F.col("cls").alias("a"), F.col("hub").alias("b")).distinct()
        else:
            minor = open_.where("component <> main").select("token", *[F.col(c).alias(f"{c}_b") for c in ("cls", "n", "pos", "component")])
            best = F.least(F.col("n") - F.col("pos"), F.col("n_b") - F.col("pos_b")) + 1
            met = open_.join(minor, "token").where(
                (F.col("component") != F.col("component_b")) & fits(F.col("n"), F.col("n_b")) & ((num + den) * best >= num * (F.col("n") + F.col("n_b")))
            )
            pairs = met.select(F.least("cls", "cls_b").alias("a"), F.greatest("cls", "cls_b").alias("b")).distinct()
        links = links.union(written(_verified(pairs, sets, num, den), "links"))
        del comp, named, main, open_, met, pairs
        tidy(sets.sparkSession)  # of dozens of joins the driver holds plans, too
    return links


def _candidates(docs: DataFrame, size: int, num: int, den: int, hot: np.ndarray, hot_count: np.ndarray, buckets: int) -> DataFrame:
    """Classes (cls, n, tokens) whose shared shingles could fill the overlap."""
    schema = "bucket int, block long, a binary, b binary, c binary, d binary"
    back = _packed(docs, size, hot, buckets).groupBy("bucket").applyInArrow(_shared, schema)
    left = back.groupBy("block").applyInArrow(_survivors(num, den, hot_count), "cls long, n long, tokens array<long>")
    return written(left.dropDuplicates(["cls"]), "survivors")


def jaccard_components(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of docs (doc_id, text).

    Null and empty texts have no shingles and link with nothing. Rows with the
    same id are separate documents with that id; null ids never name a
    component unless all its ids are null. Equal sets always link. Extra
    columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sizes = written(_sizes(own, size), "sizes")
    rows, often = sizes.where("token is null").select("doc_id", "n", "cls"), sizes.where("token is not null")
    total = rows.agg(F.sum("n")).first()[0] or 0
    # at most HOT shingles can occur in a HOT-th of all occurrences or more
    hot = often.groupBy("token").agg(F.sum("count").alias("c")).where(F.col("c") >= max(3, -(-total // HOT))).collect()
    known = sorted((int(np.int64(r["token"]).view(np.uint64)), r["c"]) for r in hot)
    hot_tokens, hot_count = np.array([t for t, _ in known], np.uint64), np.array([c for _, c in known], np.int64)
    buckets = 64
    while buckets * BUCKET_SHINGLES < total:
        buckets *= 2
    sets = _candidates(own, size, num, den, hot_tokens, hot_count, buckets)
    tidy(spark)
    comp = components(linked_classes(sets, num, den))
    named = rows.where("n > 0").join(comp.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    names = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    linked = named.join(names, "component").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return linked.union(rows.where("n = 0").select("doc_id", F.col("n"), F.col("doc_id")))


def one_of_each(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Documents (all columns) of which one stays per component: that of the
    smallest id. Rows that repeat its id and text go, too; other texts under
    the same id stay, and so do texts without words."""
    found = jaccard_components(docs, size, num, den).withColumn("id", F.coalesce("doc_id", F.lit(NO_ID)))
    per_id = found.groupBy("id").agg(F.count("*").alias("rows"), F.count_if(F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("own"))
    per_id = written(per_id.where("own = 0 or rows > 1"), "per_id")
    own_id = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    left = docs.join(per_id.where("own = 0").select(F.col("id").alias("_id")), own_id == F.col("_id"), "left_anti")
    often = per_id.where("own > 0 and rows > 1").select(F.col("id").alias("_id"))
    if not often.limit(1).count():
        return left
    same = left.join(often, own_id == F.col("_id"), "left_semi").dropDuplicates(["doc_id", "text"])
    return left.join(often, own_id == F.col("_id"), "left_anti").union(same.select(*docs.columns))


def op5_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Sizes and components of all documents, four-word shingles at 0.85."""
    return jaccard_components(documents(spark, sf_dir), 4, 85, 100)
