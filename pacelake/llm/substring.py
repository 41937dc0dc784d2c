"""Near-duplicate passages by compact windows (operator 7).

A text is the sequence of its word shingles, and a passage of ``min_words`` words
a window of ``least`` of them. Under a hash function, the windows that have the
same shingle as their minimum are one compact window: a node of the Cartesian
tree of the hashes, kept if it is ``least`` wide. Two similar windows have the
same minimum under most of ``HASHES`` functions.

1. The minima of all compact windows are exchanged as keys. A part of the corpus
   sends a key once, for its first document; its other documents are compared
   with that one. So a key that every document has costs a row a part.
2. Per document, partner and diagonal the compact windows are joined as
   intervals; where at least ``ENOUGH`` functions meet, the stretch is compared
   once: two shingles agree if the partner has them within ``SHIFT`` places, so
   inserted and deleted words do not end a passage, and passages are the windows
   of which 4 of 5 shingles agree.
3. A key has one partner, the first document that has it. Where that one has too
   little of a passage, the stretches that no passage covers, but where enough
   functions meet over all partners, are exchanged again by keys that are harder
   to share: pairs of minima, and whole windows. Both costs follow the number of
   occurrences, not of pairs.
4. Passages are joined as intervals.

Texts of the same words as an earlier one are repeated as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacelake.llm.common import documents, tidy, written
from pacelake.llm.text import BASE, BASE_INVERSE, U64, Texts, mix, powers, shingles, slices

HASHES, ENOUGH = 6, 2
SHIFT = 16  # places by which inserted or deleted words may move a shingle
DIAGONAL = 8  # diagonals of a cell
QUANTUM = 32  # partners' stretches begin and end at multiples, so that they can be shared
BUCKET_KEYS = 1 << 20
NO_ID = -(2**63)
STEP = 1 << 22  # shingles whose minima are looked for at a time
PLACE = U64((1 << 24) - 1)
_SEEDS = mix(np.arange(1, HASHES + 1, dtype=np.uint64))
KEY_BYTES = 6
FIELDS = [("keys", f"V{KEY_BYTES}"), ("docs", "<i8"), ("places", "<i4"), ("backs", "u1"), ("aheads", "u1"), ("masks", "u1"), ("hubs", "<i8"), ("hub_places", "<i4")]
PACKED = "bucket int, " + ", ".join(f"{name} binary" for name, _ in FIELDS)
MATCH = "id long, at int, lo int, hi int, mask int, hub long, hub_at int"


def minima(v: np.ndarray, least: int) -> np.ndarray:
    """The place of the minimum of every run of ``least`` values (of equals the
    first; the lowest 24 bits do not count)."""
    n = len(v) - least + 1
    out = np.empty(max(n, 0), np.int64)
    for a in range(0, max(n, 0), STEP):
        part = v[a : a + STEP + least - 1]
        low = part & ~PLACE | np.arange(len(part), dtype=np.uint64)
        width, m = 1, len(part) - least + 1
        while 2 * width <= least:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        out[a : a + m] = (np.minimum(low[:m], low[least - width : least - width + m]) & PLACE).astype(np.int64) + a
    return out


def _runs(starts: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of the runs of consecutive starts with equal values."""
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] != starts[:-1] + 1
    for x in values:
        new[1:] |= x[1:] != x[:-1]
    first = np.flatnonzero(new)
    return first, np.append(first[1:], len(starts))[: len(first)] - 1


class Part:
    """Words and shingles of a part of the documents."""

    def __init__(self, col: pa.Array, size: int, least: int, words_only: bool = False):
        self.texts = Texts(col)
        self.start, self.end, self.at = self.texts.words()
        self.words = self.texts.span_hashes(self.start, self.end, lower=True)
        if words_only:
            return
        self.g, self.owner, self.word = shingles(self.words, self.at, size)
        self.first = np.searchsorted(self.owner, np.arange(self.texts.n + 1))
        self.least, self.length = least, least + size - 1
        n = len(self.g) - least + 1
        self.starts = np.flatnonzero(self.owner[:n] == self.owner[least - 1 :]) if n > 0 else np.zeros(0, np.int64)

    def _of(self, f: int, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, value) of the minimum of the windows at some starts."""
        v = mix(self.g ^ _SEEDS[f])
        at = minima(v, self.least)[starts]
        return at, v[at]

    def compact(self) -> list[tuple[np.ndarray, ...]]:
        """Per function the compact windows (place of the minimum, first and
        last shingle, key), cut at ``least`` places from the minimum."""
        out = []
        for f in range(HASHES):
            at, v = self._of(f, self.starts)
            a, b = _runs(self.starts, at)
            out.append((at[a], self.starts[a], self.starts[b] + self.least - 1, mix(v[a] + U64(f))))
        return out

    def keys(self) -> tuple[np.ndarray, ...]:
        """(key, place, first, last, mask of the function) of compact windows."""
        found = self.compact()
        mask = np.repeat([1 << f for f in range(HASHES)], [len(x[0]) for x in found])
        at, lo, hi, key = (np.concatenate([x[k] for x in found]) for k in range(4))
        return key, at, lo, hi, mask

    def keys_again(self, inside: np.ndarray) -> tuple[np.ndarray, ...]:
        """As ``keys``: windows within marked shingles under pairs of functions
        (joined as intervals), and whole windows."""
        marked = np.concatenate([[0], np.cumsum(inside)])
        starts = self.starts[marked[self.starts + self.least] - marked[self.starts] == self.least]
        low = [self._of(f, starts) for f in range(HASHES)]
        parts = []
        for k, (f, h) in enumerate(combinations(range(HASHES), 2)):
            (at, v), (other, w) = low[f], low[h]
            a, b = _runs(starts, at, other)
            with np.errstate(over="ignore"):
                parts.append((mix(mix(v[a] + U64(k)) * BASE + w[a]), at[a], starts[a], starts[b] + self.least - 1))
        word = self.word[starts]
        with np.errstate(over="ignore"):
            total, _, down = self._sums()
            whole = mix((total[word + self.length] - total[word]) * down[word] + BASE)
        parts.append((whole, starts, starts, starts + self.least - 1))
        key, at, lo, hi = (np.concatenate([x[k] for x in parts]) for k in range(4))
        return key, at, lo, hi, np.full(len(key), 3)

    def _sums(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        with np.errstate(over="ignore"):
            up, down = powers(BASE, len(self.words)), powers(BASE_INVERSE, len(self.words))
            return np.concatenate([[U64(0)], np.cumsum(self.words * up[:-1], dtype=np.uint64)]), up, down

    def text_hashes(self) -> np.ndarray:
        """Hash of every text's sequence of words."""
        with np.errstate(over="ignore"):
            total, _, down = self._sums()
            n = np.diff(self.at)
            return mix((total[self.at[1:]] - total[self.at[:-1]]) * down[self.at[:-1]] + n.astype(np.uint64)).view(np.int64)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from slices(batch, "text", 2_000_000)


def _survey(docs: DataFrame, size: int, least: int) -> DataFrame:
    """(id, n_words, text_hash) of documents."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            p = Part(batch.column("text"), size, least, words_only=True)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(np.diff(p.at), pa.int64()), pa.array(p.text_hashes())], names=["id", "n_words", "text_hash"])

    return docs.mapInArrow(work, "id long, n_words long, text_hash long")


# --- exchange of keys ------------------------------------------------------------------


def _split(values: list[np.ndarray], part: np.ndarray, n: int) -> tuple[np.ndarray, list[list[bytes]]]:
    """Parts that occur, and per column the bytes of each one's values."""
    order = np.argsort(part, kind="stable")
    edge = np.searchsorted(part[order], np.arange(n + 1))
    used = np.flatnonzero(np.diff(edge))
    out = []
    for x in values:
        x = x[order]
        out.append([x[edge[k] : edge[k + 1]].tobytes() for k in used])
    return used, out


def _packed_rows(key, ids, place, back, ahead, mask, buckets: int) -> pa.RecordBatch:
    """A part's rows to exchange: per bucket the occurrences of keys in their
    first document here, and (bucket below 0) the matches of the others with it."""
    order = np.lexsort((place, ids, key))
    key, ids, place, back, ahead, mask = (x[order] for x in (key, ids, place, back, ahead, mask))
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    head = np.flatnonzero(new)[np.cumsum(new) - 1] if len(key) else np.zeros(0, np.int64)
    first = ids == ids[head]
    low = np.ascontiguousarray(key).view("u1").reshape(-1, 8)[:, :KEY_BYTES].copy().view(f"V{KEY_BYTES}").ravel()
    rest = [ids.astype("<i8"), place.astype("<i4"), back.astype("u1"), ahead.astype("u1"), mask.astype("u1")]
    bucket = (key >> U64(48)).astype(np.int64) % buckets
    used, own = _split([x[first] for x in (low, *rest)], bucket[first], buckets)
    other = ~first
    there, matched = _split([x[other] for x in (*rest, ids[head].astype("<i8"), place[head].astype("<i4"))], bucket[other] % 16, 16)
    none = lambda n: [None] * n
    cols = [[*own[0], *none(len(there))], *([*own[k + 1], *matched[k]] for k in range(5)), *([*none(len(used)), *matched[k]] for k in (5, 6))]
    numbers = np.concatenate([used, -1 - there]).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(numbers), *(pa.array(c, pa.binary()) for c in cols)], names=["bucket", *(x for x, _ in FIELDS)])


def _packed(rows: DataFrame, size: int, least: int, buckets: int, again: bool = False) -> DataFrame:
    """Packed keys of documents (id, text), or ``again`` of the stretches
    (spans: lo, hi) of documents that are still open."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            p = Part(batch.column("text"), size, least)
            if again:
                inside = np.zeros(len(p.g) + 1, np.int64)
                for k, spans in enumerate(batch.column("spans").to_pylist()):
                    base, end = p.first[k], p.first[k + 1]
                    for s in spans:
                        if base + s["lo"] < end:
                            inside[base + s["lo"]] += 1
                            inside[min(base + s["hi"] + 1, end)] -= 1
                found = p.keys_again(np.cumsum(inside)[:-1] > 0)
            else:
                found = p.keys()
            ids = batch.column("id").to_numpy()
            hashes = p.text_hashes()
            order = np.lexsort((ids, hashes))
            copy = np.zeros(len(ids), bool)  # of a text here: it is repeated as a whole
            copy[order[1:]] = hashes[order][1:] == hashes[order][:-1]
            kept = ~copy[p.owner[found[1]]] if len(found[1]) else np.zeros(0, bool)
            key, at, lo, hi, mask = (x[kept] for x in found)
            owner = p.owner[at] if len(at) else at
            yield _packed_rows(key, ids[owner] if len(at) else at, at - p.first[owner], np.minimum(at - lo, 255), np.minimum(hi - at, 255), mask, buckets)

    return rows.mapInArrow(work, PACKED)


def _matches(table: pa.Table) -> pa.Table:
    """A bucket's occurrences of keys that an earlier document has: with the
    first document and its first place."""
    read = lambda name, kind: np.concatenate([np.frombuffer(x, kind) for x in table.column(name).to_pylist()])
    ids, place, back, ahead, mask = (read(*x) for x in FIELDS[1:6])
    if table.column("bucket")[0].as_py() < 0:
        hub, hub_place = (read(*x) for x in FIELDS[6:])
    else:
        key = np.zeros((len(ids), 8), "u1")
        key[:, :KEY_BYTES] = read(*FIELDS[0]).view("u1").reshape(-1, KEY_BYTES)
        key = key.view("<u8").ravel()
        order = np.argsort(key)
        k = key[order]
        same = k[1:] == k[:-1]
        many = order[np.concatenate([[False], same]) | np.concatenate([same, [False]])] if len(k) else order
        key, ids, place, back, ahead, mask = (x[many] for x in (key, ids, place, back, ahead, mask))
        order = np.lexsort((place, ids, key))
        key, ids, place, back, ahead, mask = (x[order] for x in (key, ids, place, back, ahead, mask))
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        head = np.flatnonzero(new)[np.cumsum(new) - 1] if len(key) else np.zeros(0, np.int64)
        hub, hub_place = ids[head], place[head]
        later = hub != ids
        ids, place, back, ahead, mask, hub, hub_place = (x[later] for x in (ids, place, back, ahead, mask, hub, hub_place))
    place = place.astype(np.int32)
    return pa.table({"id": ids, "at": place, "lo": place - back.astype(np.int32), "hi": place + ahead.astype(np.int32), "mask": mask.astype(np.int32), "hub": hub, "hub_at": hub_place.astype(np.int32)})


def _cells(packed: DataFrame, least: int) -> DataFrame:
    """Matches, one per document, partner, diagonal and half a window, with the
    functions that meet there and what their compact windows span."""
    met = packed.groupBy("bucket").applyInArrow(_matches, MATCH)
    diagonal, cell = F.floor((F.col("at") - F.col("hub_at")) / DIAGONAL).cast("int"), F.floor(F.col("at") / (least // 2 or 1)).cast("int")
    each = met.groupBy("id", "hub", diagonal.alias("d"), cell.alias("cell"))
    return each.agg(F.bit_or("mask").alias("mask"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min(F.struct("at", "hub_at")).alias("m")).select("id", "hub", "d", "mask", "lo", "hi", "m.at", "m.hub_at")


# --- intervals -----------------------------------------------------------------------------


def _whole_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by id as tables in which no id is cut."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column("id").to_numpy()
        cut = int(np.searchsorted(ids, ids[-1]))
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def _joined(group: np.ndarray, lo: np.ndarray, hi: np.ndarray, overlap: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of the stretch of every interval, running end): intervals sorted
    by group and lo belong together while they overlap by ``overlap`` places."""
    if not len(lo):
        return lo, hi
    reach = np.maximum.accumulate(group.astype(np.int64) << 32 | hi.astype(np.int64)) & 0xFFFFFFFF
    new = np.ones(len(lo), bool)
    new[1:] = (group[1:] != group[:-1]) | (lo[1:] > reach[:-1] - overlap + 1)
    return np.cumsum(new) - 1, reach


def _enough(masks: np.ndarray) -> np.ndarray:
    return np.array([bin(m).count("1") for m in range(256)])[masks & 255] >= ENOUGH


def _changes(*columns: np.ndarray) -> np.ndarray:
    new = np.zeros(len(columns[0]), bool)
    for x in columns:
        new[1:] |= x[1:] != x[:-1]
    return np.cumsum(new)


def _stretches(cells: DataFrame, least: int, by_hub: bool) -> DataFrame:
    """Stretches (id, lo, hi, and per partner hub, delta, hlo, hhi) where the
    windows of enough functions overlap; of all partners together without
    ``by_hub``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole_ids(batches):
            x = {c: t.column(c).to_numpy() for c in ("id", "hub", "d", "mask", "lo", "hi", "at", "hub_at")}
            group = _changes(x["id"], x["hub"], x["d"]) if by_hub else _changes(x["id"])
            run, _ = _joined(group, x["lo"], x["hi"], least)
            first = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
            keep = _enough(np.bitwise_or.reduceat(x["mask"], first))
            first_kept = first[keep]
            lo, hi = x["lo"][first_kept].astype(np.int64), np.maximum.reduceat(x["hi"], first)[keep].astype(np.int64)
            cols = [pa.array(x["id"][first_kept])]
            if by_hub:
                delta = (x["at"] - x["hub_at"])[first_kept].astype(np.int64)
                lo, hi = np.maximum(lo - least + 1, 0), hi + least - 1
                hlo, hhi = (lo - delta - SHIFT) // QUANTUM * QUANTUM, -(-(hi - delta + SHIFT + 1) // QUANTUM) * QUANTUM - 1
                cols += [pa.array(a) for a in (lo, hi, x["hub"][first_kept], delta, hlo, hhi)]
            else:
                cols += [pa.array(lo), pa.array(hi)]
            yield pa.RecordBatch.from_arrays(cols, names=["id", "lo", "hi", "hub", "delta", "hlo", "hhi"][: len(cols)])

    order = ["id", "hub", "d", "lo"] if by_hub else ["id", "lo"]
    schema = "id long, lo long, hi long" + (", hub long, delta long, hlo long, hhi long" if by_hub else "")
    return cells.repartition("id").sortWithinPartitions(*order).mapInArrow(work, schema)


# --- verification ----------------------------------------------------------------------------


def _contexts(rows: DataFrame, size: int, least: int) -> DataFrame:
    """16 bits of every shingle of the asked stretches of documents (id, text,
    picks): as far as the document goes for those that ask (hub is set), with
    zeros beyond its ends for partners."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            p = Part(batch.column("text"), size, least)
            short = (mix(p.g) >> U64(48)).astype("<u2") | np.uint16(1)
            out, held = [], 0
            for k, (i, picks) in enumerate(zip(batch.column("id").to_pylist(), batch.column("picks").to_pylist())):
                own = short[p.first[k] : p.first[k + 1]]
                for q in picks:
                    lo, hi = q["lo"], q["hi"]
                    codes = own[max(lo, 0) : max(hi + 1, 0)]
                    if q["hub"] is None:
                        codes = np.concatenate([np.zeros(max(0, min(-lo, hi - lo + 1)), "<u2"), codes])
                        codes = np.concatenate([codes, np.zeros(hi - lo + 1 - len(codes), "<u2")])
                    if len(codes) >= least:
                        out.append((i, lo, hi, q["hub"], q["delta"], q["hlo"], q["hhi"], codes.tobytes()))
                        held += 2 * len(codes)
                    if held > 2_000_000:
                        yield _rows(out)
                        out, held = [], 0
            yield _rows(out)

    return rows.mapInArrow(work, "id long, lo long, hi long, hub long, delta long, hlo long, hhi long, codes binary")


def _rows(out: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 7 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], names=["id", "lo", "hi", "hub", "delta", "hlo", "hhi", "codes"])


def agreeing(a: list[np.ndarray], b: list[np.ndarray], base: np.ndarray) -> np.ndarray:
    """Flags of all shingles of the stretches a, one after the other, whose
    partner b has the same within ``SHIFT`` places, and that of a neighbour, too
    (16 bits alone meet by chance); base: the place in b that stands against the
    first of a."""
    n = np.array([len(x) for x in a])
    one, two = np.concatenate(a), np.concatenate(b)
    begin = np.cumsum([0, *(len(x) for x in b)])[:-1]
    at = np.arange(len(one)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin + base, n)
    out = np.zeros(len(one), bool)
    for shift in range(-SHIFT, SHIFT + 1):
        out |= one == two[at + shift]
    out &= one > 0
    joint = out[1:] & out[:-1]
    joint[np.cumsum(n)[:-1] - 1] = False  # ends of stretches are no neighbours
    return np.concatenate([[False], joint]) | np.concatenate([joint, [False]]) if len(out) else out


def passages(same: np.ndarray, n: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(stretch, first, last shingle) of the passages: unions of overlapping
    windows of ``least`` shingles of which 4 of 5 agree, from the first to the
    last shingle that agrees. same: flags of stretches of n shingles."""
    if not len(same):
        return (np.zeros(0, np.int64),) * 3
    row, begin = np.repeat(np.arange(len(n)), n), np.cumsum(n) - n
    total = np.concatenate([[0], np.cumsum(same)])
    start = np.arange(max(0, len(same) - least + 1))
    start = start[(row[start] == row[start + least - 1]) & (5 * (total[start + least] - total[start]) >= 4 * least)]
    cover = np.zeros(len(same) + 1, np.int64)
    cover[start] += 1
    cover -= np.bincount(start + least, minlength=len(cover))[: len(cover)]
    used = np.flatnonzero(np.cumsum(cover)[:-1] > 0)
    first, last = _runs(used, row[used])
    agree = np.flatnonzero(same)
    lo = agree[np.searchsorted(agree, used[first])] if len(used) else used
    hi = agree[np.searchsorted(agree, used[last], side="right") - 1] if len(used) else used
    long = hi - lo + 1 >= least
    lo, hi = lo[long], hi[long]
    return row[lo], lo - begin[row[lo]], hi - begin[row[lo]]


def _verified(asks: DataFrame, docs: DataFrame, size: int, least: int) -> DataFrame:
    """Passages (id, lo, hi, hub) of stretches that ask a partner."""
    asks = written(asks, "stretches")
    mine = asks.select("id", F.struct("lo", "hi", "hub", "delta", "hlo", "hhi").alias("pick"))
    none = F.lit(None).cast("long")
    theirs = asks.select("hub", "hlo", "hhi").distinct().select(F.col("hub").alias("id"), F.struct(F.col("hlo").alias("lo"), F.col("hhi").alias("hi"), none.alias("hub"), none.alias("delta"), none.alias("hlo"), none.alias("hhi")).alias("pick"))
    picks = mine.union(theirs).groupBy("id").agg(F.collect_list("pick").alias("picks"))
    # texts are met by merging at any size: what is asked of them grows with the corpus
    seen = written(_contexts(docs.join(picks.hint("merge"), "id"), size, least), "contexts")
    # written, so that both sides of the join are plain exchanges, of which AQE splits a hot partner's rows
    partners = seen.where("hub is null").select(F.col("id").alias("hub"), F.col("lo").alias("hlo"), F.col("hi").alias("hhi"), F.col("codes").alias("partner"))
    pairs = seen.where("hub is not null").join(partners, ["hub", "hlo", "hhi"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "codes", 1_000_000):
                a, b = ([np.frombuffer(x, "<u2") for x in batch.column(name).to_pylist()] for name in ("codes", "partner"))
                lo, delta, hlo = (batch.column(x).to_numpy() for x in ("lo", "delta", "hlo"))
                n = np.array([len(x) for x in a])
                row, first, last = passages(agreeing(a, b, lo - delta - hlo), n, least)
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays([batch.column("id").take(at), pa.array(lo[row] + first), pa.array(lo[row] + last), batch.column("hub").take(at)], names=["id", "lo", "hi", "hub"])

    found = pairs.select("id", "lo", "delta", "hub", "hlo", "codes", "partner").mapInArrow(work, "id long, lo long, hi long, hub long")
    return written(found, "passages")


def _open_stretches(cells: DataFrame, found: DataFrame, least: int) -> DataFrame:
    """(id, spans): stretches in which enough functions meet, over all partners,
    in places that no passage covers."""
    covered = found.groupBy("id").agg(F.collect_list(F.struct("lo", "hi")).alias("found"))
    hit = F.exists("found", lambda s: (s["lo"] <= F.col("at")) & (s["hi"] >= F.col("at")))
    left = cells.join(covered, "id", "left").where(~F.coalesce(hit, F.lit(False))).drop("found")
    return _stretches(left, least, by_hub=False).groupBy("id").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))


def repeated_passages(docs: DataFrame, min_words: int = 50, size: int = 5) -> DataFrame:
    """(doc_id, first_word, n_words, first_doc_id): every passage of at least
    ``min_words`` words of docs (doc_id, text) that an earlier document (by id)
    has too, exactly or with 4 of 5 shingles agreeing in about the same order.

    Words are compared with A-Z lower-cased. Null and empty texts and texts
    with fewer words have none. Rows with the same id count as one document,
    rows without id as one document before all others. Extra columns are
    ignored; an empty table gives an empty result.
    """
    least = min_words - size + 1
    spark = docs.sparkSession
    own = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.col("text").cast("string").alias("text"))
    survey = written(_survey(own, size, least), "survey")
    total = survey.agg(F.sum("n_words")).first()[0] or 0
    buckets = 64
    while buckets * BUCKET_KEYS * least < total * 2 * HASHES:
        buckets *= 2
    firsts = survey.where(F.col("n_words") >= min_words).groupBy("text_hash", "n_words").agg(F.min("id").alias("original"), F.max("id").alias("last"))
    copies = survey.join(firsts.where("original <> last"), ["text_hash", "n_words"]).where("id <> original").select("id", "original", "n_words").distinct()
    copies = written(copies, "copies")
    whole = copies.select("id")
    cells = written(_cells(_packed(own, size, least, buckets), least).join(whole, "id", "left_anti"), "cells")
    tidy(spark)
    found = _verified(_stretches(cells, least, by_hub=True), own, size, least)
    tidy(spark)
    still = written(_open_stretches(cells, found, least), "open")
    more = written(_cells(_packed(own.join(still.hint("merge"), "id"), size, least, buckets, again=True), least), "cells")
    tidy(spark)
    found = found.unionByName(_verified(_stretches(more, least, by_hub=True), own, size, least))
    tidy(spark)

    def join_intervals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole_ids(batches):
            ids, lo, hi, hub = (t.column(c).to_numpy() for c in ("id", "lo", "hi", "hub"))
            run, _ = _joined(_changes(ids), lo, hi, 1 - size)  # passages whose words touch are one
            first = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
            n = np.maximum.reduceat(hi, first) - lo[first] + size
            yield pa.RecordBatch.from_arrays([pa.array(ids[first]), pa.array(lo[first]), pa.array(n), pa.array(np.minimum.reduceat(hub, first))], names=["id", "first_word", "n_words", "original"])

    joined = found.repartition("id").sortWithinPartitions("id", "lo").mapInArrow(join_intervals, "id long, first_word long, n_words long, original long")
    copied = copies.select("id", F.lit(0).cast("long").alias("first_word"), "n_words", "original")
    named = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return joined.union(copied).select(named("id").alias("doc_id"), "first_word", "n_words", named("original").alias("first_doc_id"))


def without_passages(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """Documents (with the columns of ``docs``) less their repeated passages;
    a document of which no word is left goes. ``n_chars`` is counted anew where
    it is a column. Other texts stay as they are."""
    cuts = passages.groupBy(F.coalesce("doc_id", F.lit(NO_ID)).alias("_id")).agg(F.collect_list(F.struct("first_word", "n_words")).alias("_cuts"))
    rows = docs.withColumn("_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))).join(cuts, "_id", "left").drop("_id")
    columns = docs.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keep = batch.column("text").to_pylist(), []
            part = Texts(batch.column("text"))
            start, end, at = part.words()
            for i, cut in enumerate(batch.column("_cuts").to_pylist()):
                if cut:
                    s, e, base = start[at[i] : at[i + 1]], end[at[i] : at[i + 1]], part.offsets[i]
                    raw, out, done = part.raw[base : part.offsets[i + 1]].tobytes(), [], 0
                    for a, n in sorted((c["first_word"], c["n_words"]) for c in cut):
                        if n > 0 and a < len(s):
                            out.append(raw[done : max(done, s[a] - base)])
                            done = max(done, e[min(a + n, len(s)) - 1] - base)
                    texts[i] = b"".join([*out, raw[done:]]).decode()
                keep.append(not cut or bool(texts[i].strip(" \t\n\x0b\x0c\r")))
            cols = {c: batch.column(c) for c in columns}
            cols["text"] = pa.array(texts, batch.schema.field("text").type)
            if "n_chars" in cols:
                old = batch.column("n_chars").to_pylist()
                cols["n_chars"] = pa.array([len(t) if c else o for t, c, o in zip(texts, batch.column("_cuts").to_pylist(), old)], batch.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays([cols[c] for c in columns], names=columns).filter(pa.array(keep))

    return rows.mapInArrow(work, docs.schema)


def op7_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Repeated passages of 50 words and more of all documents."""
    return repeated_passages(documents(spark, sf_dir))
