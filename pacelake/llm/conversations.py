"""Conversation structure repair (operator 11).

A conversation's roles have to read ``(s?(ua)+)?``: an optional system turn,
then user and assistant in turn. Rows are kept, rerole'd, deleted or inserted at
least cost. The dynamic program runs over run lengths: consecutive rows of equal
role and fault are one symbol, and a run of n rows advances the costs by the n-th
min-plus power of the symbol's transition, from cached powers of two. The choices
are then unrolled from the first row on, the letter first in ASCII at a tie.

Faults are found by grouping on hashes; symbols are dealt out as ranges of
(conversation, turn), so that a long conversation's rows meet in no task. Only
its runs (and the audit, one letter a row, that the result holds anyway) come
together, followed by its texts, which pass one by one in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from pacelake.llm.common import ship, written
from pacelake.sources.tables import read_table

SPACES = " \t\n\x0b\x0c\r"
#: Costs of the edits, and what a truncated row costs that stays.
RENAME, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
S, U, A, OTHER = range(4)  # classes of role initials
MUST_GO = 8  # symbol of blank and duplicate rows; others are class + 4 * truncated
LEGAL = np.zeros((4, 4), bool)  # by the classes of two rows in a row
LEGAL[[S, U, A], [U, A, U]] = True
FAR = 1 << 60
BLOCK = 4096  # rows of a run whose costs are held at a time

# States: 0 nothing yet, 1 after s, 2 after u, 3 after a. Where a user or an
# assistant turn leads (None: not allowed here).
ACCEPTING = (0, 3)
NEXT = {S: (1, None, None, None), U: (2, 2, None, 2), A: (None, None, 3, None), OTHER: (None,) * 4}
#: The role that a rerole'd or inserted turn gets in each state.
GIVEN = (U, U, A, U)
NAME = {U: "user", A: "assistant"}

Matrix = tuple[tuple[int, ...], ...]


def _times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(FAR, *(a[i][k] + b[k][j] for k in range(4))) for j in range(4)) for i in range(4))


def _apply(m: Matrix, v: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(min(FAR, *(m[i][k] + v[k] for k in range(4))) for i in range(4))


def _inserts() -> Matrix:
    """Least cost from state to state by inserted turns alone."""
    m = [[0 if i == j else FAR for j in range(4)] for i in range(4)]
    for i in range(4):
        to, cost = i, 0
        for _ in range(2):
            to, cost = NEXT[GIVEN[to]][to], cost + INSERT
            m[i][to] = min(m[i][to], cost)
    return tuple(map(tuple, m))


INSERTS = _inserts()


@lru_cache(None)
def transition(symbol: int) -> Matrix:
    """Cost from state to state over one row of a symbol, inserts before it
    included."""
    m = [[FAR] * 4 for _ in range(4)]
    for i in range(4):
        m[i][i] = DELETE
        if symbol != MUST_GO:
            stays = TRUNCATED * (symbol >= 4)
            for to, cost in ((NEXT[symbol % 4][i], stays), (NEXT[GIVEN[i]][i], stays + RENAME)):
                if to is not None:
                    m[i][to] = min(m[i][to], cost)
    return _times(INSERTS, tuple(map(tuple, m)))


@lru_cache(None)
def power(symbol: int, k: int) -> Matrix:
    """The transition of 2**k rows of a symbol."""
    return transition(symbol) if k == 0 else _times(power(symbol, k - 1), power(symbol, k - 1))


def advance(symbol: int, n: int, costs: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to go before n rows of a symbol, from the costs after them."""
    k = 0
    while n:
        if n & 1:
            costs = _apply(power(symbol, k), costs)
        n, k = n >> 1, k + 1
    return costs


AT_END = _apply(INSERTS, tuple(0 if i in ACCEPTING else FAR for i in range(4)))


def repair(runs: list[tuple[int, int]]) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits of a conversation given as runs
    (symbol, rows); of equally cheap audits the ASCII-least."""
    costs = [AT_END]
    for symbol, n in reversed(runs):
        costs.append(advance(symbol, n, costs[-1]))
    costs.reverse()  # before each run, and at the end
    letters, state = [], 0
    for (symbol, n), after in zip(runs, costs[1:]):
        for first in range(0, n, BLOCK):
            size = min(BLOCK, n - first)
            here = [advance(symbol, n - first - size, after)]
            for _ in range(size):
                here.append(_apply(transition(symbol), here[-1]))
            here.reverse()
            stays = TRUNCATED * (4 <= symbol < MUST_GO)
            for k in range(size):
                while True:
                    left, then = here[k][state], here[k + 1]
                    if DELETE + then[state] == left:
                        letters.append("D")
                        break
                    added = NEXT[GIVEN[state]][state]
                    if INSERT + here[k][added] == left:
                        letters.append("I")
                        state = added
                        continue
                    kept = NEXT[symbol % 4][state]
                    keep = kept is not None and stays + then[kept] == left
                    letters.append("K" if keep else "R")
                    state = kept if keep else added
                    break
    while AT_END[state]:
        letters.append("I")
        state = NEXT[GIVEN[state]][state]
    return costs[0][0], "".join(letters)


# --- faults and symbols ---------------------------------------------------------------

def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the damage drawn by the crc32 of
    ``conv_id:turn`` modulo 20; nulls count as one space."""
    text = lambda x: F.coalesce(F.col(x).cast("string"), F.lit(" "))
    own = rows.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), (F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20).alias("kind"))
    own = own.where("kind <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"),
    )
    return own.drop("copy")


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows with what tells their order within a turn: role, then the hash of
    the text."""
    whole = lambda x: F.coalesce(F.col(x).cast("string"), F.lit(" "))
    own = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), whole("role").alias("role"), whole("text").alias("text"))
    return own.withColumn("mark", F.unhex(F.md5("text")))


def _symbols(rows: DataFrame) -> DataFrame:
    """A row per distinct (conv_id, turn, role, text), without the text: class
    of the role's initial, faults and number of copies."""
    seen = F.rtrim(F.col("text"), F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    found = rows.select(
        "conv_id", "turn", "role", "mark",
        F.when(initial == "s", S).when(initial == "u", U).when(initial == "a", A).otherwise(OTHER).cast("byte").alias("cls"),
        (seen == "").alias("blank"), (~F.right(seen, F.lit(1)).isin(".", "!", "?")).alias("cut"),
    )
    each = written(found.groupBy("conv_id", "turn", "role", "mark", "cls", "blank", "cut").agg(F.count(F.lit(1)).alias("n")), "symbols")
    # the first turn of texts that a conversation has in several turns
    first = each.groupBy("conv_id", "role", "mark").agg(F.count(F.lit(1)).alias("turns"), F.min(F.struct(F.col("turn").isNotNull().alias("dated"), "turn")).alias("first"))
    first = written(first.where("turns > 1").select(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("mark").alias("_m"), F.col("first.turn").alias("first"), F.lit(True).alias("several")), "symbols")
    on = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("mark") == F.col("_m"))
    later = F.coalesce("several", F.lit(False)) & ~F.col("turn").eqNullSafe(F.col("first"))
    return each.join(first, on, "left").select("conv_id", "turn", "role", "mark", "cls", "blank", "cut", "n", later.alias("later"))


def _changes(col: pa.Array) -> np.ndarray:
    """Where a column differs from the row before (first row: it does)."""
    a, b = col.slice(1), col.slice(0, len(col) - 1)
    ne = pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(pc.is_null(a), pc.is_null(b)))
    return np.concatenate([[True], ne.to_numpy(zero_copy_only=False)])


#: Figures of a segment: counts, classes at its ends, turns.
FIGURES = ["blank", "duplicate", "truncated", "illegal", "first_cls", "last_cls", "turns", "low", "high", "first_dated", "first_turn", "last_dated", "last_turn"]


def _segments(symbols: DataFrame) -> DataFrame:
    """(conv_id, part, seg, figures, runs) of sorted symbol rows: a segment is
    what one batch holds of a conversation."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seg = TaskContext.get().partitionId(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            cls, n = batch.column("cls").to_numpy().astype(np.int64), batch.column("n").to_numpy()
            blank, cut, later = (batch.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("blank", "cut", "later"))
            new = _changes(batch.column("conv_id"))
            starts = np.flatnonzero(new)
            ends = np.append(starts[1:], len(new)) - 1
            total = lambda x: np.add.reduceat(x.astype(np.int64), starts)  # noqa: B023, E731
            stays = ~blank & ~later
            legal = np.zeros(len(new), bool)
            legal[1:] = LEGAL[cls[:-1], cls[1:]]
            dated = batch.column("turn").is_valid().to_numpy(zero_copy_only=False)
            turn = batch.column("turn").fill_null(0).to_numpy()
            other_turn = _changes(batch.column("turn")) | new
            figures = np.stack(
                [
                    total(np.where(blank, n, 0)),
                    total(np.where(blank, 0, np.where(later, n, n - 1))),
                    total(stays & cut),
                    total(n - 1 + (~new & ~legal)),
                    cls[starts],
                    cls[ends],
                    total(other_turn & dated),
                    np.minimum.reduceat(np.where(dated, turn, 2**63 - 1), starts),
                    np.maximum.reduceat(np.where(dated, turn, -(2**63)), starts),
                    dated[starts],
                    turn[starts],
                    dated[ends],
                    turn[ends],
                ],
                axis=1,
            ).astype("<i8")
            # a row that stays is one of its symbol, its further copies go
            symbol = np.stack([np.where(stays, cls + 4 * cut, MUST_GO), np.full(len(n), MUST_GO)], 1).ravel()
            count = np.stack([np.where(stays, 1, n), np.where(stays, n - 1, 0)], 1).ravel()
            owner = np.repeat(np.cumsum(new) - 1, 2)
            symbol, count, owner = (x[count > 0] for x in (symbol, count, owner))
            run = np.flatnonzero(np.concatenate([[True], (symbol[1:] != symbol[:-1]) | (owner[1:] != owner[:-1])]))
            sums = np.stack([symbol[run], np.add.reduceat(count, run)], 1).astype("<i8")
            edge = np.searchsorted(owner[run], np.arange(len(starts) + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id").take(pa.array(starts)),
                    pa.array(np.full(len(starts), part)),
                    pa.array(np.full(len(starts), seg)),
                    pa.array([x.tobytes() for x in figures], pa.binary()),
                    pa.array([sums[a:b].tobytes() for a, b in zip(edge, edge[1:])], pa.binary()),
                ],
                names=["conv_id", "part", "seg", "figures", "runs"],
            )
            seg += 1

    kind = symbols.schema["conv_id"].dataType.simpleString()
    return symbols.mapInArrow(work, f"conv_id {kind}, part long, seg long, figures binary, runs binary")


class Summary:
    """Figures, cost and audit of a conversation out of its segments in order."""

    def __init__(self, segments: list[tuple[bytes, bytes]]):
        self.gaps = self.blank = self.duplicate = self.truncated = self.illegal = 0
        low, high, turns, last, runs = None, None, 0, None, []
        for figures, packed in segments:
            f = dict(zip(FIGURES, np.frombuffer(figures, "<i8").tolist()))
            self.blank, self.duplicate, self.truncated, self.illegal = (getattr(self, x) + f[x] for x in ("blank", "duplicate", "truncated", "illegal"))
            if last:
                self.illegal += not LEGAL[last["last_cls"], f["first_cls"]]
                turns -= bool(last["last_dated"] and f["first_dated"] and last["last_turn"] == f["first_turn"])
            turns += f["turns"]
            if f["turns"]:
                low, high = f["low"] if low is None else min(low, f["low"]), f["high"] if high is None else max(high, f["high"])
            last = f
            runs += map(tuple, np.frombuffer(packed, "<i8").reshape(-1, 2).tolist())
        if low is not None:
            self.gaps = high - low + 1 - turns
        merged: list[tuple[int, int]] = []
        for symbol, n in runs:
            merged.append((symbol, merged.pop()[1] + n) if merged and merged[-1][0] == symbol else (symbol, n))
        self.cost, self.audit = repair(merged)


# --- repaired rows ---------------------------------------------------------------------


def _walk(batches: Iterator[pa.RecordBatch]):
    """Events of sorted rows: ("open", conv_id, summary), then ("row", edit,
    role, text) per repaired row, then ("close",), per conversation."""
    segments: list[tuple[bytes, bytes]] = []
    audit, at, state, opened, current = "", 0, 0, False, None

    def given():
        nonlocal state
        role = GIVEN[state]
        state = NEXT[role][state]
        return NAME[role]

    def start():
        nonlocal audit, at, state, opened
        summary = Summary(segments)
        segments.clear()
        audit, at, state, opened = summary.audit, 0, 0, True
        return "open", current[0], summary

    def added():
        nonlocal at
        while at < len(audit) and audit[at] == "I":
            at += 1
            yield "row", "I", given(), ""

    def end():
        if current is not None:
            if not opened:
                yield start()
            yield from added()
            yield ("close",)

    for batch in batches:
        for conv, kind, figures, runs, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "kind", "figures", "runs", "role", "text"))):
            if current is None or (conv,) != current:
                yield from end()
                current, opened = (conv,), False
            if kind == 0:
                continue
            if kind == 1:
                segments.append((figures, runs))
                continue
            if not opened:
                yield start()
            yield from added()
            edit = audit[at]
            at += 1
            if edit == "K":
                state = NEXT[{"s": S, "u": U, "a": A}[role[:1]]][state]
                yield "row", edit, role, text
            elif edit == "R":
                yield "row", edit, given(), text
    yield from end()


def _together(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Per conversation in one partition and in order: a row of its id, its
    segments, its rows."""
    own = _ordered(rows)
    symbols = written(_symbols(own), "symbols")  # dealing out by ranges reads its input twice
    order = ["conv_id", "turn", "role", "mark"]
    segments = written(_segments(symbols.repartitionByRange(*order).sortWithinPartitions(*order)), "segments")
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    blank = [none("string", "role"), none("string", "text"), none("binary", "mark")]
    heads = ids.select("conv_id").distinct().select("conv_id", F.lit(0).alias("kind"), none("long", "part"), none("long", "seg"), none("binary", "figures"), none("binary", "runs"), *blank)
    parts = segments.select("conv_id", F.lit(1).alias("kind"), "part", "seg", "figures", "runs", *blank)
    texts = own.select("conv_id", F.lit(2).alias("kind"), F.lit(0).cast("long"), F.col("turn"), none("binary", "figures"), none("binary", "runs"), "role", "text", "mark")
    everything = heads.union(parts).union(texts)
    return everything.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "part", F.col("seg").asc_nulls_first(), "role", "mark")


def repaired_rows(rows: DataFrame) -> DataFrame:
    """The repaired conversations of rows (conv_id, turn, role, text), row by
    row: conv_id, place (from 0), edit (K kept, R rerole'd, I inserted), role, text."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    id_type = to_arrow_type(rows.schema["conv_id"].dataType)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, conv, place = [], None, 0
        pack = lambda: pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((id_type, pa.int64(), pa.string(), pa.string(), pa.string()))], names=["conv_id", "place", "edit", "role", "text"])
        for event in _walk(batches):
            if event[0] == "open":
                conv, place = event[1], 0
            elif event[0] == "row":
                out.append((conv, place, *event[1:]))
                place += 1
                if len(out) == 1000:
                    yield pack()
                    out.clear()
        if out:
            yield pack()

    return _together(rows, rows).mapInArrow(work, f"conv_id {kind}, place long, edit string, role string, text string")


def repair_report(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Per conversation of ``ids``: conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256, for rows (conv_id, turn, role, text).

    Null roles and texts count as one space. Rows go by turn, null turns first,
    those of one turn by role, then by the MD5 of their text; equal rows are
    duplicates of the first. Rows without id are one conversation. A conversation
    of which no rows are left has zeros, an empty audit and the empty text's hash.
    Extra columns are ignored; an empty table gives an empty result.
    """
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    kind = ids.schema["conv_id"].dataType.simpleString()
    id_type = to_arrow_type(ids.schema["conv_id"].dataType)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, sha, conv, summary, fresh = [], None, None, None, True
        pack = lambda: pa.RecordBatch.from_arrays([pa.array([r[k] for r in out]) if k else pa.array([r[0] for r in out], id_type) for k in range(len(out[0]))], names=["conv_id", *names, "audit", "repaired_sha256"])
        for event in _walk(batches):
            if event[0] == "open":
                _, conv, summary = event
                sha, fresh = hashlib.sha256(), True
            elif event[0] == "row":
                sha.update(f"{'' if fresh else chr(10)}{event[2]}:{event[3]}".encode())
                fresh = False
            else:
                out.append((conv, *(getattr(summary, x) for x in names), summary.audit, sha.hexdigest()))
                if len(out) == 1000:
                    yield pack()
                    out.clear()
        if out:
            yield pack()

    columns = ", ".join(f"{x} long" for x in names)
    return _together(rows, ids).mapInArrow(work, f"conv_id {kind}, {columns}, audit string, repaired_sha256 string")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations, repaired at least cost."""
    ship(spark)
    rows = read_table(spark, sf_dir, "conversations")
    return repair_report(damage(rows), rows)
