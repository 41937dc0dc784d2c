"""Quality rules by weak supervision (operator 10).

Rules vote good (+1), bad (-1) or abstain (0) on every text. Expectation
maximisation estimates, without labels, how often each rule votes and how
often its vote is right in good and in bad texts; the posterior probability of
"good" replaces an all-must-pass filter. The rules' votes are counted over all
documents; the model sees one row per pattern of votes (at most
3 ** number of rules), whatever the number of documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacelake.llm.text import BASE, IS_SPACE, U64, Texts, mix, shingles, slices

SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_digits", "n_ended")
#: Belief about a rule's votes (bad, abstain, good) on bad and on good texts, and its weight against the data:
#: rules are written so that good texts seldom trip them, and a bad text trips one in four. Without it the
#: classes may split along any strong pattern.
PRIORS = np.array([[0.25, 0.15, 0.6], [0.003, 0.05, 0.947]])
PRIOR_WEIGHTS = (0.2, 5.0)
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS)] = True
_END = np.zeros(256, dtype=bool)
_END[list(b".!?:;\"')")] = True


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Flags of the keys that occur twice or more."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    same = s[1:] == s[:-1]
    out = np.zeros(len(keys), dtype=bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _later(keys: np.ndarray) -> np.ndarray:
    """Flags of the keys equal to an earlier one."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    out = np.zeros(len(keys), dtype=bool)
    out[order[1:][s[1:] == s[:-1]]] = True
    return out


def text_counts(col: pa.Array, window: int = 5) -> dict[str, np.ndarray]:
    """Counts of every text of a batch (null as empty), all vectorised."""
    t = Texts(col)
    raw, solid = t.raw, ~IS_SPACE[t.raw]
    start, end, at = t.words()
    out = {
        "n_words": np.diff(at),
        "word_chars": t.count(solid & ((raw & 0xC0) != 0x80)),
        "n_symbols": t.count(_SYMBOL[raw]),
        "n_upper": t.count((raw >= 65) & (raw <= 90)),
        "n_letters": t.count(((raw | 32) >= 97) & ((raw | 32) <= 122)),
        "n_digits": t.count((raw >= 48) & (raw <= 57)),
    }
    # lines: cut at \n and at the bounds of texts
    cut = np.flatnonzero(raw == 10)
    first = np.unique(np.concatenate([t.offsets[:-1], cut + 1]))
    first = first[first < len(raw)]
    last = np.append(first[1:], len(raw)) if len(first) else first
    closed = np.zeros(len(raw) + 1, dtype=bool)
    closed[cut + 1] = True
    last = last - closed[last]  # without its \n
    words_before = np.concatenate([[0], np.cumsum(solid)])
    has = words_before[last] > words_before[first]
    first, last = first[has], last[has]
    line_of = np.searchsorted(t.offsets, first, side="right") - 1
    with np.errstate(over="ignore"):
        keys = mix(t.span_hashes(first, last, lower=False) + mix(line_of.astype(np.uint64) * BASE))
    out["n_lines"] = np.bincount(line_of, minlength=t.n)
    out["n_dup_lines"] = np.bincount(line_of[_later(keys)], minlength=t.n)
    final = np.searchsorted(end, last, side="right") - 1  # the last word that ends in the line
    out["n_ended"] = np.bincount(line_of[_END[raw[end[final] - 1]]], minlength=t.n) if len(first) else np.zeros(t.n, int)
    # words in windows that occur twice or more in the text
    sh, owner, pos = shingles(t.span_hashes(start, end, lower=False), at, window)
    with np.errstate(over="ignore"):
        twice = _repeated(mix(sh + mix(owner.astype(np.uint64) * BASE + U64(1))))
    cover = np.zeros(len(start) + 1, dtype=np.int64)
    np.add.at(cover, pos[twice], 1)
    np.add.at(cover, pos[twice] + window, -1)
    inside = np.cumsum(cover[:-1]) > 0
    out["n_repeat_words"] = np.diff(np.concatenate([[0], np.cumsum(inside)])[at])
    return out


def with_counts(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns of every row and the counts of its whole text, as long."""
    from pyspark.sql import types as T

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                c = text_counts(part.column("_text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column(f"_k{i}") for i in range(len(keep))] + [pa.array(c[k].astype(np.int64)) for k in COUNTS],
                    names=[*(f"_k{i}" for i in range(len(keep))), *COUNTS],
                )

    own = docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], F.col(text).alias("_text"))
    schema = T.StructType([*own.drop("_text").schema.fields, *[T.StructField(c, T.LongType()) for c in COUNTS]])
    got = own.mapInArrow(count, schema)
    return got.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], *COUNTS)


def _share(a: str, b: str) -> Column:
    return F.col(a) / F.greatest(F.col(b), F.lit(1))


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0).cast("byte")


def rules() -> dict[str, Column]:
    """Name -> vote, each a pair of thresholds on the counts with room to
    abstain in between. Signs of machine noise vote bad, ordinary prose good."""
    w, mean = F.col("n_words"), _share("word_chars", "n_words")
    symbols, dup, rep = _share("n_symbols", "n_words"), _share("n_dup_lines", "n_lines"), _share("n_repeat_words", "n_words")
    upper, digit, ended = _share("n_upper", "n_letters"), _share("n_digits", "word_chars"), _share("n_ended", "n_lines")
    return {
        "length": _vote(w.between(30, 100_000), w < 3),
        "word_length": _vote(mean.between(3, 10), (mean < 2.5) | (mean > 14)),
        "symbols": _vote(symbols < 0.05, symbols > 0.2),
        "symbol_share": _vote(_share("n_symbols", "word_chars") < 0.03, _share("n_symbols", "word_chars") > 0.1),
        "repeated_lines": _vote(dup < 0.1, dup > 0.5),
        "repeated_windows": _vote(rep < 0.05, rep > 0.2),
        "capitals": _vote(upper < 0.15, upper > 0.4),
        "digits": _vote(digit < 0.05, digit > 0.2),
        "line_ends": _vote(ended > 0.6, ended < 0.3),
    }


def fit_votes(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 200, prior: float = 0.9) -> dict[tuple[int, ...], float]:
    """Expectation maximisation over counted patterns of votes: class shares,
    and for each rule and class the chance of each vote. Starts from the belief
    that a text without bad votes is good with chance ``prior``, any other bad
    with the same chance; returns the posterior of "good" per pattern.

    The priors keep the classes' sense. Without patterns the result is empty.
    """
    if not patterns:
        return {}
    votes = np.array([p for p, _ in patterns]) + 1  # 0 bad, 1 abstain, 2 good
    n = np.array([c for _, c in patterns], dtype=float)
    good = np.where((votes == 0).any(1), 1 - prior, prior)
    for _ in range(rounds):
        share = (n * good).sum() / n.sum()
        like = np.zeros((len(n), 2))
        for k, r in enumerate((1 - good, good)):
            like[:, k] = math.log(max(1e-9, share if k else 1 - share))
            for j in range(votes.shape[1]):
                p = np.bincount(votes[:, j], weights=n * r, minlength=3) + PRIORS[k] * PRIOR_WEIGHTS[k] * n.sum()
                like[:, k] += np.log(p / p.sum())[votes[:, j]]
        new = 1 / (1 + np.exp(np.clip(like[:, 0] - like[:, 1], -500, 500)))
        done, good = np.abs(new - good).max() < 1e-9, new
        if done:
            break
    return {p: float(g) for (p, _), g in zip(patterns, good)}


def quality_filter(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns, counts, base_failed, votes, probability and kept.

    Null and empty texts have no words: they fail the base. A text with no
    vote at all gets the pattern of abstentions and its posterior. Repeated
    rows are rated like others; an empty table gives an empty result.
    """
    from pacelake.llm.common import written

    named = rules()
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rated = written(
        with_counts(docs, keep, text).withColumn("base_failed", base).withColumn("votes", F.array(*named.values())), "votes"
    )
    counted = rated.groupBy("votes").agg(F.count("*").alias("n")).collect()  # at most 3 ** rules rows
    posterior = fit_votes(sorted((tuple(r["votes"]), r["n"]) for r in counted))
    table = rated.sparkSession.createDataFrame(
        [(list(v), p) for v, p in posterior.items()], "votes array<byte>, probability double"
    )
    return rated.join(F.broadcast(table), "votes").withColumn("kept", ~F.col("base_failed") & (F.col("probability") >= 0.5))


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Every document with its base counts, the posterior and the verdict."""
    from pacelake.llm.common import documents

    out = quality_filter(documents(spark, sf_dir), ["doc_id"])
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("probability", 9).alias("probability")
    )
