import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

from pacelake.llm.common import ship  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"

#: Columns of documents and some of other names that operators use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

AWKWARD = [
    None,
    "",
    " \t\n ",
    "word",
    "two  words",
    "one two three four five",
    "tab\tand\rreturn and no-break space",
    "Übung macht den Meister – 日本語 テキスト 😀 ▁mark <|endoftext|> don't, 1,000.50!",
    "repeat after me " * 40,
    "x" * 5000,
    " ".join(f"w{i % 977}" for i in range(30_000)),
]


def rows_of(texts, source="s", start=0):
    return [(start + i, t, "en", source, None if t is None else len(t)) for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def make(spark):
    ship(spark)

    def build(texts, **kw):
        rows = texts if texts and isinstance(texts[0], tuple) else rows_of(texts, **kw)
        return spark.createDataFrame(rows, SCHEMA)

    return build


@pytest.fixture(scope="session")
def awkward(spark, make):
    """Every awkward text, some twice, one row wholly null, extra columns whose
    names the operators use themselves."""
    rows = rows_of(AWKWARD) + rows_of(AWKWARD[3:6], start=3) + [(None, None, None, None, None), (None, "no id here", None, None, 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit(1) for c in ("id", "key", "keys", "size", "token", "score", "n", "part", "ids", "_text", "_t", "hub", "cls")})


@pytest.fixture(scope="session")
def empty(spark):
    ship(spark)
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    ship(spark)
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")
