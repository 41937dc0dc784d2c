"""Data-quality operators: JSON spec validation, star-schema audit, result
comparison and table profiling. All are single Spark jobs over whole
tables (no driver-side loops over rows)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pacelake.operators.exact_quantiles import quantiles
from pacelake.session import scratch_path

c = F.col


def _null_str() -> Column:
    return F.lit(None).cast("string")


def _first_reason(checks: Sequence[tuple[Column, str]]) -> Column:
    """The label of the first failing check (NULL when all pass)."""
    expr = None
    for failed, label in checks:
        expr = F.when(failed, F.lit(label)) if expr is None else expr.when(failed, F.lit(label))
    return expr.otherwise(_null_str())


def _json_object(text: Column) -> Column:
    """Outermost {...} of the text (markdown fences and prose around it dropped)."""
    return F.regexp_extract(text, r"(?s)\{.*\}", 0)


# A number as Python's float() reads it: sign, digits with single underscores
# between them, fraction, exponent, white space around. No Java suffix (1d, 1f).
_DIGITS = r"[0-9]+(?:_[0-9]+)*"
NUMBER_TEXT = rf"^\s*[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?\s*$"


def _number_of(raw: Column) -> Column:
    """The number a JSON scalar's text stands for, as double; NULL if none."""
    return F.when(raw.rlike(NUMBER_TEXT), F.regexp_replace(F.trim(raw), "_", "").try_cast("double"))


def _entries(entries: str, key: str) -> Column:
    """A map's entries of one key, in order."""
    return F.filter(entries, lambda e: e["key"] == key)


# --- R1: JSON specs --------------------------------------------------------------

def validate_json_specs(
    df: DataFrame,
    text_col: str,
    required: Sequence[str],
    int_ranges: dict[str, tuple[int, int]] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Parse a JSON object out of free text and check it.

    Output: ``keep`` columns, one column per required key (longs for keys in
    ``int_ranges``, text otherwise, a JSON null as NULL) and ``reject_reason``
    (NULL when the row is accepted). Of a repeated key the last value counts.
    Reasons, first one wins: no JSON object
    (also for a NULL text), invalid JSON (also text after the object, or single
    quotes), missing keys, non-numeric <key>, <key> out of range (fractions are
    cut off first). A check that cannot be decided counts as failed.
    """
    int_ranges = int_ranges or {}
    obj = F.coalesce(_json_object(c(text_col)), F.lit(""))
    # read as the only element of an array, the object must be the whole text; one parse gives keys and values
    items = F.from_json(F.concat(F.lit("["), obj, F.lit("]")), "array<map<string,string>>", {"allowSingleQuotes": "false", "mode": "PERMISSIVE"})
    parsed = df.select(*keep, obj.alias("_obj"), items.alias("_items"))
    parsed = parsed.withColumn("_j", F.when(F.size("_items") == 1, F.map_entries(c("_items")[0])))
    found = {k: _entries("_j", k) for k in required}
    missing = reduce(lambda a, b: a | b, [F.size(x) == 0 for x in found.values()])
    checks: list[tuple[Column, str]] = [
        (c("_obj") == "", "no JSON object"),
        (c("_j").isNull(), "invalid JSON"),
        (missing, "missing keys"),
    ]
    values = {}
    for k in required:
        raw = F.try_element_at(found[k], F.lit(-1))["value"]  # of a repeated key the last counts
        if k in int_ranges:
            lo, hi = int_ranges[k]
            number = _number_of(raw)
            whole = F.when(number >= 0, F.floor(number)).otherwise(F.ceil(number))
            checks.append((number.isNull(), f"non-numeric {k}"))
            # compared as doubles: a number beyond any integer type is out of range like others
            checks.append((~F.when(F.abs(number) < 2.0**53, whole.between(lo, hi)).otherwise(F.lit(False)), f"{k} out of range"))
            values[k] = F.when(F.abs(number) < 2.0**63, whole).cast("long")
        else:
            values[k] = raw
    return parsed.select(
        *keep,
        *[v.alias(k) for k, v in values.items()],
        _first_reason([(F.coalesce(failed, F.lit(True)), label) for failed, label in checks]).alias("reject_reason"),
    )


# --- fixed values for race event specs -------------------------------------------
EVENT_SPEC_KEYS = ["event_name", "country", "distance_km", "n_finishers"]
EVENT_DISTANCE_RANGE = (50, 250)
EVENT_FINISHERS_RANGE = (30, 300)
CSV_BREAKERS = r"[,\"\r\n\t]+"
COUNTRY_CODE = r"^[A-Z]{3}$"
CODE_SUFFIX = r"(?U)\s*\([A-Z]{3}\)\s*$"
NULL_NAME = "None"
# -----------------------------------------------------------------------------------

# (?U): white space in the Unicode sense
_OUTER_SPACE = r"(?U)^\s+|\s+$"


def validate_event_specs(df: DataFrame, text_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """Race event specs: name, 3-letter country code, distance 50-250 km,
    30-300 finishers. The name loses what would break a CSV row (comma, quote,
    CR, LF, TAB), has white space squeezed, and ends with '(CODE)'; a JSON null
    as name is the text "None". Name and country are checked before the
    numbers."""
    specs = validate_json_specs(
        df,
        text_col,
        EVENT_SPEC_KEYS,
        {"distance_km": EVENT_DISTANCE_RANGE, "n_finishers": EVENT_FINISHERS_RANGE},
        keep=keep,
    ).withColumnRenamed("reject_reason", "_found")
    name = F.regexp_replace(F.coalesce("event_name", F.lit(NULL_NAME)), CSV_BREAKERS, " ")
    name = F.regexp_replace(F.regexp_replace(name, r"(?U)\s+", " "), _OUTER_SPACE, "")
    country = F.upper(F.regexp_replace("country", _OUTER_SPACE, ""))
    named = specs.withColumns({"_name": name, "_code": country}).withColumn("_tail", F.concat(F.lit("("), "_code", F.lit(")")))
    stem = F.regexp_replace(F.regexp_replace("_name", CODE_SUFFIX, ""), _OUTER_SPACE, "")
    full = F.when(c("_name").endswith(c("_tail")), c("_name")).otherwise(F.concat_ws(" ", stem, "_tail"))
    reason = (
        F.when(c("_found").isin("no JSON object", "invalid JSON", "missing keys"), c("_found"))
        .when(c("_name") == "", F.lit("empty event_name"))
        .when(~F.coalesce(c("_code").rlike(COUNTRY_CODE), F.lit(False)), F.lit("bad country code"))
        .otherwise(c("_found"))
    )
    accepted = named.withColumn("reject_reason", reason).withColumn("_full", full)
    ok = c("reject_reason").isNull()
    return accepted.select(
        *keep,
        F.when(ok, c("_full")).alias("event_name"),
        F.when(ok, c("_code")).alias("country"),
        F.when(ok, c("distance_km")).alias("distance_km"),
        F.when(ok, c("n_finishers")).alias("n_finishers"),
        "reject_reason",
    )


# --- R2: star-schema audit ---------------------------------------------------------

def _columns(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def audit_star_schema(
    tables: dict[str, DataFrame],
    primary_keys: dict[str, str | Sequence[str]],
    foreign_keys: Sequence[tuple[str, str, str, str]],
    not_null: dict[str, Sequence[str]] | None = None,
    counted: dict[str, dict[str, int]] | None = None,
) -> DataFrame:
    """Report of key violations, one row per check.

    primary_keys: table -> key column or columns (violations = rows beyond the
        first per key value, plus rows with a NULL in the key).
    foreign_keys: (table, column, parent table, parent key); violations =
        non-NULL child values with no parent row.
    not_null: table -> columns that must not be NULL.
    counted: table -> NULLs per column, where they were counted when the table
        was written; such columns are not read again.

    A table's key and NULL checks are one aggregation. Each foreign key is counted
    per value in its own type, in a scan of that column alone (reduced on every
    mapper), before it meets the parent's keys.
    """
    report = "check_name string, table_name string, column_name string, n_violations long"
    not_null, counted = not_null or {}, counted or {}
    parts: list[DataFrame] = []
    known = [("not_null", t, x, counted[t][x]) for t, cols in not_null.items() for x in cols if x in counted.get(t, {})]
    if known:
        parts.append(next(iter(tables.values())).sparkSession.createDataFrame(known, report))
    not_null = {t: left for t, cols in not_null.items() if (left := [x for x in cols if x not in counted.get(t, {})])}
    for t in dict.fromkeys([*primary_keys, *not_null]):
        checks: list[tuple[str, str, Column]] = []
        if t in primary_keys:
            key = _columns(primary_keys[t])
            # rows - distinct keys without NULL = further copies + rows with a NULL key
            checks.append(("primary_key", ",".join(key), F.count(F.lit(1)) - F.count_distinct(*key)))
        checks += [("not_null", x, F.count_if(c(x).isNull())) for x in not_null.get(t, [])]
        wide = tables[t].agg(*[n.cast("long").alias(f"_n{i}") for i, (_, _, n) in enumerate(checks)])
        rows = [F.struct(F.lit(k), F.lit(t), F.lit(col), c(f"_n{i}").alias("_n")) for i, (k, col, _) in enumerate(checks)]
        parts.append(wide.select(F.inline(F.array(*rows)).alias("check_name", "table_name", "column_name", "n_violations")))
    for t, col, p, pk in foreign_keys:
        values = tables[t].groupBy(c(col).alias("_k")).agg(F.count(F.lit(1)).alias("_n")).where("_k is not null")
        orphans = values.join(tables[p].select(c(pk).alias("_p")), c("_k") == c("_p"), "left_anti").agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("n_violations"))
        parts.append(orphans.select(F.lit("foreign_key").alias("check_name"), F.lit(t).alias("table_name"), F.lit(f"{col}->{p}.{pk}").alias("column_name"), "n_violations"))
    if not parts:
        raise ValueError("no check asked for")
    return reduce(DataFrame.unionByName, parts)


# --- R3: result comparison ---------------------------------------------------------

COMPARE_BUCKETS = 4096


def _checked_columns(left: DataFrame, right: DataFrame, name_left: str, name_right: str) -> list[str]:
    kinds_left, kinds_right = dict(left.dtypes), dict(right.dtypes)
    found = [
        *(f"{x} only in {name_left}" for x in kinds_left if x not in kinds_right),
        *(f"{x} only in {name_right}" for x in kinds_right if x not in kinds_left),
        *(f"{x} is {t} in {name_left} and {kinds_right[x]} in {name_right}" for x, t in kinds_left.items() if kinds_right.get(x, t) != t),
    ]
    if found:
        raise ValueError("the results differ in their columns: " + "; ".join(found))
    return left.columns


def _row_hashes(cols: Sequence[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row; which columns are NULL counts, too (a hash
    skips NULLs)."""
    values = [c(x) for x in cols]
    nulls = [v.isNull() for v in values]
    return F.xxhash64(*values, *nulls), F.xxhash64(F.lit(1), *nulls, *values)


def checksum_differences(left: DataFrame, right: DataFrame, cols: Sequence[str], buckets: int = COMPARE_BUCKETS) -> DataFrame:
    """(bucket): where the two inputs differ as multisets of rows. Rows are dealt
    into buckets by a hash; a bucket's checksum is the number of its rows and the
    sums of four 32-bit parts of two hashes, which do not depend on the order and
    tell how often a row is there. Only the sums of buckets are shuffled."""
    one, two = _row_hashes(cols)
    low = lambda h: h.bitwiseAND(F.lit(0xFFFFFFFF))
    high = lambda h: F.shiftrightunsigned(h, 32)
    marked = lambda df, sign: df.select(one.alias("_a"), two.alias("_b"), F.lit(sign).cast("long").alias("_s"))
    both = marked(left, 1).union(marked(right, -1))
    parts = [F.sum("_s"), *(F.sum(c("_s") * part(c(h))) for h in ("_a", "_b") for part in (low, high))]
    sums = both.groupBy(F.pmod(c("_a"), F.lit(buckets)).cast("int").alias("bucket")).agg(*[x.alias(f"_p{i}") for i, x in enumerate(parts)])
    return sums.where(reduce(lambda x, y: x | y, [c(f"_p{i}") != 0 for i in range(len(parts))])).select("bucket")


def compare_results(left: DataFrame, right: DataFrame, name_left: str = "left", name_right: str = "right", buckets: int = COMPARE_BUCKETS) -> DataFrame:
    """Rows present in one input and not the other (multiset semantics).

    Output: ``side`` plus the row's columns plus ``n`` = how many more copies
    that side has. Empty when the inputs are equal as multisets. Columns are
    matched by name; a column that only one side has, or of another type, is
    an error.

    Checksums per bucket are compared first; only rows of buckets that differ
    (at most ``buckets`` numbers are read by the driver) are compared one by
    one: copies count +1 and -1 and are summed per row, pre-reduced on every
    mapper.
    """
    cols = _checked_columns(left, right, name_left, name_right)
    differ = [r.bucket for r in checksum_differences(left, right, cols, buckets).collect()]
    bucket = F.pmod(_row_hashes(cols)[0], F.lit(buckets)).cast("int")
    here = F.lit(True) if len(differ) == buckets else bucket.isin(differ) if differ else F.lit(False)
    marked = lambda df, sign: df.where(here).select(*cols, F.lit(sign).cast("long").alias("_n"))
    more = marked(left, 1).union(marked(right, -1)).groupBy(*cols).agg(F.sum("_n").alias("_n")).filter("_n <> 0")
    return more.select(
        F.when(c("_n") > 0, F.lit(name_left)).otherwise(F.lit(name_right)).alias("side"), *cols, F.abs("_n").alias("n")
    )


# --- heavy hitters --------------------------------------------------------------------

FREQUENT_BUCKETS = 1 << 16


def frequent_values(df: DataFrame, column: str, k: int, buckets: int = FREQUENT_BUCKETS) -> DataFrame:
    """The ``k`` most frequent values of a column with their exact counts (of
    equal counts the smallest values; NULL is no value).

    Pass 1 counts rows per hash bucket: a summary of at most ``buckets`` numbers
    that merges by adding up. A value has at most its bucket's rows. Pass 2 counts
    the values of the heaviest buckets only, more and more of them, until the
    k-th count found is greater than every bucket left out: then no other value
    can be among the first k. Only values of these buckets are shuffled. Where
    values are about equally frequent, that may be all of them.
    """
    spark = df.sparkSession
    rows = df.select(c(column).alias("value")).where("value is not null").withColumn("_h", F.pmod(F.xxhash64("value"), F.lit(buckets)).cast("int"))
    path = scratch_path(spark, "frequent")
    rows.groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).write.parquet(path)
    sizes = spark.read.schema("_h int, _n long").parquet(path)
    largest = [r._n for r in sizes.select("_n").orderBy(F.desc("_n")).limit(max(4 * k, 64)).collect()]
    least = largest[-1] if largest else 1
    while True:
        here = rows.join(sizes.where(c("_n") >= least).select("_h"), "_h", "left_semi")
        top = here.groupBy("value").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value").limit(k)
        if least <= 1:
            return top
        counts = [r.n for r in top.select("n").collect()]
        proven = max(1, counts[-1]) if len(counts) == k else 1
        if proven >= least:  # every bucket that may hold such a value was counted
            return top
        least = proven


# --- R5 / X1-X5: profiling -----------------------------------------------------------

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def shape(df: DataFrame) -> DataFrame:
    """X1: rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"))


def null_counts(df: DataFrame) -> DataFrame:
    """X3: NULL count of every column, one pass, one row."""
    return df.select([F.sum(c(x).isNull().cast("int")).cast("long").alias(x) for x in df.columns])


def _long_form(df: DataFrame, values: dict[str, Column], kind: str) -> DataFrame:
    """Rows (column_name, value), one per row of ``df`` and entry of ``values``."""
    rows = [F.struct(F.lit(x).alias("column_name"), v.cast(kind).alias("value")) for x, v in values.items()]
    return df.select(F.inline(F.array(*rows)))


_QUARTERS = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def numeric_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """X2: count, mean, stddev, min, exact quartiles, max; a row per column."""
    rows = _long_form(df, {x: c(x) for x in cols}, "double")
    stats = rows.groupBy("column_name").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("stddev"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    quarters = quantiles(rows, ["column_name"], "value", _QUARTERS).drop("n")
    return stats.join(quarters, "column_name", "left").select("column_name", "count", "mean", "stddev", "min", *_QUARTERS, "max")


def _value_hashes(x: str) -> Column:
    """A 128-bit hash of a value in its own type (NULL for NULL)."""
    return F.when(c(x).isNotNull(), F.struct(F.xxhash64(c(x)).alias("a"), F.xxhash64(F.lit(1), c(x)).alias("b")))


def profile_table(df: DataFrame) -> DataFrame:
    """R5, a row per column of any table: type, rows, NULLs, distinct values,
    the most frequent value with its count (of equals the smallest), and

    * numbers: min, max, mean, stddev, exact quartiles (as double);
    * all but floating numbers: smallest, greatest and most frequent value as
      text of the column's own type, so that long integers stay exact; the most
      frequent value of floating numbers is ``top_number``.

    Values are counted by a 128-bit hash of the value in its own type, reduced on
    every mapper; no text is shuffled. The value of the most frequent hash is then
    looked up in a scan of that column alone (the smallest value if all are
    equally frequent). The driver sees a row per column.
    """
    spark, fields = df.sparkSession, df.schema.fields
    own = df.select(*[(c(f.name) if isinstance(f.dataType, T.AtomicType) else c(f.name).cast("string")).alias(f"_v{i}") for i, f in enumerate(fields)])
    numeric = [i for i, f in enumerate(fields) if isinstance(f.dataType, _NUMERIC)]
    floating = [i for i, f in enumerate(fields) if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    each = [F.struct(F.lit(i).alias("_i"), _value_hashes(f"_v{i}").alias("_h")) for i in range(len(fields))]
    counts = own.select(F.inline(F.array(*each))).where("_h is not null").groupBy("_i", "_h").agg(F.count(F.lit(1)).alias("_n"))
    path = scratch_path(spark, "profile")
    counts.write.parquet(path)
    counts = spark.read.schema(counts.schema).parquet(path)
    per_count = counts.groupBy("_i", "_n").agg(F.count(F.lit(1)).alias("_m"))
    found = {r._i: r for r in per_count.groupBy("_i").agg(F.sum("_m").alias("distinct"), F.max("_n").alias("top"), F.max_by("_m", "_n").alias("ties")).collect()}

    def stats(i: int) -> list[Column]:
        v = c(f"_v{i}")
        out = [F.count_if(v.isNull()).alias(f"nulls{i}"), F.min(v).alias(f"min{i}"), F.max(v).alias(f"max{i}")]
        return out + ([F.avg(v.cast("double")).alias(f"mean{i}"), F.stddev_samp(v.cast("double")).alias(f"stddev{i}")] if i in numeric else [])

    wide = own.agg(F.count(F.lit(1)).alias("rows"), *[x for i in range(len(fields)) for x in stats(i)])
    tops = {}
    for i, r in found.items():
        if r.ties < r.distinct:
            best = counts.where((c("_i") == i) & (c("_n") == r.top)).select("_h")
            tops[i] = own.select(f"_v{i}", _value_hashes(f"_v{i}").alias("_h")).join(best, "_h", "left_semi").agg(F.min(f"_v{i}")).scalar()
    null = lambda kind: F.lit(None).cast(kind)
    rows = []
    for i, f in enumerate(fields):
        r = found.get(i)
        low, high = c(f"min{i}"), c(f"max{i}")
        top = null("string") if r is None else tops.get(i, low)
        number = i in numeric
        as_text = (lambda x: null("string")) if i in floating else (lambda x: x.cast("string"))
        rows.append(
            F.struct(
                F.lit(i).alias("_at"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"), c("rows").alias("n_rows"),
                c(f"nulls{i}").alias("n_nulls"), F.lit(r.distinct if r else 0).cast("long").alias("n_distinct"),
                *[(c(f"{x}{i}").cast("double") if number else null("double")).alias(x) for x in ("min", "max", "mean", "stddev")],
                as_text(low).alias("min_text"), as_text(high).alias("max_text"),
                (top.cast("double") if i in floating else null("double")).alias("top_number"), as_text(top).alias("top_text"),
                F.lit(r.top if r else None).cast("long").alias("top_count"),
            )
        )
    out = wide.select(F.inline(F.array(*rows)))
    if numeric:
        values = _long_form(own, {str(i): c(f"_v{i}") for i in numeric}, "double").withColumnRenamed("column_name", "_name")
        quarters = quantiles(values, ["_name"], "value", _QUARTERS).select(c("_name").cast("int").alias("_q"), *_QUARTERS)
        out = out.join(quarters, c("_at") == c("_q"), "left")
    else:
        out = out.withColumns({x: null("double") for x in _QUARTERS})
    names = ["column_name", "data_type", "n_rows", "n_nulls", "n_distinct", "min", "max", "mean", "stddev", *_QUARTERS, "min_text", "max_text", "top_number", "top_text", "top_count"]
    return out.orderBy("_at").select(*names)
