"""Column helpers for turning free-text race fields into typed values.

Every helper takes and returns a ``Column`` built from native Spark
expressions, so they run inside whole-stage codegen on batch and streaming
DataFrames alike (no Python UDF anywhere).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the source semantics) --------------------------
MI_TO_KM = 1.609344
NUMBER_PATTERN = r"([0-9]*\.?[0-9]+)"
TRAILING_UNIT_PATTERN = r"([a-zA-Z]+)$"
PERFORMANCE_UNIT_PATTERN = r"(?i)(km|h)\s*$"
# groups: days in front of a clock time (optional), hours, minutes, seconds
CLOCK_PATTERN = r"(?s)^(?:(\d+)\s+(?=\d+:\d+:\d+))?.*?(\d+):(\d+):(\d+)\s*h.*$"
HMS_PATTERN = r"(\d+:\d+:\d+)\s*h"
DATE_PREFIX_PATTERN = r"^(\d{2}\.\d{2}\.\d{4})"
DATE_FORMAT = "dd.MM.yyyy"
CLOCK_SECONDS = [86400.0, 3600.0, 60.0, 1.0]
# Strict variant: accepts "1d 05:00:00 h" and an upper-case "H".
STRICT_CLOCK_PATTERN = r"(?si)^(?:(\d+)\s*d?\s+(?=\d+:\d+:\d+))?.*?(\d+):(\d+):(\d+)\s*h.*$"
STRICT_HMS_PATTERN = r"(?i)(\d+:\d+:\d+)\s*h"
# -----------------------------------------------------------------------------

def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_double(c: Column | str) -> Column:
    """String -> double; text that is not a number (including '') -> NULL."""
    return _col(c).try_cast("double")


def blank_to_null(c: Column | str) -> Column:
    """'' -> NULL, anything else unchanged."""
    return F.nullif(_col(c), F.lit(""))


def first_number(c: Column | str) -> Column:
    """First unsigned decimal number in the text, as double (NULL if none)."""
    return safe_double(F.regexp_extract(_col(c), NUMBER_PATTERN, 1))


def trailing_unit(c: Column | str) -> Column:
    """Lower-cased run of letters that ends the text ('' if it does not end in one)."""
    return F.lower(F.regexp_extract(_col(c), TRAILING_UNIT_PATTERN, 1))


def performance_unit(trimmed: Column | str) -> Column:
    """'h' for a time performance, 'km' for a distance one, else NULL."""
    return blank_to_null(F.lower(F.regexp_extract(_col(trimmed), PERFORMANCE_UNIT_PATTERN, 1)))


def hms_seconds(trimmed: Column | str, strict: bool = False) -> Column:
    """'[D ]H:MM:SS h' -> seconds as double; NULL when no H:MM:SS h is found."""
    t = _col(trimmed)
    parts = F.split(F.regexp_replace(t, STRICT_CLOCK_PATTERN if strict else CLOCK_PATTERN, "$1|$2|$3|$4"), r"\|")
    worth = F.array(*map(F.lit, CLOCK_SECONDS))
    each = F.zip_with(parts, worth, lambda part, w: F.coalesce(safe_double(part), F.lit(0.0)) * w)
    return F.when(has_hms(t, strict), F.aggregate(each, F.lit(0.0), lambda total, x: total + x))


def has_hms(trimmed: Column | str, strict: bool = False) -> Column:
    """True exactly when ``hms_seconds`` is not NULL (cheap: one regex test)."""
    return _col(trimmed).rlike(STRICT_HMS_PATTERN if strict else HMS_PATTERN)


def has_number(c: Column | str) -> Column:
    """True exactly when ``first_number`` is not NULL (the text has a digit)."""
    return _col(c).rlike("[0-9]")


def leading_date(c: Column | str) -> Column:
    """Date from a leading 'dd.MM.yyyy' (ranges keep their first day); else NULL."""
    head = F.regexp_extract(_col(c), DATE_PREFIX_PATTERN, 1)
    return F.try_to_date(F.nullif(head, F.lit("")), DATE_FORMAT)


def hash_key(*cols: Column | str, sep: str = "|") -> Column:
    """sha2-256 hex of the columns as text (NULL -> ''), joined by ``sep``.

    Deterministic and stateless, so it is safe on streams (no row numbers).
    """
    parts = [F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols]
    body = parts[0] if len(parts) == 1 else F.concat_ws(sep, *parts)
    return F.sha2(body, 256)
