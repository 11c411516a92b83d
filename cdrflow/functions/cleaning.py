"""Column-level cleaning and conversion functions (all JVM-side expressions).

Every function takes and returns ``pyspark.sql.Column`` so it composes into a
single projection inside whole-stage codegen; no Python UDF is involved.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Regex anchors are \A ... \z: Java's "$" also matches before a trailing line
# break, so "123\r" would pass a "^...$" guard.
NUMBER_PATTERN = r"\A[+-]?[0-9]+(\.[0-9]+)?\z"
DIGITS_PATTERN = r"\A[0-9]+\z"
MSISDN_CHARS_PATTERN = r"\A[0-9+]+\z"

# Largest epoch second whose date-time is still in year 9999.
MAX_EPOCH_SECONDS = 253402300799

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c) -> Column:
    """'' -> NULL (the target store treats an empty string as NULL)."""
    return F.nullif(_col(c), F.lit(""))


def is_blank(c) -> Column:
    """NULL, empty or blanks only (space trimming, as the target store does)."""
    return F.nullif(F.trim(_col(c)), F.lit("")).isNull()


def clean_msisdn(c) -> Column:
    """Remove CR, LF, TAB and every blank; '+' and other characters stay."""
    return F.translate(_col(c), "\r\n\t ", "")


def apply_transform(c, transform: str | None) -> Column:
    c = _col(c)
    if transform is None:
        return c
    if transform == "trim":
        return F.trim(c)
    if transform == "upper":
        return F.upper(F.trim(c))
    if transform == "clean_msisdn":
        return clean_msisdn(c)
    raise ValueError(f"unknown transform {transform!r}")


def clean_string(c, spec) -> Column:
    """Transform, cut to ``max_length``, fill the default, blank -> NULL."""
    e = apply_transform(c, spec.transform)
    if spec.extra is not None:
        e = spec.extra(e)
    if spec.max_length is not None:
        e = F.substring(e, 1, int(spec.max_length))
    if not spec.required and isinstance(spec.default, str):
        e = F.coalesce(blank_to_null(e), F.lit(spec.default))
    return blank_to_null(e)


def number_guard(c) -> Column:
    return F.regexp_like(_col(c), F.lit(NUMBER_PATTERN))


def safe_number(c, precision: int, scale: int) -> Column:
    """Guarded numeric conversion of the *untrimmed* text; never rejects a row.

    Text that is not ``[+-]digits[.digits]`` gives NULL; the value is rounded
    half away from zero to ``scale``; an overflow gives NULL (see ``overflows``).
    """
    c = _col(c)
    return F.when(number_guard(c), c.try_cast(T.DecimalType(precision, scale)))


def overflows(c, precision: int, scale: int) -> Column:
    """True when the text is a number that does not fit DECIMAL(p, s)."""
    c = _col(c)
    return F.coalesce(
        number_guard(c) & c.try_cast(T.DecimalType(precision, scale)).isNull(), F.lit(False)
    )


def epoch_value(c, unit: str = "seconds") -> Column:
    """Epoch text -> whole seconds (bigint), NULL when not a valid epoch.

    Valid = digits only on the untrimmed text, fits a bigint, and the result
    is not after 9999-12-31 23:59:59. Milliseconds round half up to the second.
    """
    c = _col(c)
    n = c.try_cast(T.LongType())
    if unit == "seconds":
        secs = n
    elif unit == "milliseconds":
        secs = F.floor((n + F.lit(500)) / F.lit(1000)).cast(T.LongType())
    else:
        raise ValueError(f"unknown timestamp unit {unit!r}")
    ok = F.regexp_like(c, F.lit(DIGITS_PATTERN)) & n.isNotNull() & (secs <= F.lit(MAX_EPOCH_SECONDS))
    return F.when(ok, secs)


def valid_epoch(c, unit: str = "seconds") -> Column:
    return F.coalesce(epoch_value(c, unit).isNotNull(), F.lit(False))


def epoch_to_ntz(c, unit: str = "seconds") -> Column:
    """Epoch text -> zone-free date-time (TIMESTAMP_NTZ, whole seconds).

    Plain arithmetic from 1970-01-01, so the result does not depend on the
    session time zone.
    """
    return F.timestamp_add("SECOND", epoch_value(c, unit), F.expr(EPOCH_NTZ))


def start_hour(ts) -> Column:
    return F.hour(_col(ts)).cast(T.IntegerType())


def dedup_key(keys, max_length: int | None = None) -> Column:
    """First non-blank (trimmed) key in priority order, cut like the key column."""
    e = F.coalesce(*[blank_to_null(F.trim(_col(k))) for k in keys])
    if max_length is not None:
        e = F.substring(e, 1, int(max_length))
    return e


def ntz(literal: str) -> Column:
    """A TIMESTAMP_NTZ literal, independent of the session time zone."""
    return F.expr(f"TIMESTAMP_NTZ'{literal}'")
