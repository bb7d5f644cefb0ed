"""Scalar helpers (Column -> Column): safe casts, time parsing, e-mail split,
text sanitising, list helpers. Built-in expressions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Fixed patterns: text shapes that parse as integers / floating point numbers.
INT_TEXT_RE = r"^\s*[+-]?\d+\s*$"
NUM_TEXT_RE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def text_to_long(c) -> Column:
    """String -> long, null when not an integer or out of range. The shape is
    tested with a regex first, so that only integers meet try_cast."""
    x = col_of(c)
    return F.when(x.rlike(INT_TEXT_RE), F.trim(x).try_cast("long"))


def text_to_double(c) -> Column:
    """String -> double, null when not a plain decimal number."""
    x = col_of(c)
    return F.when(x.rlike(NUM_TEXT_RE), F.trim(x).cast("double"))


def safe_double(c) -> Column:
    """Numeric value -> double; NaN and +-Inf become null (a stat must be a
    finite float). Strings go through ``text_to_double``."""
    x = col_of(c).cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(None).cast("double")).otherwise(x)


def safe_long(c) -> Column:
    x = col_of(c).cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(None).cast("long")).otherwise(x.cast("long"))


def non_empty(c) -> Column:
    return F.nullif(col_of(c).cast("string"), F.lit(""))


def once(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)`` with ``value`` computed once per row, however often ``f`` uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def parse_iso8601(c) -> Column:
    """ISO-8601 text (extended or basic form, a fraction of any length, cut to
    microseconds) -> timestamp; a trailing offset or 'Z' is replaced by UTC (not
    converted), bad text -> null."""
    s = F.regexp_replace(col_of(c), r"Z$|(?=[+-])(?<=[T ][0-9:.,]{1,40})[+-]\d{2}(:?\d{2}){0,2}$", "")
    s = F.regexp_replace(s, r"^(\d{4})(\d{2})(\d{2})(?=[T ]|$)", "$1-$2-$3")
    s = F.regexp_replace(s, r"(?<=[T ])(\d{2})(\d{2})(\d{2})?(?=[.,]|$)", "$1:$2:$3")
    whole = F.regexp_extract(s, r"^(\d{4}-\d{2}-\d{2})(?:[T ](\d{2})(?::(\d{2}))?(?::(\d{2}))?:?(?:[.,](\d+))?)?$", 0)

    def stamp(whole: Column) -> Column:
        part = lambda i: F.regexp_extract(whole, r"^(.{10})(?:[T ](\d{2})(?::(\d{2}))?(?::(\d{2}))?:?(?:[.,](\d+))?)?$", i)
        clock = F.concat_ws(":", *[F.lpad(part(i), 2, "0") for i in (2, 3, 4)])
        text = F.concat(part(1), F.lit(" "), clock, F.lit("."), F.rpad(part(5), 6, "0"))
        return F.when(whole != "", F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS")))

    return once(whole, stamp)


def parse_us_datetime(c) -> Column:
    """'5/31/2024 1:02:03 PM' -> timestamp, bad -> null."""
    return F.try_to_timestamp(col_of(c), F.lit("M/d/yyyy h:mm:ss a"))


def from_epoch(c, unit: str = "s") -> Column:
    x = col_of(c)
    if unit == "s":
        return F.timestamp_seconds(x)
    if unit == "ms":
        return F.timestamp_millis(x.cast("long"))
    if unit == "us":
        return F.timestamp_micros(x.cast("long"))
    if unit == "ns":
        return F.timestamp_micros((x / 1000).cast("long"))
    raise ValueError(unit)


def start_of_day_before(as_of, days: int) -> Column:
    """Midnight (UTC date of ``as_of``) minus ``days`` days."""
    return F.date_sub(F.to_date(col_of(as_of)), days).cast("timestamp")


# Declared e-mail shape (the reference uses a full validator library).
EMAIL_RE = r"^[A-Za-z0-9.!#$%&'*+/=?^_`{|}~-]+@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)+$"


def is_email(c) -> Column:
    return F.coalesce(col_of(c).rlike(EMAIL_RE), F.lit(False))


def user_id_or_email(c) -> Column:
    """struct(user_id, email): an e-mail goes to ``email``, anything else to ``user_id``."""
    x = col_of(c)
    return F.struct(
        F.when(~is_email(x), x).alias("user_id"),
        F.when(is_email(x), x).alias("email"),
    )


def sanitize_text(c) -> Column:
    """F-23 / D-4: newline, tab and CR to space, runs of spaces collapsed, ends
    trimmed. (X-2: row functions are built-in expressions like this one.)"""
    x = F.translate(col_of(c), "\n\t\r", "   ")
    return F.trim(F.regexp_replace(x, " +", " "))


def drop_empty_strings(c) -> Column:
    return F.filter(col_of(c), lambda x: x.isNotNull() & (x != ""))


def drop_nulls(c) -> Column:
    return F.filter(col_of(c), lambda x: x.isNotNull())


def remove_suffix(c, suffix: str) -> Column:
    x = col_of(c)
    return F.when(x.endswith(F.lit(suffix)), F.substring(x, F.lit(1), F.length(x) - len(suffix))).otherwise(x)


def fixed_chunks(c, n: int) -> Column:
    """Split an array into consecutive slices of at most ``n`` items."""
    a = col_of(c)
    return F.transform(
        F.sequence(F.lit(0), F.greatest(F.ceil(F.size(a) / n).cast("int") - 1, F.lit(-1))),
        lambda i: F.slice(a, i * n + 1, n),
    )


def duration_text_seconds(c) -> Column:
    """'55.66 ms' -> 0.05566 seconds; no match -> null."""
    ms = F.regexp_extract(col_of(c), r"([0-9]+(?:\.[0-9]+)?) ms", 1)
    return F.when(ms != "", ms.cast("double") / 1000.0)


def seconds_between(start, end) -> Column:
    return (F.unix_micros(col_of(end).cast("timestamp")) - F.unix_micros(col_of(start).cast("timestamp"))) / 1e6


def first_non_zero(a, b) -> Column:
    """``a or b`` for numbers: a unless it is 0 or null."""
    return F.coalesce(F.nullif(col_of(a), F.lit(0)), col_of(b))


def type_precision(native_type) -> Column:
    """struct(precision, max_length) from a type text such as 'numeric(10,2)',
    'character varying(20)', 'integer'."""
    t = F.lower(col_of(native_type))
    arg1 = F.regexp_extract(t, r"\(\s*(\d+)", 1)
    is_char = t.rlike(r"^(character|char|varchar|nvarchar|nchar|text|string)")
    is_num = t.rlike(r"^(numeric|decimal|number)")
    int_prec = (
        F.when(t.isin("smallint", "int2"), 16.0)
        .when(t.isin("integer", "int", "int4"), 32.0)
        .when(t.isin("bigint", "int8"), 64.0)
        .when(t.isin("real", "float4"), 24.0)
        .when(t.isin("double precision", "float8"), 53.0)
    )
    return F.struct(
        F.when(is_num & (arg1 != ""), arg1.cast("double")).otherwise(int_prec).alias("precision"),
        F.when(is_char & (arg1 != ""), arg1.cast("double")).alias("max_length"),
    )
