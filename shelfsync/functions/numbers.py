"""Number functions. Dirty text never raises: it becomes null or the stated default."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, functions as F

from .text import is_blank, trim

# What counts as a number in text.
NUMERIC = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
NUMERIC_PREFIX = r"^\s*([+-]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?)"
WHOLE_NUMBER = r"^\s*[+-]?\d+\s*$"

# Texts read as true.
TRUE_WORDS = ("1", "true", "yes", "ja", "y")
FALSE_WORDS = ("0", "false", "no", "nein", "n")

# Tax rate in percent and its class.
TAX_CLASSES = {19.0: 1, 7.0: 2, 0.0: 0}
TAX_TOLERANCE = 0.1


def is_numeric(c: Column) -> Column:
    return F.coalesce(c.cast("string").rlike(NUMERIC), F.lit(False))


def to_number(c: Column) -> Column:
    text = c.cast("string")
    return F.when(is_numeric(text), trim(text).try_cast("double"))


def to_decimal(c: Column) -> Column:
    """Number with a decimal comma or point. Thousands separators are not accepted."""
    return to_number(F.replace(c.cast("string"), F.lit(","), F.lit(".")))


def to_int(c: Column) -> Column:
    """Whole part of a number, cut towards zero; exact as long as it fits 64 bits, beyond that null."""
    text = c.cast("string")
    whole = F.when(text.rlike(WHOLE_NUMBER), trim(text).try_cast("bigint"))
    return F.coalesce(whole, to_number(text).try_cast("bigint"))


def bool_to_int(c: Column) -> Column:
    """1 for a number with whole part one or a word for yes, otherwise 0."""
    text = c.cast("string")
    words = F.lower(trim(text)).isin(*TRUE_WORDS)
    truth = F.when(is_numeric(text), to_int(text) == 1).otherwise(words)
    return F.coalesce(truth, F.lit(False)).cast("int")


def round_n(c: Column, digits: int = 0) -> Column:
    return F.round(to_number(c), digits)


def tax_map(c: Column) -> Column:
    """Tax rate to tax class; other rates are rounded, text counts by its leading number."""
    leading = F.regexp_extract(c.cast("string"), NUMERIC_PREFIX, 1)
    rate = F.coalesce(F.when(leading != "", leading.try_cast("double")), F.lit(0.0))
    result = F.round(rate).cast("int")
    for percent, tax_class in TAX_CLASSES.items():
        result = F.when(F.abs(rate - percent) < TAX_TOLERANCE, tax_class).otherwise(result)
    return result


def convert(c: Column, kind: str) -> Column:
    """Declared column type: integer, float, string, boolean or datetime."""
    if kind == "integer":
        return to_int(c)
    if kind == "float":
        return to_decimal(c)
    if kind == "string":
        return c.cast("string")
    if kind == "boolean":
        word = F.lower(trim(c.cast("string")))
        return F.when(word.isin(*TRUE_WORDS), 1).when(word.isin(*FALSE_WORDS), 0)
    if kind == "datetime":
        return iso_time(F.try_to_timestamp(F.when(~is_blank(c), trim(c))))
    raise ValueError(f"unknown column type: {kind}")


# Fixed value: format of every time written as text.
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ssxxx"


def iso_time(ts: Column) -> Column:
    """Timestamp, or seconds since the epoch, as ISO-8601 text with offset."""
    return F.date_format(ts.cast("timestamp"), ISO_FORMAT)


def now(run_time: datetime) -> Column:
    """Time of the run as text. It is passed in, so that a repeated task writes the same."""
    fixed = run_time if run_time.tzinfo else run_time.replace(tzinfo=timezone.utc)
    return F.lit(fixed.isoformat(timespec="seconds"))


def format_duration(seconds: Column) -> Column:
    """45.2s, 1m 23s or 2h 5m."""
    s = seconds.cast("double")
    minutes = F.floor(s / 60)
    hours = F.floor(minutes / 60)
    rest = s - minutes * 60
    return (
        F.when(s < 60, F.format_string("%.1fs", s))
        .when(minutes < 60, F.format_string("%dm %.0fs", minutes, rest))
        .otherwise(F.format_string("%dh %dm", hours, minutes - hours * 60))
    )
