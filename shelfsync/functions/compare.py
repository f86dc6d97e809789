"""Change detection on columns: loose comparison, delta test, row hash, file token."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F, types as T

from .numbers import NUMERIC, WHOLE_NUMBER

_SEPARATOR = "\x1f"


_NUMBER, _WHOLE = f"r'{NUMERIC}'", f"r'{WHOLE_NUMBER}'"


def _family(kind: T.DataType) -> str:
    if isinstance(kind, T.BooleanType):
        return "bool"
    return "number" if isinstance(kind, T.NumericType) else "text"


def _truth(x: str, kind: str) -> str:
    return {"bool": x, "number": f"({x} <> 0)", "text": f"({x} NOT IN ('', '0'))"}[kind]


def _is_something(x: str, kind: str) -> str:
    """Whether a non-null value differs from null: not empty text, zero or false."""
    return f"{x} <> ''" if kind == "text" else _truth(x, kind)


def _digits(x: str) -> str:
    """A whole number of any length in one spelling: no plus sign, no leading zeros, no minus before zero."""
    return f"regexp_replace(regexp_replace({x}, '^\\\\s*[+]?(-?)0*(?=[0-9])|\\\\s+$', '$1'), '^-0$', '0')"


def canonical(x: str, kind: T.DataType) -> str:
    """A text that two values of one column share exactly if they count as equal; never null."""
    if _family(kind) == "bool":
        return f"CAST(coalesce({x}, false) AS string)"
    if _family(kind) == "number":
        return f"CAST(coalesce({x}, 0) AS string)"
    short = f"length({_digits(x)}) < 16"
    return f"""CASE WHEN {x} RLIKE {_WHOLE} AND NOT {short} THEN {_digits(x)}
        WHEN {x} RLIKE {_NUMBER} THEN CAST(try_cast({x} AS double) + 0.0D AS string) ELSE coalesce(CAST({x} AS string), '') END"""


def _differ(a: str, kind_a: str, b: str, kind_b: str) -> str:
    """Inequality of two values that are not null."""
    if "bool" in (kind_a, kind_b):
        return f"{_truth(a, kind_a)} <> {_truth(b, kind_b)}"
    if kind_a == kind_b == "number":
        return f"{a} <> {b}"
    if kind_a == kind_b:
        return f"""CASE WHEN {a} RLIKE {_WHOLE} AND {b} RLIKE {_WHOLE} THEN {_digits(a)} <> {_digits(b)}
            WHEN {a} RLIKE {_NUMBER} AND {b} RLIKE {_NUMBER} THEN try_cast({a} AS double) <> try_cast({b} AS double)
            ELSE {a} <> {b} END"""
    number, text = (a, b) if kind_a == "number" else (b, a)
    return f"CASE WHEN {text} RLIKE {_NUMBER} THEN try_cast({text} AS double) <> CAST({number} AS double) ELSE true END"


def loose_ne_sql(a: str, b: str, type_a: T.DataType, type_b: T.DataType) -> str:
    """Inequality of two SQL expressions as a loosely typed source sees it; never null.

    Numeric texts compare as numbers, null equals empty text, zero and false, and a number
    never equals a text that is not a number. Equal values leave on the first test, so the
    patterns run for changed values only.
    """
    kind_a, kind_b = _family(type_a), _family(type_b)
    same = f"WHEN {a} <=> {b} THEN false" if kind_a == kind_b else f"WHEN {a} IS NULL AND {b} IS NULL THEN false"
    return f"""(CASE {same} WHEN {a} IS NULL THEN {_is_something(b, kind_b)} WHEN {b} IS NULL THEN {_is_something(a, kind_a)}
        ELSE {_differ(a, kind_a, b, kind_b)} END)"""


def loose_ne(a: str, b: str, type_a: T.DataType, type_b: T.DataType) -> Column:
    return F.expr(loose_ne_sql(a, b, type_a, type_b))


def delta_changed(pairs: Sequence[tuple[str, str, T.DataType, T.DataType]]) -> Column:
    """True if any pair differs. Without fields every row counts as changed."""
    return F.expr(" OR ".join(loose_ne_sql(*p) for p in pairs)) if pairs else F.lit(True)


# Beginnings of names of algorithms that Spark has no function for. Names of no algorithm mean SHA-256.
OTHER_ALGORITHMS = (
    "mtime_size_xxh64", "md2", "md4", "sha", "ripemd", "whirlpool", "tiger", "snefru", "gost", "adler", "crc32", "fnv", "joaat",
    "murmur", "xxh", "haval",
)


def file_token(mtime: Column, size: Column, algo: str = "sha256") -> Column:
    """Change token of a file from its time and size, plain or hashed."""
    data = F.concat_ws("|", F.coalesce(mtime.cast("string"), F.lit("")), F.coalesce(size.cast("string"), F.lit("")))
    known = {
        "mtime_size": lambda c: c,
        "md5": F.md5,
        "sha1": F.sha1,
        "crc32b": lambda c: F.lpad(F.lower(F.hex(F.crc32(c.cast("binary")))), 8, "0"),
        "sha256": lambda c: F.sha2(c, 256),
        "sha224": lambda c: F.sha2(c, 224),
        "sha384": lambda c: F.sha2(c, 384),
        "sha512": lambda c: F.sha2(c, 512),
    }
    if algo.lower() not in known and algo.lower().startswith(OTHER_ALGORITHMS):
        raise ValueError(f"checksum algorithm not offered: {algo}")
    return known.get(algo.lower(), known["sha256"])(data)


def row_hash(*cols: Column) -> Column:
    """SHA-256 over the values of a row; null and empty text hash alike."""
    return F.sha2(F.concat_ws(_SEPARATOR, *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]), 256)
