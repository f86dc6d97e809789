"""Text functions: every one maps Columns to a Column and stays in the JVM."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column, functions as F

# The characters removed by a trim.
TRIM_CHARS = " \t\n\r\0\x0b"

# Spelling of the German letters, in lower case, in slugs and keys.
UMLAUTS = {"ä": "ae", "ö": "oe", "ü": "ue", "ß": "ss"}

# Symbols that get their own word in a slug.
SLUG_WORDS = {"&": " und "}

# Placeholders filled with the name of the record.
NAME_PLACEHOLDERS = ("{{Bezeichnung}}", "{{bezeichnung}}")


# Lower-case Latin letters that do not come apart into a letter and a mark.
WHOLE_LETTERS = {
    "æ": "ae", "œ": "oe", "ø": "o", "ł": "l", "đ": "d", "ð": "d", "þ": "th", "ı": "i", "ħ": "h", "ŧ": "t", "ŋ": "n",
    "ƀ": "b", "ɓ": "b", "ƈ": "c", "ɗ": "d", "ƒ": "f", "ɠ": "g", "ɨ": "i", "ƙ": "k", "ƚ": "l", "ɲ": "n", "ƥ": "p", "ƭ": "t",
    "ƶ": "z", "ĳ": "ij", "ſ": "s", "ŉ": "'n", "ǆ": "dz", "ǉ": "lj", "ǌ": "nj", "ﬁ": "fi", "ﬂ": "fl",
}


def _accent_table() -> tuple[str, str]:
    """Lower-case Latin letters with marks, and the plain letters below them."""
    marked, plain = [], []
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        letter = chr(code)
        base = unicodedata.normalize("NFD", letter)[0]
        base = WHOLE_LETTERS.get(base, base)
        if letter.islower() and letter not in WHOLE_LETTERS and base != letter and base.isascii() and len(base) == 1:
            marked.append(letter)
            plain.append(base)
    return "".join(marked), "".join(plain)


MARKED_LETTERS, PLAIN_LETTERS = _accent_table()
# Marks that follow their letter as characters of their own.
_LOOSE_MARKS = "".join(map(chr, range(0x300, 0x370)))
_RARE = "[" + "".join(WHOLE_LETTERS) + "]"


def trim(c: Column) -> Column:
    return F.trim(c, F.lit(TRIM_CHARS))


def is_blank(c: Column) -> Column:
    """Null, empty or only white space; never null itself."""
    return F.coalesce(trim(c.cast("string")) == "", F.lit(True))


def null_if_empty(c: Column) -> Column:
    """Null for a blank value, otherwise the value as it is (not trimmed)."""
    return F.when(~is_blank(c), c)


def concat(*cols: Column) -> Column:
    """Join the parts; nulls are skipped, so the result is never null."""
    return F.concat_ws("", *[c.cast("string") for c in cols])


def forward_slashes(c: Column) -> Column:
    return F.replace(c, F.lit("\\"), F.lit("/"))


def basename(c: Column) -> Column:
    """Last path segment; closing slashes are ignored."""
    return F.substring_index(F.rtrim(forward_slashes(c), F.lit("/")), "/", -1)


def normalize_title(c: Column) -> Column:
    return F.coalesce(basename(trim(c)), F.lit(""))


def _bound(c: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn`` of a value that it uses more than once, computed once."""
    return F.get(F.transform(F.array(c), fn), F.lit(0))


def _all_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.char_length(c)


def _without_marks(spelled: Column) -> Column:
    """Letters without their marks. Rare letters get their spelling, in texts that have any."""

    def rare(plain: Column) -> Column:
        other = plain
        for letter, spelling in WHOLE_LETTERS.items():
            other = F.replace(other, F.lit(letter), F.lit(spelling))
        return F.when(plain.rlike(_RARE), other).otherwise(plain)

    # marks of their own have no counterpart and go
    return _bound(F.translate(spelled, MARKED_LETTERS + _LOOSE_MARKS, PLAIN_LETTERS), lambda plain: F.when(_all_ascii(plain), plain).otherwise(rare(plain)))


def _plain_letters(c: Column, drop_accents: bool) -> Column:
    """Lower case with umlauts spelled out. Text that is all ASCII skips the replacements, before them or after the umlauts."""

    def spelled(low: Column) -> Column:
        out = low
        for letter, spelling in UMLAUTS.items():
            out = F.replace(out, F.lit(letter), F.lit(spelling))
        return _bound(out, lambda x: F.when(_all_ascii(x), x).otherwise(_without_marks(x))) if drop_accents else out

    return _bound(F.lower(F.coalesce(c, F.lit(""))), lambda low: F.when(_all_ascii(low), low).otherwise(spelled(low)))


def _squeeze(c: Column, separator: str) -> Column:
    """Every run of characters outside a-z and 0-9 becomes one separator."""
    return F.trim(F.regexp_replace(c, "[^a-z0-9]+", separator), F.lit(separator))


def slugify(c: Column, translit: bool = True) -> Column:
    """URL slug. With ``translit`` the ampersand is spelled out and accents are dropped."""
    slug = _plain_letters(c, drop_accents=translit)
    if translit:
        for symbol, word in SLUG_WORDS.items():
            slug = F.replace(slug, F.lit(symbol), F.lit(word))
    return _squeeze(slug, "-")


def normalize_key(c: Column) -> Column:
    """Comparison key of a name: letters and digits joined by underscores."""
    return _squeeze(_plain_letters(c, drop_accents=False), "_")


def fill_placeholder(c: Column, name: Column) -> Column:
    """Put the name into its placeholders, then reduce white space to single blanks."""
    filled = c
    for placeholder in NAME_PLACEHOLDERS:
        filled = F.replace(filled, F.lit(placeholder), name)
    text = F.when(is_blank(name), c).otherwise(filled)
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def meta_default(name: Column, suffix: str = "") -> Column:
    """Trimmed name followed by the shop's own suffix; blank stays empty."""
    return F.when(is_blank(name), "").otherwise(F.concat(trim(name), F.lit(suffix)))


# An opening angle bracket before white space is text. Quoted values may hold brackets.
_COMMENT = r"<!--(?s:.*?)(?:-->|\z)"
_TAG = r"""<(?![\s])(?:[^"'<>]++|"[^"]*+(?:"|\z)|'[^']*+(?:'|\z)|<[^"'<>]*+(?:>|\z))*+(?:>|\z)"""
_RTF_CONTROL = r"\\[a-zA-Z]+-?\d* ?"


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, _COMMENT, ""), _TAG, "")


def remove_html(c: Column) -> Column:
    """Text without mark-up; rich text loses its control words first."""
    words = F.translate(F.regexp_replace(c, _RTF_CONTROL, " "), "{}\\", "")
    plain_rtf = trim(F.regexp_replace(words, r"\s+", " "))
    return strip_tags(F.when(F.contains(c, F.lit("{\\rtf")), plain_rtf).otherwise(c))
