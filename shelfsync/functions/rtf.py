"""Rich text to simple HTML lines.

Plain text, the common case, is cleaned by native expressions. Only values that hold a rich
text header are sent to Python, in Arrow batches; all other rows send a null.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from .text import trim

# Destinations without visible text.
HIDDEN_GROUPS = ("fonttbl", "colortbl", "stylesheet", "info", "header", "footer", "generator", "pict")

# Control words and symbols with a visible meaning.
CONTROL_TEXT = {
    "par": "\n",
    "pard": "\n",
    "line": "\n",
    "tab": "\t",
    "emdash": "—",
    "endash": "–",
    "lquote": "‘",
    "rquote": "’",
    "ldblquote": "“",
    "rdblquote": "”",
    "bullet": "•",
}
SYMBOL_TEXT = {"~": " ", "_": "-"}
DEFAULT_CODE_PAGE = "cp1252"

_HEADER = "{\\rtf"
_CODE_PAGE = re.compile(r"\\ansicpg(\d+)", re.I)
_HIDDEN = re.compile(r"\\(?:\*|([A-Za-z]+))")
_TOKEN = re.compile(
    r"(?P<brace>[{}])"
    r"|\\'(?P<hex>[0-9a-fA-F]{2})"
    r"|\\u(?P<code>-?\d+)\??"
    r"|\\(?P<word>[A-Za-z]+)(?P<tail>-?\d* ?)"
    r"|\\(?P<symbol>[^A-Za-z])"
    r"|(?P<text>[^{}\\]+)"
)


def _decode(byte: str, code_page: str) -> str:
    try:
        return bytes.fromhex(byte).decode(code_page, "ignore")
    except LookupError:
        return bytes.fromhex(byte).decode(DEFAULT_CODE_PAGE, "ignore")


def rtf_text(rtf: str) -> str:
    """Visible text of one rich text value."""
    declared = _CODE_PAGE.search(rtf)
    code_page = f"cp{declared.group(1)}" if declared else DEFAULT_CODE_PAGE
    out: list[str] = []
    depth, hidden_from = 0, None
    for token in _TOKEN.finditer(rtf):
        kind = token.lastgroup
        if kind == "brace":
            if token["brace"] == "{":
                depth += 1
                opening = _HIDDEN.match(rtf, token.end())
                hidden = opening and (not opening.group(1) or opening.group(1).lower() in HIDDEN_GROUPS)
                if hidden and hidden_from is None:
                    hidden_from = depth
            else:
                if hidden_from == depth:
                    hidden_from = None
                depth -= 1
        elif hidden_from is not None:
            continue
        elif kind == "hex":
            out.append(_decode(token["hex"], code_page))
        elif kind == "code":
            number = int(token["code"]) % 65536
            out.append(chr(number) if number and not 0xD800 <= number < 0xE000 else "")
        elif token["word"] is not None:
            word = token["word"]
            if word in CONTROL_TEXT:
                out.append(CONTROL_TEXT[word] + token["tail"])
            elif word != "uc":
                out.append(" ")
        elif kind == "symbol":
            symbol = token["symbol"]
            out.append(SYMBOL_TEXT.get(symbol, "" if symbol in "{}\\*" else symbol))
        elif kind == "text":
            out.append(token["text"])
    return "".join(out)


@F.pandas_udf(T.StringType())
def _rtf_text(values: pd.Series) -> pd.Series:
    return values.map(rtf_text, na_action="ignore")


# What the tidying patterns below can match; text without any of it skips them.
_UNTIDY = ("\r", "\t", "  ", " \n", "\n\n\n", ";")


def _tidy(c: Column) -> Column:
    text = F.regexp_replace(c, r"\r\n?", "\n")
    text = F.regexp_replace(text, r"[ \t]+\n", "\n")
    text = F.regexp_replace(text, r"\n{3,}", "\n\n")
    text = F.regexp_replace(text, r"[ \t]{2,}", " ")
    return F.regexp_replace(text, r"\A\s*[\w\s\-,.]+;", "")


def clean_lines(c: Column) -> Column:
    """Tidy white space, drop a leading list of words closed by a semicolon, join lines."""
    untidy = reduce(or_, [F.contains(c, F.lit(mark)) for mark in _UNTIDY])
    text = F.when(untidy, _tidy(c)).otherwise(c)
    lines = F.transform(F.split(text, "\n"), trim)
    return F.array_join(F.filter(lines, lambda line: line != ""), "<br>")


def rtf_to_html(c: Column, may_hold_rtf: bool = True) -> Column:
    """Rich or plain text as lines joined by ``<br>``. Null stays null.

    Pass ``may_hold_rtf=False`` for a column known to be plain; no Python is started then.
    """
    plain = trim(c)
    if not may_hold_rtf:
        return clean_lines(plain)
    is_rtf = F.contains(c, F.lit(_HEADER))
    return clean_lines(F.when(is_rtf, _rtf_text(F.when(is_rtf, plain))).otherwise(plain))
