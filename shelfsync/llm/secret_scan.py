"""Secrets by assignment-aware lexing.

Source code and configuration are lexed into pairs of a name and a literal: `name = "x"`, `name: x`,
`"name": "x"`, `name => 'x'`. Constants are propagated: a name that is assigned another name takes that one's
literal, and literals joined by `+` belong to one value. A literal is scored by how sensitive the words of its
name are and by how random it looks. Three fixed patterns are reported whatever the lexer says.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import map_columns

# Fixed patterns. ASCII letters only: Unicode has other letters that fold to s and k.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so this is "runs, of which those of 24 or more stay"
KINDS = ("assign", "access", "hex", "named")

NAME = r"[A-Za-z_$][\w$-]*(?:\.[A-Za-z_$][\w$-]*)*"
PAIR = re.compile(
    rf"""(?P<q>["']?)(?P<name>{NAME})(?P=q)\x20*(?::=|=>|=(?![=~])|:(?![:/]))\x20*(?P<value>"[^"\n]*"(?:\x20*\+\x20*"[^"\n]*")*|'[^'\n]*'(?:\x20*\+\x20*'[^'\n]*')*|[^\s"'#;,(){{}}\[\]]+)""",
    re.A,
)
QUOTED = re.compile(r"""(["'])(.*?)\1""")
PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
# Weights of the words of a name
SENSITIVE = {
    "password": 3, "passwd": 3, "pwd": 3, "passphrase": 3, "secret": 3, "credential": 3, "credentials": 3,
    "token": 2, "auth": 2, "bearer": 2, "apikey": 3, "private": 2, "signing": 2, "access": 1, "api": 1,
    "key": 1, "client": 1, "session": 1, "connection": 1, "webhook": 1, "salt": 2,
}
THRESHOLD = 4.0
SHORTEST = 8
#: With a name of this weight every quoted literal of so many characters is reported, but for placeholders.
STRONG = 3
STRONG_SHORTEST = 4
PLACEHOLDER = re.compile(
    r"<[^>]*>|\$\{[^}]*\}|\$\([^)]*\)|(?-i:\$[A-Z_]+)|\{\{.*\}\}|\{[a-z_]*\}|%\(\w+\)s|(?-i:%[A-Z_]+%)|(.)\1*"
    r"|(?:your|my|the|some|enter)[-_ ](?:\w+[-_ ])?(?:password|passwd|pwd|passphrase|secret|credentials?|api[-_ ]?key|key|token)(?:[-_ ]here)?"
    r"|change[-_ ]?me|redacted|placeholder|todo|tbd|none|null|undefined|true|false",
    re.I,
)


def _name_weight(name: str) -> int:
    return sum(SENSITIVE.get(p.lower(), 0) for p in dict.fromkeys(PART.findall(name)))


def _randomness(value: str, quoted: bool) -> float:
    """Bits of a character, from the value's own frequencies; 0 for what holds only one kind of character, and for bare
    words without a digit."""
    kinds = sum((any(c.isdigit() for c in value), any(c.islower() for c in value), any(c.isupper() for c in value), not value.isalnum()))
    if kinds < 2 or not (quoted or any(c.isdigit() for c in value)):
        return 0.0
    n = len(value)
    return -sum(k / n * math.log2(k / n) for k in Counter(value).values())


def _literal(match: re.Match) -> tuple[str, int, int, bool]:
    """Value, its span, and whether it is quoted. Joined literals span from the first to the last."""
    text, start = match["value"], match.start("value")
    if text[0] not in "\"'":
        return text, start, start + len(text), False
    parts = list(QUOTED.finditer(text))
    if not parts:
        return "", start, start, True
    return "".join(p[2] for p in parts), start + parts[0].start(2), start + parts[-1].end(2), True


def lexed(text: str) -> list[tuple[str, str, int, int]]:
    """Name, literal and its span for every assignment, constants propagated."""
    pairs, constants = [], {}
    if "=" not in text and ":" not in text:
        return []
    for m in PAIR.finditer(text):
        value, start, end, quoted = _literal(m)
        name = m["name"]
        if not quoted and value in constants:  # an earlier constant: the secret is where its literal stands
            literal = constants[value]
        else:
            literal = (value, start, end)
        constants[name] = literal
        if literal[0]:
            pairs.append((name, *literal))
    return pairs


def spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Spans of the fixed patterns, and with them those that the lexer adds; sorted by start, then kind."""
    base = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        base += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    base += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    order = {k: i for i, k in enumerate(KINDS)}
    base.sort(key=lambda s: (s[1], order[s[0]]))
    more: set[tuple[str, int, int]] = set()
    for name, value, start, end in lexed(text):
        weight = _name_weight(name)
        quoted = text[start - 1 : start] in ("'", '"')
        strong = quoted and weight >= STRONG
        if not weight or len(value) < (STRONG_SHORTEST if strong else SHORTEST) or any(a <= start and end <= b for _, a, b in base):
            continue
        least = THRESHOLD + (weight < 2)
        if len(value) >= SHORTEST and weight + _randomness(value, False) >= least:
            more.add(("named", start, end))
        elif quoted and (strong or weight + _randomness(value, True) >= least) and not PLACEHOLDER.fullmatch(value.strip()):
            more.add(("named", start, end))
    return base, sorted([*base, *more], key=lambda s: (s[1], order[s[0]], s[2]))


def _joined(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def scan(documents: DataFrame) -> DataFrame:
    """Every row's secrets: doc_id, n_assign, n_access, n_hex, n_named, base_sha256, spans.

    Offsets count code points. Null and empty texts have none; repeated rows are scanned each for itself.
    """

    def start():
        def rows(at):
            found = [spans(t or "") for t in at["text"]]
            out = {f"n_{k}": [sum(s[0] == k for s in every) for _, every in found] for k in KINDS}
            return {
                **out,
                "doc_id": at["doc_id"],
                "base_sha256": [hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in found],
                "spans": [_joined(every) for _, every in found],
            }

        return rows

    kind = "doc_id long, n_assign long, n_access long, n_hex long, n_named long, base_sha256 string, spans string"
    return map_columns(documents.select(F.col("doc_id").cast("long"), "text"), kind, start)


def redact(documents: DataFrame, mark: str = "<secret>") -> DataFrame:
    """The documents with every span replaced by `mark`; n_chars follows where a text has changed."""

    def start():
        def rows(at):
            texts, sizes = [], []
            for text, size in zip(at["text"], at["n_chars"]):
                every = spans(text or "")[1]
                if every:
                    out, last = [], 0
                    for _, a, b in every:
                        if a >= last:
                            out += [text[last:a], mark]
                        last = max(last, b)
                    text = "".join([*out, text[last:]])
                    size = len(text)
                texts.append(text)
                sizes.append(size)
            return {**at, "text": texts, "n_chars": sizes}

        return rows

    return map_columns(documents, ", ".join(f"`{n}` {t}" for n, t in documents.dtypes), start)
