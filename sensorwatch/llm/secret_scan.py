"""Secret scans by assignment-aware lexing.

Method: around each assignment operator of a text a small lexer reads the
target name to the left and the literal expression to the right: quoted strings
with escapes, bare words, names of earlier constants, concatenations, and
``${NAME}`` interpolation. Constants are propagated through a document's names
in order, so a literal that reaches a sensitive name by way of another name is
found where it was written. A literal is scored by the sensitivity of its
target's name and by its own strength (length, entropy, character classes); it
is a span of kind ``literal`` from ``MIN_SCORE`` on, unless a base span covers
it already.

The lexer looks only at operators and resumes behind the literal it has read,
so its time is linear in the text.

Contract: null and empty texts have no spans; texts of any length are read
whole; repeated rows give repeated results; an empty table gives an empty
result; extra columns are carried along.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from .common import read_table
from .spans import Span, digests, matches, outside, with_spans

KINDS = ("assign", "access", "hex", "literal")

#: Base patterns (given). Group 1 in either case, ASCII letters only.
_WORDS = ["password", "passwd", "secret", "token", "api_?key"]
_EITHER = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in _WORDS)
ASSIGN = re.compile(rf"({_EITHER})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
_HINTS = ("passw", "secret", "token", "api")


def base_spans(text: str) -> list[Span]:
    found: list[Span] = []
    lowered = text.lower()
    if any(h in lowered for h in _HINTS):
        found += matches(ASSIGN, text, "assign", lambda m: len(m[2]) >= 8)
    if "AKIA" in text:
        found += matches(ACCESS, text, "access", lambda m: len(m[0]) >= 16)
    return found + matches(HEX, text, "hex", lambda m: True)


# --- names ---------------------------------------------------------------

#: Sensitivity of the parts of a name (0 to 1); the strongest counts.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "passcode": 0.9, "secret": 1.0,
    "token": 0.9, "apikey": 1.0, "accesskey": 0.9, "privatekey": 1.0, "secretkey": 1.0, "signingkey": 0.9,
    "encryptionkey": 0.9, "credential": 0.9, "credentials": 0.9, "auth": 0.7, "authorization": 0.8,
    "bearer": 0.8, "key": 0.6, "jwt": 0.8, "session": 0.5, "cookie": 0.5, "dsn": 0.6, "pin": 0.5,
}
#: Words that make a name speak about a secret rather than hold one.
_ABOUT = {"file", "path", "name", "url", "uri", "type", "length", "len", "count", "id", "field", "label", "hint", "policy", "expiry"}
_PLACEHOLDER = re.compile(
    r"(?i)^(?:x+|\*+|\.+|-+|none|null|true|false|changeme|change_me|example.*|placeholder.*|your[_-].*|<.*>|test|dummy.*|todo.*|redacted)$"
)
MIN_SCORE = 0.45


def name_parts(name: str) -> list[str]:
    """Lower-case parts of a name written in snake, kebab, dotted or camel case."""
    return [p.lower() for p in re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+", name)]


def sensitivity(name: str) -> float:
    parts = name_parts(name)
    if not parts or parts[-1] in _ABOUT:
        return 0.0
    pairs = [a + b for a, b in zip(parts, parts[1:], strict=False)]
    return max(SENSITIVE.get(p, 0.0) for p in [*parts, *pairs, "".join(parts)])


def strength(literal: str) -> float:
    """0 to 1: how much a literal looks like a generated or chosen secret."""
    n = len(literal)
    if n < 8 or _PLACEHOLDER.match(literal) or any(c.isspace() for c in literal):
        return 0.0
    counts = Counter(literal)
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    kinds = sum(
        (any(c.islower() for c in literal), any(c.isupper() for c in literal), any(c.isdigit() for c in literal),
         any(not c.isalnum() for c in literal))
    )
    if kinds < 2:
        return 0.0
    return min(1.0, 0.15 * kinds + 0.12 * entropy + 0.1 * min(1.0, n / 32))


# --- lexer ---------------------------------------------------------------

_OPERATOR = re.compile(r"=>|:=|\+=|={1,3}|:(?!//)")
_NAME_LEFT = re.compile(r"(?:[\"']([A-Za-z_][\w.\-]{0,126})[\"']|([A-Za-z_$][\w.\-]{0,126}))[ \t]*$")
_STRING = re.compile(r"\"((?:[^\"\\\n]|\\.)*)\"|'((?:[^'\\\n]|\\.)*)'|`((?:[^`\\]|\\.)*)`")
_BARE = re.compile(r"[^\s\"'`,;(){}\[\]<>#&|+]+")
_SPACE = re.compile(r"[ \t]*")
_JOIN = re.compile(r"[ \t]*(?:\+|\.\.)[ \t]*")
_IDENTIFIER = re.compile(r"[A-Za-z_][\w.]*$")
_HOLE = re.compile(r"\$\{([A-Za-z_][\w.]*)\}|\$([A-Za-z_]\w*)")
#: Characters of a name looked at to the left of an operator.
_NAME_CHARS = 130

Piece = tuple[str, int, int]  # a literal's text and place
#: Literals and, by reference, what the names in an expression stand for; not changed once a name has it.
Value = list


def _operand(text: str, at: int, known: dict[str, Value]) -> tuple[Value | None, int]:
    """What an operand stands for, and its end."""
    m = _STRING.match(text, at)
    if m:
        k = m.lastindex
        pieces = [(m[k], m.start(k), m.end(k))] if m[k] else []
        for hole in _HOLE.finditer(m[k]):
            if (name := hole[1] or hole[2]) in known:
                pieces.append(known[name])
        return pieces, m.end()
    m = _BARE.match(text, at)
    if not m:
        return None, at
    word = m[0].rstrip(".:")
    hole = _HOLE.fullmatch(word)
    name = (hole[1] or hole[2]) if hole else word
    if name in known and (hole or _IDENTIFIER.match(word)):
        return [known[name]], m.end()
    return [(word, at, at + len(word))], m.end()


def pairs(text: str) -> list[tuple[str, Value]]:
    """Name-value pairs of a text in order: each target with what reaches it (see :func:`literals`)."""
    known: dict[str, Value] = {}
    out, at = [], 0
    while m := _OPERATOR.search(text, at):
        at = m.end()
        left = text[max(0, m.start() - _NAME_CHARS) : m.start()]
        name = _NAME_LEFT.search(left)
        if not name:
            continue
        start = _SPACE.match(text, at).end()
        pieces, end = _operand(text, start, known)
        while pieces is not None and (j := _JOIN.match(text, end)):
            more, after = _operand(text, j.end(), known)
            if more is None:
                break
            pieces += more
            end = after
        if pieces is None:
            continue
        at = max(at, end)
        target = name[1] or name[2]
        known[target] = [known[target], *pieces] if m[0] == "+=" and target in known else pieces
        out.append((target, pieces))
    return out


def literals(value: Value, seen: set[int]) -> Iterator[Piece]:
    """All literals of a value but those of the values in ``seen``, which is added to."""
    rest = [value]
    while rest:
        one = rest.pop()
        if id(one) not in seen:
            seen.add(id(one))
            for x in one:
                if isinstance(x, list):
                    rest.append(x)
                else:
                    yield x


def scored_literals(text: str) -> list[tuple[str, int, int, float]]:
    """Literals of sensitive names as (kind, start, end, score)."""
    best: dict[tuple[int, int], float] = {}
    found = pairs(text)  # keeps the values, which are told apart by identity
    seen: dict[float, set[int]] = {}  # by weight, of which there are few: the time stays linear
    for target, value in found:
        weight = sensitivity(target)
        if weight:
            for literal, a, b in literals(value, seen.setdefault(weight, set())):
                best[a, b] = max(best.get((a, b), 0.0), weight * strength(literal))
    return [("literal", a, b, s) for (a, b), s in sorted(best.items()) if s >= MIN_SCORE]


def find_secrets(text: str) -> tuple[list[Span], list[tuple[str, int, int, float]]]:
    base = base_spans(text)
    added = scored_literals(text) if "=" in text or ":" in text else []
    return base, [s for s in added if outside([s[:3]], base)]


def scan(docs: DataFrame, text: str = "text", into: str = "found") -> DataFrame:
    """``docs`` with the secrets of each text: array of (kind, start, end, base, score)."""
    return with_spans(docs, lambda: lambda texts: [find_secrets(t) for t in texts], text, into)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all ``documents``."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(scan(docs).select("doc_id", "found"), KINDS[:3], KINDS)
