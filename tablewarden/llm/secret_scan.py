"""Secret scan: assignment-aware lexing of source and configuration text.

A small lexer reads ``name = literal``, ``name: literal``, ``"name": "literal"``, ``name="literal"`` of markup, and
``export NAME=literal``. Names that are assigned literals are constants of the text; an assignment from a name, or
a sum of literals and names, propagates them in reading order, so ``a = "x..."; api_secret = a`` is found at the
literal. A literal is scored by the words of the most sensitive name it reaches, by its length and by its mix of
characters. Three fixed patterns (assignments, access ids, hexadecimal runs) are always reported.

Defined results: a NULL or empty text has no span. Positions count code points, the end is exclusive. Repeated rows
give repeated results. An empty table gives an empty result. Columns other than ``keep`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_texts

# The three base patterns and the shortest lengths that count.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LEAST, ACCESS_LEAST = 8, 16
KINDS = ("assign", "access", "hex", "literal")

# Words of a name and what they add to the score of its literal.
NAME_WEIGHTS = {
    "password": 3.0, "passwd": 3.0, "pwd": 3.0, "passphrase": 3.0, "secret": 3.0, "token": 2.5, "apikey": 3.0,
    "credential": 2.5, "credentials": 2.5, "auth": 1.5, "bearer": 2.0, "private": 1.5, "signing": 1.0, "access": 1.0,
    "key": 1.0, "api": 1.0, "client": 0.5, "encryption": 1.0, "salt": 1.0, "session": 0.5, "cookie": 0.5,
}
HARMLESS_NAMES = {"public", "id", "name", "file", "path", "url", "length", "type", "count", "field", "label", "hint"}
PLACEHOLDERS = {"changeme", "password", "example", "placeholder", "undefined", "redacted", "required", "your"}
LEAST_SCORE = 3.5
LEAST_LITERAL = 8

_NAME = r"[A-Za-z_][A-Za-z0-9_.-]*+"
_SIGN = r"""["']?[\x20\t]*(?:=>|:=|=(?!=)|:(?![:/]))"""
# A sum may go on in the next line, unless that line is an assignment of its own (as the added lines of a diff are).
_PLUS = (
    r"""(?>[\x20\t]*\+[\x20\t]*(?![\x20\t\r\n])|"""
    rf"""[\x20\t\r\n]*+\+[\x20\t\r\n]*+(?!["']?{_NAME}{_SIGN}))"""
)
_ASSIGNMENT = re.compile(
    rf"""(?<![A-Za-z0-9_.$-])["']?(?P<name>{_NAME}){_SIGN}[\x20\t]*(?P<value>"""
    rf"""(?:(?:[rbfu]?"[^"\n]*"|[rbfu]?'[^'\n]*'|\$?\{{?{_NAME}\}}?){_PLUS})*"""
    r"""(?:[rbfu]?"[^"\n]*"|[rbfu]?'[^'\n]*'|[^\s"'`,;<>(){}\[\]]+|\$\{[A-Za-z0-9_.]+\}))"""
)
_ATOM = re.compile(r"""[rbfu]?"(?P<d>[^"\n]*)"|[rbfu]?'(?P<s>[^'\n]*)'|(?P<bare>[^\s"'+]+)""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")


def name_score(name: str) -> float:
    """How sensitive a name is, by its words; 0 when its last word says it only points to a secret."""
    words = [w.lower() for w in _WORDS.findall(name)]
    if not words or words[-1] in HARMLESS_NAMES or "public" in words:
        return 0.0
    joined = {a + b for a, b in zip(words, words[1:])}
    return sum(NAME_WEIGHTS.get(w, 0.0) for w in set(words) | joined)


def literal_score(literal: str) -> float:
    """Up to 2 for long texts of mixed characters, below 0 for what no secret looks like."""
    if len(literal) < LEAST_LITERAL or any(c.isspace() for c in literal):
        return -9.0
    low = literal.lower()
    if any(p in low for p in PLACEHOLDERS) or low.startswith(("${", "{{", "http://", "https://", "/", "./")):
        return -9.0
    counts = Counter(literal)
    bits = -sum(n / len(literal) * math.log2(n / len(literal)) for n in counts.values())
    kinds = sum(map(bool, (re.search("[a-z]", literal), re.search("[A-Z]", literal), re.search("[0-9]", literal),
                           re.search("[^A-Za-z0-9]", literal))))
    return (bits - 2.0) / 2 + 0.5 * (kinds - 1) if kinds > 1 else -1.0


def named_literals(text: str) -> list[tuple[int, int]]:
    """Spans of literals that reach a sensitive name, with constants propagated in reading order."""
    # A constant is a list of its own literals (spans) and of the constants it is made of (lists, shared).
    constants: dict[str, list] = {}
    reached: dict[float, list[list]] = {}
    for found in _ASSIGNMENT.finditer(text):
        name, base = found["name"], found.start("value")
        atoms: list = []
        for atom in _ATOM.finditer(found["value"]):
            kind = atom.lastgroup
            if kind in ("d", "s"):
                atoms.append((base + atom.start(kind), base + atom.end(kind)))
                continue
            bare = atom["bare"].rstrip(".,")
            key = bare.strip("${}").rpartition(".")[2]
            if key in constants:
                atoms.append(constants[key])
            elif bare and not bare.startswith("$"):
                atoms.append((base + atom.start("bare"), base + atom.start("bare") + len(bare)))
        if not atoms:
            continue
        constants[name.rpartition(".")[2]] = atoms
        weight = name_score(name)
        if weight:
            reached.setdefault(weight, []).append(atoms)
    best: dict[tuple[int, int], float] = {}
    seen: set[int] = set()
    for weight in sorted(reached, reverse=True):  # what a more sensitive name reaches keeps that weight: one visit a list
        todo = reached[weight]
        while todo:
            atoms = todo.pop()
            if id(atoms) in seen:
                continue
            seen.add(id(atoms))
            for atom in atoms:
                if isinstance(atom, list):
                    todo.append(atom)
                else:
                    best.setdefault(atom, weight)
    return sorted(
        (a, b) for (a, b), weight in best.items() if weight + literal_score(text[a:b]) >= LEAST_SCORE
    )


def scan(text: str | None) -> list[tuple[str, int, int]]:
    """All spans of a text as (kind, start, end), by start and kind."""
    if not text:
        return []
    low = text.lower()
    spans: list[tuple[str, int, int]] = []
    if any(w in low for w in ("passw", "secret", "token", "api")):
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    if "=" in text or ":" in text:
        starts, reach = [], []  # of the spans so far, and how far those that start no later reach
        for _, a, b in sorted(spans, key=lambda s: s[1]):
            starts.append(a)
            reach.append(max(b, reach[-1] if reach else 0))
        for a, b in named_literals(text):
            before = bisect_right(starts, a)
            if not before or reach[before - 1] < b:
                spans.append(("literal", a, b))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan_secrets(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``spans`` (array of ``kind:start:end``, by start) for every row."""

    def make():
        return lambda texts: {"spans": [[f"{k}:{a}:{b}" for k, a, b in scan(t)] for t in texts]}

    return map_texts(docs, keep, text, make, {"spans": pa.list_(pa.string())})


def secret_digest(spans: list[str]) -> str:
    """SHA-256 of the base spans, for tests."""
    return hashlib.sha256(",".join(s for s in spans if not s.startswith("literal:")).encode()).hexdigest()
