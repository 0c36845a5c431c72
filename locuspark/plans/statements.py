"""The SQL surface beyond Spark's grammar: table function calls, path literals and COPY.

Statements are cut into tokens that respect quotes and comments; nothing is matched inside them.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass

_TOKEN = re.compile(r"(?P<blank>\s+|--[^\n]*|/\*.*?\*/)|(?P<string>'(?:[^']|'')*')|(?P<name>\"(?:[^\"]|\"\")*\"|`(?:[^`]|``)*`)|(?P<word>[A-Za-z_]\w*)|(?P<number>\d[\w.]*)|(?P<sign>:=|=>|::|.)", re.S)

FUNCTIONS = {"read_gor": "gor", "read_gorz": "gorz", "read_gord": "gord"}
PARAMETERS = ("f", "ff", "range", "source", "columns")


@dataclass
class Token:
    kind: str
    text: str

    @property
    def value(self) -> str:
        return self.text[1:-1].replace("''", "'") if self.kind == "string" else self.text

    def __str__(self) -> str:
        # Double quotes hold identifiers.
        if self.kind == "name" and self.text[0] == '"':
            return "`" + self.text[1:-1].replace('""', '"').replace("`", "``") + "`"
        if self.kind == "string":  # Spark reads backslashes as escapes and doubled quotes as concatenation
            return "'" + self.value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return self.text


def tokens(sql: str) -> list[Token]:
    return [Token(m.lastgroup, m[0]) for m in _TOKEN.finditer(sql)]


def _closing(ts: list[Token], at: int) -> int:
    """The index of the bracket that closes the one at ``at``."""
    depth = 0
    for i in range(at, len(ts)):
        if ts[i].kind == "sign":
            depth += (ts[i].text in "([{") - (ts[i].text in ")]}")
            if depth == 0:
                return i
    raise ValueError("unbalanced brackets in SQL")


def _solid(ts: list[Token]) -> list[Token]:
    return [t for t in ts if t.kind != "blank"]


def _items(ts: list[Token]) -> list[list[Token]]:
    """Split at the commas outside of brackets."""
    out, depth = [[]], 0
    for t in _solid(ts):
        if t.kind == "sign":
            depth += (t.text in "([{") - (t.text in ")]}")
            if t.text == "," and not depth:
                out.append([])
                continue
        out[-1].append(t)
    return [x for x in out if x]


def _constant(ts: list[Token]) -> str | list[str | None] | None:
    """A string, NULL, ['a', ...] or array('a', ...)."""
    if len(ts) == 1 and ts[0].kind == "string":
        return ts[0].value
    if len(ts) == 1 and ts[0].text.upper() == "NULL":
        return None
    if len(ts) > 1 and ts[0].text.lower() == "array":
        ts = ts[1:]
    if len(ts) > 1 and ts[0].text in ("[", "(") and ts[-1].text in ("]", ")"):
        values = [_constant(x) for x in _items(ts[1:-1])]
        if not any(isinstance(x, list) for x in values):
            return values
    raise ValueError(f"only constants are allowed here: {' '.join(map(str, ts))}")


def call_options(ts: list[Token]) -> dict[str, str]:
    """The options of a table function call from what is between its brackets."""
    out: dict[str, str] = {}
    for i, item in enumerate(_items(ts)):
        if len(item) > 2 and item[1].text in (":=", "=>", "="):
            name, value = item[0].text.lower(), _constant(item[2:])
            if name not in PARAMETERS:
                raise ValueError(f"unknown parameter '{name}'")
        elif i == 0:
            name, value = "path", _constant(item)
            if not isinstance(value, str):
                raise ValueError("read_gor expects a single VARCHAR file path")
        else:
            raise ValueError("read_gor expects a single VARCHAR file path")
        if value is not None:
            out[name] = value if isinstance(value, str) else json.dumps([x for x in value if x is not None])
    if "path" not in out:
        raise ValueError("read_gor expects a single VARCHAR file path")
    return out


def rewrite(sql: str, view: Callable[[str, dict[str, str]], str]) -> str:
    """Spark SQL in which table function calls and path literals are views; ``view`` makes one for a format and its options."""
    ts = tokens(sql)
    out: list[str] = []
    last = ""
    i = 0
    while i < len(ts):
        t = ts[i]
        ahead = i + 1
        while ahead < len(ts) and ts[ahead].kind == "blank":
            ahead += 1
        opens = ahead < len(ts) and ts[ahead].text == "("
        if t.kind == "word" and t.text.lower() in FUNCTIONS and opens:
            end = _closing(ts, ahead)
            out.append(view(FUNCTIONS[t.text.lower()], call_options(ts[ahead + 1 : end])))
            i, last = end + 1, ")"
            continue
        if t.kind == "string" and last in ("FROM", "JOIN", ",") and t.value.lower().endswith((".gorz", ".gord")):
            out.append(view("gor", {"path": t.value}))
            i, last = i + 1, "literal"
            continue
        out.append(":" if t.text == ":" else str(t))
        if t.kind != "blank":
            last = t.text.upper()
        i += 1
    return "".join(out)


@dataclass
class Copy:
    query: str
    path: str
    format: str
    options: dict[str, str]


def parse_copy(sql: str) -> Copy | None:
    """COPY (query) | table TO 'path' [(FORMAT x, ...)]; None for any other statement."""
    ts = tokens(sql.strip().rstrip(";"))
    solid = [i for i, t in enumerate(ts) if t.kind != "blank"]
    if not solid or ts[solid[0]].text.upper() != "COPY":
        return None
    first = solid[1]
    if ts[first].text == "(":
        end = _closing(ts, first)
        query = "".join(t.text for t in ts[first + 1 : end])
        rest = ts[end + 1 :]
    else:
        to = next(i for i in solid if ts[i].text.upper() == "TO")
        query = "SELECT * FROM " + "".join(t.text for t in ts[first:to])
        rest = ts[to:]
    rest = _solid(rest)
    if len(rest) < 2 or rest[0].text.upper() != "TO" or rest[1].kind != "string":
        raise ValueError("COPY needs TO 'path'")
    options: dict[str, str] = {}
    if len(rest) > 2:
        for item in _items(rest[3:-1]):
            options[item[0].text.lower()] = item[-1].value if len(item) > 1 else "true"
    path = rest[1].value
    kind = options.pop("format", "").lower() or path.rpartition(".")[2].lower()
    return Copy(query, path, kind, options)
