"""JSON helpers: typed reads of strict JSON on columns, and the two rules by
which model responses are read (Python's own, and a lenient one)."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_json_object(text: Column) -> Column:
    """from the first '{' to the last '}' across lines ('' if none)."""
    return F.regexp_extract(text, r"(?s)\{.*\}", 0)


def strict_json(j: Column) -> Column:
    """F15 in one parse: the variant of ``j`` when it is exactly one JSON
    value (nothing after it), else null.  Typed reads then use
    ``try_variant_get`` on the result instead of parsing the text again."""
    wrapped = F.try_parse_json(F.concat(F.lit("["), j, F.lit("]")))
    one = F.coalesce(F.array_size(F.try_variant_get(wrapped, "$", "array<variant>")) == F.lit(1), F.lit(False))
    return F.when(one, F.variant_get(wrapped, "$[0]", "variant"))


def json_kind(v: Column, path: str = "$") -> Column:
    """Upper-case kind of a variant value at ``path``: OBJECT, ARRAY, STRING, ..."""
    s = F.schema_of_variant(F.variant_get(v, path, "variant"))
    return F.when(s.startswith("OBJECT"), "OBJECT").when(s.startswith("ARRAY"), "ARRAY").otherwise(s)


def nullish(c: Column) -> Column:
    """F17 for dates: null or the text 'null' -> ''."""
    return F.when(c.isNull() | (c == F.lit("null")), F.lit("")).otherwise(c)


# ---------------------------------------------------------------- reading responses

def read_strict(text: str):
    """one JSON value by Python's rule: the last value of a repeated key
    counts, NaN and Infinity are numbers.  Raises ValueError otherwise."""
    try:
        return json.loads(text)
    except RecursionError as e:
        raise ValueError("nested too deeply") from e


_LENIENT = re.compile(r"""
    (?P<skip> [\s\ufeff]++ | //[^\n\r\u2028\u2029]*+ | /\*.*?\*/ )
  | (?P<string> "(?:[^"\\]|\\.)*+" | '(?:[^'\\]|\\.)*+' )
  | (?P<number> [+-]?(?: 0[xX][0-9a-fA-F]++ | Infinity\b | NaN\b | (?:[0-9]++\.?[0-9]*+|\.[0-9]++)(?:[eE][+-]?[0-9]++)? ) )
  | (?P<name> [^\W\d][\w$]*+ | \$[\w$]*+ )
  | (?P<mark> [][{}:,] )
""", re.S | re.X)
_ESCAPE = re.compile(r"\\(?:u([0-9a-fA-F]{4})|x([0-9a-fA-F]{2})|(\r\n|.))", re.S)
_ESCAPED = {"b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t", "v": "\v", "0": "\0", "\n": "", "\r": "", "\r\n": "", "\u2028": "", "\u2029": ""}


def _text(quoted: str) -> str:
    def one(m: re.Match) -> str:
        code = m[1] or m[2]
        return chr(int(code, 16)) if code else _ESCAPED.get(m[3], m[3])
    return _ESCAPE.sub(one, quoted[1:-1])


def _number(text: str) -> str:
    sign, digits = ("-" if text[0] == "-" else ""), text.lstrip("+-")
    if digits[:2] in ("0x", "0X"):
        return sign + str(int(digits, 16))
    if digits == "NaN":
        return digits
    whole, point, rest = digits.partition(".")
    if point:
        digits = (whole or "0") + "." + (rest if rest[:1].isdigit() else "0" + rest)
    return sign + digits


def read_lenient(text: str):
    """F16: a strict value, or else what people write for JSON: single quotes,
    every escape, bare keys, hexadecimal and signed numbers, comments, trailing
    commas.  The text is cut into tokens first, so strings keep what they hold.
    Raises ValueError for anything else."""
    try:
        return read_strict(text)
    except ValueError:
        pass
    out: list[tuple[str, str]] = []
    at = 0
    while at < len(text):
        m = _LENIENT.match(text, at)
        if m is None:
            raise ValueError(f"no token at {at}")
        at, kind, token = m.end(), m.lastgroup, m.group()
        if kind == "string":
            out.append((kind, json.dumps(_text(token))))
        elif kind == "number":
            out.append((kind, _number(token)))
        elif kind == "name":
            out.append((kind, token))
        elif kind == "mark":
            if token == ":" and out and out[-1][0] == "name":
                out[-1] = "string", json.dumps(out[-1][1])
            # a comma may end a list that has something before it
            if token in "]}" and len(out) > 1 and out[-1][1] == "," and out[-2][1] not in ("[", "{", ",", ":"):
                out.pop()
            out.append((kind, token))
    return read_strict(" ".join(t for _, t in out))


def as_text(value) -> str | None:
    """A field's value as text: null stays null, a nested value is compact JSON."""
    if value is None or isinstance(value, str):
        return value
    if isinstance(value, float) and value in (float("inf"), float("-inf")):
        return "Infinity" if value > 0 else "-Infinity"
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"))
