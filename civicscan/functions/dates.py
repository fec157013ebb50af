"""F19 fuzzy date parsing with built-in expressions.

A text is cut into tokens once; a fold over the tokens fills the slots of a
date.  Numbers and month names that stand together, with nothing but blanks,
commas, '-', '/', '.', an apostrophe, "of" or a time of day between them, are
one group.  A group of three resolves at once, a month and a year when the
group ends; the first group that gives a valid date wins.

The wall-clock date is kept and any zone is ignored; a month without a day
gives day 1; text without a year and a month gives null (never "today").
Numbers are month first, and day first where the month could not be one;
two-digit years are 1969 to 2068.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTH_KEYS = "janfebmaraprmayjunjulaugsepoctnovdec"
MONTH_NAMES = [name for word in ("january february march april may june july august september october november december").split()
               for name in dict.fromkeys((word[:3], word))] + ["sept"]

#: Times of day, numbers with an ordinal's ending, words, and any other character.
TOKEN_RE = r"(?i)\d{1,2}\s*[ap]\.?m\b|\d{1,2}:\d{2}(?::\d{2})?|\d+(?:(?:st|nd|rd|th)\b)?|[a-z]+|[^a-z\d]"

# kinds of tokens
BLANK, DASH, DOT, TIME, MONTH, YEAR, TWO, ONE, WHOLE, ODD, WORD, OTHER = range(12)


def _token(t: str) -> str:
    """Spark SQL text: (kind, value) of a token, by its length and its ends (no pattern is run again)."""
    ends_in_digit = f"right({t}, 1) BETWEEN '0' AND '9'"
    number = (f"CASE WHEN instr({t}, ':') > 0 OR lower(right({t}, 1)) = 'm' THEN {TIME} "
              f"WHEN NOT {ends_in_digit} THEN IF(length({t}) <= 4, {ONE}, {ODD}) "
              f"ELSE CASE length({t}) WHEN 1 THEN {ONE} WHEN 2 THEN {TWO} WHEN 4 THEN {YEAR} WHEN 8 THEN {WHOLE} WHEN 12 THEN {WHOLE} "
              f"WHEN 14 THEN {WHOLE} ELSE {ODD} END END")
    names, blanks = ", ".join(f"'{n}'" for n in MONTH_NAMES), "' ', ',', 'of', '\\t', '\\n', '\\r', '\u00a0', '\u2019', '\\''"
    kind = (f"CASE WHEN left({t}, 1) BETWEEN '0' AND '9' THEN {number} WHEN lower({t}) IN ({blanks}) THEN {BLANK} "
            f"WHEN {t} IN ('-', '/') THEN {DASH} WHEN {t} = '.' THEN {DOT} WHEN lower({t}) IN ({names}) THEN {MONTH} "
            f"WHEN lower(left({t}, 1)) BETWEEN 'a' AND 'z' THEN {WORD} ELSE {OTHER} END")
    # nothing that isn't digits is cast: a failing cast costs more than all the rest
    value = (f"CASE WHEN left({t}, 1) NOT BETWEEN '0' AND '9' THEN IF(lower({t}) IN ({names}), CAST((instr('{MONTH_KEYS}', lower(left({t}, 3))) + 2) DIV 3 AS INT), 0) "
             f"WHEN instr({t}, ':') > 0 OR lower(right({t}, 1)) = 'm' THEN 0 WHEN {ends_in_digit} THEN CAST(left({t}, 8) AS INT) "
             f"ELSE CAST(left({t}, least(8, length({t}) - 2)) AS INT) END")
    return f"named_struct('k', {kind}, 'v', {value})"


def _date(y: str, m: str, d: str) -> str:
    return f"try_to_date(format_string('%04d-%02d-%02d', {y}, {m}, {d}), 'yyyy-MM-dd')"


def _full(y: str) -> str:
    """The year of a slot of kind YEAR or TWO."""
    return f"({y}.v + IF({y}.k = {TWO}, IF({y}.v < 69, 2000, 1900), 0))"


_SMALL = f"({TWO}, {ONE})"
_ANY_YEAR = f"({YEAR}, {TWO})"


def _triple(a: str, b: str, c: str, joins: str) -> str:
    """The date of three slots; ``joins`` counts the explicit separators between them."""
    def case(when: str, y: str, m: str, d: str) -> str:
        return f"WHEN {when} THEN {_date(_full(y), m + '.v', d + '.v')}"
    first_month = f"IF({a}.v > 12 AND {b}.v <= 12, {b}.v, {a}.v)"
    first_day = f"IF({a}.v > 12 AND {b}.v <= 12, {a}.v, {b}.v)"
    return " ".join([
        "CASE",
        case(f"{a}.k = {MONTH} AND {b}.k IN {_SMALL} AND {c}.k IN {_ANY_YEAR}", c, a, b),
        case(f"{a}.k = {MONTH} AND {b}.k = {YEAR} AND {c}.k IN {_SMALL} AND {joins} = 2", b, a, c),
        case(f"{b}.k = {MONTH} AND {a}.k = {YEAR} AND {c}.k IN {_SMALL}", a, b, c),
        case(f"{b}.k = {MONTH} AND {a}.k IN {_SMALL} AND {c}.k IN {_ANY_YEAR}", c, b, a),
        case(f"{c}.k = {MONTH} AND {a}.k = {YEAR} AND {b}.k IN {_SMALL}", a, c, b),
        case(f"{c}.k = {MONTH} AND {b}.k = {YEAR} AND {a}.k IN {_SMALL}", b, c, a),
        case(f"{a}.k = {YEAR} AND {b}.k IN {_SMALL} AND {c}.k IN {_SMALL}", a, b, c),
        case(f"{a}.k = {TWO} AND {a}.v > 31 AND {b}.k IN {_SMALL} AND {c}.k IN {_SMALL} AND {joins} = 2", a, b, c),
        f"WHEN {a}.k IN {_SMALL} AND {b}.k IN {_SMALL} AND ({c}.k = {YEAR} OR {c}.k = {TWO} AND {joins} = 2)",
        f"THEN {_date(_full(c), first_month, first_day)}",
        "END"])


def _pair(a: str, b: str, numbers: str) -> str:
    """The first day of the month of two slots; two numbers only where ``numbers`` holds."""
    return (f"CASE WHEN {a}.k = {MONTH} AND {b}.k = {YEAR} OR {a}.k IN {_SMALL} AND {b}.k = {YEAR} AND {numbers} THEN {_date(b + '.v', a + '.v', '1')} "
            f"WHEN {a}.k = {YEAR} AND ({b}.k = {MONTH} OR {b}.k IN {_SMALL} AND {numbers}) THEN {_date(a + '.v', b + '.v', '1')} END")


_NONE = "named_struct('k', -1, 'v', 0)"


def _state(n: str, a: str, b: str, joins: str, sep: str, lost: str, timed: str, d: str) -> str:
    """n slots a, b; explicit joins between them; the separator since; whether
    numbers belong to something else; whether a time stands just before; the date."""
    return f"named_struct('n', {n}, 'a', {a}, 'b', {b}, 'j', {joins}, 's', {sep}, 'lost', {lost}, 'timed', {timed}, 'd', {d})"


_NO_DATE = "CAST(NULL AS DATE)"
_START = _state("0", _NONE, _NONE, "0", str(BLANK), "false", "false", _NO_DATE)


def _step(g: str, c: str) -> str:
    joined = f"{g}.j + IF({g}.s = {BLANK}, 0, 1)"
    # a slot: the third one resolves the group, or the first one leaves it
    three = f"coalesce({_triple(g + '.a', g + '.b', c, '(' + joined + ')')}, {_pair(g + '.a', g + '.b', 'false')})"
    named = f"{MONTH} IN ({g}.a.k, {g}.b.k, {c}.k)"
    third = (f"CASE WHEN {named} OR {joined} = 0 OR {g}.b.k = {YEAR} THEN {_state('2', g + '.b', c, f'IF({g}.s = {BLANK}, 0, 1)', str(BLANK), 'false', 'false', three)} "
             f"ELSE {_state('0', _NONE, _NONE, '0', str(BLANK), 'true', 'false', three)} END")
    slot = (f"CASE WHEN {g}.lost AND {c}.k <> {YEAR} AND {c}.k <> {MONTH} THEN {g} "
            f"WHEN {g}.n = 0 THEN {_state('1', c, _NONE, '0', str(BLANK), 'false', 'false', _NO_DATE)} "
            f"WHEN {g}.n = 1 THEN {_state('2', g + '.a', c, joined, str(BLANK), 'false', 'false', _NO_DATE)} ELSE {third} END")
    # what is no part of a date ends the group: two slots may do, and a number of another kind spoils those joined to it
    two = f"IF({g}.n = 2, {_pair(g + '.a', g + '.b', f'({g}.j = 1 AND {g}.s <> {DASH})')}, {_NO_DATE})"
    whole = f"IF({c}.k = {WHOLE}, {_date(f'CAST({c}.v / 10000 AS INT)', f'CAST({c}.v / 100 AS INT) % 100', f'{c}.v % 100')}, {_NO_DATE})"
    end = _state("0", _NONE, _NONE, "0", str(BLANK), f"{c}.k IN ({ODD}, {WHOLE})", "false", f"coalesce({two}, {whole})")
    between = _state(f"{g}.n", f"{g}.a", f"{g}.b", f"{g}.j", f"IF({c}.k IN ({DASH}, {DOT}) AND {g}.s <> {DASH}, {c}.k, {g}.s)",
                     f"{g}.lost AND {c}.k IN ({DASH}, {DOT})", f"{c}.k = {TIME} OR {g}.timed AND {c}.k = {BLANK}", _NO_DATE)
    zone = f"{c}.k = {WORD} AND {g}.timed"
    return (f"CASE WHEN {g}.d IS NOT NULL THEN {g} WHEN {c}.k IN ({MONTH}, {YEAR}, {TWO}, {ONE}) THEN {slot} "
            f"WHEN {c}.k IN ({BLANK}, {DASH}, {DOT}, {TIME}) OR {zone} THEN {between} ELSE {end} END")


def parse_date_text(x: str) -> str:
    """Spark SQL text of ``parse_date`` for a column, field or lambda variable."""
    tokens = f"transform(regexp_extract_all({x}, r\"{TOKEN_RE}\", 0), t -> {_token('t')})"
    stop = f"named_struct('k', {OTHER}, 'v', 0)"
    return f"aggregate(concat({tokens}, array({stop})), {_START}, (g, c) -> {_step('g', 'c')}, g -> g.d)"


def parse_date(column: str) -> Column:
    """the first date in the text of ``column`` as DateType (null when
    none).  Written as SQL text: column calls cost the driver more."""
    return F.expr(parse_date_text(column))


def format_mdy(d: Column) -> Column:
    """The MM/DD/YYYY text form of a date (CSV sinks)."""
    return F.date_format(d, "MM/dd/yyyy")
