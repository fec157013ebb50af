"""Page signals and page text on columns.

``signals`` is the one Python step of the page jobs: an Arrow-batched UDF that
walks each page once (``markup.Page``) and returns every signal its caller
asks for as one struct.  What follows from the signals is built-in expressions.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..session import ship_package
from .markup import Page

# Characters removed by ``strip_ws``: Python's whitespace set (str.isspace),
# built from the rule rather than listed.
WS_CHARS = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())
# Line boundaries of Python's str.splitlines().
LINE_SPLIT_RE = r"\r\n|[\n\r\x0B\x0C\x1C\x1D\x1E\x{85}\x{2028}\x{2029}]"


def signals(html: Column, linked: bool = False, **fields: tuple[str, Callable[[Page], object]]) -> Column:
    """A struct of ``fields``, each a type and a function of the walked page;
    null for a null page.  ``linked`` also writes the link-keeping text."""
    spark = SparkSession.active()
    ship_package(spark)
    schema = T.StructType([T.StructField(name, T._parse_datatype_string(ddl)) for name, (ddl, _) in fields.items()])
    kind, wanted = to_arrow_type(schema), {name: fn for name, (_, fn) in fields.items()}

    def walk(pages: pa.Array) -> pa.Array:
        found = (None if h is None else Page(h, linked) for h in pages.to_pylist())
        return pa.array([None if p is None else {name: fn(p) for name, fn in wanted.items()} for p in found], kind)

    return F.arrow_udf(walk, schema)(html)


def strip_ws(s: Column) -> Column:
    """Python-style strip (whitespace incl. no-break space), no regex."""
    return F.btrim(s, F.lit(WS_CHARS))


# Unicode spaces that Python's \s matches but Java's and RE2's do not.
UNICODE_SPACES_RE = r"[\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def ascii_spaces(s: Column) -> Column:
    """Map Unicode spaces to ' ' so the ASCII whitespace class in label patterns sees them."""
    return F.regexp_replace(s, UNICODE_SPACES_RE, " ")


# ---------------------------------------------------------------- article text helpers

def squeeze_newlines(s: Column) -> Column:
    """runs of 2+ newlines -> one blank line."""
    return F.regexp_replace(s, r"\n{2,}", "\n\n")


def clean_lines(s: Column) -> Column:
    """strip every line, drop blank lines, join with newlines."""
    return F.array_join(F.filter(F.transform(F.split(s, LINE_SPLIT_RE), strip_ws),
                                 lambda x: x != F.lit("")), "\n")


def rstrip_lines(s: Column) -> Column:
    """right-trim every line."""
    return F.regexp_replace(s, r"(?m)[ \t\x{00A0}]+$", "")


#: Visible text, stripped pieces joined by blanks.
PAGE_TEXT = ("string", lambda p: p.text("page", " "))
#: X9 (article cleanup): text without script/style/template/noscript/form/footer/nav/aside, a piece per line.
ARTICLE_LINES = ("string", lambda p: p.text("article", "\n"))
#: X11: anchors -> [text](url), images dropped, headings -> '#' marks, list items -> '* ', bold -> '**', italics -> '_'
#: (one mark per tag), block tags -> line breaks, other tags removed; ``linked_text`` cleans its lines.
LINKED = ("string", lambda p: "".join(p.linked))


def texts(html: Column) -> Column:
    """struct(text_all, text_article) of a page in one walk."""
    return signals(html, text_all=PAGE_TEXT, text_article=ARTICLE_LINES)


def article_text(lines: Column) -> Column:
    """Blank runs of ``ARTICLE_LINES`` squeezed."""
    return strip_ws(squeeze_newlines(lines))


def linked_text(linked: Column) -> Column:
    """Lines of ``LINKED`` right-trimmed, three line breaks or more made two."""
    return strip_ws(F.regexp_replace(rstrip_lines(linked), r"\n{3,}", "\n\n"))


def markdown_text(html: Column) -> Column:
    """X11 of a page."""
    return linked_text(signals(html, linked=True, text=LINKED).getField("text"))


def looks_like_html(s: Column) -> Column:
    """Contains '<', '>' and '</'."""
    return s.contains("<") & s.contains(">") & s.contains("</")
