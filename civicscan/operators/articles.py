"""Article extraction (X3, X9–X12): JSON-LD article metadata, container
density text, link-keeping text fallback, and the article record.

Like the date job, everything about one page stays in its row: the JSON-LD
items, the container nodes and the pick of the best node are array values of
the page row, so extraction is narrow (no shuffle) and a page with huge HTML
only ever costs its own task.

The walk over the page (``functions.markup``) yields the containers (nested
<article>/<section>/<div>/<main>) as ranges of one list of the page's text
pieces, so work and output stay linear in the page.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import html as H
from ..functions import jsonx
from ..functions.markup import Page, densest
from . import dates

# ------------------------------------------------------------------ JSON-LD article

def _is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def first_article(page: Page) -> dict | None:
    """A13 + P14: the first article-typed JSON-LD object (non-objects skipped;
    @graph is not searched), as a JSON value."""
    for item in map(json.loads, (found["item"] for found in dates.read_items(page.scripts))):
        kinds = item.get("@type") if isinstance(item, dict) else None
        if any(isinstance(k, str) and k in schemas.ARTICLE_TYPES for k in (kinds if isinstance(kinds, list) else [kinds])):
            return item
    return None


def _item(page: Page) -> str | None:
    article = first_article(page)
    return None if article is None else json.dumps(article)


ARTICLE = ("string", _item)


def _s(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def _truthy(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _author(art: Column) -> Column:
    """list -> ', '-joined names / texts (missing names skipped);
    object -> name; other truthy scalar -> text."""
    kind = jsonx.json_kind(art, "$.author")
    as_list = F.try_variant_get(art, "$.author", "array<variant>")
    joined = F.array_join(F.transform(as_list, lambda a: F.when(_is_object(a), _s(a, "$.name"))
                                      .otherwise(_s(a, "$"))), ", ")
    return (F.when(kind == F.lit("ARRAY"), joined)
            .when(kind == F.lit("OBJECT"), _s(art, "$.author.name"))
            .otherwise(_truthy(_s(art, "$.author"))))


def article_meta(art: Column) -> Column:
    """X3 fields of one article object."""
    publisher = F.when(jsonx.json_kind(art, "$.publisher") == F.lit("OBJECT"),
                       _s(art, "$.publisher.name")).otherwise(_s(art, "$.publisher"))
    return F.struct(
        F.coalesce(_truthy(_s(art, "$.headline")), _truthy(_s(art, "$.name"))).alias("title"),
        _author(art).alias("author"),
        F.coalesce(_truthy(_s(art, "$.datePublished")), _truthy(_s(art, "$.dateCreated"))).alias("date"),
        _s(art, "$.description").alias("description"),
        _s(art, "$.articleBody").alias("article_body"),
        publisher.alias("publisher"),
        _s(art, "$.url").alias("url"),
    )


def jsonld_articles(pages: DataFrame) -> DataFrame:
    """X3 per page with an article object: its metadata (staged so the item
    search runs once per page)."""
    # tested on a generator output, else the filter walks the page a second time
    found = H.signals(F.col("html"), article=ARTICLE).getField("article")
    staged = pages.select("page_id", F.explode_outer(F.array(found)).alias("_item")).where(F.col("_item").isNotNull())
    return (staged.select("page_id", F.try_parse_json("_item").alias("_art"))
            .select("page_id", article_meta(F.col("_art")).alias("m"))
            .select("page_id", "m.*"))


# ------------------------------------------------------------------ container nodes

def _densest(page: Page) -> dict | None:
    """P16 + F29 + A11: the container with the highest length/(links+1) among
    those of more than 200 characters, the first of equals; null without one."""
    best = densest(page, schemas.MIN_TEXT_CHARS)
    return best and dict(zip(("node_ord", "tag", "n_links", "score", "text"), best))


BEST = ("struct<node_ord:int,tag:string,n_links:int,score:double,text:string>", _densest)


def _container_text(text: Column) -> Column:
    return H.strip_ws(H.squeeze_newlines(text))


def best_containers(pages: DataFrame) -> DataFrame:
    """X10 per page: best container (tag, score inputs, text)."""
    # filter on a generator output: a plain where(b IS NOT NULL) would be
    # pushed below the projection and walk the page a second time
    found = H.signals(F.col("html"), best=BEST).getField("best")
    best = pages.select("page_id", F.explode_outer(F.array(found)).alias("b")).where(F.col("b.text").isNotNull())
    return best.select("page_id", "b.node_ord", "b.tag", "b.n_links", "b.score",
                       _container_text(F.col("b.text")).alias("text"))


# ------------------------------------------------------------------ article record

def fetched(pages: DataFrame) -> Column:
    """P18 input: a page counts as fetched when it has HTML and a 2xx status."""
    ok = F.col("html").isNotNull()
    if "status_code" in pages.columns:
        ok = ok & F.col("status_code").between(200, 299)
    return ok


def _bodies(page: Page) -> dict:
    """The page's article and densest container, with what stands in for a
    body that is itself HTML (its text) or empty (the link-keeping text)."""
    article, best = first_article(page), _densest(page)
    body = article.get("articleBody") if article else None
    body = body if isinstance(body, str) and body else (best or {}).get("text", "")
    reduced = Page(body).text("page", "\n") if all(x in body for x in ("<", ">", "</")) else None
    empty = not (body if reduced is None else reduced)
    return {"article": None if article is None else json.dumps(article), "dense": (best or {}).get("text"), "reduced": reduced,
            "linked": "".join(Page(page.source, linked=True).linked) if empty else None}


BODIES = ("struct<article:string,dense:string,reduced:string,linked:string>", _bodies)


def article_records(pages: DataFrame, id_col: str = "page_id") -> DataFrame:
    """JSON-LD body, else best container text, else link-keeping text;
    HTML-looking bodies reduced to text; lines stripped; url falls back to the
    page url.  ``request_url`` is always the url that was asked for: the key to
    join records on, as the page may name another url as its own.  Unfetched
    pages keep a row with only the urls."""
    html = F.when(fetched(pages), F.col("html"))
    s1 = pages.select(id_col, "url", html.alias("_html"))
    s2 = s1.select(id_col, "url", "_html", H.signals(F.col("_html"), found=BODIES).getField("found").alias("_f"))
    s3 = s2.select(id_col, "url", "_html", "_f", article_meta(F.try_parse_json("_f.article")).alias("m"))
    body0 = F.coalesce(_truthy(F.col("m.article_body")), _truthy(_container_text(F.col("_f.dense"))))
    s4 = s3.select(id_col, "url", "_html", "_f", "m", body0.alias("_b0"))
    body1 = F.when(H.looks_like_html(F.col("_b0")), F.coalesce("_f.reduced", "_b0")).otherwise(F.col("_b0"))
    s6 = s4.select(id_col, "url", "_html", "m", F.coalesce(_truthy(body1), H.linked_text(F.col("_f.linked"))).alias("_b2"))
    missing = F.col("_html").isNull()
    # output columns in the order of schemas.ARTICLE_FIELDS
    return s6.select(
        id_col, F.col("url").alias("request_url"),
        F.when(~missing, F.col("m.title")).alias("title"),
        F.when(~missing, F.col("m.author")).alias("author"),
        F.when(~missing, F.col("m.date")).alias("date"),
        F.when(~missing, F.col("m.publisher")).alias("publisher"),
        F.when(missing, F.col("url")).otherwise(F.coalesce(_truthy(F.col("m.url")), F.col("url"))).alias("url"),
        F.when(~missing, F.col("m.description")).alias("description"),
        F.when(~missing, H.clean_lines(F.col("_b2"))).alias("text"),
    )
