"""Collected service responses as tables: search result unpacking (nested and
flat shapes), top-N, url lists, snippet / verdict tests, prompt text, and
structured advisory extraction from model responses with a quarantine.

All operators are narrow (a parse + generators); nothing shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .. import schemas
from ..functions import jsonx
from ..session import ship_package


def _ids(ids: Sequence[str]) -> list[Column]:
    return [F.col(c) for c in ids]


def _unpack(df: DataFrame, ids: Sequence[str], arr: Column, name: str = "r") -> DataFrame:
    """posexplode without the optimizer's inferred size(arr) > 0 pre-filter
    (which would evaluate the JSON parse twice): outer generator, then drop
    the null row of empty / missing arrays."""
    return (df.select(*_ids(ids), F.posexplode_outer(arr).alias("pos", name))
            .where(F.col("pos").isNotNull()))


def _items(body: Column, path: str) -> Column:
    """The array at ``path`` of a strictly parsed body, as variants."""
    return F.try_variant_get(jsonx.strict_json(body), path, "array<variant>")


def _result_rows(responses: DataFrame, ids: Sequence[str], arr: Column, top_n: int | None,
                 fields: Sequence[tuple[str, str]]) -> DataFrame:
    """One row per object of ``arr`` (its rank is its place in the array);
    items of another kind (text, numbers, null) are no results."""
    if top_n is not None:
        arr = F.slice(arr, 1, top_n)
    ex = _unpack(responses, ids, arr).where(F.coalesce(jsonx.json_kind(F.col("r")) == F.lit("OBJECT"), F.lit(False)))
    return ex.select(*_ids(ids), (F.col("pos") + 1).cast("bigint").alias("rank"),
                     *[F.try_variant_get(F.col("r"), f"$.{key}", "string").alias(name) for key, name in fields])


NESTED_PATH = "$.data.webPages.value"
FLAT_PATH = "$.items"


def one_answer(log: DataFrame, key: str, value: str, path: str | None = None) -> DataFrame:
    """One stored answer per request: a request logged more than once keeps
    the smallest answer text; with ``path``, the smallest of those that are
    JSON with an array there, if any is.  The minimum is taken before the
    shuffle too, so a request with very many rows is one row per map task."""
    usable = _items(F.col(value), path).isNotNull() if path else F.lit(True)
    best = F.min(F.struct((~usable).alias("no"), F.col(value).alias("v")))
    return log.groupBy(key).agg(best.alias("_best")).select(key, F.col("_best.v").alias(value))


def nested_results(responses: DataFrame, ids: Sequence[str] = ("doc_id",), body: str = "body",
                   top_n: int | None = None) -> DataFrame:
    """S9 + P13 (+ W4 when ``top_n``): ``data.webPages.value[]`` -> rows.

    One strict parse per body; non-JSON bodies and bodies without the path
    (or with a non-array there) give no rows.
    """
    return _result_rows(responses, ids, _items(F.col(body), NESTED_PATH), top_n,
                        [("url", "url"), ("displayUrl", "display_url"), ("snippet", "snippet"), ("summary", "summary")])


def flat_results(responses: DataFrame, ids: Sequence[str] = ("doc_id",), body: str = "body",
                 top_n: int | None = None) -> DataFrame:
    """S10 (+ W4): ``items[]`` of {title, link, snippet} -> rows."""
    return _result_rows(responses, ids, _items(F.col(body), FLAT_PATH), top_n,
                        [("title", "title"), ("link", "link"), ("snippet", "snippet")])


def result_urls(responses: DataFrame, ids: Sequence[str] = ("doc_id",), body: str = "body") -> DataFrame:
    """The url list of each nested response (responses without results dropped)."""
    objects = F.filter(_items(F.col(body), NESTED_PATH),
                       lambda r: F.coalesce(jsonx.json_kind(r) == F.lit("OBJECT"), F.lit(False)))
    urls = F.transform(objects, lambda r: F.try_variant_get(r, "$.url", "string"))
    out = responses.select(*_ids(ids), urls.alias("urls")).where(F.col("urls").isNotNull())
    return out.select(*_ids(ids), F.array_size("urls").cast("bigint").alias("n_urls"),
                      F.array_join("urls", "\n").alias("urls_text"))


def snippet_contains(df: DataFrame, word: str = schemas.SNIPPET_WORD, column: str = "snippet") -> DataFrame:
    """Case-sensitive substring test."""
    return df.where(F.col(column).contains(word))


def verdict_yes(df: DataFrame, column: str = "response", word: str = schemas.VERDICT_WORD) -> DataFrame:
    """P5: the verdict text contains YES (case-sensitive)."""
    return df.where(F.col(column).contains(word))


def extraction_prompt(text: Column) -> Column:
    """the extraction prompt around the whole article text."""
    return F.concat(F.lit(schemas.EXTRACTION_PROMPT_HEAD), text, F.lit(schemas.EXTRACTION_PROMPT_TAIL))


def verdict_prompt(snippet: Column) -> Column:
    """the yes/no verdict prompt after a snippet."""
    return F.concat(snippet, F.lit(schemas.VERDICT_PROMPT_SUFFIX))


PARTS_SCHEMA = "array<struct<type:string,text:string>>"


def response_text(parts: Column) -> Column:
    """Concatenated text parts of a model response (array<struct<text>>);
    parts without text are skipped."""
    return F.array_join(F.transform(parts, lambda p: F.coalesce(p.getField("text"), F.lit(""))), "")


def model_texts(df: DataFrame, ids: Sequence[str] = ("doc_id",), content: str = "content") -> DataFrame:
    """S14 over stored responses: JSON content-part arrays -> one text per
    response; bodies that are not a part array give no row."""
    # typed read of a strictly parsed array (a lone object is not a part list)
    parts = F.try_variant_get(jsonx.strict_json(F.col(content)), "$", PARTS_SCHEMA)
    return (df.select(*_ids(ids), parts.alias("_parts")).where(F.col("_parts").isNotNull())
            .select(*_ids(ids), response_text(F.col("_parts")).alias("response")))


# ------------------------------------------------------------------ advisories

ADVISORY_FIELDS = ("type", "location", "start_date", "end_date", "publish_date")
READ_TYPE = ("struct<reason:string,items:array<struct<is_object:boolean," + ",".join(f"{f}:string" for f in ADVISORY_FIELDS) + ">>>")


def _field(item: dict, name: str) -> str | None:
    """the items of a list-valued location joined, any other value as text."""
    value = item.get(name)
    if name == "location" and isinstance(value, list):
        return ", ".join(t for t in map(jsonx.as_text, value) if t is not None)
    return jsonx.as_text(value)


def read_advisories(text: str | None, lenient: bool = False) -> dict:
    """The advisories of one extracted JSON text, in one parse: why there are
    none, or its items with their fields as text."""
    if text == "":
        return {"reason": "no_json", "items": None}
    try:
        value = (jsonx.read_lenient if lenient else jsonx.read_strict)(text or "")
    except ValueError:
        return {"reason": "invalid_json", "items": None}
    items = value.get("advisories") if isinstance(value, dict) else None
    if not isinstance(items, list):
        return {"reason": "no_advisories", "items": None}
    return {"reason": None, "items": [{"is_object": isinstance(a, dict)} | {f: _field(a, f) if isinstance(a, dict) else None for f in ADVISORY_FIELDS}
                                      for a in items]}


def _read(df: DataFrame, text: str, lenient: bool) -> Column:
    """F14 + F15 / F16: struct(reason, items) of the JSON in a response text."""
    ship_package(df.sparkSession)
    schema = T._parse_datatype_string(READ_TYPE)
    kind = to_arrow_type(schema)

    def read(texts: pa.Array) -> pa.Array:
        return pa.array([read_advisories(t, lenient) for t in texts.to_pylist()], kind)

    return F.arrow_udf(read, schema)(jsonx.first_json_object(F.col(text)))


def advisories(df: DataFrame, ids: Sequence[str] = ("doc_id",), text: str = "response",
               lenient: bool = False) -> DataFrame:
    """X13 + J10 + F17 + F18: one normalised row per advisory object; the
    parent columns (``ids``) repeat on each.  ``adv_pos`` counts all items of
    the response; items of another kind are in ``advisories_rejected``."""
    read = df.withColumn("_read", _read(df, text, lenient))
    ex = _unpack(read, ids, F.col("_read.items"), "a").where(F.col("a.is_object"))
    return ex.select(*_ids(ids), (F.col("pos") + 1).cast("bigint").alias("adv_pos"),
                     *[F.coalesce(F.col(f"a.{f}"), F.lit("")).alias(f) for f in ("type", "location")],
                     *[jsonx.nullish(F.col(f"a.{d}")).alias(d) for d in ("start_date", "end_date", "publish_date")])


def advisories_rejected(df: DataFrame, ids: Sequence[str] = ("doc_id",), text: str = "response",
                        lenient: bool = False) -> DataFrame:
    """P20 quarantine, with the reason: responses that are not a JSON object
    with an ``advisories`` array, and one row per response with items that are
    not objects (its other items are still advisories)."""
    odd = F.exists(F.col("_read.items"), lambda a: ~a.getField("is_object"))
    reason = F.coalesce(F.col("_read.reason"), F.when(odd, "item_not_object"))
    checked = df.withColumn("_read", _read(df, text, lenient)).withColumn("_reason", reason)
    # tested on a generator output, so the parse isn't repeated below the projection
    return (checked.select(*_ids(ids), F.explode_outer(F.array("_reason")).alias("reason"))
            .where(F.col("reason").isNotNull()))


def advisory_rows(advs: DataFrame, extras: DataFrame, on: Sequence[str],
                  fields: Sequence[str] = tuple(schemas.ADVISORY_CSV_FIELDS_A)) -> DataFrame:
    """Normalised advisory fields plus per-article extra columns; an extra
    column replaces the advisory column of the same name."""
    extra_cols = [c for c in extras.columns if c not in on]
    base = advs.drop(*[c for c in extra_cols if c in advs.columns])
    joined = base.join(extras, list(on), "inner")
    cols = [F.col(c) if c in joined.columns else F.lit("").alias(c) for c in fields]
    return joined.select(*[c for c in on if c not in fields], *cols)


def advisories_carrying(df: DataFrame, ids: Sequence[str], extras: Sequence[str],
                        fields: Sequence[str] = tuple(schemas.ADVISORY_CSV_FIELDS_A),
                        text: str = "response", lenient: bool = False) -> DataFrame:
    """R5 in one pass: the per-article extra columns ride along the advisory
    explode (no join back to the article table) and replace the advisory
    field of the same name; missing fields are ''."""
    carried = df.select(*_ids(ids), *[F.col(c).alias(f"_x_{c}") for c in extras], F.col(text))
    advs = advisories(carried, [*ids, *[f"_x_{c}" for c in extras]], text=text, lenient=lenient)
    cols = []
    for f in fields:
        if f in extras:
            cols.append(F.col(f"_x_{f}").alias(f))
        elif f in advs.columns:
            cols.append(F.col(f))
        else:
            cols.append(F.lit("").alias(f))
    return advs.select(*[c for c in ids if c not in fields], *cols)
