"""Odd inputs of every training-data operator: nulls, empty and long texts,
ties, repeated rows, empty tables, and columns with clashing names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from civicscan.llm import (bpe, embed_dedup, langid, licenses, line_dedup, order_minhash, packing, page_text, sharding, simhash)
from civicscan.llm.queries import vocabulary

LONG = " ".join(f"word{i % 97} thing{i % 89}" for i in range(30_000))
ROWS = [(1, "The first text of all.\nIt has two lines.", "en", "a", 5, "x"), (2, None, "en", None, None, "y"), (3, "", None, "a", 0, None),
        (4, "  \n\t ", "de", "b", 4, ""), (5, LONG, "en", "b", len(LONG), "x"), (6, "12345 !!!", "fr", "b", 9, "x"),
        (7, "Le petit texte de la fin.", "fr", "c", 25, "z"), (7, "Le petit texte de la fin.", "fr", "c", 25, "z"),
        (None, "no id here", "en", "a", 10, "q"), (None, None, None, None, None, None), (8, "Z\u0000é🙂 x", "de", "a", 6, "k")]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, {} string"

OPERATORS = {
    "licenses": lambda d: licenses.scan(d),
    "langid": lambda d: langid.identify(d, langid.fit(d)),
    "order_minhash": lambda d: order_minhash.fingerprints(d),
    "sharding": lambda d: sharding.shard(d, shards=4),
    "packing": lambda d: packing.pack(d, vocabulary("word_bpe_49k.json"), length=64),
    "bpe": lambda d: bpe.round_trip(d, vocabulary("byte_bpe_50k.json")),
    "simhash": lambda d: simhash.near_duplicates(d),
    "line_dedup": lambda d: line_dedup.digest(d),
}
# one name that an operator uses inside, among the columns it must not look at
CLASHING = ["id", "t", "h", "fp", "bucket", "part", "found", "x", "lines", "record", "__id", "key"]


@pytest.mark.parametrize("name", OPERATORS)
@pytest.mark.parametrize("clash", ["id", "t"])
def test_odd_rows_get_a_result_each(spark, name, clash):
    docs = spark.createDataFrame(ROWS, SCHEMA.format(clash)).repartition(3)
    out = OPERATORS[name](docs).collect()
    if name == "packing":
        assert sum(r.start == 0 for r in out) == len(ROWS)
        assert sum(r.length for r in out) == sum(r.doc_tokens for r in out if r.start == 0)
    else:
        assert len(out) == len(ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables_stay_empty(spark, name):
    assert OPERATORS[name](spark.createDataFrame([], SCHEMA.format("id"))).collect() == []


def test_columns_with_clashing_names_pass_through(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA.format("t")).withColumns({f"{c}": F.lit(1) for c in CLASHING if c != "t"})
    for keep in (simhash.keep_one, line_dedup.dedup, lambda d: langid.keep_identified(d, langid.fit(d))):
        assert keep(docs).columns == docs.columns
    assert sharding.shard(docs).select("record.*").columns == docs.columns


def test_language_filter_drops_only_texts_without_language(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA.format("u"))
    kept = langid.keep_identified(docs, langid.fit(docs)).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "5", "7", "7", "8", "None"]


def test_stages_keep_the_columns_and_take_odd_rows(spark, tmp_path):
    docs = spark.createDataFrame([r[:5] for r in ROWS], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_embeddings_with_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1, "a"), (2, [2.0, 0.0], 1, "b"), (3, [1.0, 0.0], 2, None), (4, None, 1, ""), (5, [], 1, "x"),
            (6, [0.0, 0.0], 1, "x"), (7, [nan, 1.0], 1, "x"), (8, [inf, 1.0], 1, "x"), (9, [1.0, None], 1, "x"), (10, [1.0, 0.0], None, "x"),
            (10, [1.0, 0.0], None, "x"), (11, [0.0, 1.0], 1, "x"), (12, [0.0, 1.0], 1, "x"), (12, [0.0, 1.0], 1, "x"), (13, [1.0, 0.0, 0.0], 1, "x"),
            (None, [0.0, -1.0], 1, "x")]
    for kind in ("float", "double"):
        out = embed_dedup.near_duplicates(spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int, node string")).collect()
        assert len(out) == len(rows)
        got = {r.id: (r.n_links, r.component_id, r.kept) for r in out}
        assert got[1] == (1, 1, True) and got[2] == (1, 1, False) and got[3] == (0, 3, True)
        assert all(got[i] == (0, i, True) for i in (4, 5, 6, 7, 8, 9, 10, 13))
        assert got[11] == (2, 11, True) and got[12] == (2, 11, False) and got[None] == (0, None, False)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embed_dedup.near_duplicates(empty).collect() == []


def test_pages_with_odd_rows(spark):
    rows = [(1, "http://a.example/x", "<p>One</p>", "i"), (2, None, "<p>Two", None), (3, "http://a.example/y", None, ""), (4, "not a url", "", "h"),
            (5, "HTTP://A.example", "<div>" * 3000 + "deep" + "</div>" * 3000, "x"), (5, "HTTP://A.example", "<!-- never closed", "x"), (None, "", "plain", "x")]
    out = page_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, host string"))
    got = sorted((r.id or 0, r.text, r.n_chars) for r in out.collect())
    assert got == [(0, "plain", 5), (1, "One", 3), (2, "Two", 3), (3, "", 0), (4, "", 0), (5, "", 0), (5, "deep", 4)]
    assert page_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
