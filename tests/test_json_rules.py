"""How model responses are read: Python's JSON rule, and the lenient scanner."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from civicscan.functions import jsonx
from civicscan.operators import responses as R

values = st.recursive(st.none() | st.booleans() | st.integers(-10**9, 10**9) | st.floats(allow_nan=False, allow_infinity=False)
                      | st.text(alphabet="ab,]}[{:'\"\\/\n\t* é🙂0x", max_size=8),
                      lambda v: st.lists(v, max_size=4) | st.dictionaries(st.text(alphabet="abc_$1 '", max_size=5), v, max_size=4), max_leaves=12)


def spelt(draw, value):
    """``value`` as a person might write it: one of many spellings."""
    pick = draw.draw
    gap = lambda: pick(st.sampled_from(["", " ", "\n", "/* ,]} */", "// it's {\n"]))
    if isinstance(value, str):
        quote = pick(st.sampled_from("\"'"))
        out = ""
        for c in value:
            if c == quote or c == "\\":
                out += "\\" + c
            elif c in "\n ":
                out += {"\n": "\\n", " ": pick(st.sampled_from(["\\u2028", " "]))}[c]
            elif c == "a":
                out += pick(st.sampled_from(["a", "\\x61", "\\u0061", "\\a", "\\\na"]))
            else:
                out += c
        return quote + out + quote
    if isinstance(value, bool) or value is None:
        return json.dumps(value)
    if isinstance(value, int):
        return pick(st.sampled_from([str(value), f"{value:+d}", f"{'-' if value < 0 else ''}0x{abs(value):X}"]))
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, list):
        tail = pick(st.sampled_from(["", ","])) if value else ""
        return "[" + ",".join(gap() + spelt(draw, v) + gap() for v in value) + tail + gap() + "]"
    tail = pick(st.sampled_from(["", ","])) if value else ""
    keys = [k if k.isidentifier() and k.isascii() and pick(st.booleans()) else spelt(draw, k) for k in value]
    return "{" + ",".join(gap() + k + gap() + ":" + gap() + spelt(draw, v) + gap() for k, v in zip(keys, value.values())) + tail + "}"


@settings(max_examples=1500, deadline=None)
@given(values, st.data())
def test_lenient_reader_gives_the_value_that_was_spelt(value, data):
    assert jsonx.read_lenient(spelt(data, value)) == value


@settings(max_examples=500, deadline=None)
@given(values)
def test_strict_texts_are_read_as_they_are(value):
    text = json.dumps(value)
    assert jsonx.read_lenient(text) == jsonx.read_strict(text) == value


@pytest.mark.parametrize("text", ["", "{", "[,]", "{,}", "[1,,2]", "[1,,]", "{a:}", "{a:,}", "'x", "\"x", "{a b:1}", "[nope]", "[1 2]", "/* x", "{a:1}}", "01", "[" * 100_000, "@"])
def test_what_is_no_json_is_refused(text):
    with pytest.raises(ValueError):
        jsonx.read_lenient(text)


def test_numbers_beyond_strict_json():
    assert jsonx.read_lenient("[.5, 5., +1, -.5e1, 0x1F, Infinity, -Infinity, 5.e2]") == [0.5, 5.0, 1, -5.0, 31, float("inf"), float("-inf"), 500.0]
    assert str(jsonx.read_lenient("NaN")) == str(jsonx.read_strict("NaN")) == "nan"


PROBES = {
    1: ('{"advisories":[],"advisories":[{"type":"D"}]}', "D", "D"),  # the last of a repeated key
    2: ('{"x":NaN,"advisories":[{"type":"N"}]}', "N", "N"),
    3: ('{"x":-Infinity,"advisories":[{"type":"I","type":"J"}]}', "J", "J"),
    4: ('{"advisories":[{"type":"x, ]y"}]}', "x, ]y", "x, ]y"),  # text stays text
    5: ('{"advisories":[{"type":"a,}b",}]}', None, "a,}b"),
    6: ("{advisories:[{type:'it\\'s', n:+1, h:0xFF}]} // end }", None, "it's"),
    7: ('{"advisories":[{"type":"line\nbreak"}]}', None, "line\nbreak"),
}


def test_response_probes(spark):
    df = spark.createDataFrame([(i, f"Sure: {t}") for i, (t, _, _) in PROBES.items()], "doc_id long, response string")
    strict = {r.doc_id: r.type for r in R.advisories(df).collect()}
    assert strict == {i: s for i, (_, s, _) in PROBES.items() if s is not None}
    assert {r.doc_id: r.reason for r in R.advisories_rejected(df).collect()} == {i: "invalid_json" for i, (_, s, _) in PROBES.items() if s is None}
    assert {r.doc_id: r.type for r in R.advisories(df, lenient=True).collect()} == {i: v for i, (_, _, v) in PROBES.items()}
    assert R.advisories_rejected(df, lenient=True).collect() == []


def test_field_values_of_every_kind():
    item = {"type": 5, "location": ["a", None, 1.5, True, ["x"]], "start_date": None, "end_date": {"a": 1}, "publish_date": False}
    got = R.read_advisories(json.dumps({"advisories": [item, "none", None]}))
    assert got["reason"] is None and [i["is_object"] for i in got["items"]] == [True, False, False]
    assert [got["items"][0][f] for f in R.ADVISORY_FIELDS] == ["5", 'a, 1.5, true, ["x"]', None, '{"a":1}', "false"]
    assert [R.read_advisories(t)["reason"] for t in ("", None, "[1]", '{"advisories":{}}', "{x}")] == \
        ["no_json", "invalid_json", "no_advisories", "no_advisories", "invalid_json"]
