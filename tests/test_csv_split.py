"""CSV with line breaks in fields, read over byte ranges, equals a reading in one piece."""

import csv
import io
import random

import pytest

from civicscan.sources import csv_split, csvio

SCHEMA = "id long, v string, w string"


@pytest.fixture
def small_ranges(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda size: [spark.conf.set(k, size) for k in old]
    for k, v in old.items():
        spark.conf.set(k, v)


def _inside(text: str) -> bool:
    """A character-wise automaton of quoted fields: is one open at the end?"""
    state = "begin"
    for c in text:
        if state in ("begin", "plain") and c in ",\n":
            state = "begin"
        elif state == "begin":
            state = "open" if c == '"' else "plain"
        elif state == "open":
            state = "quote" if c == '"' else "open"
        elif state == "quote":
            state = "open" if c == '"' else "begin" if c in ",\n" else "plain"
    return state == "open"


def test_line_rule_equals_an_automaton():
    rng = random.Random(5)
    for _ in range(20000):
        line = "".join(rng.choices('",ab', k=rng.randrange(12)))
        assert csv_split.ends_inside(line, False) == _inside(line), line
        assert csv_split.ends_inside(line, True) == _inside('"' + line), line


def _text(rng: random.Random) -> str:
    return "".join(rng.choices(["a", "bc", '"', ",", "\n", "\n\n", " ", "é", "\\", 'x"y', "end\r\nnext"], k=rng.randrange(9)))


@pytest.mark.parametrize("eol", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [300, 2500, 20000])
def test_ranges_equal_one_reading(spark, tmp_path, small_ranges, size, eol):
    rng = random.Random(size)
    rows = [(i, _text(rng), _text(rng)) for i in range(400)]
    rows[7] = (7, "long\n" * 200, "x" * 300)       # a record over many ranges
    for part in range(2):
        out = io.StringIO()
        writer = csv.writer(out, lineterminator=eol)
        writer.writerow(["id", "two\nlines", "w"])
        writer.writerows(rows[part::2])
        (tmp_path / f"part{part}.csv").write_bytes(out.getvalue().encode())
    small_ranges(str(size))
    text, _ = csv_split.lines(spark, str(tmp_path))
    assert text.rdd.getNumPartitions() > 2 or size == 20000
    got = csvio.read_csv(spark, str(tmp_path), SCHEMA, multi_line=True).collect()
    assert sorted((r.id, r.v or "", r.w or "") for r in got) == rows
    if eol == "\n":     # Spark guesses a file's line end from the first break, here one in a field
        single = (spark.read.schema(SCHEMA).option("header", True).option("multiLine", True).options(**csvio.READ_OPTIONS)
                  .csv(str(tmp_path)))
        assert sorted(map(str, got)) == sorted(map(str, single.collect()))


def test_odd_files_equal_one_reading(spark, tmp_path, small_ranges):
    odd = {"stray": 'id,v,w\n1,a"b,c"\n2,"x"y"z,w\n\n3,"q"" \n,""r",\n4\n5,a,b,c\nx,"1\n2",""\n',
           "header_only": "id,v,w\n", "empty": "", "blank_first": "\n\nid,v,w\n1,a,\n", "no_end": 'id,v,w\n1,"a\nb",c'}
    small_ranges("16")
    for name, text in odd.items():
        folder = tmp_path / name
        folder.mkdir()
        (folder / "f.csv").write_bytes(text.encode())
        got = csvio.read_csv(spark, str(folder), SCHEMA, multi_line=True).collect()
        single = spark.read.schema(SCHEMA).option("header", True).option("multiLine", True).options(**csvio.READ_OPTIONS).csv(str(folder))
        assert sorted(map(str, got)) == sorted(map(str, single.collect())), name


def test_spaces_survive_the_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "  two ", "\tx\n ")], SCHEMA)
    csvio.write_csv(df, str(tmp_path / "out"))
    assert csvio.read_csv(spark, str(tmp_path / "out"), SCHEMA, multi_line=True).collect() == df.collect()
