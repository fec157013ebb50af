"""CSV files with line breaks inside quoted fields, read as many tasks.

A byte range of a file can't tell by itself whether it begins inside a quoted
field.  What a range does to that one bit can be told for either beginning, so
three scans do, and no text is shuffled but that of records which cross ranges:

1. each range reports how it ends, begun outside and begun inside a field;
2. these small rows, one per range, are chained in file order by a window,
   which settles how every range begins;
3. each range puts its own lines together to records.  Records that run from
   one range into another are gathered by the range they begin in.

A quote opens a field only as its first character; a doubled one inside is the
character itself; text between a closing quote and the next comma belongs to
the field.  These are the rules of Spark's own CSV parser, which then takes the
records apart.  Lines end with LF or CRLF; blank lines are no records.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, ship_package

#: The rest of a quoted field, up to the comma or line end behind it.
_CLOSED = re.compile(r'(?:[^"]++|"")*+"(?!")[^,]*+')
#: Records, and characters of them, handed to Spark at a time.
_BATCH_ROWS, _BATCH_CHARS = 4096, 1 << 22

RECORD, HEAD, TAIL = "record", "head", "tail"


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line begun inside (or outside) a quoted field ends inside one."""
    if inside:
        at = 0
    elif line.startswith('"'):
        at = 1
    else:
        at = line.find(',"') + 2
        if at == 1:
            return False
    while m := _CLOSED.match(line, at):
        at = line.find(',"', m.end()) + 2
        if at == 1:
            return False
    return True


def lines(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, list[str]]:
    """``_path, _block`` (byte range), ``_pos`` (order in a range), ``_value``
    per line, and the partition columns of the folders (as text) with their names."""
    text = spark.read.option("lineSep", "\n").text(path)
    folders = [c for c in text.columns if c != "value"]
    return text.select(F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block"),
                       F.monotonically_increasing_id().alias("_pos"), F.col("value").alias("_value"),
                       *[F.col(f"`{c}`").cast("string").alias(c) for c in folders]), folders


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bool, list[str]]]:
    """``(what the lines share, whether their range begins here, lines)`` in
    order.  Batches hold ``_value`` last; all columns before it are constant in a range."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        *shared, values = batch.columns
        change = np.zeros(batch.num_rows - 1, bool)
        for column in shared[:2]:  # path and block
            codes = column.dictionary_encode().indices.to_numpy()
            change |= codes[1:] != codes[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        values = values.to_pylist()
        for a, b in zip(cuts, cuts[1:]):
            key = tuple(column[a].as_py() for column in shared)
            yield key, key != last, values[a:b]
            last = key


def _transitions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[list] = []
    for (path, block), new, values in _ranges(batches):
        if new:
            rows.append([path, block, False, True, False])
        outside, inside, breaks = rows[-1][2:]
        for v in values:
            if '"' in v:
                outside, inside = ends_inside(v, outside), ends_inside(v, inside)
            breaks = breaks or not inside
        rows[-1][2:] = outside, inside, breaks
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(column) for column in zip(*rows)],
                                         names=["_path", "_block", "_from_outside", "_from_inside", "_breaks"])


def ranges(text: DataFrame) -> DataFrame:
    """How each byte range begins: ``_path, _block, _inside`` (a field is open),
    ``_open`` (its last record goes on in the next range) and ``_owner`` (the
    range where the record that is open at its beginning begins).

    One small row per range goes through the window: 8,000 for a file of 1 TB."""
    found = (text.select("_path", "_block", "_value")
             .mapInArrow(_transitions, "_path string, _block long, _from_outside boolean, _from_inside boolean, _breaks boolean"))
    found = materialize(found, "csv-ranges")
    order = Window.partitionBy("_path").orderBy("_block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # a range sets the bit, keeps it or turns it: the last one that sets it counts, and the turns since then
    turn = (F.col("_from_outside") & ~F.col("_from_inside")).cast("int")
    found = found.withColumn("_turns", F.sum(turn).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    sets = F.when(F.col("_from_outside") == F.col("_from_inside"),
                  F.struct(F.col("_from_outside").cast("int").alias("bit"), F.col("_turns").alias("turns")))
    found = (found.withColumn("_set", F.last(sets, ignorenulls=True).over(before))
             .withColumn("_before", F.lag("_turns", 1, 0).over(order)))
    zero = F.lit(0)
    bit = F.coalesce(F.col("_set.bit"), zero) + F.col("_before") - F.coalesce(F.col("_set.turns"), zero)
    found = found.withColumn("_inside", bit % 2 == 1)
    ends = F.when(F.col("_inside"), F.col("_from_inside") & F.col("_breaks")).otherwise(F.col("_from_outside"))
    found = found.withColumn("_open", ends)
    owner = F.last(F.when(F.col("_open"), F.col("_block")), ignorenulls=True).over(before)
    return found.select("_path", "_block", "_inside", "_open", F.when(F.col("_inside"), owner).alias("_owner"))


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, str, str, bool]]:
    """``(what the lines share, kind, text, whether it is the file's first record)``:
    whole records, the end of one that began earlier, the beginning of one that goes on."""
    key, held, inside, kind, first = None, [], False, RECORD, False
    for now, new, values in _ranges(batches):
        if new:
            if held:
                yield key, TAIL if kind == RECORD else HEAD, "\n".join(held), first
            key, held, inside = now, [], bool(now[2])
            kind, first = HEAD if inside else RECORD, now[1] == 0
        for v in values:
            if '"' in v:
                inside = ends_inside(v, inside)
            held.append(v)
            if inside:
                continue
            text, held = "\n".join(held), []
            if kind == HEAD:
                yield key, HEAD, text, False
            elif text := text.removesuffix("\r"):
                yield key, RECORD, text, first
                first = False
            kind = RECORD
    if held:
        yield key, TAIL if kind == RECORD else HEAD, "\n".join(held), first


def _written(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += len(row[0])
        if len(held) >= _BATCH_ROWS or chars >= _BATCH_CHARS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def records(spark: SparkSession, path: str | list[str], header: bool = True) -> DataFrame:
    """``_record`` (text without its line end) per record of all files, and the
    folders' partition columns.  ``header`` leaves out the first of each file.

    A field that is never closed takes the rest of its file, which is then one record."""
    ship_package(spark)
    text, folders = lines(spark, path)
    state = materialize(ranges(text), "csv-states")
    names = [f"`{c}`" for c in folders]
    text_fields = [pa.field(c, pa.string()) for c in folders]
    ddl = "".join(f", {c} string" for c in names)

    # few ranges begin inside a field; the planner broadcasts them if they are small.  The sort
    # makes the order of lines safe from any other join, which moves a range's lines together.
    begun = text.join(state.filter("_inside").select("_path", "_block", "_inside"), ["_path", "_block"], "left")
    begun = begun.sortWithinPartitions("_path", "_block", "_pos").select("_path", "_block", "_inside", *names, "_value")
    record_schema = pa.schema([pa.field("_record", pa.string()), *text_fields])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _written(((t, *key[3:]) for key, kind, t, first in _assembled(batches)
                         if kind == RECORD and not (header and first)), record_schema)

    out = begun.mapInArrow(whole, "_record string" + ddl)
    crossing = state.filter("_inside or _open")
    if crossing.isEmpty():
        return out

    part_schema = pa.schema([pa.field("_part", pa.string()), pa.field("_path", pa.string()), pa.field("_block", pa.int64()),
                             pa.field("_begun", pa.int64()), pa.field("_first", pa.bool_()), *text_fields])

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _written(((t, key[0], key[1], key[1] if kind == TAIL else key[3], first, *key[4:])
                         for key, kind, t, first in _assembled(batches) if kind != RECORD), part_schema)

    some = text.join(crossing.drop("_open"), ["_path", "_block"]).sortWithinPartitions("_path", "_block", "_pos")
    some = (some.select("_path", "_block", "_inside", "_owner", *names, "_value")
            .mapInArrow(parts, "_part string, _path string, _block long, _begun long, _first boolean" + ddl))
    pieces = F.sort_array(F.collect_list(F.struct("_block", "_part")))
    joined = some.groupBy("_path", "_begun", *names).agg(
        F.regexp_replace(F.array_join(F.transform(pieces, lambda p: p["_part"]), "\n"), r"\r\z", "").alias("_record"),
        F.max("_first").alias("_first"))
    if header:
        joined = joined.filter(~F.col("_first"))
    return out.unionByName(joined.filter("_record <> ''").select("_record", *names))


def read(spark: SparkSession, path: str | list[str], schema: T.StructType | str, options: dict[str, str],
         header: bool = True) -> DataFrame:
    """The files' records as columns of ``schema``, in its order; a column that
    names a folder level (``year=2020``) is read from there."""
    fields = (schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)).fields
    found = records(spark, path, header)
    folders = {c.lower(): c for c in found.columns if c != "_record"}
    inside = T.StructType([f for f in fields if f.name.lower() not in folders])
    parsed = found.withColumn("_record", F.from_csv("_record", inside.toDDL(), options))
    columns = [F.col(f"`{folders[f.name.lower()]}`").cast(f.dataType).alias(f.name) if f.name.lower() in folders
               else F.col(f"_record.`{f.name}`").alias(f.name) for f in fields]
    asked = {f.name.lower() for f in fields}
    return parsed.select(*columns, *[F.col(f"`{c}`") for low, c in folders.items() if low not in asked])
