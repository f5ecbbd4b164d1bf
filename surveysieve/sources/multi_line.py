"""CSV with line breaks inside quotes, read by many tasks.

A file is cut into splits wherever Spark cuts it. A line break ends a record
if an even number of quotes lies ahead of it in the file, so one pass counts
the quotes of each split, and their sums over the splits before say whether a split
begins inside quotes. With that each task puts the lines of its splits together to
records; only what crosses the end of a split (a piece of the last record, and the
pieces of it that follow) is brought together. Spark's own CSV parser reads the records.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from surveysieve.operators.skew import is_small
from surveysieve.sources.sinks import CSV_OPTIONS, stage_table

_SPLIT = ["__file", "__start"]
_PIECES = "__file string, __start long, __position long, record string, first boolean, open boolean"
# Records that are handed on at once.
_ROWS = 4_096


def read_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of all CSV files of ``path``, which have a header, with the place of each: __file, __start, __position.

    The same rows as Spark's ``multiLine``, but a file is read by as many tasks as it
    has splits. Lines end with a line feed, or with a carriage return ahead of it. A quote may
    only stand at the ends of a value, or doubled within; anything else that would leave
    open where a record ends is refused, as is any value that does not fit its type.
    """
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__start"), "value"
    )
    records = _whole(_cut(lines, _beginnings(lines)))
    options = {name: str(value).lower() if isinstance(value, bool) else value for name, value in CSV_OPTIONS.items()}
    parsed = F.from_csv("record", schema, {**options, "mode": "FAILFAST", "multiLine": "true"})
    return records.select(*_SPLIT, "__position", parsed.alias("row")).select("row.*", *_SPLIT, "__position")


def _beginnings(lines: DataFrame) -> DataFrame:
    """(split, inside, header) of each split: whether it begins inside quotes, and whether with the file's header."""
    value = F.col("value")
    quotes = F.length(value) - F.length(F.replace(value, F.lit('"')))
    filled = F.max(F.regexp_replace(value, "\r$", "") != "")
    splits = lines.groupBy(*_SPLIT).agg(F.sum(quotes).alias("quotes"), filled.alias("filled"))
    # One row per split of the input, far fewer than lines.
    splits = stage_table(splits, "csv-splits")
    odd = splits.groupBy("__file").agg(F.sum("quotes").alias("quotes")).where("quotes % 2 = 1")
    if not odd.isEmpty():
        raise ValueError(f"a quote is not closed in {odd.head()['__file']}")
    before = Window.partitionBy("__file").orderBy("__start").rowsBetween(Window.unboundedPreceding, -1)
    return splits.select(
        *_SPLIT,
        (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("inside"),
        (F.col("filled") & ~F.coalesce(F.max("filled").over(before), F.lit(False))).alias("header"),
    )


def _cut(lines: DataFrame, beginnings: DataFrame) -> DataFrame:
    """Records and pieces of records, without headers, in their order in each split.

    ``first`` says that a piece has the beginning of its record, ``open`` that its end is in a later split.
    """
    # A broadcast join keeps the order of the lines; beyond its size, they are sorted again by their places.
    if is_small(beginnings):
        known = lines.join(F.broadcast(beginnings), _SPLIT)
    else:
        numbered = lines.withColumn("line", F.monotonically_increasing_id()).join(beginnings, _SPLIT)
        known = numbered.sortWithinPartitions(*_SPLIT, "line").drop("line")
    return known.select(*_SPLIT, "value", "inside", "header").mapInArrow(_pieces, _PIECES)


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    split, position, inside, first, header, held, rows = None, 0, False, True, False, [], []

    def close(is_open: bool) -> None:
        nonlocal position, header
        if header and is_open:
            raise ValueError(f"the header of {split[0]} is longer than a split of the file")
        if not header:
            rows.append((*split, position, "\n".join(held), first, is_open))
            position += 1
        header = False

    for batch in batches:
        for file, start, line, begins_inside, has_header in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (file, start) != split:
                if held:
                    close(True)
                split, position, inside, header, held = (file, start), 0, begins_inside, has_header, []
                first = not inside
            # Blank lines between records are none.
            if not inside and line in ("", "\r"):
                continue
            held.append(line)
            inside ^= line.count('"') % 2 == 1
            if not inside:
                close(False)
                held, first = [], True
        if len(rows) >= _ROWS:
            yield _batch(rows)
            rows = []
    if held:
        close(True)
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_()]
    names = [*_SPLIT, "__position", "record", "first", "open"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _whole(pieces: DataFrame) -> DataFrame:
    """The records of all files, numbered within the splits where they begin."""
    pieces = stage_table(pieces, "csv-records")
    complete = pieces.where("first AND NOT open")
    # At most two pieces per split: what it begins with, and what it leaves open.
    in_file = Window.partitionBy("__file").orderBy(*_SPLIT, "__position")
    parts = pieces.where("NOT first OR open").withColumn("record_number", F.sum(F.col("first").cast("int")).over(in_file))
    at = F.struct("__start", "__position")
    joined = parts.groupBy("__file", "record_number").agg(
        F.min(at).alias("at"),
        F.array_sort(F.collect_list(F.struct(at.alias("at"), "record"))).alias("parts"),
    )
    crossing = joined.select(
        "__file", "at.__start", "at.__position", F.array_join(F.col("parts.record"), "\n").alias("record")
    )
    records = complete.select(*_SPLIT, "__position", "record").unionByName(crossing)
    record = F.regexp_replace("record", "\r$", "")
    refused = F.raise_error(F.concat(F.lit("a quote stands inside a value without quotes in "), "__file")).cast("string")
    return records.select(*_SPLIT, "__position", F.when(_ambiguous(record), refused).otherwise(record).alias("record"))


def _ambiguous(record):
    """Whether a record of several lines has a quote that neither begins nor ends a value."""
    single = F.replace(record, F.lit('""'), F.lit(""))
    return record.contains("\n") & (single.rlike('[^,]"[^,]') | single.rlike('^[^"]*[^",]"'))
