"""Reading survey responses and giving them a key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from surveysieve.functions.columns import nan_to_null
from surveysieve.operators.skew import is_small
from surveysieve.sources.multi_line import read_records
from surveysieve.sources.sinks import CSV_OPTIONS, stage_table

KEY = "response_id"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str | None = None,
    key: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Responses from CSV with a header; quotes are doubled, blanks are missing.

    Give a ``schema`` for large data: without one Spark reads the files twice to
    infer it. ``multi_line`` allows line breaks in answers; with a schema, a file is
    then still read by many tasks (``multi_line.read_records``), without one by one task. Without
    ``multi_line`` a record that a line break cuts is refused, as is always
    any value that does not fit its type. Without a ``key`` column,
    ``response_id`` is added.
    """
    if multi_line and schema:
        records = read_records(spark, path, schema)
        if key is None and KEY not in records.columns:
            records = number_placed(stage_table(records, "csv"), KEY, "csv")
        return nan_to_null(records.drop("__file", "__start", "__position"))
    # All columns are parsed, whichever are used: a cut record has too few of them.
    reader = spark.read.options(**CSV_OPTIONS, multiLine=multi_line, mode="FAILFAST", columnPruning=False)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return _keyed(reader.csv(path), key, "csv")


def read_parquet(spark: SparkSession, path: str, key: str | None = None) -> DataFrame:
    return _keyed(spark.read.parquet(path), key, "parquet")


def _keyed(df: DataFrame, key: str | None, name: str) -> DataFrame:
    if key is None and KEY not in df.columns:
        df = number_rows(df, KEY, name)
    return nan_to_null(df)


def number_rows(df: DataFrame, name: str = KEY, stage: str = "rows") -> DataFrame:
    """Consecutive numbers from 0 in file order, for a DataFrame read from files.

    The files are read once, into a staged table that keeps the place of each row:
    its file, the split of it, and the row in the split. From that the rows of the
    splits before (files by name, splits by position) are counted, in a table with
    one row per split. The rows themselves are not shuffled.
    """
    placed = df.select(
        "*",
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__start"),
        F.monotonically_increasing_id().alias("__position"),
    )
    return number_placed(stage_table(placed, stage), name, stage)


def number_placed(placed: DataFrame, name: str, stage: str) -> DataFrame:
    """The same for a staged table whose rows have their places: __file, __start of the split, __position without gaps in it."""
    at = ["__file", "__start"]
    splits = placed.groupBy(*at).agg(F.min("__position").alias("__first"), F.count("*").alias("__rows"))
    # One row per split of the input, far fewer than responses.
    before = Window.orderBy(*at).rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage_table(
        splits.select(*at, (F.coalesce(F.sum("__rows").over(before), F.lit(0)) - F.col("__first")).alias("__offset")),
        f"{stage}-splits",
    )
    numbered = placed.join(F.broadcast(offsets) if is_small(offsets) else offsets, at)
    kept = ["`" + c.replace("`", "``") + "`" for c in placed.columns if c not in (*at, "__position")]
    return numbered.select(*kept, (F.col("__position") + F.col("__offset")).alias(name))


def review_schema(df: DataFrame) -> str:
    """Schema to read back a file that was written from ``df`` and edited by people."""
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema)
