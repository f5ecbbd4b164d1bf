"""Small helpers over Spark columns."""

from __future__ import annotations

import math
from collections.abc import Iterable
from functools import reduce

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col_(name: str) -> Column:
    """Column by its exact name; survey names hold dots, spaces and brackets."""
    return F.col("`" + name.replace("`", "``") + "`")


def flag(condition: Column) -> Column:
    """A condition as a flag: unknown counts as not flagged."""
    return F.coalesce(condition, F.lit(False))


def truth(df: DataFrame, expression: str, what: str) -> Column:
    """A Spark SQL expression as a condition: numbers hold if not zero, texts if not empty; unknown does not hold."""
    try:
        column = F.expr(str(expression))
        kind = df.select(column).schema[0].dataType
    except (AnalysisException, ParseException) as error:
        raise ValueError(f"{what}: cannot use the condition {expression!r}") from error
    if isinstance(kind, T.NumericType):
        column = column != 0
    elif isinstance(kind, T.StringType):
        column = column != ""
    return flag(column)


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def require_columns(df: DataFrame, names: Iterable[str], what: str) -> None:
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise ValueError(f"{what}: missing column(s) {absent}")


def nan_to_null(df: DataFrame) -> DataFrame:
    """Floats with NaN turned to NULL, so that missing values have one spelling."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    if not floats:
        return df
    return df.select(
        *[
            F.when(F.isnan(col_(c)), F.lit(None)).otherwise(col_(c)).alias(c) if c in floats else col_(c)
            for c in df.columns
        ]
    )


def naive_micros(stamp: Column) -> Column:
    """Microseconds since 1970 of a wall-clock timestamp, whatever the session zone."""
    days = F.date_diff(F.to_date(stamp), F.lit("1970-01-01").cast("date")).cast("long")
    minutes = F.hour(stamp) * 60 + F.minute(stamp)
    seconds = F.extract(F.lit("SECOND"), stamp)
    return days * 86_400_000_000 + minutes.cast("long") * 60_000_000 + (seconds * 1_000_000).cast("long")


def is_bound(value: float | None, infinite: float) -> bool:
    """False when a threshold is the infinity that excludes nothing."""
    return not (isinstance(value, float) and math.isinf(value) and value == infinite)
