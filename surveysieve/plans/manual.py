"""Labels a person adds after the automated classification."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveysieve.functions.columns import col_

MANUAL_COLUMNS = ("MANUAL_FLAG", "MANUAL_COMMENT")


def add_placeholders(df: DataFrame) -> DataFrame:
    """Empty columns for the manual label and comment, unless they are there."""
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in MANUAL_COLUMNS if c not in df.columns])


def merge_labels(df: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Labels and comments from a table by response key; others keep what they have.

    Rows that repeat the same label and comment of a key count once. Different
    ones are refused with an error that names some keys, as is a label without
    a key, so responses never multiply and no label is lost.
    """
    entered = F.struct(*[col_(c).cast("string").alias(c) for c in MANUAL_COLUMNS])
    given = labels.groupBy(col_(key)).agg(F.min(entered).alias("__given"), F.max(entered).alias("__other"))
    refused = given.where(~F.col("__given").eqNullSafe(F.col("__other")) | col_(key).isNull()).select(col_(key)).take(5)
    if refused:
        raise ValueError(f"several manual labels for a response, or none named: {[row[0] for row in refused]}")
    given, placed = given.drop("__other"), add_placeholders(df)
    merged = placed.join(given, key, "left")
    return merged.select(
        *[
            F.coalesce(F.col("__given")[c], col_(c)).alias(c) if c in MANUAL_COLUMNS else col_(c)
            for c in placed.columns
        ]
    )
