"""Answers that repeat the text of another answer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveysieve.functions.columns import any_of, col_, is_bound
from surveysieve.functions.text import normalise, text_key
from surveysieve.operators.skew import HOT_ROWS, join_per_key

STRATEGIES = ("column", "all")


def duplicated_text(
    df: DataFrame,
    key: str,
    list_of_columns: Sequence[str],
    min_length: float,
    max_length: float,
    search_strategy: str = "column",
    names: Sequence[str] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Keys of the responses with duplicated text, and per column whether it is one.

    'column' counts a text within its column, 'all' over all columns together
    (twice in one response counts). Only keys with a duplicate are returned;
    the Boolean columns are called ``names``. Texts are cut to their length
    range first and travel as keys of at most 64 bytes.
    """
    if search_strategy not in STRATEGIES:
        raise ValueError(f"search_strategy must be one of {STRATEGIES}, not '{search_strategy}'")
    names = list(names or [f"dup_{i}" for i in range(len(list_of_columns))])
    cells = df.select(
        col_(key).alias(key),
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(i).alias("__column"), normalise(col_(c)).alias("__text"))
                    for i, c in enumerate(list_of_columns)
                ]
            )
        ),
    )
    length = F.length("__text")
    kept = cells.where(F.col("__text").isNotNull())
    if is_bound(min_length, float("-inf")):
        kept = kept.where(length >= F.lit(min_length))
    if is_bound(max_length, float("inf")):
        kept = kept.where(length <= F.lit(max_length))
    # With the strategy 'all' every cell counts in one common scope.
    scope = F.col("__column") if search_strategy == "column" else F.lit(0)
    kept = kept.select(key, "__column", scope.alias("__scope"), text_key(F.col("__text")).alias("__text"))
    repeated = kept.groupBy("__scope", "__text").agg(F.count("*").alias("__rows")).where("__rows > 1")
    hits = join_per_key(
        kept, repeated, ["__scope", "__text"], "__rows", F.struct(key, "__column"), hot_rows
    )
    return hits.groupBy(key).agg(*[F.max(F.col("__column") == i).alias(n) for i, n in enumerate(names)])


def any_duplicate(names: Sequence[str]):
    return any_of(F.coalesce(col_(n), F.lit(False)) for n in names)
