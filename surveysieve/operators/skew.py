"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
LOOKUP_LANES = 256
SMALL_ROWS = 200_000


def join_per_key(
    rows: DataFrame,
    per_key: DataFrame,
    on: Sequence[str],
    weight: str,
    spread_by: Column,
    hot_rows: int = HOT_ROWS,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Inner join of ``rows`` with a table that has one row per key.

    ``weight`` counts the rows behind each key, in ``per_key`` or in a cheaper
    table ``sizes``. Keys of ``hot_rows`` rows and more are spread over a lane for
    each ``hot_rows`` of them: their ``rows`` by a hash of ``spread_by``, their
    ``per_key`` row by copying it. So no lane grows with the data. Only the hot keys
    and their numbers of lanes are broadcast, never payload; there is at most one
    for every ``hot_rows`` rows.
    """
    heavy = F.col(weight) >= hot_rows
    needed = F.ceil(F.col(weight) / hot_rows).cast("int")
    hot = (per_key if sizes is None else sizes).where(heavy).select(*on, needed.alias("__lanes"))
    lanes = F.coalesce(F.col("__lanes"), F.lit(1))
    marked_rows = rows.join(F.broadcast(hot), list(on), "left")
    if weight in per_key.columns:
        marked_keys = per_key.withColumn("__lanes", F.when(heavy, needed))
    else:
        marked_keys = per_key.join(F.broadcast(hot), list(on), "left")
    spread_rows = marked_rows.withColumn("__lane", F.pmod(F.xxhash64(spread_by), lanes).cast("int")).drop("__lanes")
    spread_keys = marked_keys.withColumn("__lane", F.explode(F.sequence(F.lit(0), lanes - 1))).drop("__lanes")
    return spread_rows.join(spread_keys, [*on, "__lane"]).drop("__lane")


def join_lookup(
    rows: DataFrame, lookup: DataFrame, on: Sequence[str], spread_by: Column, small: bool, lanes: int = LOOKUP_LANES
) -> DataFrame:
    """Inner join with a lookup table: broadcast if ``small``, salted otherwise.

    ``small`` is the outcome of ``is_small`` on the lookup table. Beyond that
    size each lookup row is copied to ``lanes`` lanes, and ``rows`` are spread
    over them, so that a key shared by many rows is not joined in one task.
    """
    if small:
        return rows.join(F.broadcast(lookup), list(on))
    salted = rows.withColumn("__lane", F.pmod(F.xxhash64(spread_by), F.lit(lanes)).cast("int"))
    copied = lookup.withColumn("__lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    return salted.join(copied, [*on, "__lane"]).drop("__lane")


def is_small(df: DataFrame, rows: int = SMALL_ROWS) -> bool:
    """Whether a narrow table has at most ``rows`` rows; stops counting beyond."""
    return df.limit(rows + 1).count() <= rows


def task_partitions(spark: SparkSession, tasks: int) -> int:
    """Partitions for groups that are costly to compute but small: one each, within reason."""
    most = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return max(1, min(tasks, most))
