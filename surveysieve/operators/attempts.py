"""Number of attempts from the same IP network (first three octets)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveysieve.functions.columns import all_of, col_
from surveysieve.operators.skew import HOT_ROWS, join_per_key

ATTEMPT_TYPES = ("successful", "unsuccessful", "incomplete", "failed", "all")
NEED_TERMINATE = ("incomplete", "failed")


def network(ip: Column) -> Column:
    return F.substring_index(ip, ".", 3)


def _counted(attempt_type: str, success: Column, terminate: Column | None) -> Column:
    if attempt_type == "successful":
        return success.isNotNull()
    if attempt_type == "unsuccessful":
        return success.isNull()
    if attempt_type == "all":
        return F.lit(True)
    if attempt_type not in ATTEMPT_TYPES:
        raise ValueError(f"attempt_type must be one of {ATTEMPT_TYPES}, not '{attempt_type}'")
    if terminate is None:
        raise ValueError(f"attempt_type '{attempt_type}' needs column_terminate")
    return success.isNull() & (terminate.isNull() if attempt_type == "incomplete" else terminate.isNotNull())


def attempt_counts(
    df: DataFrame,
    key: str,
    column_ip: str,
    column_success: str,
    attempt_types: Sequence[str] = ("successful",),
    column_terminate: str | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """(key, one count per type): such attempts in the network of the response.

    The counts are aggregated per network first, all types at once; only the
    narrow pair of key and network is joined with them, and busy networks are
    spread over many tasks.
    """
    success = col_(column_success)
    terminate = col_(column_terminate) if column_terminate is not None else None
    counted = {t: _counted(t, success, terminate) for t in attempt_types}
    rows = df.select(
        col_(key).alias(key),
        network(col_(column_ip)).alias("__net"),
        *[condition.alias(t) for t, condition in counted.items()],
    ).where(F.col("__net").isNotNull())
    per_network = rows.groupBy("__net").agg(
        F.count("*").alias("__rows"), *[F.count_if(t).cast("long").alias(t) for t in counted]
    )
    # Always true; it asks for all counts, so that the plan aggregates once for both uses.
    sizes = per_network.where(all_of(F.col(t) <= F.col("__rows") for t in counted))
    found = join_per_key(
        rows.select(key, "__net"), per_network, ["__net"], "__rows", F.col(key), hot_rows, sizes=sizes
    )
    return found.select(key, *counted)
