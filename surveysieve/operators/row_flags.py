"""Checks that need one response only: each is a Boolean column, never NULL."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from surveysieve.functions.columns import any_of, col_, flag, is_bound
from surveysieve.functions.text import words

NON_BREAKING_SPACE = "\xa0"


def value_in_range(column_name: str, lower_threshold: float, upper_threshold: float) -> Column:
    """Value between the thresholds, both included; infinite ones do not bind."""
    value = col_(column_name)
    inside = value.isNotNull()
    if is_bound(lower_threshold, float("-inf")):
        inside = inside & (value >= F.lit(lower_threshold))
    if is_bound(upper_threshold, float("inf")):
        inside = inside & (value <= F.lit(upper_threshold))
    return flag(inside)


def custom_condition(condition: str) -> Column:
    """Any Spark SQL condition over the columns; unknown counts as not flagged."""
    return flag(F.expr(condition))


def reverse_coded(
    positive_columns: Sequence[str],
    negative_columns: Sequence[str],
    min_score: float,
    max_score: float,
    max_correlation: float = 0,
) -> Column:
    """Same attitude towards items and their reversals.

    Scores within [min_score, max_score] are rescaled to [-1, 1], others are left
    out. Flagged if mean(positive) * mean(negative) >= max_correlation.
    """
    if max_score == min_score:
        raise ValueError("min_score and max_score must differ")

    def rescaled(name: str) -> Column:
        score = col_(name).cast("double")
        unit = (F.lit(2.0) * (score - F.lit(float(min_score)))) / F.lit(float(max_score) - float(min_score)) - 1.0
        return F.when(score.between(float(min_score), float(max_score)), unit)

    def mean(names: Sequence[str]) -> Column:
        scores = [rescaled(n) for n in names]
        total = reduce(lambda a, b: a + b, [F.coalesce(s, F.lit(0.0)) for s in scores])
        known = reduce(lambda a, b: a + b, [s.isNotNull().cast("int") for s in scores])
        return total / F.nullif(known, F.lit(0))

    return flag(mean(positive_columns) * mean(negative_columns) >= F.lit(float(max_correlation)))


def suspicious_character(
    available: Sequence[str],
    list_of_columns: Sequence[str],
    list_of_chars: Sequence[str] = (NON_BREAKING_SPACE,),
) -> Column:
    """Any of the given substrings in any of the text columns that exist."""
    skipped = [c for c in list_of_columns if c not in available]
    if skipped:
        warnings.warn(f"columns not found and not searched: {skipped}", stacklevel=2)
    return any_of(
        F.coalesce(col_(c).cast("string"), F.lit("")).contains(ch)
        for c in list_of_columns
        if c in available
        for ch in list_of_chars
    )


def suspicious_name(column_first_name: str, column_last_name: str, min_word_length: int = 2) -> Column:
    """First and last name share a word, ignoring case and initials."""
    return flag(
        F.arrays_overlap(words(col_(column_first_name), min_word_length), words(col_(column_last_name), min_word_length))
    )


def outside_region(location: Column, target: str, flag_missing: bool) -> Column:
    """Location other than the target; a missing one is flagged on request."""
    return F.when(location.isNull(), F.lit(bool(flag_missing))).otherwise(location != F.lit(target))
