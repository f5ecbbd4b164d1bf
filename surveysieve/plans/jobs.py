"""The steps a user runs, from responses to reports."""

from __future__ import annotations

import warnings
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveysieve.config import Config
from surveysieve.functions.columns import col_, require_columns
from surveysieve.operators import descriptives
from surveysieve.operators.similarity import similar_answers
from surveysieve.plans.flagging import flag_responses
from surveysieve.plans.manual import add_placeholders, merge_labels
from surveysieve.plans.rules import classify

AUTOMATED, MANUAL, FINAL = "AUTOMATED_FLAG", "MANUAL_FLAG", "FINAL_FLAG"


def initial_classification(
    df: DataFrame, config: Config, key: str, lookups: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Flags, groups, automated class with its rule, and columns for the manual label."""
    flagged = flag_responses(df, config, key, lookups)
    return add_placeholders(classify(flagged, config.initial_rules, AUTOMATED, f"{AUTOMATED}_RULE"))


def final_classification(
    df: DataFrame, config: Config, key: str | None = None, labels: DataFrame | None = None
) -> DataFrame:
    """Final class from the automated and the manual one; ``labels`` are merged by key first."""
    if labels is not None:
        df = merge_labels(df, labels, key)
    require_columns(df, [AUTOMATED, MANUAL], "final classification")
    return classify(df, config.final_rules, FINAL, f"{FINAL}_RULE")


def warn_without_labels(df: DataFrame) -> None:
    """One cheap look whether anybody entered a manual label."""
    if df.where(col_(MANUAL).isNotNull()).isEmpty():
        warnings.warn("no response has a manual label", stacklevel=2)


def initial_reports(df: DataFrame, config: Config) -> dict[str, DataFrame]:
    """Report tables after the automated classification."""
    table = descriptives.patterns(df, config, [AUTOMATED])
    return {
        "02_filters": descriptives.flag_group_crosstab(table, config),
        "02_any_flag": descriptives.any_flag_count(table, config),
        "02_flags": descriptives.flag_counts(table, config),
        "02_groups": descriptives.group_totals(table, config),
        "02_AUTOMATED_FLAG": descriptives.classification_counts(table, AUTOMATED, F.col("n")),
        "02_cooccurrence_flags": descriptives.cooccurrence(table, config, [AUTOMATED]),
        "02_cooccurrence_groups": descriptives.cooccurrence(table, config, [AUTOMATED], use_groups=True),
    }


def final_reports(df: DataFrame, config: Config) -> dict[str, DataFrame]:
    """Report tables after the final classification."""
    classes = [AUTOMATED, MANUAL, FINAL]
    table = descriptives.patterns(df, config, classes)
    counts = {f"05_{c}": descriptives.classification_counts(table, c, F.col("n")) for c in classes}
    return {
        **counts,
        "05_cooccurrence_flags": descriptives.cooccurrence(table, config, classes),
        "05_cooccurrence_groups": descriptives.cooccurrence(table, config, classes, use_groups=True),
    }


def as_one_table(reports: Mapping[str, DataFrame]) -> DataFrame:
    """Reports below each other as (report, row_label, column_label, n)."""
    parts = []
    for name, report in reports.items():
        if report.columns == ["label_a", "label_b", "n"]:
            part = report.toDF("row_label", "column_label", "n")
        else:
            first, *rest = report.columns
            if dict(report.dtypes)[first] != "string":
                first, rest = None, report.columns
            row = F.lit("all") if first is None else col_(first)
            part = report.select(
                row.alias("row_label"),
                F.inline(
                    F.array(
                        *[F.struct(F.lit(c).alias("column_label"), col_(c).cast("long").alias("n")) for c in rest]
                    )
                ),
            )
        parts.append(part.select(F.lit(name).alias("report"), "row_label", "column_label", "n"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def mark_similar(df: DataFrame, config: Config, key: str) -> DataFrame:
    """Number and list of similar responses for every configured text column."""
    marked = df
    for fuzzy in config.fuzzy:
        require_columns(df, [fuzzy.column], "similar responses")
        count, listed = f"FZ_COUNT_{fuzzy.column}", f"FZ_SIMILAR_{fuzzy.column}"
        found = similar_answers(
            df, key, fuzzy.column, fuzzy.minimum_length, fuzzy.fuzzy_algorithm, fuzzy.threshold,
            count_name=count, list_name=listed,
        )
        kept = [col_(c) for c in marked.columns if c not in (count, listed)]
        marked = marked.select(*kept).join(found, key, "left").select(
            *kept, F.coalesce(col_(count), F.lit(0).cast("long")).alias(count), F.nullif(col_(listed), F.lit("")).alias(listed)
        )
    return marked
