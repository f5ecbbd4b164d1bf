"""Counts, crosstabs and co-occurrence of flags, groups and classes.

Everything starts from one table of patterns: each combination of flags, groups
and classes that occurs, with its number of responses. It is aggregated before
any shuffle, and its size follows the configuration, not the responses. With so many
flags that nearly every response has a combination of its own, responses are
not combined, and each report adds up what its tasks have summed.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveysieve.config import DEFAULT_CLASS, Config
from surveysieve.functions.columns import any_of, col_, require_columns

# Prefixes of class labels in co-occurrence tables.
PREFIXES = {"AUTOMATED_FLAG": "(auto) ", "MANUAL_FLAG": "(manual) ", "FINAL_FLAG": "(final) "}
TOTAL = "Total"
# Flags and groups from which on responses are not combined to patterns.
MANY_COLUMNS = 24
# Pairs of labels that a task adds up before it hands them on.
_MOST_PAIRS = 1_000_000


def patterns(df: DataFrame, config: Config, class_columns: Sequence[str] = ()) -> DataFrame:
    """Each occurring combination of flags, group counts and classes, with its count ``n``; or each response with 1."""
    names = [c for c in [*config.flag_names, *config.group_names] if c in df.columns]
    require_columns(df, class_columns, "classification")
    if len(names) >= MANY_COLUMNS:
        return df.select(*[col_(c) for c in [*names, *class_columns]], F.lit(1).cast("long").alias("n"))
    return df.groupBy(*[col_(c) for c in [*names, *class_columns]]).agg(F.count("*").alias("n"))


def _long(sums: DataFrame, names: Sequence[str], name_column: str) -> DataFrame:
    """A row of sums as (name, Count) rows in the given order."""
    entries = F.array(
        *[F.struct(F.lit(c).alias(name_column), F.coalesce(col_(c), F.lit(0)).cast("long").alias("Count")) for c in names]
    )
    return sums.select(F.inline(entries))


def any_flag_count(table: DataFrame, config: Config) -> DataFrame:
    """Responses with any flag, and all responses."""
    flagged = any_of(col_(f) for f in config.flag_names)
    return table.agg(
        F.coalesce(F.sum(F.when(flagged, F.col("n"))), F.lit(0)).cast("long").alias("flagged"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("responses"),
    )


def flag_counts(table: DataFrame, config: Config) -> DataFrame:
    """(flag, Count) of the flagged responses."""
    sums = table.agg(*[F.sum(F.when(col_(f), F.col("n"))).alias(f) for f in config.flag_names])
    return _long(sums, config.flag_names, "flag")


def group_totals(table: DataFrame, config: Config) -> DataFrame:
    """(flag_group, Count) summing the group counts of all responses."""
    sums = table.agg(*[F.sum(col_(g) * F.col("n")).alias(g) for g in config.group_names])
    return _long(sums, config.group_names, "flag_group")


def flag_group_crosstab(table: DataFrame, config: Config) -> DataFrame:
    """Responses with the flag (rows) and an active group (columns), and totals.

    The total of the totals is missing. Rows come in configuration order.
    """
    groups = config.group_names
    rows = [(f, col_(f)) for f in config.flag_names] + [(TOTAL, F.lit(True))]
    exploded = table.select(
        "n",
        *[(col_(g) > 0).alias(f"__g{i}") for i, g in enumerate(groups)],
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(i).alias("__row"), F.lit(name).alias("flag"), active.alias("__active"))
                    for i, (name, active) in enumerate(rows)
                ]
            )
        ),
    )

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("long")

    active = F.col("__active")
    counted = exploded.groupBy("__row", "flag").agg(
        *[total(active & F.col(f"__g{i}")).alias(g) for i, g in enumerate(groups)],
        total(active).alias("__all"),
    )
    return counted.orderBy("__row").select(
        "flag", *[col_(g) for g in groups], F.when(F.col("flag") != TOTAL, F.col("__all")).alias(TOTAL)
    )


def classification_counts(df: DataFrame, class_column: str, weight: Column | None = None) -> DataFrame:
    """(label, Count), most frequent first; missing labels do not count."""
    count = F.count("*") if weight is None else F.sum(weight)
    return (
        df.where(col_(class_column).isNotNull())
        .groupBy(col_(class_column).alias("label"))
        .agg(count.cast("long").alias("Count"))
        .orderBy(F.desc("Count"), "label")
    )


def cooccurrence(
    table: DataFrame, config: Config, class_columns: Sequence[str], use_groups: bool = False
) -> DataFrame:
    """(label_a, label_b, n) of the labels that occur together; n of a label with itself is its total.

    Labels are flags or groups, then classes with their prefix. Each task adds up X'NX of its
    rows' 0-1 matrix X and their counts N, so what is shuffled are at most a task's
    pairs of labels, however many rows there are and however they combine.
    """
    require_columns(table, class_columns, "classification")
    names = [c for c in (config.group_names if use_groups else config.flag_names) if c in table.columns]
    active = [F.coalesce(col_(c) > 0 if use_groups else col_(c), F.lit(False)).alias(f"__a{i}") for i, c in enumerate(names)]
    classes = [
        F.concat(F.lit(PREFIXES.get(c, "")), col_(c).cast("string")).alias(f"__c{i}") for i, c in enumerate(class_columns)
    ]
    pairs = table.select(F.col("n").cast("long"), *active, *classes).mapInArrow(
        _pair_counts(names), "label_a string, label_b string, n long"
    )
    return pairs.groupBy("label_a", "label_b").agg(F.sum("n").cast("long").alias("n"))


def _pair_counts(names: Sequence[str]):
    """Rows of counts, active names and classes -> how often two labels occur together, per task."""

    def add(total: Counter, a: Sequence[str], b: Sequence[str], counts: np.ndarray) -> None:
        for i, j in zip(*np.nonzero(counts), strict=True):
            total[a[i], b[j]] += int(counts[i, j])

    def batch_of(total: Counter) -> pa.RecordBatch:
        columns = [[pair[0] for pair in total], [pair[1] for pair in total], list(total.values())]
        kinds = [pa.string(), pa.string(), pa.int64()]
        arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, ["label_a", "label_b", "n"])

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        square = np.zeros((len(names), len(names)), dtype=np.int64)
        for batch in batches:
            frame = batch.to_pandas()
            n = frame["n"].to_numpy(dtype=np.int64)
            x = frame.iloc[:, 1 : 1 + len(names)].to_numpy(dtype=np.int64).reshape(len(frame), len(names))
            weighted = x * n[:, None]
            square += weighted.T @ x
            coded = [pd.factorize(frame[c]) for c in frame.columns[1 + len(names) :]]
            for codes, labels in coded:
                has = codes >= 0
                with_names = np.zeros((len(labels), len(names)), dtype=np.int64)
                np.add.at(with_names, codes[has], weighted[has])
                add(total, labels, names, with_names)
                add(total, names, labels, with_names.T)
                for other_codes, other_labels in coded:
                    both = has & (other_codes >= 0)
                    sums = pd.Series(n[both]).groupby([codes[both], other_codes[both]]).sum()
                    for (i, j), count in sums.items():
                        total[labels[i], other_labels[j]] += int(count)
            if len(total) > _MOST_PAIRS:
                yield batch_of(total)
                total.clear()
        add(total, names, names, square)
        yield batch_of(total)

    return task


OTHER = "other"


def configured_labels(config: Config, class_columns: Sequence[str], use_groups: bool = False) -> list[str]:
    """Labels that a configuration can give: flags or groups, then the classes of its rules by class column.

    People may enter other manual labels; these count under ``OTHER``.
    """
    names = config.group_names if use_groups else config.flag_names
    classes = [*_configured_classes(config), OTHER]
    return [*names, *(PREFIXES.get(c, "") + label for c in class_columns for label in classes)]


def _configured_classes(config: Config) -> list[str]:
    return sorted({rule.classification for rule in (*config.initial_rules, *config.final_rules)} | {DEFAULT_CLASS})


def cooccurrence_matrix(
    table: DataFrame, config: Config, class_columns: Sequence[str], use_groups: bool = False
) -> DataFrame:
    """The same as a square table with zeros, over the labels of the configuration.

    Classes that no rule gives are counted together, as ``OTHER`` of their column.
    """
    require_columns(table, class_columns, "classification")
    labels = configured_labels(config, class_columns, use_groups)
    known = _configured_classes(config)
    named = {c: F.when(col_(c).isNull() | col_(c).isin(known), col_(c)).otherwise(OTHER) for c in class_columns}
    renamed = table.select(*[named[c].alias(c) if c in named else col_(c) for c in table.columns])
    counts = cooccurrence(renamed, config, class_columns, use_groups)
    rows = table.sparkSession.createDataFrame([(i, label) for i, label in enumerate(labels)], "__row int, label string")
    cells = rows.join(counts.withColumnRenamed("label_a", "label"), "label", "left")
    return (
        cells.groupBy("__row", "label")
        .agg(*[F.coalesce(F.sum(F.when(F.col("label_b") == b, F.col("n"))), F.lit(0)).cast("long").alias(b) for b in labels])
        .orderBy("__row")
        .drop("__row")
    )
