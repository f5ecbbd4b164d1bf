"""Classification by an ordered list of rules; the first that holds decides."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveysieve.config import DEFAULT_CLASS, Rule
from surveysieve.functions.columns import truth

def _condition(df: DataFrame, rule: Rule) -> Column:
    """The rule as a Boolean column."""
    if isinstance(rule.condition_expr, bool):
        return F.lit(rule.condition_expr)
    return truth(df, rule.condition_expr, f"rule {rule.rule_num}")


def classify(df: DataFrame, rules: Iterable[Rule], class_column: str, rule_column: str) -> DataFrame:
    """The responses with class and number of the first rule that holds.

    Conditions are Spark SQL over the columns; an unknown condition does not
    hold. A response that no rule fits is VALID without a rule.
    """
    decision = None
    for rule in rules:
        outcome = F.struct(
            F.lit(rule.classification).cast("string").alias("label"), F.lit(rule.rule_num).cast("string").alias("rule")
        )
        condition = _condition(df, rule)
        decision = F.when(condition, outcome) if decision is None else decision.when(condition, outcome)
    default = F.struct(F.lit(DEFAULT_CLASS).alias("label"), F.lit(None).cast("string").alias("rule"))
    decision = default if decision is None else decision.otherwise(default)
    kept = [c for c in df.columns if c not in (class_column, rule_column)]
    decided = df.select(*["`" + c.replace("`", "``") + "`" for c in kept], decision.alias("__decision"))
    return decided.select(
        "*", F.col("__decision.label").alias(class_column), F.col("__decision.rule").alias(rule_column)
    ).drop("__decision")
