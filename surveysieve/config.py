"""Configuration tables: file paths, flags, classification rules, fuzzy columns.

Plain driver-side records, read from one JSON file or a folder of CSV files.
"""

from __future__ import annotations

import csv
import json
import math
import os
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any

# Spellings of special numbers and Booleans in parameter objects.
SPECIAL_VALUES = {
    "infinity": math.inf,
    "inf": math.inf,
    "-infinity": -math.inf,
    "-inf": -math.inf,
    "nan": math.nan,
    "nil": math.nan,
    "none": math.nan,
    "true": True,
    "false": False,
}

# Configuration tables and the columns they must have.
REQUIRED_COLUMNS = {
    "filepaths": ["parameter", "value"],
    "flags": ["flag_name", "method_name", "flag_group", "use_flag", "parameters"],
    "initial_classification_rules": ["rule_num", "condition_expr", "classification", "use_rule"],
    "final_classification_rules": ["rule_num", "condition_expr", "classification", "use_rule"],
    "fuzzy_string": ["column", "minimum_length", "fuzzy_algorithm", "threshold"],
}


# Class of a response that no rule fits.
DEFAULT_CLASS = "VALID"


def decode_special_values(values: Mapping[str, Any]) -> dict[str, Any]:
    """Special spellings among the values of an object; lists are left alone."""
    return {
        name: SPECIAL_VALUES.get(value.lower(), value) if isinstance(value, str) else value
        for name, value in values.items()
    }


def _blank(value: Any) -> bool:
    return value is None or value == "" or (isinstance(value, float) and math.isnan(value))


def _used(value: Any) -> bool:
    try:
        return float(value) == 1
    except (TypeError, ValueError):
        return False


@dataclass(frozen=True)
class Flag:
    flag_name: str
    method_name: str
    flag_group: str | None = None
    parameters: Mapping[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class Rule:
    rule_num: str | None
    condition_expr: str | bool
    classification: str


@dataclass(frozen=True)
class FuzzyColumn:
    column: str
    minimum_length: int = 7
    fuzzy_algorithm: str = "token_sort_ratio"
    threshold: float = 65


@dataclass(frozen=True)
class Config:
    filepaths: Mapping[str, str] = field(default_factory=dict)
    flags: tuple[Flag, ...] = ()
    initial_rules: tuple[Rule, ...] = ()
    final_rules: tuple[Rule, ...] = ()
    fuzzy: tuple[FuzzyColumn, ...] = ()

    def path(self, parameter: str) -> str:
        if parameter not in self.filepaths:
            raise KeyError(f"no path configured for '{parameter}'")
        return self.filepaths[parameter]

    @property
    def flag_names(self) -> list[str]:
        return list(dict.fromkeys(f.flag_name for f in self.flags))

    @property
    def group_names(self) -> list[str]:
        """Groups in the order of their first flag."""
        return list(dict.fromkeys(f.flag_group for f in self.flags if f.flag_group))

    def flags_of(self, group: str) -> list[str]:
        return list(dict.fromkeys(f.flag_name for f in self.flags if f.flag_group == group))


def config_from_tables(tables: Mapping[str, Iterable[Mapping[str, Any]]]) -> Config:
    """Active rows of the tables; a table that is absent is empty."""
    rows = {name: [dict(r) for r in tables.get(name, [])] for name in REQUIRED_COLUMNS}
    for name, required in REQUIRED_COLUMNS.items():
        absent = [c for c in required if any(c not in r for r in rows[name])]
        if absent:
            raise ValueError(f"table '{name}': missing required columns {absent}")
    return Config(
        filepaths={r["parameter"]: r["value"] for r in rows["filepaths"] if not _blank(r["value"])},
        flags=tuple(_flag(r) for r in rows["flags"] if _used(r["use_flag"])),
        initial_rules=_rules(rows["initial_classification_rules"]),
        final_rules=_rules(rows["final_classification_rules"]),
        fuzzy=tuple(_fuzzy(r) for r in rows["fuzzy_string"]),
    )


def _flag(row: Mapping[str, Any]) -> Flag:
    given = row["parameters"]
    if isinstance(given, str):
        given = json.loads(given, object_hook=decode_special_values)
    else:
        given = {} if _blank(given) else decode_special_values(given)
    group = None if _blank(row["flag_group"]) else row["flag_group"]
    return Flag(row["flag_name"], row["method_name"], group, given)


def _rules(rows: Iterable[Mapping[str, Any]]) -> tuple[Rule, ...]:
    return tuple(
        Rule(None if _blank(r["rule_num"]) else str(r["rule_num"]), r["condition_expr"], r["classification"])
        for r in rows
        if _used(r["use_rule"])
    )


def _fuzzy(row: Mapping[str, Any]) -> FuzzyColumn:
    default = FuzzyColumn(row["column"])
    minimum, scorer, threshold = (row[c] for c in ("minimum_length", "fuzzy_algorithm", "threshold"))
    return FuzzyColumn(
        row["column"],
        default.minimum_length if _blank(minimum) or not float(minimum) else int(float(minimum)),
        default.fuzzy_algorithm if _blank(scorer) else scorer,
        default.threshold if _blank(threshold) or not float(threshold) else float(threshold),
    )


def load_config(path: str) -> Config:
    """Tables from ``path``: a JSON object of row lists, or a folder of ``<table>.csv``."""
    if not os.path.isdir(path):
        with open(path, encoding="utf-8") as file:
            return config_from_tables(json.load(file))
    tables = {}
    for name in REQUIRED_COLUMNS:
        file_name = os.path.join(path, f"{name}.csv")
        if os.path.exists(file_name):
            with open(file_name, encoding="utf-8", newline="") as file:
                tables[name] = list(csv.DictReader(file))
    return config_from_tables(tables)
