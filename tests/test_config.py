"""Configuration tables."""

import json
import math

import pytest

from surveysieve.config import Flag, FuzzyColumn, config_from_tables, decode_special_values, load_config


def flag_row(name="F_A", group="FG_A", used=1, parameters="{}"):
    return {"flag_name": name, "method_name": "check_X", "flag_group": group, "use_flag": used, "parameters": parameters}


def test_special_values():
    given = {"a": "INF", "b": "-Infinity", "c": "Nil", "d": "TRUE", "e": "false", "f": "x", "g": ["inf"], "h": 3}
    got = decode_special_values(given)
    assert got["a"] == math.inf and got["b"] == -math.inf and math.isnan(got["c"])
    assert got["d"] is True and got["e"] is False
    assert got["f"] == "x" and got["g"] == ["inf"] and got["h"] == 3


def test_flags_and_groups():
    config = config_from_tables(
        {
            "flags": [
                flag_row("F_B", "FG_Z", parameters='{"lower_threshold": "-inf"}'),
                flag_row("F_C", None),
                flag_row("F_D", "FG_A", used="1"),
                flag_row("F_E", "FG_A", used=0),
                flag_row("F_F", float("nan"), used=1.0),
                flag_row("F_G", "FG_Z"),
            ]
        }
    )
    assert config.flags[0] == Flag("F_B", "check_X", "FG_Z", {"lower_threshold": -math.inf})
    assert config.flag_names == ["F_B", "F_C", "F_D", "F_F", "F_G"]
    assert config.group_names == ["FG_Z", "FG_A"]
    assert config.flags_of("FG_Z") == ["F_B", "F_G"]


def test_missing_columns_are_named():
    with pytest.raises(ValueError, match="method_name.*use_flag"):
        config_from_tables({"flags": [{"flag_name": "F", "flag_group": "G", "parameters": "{}"}]})


def test_fuzzy_defaults():
    rows = [
        {"column": "a", "minimum_length": "", "fuzzy_algorithm": None, "threshold": float("nan")},
        {"column": "b", "minimum_length": 5, "fuzzy_algorithm": "ratio", "threshold": "80"},
    ]
    assert config_from_tables({"fuzzy_string": rows}).fuzzy == (
        FuzzyColumn("a", 7, "token_sort_ratio", 65),
        FuzzyColumn("b", 5, "ratio", 80),
    )


def test_load(tmp_path):
    tables = {
        "filepaths": [{"parameter": "data_file", "value": "x.csv"}],
        "flags": [flag_row()],
        "initial_classification_rules": [
            {"rule_num": 1, "condition_expr": "a > 0", "classification": "BAD", "use_rule": 1},
            {"rule_num": 2, "condition_expr": "b > 0", "classification": "BAD", "use_rule": 0},
        ],
    }
    path = tmp_path / "config.json"
    path.write_text(json.dumps(tables))
    config = load_config(str(path))
    assert config.path("data_file") == "x.csv" and len(config.initial_rules) == 1
    with pytest.raises(KeyError):
        config.path("other")
    folder = tmp_path / "tables"
    folder.mkdir()
    (folder / "flags.csv").write_text(
        'flag_name,method_name,flag_group,use_flag,parameters,description\nF_A,check_X,FG_A,1,"{""k"": ""inf""}",text\n'
    )
    assert load_config(str(folder)).flags == (Flag("F_A", "check_X", "FG_A", {"k": math.inf}),)
