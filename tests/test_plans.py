"""Flagging, rules, labels, reports and whole jobs on a handful of responses."""

import json
import sys

import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from surveysieve import __main__ as command
from surveysieve.config import Flag, Rule, config_from_tables
from surveysieve.operators import descriptives
from surveysieve.plans import jobs
from surveysieve.plans.flagging import apply_flags, flag_responses
from surveysieve.plans.manual import add_placeholders, merge_labels
from surveysieve.plans.registry import Columns, register_batch_flag, register_flag
from surveysieve.plans.rules import classify
from surveysieve.sources import responses, sinks
from surveysieve.sources.ip_ranges import read_ip_ranges
from surveysieve.sources.polygons import POLYGON_SCHEMA, read_polygons

ROWS = [
    (0, "5/30/2024 22:26", 30, "9.9.9.1", 100, "27", "a long answer here"),
    (1, "5/30/2024 22:26", 31, "9.9.9.2", 100, "5", "A LONG answer here "),
    (2, "5/30/2024 23:40", 900, "9.9.8.2", 40, None, "something else"),
    (3, "5/30/2024 23:50", 901, "9.9.8.3", 100, "9", None),
    (4, "5/31/2024 23:50", 5000, "9.9.7.3", 100, "9", "last"),
]
SCHEMA = "response_id long, `Start Date` string, `Duration (s)` int, IP string, Progress int, `Q7.1` string, `Q4.1` string"


def config():
    def flag(name, method, group, **parameters):
        return {"flag_name": name, "method_name": method, "flag_group": group, "use_flag": 1, "parameters": json.dumps(parameters)}

    def rule(number, condition, label):
        return {"rule_num": number, "condition_expr": condition, "classification": label, "use_rule": 1}

    return config_from_tables(
        {
            "flags": [
                flag("F_Two", "check_MultipleIPAttempts", "FG_Z", column_ip="IP", column_success="Q7.1",
                     num_attempts_lower=2, num_attempts_upper="inf"),
                flag("F_Short", "check_ValueInRange", "FG_A", column_name="Duration (s)",
                     lower_threshold="-inf", upper_threshold=60),
                flag("F_Burst", "check_BurstResponses", "FG_Z", column_start_time="Start Date",
                     column_duration="Duration (s)", max_start_time_difference=60, max_duration_difference=5),
                flag("F_Text", "check_DuplicatedText", "FG_A", list_of_columns="Q4.1", min_length=5, max_length="inf"),
                flag("F_Incomplete", "check_ValueInRange", "FG_I", column_name="Progress",
                     lower_threshold="-inf", upper_threshold=90),
            ],
            "initial_classification_rules": [
                rule("1", "FG_I > 0", "INCOMPLETE"), rule("2", "FG_Z", "FRAUD"), rule("3", "FG_A > 0", "TBD"),
            ],
            "final_classification_rules": [
                rule("1", "AUTOMATED_FLAG == 'INCOMPLETE'", "INCOMPLETE"),
                rule("2", "MANUAL_FLAG == 'FRAUD' or AUTOMATED_FLAG == 'FRAUD'", "FRAUD"),
                rule("3", True, "VALID"),
            ],
            "fuzzy_string": [{"column": "Q4.1", "minimum_length": 7, "fuzzy_algorithm": "", "threshold": 65}],
        }
    )


@pytest.fixture(scope="module")
def survey(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def flagged(spark, survey, tmp_path_factory):
    classified = jobs.initial_classification(survey, config(), "response_id")
    return sinks.write_table(classified, str(tmp_path_factory.mktemp("flagged") / "t"))


def test_column_order(flagged):
    assert flagged.columns == [
        "response_id", "Start Date", "Duration (s)", "IP", "Progress", "Q7.1", "Q4.1",
        "num_attempts_successful", "F_Two", "F_Short", "FF_Burst_count", "F_Burst", "F_Text", "F_Incomplete",
        "FG_A", "FG_I", "FG_Z", "ActiveFlags", "ActiveFlagGroups",
        "AUTOMATED_FLAG", "AUTOMATED_FLAG_RULE", "MANUAL_FLAG", "MANUAL_COMMENT",
    ]


def test_flag_values(flagged):
    rows = {r.response_id: r for r in flagged.collect()}
    assert [rows[i].num_attempts_successful for i in range(5)] == [2, 2, 1, 1, 1]
    assert [rows[i].FF_Burst_count for i in range(5)] == [1, 1, 0, 0, 0]
    assert rows[0].ActiveFlags == "F_Two; F_Short; F_Burst; F_Text"
    # Groups are named in the order of their first flag, the columns are sorted.
    assert rows[0].ActiveFlagGroups == "FG_Z; FG_A"
    assert rows[3].ActiveFlags == "" and rows[3].ActiveFlagGroups == ""
    assert [(rows[0].FG_A, rows[0].FG_I, rows[0].FG_Z)] == [(2, 0, 2)]
    assert [rows[i].AUTOMATED_FLAG for i in range(5)] == ["FRAUD", "FRAUD", "INCOMPLETE", "VALID", "VALID"]
    assert [rows[i].AUTOMATED_FLAG_RULE for i in range(5)] == ["2", "2", "1", None, None]


def test_without_strings(survey):
    assert "ActiveFlags" not in flag_responses(survey, config(), "response_id", add_string=False).columns


def test_own_flags(survey):
    register_flag("check_Even", lambda setting, column: F.col(column) % 2 == 0)

    def above_same_network(setting, column):
        table = setting.df.groupBy("IP").agg(F.min("response_id").alias("response_id"), F.lit(85.0).alias("__limit"))
        above = F.coalesce(F.col(column) > F.col("__limit"), F.lit(False))
        return Columns([("limit", F.col("__limit")), (setting.flag_name, above)], "limit", lambda: table.drop("IP"))

    register_flag("check_AboveLimit", above_same_network)
    flags = [
        Flag("F_Even", "check_Even", None, {"column": "Progress"}),
        Flag("F_Above", "check_AboveLimit", None, {"column": "Progress"}),
        Flag("F_Both", "check_CustomCondition", None, {"condition": "F_Even and F_Above"}),
    ]
    got = apply_flags(survey, flags, "response_id").orderBy("response_id")
    assert [(r.F_Even, r.F_Above, r.F_Both) for r in got.collect()] == [
        (True, True, True), (True, True, True), (True, False, False), (True, True, True), (True, True, True),
    ]


def test_batch_flags_share_one_pass_through_python(survey):
    sizes = []

    def longer(batch, least):
        sizes.append(batch.num_rows)
        return [len(text or "") >= least for text in batch.column("Q4.1").to_pylist()]

    def either(batch):
        return pc.or_kleene(pc.equal(batch.column(0), 100), pc.is_null(batch.column("Q7.1")))

    register_batch_flag("own_Longer", longer)
    register_batch_flag("own_Either", either)
    flags = [
        Flag("F_Long", "own_Longer", "FG", {"columns": "Q4.1", "least": 15}),
        Flag("F_Either", "own_Either", "FG", {"columns": ["Progress", "Q7.1"]}),
        Flag("F_Both", "check_CustomCondition", None, {"condition": "F_Long and F_Either"}),
    ]
    got = apply_flags(survey, flags, "response_id")
    plan = got.select("response_id", "F_Long", "F_Either")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    rows = got.orderBy("response_id").collect()
    assert [(r.F_Long, r.F_Either, r.F_Both) for r in rows] == [
        (True, True, True), (True, True, True), (False, True, False), (False, True, False), (False, True, False),
    ]
    for wrong in ({"columns": ["gone"]}, {"columns": ["Q4.1"]}, {"columns": ["Q4.1"], "least": 1, "most": 2}):
        with pytest.raises((ValueError, KeyError)):
            apply_flags(survey, [Flag("F", "own_Longer", None, wrong)], "response_id")


@pytest.mark.parametrize(
    "method, parameters, error",
    [
        ("check_Unknown", {}, ValueError),
        ("check_ValueInRange", {"column": "Progress"}, ValueError),
        ("check_MultipleIPAttempts", {"column_ip": "gone", "column_success": "IP", "num_attempts_lower": 1}, ValueError),
        ("check_IPLocation", {"column_ip": "IP", "target_region": "X", "flag_missing": True}, KeyError),
        (
            "check_IPLocation",
            {"column_ip": "IP", "target_region": "X", "flag_missing": True, "region_level": "street"},
            ValueError,
        ),
        (
            "check_DuplicatedText",
            {"list_of_columns": ["IP"], "min_length": 1, "max_length": 9, "search_strategy": "x"},
            ValueError,
        ),
    ],
)
def test_bad_flags_fail_before_running(survey, method, parameters, error):
    with pytest.raises(error):
        apply_flags(survey, [Flag("F_Bad", method, None, parameters)], "response_id")


def test_shared_counts_are_joined_once(survey):
    common = {"column_ip": "IP", "column_success": "Q7.1"}
    flags = [
        Flag("F_2", "check_MultipleIPAttempts", None, {**common, "num_attempts_lower": 2, "num_attempts_upper": 2}),
        Flag("F_3", "check_MultipleIPAttempts", None, {**common, "num_attempts_lower": 3}),
    ]
    one, two = (apply_flags(survey, flags[:n], "response_id") for n in (1, 2))
    joins = [df._jdf.queryExecution().analyzed().toString().count("Join ") for df in (one, two)]
    assert joins[0] == joins[1]


def test_rules(spark):
    df = spark.createDataFrame([(1, 0, None, True), (2, 3, "x", None), (3, None, "", False)], "id int, n int, t string, b boolean")
    rules = [Rule("a", "b", "B"), Rule("b", "n", "N"), Rule("c", "t", "T"), Rule("d", "id == 3 and not (n <=> 1)", "D")]
    got = classify(df, rules, "label", "rule").orderBy("id").collect()
    assert [(r.label, r.rule) for r in got] == [("B", "a"), ("N", "b"), ("D", "d")]
    assert [r.label for r in classify(df, [], "label", "rule").collect()] == ["VALID"] * 3
    assert [r.rule for r in classify(df, [Rule("z", False, "Z")], "label", "rule").collect()] == [None] * 3
    for broken in ("n >", "no_such_column > 0"):
        with pytest.raises(ValueError, match="rule q"):
            classify(df, [Rule("a", "b", "B"), Rule("q", broken, "Q")], "label", "rule")


def test_labels(spark, survey):
    placed = add_placeholders(survey.select("response_id"))
    assert placed.columns == ["response_id", "MANUAL_FLAG", "MANUAL_COMMENT"]
    assert add_placeholders(placed).columns == placed.columns
    labels = spark.createDataFrame([(1, "FRAUD", "seen"), (2, None, "only a note")], "response_id long, MANUAL_FLAG string, MANUAL_COMMENT string")
    before = placed.withColumn("MANUAL_FLAG", F.when(F.col("response_id").isin(2, 3), "OLD"))
    merged = {r.response_id: (r.MANUAL_FLAG, r.MANUAL_COMMENT) for r in merge_labels(before, labels, "response_id").collect()}
    assert merged == {0: (None, None), 1: ("FRAUD", "seen"), 2: ("OLD", "only a note"), 3: ("OLD", None), 4: (None, None)}


def test_final_classification(spark, flagged):
    labels = spark.createDataFrame([(3, "FRAUD", None)], "response_id long, MANUAL_FLAG string, MANUAL_COMMENT string")
    final = jobs.final_classification(flagged, config(), "response_id", labels)
    got = {r.response_id: (r.FINAL_FLAG, r.FINAL_FLAG_RULE) for r in final.collect()}
    assert got == {0: ("FRAUD", "2"), 1: ("FRAUD", "2"), 2: ("INCOMPLETE", "1"), 3: ("FRAUD", "2"), 4: ("VALID", "3")}
    with pytest.raises(ValueError):
        jobs.final_classification(flagged.drop("MANUAL_FLAG"), config())
    with pytest.warns(UserWarning):
        jobs.warn_without_labels(flagged)


def test_reports(flagged):
    table = descriptives.patterns(flagged, config(), ["AUTOMATED_FLAG"])
    crosstab = [tuple(r) for r in descriptives.flag_group_crosstab(table, config()).collect()]
    assert crosstab == [
        ("F_Two", 2, 2, 0, 2), ("F_Short", 2, 2, 0, 2), ("F_Burst", 2, 2, 0, 2), ("F_Text", 2, 2, 0, 2),
        ("F_Incomplete", 0, 0, 1, 1), ("Total", 2, 2, 1, None),
    ]
    assert descriptives.any_flag_count(table, config()).first()[:] == (3, 5)
    assert [r.Count for r in descriptives.group_totals(table, config()).collect()] == [4, 4, 1]
    counts = [tuple(r) for r in descriptives.classification_counts(flagged, "AUTOMATED_FLAG").collect()]
    assert counts == [("FRAUD", 2), ("VALID", 2), ("INCOMPLETE", 1)]
    matrix = descriptives.cooccurrence_matrix(table, config(), ["AUTOMATED_FLAG"], use_groups=True)
    classes = [f"(auto) {label}" for label in ("FRAUD", "INCOMPLETE", "TBD", "VALID", "other")]
    labels = ["FG_Z", "FG_A", "FG_I", *classes]
    assert matrix.columns == ["label", *labels]
    rows = {r["label"]: tuple(r)[1:] for r in matrix.collect()}
    assert rows["FG_Z"] == (2, 2, 0, 2, 0, 0, 0, 0) and rows["(auto) VALID"] == (0, 0, 0, 0, 0, 0, 2, 0)
    assert all(rows[a][labels.index(b)] == rows[b][labels.index(a)] for a in labels for b in labels)
    with pytest.raises(ValueError):
        descriptives.patterns(flagged, config(), ["GONE"])


def test_reports_of_nothing(flagged):
    table = descriptives.patterns(flagged.limit(0), config(), ["AUTOMATED_FLAG"])
    assert descriptives.any_flag_count(table, config()).first()[:] == (0, 0)
    assert {r.Count for r in descriptives.flag_counts(table, config()).collect()} == {0}


def test_mark_similar(survey):
    rows = {r.response_id: r for r in jobs.mark_similar(survey, config(), "response_id").collect()}
    assert rows[0]["FZ_COUNT_Q4.1"] == 1 and rows[0]["FZ_SIMILAR_Q4.1"] == '1. (66) "A LONG answer here "'
    assert rows[3]["FZ_COUNT_Q4.1"] == 0 and rows[3]["FZ_SIMILAR_Q4.1"] is None


def test_numbering_follows_the_file(spark, tmp_path):
    path = str(tmp_path / "many.csv")
    with open(path, "w", encoding="utf-8") as file:
        file.write("a,b\n" + "".join(f"{i},{'x' * (i % 50)}\n" for i in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 20_000)
    try:
        df = responses.read_csv(spark, path, "a long, b string")
        assert df.rdd.getNumPartitions() > 5
        assert df.where("a <> response_id").count() == 0 and df.count() == 20_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_csv_keeps_text(spark, tmp_path):
    rows = [(0, 'say "hi", then\nleave', 1.5, True), (1, None, None, False), (2, "\xa0", float("nan"), None)]
    df = spark.createDataFrame(rows, "response_id long, `t.x` string, d double, b boolean")
    sinks.write_csv(df, str(tmp_path / "c"), "response_id")
    back = responses.read_csv(spark, str(tmp_path / "c"), responses.review_schema(df), "response_id", multi_line=True)
    assert [tuple(r) for r in back.orderBy("response_id").collect()] == [
        (0, 'say "hi", then\nleave', 1.5, True), (1, None, None, False), (2, "\xa0", None, None),
    ]


def test_booleans_as_people_save_them(spark, tmp_path):
    (tmp_path / "m.csv").write_text("F_A,FG_A,MANUAL_FLAG\nTRUE,1,FRAUD\nFALSE,0,\n")
    df = responses.read_csv(spark, str(tmp_path / "m.csv"), "F_A boolean, FG_A int, MANUAL_FLAG string")
    assert [tuple(r) for r in df.collect()] == [(True, 1, "FRAUD", 0), (False, 0, None, 1)]


def test_lookup_sources(spark, tmp_path):
    (tmp_path / "r.csv").write_text("start_ip,end_ip,lat,lon,country,state,city\n1.0.0.0,16777471,1.5,2,A,,\n")
    assert read_ip_ranges(spark, str(tmp_path / "r.csv")).first()[:] == (16777216, 16777471, 1.5, 2.0, "A", None, None)
    shape = {"name": "A", "iso3": "AAA", "ring_id": 1, "vertices": [{"lon": 0, "lat": 0}, {"lon": 1, "lat": 0}]}
    (tmp_path / "p.jsonl").write_text(json.dumps(shape) + "\n")
    polygons = read_polygons(spark, str(tmp_path / "p.jsonl"))
    assert polygons.first().vertices[1].lon == 1.0
    sinks.write_table(polygons, str(tmp_path / "p"))
    assert read_polygons(spark, str(tmp_path / "p")).schema == spark.createDataFrame([], POLYGON_SCHEMA).schema


def test_command_line_steps(spark, survey, tmp_path, monkeypatch):
    paths = {
        "data_file": "data.parquet", "flagged_file": "flagged.csv", "manual_file": "flagged.csv",
        "final_output_file": "final", "fuzzy_file": "fuzzy", "descriptives_file": "reports",
    }
    sinks.write_table(survey, str(tmp_path / "data.parquet"))
    monkeypatch.setattr(command, "load_config", lambda path: config_with_paths(tmp_path, paths))
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    for step in ("initial", "initial-reports", "final", "final-reports", "similar"):
        monkeypatch.setattr(sys, "argv", ["surveysieve", step, "unused", "--key", "response_id"])
        command.main()
    final = spark.read.parquet(str(tmp_path / "final"))
    assert {r.response_id: r.FINAL_FLAG for r in final.collect()}[2] == "INCOMPLETE"
    assert sinks.read_report(spark, str(tmp_path / "reports"), "02_filters").count() == 6
    assert sinks.read_report(spark, str(tmp_path / "reports"), "05_FINAL_FLAG").count() == 3
    assert "FZ_COUNT_Q4.1" in spark.read.parquet(str(tmp_path / "fuzzy")).columns


def config_with_paths(folder, paths):
    from dataclasses import replace

    return replace(config(), filepaths={name: str(folder / path) for name, path in paths.items()})
