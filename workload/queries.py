"""One query per operator: (spark, folder of the tables) -> DataFrame."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveysieve.config import Flag
from surveysieve.functions.columns import col_
from surveysieve.operators import attempts, bursts, descriptives, geo_location, ip_location, row_flags, similarity
from surveysieve.plans import flagging, jobs, registry
from surveysieve.plans.manual import add_placeholders, merge_labels
from surveysieve.plans.rules import classify
from surveysieve.sources import responses as source
from surveysieve.sources import polygons, sinks
from workload import tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
KEY = "response_id"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _scratch(spark: SparkSession, name: str) -> str:
    return os.path.join(sinks.shared_folder(spark), f"surveysieve-{name}-{uuid.uuid4().hex}")


def _flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flagging.flag_responses(tables.responses(spark, sf_dir), tables.config(), KEY)


def _automated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.initial_classification(tables.responses(spark, sf_dir), tables.config(), KEY)


def _final(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = tables.manual_labels(spark, sf_dir)
    return jobs.final_classification(_automated(spark, sf_dir), tables.config(), KEY, labels)


def _patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return descriptives.patterns(_automated(spark, sf_dir), tables.config(), [jobs.AUTOMATED])


_CLASSES = [jobs.AUTOMATED, jobs.MANUAL, jobs.FINAL]


# Sources and sinks

_CSV_COLUMNS = ["response_id", "duration", "ip", "success", "terminate", "progress", "instructed"]


@query
def scan_responses(spark, sf_dir):
    """Responses from CSV files, numbered in file order."""
    path = _scratch(spark, "scan")
    written = tables.responses(spark, sf_dir).select(*_CSV_COLUMNS)
    sinks.write_csv(written.withColumnRenamed(KEY, "event_id"), path, "event_id")
    schema = source.review_schema(written.withColumnRenamed(KEY, "event_id"))
    return source.read_csv(spark, path, schema)


@query
def scan_flagged(spark, sf_dir):
    """A flagged file as people get it, read back with its flags and counts."""
    path = _scratch(spark, "flagged")
    flagged = _flagged(spark, sf_dir).select(KEY, *_FLAG_OUTPUT)
    sinks.write_csv(flagged, path)
    return source.read_csv(spark, path, source.review_schema(flagged), key=KEY)


@query
def csv_roundtrip(spark, sf_dir):
    """Free text with quotes, commas and line breaks through a CSV file."""
    path = _scratch(spark, "csv")
    written = tables.answers(spark, sf_dir).select(KEY, "text")
    sinks.write_csv(written, path)
    return source.read_csv(spark, path, source.review_schema(written), key=KEY, multi_line=True)


@query
def checkpoint_roundtrip(spark, sf_dir):
    """Classified responses through the table the next step starts from."""
    return sinks.stage_table(_automated(spark, sf_dir).select(KEY, "AUTOMATED_FLAG", "AUTOMATED_FLAG_RULE"), "classified")


@query
def descriptives_roundtrip(spark, sf_dir):
    """Report tables written one by one and read back; writing again replaces one table."""
    path = _scratch(spark, "reports")
    table = _patterns(spark, sf_dir)
    counts = descriptives.classification_counts(table, jobs.AUTOMATED, F.col("n"))
    sinks.write_report(counts, path, "02_AUTOMATED_FLAG")
    sinks.write_report(descriptives.flag_counts(table, tables.config()), path, "02_flags")
    sinks.write_report(counts, path, "02_AUTOMATED_FLAG")
    return jobs.as_one_table(
        {name: sinks.read_report(spark, path, name) for name in ("02_AUTOMATED_FLAG", "02_flags")}
    )


@query
def polygon_edges(spark, sf_dir):
    """Border segments of the countries."""
    return polygons.polygon_edges(tables.polygons(spark, sf_dir))


# Flags within a response


def _row_flag(name: str, column: Callable[[DataFrame], F.Column], base: Query = tables.responses) -> None:
    def run(spark, sf_dir):
        df = base(spark, sf_dir)
        return df.select(KEY, column(df).alias("flag"))

    QUERIES[name] = run


_row_flag("flag_value_in_range", lambda df: row_flags.value_in_range("duration", 20, 60.5))
_row_flag("flag_value_at_most", lambda df: row_flags.value_in_range("success", float("-inf"), 30))
_row_flag("flag_custom_condition", lambda df: row_flags.custom_condition("NOT (instructed <=> 2) AND progress < 50"))
_row_flag("flag_reverse_coded", lambda df: row_flags.reverse_coded(["q1", "q2"], ["q3", "q4"], 1, 7, 0.1))
_row_flag(
    "flag_suspicious_character",
    lambda df: row_flags.suspicious_character(df.columns, ["html", "url"], ["%%%", "***", "\xa0"]),
    lambda spark, sf_dir: tables.read(spark, sf_dir, "pages").withColumnRenamed("page_id", KEY),
)
_row_flag(
    "flag_suspicious_name", lambda df: row_flags.suspicious_name("first_name", "last_name", 4), tables.names
)


# Flags across responses


def _attempts(attempt_type: str) -> None:
    def run(spark, sf_dir):
        flag = Flag(
            "F_Attempts",
            "check_MultipleIPAttempts",
            None,
            {
                "column_ip": "ip", "column_success": "success", "column_terminate": "terminate",
                "attempt_type": attempt_type, "num_attempts_lower": 5, "num_attempts_upper": 20,
            },
        )
        flagged = flagging.apply_flags(tables.responses(spark, sf_dir), [flag], KEY)
        return flagged.select(KEY, f"num_attempts_{attempt_type}", "F_Attempts")

    QUERIES[f"attempts_{attempt_type}"] = run


for _type in attempts.ATTEMPT_TYPES:
    _attempts(_type)


def _burst(name: str, **more: float) -> None:
    def run(spark, sf_dir):
        flag = Flag(
            "F_Burst",
            "check_BurstResponses",
            None,
            {
                "column_start_time": "start_ts", "column_duration": "duration",
                "max_start_time_difference": 60, "max_duration_difference": 1.0, **more,
            },
        )
        return flagging.apply_flags(tables.responses(spark, sf_dir), [flag], KEY).select(KEY, "FF_Burst_count", "F_Burst")

    QUERIES[name] = run


_burst("burst_responses")
_burst(
    "burst_responses_unflag",
    max_start_time_difference=3600, max_duration_difference=5.0,
    unflag_start_time_difference=600, unflag_duration_difference=2.5,
)


@query
def burst_text_times(spark, sf_dir):
    """Start times as text on a clock of 12 hours, some of them blank."""
    text = "CASE WHEN response_id % 11 != 0 THEN date_format(start_ts, 'M/d/yyyy h:mm:ss a') ELSE ' ' END AS started"
    rows = tables.responses(spark, sf_dir).selectExpr(KEY, text, "duration")
    return bursts.burst_counts(rows, KEY, "started", "duration", 60, 1.0)


def _duplicates(name: str, **parameters) -> None:
    def run(spark, sf_dir):
        flag = Flag(
            "F_Duplicate",
            "check_DuplicatedText",
            None,
            {"list_of_columns": ["text", "headline"], "min_length": 20, "max_length": float("inf"), **parameters},
        )
        flagged = flagging.apply_flags(tables.answers(spark, sf_dir), [flag], KEY)
        return flagged.select(KEY, *[c for c in flagged.columns if c.startswith("F_Duplicate")])

    QUERIES[name] = run


_duplicates("duplicated_text_column", list_of_columns="text", max_length=5000)
_duplicates("duplicated_text_column_flags", create_column_flag=True)
_duplicates("duplicated_text_all", search_strategy="all")


def _ip_location(name: str, **parameters) -> None:
    def run(spark, sf_dir):
        flag = Flag("F_IP", "check_IPLocation", None, {"column_ip": "ip", **parameters})
        lookups = {"ip_ranges": tables.ip_ranges(spark, sf_dir)}
        flagged = flagging.apply_flags(tables.responses(spark, sf_dir), [flag], KEY, lookups)
        return flagged.select(KEY, *ip_location.PLACE, "IPLocation", "F_IP")

    QUERIES[name] = run


@query
def ip_location_nested(spark, sf_dir):
    """Places by ranges that nest: the innermost one counts, and the outer one around it."""
    outer = tables.ip_ranges(spark, sf_dir)
    inner = outer.selectExpr(
        "start_ip + 1000 AS start_ip", "start_ip + 20000 AS end_ip", "lat", "lon",
        "concat('IN_', country) AS country", "state", "city",
    )
    innermost = inner.selectExpr(
        "start_ip + 500 AS start_ip", "start_ip + 700 AS end_ip", "lat", "lon", "concat('DEEP_', country) AS country", "state", "city"
    )
    rows = tables.responses(spark, sf_dir).select(KEY, "ip")
    return ip_location.ip_places(rows, KEY, "ip", outer.unionByName(inner).unionByName(innermost))


@query
def flag_batches(spark, sf_dir):
    """Own flags on Arrow batches, which share one pass, beside others."""

    def same_answers(batch):
        """Whether all answers of a row are there and equal."""
        first, *others = batch.columns
        same = pc.is_valid(first)
        for other in others:
            same = pc.and_(same, pc.fill_null(pc.equal(first, other), False))
        return same

    def far_apart(batch, at_least):
        """Whether the answers of a row span so much."""
        return pc.greater_equal(pc.subtract(pc.max_element_wise(*batch.columns), pc.min_element_wise(*batch.columns)), at_least)

    registry.register_batch_flag("own_SameAnswers", same_answers)
    registry.register_batch_flag("own_FarApart", far_apart)
    flags = [
        Flag("F_Same", "own_SameAnswers", None, {"columns": ["q1", "q2"]}),
        Flag("F_Apart", "own_FarApart", None, {"columns": ["q1", "q2", "q3", "q4"], "at_least": 6}),
        Flag("F_Short", "check_ValueInRange", None, {"column_name": "duration", "lower_threshold": 0, "upper_threshold": 5}),
    ]
    flagged = flagging.apply_flags(tables.responses(spark, sf_dir), flags, KEY)
    return flagged.select(KEY, "F_Same", "F_Apart", "F_Short")


@query
def ip_location_v6(spark, sf_dir):
    """Places of IPv6 addresses by the innermost range of 128-bit addresses."""
    address = """CASE response_id % 3
        WHEN 0 THEN concat('2001:db8:', hex(user % 50), '::', hex(near), ':', hex(far))
        WHEN 1 THEN concat('2001:0db8:', lower(hex(user % 50)), ':0:0:0:', hex(near), ':', lpad(hex(far), 4, '0'))
        ELSE concat('2001:db8:', hex(user % 50), '::0.', near, '.', far div 256, '.', far % 256) END AS ip"""
    rows = tables.read(spark, sf_dir, "events").selectExpr(
        "event_id AS response_id", "user_id AS user", "event_id % 8 AS near", "event_id % 200 AS far"
    )
    return ip_location.ip_places(rows.selectExpr(KEY, address), KEY, "ip", tables.ip_ranges_v6(spark, sf_dir))


_ip_location("ip_location_country", target_region="NATION_7", flag_missing=False)
_ip_location("ip_location_state", target_region="STATE_2", flag_missing=False, region_level="state")
_ip_location("ip_location_city_missing", target_region="CITY_7", flag_missing=True, region_level="city")


@query
def latlong_country(spark, sf_dir):
    """Country of each distinct coordinate that is in one."""
    points = tables.responses(spark, sf_dir).selectExpr("latitude AS lat", "longitude AS lon")
    distinct = points.where("lat IS NOT NULL AND lon IS NOT NULL").distinct()
    return geo_location.locate_points(distinct, tables.polygons(spark, sf_dir))


def _latlong(name: str, flag_missing: bool) -> None:
    def run(spark, sf_dir):
        flag = Flag(
            "F_Place",
            "check_LatLongLocation",
            None,
            {
                "column_latitude": "latitude", "column_longitude": "longitude",
                "target_country": "NATION_7", "flag_missing": flag_missing,
            },
        )
        lookups = {"polygons": tables.polygons(spark, sf_dir)}
        flagged = flagging.apply_flags(tables.responses(spark, sf_dir), [flag], KEY, lookups)
        return flagged.select(KEY, "LatLongLocation", "F_Place")

    QUERIES[name] = run


_latlong("flag_latlong_location", False)
_latlong("flag_latlong_location_missing", True)


# Flags together, labels and rules

_FLAG_OUTPUT = [
    "F_ShortDuration", "num_attempts_successful", "F_ManyAttempts", "F_SomeAttempts", "num_attempts_failed",
    "F_FailedAttempts", "F_Incomplete", "FF_Burst_count", "F_Burst", "F_Instructed", "F_Contradiction", "F_Both",
    "FG_Answers", "FG_Incomplete", "FG_Network", "FG_Speed", "ActiveFlags", "ActiveFlagGroups",
]


@query
def flag_responses(spark, sf_dir):
    """Every flag, group count and label of the configuration."""
    return _flagged(spark, sf_dir).select(KEY, *_FLAG_OUTPUT)


def _flag(name: str, method: str, **parameters) -> Flag:
    return Flag(name, method, None, parameters)


@query
def flag_rerun(spark, sf_dir):
    """A flagged table flagged again: a condition takes the new value of an earlier flag, not the old one."""
    old = tables.responses(spark, sf_dir).selectExpr(KEY, "duration", "duration > 5 AS F_Short")
    flags = [
        _flag("F_Short", "check_ValueInRange", column_name="duration", lower_threshold=float("-inf"), upper_threshold=5),
        _flag("F_Same", "check_CustomCondition", condition="F_Short"),
    ]
    return flagging.apply_flags(old, flags, KEY)


@query
def flag_on_earlier_column(spark, sf_dir):
    """A check across responses, and the character check, on columns that earlier flags made."""
    answers = tables.answers(spark, sf_dir).select(KEY, "headline")
    flags = [
        _flag("F_First", "check_DuplicatedText", list_of_columns="headline", min_length=5, max_length=float("inf")),
        _flag("F_Digit", "check_SuspiciousCharacter", list_of_columns=["F_First"], list_of_chars=["rue"]),
        _flag("F_Again", "check_DuplicatedText", list_of_columns="F_Digit", min_length=5, max_length=float("inf")),
    ]
    return flagging.apply_flags(answers, flags, KEY).drop("headline")


@query
def flag_overwritten_count(spark, sf_dir):
    """A count written by two flags: a condition between them sees the first one."""
    attempts_of = {"column_ip": "ip", "column_success": "success", "num_attempts_lower": 5}
    flags = [
        _flag("F_One", "check_MultipleIPAttempts", **attempts_of),
        _flag("F_Between", "check_CustomCondition", condition="num_attempts_successful >= 5"),
        _flag("F_Two", "check_MultipleIPAttempts", **attempts_of | {"column_success": "terminate"}),
    ]
    flagged = flagging.apply_flags(tables.responses(spark, sf_dir), flags, KEY)
    return flagged.select(KEY, "F_One", "F_Between", "F_Two", "num_attempts_successful")


@query
def flag_group_counts(spark, sf_dir):
    return _flagged(spark, sf_dir).select(KEY, "FG_Answers", "FG_Incomplete", "FG_Network", "FG_Speed")


@query
def active_flags(spark, sf_dir):
    return _flagged(spark, sf_dir).select(KEY, "ActiveFlags")


@query
def active_flag_groups(spark, sf_dir):
    return _flagged(spark, sf_dir).select(KEY, "ActiveFlagGroups")


@query
def placeholder_columns(spark, sf_dir):
    return add_placeholders(tables.responses(spark, sf_dir).select(KEY, "progress"))


@query
def merge_manual_labels(spark, sf_dir):
    responses = tables.responses(spark, sf_dir).select(KEY, "progress")
    return merge_labels(responses, tables.manual_labels(spark, sf_dir), KEY)


@query
def classify_initial(spark, sf_dir):
    flagged = _flagged(spark, sf_dir)
    classified = classify(flagged, tables.config().initial_rules, "AUTOMATED_FLAG", "AUTOMATED_FLAG_RULE")
    return classified.select(KEY, "AUTOMATED_FLAG", "AUTOMATED_FLAG_RULE")


@query
def classify_final(spark, sf_dir):
    return _final(spark, sf_dir).select(KEY, "FINAL_FLAG", "FINAL_FLAG_RULE")


# Reports


@query
def flag_counts(spark, sf_dir):
    return descriptives.flag_counts(_patterns(spark, sf_dir), tables.config())


@query
def flag_group_totals(spark, sf_dir):
    return descriptives.group_totals(_patterns(spark, sf_dir), tables.config())


@query
def any_flag_count(spark, sf_dir):
    return descriptives.any_flag_count(_patterns(spark, sf_dir), tables.config())


@query
def flag_group_crosstab(spark, sf_dir):
    return descriptives.flag_group_crosstab(_patterns(spark, sf_dir), tables.config())


@query
def classification_counts(spark, sf_dir):
    return descriptives.classification_counts(_automated(spark, sf_dir), "AUTOMATED_FLAG")


@query
def cooccurrence_flags(spark, sf_dir):
    return descriptives.cooccurrence(_patterns(spark, sf_dir), tables.config(), [jobs.AUTOMATED])


@query
def cooccurrence_groups(spark, sf_dir):
    return descriptives.cooccurrence(_patterns(spark, sf_dir), tables.config(), [jobs.AUTOMATED], use_groups=True)


@query
def cooccurrence_matrix(spark, sf_dir):
    """Square table of groups and the classes that occur, as rows (label_a, label_b, n) with zeros."""
    config = tables.config()
    table = sinks.stage_table(descriptives.patterns(_final(spark, sf_dir), config, _CLASSES), "patterns")
    matrix = descriptives.cooccurrence_matrix(table, config, _CLASSES, use_groups=True)
    cells = F.array(
        *[F.struct(F.lit(c).alias("label_b"), col_(c).alias("n")) for c in matrix.columns if c != "label"]
    )
    rows = matrix.select(F.col("label").alias("label_a"), F.inline(cells))
    own = rows.where("label_a = label_b").where((F.col("n") > 0) | F.col("label_a").isin(config.group_names))
    for side in ("label_a", "label_b"):
        rows = rows.join(own.select(F.col("label_a").alias(side)), side, "left_semi")
    return rows.select("label_a", "label_b", "n")


# Similar texts


@query
def similar_pairs(spark, sf_dir):
    return similarity.similar_pairs(tables.read(spark, sf_dir, "part"), "p_partkey", "p_name")


@query
def similar_pairs_ratio(spark, sf_dir):
    """Without sorting the tokens, at a higher threshold."""
    part = tables.read(spark, sf_dir, "part")
    return similarity.similar_pairs(part, "p_partkey", "p_name", 3, "ratio", 70)


@query
def similar_pairs_token_set(spark, sf_dir):
    part = tables.read(spark, sf_dir, "part")
    return similarity.similar_pairs(part, "p_partkey", "p_name", 7, "token_set_ratio", 80)


@query
def similar_pairs_conversations(spark, sf_dir):
    """All pairs of long texts, each of them whole."""
    turns = tables.read(spark, sf_dir, "conversations").selectExpr("conv_id * 100000 + turn AS response_id", "text")
    return similarity.similar_pairs(turns, KEY, "text")


@query
def similar_pairs_token_set_conversations(spark, sf_dir):
    """Pairs of long texts by the tokens they share, whatever else they hold; each text whole."""
    turns = tables.read(spark, sf_dir, "conversations").selectExpr("conv_id * 100000 + turn AS response_id", "text")
    return similarity.similar_pairs(turns, KEY, "text", 7, "token_set_ratio", 80)


@query
def similar_members(spark, sf_dir):
    """Who stands for each response in the pairs of similar texts."""
    return similarity.similar_members(tables.read(spark, sf_dir, "part"), "p_partkey", "p_name")


@query
def similar_counts(spark, sf_dir):
    part = tables.read(spark, sf_dir, "part")
    return similarity.similar_answers(
        part, "p_partkey", "p_name", count_name="FZ_COUNT_p_name", list_name=None
    )


@query
def similar_texts(spark, sf_dir):
    part = tables.read(spark, sf_dir, "part")
    found = similarity.similar_answers(part, "p_partkey", "p_name", threshold=75, list_name="FZ_SIMILAR_p_name")
    return found.select("p_partkey", "FZ_SIMILAR_p_name")


@query
def flag_similar_text(spark, sf_dir):
    """Similarity as a flag of its own."""
    flag = Flag("F_Similar", "check_SimilarText", None, {"column_name": "p_name", "threshold": 90})
    flagged = flagging.apply_flags(tables.read(spark, sf_dir, "part"), [flag], "p_partkey")
    return flagged.select("p_partkey", "FZ_COUNT_p_name", "F_Similar")


# Whole jobs


@query
def initial_classification(spark, sf_dir):
    return _automated(spark, sf_dir).drop("start_ts")


@query
def initial_descriptives(spark, sf_dir):
    flagged = sinks.stage_table(_automated(spark, sf_dir), "initial")
    return jobs.as_one_table(jobs.initial_reports(flagged, tables.config()))


@query
def final_classification(spark, sf_dir):
    return _final(spark, sf_dir).select(
        KEY, "AUTOMATED_FLAG", "AUTOMATED_FLAG_RULE", "MANUAL_FLAG", "MANUAL_COMMENT", "FINAL_FLAG", "FINAL_FLAG_RULE"
    )


@query
def final_descriptives(spark, sf_dir):
    final = sinks.stage_table(_final(spark, sf_dir), "final")
    return jobs.as_one_table(jobs.final_reports(final, tables.config()))


@query
def mark_similar(spark, sf_dir):
    part = tables.read(spark, sf_dir, "part").select("p_partkey", "p_name")
    return jobs.mark_similar(part, tables.config(), "p_partkey")
