"""Survey-like tables derived from the generated ones, in Spark and in SQL.

``responses`` turns each event into a survey response: the event time is the
start, its value the duration, purchases are completed surveys and errors are
screened-out ones. Ranges of IP addresses and country borders come from the
nations, one country each.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveysieve.config import Config, config_from_tables

# Corners of a country relative to its south-west one: an L shape that abuts the
# country east of it, a hole in it, and an island in its notch.
COUNTRY_RINGS = {
    1: [(0, 0), (70, 0), (70, 14), (30, 14), (30, 28), (0, 28)],
    2: [(5, 5), (15, 5), (15, 12), (5, 12)],
    3: [(42, 18), (66, 18), (54, 27)],
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    question = "CASE WHEN event_id % 13 = {a} THEN -99 WHEN event_id % 17 = {a} THEN NULL ELSE (event_id * {p} + user_id) % 7 + 1 END AS q{a}"
    return read(spark, sf_dir, "events").selectExpr(
        "event_id AS response_id",
        "ts AS start_ts",
        "value AS duration",
        "concat('10.', user_id % 50, '.', event_id % 8, '.', event_id % 200) AS ip",
        "CASE WHEN event_type = 'purchase' THEN value END AS success",
        "CASE WHEN event_type = 'error' THEN 'Screened' END AS terminate",
        "cast(get_json_object(props, '$.k') AS int) AS progress",
        *[question.format(a=a, p=p) for a, p in ((1, 3), (2, 5), (3, 11), (4, 19))],
        "CASE WHEN event_id % 9 != 0 THEN event_id % 5 + 1 END AS instructed",
        "CASE WHEN event_id % 19 != 0 THEN (event_id * 37 % 1700) / 10.0D - 85.0D END AS latitude",
        "CASE WHEN event_id % 19 != 0 THEN (event_id * 91 % 3590) / 10.0D - 179.5D END AS longitude",
    )


def manual_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels a reviewer entered for every 50th response."""
    return (
        read(spark, sf_dir, "events")
        .where("event_id % 50 = 0")
        .selectExpr(
            "event_id AS response_id",
            "CASE WHEN event_id % 100 = 0 THEN 'FRAUD' ELSE 'VALID' END AS MANUAL_FLAG",
            "concat('seen as ', event_type) AS MANUAL_COMMENT",
        )
    )


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free-text answers: a document, and its first line as the answer to another question."""
    return read(spark, sf_dir, "documents").selectExpr(
        "doc_id AS response_id", "text", "substring_index(text, '\\n', 1) AS headline"
    )


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two name fields: a part and the one after it."""
    part = read(spark, sf_dir, "part")
    following = part.selectExpr("p_partkey - 1 AS p_partkey", "p_name AS last_name")
    return part.join(following, "p_partkey", "left").selectExpr(
        "p_partkey AS response_id", "p_name AS first_name", "last_name"
    )


def ip_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "nation").selectExpr(
        "167772160 + n_nationkey * 131072L + 768 AS start_ip",
        "167772160 + n_nationkey * 131072L + 768 + 66560 AS end_ip",
        "n_nationkey * 1.5D AS lat",
        "n_nationkey * -2.0D AS lon",
        "n_name AS country",
        "concat('STATE_', n_regionkey) AS state",
        "CASE WHEN n_nationkey % 6 != 0 THEN concat('CITY_', n_nationkey) END AS city",
    )


def ip_ranges_v6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Networks of IPv6 addresses, one inside the other, of which the inner ones are narrow ranges."""
    place = [
        "n_nationkey * 1.5D AS lat",
        "n_nationkey * -2.0D AS lon",
        "concat({}, n_name) AS country",
        "concat('STATE_', n_regionkey) AS state",
        "cast(NULL AS string) AS city",
    ]
    nation = read(spark, sf_dir, "nation").withColumn("net", F.lower(F.hex(F.col("n_nationkey") * 2)))
    ends = [
        ("'2001:db8:' || net || '::'", "'2001:db8:' || lower(hex(n_nationkey * 2 + 1)) || ':0::3:ffff'", "''"),
        ("'2001:0DB8:' || net || '::1:10'", "'2001:db8:' || net || '::6:0'", "'IN_'"),
        ("'2001:db8:' || net || ':0:0:0:2:0'", "'2001:db8:' || net || '::2:80'", "'DEEP_'"),
    ]
    nets = [
        nation.selectExpr(f"{start} AS start_ip", f"{end} AS end_ip", *(p.format(name) for p in place))
        for start, end, name in ends
    ]
    return nets[0].unionByName(nets[1]).unionByName(nets[2])


def polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    west = F.col("n_nationkey") % 5 * 70 - 175
    south = F.floor(F.col("n_nationkey") / 5) * 32 - 80
    rings = F.array(
        *[
            F.struct(
                F.lit(ring).alias("ring_id"),
                F.array(
                    *[
                        F.struct((west + x).cast("double").alias("lon"), (south + y).cast("double").alias("lat"))
                        for x, y in corners
                    ]
                ).alias("vertices"),
            )
            for ring, corners in COUNTRY_RINGS.items()
        ]
    )
    return read(spark, sf_dir, "nation").select(
        F.col("n_name").alias("name"), F.format_string("N%02d", "n_nationkey").alias("iso3"), F.inline(rings)
    )


def config() -> Config:
    """Flags and rules over ``responses``."""

    def flag(name, method, group, **parameters):
        return {
            "flag_name": name, "method_name": method, "flag_group": group, "use_flag": 1, "parameters": parameters,
        }

    def rules(*rows):
        return [
            {"rule_num": n, "condition_expr": c, "classification": label, "use_rule": used}
            for n, c, label, used in rows
        ]

    attempts = {"column_ip": "ip", "column_success": "success"}
    return config_from_tables(
        {
            "flags": [
                flag("F_ShortDuration", "check_ValueInRange", "FG_Speed",
                     column_name="duration", lower_threshold="-inf", upper_threshold=5),
                flag("F_ManyAttempts", "check_MultipleIPAttempts", "FG_Network", **attempts, num_attempts_lower=10),
                flag("F_SomeAttempts", "check_MultipleIPAttempts", "FG_Network", **attempts,
                     num_attempts_lower=8, num_attempts_upper=9),
                flag("F_FailedAttempts", "check_MultipleIPAttempts", "FG_Network", **attempts,
                     num_attempts_lower=9, attempt_type="failed", column_terminate="terminate"),
                flag("F_Incomplete", "check_ValueInRange", "FG_Incomplete",
                     column_name="progress", lower_threshold=0, upper_threshold=19),
                flag("F_Burst", "check_BurstResponses", "FG_Speed", column_start_time="start_ts",
                     column_duration="duration", max_start_time_difference=120, max_duration_difference=2.0),
                flag("F_Instructed", "check_CustomCondition", "FG_Answers",
                     condition="instructed IS NOT NULL AND NOT (instructed <=> 2)"),
                flag("F_Contradiction", "check_ReverseCodedResponse", "FG_Answers", positive_columns=["q1", "q2"],
                     negative_columns=["q3", "q4"], min_score=1, max_score=7, max_correlation=0.25),
                flag("F_Both", "check_CustomCondition", None, condition="F_Instructed AND F_Contradiction"),
                {**flag("F_Off", "check_CustomCondition", "FG_Off", condition="true"), "use_flag": 0},
            ],
            "initial_classification_rules": rules(
                ("1", "FG_Incomplete > 0", "INCOMPLETE", 1),
                ("2.1", "FG_Speed > 1 or FG_Network > 1", "FRAUD", 1),
                ("2.2", "FG_Network > 0 and FG_Answers > 0", "FRAUD", 1),
                ("3", "TRUE", "FRAUD", 0),
                ("4", "FG_Speed > 0 or F_Both", "TBD", 1),
                ("5", "FG_Network", "TBD", 1),
            ),
            "final_classification_rules": rules(
                ("1.1", "AUTOMATED_FLAG == 'INCOMPLETE'", "INCOMPLETE", 1),
                ("2.1", "AUTOMATED_FLAG == 'FRAUD' and not (MANUAL_FLAG <=> 'VALID')", "FRAUD", 1),
                ("2.2", "MANUAL_FLAG == 'FRAUD'", "FRAUD", 1),
                ("5", True, "VALID", 1),
            ),
            "fuzzy_string": [
                {"column": "p_name", "minimum_length": "", "fuzzy_algorithm": "", "threshold": ""}
            ],
        }
    )
