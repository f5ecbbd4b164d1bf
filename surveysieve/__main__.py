"""Command line: python -m surveysieve STEP CONFIG

Steps: initial, initial-reports, final, final-reports, similar. Paths come from
the table ``filepaths`` of the configuration.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from surveysieve.config import Config, load_config
from surveysieve.plans import jobs
from surveysieve.sources import responses, sinks
from surveysieve.sources.ip_ranges import read_ip_ranges
from surveysieve.sources.polygons import read_polygons

_LOOKUPS = {"ip_ranges": ("ip_range_file", read_ip_ranges), "polygons": ("world_shape_file", read_polygons)}


def _read(
    spark: SparkSession, config: Config, parameter: str, key: str | None, schema: str | None, multi_line: bool
) -> DataFrame:
    path = config.path(parameter)
    if not path.endswith((".csv", ".csv.gz")):
        return responses.read_parquet(spark, path, key)
    # Text files are read once; the checks then read the few columns they need from the table.
    return sinks.stage_table(responses.read_csv(spark, path, schema, key, multi_line), parameter)


def _write(df: DataFrame, config: Config, parameter: str, key: str) -> None:
    path = config.path(parameter)
    if path.endswith(".csv"):
        sinks.write_csv(df, path, key)
    else:
        sinks.write_table(df, path)


def run(
    spark: SparkSession,
    step: str,
    config: Config,
    key: str | None = None,
    schema: str | None = None,
    multi_line: bool = False,
) -> None:
    with sinks.stages(spark):
        _run(spark, step, config, key, schema, multi_line)


def _run(spark: SparkSession, step: str, config: Config, key: str | None, schema: str | None, multi_line: bool) -> None:
    name = key or responses.KEY
    if step == "initial":
        lookups = {
            table: read(spark, config.path(path))
            for table, (path, read) in _LOOKUPS.items()
            if path in config.filepaths
        }
        df = _read(spark, config, "data_file", key, schema, multi_line)
        _write(jobs.initial_classification(df, config, name, lookups), config, "flagged_file", name)
    elif step == "final":
        df = _read(spark, config, "manual_file", key, schema, multi_line)
        jobs.warn_without_labels(df)
        _write(jobs.final_classification(df, config, name), config, "final_output_file", name)
    elif step == "similar":
        df = _read(spark, config, "data_file", key, schema, multi_line)
        _write(jobs.mark_similar(df, config, name), config, "fuzzy_file", name)
    else:
        initial = step == "initial-reports"
        df = _read(spark, config, "flagged_file" if initial else "final_output_file", key, schema, multi_line)
        reports = jobs.initial_reports(df, config) if initial else jobs.final_reports(df, config)
        for table, report in reports.items():
            sinks.write_report(report, config.path("descriptives_file"), table)


def main() -> None:
    parser = argparse.ArgumentParser(prog="surveysieve", description=__doc__)
    parser.add_argument("step", choices=["initial", "initial-reports", "final", "final-reports", "similar"])
    parser.add_argument("config", help="JSON file or folder of CSV tables")
    parser.add_argument("--key", help="column that identifies a response; default: row numbers are added")
    parser.add_argument(
        "--schema", help="columns and types of the CSV files, which are then read once instead of twice"
    )
    parser.add_argument(
        "--multi-line", action="store_true", help="answers in CSV files hold line breaks; each file is read by one task"
    )
    given = parser.parse_args()
    spark = SparkSession.builder.appName("surveysieve").getOrCreate()
    run(spark, given.step, load_config(given.config), given.key, given.schema, given.multi_line)


if __name__ == "__main__":
    main()
