"""Writing results: Parquet between steps, CSV for people, one table per report."""

from __future__ import annotations

import gc
import os
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# The same for writing and reading, so that what is written is what is read.
CSV_OPTIONS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Parquet for the next step; returns the table as written, which also cuts the lineage."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write a table of its own in the shared folder, where the checks can read single columns of it.

    It is removed at the end of the ``stages`` block around the call, if there is one.
    """
    return write_table(df, _stage_path(df.sparkSession, name))


def stage_rounds(spark: SparkSession, rounds: Iterable[DataFrame], schema: str, name: str) -> DataFrame:
    """``stage_table`` of what one round after the other gives; the shuffle files of each are let go of before the next."""
    path = _stage_path(spark, name)
    spark.createDataFrame([], schema).write.parquet(path)
    for number, df in enumerate(rounds):
        if number:
            gc.collect()
            spark._jvm.System.gc()
        df.write.mode("append").parquet(path)
        del df
    return spark.read.schema(schema).parquet(path)


def _stage_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark).rstrip('/')}/surveysieve-{name}-{uuid.uuid4().hex}"
    open_stages = _stages.get()
    if open_stages is not None:
        open_stages.append(path)
    return path


@contextmanager
def stages(spark: SparkSession) -> Iterator[None]:
    """Removes the tables staged inside the block at its end; results must be written by then."""
    paths: list[str] = []
    token = _stages.set(paths)
    try:
        yield
    finally:
        _stages.reset(token)
        for path in paths:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def stage_result(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """``stage_table`` of what ``make`` returns; tables that it stages itself are removed once this one is written."""
    around = _stages.get()
    with stages(spark):
        result = make()
        token = _stages.set(around)
        try:
            return stage_table(result, name)
        finally:
            _stages.reset(token)


_stages: ContextVar[list[str] | None] = ContextVar("stages", default=None)


def write_csv(df: DataFrame, path: str, key: str | None = None) -> None:
    """CSV with a header, for review; every character of an answer is kept."""
    if key is not None:
        df = df.orderBy(key)
    _replace(df.sparkSession, path, lambda aside: df.write.options(**CSV_OPTIONS).csv(aside))


def write_report(df: DataFrame, folder: str, name: str) -> None:
    """One report table; replaces the table of that name only."""
    _replace(df.sparkSession, os.path.join(folder, name), df.write.parquet)


def _replace(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Writes a table aside and puts it in the place of an earlier one when it is whole.

    If writing fails, the earlier table stays as it is; if the switch fails, it is put back. ``path`` may
    be what the new table is made from.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())

    def beside(kind: str):
        # Names that begin like this are no data for readers of the folder.
        return spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f"_{place.getName()}.{kind}-{uuid.uuid4().hex}")

    aside, earlier = beside("new"), beside("old")
    try:
        write(aside.toString())
        there = files.exists(place)
        if there and not files.rename(place, earlier):
            raise OSError(f"cannot move {path} aside")
        if not files.rename(aside, place):
            if there:
                files.rename(earlier, place)
            raise OSError(f"cannot put a new table at {path}")
    except BaseException:
        files.delete(aside, True)
        raise
    files.delete(earlier, True)


def read_report(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, name))


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors reach: the cluster's checkpoint folder, ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return folder
