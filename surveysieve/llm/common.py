"""Helpers shared by the operators: input columns, tables, shared files, cached encoding."""

from __future__ import annotations

import gc
import os
import sys
import uuid
from collections.abc import Callable, Iterable, Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveysieve.sources.sinks import shared_folder

# Bytes of text handled at once inside a task, a row counting as ROW_BYTES at least:
# bounds its memory whatever the size of Spark's batches.
SLICE_BYTES = 4_000_000
ROW_BYTES = 200


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, by exact name: others that clash in case or repeat a name do no harm."""
    positions = [df.columns.index(name) for name in names]
    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    return plain.select(*(F.col(f"c{i}").alias(name) for i, name in zip(positions, names, strict=True)))


def packed(df: DataFrame, *names: str) -> DataFrame:
    """The named columns, and the whole row as ``row``; see ``unpacked``."""
    positions = [df.columns.index(name) for name in names]
    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    named = [F.col(f"c{i}").alias(name) for i, name in zip(positions, names, strict=True)]
    return plain.select(*named, F.struct(*plain.columns).alias("row"))


def unpacked(df: DataFrame, like: DataFrame) -> DataFrame:
    """The whole rows of ``packed`` again, under their first names."""
    columns = [F.col(f"row.c{i}").alias(name) for i, name in enumerate(like.columns)]
    return df.select(*columns)


def sampled(df: DataFrame, most: int, *by: str) -> DataFrame:
    """About ``most`` rows, those whose hashes of some columns are small; all rows if there are fewer."""
    total = df.count()
    if total <= most:
        return df
    return df.where(F.pmod(F.xxhash64(*by), F.lit(2**31)) < int(2**31 * most / total))


def release(spark: SparkSession) -> None:
    """Has the driver collect its garbage, so that executors drop the shuffle files of steps that are written and done."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder's place among the files that all executors share."""
    return f"{shared_folder(spark).rstrip('/')}/surveysieve-{name}-{uuid.uuid4().hex}"


def open_filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system that holds a folder, and the folder's path there; works on any executor."""
    if folder.startswith("file:"):
        folder = "/" + folder[len("file:") :].lstrip("/")
    if "://" in folder:
        return pafs.FileSystem.from_uri(folder)
    return pafs.LocalFileSystem(), os.path.abspath(folder)


def slices(batches: Iterable[pa.RecordBatch], text: int = 1, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts batches where the texts of a column reach ``most`` bytes; a longer text stands alone."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths + ROW_BYTES)
        start = 0
        while start < batch.num_rows:
            so_far = int(ends[start - 1]) if start else 0
            end = max(start + 1, int(np.searchsorted(ends, so_far + most, side="right")))
            yield batch.slice(start, end - start)
            start = end


def texts_of(column: pa.Array) -> list[str]:
    """Python texts, nulls as empty."""
    return [text or "" for text in column.to_pylist()]


def on_worker(key: tuple, make: Callable):
    """An object kept until one of another key is asked for: for a task where this package travels with the job, else for the worker."""
    if key not in _KEPT:
        _KEPT.clear()
        _process().clear()
        _KEPT[key] = make()
    return _KEPT[key]


def on_process(key: tuple, make: Callable):
    """An object kept for all tasks of a Python worker, until one of another key is asked for."""
    kept = _process()
    if key not in kept:
        kept.clear()
        _KEPT.clear()
        kept[key] = make()
    return kept[key]


def _process() -> dict:
    # This package travels with the job, and each task has its globals anew; a module that does not travel outlasts them.
    return sys.modules.setdefault("surveysieve_process", ModuleType("surveysieve_process")).__dict__.setdefault("kept", {})


_KEPT: dict = {}
