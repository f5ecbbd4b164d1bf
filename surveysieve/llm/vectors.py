"""Embeddings as vectors of whole numbers, and sums over all of them that tasks add up."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveysieve.llm.common import pick

SCALE = 256.0
# Beyond this, squared distances of long vectors and their sums leave the range of 64-bit integers.
LARGEST = 2**27


def whole_vectors(df: DataFrame, *kept: str, vector: str = "embedding") -> DataFrame:
    """The columns ``kept`` of those rows that have a usable vector, and ``x``, its components times 256, rounded down.

    Dropped are rows whose vector is null or empty, or holds a null, a NaN or an
    infinity. A component of 2**19 or more in size is an error: sums of its
    squares would not be exact.
    """
    rows = pick(df, *kept, vector)
    components = F.col(vector)
    infinite = F.lit(float("inf"))

    def unusable(c: Column) -> Column:
        return c.isNull() | F.isnan(c) | (F.abs(c) == infinite)

    x = F.transform(components, lambda c: F.floor(c.cast("double") * SCALE))
    too_large = F.exists(x, lambda c: F.abs(c) > LARGEST)
    usable = rows.where((F.size(components) > 0) & ~F.exists(components, unusable))
    checked = F.when(too_large, F.raise_error(F.lit("a component is too large for exact sums"))).otherwise(F.col("x"))
    return usable.withColumn("x", x).select(*kept, checked.alias("x"))


def matrix(column: pa.ListArray) -> np.ndarray:
    """The vectors of a batch as rows of a matrix; all must have as many components."""
    lengths = np.diff(column.offsets.to_numpy())
    if len(lengths) and (lengths != lengths[0]).any():
        raise ValueError("vectors differ in their number of components")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(lengths), -1)


def added_up(df: DataFrame, part: Callable[[np.ndarray], np.ndarray], cells: int, kind: type = np.int64) -> np.ndarray:
    """The sum over all rows of ``part``, which makes an array of ``cells`` numbers of a batch's matrix.

    ``df`` has the vectors as its only column. Each task adds up its own
    batches; their sums meet cell by cell, so the driver gets ``cells`` numbers.
    """

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, dtype=kind)
        seen = False
        for batch in batches:
            if batch.num_rows:
                total += part(matrix(batch.column(0)))
                seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(cells, dtype=np.int32)), pa.array(total)], ["cell", "value"])

    name = "long" if kind is np.int64 else "double"
    sums = df.mapInArrow(task, f"cell int, value {name}").groupBy("cell").agg(F.sum("value").alias("value")).collect()
    total = np.zeros(cells, dtype=kind)
    for row in sums:
        total[row["cell"]] = row["value"]
    return total
