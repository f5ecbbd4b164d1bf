"""Short codes of vectors: each part of a vector by the number of its nearest codebook entry.

Components are whole numbers, and a dimension of a batch has few different ones.
So each batch gets a dictionary per dimension, and a table with the squared
differences of every distinct number to all entries; the distances of a part to
all its entries are then looked up by dictionary code and added, never computed
again for a number that was seen before. All sums are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveysieve.llm.vectors import added_up, matrix, whole_vectors
from surveysieve.operators.skew import is_small, join_lookup
from surveysieve.sources.sinks import stage_table

PARTS, ENTRIES, ROUNDS = 16, 64, 2
# Vectors whose distances to all entries are held at once.
_ROWS = 4_096


@dataclass(frozen=True)
class Codebooks:
    """``entries[part, entry]`` is a whole-numbered vector of a part's length."""

    entries: np.ndarray

    @property
    def dimensions(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def sha256(self) -> str:
        """Digest of all components as decimal text, by part, entry and place."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per row and part, the first of the nearest entries, and the squared distance to it."""
        parts, n_entries, width = self.entries.shape
        if x.shape[1] != self.dimensions:
            raise ValueError(f"a vector has {x.shape[1]} components instead of {self.dimensions}")
        found = np.empty((len(x), parts), dtype=np.int64)
        distance = np.empty((len(x), parts), dtype=np.int64)
        for start in range(0, len(x), _ROWS):
            rows = slice(start, start + _ROWS)
            for part in range(parts):
                sums = np.zeros((len(x[rows]), n_entries), dtype=np.int64)
                for place in range(width):
                    values, codes = np.unique(x[rows, part * width + place], return_inverse=True)
                    table = (values[:, None] - self.entries[part, :, place]) ** 2
                    sums += table[codes]
                found[rows, part] = sums.argmin(axis=1)
                distance[rows, part] = np.take_along_axis(sums, found[rows, part, None], axis=1)[:, 0]
        return found, distance


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks from all rows of ``vectors`` (vec_id, x); None if there are none.

    They start as the parts of the vectors with the smallest ids, a missing id
    coming last and equal ids by their components. Each round moves every
    entry to the mean of its parts, rounded down; an entry without parts stays.
    """
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).select("x").collect()
    if not first:
        return None
    lengths = {len(row["x"]) for row in first}
    if len(lengths) > 1 or min(lengths) % parts:
        raise ValueError(f"vectors of {sorted(lengths)} components cannot be cut into {parts} equal parts")
    start = np.array([row["x"] for row in first], dtype=np.int64)
    books = Codebooks(np.ascontiguousarray(start.reshape(len(start), parts, -1).transpose(1, 0, 2)))
    for _ in range(rounds):
        books = _moved(books, vectors)
    return books


def _moved(books: Codebooks, vectors: DataFrame) -> Codebooks:
    parts, n_entries, width = books.entries.shape

    def sums(x: np.ndarray) -> np.ndarray:
        """Counts of all entries, and behind them the sums of their parts."""
        found, _ = books.nearest(x)
        cell = found + np.arange(parts) * n_entries
        counts = np.bincount(cell.ravel(), minlength=parts * n_entries)
        totals = np.zeros((parts * n_entries, width), dtype=np.int64)
        np.add.at(totals, cell.ravel(), x.reshape(len(x) * parts, width))
        return np.concatenate([counts, totals.ravel()])

    cells = parts * n_entries
    total = added_up(vectors.select("x"), sums, cells * (1 + width))
    counts = total[:cells].reshape(parts, n_entries, 1)
    totals = total[cells:].reshape(parts, n_entries, width)
    return Codebooks(np.where(counts > 0, totals // np.maximum(counts, 1), books.entries))


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """The columns of ``vectors`` but x, with ``code`` (a byte per part) and ``error`` (squared distance of the whole vector)."""
    others = [c for c in vectors.columns if c != "x"]
    schema = vectors.select(*others).schema.add("code", T.BinaryType()).add("error", T.LongType())

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found, distance = books.nearest(matrix(batch.column("x")))
            codes = found.astype(np.uint8).tobytes()
            width = found.shape[1]
            code = pa.array([codes[i : i + width] for i in range(0, len(codes), width)], pa.binary())
            columns = [batch.column(c) for c in others] + [code, pa.array(distance.sum(axis=1))]
            yield pa.RecordBatch.from_arrays(columns, [*others, "code", "error"])

    return vectors.select(*others, "x").mapInArrow(task, schema)


def compress(
    embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, vector: str = "embedding"
) -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256) of every usable row of ``embeddings``.

    ``label_error`` is the error of all rows of the same label together, rows
    without a label being one group. At most 256 entries fit a byte.

    Rows whose vector is null or empty, or holds a null, a NaN or an infinity
    are dropped. Of equally near entries the first counts. Repeated rows and ids
    are rows of their own. If there are fewer rows than entries, codebooks have
    as many entries as rows. No rows give no rows. Vectors that differ in length or
    cannot be cut evenly, and components of 2**19 or more, are errors. Other columns
    are ignored.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has a byte per part, so there can be 1 to 256 entries")
    vectors = stage_table(whole_vectors(embeddings, "vec_id", "label", vector=vector), "vectors")
    books = train(vectors, parts, entries, rounds)
    if books is None:
        books = Codebooks(np.zeros((parts, 1, 1), dtype=np.int64))
    encoded = stage_table(encode(vectors, books), "codes")
    # A label may be missing, and may be one of a few or nearly one per row.
    keyed = encoded.withColumn("unlabelled", F.col("label").isNull()).withColumn(
        "group", F.coalesce("label", F.lit(0).cast(encoded.schema["label"].dataType))
    )
    sums = keyed.groupBy("unlabelled", "group").agg(F.sum("error").alias("label_error"))
    joined = join_lookup(keyed, sums, ["unlabelled", "group"], F.col("code"), is_small(sums))
    return joined.select("vec_id", "label", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))
