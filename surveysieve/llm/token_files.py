"""Token sequences of equal length in Arrow files, read in place."""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surveysieve.llm.common import open_filesystem, pick, run_folder, slices, texts_of
from surveysieve.llm.tokenizer import spaced_ids
from surveysieve.sources.sinks import stage_table

# Sequences in a record batch: what a reader maps at once.
BATCH_SEQUENCES = 256

# Bytes of text that a writing task encodes at once.
WRITE_BYTES = 6_000_000

_DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def ids_type(largest: int) -> pa.DataType:
    """The narrowest type that holds all ids of a vocabulary."""
    return pa.uint16() if largest < 2**16 else pa.uint32()


def sequences_schema(width: int, kind: pa.DataType) -> pa.Schema:
    """Sequences of ``width`` ids, and masks that tell ids from padding."""
    return pa.schema([("ids", pa.list_(kind, width)), ("mask", pa.list_(pa.bool_(), width))])


class TokenWriter:
    """Writes a stream of documents' ids as sequences without gaps, and where each document is.

    ``<name>.arrow`` holds the sequences, ``<name>.docs.arrow`` doc_id, start and
    n_tokens of each document, in order. Only the last sequence is padded.
    """

    def __init__(self, folder: str, name: str, width: int, kind: pa.DataType):
        filesystem, path = open_filesystem(folder)
        filesystem.create_dir(path, recursive=True)
        self.width, self.kind = width, kind
        self.dtype = np.dtype(kind.to_pandas_dtype())
        self._schema = sequences_schema(width, kind)
        self._streams = [filesystem.open_output_stream(f"{path}/{name}{end}") for end in (".arrow", ".docs.arrow")]
        self._sequences = pa.ipc.new_file(self._streams[0], self._schema)
        self._docs = pa.ipc.new_file(self._streams[1], _DOCS)
        self._pending: list[np.ndarray] = []
        self._rows: list[tuple] = []
        self._n_pending = self.n_ids = self.n_docs = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self._rows.append((doc_id, self.n_ids, len(ids)))
        self._pending.append(ids.astype(self.dtype))
        self._n_pending += len(ids)
        self.n_ids, self.n_docs = self.n_ids + len(ids), self.n_docs + 1
        if self._n_pending >= self.width * BATCH_SEQUENCES:
            self._write(last=False)
        if len(self._rows) >= 10_000:
            self._write_rows()

    def _write(self, last: bool) -> None:
        flat = np.concatenate([np.zeros(0, dtype=self.dtype), *self._pending])
        batch = self.width * BATCH_SEQUENCES
        while len(flat) >= batch or (last and len(flat)):
            part, flat = flat[:batch], flat[batch:]
            size = -(-len(part) // self.width) * self.width
            ids = np.zeros(size, dtype=self.dtype)
            ids[: len(part)] = part
            mask = pa.array(np.arange(size) < len(part))
            columns = [
                pa.FixedSizeListArray.from_arrays(pa.array(ids, self.kind), type=self._schema.field(0).type),
                pa.FixedSizeListArray.from_arrays(mask, type=self._schema.field(1).type),
            ]
            self._sequences.write_batch(pa.RecordBatch.from_arrays(columns, schema=self._schema))
        self._pending, self._n_pending = [flat], len(flat)

    def _write_rows(self) -> None:
        if self._rows:
            columns = [pa.array(column, pa.int64()) for column in zip(*self._rows, strict=True)]
            self._docs.write_batch(pa.RecordBatch.from_arrays(columns, schema=_DOCS))
            self._rows = []

    def close(self) -> None:
        self._write(last=True)
        self._write_rows()
        for writer in (self._sequences, self._docs):
            writer.close()
        for stream in self._streams:
            stream.close()


class TokenFile:
    """Random access to a file of sequences: batches are mapped, not read, where the file system can."""

    def __init__(self, folder: str, name: str):
        filesystem, path = open_filesystem(folder)
        self._readers = [pa.ipc.open_file(_source(filesystem, f"{path}/{name}{end}")) for end in (".arrow", ".docs.arrow")]
        self.width = self._readers[0].schema.field("ids").type.list_size
        self._held: tuple[int, np.ndarray, pa.Array] | None = None

    def _batch(self, number: int) -> tuple[int, np.ndarray, pa.Array]:
        if self._held is None or self._held[0] != number:
            batch = self._readers[0].get_batch(number)
            ids, mask = batch.column(0), batch.column(1)
            start, end = ids.offset * self.width, (ids.offset + len(ids)) * self.width
            self._held = number, ids.values.to_numpy(zero_copy_only=True)[start:end], mask
        return self._held

    def sequence(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids (a view of the file) and mask of one sequence."""
        _, flat, masks = self._batch(number // BATCH_SEQUENCES)
        place = number % BATCH_SEQUENCES
        mask = masks[place].values.to_numpy(zero_copy_only=False)
        return flat[place * self.width : (place + 1) * self.width], mask

    def ids(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from ``start`` on; a view of the file if they lie in one batch."""
        size, parts = self.width * BATCH_SEQUENCES, []
        while n:
            number, place = divmod(start, size)
            part = self._batch(number)[1][place : place + n]
            if not len(part):
                raise ValueError("there are not as many ids in this file")
            parts.append(part)
            start, n = start + len(part), n - len(part)
        return parts[0] if len(parts) == 1 else np.concatenate([np.zeros(0, dtype=np.uint16), *parts])

    def documents(self) -> Iterator[pa.RecordBatch]:
        reader = self._readers[1]
        for number in range(reader.num_record_batches):
            yield reader.get_batch(number)


def _source(filesystem, path: str):
    return pa.memory_map(path) if filesystem.type_name == "local" else filesystem.open_input_file(path)


_FILES = "part long, file string, n_docs long, n_ids long"


def write(docs: DataFrame, tokenizer: str, folder: str, width: int = 2048, end_id: int = 2) -> DataFrame:
    """Encodes the whole texts of ``docs`` (doc_id, text) and writes their ids in ascending doc_id order.

    Returns one row per file, to be stored before it is used: part (files in
    this order hold the documents in order), file, n_docs and n_ids. Texts move
    once, sorted by ranges of doc_id; each task writes one file as it encodes. A
    task that is run again writes a file of another name, and only the one whose
    row is kept counts.

    A null text is empty and consists of the end id. A null doc_id comes first.
    Rows with the same doc_id are ordered by text. Other columns are ignored.
    """
    with open(tokenizer, encoding="utf-8") as file:
        model = json.load(file)
    largest = max([end_id, *model["model"]["vocab"].values(), *(token["id"] for token in model["added_tokens"])])
    kind, end = ids_type(largest), struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, writer = TaskContext.get(), None
        name = f"tokens-{context.partitionId():05d}-{context.taskAttemptId()}"
        for batch in slices(batches, most=WRITE_BYTES):
            for doc_id, ids in zip(
                batch.column(0).to_pylist(), spaced_ids(tokenizer, texts_of(batch.column(1))), strict=True
            ):
                if writer is None:
                    writer = TokenWriter(folder, name, width, kind)
                writer.add(doc_id, np.frombuffer(ids + end, dtype="<u4"))
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict(
                {"part": [context.partitionId()], "file": [name], "n_docs": [writer.n_docs], "n_ids": [writer.n_ids]}
            )

    return (
        pick(docs, "doc_id", "text")
        .repartitionByRange(F.asc_nulls_first("doc_id"))
        .sortWithinPartitions(F.asc_nulls_first("doc_id"), "text")
        .mapInArrow(run, _FILES)
    )


_READ = "doc_id long, start long, n_tokens long, ids binary"


def read(files: DataFrame, folder: str) -> DataFrame:
    """The documents of the files that ``write`` returned: doc_id, start, n_tokens, ids.

    ``start`` counts the ids of all documents before, in all files; ``ids`` are
    little-endian unsigned 32-bit integers.
    """
    before = F.coalesce(
        # One row per file.
        F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                tokens = TokenFile(folder, name)
                for docs in tokens.documents():
                    for start in range(0, docs.num_rows, 500):
                        yield _documents(tokens, docs.slice(start, 500), first)

    placed = files.select("file", before.alias("before"))
    return placed.repartition(max(1, files.count()), "file").mapInArrow(run, _READ)


def _documents(tokens: TokenFile, docs: pa.RecordBatch, first: int) -> pa.RecordBatch:
    starts, sizes = docs.column(1).to_pylist(), docs.column(2).to_pylist()
    ids = [tokens.ids(start, n).astype("<u4").tobytes() for start, n in zip(starts, sizes, strict=True)]
    columns = [docs.column(0), pa.array([first + start for start in starts], pa.int64()), docs.column(2), pa.array(ids, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, [field.split()[0] for field in _READ.split(", ")])


def write_and_read(docs: DataFrame, tokenizer: str, folder: str | None = None, width: int = 2048, end_id: int = 2) -> DataFrame:
    """Writes the documents' ids to files and reads them back; see ``write`` and ``read``. No rows give no files and no rows."""
    folder = folder or run_folder(docs.sparkSession, "tokens")
    files = stage_table(write(docs, tokenizer, folder, width, end_id), "token-files")
    return read(files, folder)
