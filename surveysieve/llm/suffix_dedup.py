"""Removes passages that occur more than once, found in merged Burrows-Wheeler transforms.

Every run of ``length`` bytes (a window) has an anchor: of the ``GRAM`` bytes long
grams in it, the one with the smallest hash. Equal windows have equal anchors, so
only the surroundings of anchors that occur more than once can hold repeats,
and windows need to meet only others of their anchor. Consecutive windows of one
anchor form a piece of text; equal pieces are combined. The pieces of an anchor are cut
into shards, whose transforms are built alone and merged (``bwt``); intervals of
suffixes that share ``length`` bytes tell which windows are repeated.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveysieve.llm import bwt
from surveysieve.llm.common import pick, release, slices
from surveysieve.llm.hashing import mixed
from surveysieve.operators.skew import join_per_key
from surveysieve.sources.sinks import stage_result, stage_table

LENGTH = 200
# An anchor's length; and the grams by which transforms are sorted, which must divide LENGTH.
GRAM, STEP = 40, 50
# Windows in a piece at most, and windows whose anchors are found at once.
PIECE_WINDOWS, BLOCK = 4_096, 1 << 20
# Text of the pieces of one anchor beyond which they are parted further, text merged at once, and text of a shard.
GROUP_BYTES, BATCH_BYTES, SHARD_BYTES = 1_500_000, 1_000_000, 250_000
# Texts whose digests a task remembers, so that it sends copies of a text once.
KEPT_TEXTS = 1_000_000

_PLACE = "struct<holder: binary, anchor: bigint, first: int>"
_MEMBERS = f"place {_PLACE}, anchor bigint, piece binary, windows int, core int, text binary, copied boolean"
_SPANS = "array<struct<start: int, stop: int>>"


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, step: int = STEP, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of each row of ``docs`` (doc_id, text).

    ``spans`` are the maximal runs of bytes, as (start, stop), that are covered by a
    string of ``length`` bytes which also starts anywhere else, in the same text or
    another one; ``kept`` is the rest of the text's UTF-8 bytes, which may cut a
    character. All is judged on the input.

    A null text is empty, and texts shorter than ``length`` are kept whole. Rows
    that repeat a text (or an id) are rows of their own, so their texts repeat each
    other. No rows give no rows. Other columns are ignored.
    """
    if not 0 < gram <= length or length % step:
        raise ValueError("gram must be at most length, and step must divide length")
    text = F.coalesce("text", F.lit(""))
    rows = pick(docs, "doc_id", "text").select("doc_id", text.alias("text"))
    # Texts go by 128 bits of their digest.
    rows = rows.withColumn("digest", F.substring(F.unhex(F.sha2(F.col("text").cast("binary"), 256)), 1, 16))
    # Written before the texts move again, so that the tables of pieces and their shuffle files can go.
    spans = stage_result(rows.sparkSession, lambda: repeated_spans(rows, length, gram, step, group_bytes), "spans")
    release(rows.sparkSession)
    cut = rows.join(spans, "digest", "left").select("doc_id", F.col("text").cast("binary"), "spans")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return cut.mapInArrow(_without_spans, f"doc_id {id_type}, n_bytes long, spans {_SPANS}, kept binary")


def repeated_spans(rows: DataFrame, length: int, gram: int, step: int, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(digest, spans) of each distinct text of ``rows`` (digest, text) that has repeats."""
    members = stage_result(rows.sparkSession, lambda: _members_of(rows, length, gram), "pieces")
    release(rows.sparkSession)
    marks = _marks(members, length, gram, step, group_bytes, length - gram)
    found = members.select(F.col("place.holder").alias("digest"), F.col("place.first"), "anchor", "piece")
    holders = members.groupBy("anchor", "piece").agg(F.count("*").alias("holders"))
    found = join_per_key(found, marks, ["anchor", "piece"], "holders", F.col("digest"), sizes=holders)
    first = F.col("first")
    moved = F.transform(
        "spans", lambda s: F.struct((s["start"] + first).alias("start"), (s["stop"] + first + length - 1).alias("stop"))
    )
    return found.groupBy("digest").agg(F.flatten(F.collect_set(moved)).alias("spans"))


def _members_of(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """The pieces around anchors that occur more than once, by the texts that hold them."""
    long = rows.where(F.octet_length("text") >= length).select("digest", "text")
    schema = "digest binary, first int, windows int, anchor bigint, several boolean"
    runs = stage_table(long.mapInArrow(_anchored(length, gram), schema), "anchors")
    # Rows of equal texts count one by one; each text has one run that begins at 0.
    often = runs.groupBy("anchor").agg(F.count("*").alias("n"), F.max("several").alias("several"))
    often = often.where("n > 1 OR several").select("anchor", "n")
    copied = runs.where("first = 0").groupBy("digest").agg(F.count("*").alias("n")).where("n > 1")
    wanted = (
        join_per_key(runs, often, ["anchor"], "n", F.col("digest"))
        .groupBy("digest")
        .agg(F.collect_set(F.struct("first", "windows", "anchor")).alias("runs"))
        .join(copied.select("digest", F.lit(True).alias("copied")), "digest", "left")
        .withColumn("copied", F.coalesce("copied", F.lit(False)))
    )
    once = long.mapInArrow(_once_per_task, long.schema)
    cut = once.join(wanted, "digest").select("digest", F.col("text").cast("binary"), "runs", "copied")
    return cut.mapInArrow(_pieces(length), _MEMBERS)


def anchors(text: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each gram, hash of the anchor of each window) of ``text``."""
    hashes = mixed(bwt.gram_codes(text, gram))
    return hashes, _least(hashes, length - gram + 1)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, by the least so far from both ends of blocks of that width."""
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(values)] = values
    table = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(values) - width + 1
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


def _anchored(length: int, gram: int):
    """(digest, text) -> a row for each run of windows with the same anchor."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(1)
            offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32, count=len(texts) + 1 + texts.offset)[texts.offset :]
            text = np.frombuffer(texts.buffers()[2], dtype=np.uint8, count=int(offsets[-1]))[offsets[0] :]
            bounds = (offsets - offsets[0]).astype(np.int64)
            for first in range(0, max(len(text) - length + 1, 0), BLOCK):
                hashes, anchor = anchors(text[first : first + BLOCK + length - 1], length, gram)
                place = np.arange(first, first + len(anchor))
                row = np.searchsorted(bounds, place, side="right") - 1
                inside = np.flatnonzero(place + length <= bounds[row + 1])
                if not len(inside):
                    continue
                place, row, found = place[inside], row[inside], anchor[inside]
                starts, sizes = _runs((found[1:] != found[:-1]) | (row[1:] != row[:-1]), len(found))
                several = _several(hashes, place[starts] - first, sizes, length - gram + 1)
                row = row[starts]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(row)),
                        pa.array((place[starts] - bounds[row]).astype(np.int32)),
                        pa.array(sizes.astype(np.int32)),
                        pa.array(found[starts].view(np.int64)),
                        pa.array(several),
                    ],
                    ["digest", "first", "windows", "anchor", "several"],
                )

    return task


def _several(hashes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    """Whether the anchor of each run of windows occurs in it more than once, so that windows of one run may be equal."""
    several = np.empty(len(starts), dtype=bool)
    for begin in range(0, len(starts), 4_096):
        part = slice(begin, begin + 4_096)
        near = starts[part, None] + np.arange(width)
        first = hashes[near]
        first = first == first.min(axis=1)[:, None]
        last = hashes[near + (sizes[part, None] - 1)]
        last = last == last.min(axis=1)[:, None]
        once = (first.sum(axis=1) == 1) & (last.sum(axis=1) == 1)
        several[part] = ~once | (first.argmax(axis=1) != last.argmax(axis=1) + sizes[part] - 1)
    return several


def _runs(parted: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, sizes) of runs of ``n`` neighbours, parted where said and after PIECE_WINDOWS at the latest."""
    starts = np.concatenate([[0], np.flatnonzero(parted) + 1])
    sizes = np.diff(np.append(starts, n))
    pieces = -(-sizes // PIECE_WINDOWS)
    number = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts = np.repeat(starts, pieces) + number * PIECE_WINDOWS
    return starts, np.diff(np.append(starts, n))


def _once_per_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drops texts that the task has seen; repeats that remain do no harm."""
    seen: set[bytes] = set()
    for batch in batches:
        fresh = []
        for digest in batch.column(0).to_pylist():
            fresh.append(digest not in seen)
            seen.add(digest)
        yield batch.filter(pa.array(fresh, pa.bool_()))
        if len(seen) > KEPT_TEXTS:
            seen.clear()


def _pieces(length: int):
    """(digest, text, runs, copied) -> a member for each run; a task sends the text of equal pieces once."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, bytes]] = set()
        for batch in slices(batches):
            rows = []
            for digest, text, runs, copied in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for run in runs:
                    first, windows, anchor = run["first"], run["windows"], run["anchor"]
                    piece = text[first : first + windows + length - 1]
                    name = xxhash.xxh3_128_digest(piece)
                    fresh = (anchor, name) not in seen
                    seen.add((anchor, name))
                    rows.append(({"holder": digest, "anchor": 0, "first": first}, anchor, name, windows, -1, piece if fresh else None, copied))
                if len(rows) > 20_000:
                    yield _members(rows)
                    rows = []
                if len(seen) > KEPT_TEXTS:
                    seen.clear()
            if rows:
                yield _members(rows)

    return task


_MEMBER_SCHEMA = pa.schema(
    [
        ("place", pa.struct([("holder", pa.binary()), ("anchor", pa.int64()), ("first", pa.int32())])),
        ("anchor", pa.int64()),
        ("piece", pa.binary()),
        ("windows", pa.int32()),
        ("core", pa.int32()),
        ("text", pa.binary()),
        ("copied", pa.bool_()),
    ]
)


def _members(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(column, field.type) for column, field in zip(columns, _MEMBER_SCHEMA, strict=True)], schema=_MEMBER_SCHEMA
    )


def _marks(members: DataFrame, length: int, gram: int, step: int, group_bytes: int, rest: int) -> DataFrame:
    """(anchor, piece, spans) of the pieces that have repeated windows; spans are runs of windows.

    Anchors with too much different text for one task are parted: all their windows
    share a core (the anchor at first), and ``rest`` further bytes. Either half or more of
    these lie ahead of the core or behind it, so the core grows by that half,
    and windows meet only those with the same larger core, in smaller pieces. After a
    few steps the core is the whole window; nothing is dropped or sampled.
    """
    place = F.col("place")
    pieces = stage_table(
        members.groupBy("anchor", "piece").agg(
            F.max("windows").alias("windows"),
            F.max("core").alias("core"),
            F.max("text").alias("text"),
            ((F.min(place) != F.max(place)) | F.max("copied")).alias("copied"),
        ),
        "distinct-pieces",
    )
    release(members.sparkSession)
    sizes = pieces.groupBy("anchor").agg(F.sum(F.octet_length("text")).alias("bytes"))
    large = sizes.where(F.col("bytes") > group_bytes).select("anchor")
    part_on = rest > 0 and not large.isEmpty()
    small = pieces.join(large, "anchor", "left_anti") if part_on else pieces
    merged = (
        small.select("anchor", "piece", "text", "copied")
        .repartition("anchor")
        .sortWithinPartitions("anchor", "piece")
        .mapInArrow(_merged(length, step), f"anchor bigint, piece binary, spans {_SPANS}")
    )
    if not part_on:
        return merged
    parted = pieces.join(large, "anchor", "left_semi").mapInArrow(_parted(length, gram, rest), _MEMBERS)
    parted = stage_table(parted, "parted-pieces")
    marks = _marks(parted, length, gram, step, group_bytes, rest // 2)
    back = parted.select("place", "anchor", "piece").join(marks, ["anchor", "piece"])
    first = F.col("place.first")
    moved = F.transform("spans", lambda s: F.struct(*((s[name] + first).alias(name) for name in ("start", "stop"))))
    returned = back.groupBy(F.col("place.anchor").alias("anchor"), F.col("place.holder").alias("piece")).agg(
        F.flatten(F.collect_set(moved)).alias("spans")
    )
    return merged.unionByName(returned)


def _merged(length: int, step: int):
    """Rows sorted by anchor -> the repeated windows of each piece, anchors being taken together up to BATCH_BYTES."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        size, last = 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= BATCH_BYTES and row[0] != last:
                    yield from _spans_of(group, length, step)
                    group, size = [], 0
                group.append(row)
                size += len(row[2])
                last = row[0]
        yield from _spans_of(group, length, step)

    return task


def _spans_of(group: list[tuple], length: int, step: int) -> Iterator[pa.RecordBatch]:
    if not group:
        return
    names, pieces, texts, copied = zip(*group, strict=True)
    string, offset = bwt.repeated(texts, np.array(copied), length, step, SHARD_BYTES)
    order = np.lexsort((offset, string))
    string, offset = string[order], offset[order]
    if not len(string):
        return
    starts = np.flatnonzero(np.append(True, (string[1:] != string[:-1]) | (offset[1:] != offset[:-1] + 1)))
    stops = np.append(starts[1:], len(string)) - 1
    holders, counts = np.unique(string[starts], return_counts=True)
    spans = pa.StructArray.from_arrays(
        [pa.array(offset[starts].astype(np.int32)), pa.array((offset[stops] + 1).astype(np.int32))], ["start", "stop"]
    )
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), spans)
    yield pa.RecordBatch.from_arrays(
        [pa.array([names[i] for i in holders.tolist()], pa.int64()), pa.array([pieces[i] for i in holders.tolist()], pa.binary()), lists],
        ["anchor", "piece", "spans"],
    )


def _parted(length: int, gram: int, rest: int):
    """Pieces whose windows share a core of ``length - rest`` bytes -> smaller ones, by the core that has grown by half the rest."""
    more = -(-rest // 2)
    size = length - rest

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4):
            rows = []
            columns = (batch.column(c).to_pylist() for c in ("anchor", "piece", "windows", "core", "text", "copied"))
            for anchor, piece, windows, core, text, copied in zip(*columns, strict=True):
                at = np.full(windows, core) if core >= 0 else _anchor_places(text, length, gram)
                ahead = at - np.arange(windows) >= more
                grown = np.where(ahead, at - more, at)
                starts, sizes = _runs((at[1:] != at[:-1]) | (ahead[1:] != ahead[:-1]), windows)
                for first, n in zip(starts.tolist(), sizes.tolist(), strict=True):
                    place = {"holder": piece, "anchor": anchor, "first": first}
                    begin = int(grown[first])
                    key = xxhash.xxh3_64_intdigest(text[begin : begin + size + more], seed=rest) - 2**63
                    part = text[first : first + n + length - 1]
                    rows.append((place, key, xxhash.xxh3_128_digest(part), n, begin - first, part, copied))
            if rows:
                yield _members(rows)

    return task


def _anchor_places(text: bytes, length: int, gram: int) -> np.ndarray:
    """Where the anchor of each window of a text is; of several equal ones the first in the window."""
    hashes, found = anchors(np.frombuffer(text, dtype=np.uint8), length, gram)
    places = np.flatnonzero(np.isin(hashes, found))
    after = np.searchsorted(places, np.arange(len(found)))
    at = places[after]
    # The next place may be that of another window's anchor.
    for window in np.flatnonzero(hashes[at] != found).tolist():
        at[window] = window + int(np.flatnonzero(hashes[window : window + length - gram + 1] == found[window])[0])
    return at


def _without_spans(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, spans, which may overlap) -> the maximal spans, and what is left of the text."""
    for batch in slices(batches):
        texts, spans, kept = batch.column(1).to_pylist(), [], []
        for text, found in zip(texts, batch.column(2).to_pylist(), strict=True):
            joined: list[list[int]] = []
            for start, stop in sorted((s["start"], s["stop"]) for s in found or ()):
                if joined and start <= joined[-1][1]:
                    joined[-1][1] = max(stop, joined[-1][1])
                else:
                    joined.append([start, stop])
            spans.append([{"start": a, "stop": b} for a, b in joined])
            ends = [0, *(b for _, b in joined)]
            starts = [*(a for a, _ in joined), len(text)]
            kept.append(b"".join(text[a:b] for a, b in zip(ends, starts, strict=True)))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(list(map(len, texts)), pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
                pa.array(kept, pa.binary()),
            ],
            ["doc_id", "n_bytes", "spans", "kept"],
        )
