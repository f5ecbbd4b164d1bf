"""Which texts have to be compared: blocks of like texts, and the pairs of blocks that may hold a match.

A text's profile is its length and how often characters of each class occur.
Every insertion or deletion changes one count by one, so two texts are at least
as many edits apart as their counts differ. A tree of cuts through the
profiles of a bounded sample deals all texts out to leaves of like texts; the sample steers the
work, never the result. Each leaf has the least and greatest counts of its own
texts, and a pair of leaves is dropped when even these are too far apart for
the threshold. What is left is exact: nothing is capped or approximate.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveysieve.functions.similarity_scores import character_counts, percent
from surveysieve.sources.sinks import stage_rounds, stage_table

CLASSES = 32
# Profiles that the tree is made from, at least this many in a leaf, and leaves at most.
SAMPLE, LEAF_SAMPLE, LEAVES = 50_000, 8, 1_024
# Texts in a leaf, while there are fewer leaves than that: small leaves part only at a high threshold.
HIGH, LEAF_TEXTS, LARGE_LEAF_TEXTS = 80, 16, 64
# A block is a leaf or, where that holds more, part of one.
BLOCK_CHARACTERS, BLOCK_TEXTS = 131_072, 1_024
# Pairs of characters, and texts, that a block and those it meets in one task make up.
CHUNK_CELLS, CHUNK_TEXTS = 2_000_000_000, 16_384
TASKS_PER_CORE = 16
# Characters that are copied to blocks at once, if twice those of all texts are not more: blocks beyond wait for the next round.
ROUND_CHARACTERS = 1_000_000_000
# Rows handed to the scores at once.
_ROWS = 1_024


def profiles(shapes: list[str]) -> np.ndarray:
    """Length and counts per class, one row per text."""
    counts = character_counts(shapes).reshape(len(shapes), -1, CLASSES).sum(axis=1)
    return np.column_stack([counts.sum(axis=1), counts]).astype(np.int32)


@dataclass(frozen=True)
class Tree:
    """Cuts through profiles: a node's texts with ``value[axis] <= cut`` go to ``low``, the others to ``high``.

    Leaves have the axis -1 and their number as ``cut``.
    """

    axis: np.ndarray
    cut: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def of(cls, sample: np.ndarray, leaves: int) -> Tree:
        """At most ``leaves`` leaves; the fullest node is cut first, where its values spread most, at their median."""
        nodes, members, final = [[-1, 0, 0, 0]], {0: np.arange(len(sample))}, set()
        while len(members) < leaves and len(final) < len(members):
            node = max(members.keys() - final, key=lambda n: len(members[n]))
            inside = sample[members[node]]
            axis = int(_spread(inside).argmax()) if len(inside) >= 2 * LEAF_SAMPLE else -1
            values = inside[:, axis]
            if axis < 0 or values.min() == values.max():
                final.add(node)
                continue
            cut = int(min(np.median(values), values.max() - 1))
            cut = max(cut, int(values.min()))
            at = members.pop(node)
            nodes[node] = [axis, cut, len(nodes), len(nodes) + 1]
            members[len(nodes)], members[len(nodes) + 1] = at[values <= cut], at[values > cut]
            nodes += [[-1, 0, 0, 0], [-1, 0, 0, 0]]
        for number, node in enumerate(sorted(members)):
            nodes[node][1] = number
        return cls(*np.array(nodes, dtype=np.int32).T)

    def leaf_of(self, rows: np.ndarray) -> np.ndarray:
        node = np.zeros(len(rows), dtype=np.int32)
        while True:
            inner = np.flatnonzero(self.axis[node] >= 0)
            if not len(inner):
                return self.cut[node]
            at = node[inner]
            node[inner] = np.where(rows[inner, self.axis[at]] <= self.cut[at], self.low[at], self.high[at])


def _spread(values: np.ndarray) -> np.ndarray:
    """Of each column, between its tenths; of all values if that is nothing."""
    low, high = np.percentile(values, (10, 90), axis=0)
    spread = high - low
    return spread if spread.any() else (values.max(axis=0) - values.min(axis=0)).astype(float)


def best_scores(low: np.ndarray, high: np.ndarray, one: int) -> np.ndarray:
    """The highest score that a text of leaf ``one`` can reach with one of each leaf, from their least and greatest profiles."""
    apart = np.maximum(np.maximum(low[one] - high, low - high[one]), 0)
    shorter, longer = np.minimum(high[one, 0], high[:, 0]), np.maximum(low[one, 0], low[:, 0])
    by_length = np.where(longer > shorter, percent(np.minimum(shorter, longer), shorter + longer), 100.0)
    total = high[one, 0] + high[:, 0]
    by_counts = 100 - 100 * np.divide(apart[:, 1:].sum(axis=1), total, out=np.zeros(len(total)), where=total > 0)
    return np.minimum(by_length, by_counts)


@dataclass(frozen=True)
class Plan:
    """``leaves``: leaf, texts, blocks, first_block, chunks. ``meetings``: leaf, other leaf, first chunk, chunks.

    A leaf's blocks meet the texts of its other leaves, itself included, in its chunks.
    """

    leaves: pd.DataFrame
    meetings: pd.DataFrame

    def compared(self) -> int:
        """Pairs of texts that meet."""
        texts = self.leaves.set_index("leaf")["texts"]
        one, other = (texts[self.meetings[c]].to_numpy() for c in ("leaf", "other"))
        return int(np.where(self.meetings["leaf"] == self.meetings["other"], one * (one - 1) // 2, one * other).sum())


def plan_meetings(
    boxes: pd.DataFrame, least: int, block_characters: int, chunk_texts: int = CHUNK_TEXTS, chunk_cells: int = CHUNK_CELLS
) -> Plan:
    """Blocks and meetings from one row per leaf: texts, characters, low and high profile."""
    boxes = boxes.sort_values("leaf", ignore_index=True)
    characters = boxes["characters"].to_numpy()
    wanted = np.maximum(np.ceil(boxes["characters"] / block_characters), np.ceil(boxes["texts"] / BLOCK_TEXTS))
    leaves = boxes[["leaf", "texts"]].assign(blocks=np.minimum(wanted, boxes["texts"]).astype("int64"))
    leaves["first_block"] = leaves["blocks"].cumsum() - leaves["blocks"]
    low, high = (np.array(boxes[c].tolist(), dtype=np.int64).reshape(len(boxes), -1) for c in ("low", "high"))
    numbers, texts = boxes["leaf"].to_numpy(), boxes["texts"].to_numpy()
    meetings, chunks = [], []
    for one in range(len(boxes)):
        others = np.flatnonzero(best_scores(low, high, one) >= least - 1e-6)
        others = others[others >= one]
        # Small leaves share a chunk, a large one has several: of at most one measure of texts or work each.
        room = max(chunk_cells // max(characters[one] // max(leaves["blocks"][one], 1), 1), 1)
        shares = np.maximum(texts[others] / chunk_texts, characters[others] / room)
        first = (np.cumsum(shares) - shares).astype(np.int64)
        parts = np.minimum(np.ceil(shares).astype(np.int64), texts[others])
        chunks.append(int((first + parts).max()))
        meetings.append(pd.DataFrame({"leaf": numbers[one], "other": numbers[others], "first_chunk": first, "parts": parts}))
    columns = ["leaf", "other", "first_chunk", "parts"]
    found = pd.concat(meetings, ignore_index=True) if meetings else pd.DataFrame(columns=columns, dtype="int64")
    return Plan(leaves.assign(chunks=np.array(chunks, dtype="int64")), found)


def leaf_boxes(leaved: DataFrame) -> pd.DataFrame:
    """One row per leaf, so at most LEAVES."""
    columns = range(CLASSES + 1)
    bounds = leaved.groupBy("leaf").agg(
        F.count("*").alias("texts"),
        F.sum(F.col("profile")[0] + 1).alias("characters"),
        F.array(*(F.min(F.col("profile")[i]) for i in columns)).alias("low"),
        F.array(*(F.max(F.col("profile")[i]) for i in columns)).alias("high"),
    )
    return bounds.toPandas()


def leaves_for(texts: int, least: int) -> int:
    return max(1, min(LEAVES, texts // (LEAF_TEXTS if least >= HIGH else LARGE_LEAF_TEXTS)))


def leaved(texts: DataFrame, least: int, sample: int = SAMPLE) -> DataFrame:
    """``texts`` with the profile of their ``shape`` and the number of their leaf."""
    names = texts.columns
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in texts.schema) + ", profile array<int>"

    def profiled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                part = batch.slice(start, _ROWS)
                rows = profiles(part.column(names.index("shape")).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, _lists(rows)], [*names, "profile"])

    rows = stage_table(texts.mapInArrow(profiled, schema), "profiles")
    total = rows.count()
    share = rows if total <= sample else rows.where(F.pmod(F.xxhash64("first_id"), F.lit(2**31)) < int(2**31 * sample / total))
    known = np.array([r["profile"] for r in share.select("profile").collect()], dtype=np.int32).reshape(-1, CLASSES + 1)
    tree = Tree.of(known, leaves_for(total, least))

    def dealt(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(len(names))
            table = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, CLASSES + 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tree.leaf_of(table))], [*names, "profile", "leaf"])

    return rows.mapInArrow(dealt, schema + ", leaf int")


def _lists(rows: np.ndarray) -> pa.ListArray:
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel()))


Compare = Callable[[pd.DataFrame, pd.DataFrame | None], pa.RecordBatch | None]


def compare_blocks(
    texts: DataFrame, least: int, compare: Callable[[pd.DataFrame], Compare], schema: str, block_characters: int | None = None
) -> DataFrame:
    """The results of all pairs of texts that can reach the score ``least``.

    ``texts`` have first_id, shape and columns that the scores need. ``compare`` makes of a
    block's rows a function; this gets the block and some rows it meets, or None
    for the block's own pairs, and returns a batch of results of ``schema``. A task holds one block and some rows.
    """
    spark = texts.sparkSession
    rows = leaved(texts, least)
    boxes = leaf_boxes(rows)
    if boxes.empty:
        return spark.createDataFrame([], schema)
    room = min(BLOCK_CHARACTERS, max(2_048, int(boxes["characters"].sum()) // spark.sparkContext.defaultParallelism))
    plan = plan_meetings(boxes, least, block_characters or room)
    # Scoring dwarfs the bytes shuffled, so the partitions follow the work, not the size.
    most = max(int(spark.conf.get("spark.sql.shuffle.partitions")), TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    chunks = np.repeat(plan.leaves["chunks"].to_numpy(), plan.leaves["blocks"])

    def compared(first: int, stop: int) -> DataFrame:
        tasks = min(int(chunks[first:stop].sum()), most)
        dealt = _met(rows, plan, first, stop).repartition(tasks, "block", "chunk")
        return dealt.sortWithinPartitions("block", "chunk", "visits").mapInArrow(_streamed(compare), schema)

    rounds = plan_rounds(plan, boxes, max(ROUND_CHARACTERS, 2 * int(boxes["characters"].sum())))
    if len(rounds) == 1:
        return compared(*rounds[0])
    return stage_rounds(spark, (compared(*blocks) for blocks in rounds), schema, "block-pairs")


def plan_rounds(plan: Plan, boxes: pd.DataFrame, most: int) -> list[tuple[int, int]]:
    """(first, after the last) block of each round, so that about ``most`` characters at most are copied to its blocks.

    Copies for all blocks at once would grow with the square of the texts. One more block's copies, each text once
    and the block's own in its chunks, are the most that a round has beyond.
    """
    characters = boxes.set_index("leaf")["characters"]
    visits = characters[plan.meetings["other"]].groupby(plan.meetings["leaf"].to_numpy()).sum()
    leaves = plan.leaves
    home = characters[leaves["leaf"]].to_numpy() / leaves["blocks"].to_numpy() * leaves["chunks"].to_numpy()
    copied = home + visits.reindex(leaves["leaf"], fill_value=0).to_numpy()
    numbers = (np.cumsum(np.repeat(copied, leaves["blocks"])) - 1e-6) // most
    firsts = np.flatnonzero(np.append(True, numbers[1:] != numbers[:-1])).tolist()
    return list(zip(firsts, [*firsts[1:], len(numbers)], strict=True))


def _met(rows: DataFrame, plan: Plan, first: int, stop: int) -> DataFrame:
    """The texts of blocks from ``first`` to before ``stop``, once per chunk, and (as visits) those that these meet, in the chunks where they do."""
    spark = rows.sparkSession
    # At most LEAVES rows, and at most their square by two.
    leaves = F.broadcast(spark.createDataFrame(plan.leaves.drop(columns="texts"), "leaf int, blocks long, first_block long, chunks long"))
    meetings = plan.meetings.merge(plan.leaves[["leaf", "blocks", "first_block"]], on="leaf")
    meetings = meetings.rename(columns={"leaf": "host", "other": "leaf", "blocks": "host_blocks", "first_block": "host_first"})
    kinds = "host int, leaf int, first_chunk long, parts long, host_blocks long, host_first long"
    visits = F.broadcast(spark.createDataFrame(meetings, kinds))
    placed = rows.drop("profile").join(leaves, "leaf").withColumn("own", F.pmod(F.xxhash64("first_id"), F.col("blocks")))
    kept = [c for c in rows.columns if c not in ("profile", "leaf")]
    at_home = placed.where((F.col("first_block") + F.col("own")).between(first, stop - 1)).select(
        (F.col("first_block") + F.col("own")).alias("block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"),
        F.lit(False).alias("visits"),
        *kept,
    )
    # Within a leaf, a text visits the blocks ahead of its own.
    last = F.when(F.col("host") == F.col("leaf"), F.col("own") - 1).otherwise(F.col("host_blocks") - 1)
    visiting = (
        placed.join(visits, "leaf")
        .withColumn("host_last", F.least(F.col("host_first") + last, F.lit(stop - 1)))
        .withColumn("host_first", F.greatest("host_first", F.lit(first).cast("long")))
        .where("host_first <= host_last")
    )
    part = F.pmod(F.xxhash64("first_id", F.lit(1)), F.col("parts"))
    abroad = visiting.select(
        F.explode(F.sequence("host_first", "host_last")).alias("block"),
        (F.col("first_chunk") + part).alias("chunk"),
        F.lit(True).alias("visits"),
        *kept,
    )
    return at_home.unionByName(abroad)


def _streamed(compare: Callable[[pd.DataFrame], Compare]):
    """Rows sorted by block, chunk and visit -> results; visitors are streamed past the block."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, home, block, meet = None, [], None, None

        def opened() -> Iterator[pa.RecordBatch]:
            """Prepares the block, and compares its own rows in its first chunk."""
            nonlocal block, meet
            if home and meet is None:
                block = pd.concat(home, ignore_index=True)
                meet = compare(block)
                if key[1] == 0:
                    yield from _some(meet(block, None))

        for batch in batches:
            frame = batch.to_pandas()
            marks = frame[["block", "chunk", "visits"]]
            runs = (marks != marks.shift()).any(axis=1).cumsum().to_numpy()
            for _, rows in frame.groupby(runs, sort=False):
                place = rows["block"].iat[0], rows["chunk"].iat[0]
                if place != key:
                    yield from opened()
                    key, home, meet = place, [], None
                if not rows["visits"].iat[0]:
                    home.append(rows)
                    continue
                yield from opened()
                # By its hash, a part of a leaf may have got no text.
                for start in range(0, len(rows) if home else 0, _ROWS):
                    yield from _some(meet(block, rows.iloc[start : start + _ROWS].reset_index(drop=True)))
        yield from opened()

    return task


def _some(batch: pa.RecordBatch | None) -> Iterator[pa.RecordBatch]:
    if batch is not None and batch.num_rows:
        yield batch
