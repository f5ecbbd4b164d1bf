"""SimHash fingerprints and the pairs of them within a Hamming radius."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveysieve.llm.common import pick, slices, texts_of
from surveysieve.llm.hashing import mixed, word_hashes
from surveysieve.operators.skew import join_per_key
from surveysieve.sources.sinks import stage_table

BITS = 256
# Fingerprints of a prefix that are compared with each other in one task.
GROUP = 1_000


def fingerprint(text: str, bits: int = BITS) -> np.ndarray:
    """Bits of a text, packed into bytes.

    Its terms are its words and the pairs of neighbouring words. Each distinct
    term votes on every bit with a sign from its hash, weighted by one plus the
    logarithm of its count; pairs count double, as they tell more. A bit
    is set if its votes are above zero, so a text without words has no bit set.
    """
    words = word_hashes(text)
    if not len(words):
        return np.zeros(bits // 8, dtype=np.uint8)
    with np.errstate(over="ignore"):
        pairs, pair_counts = np.unique(mixed(words[:-1] * np.uint64(3) + words[1:]), return_counts=True)
        singles, counts = np.unique(words, return_counts=True)
        terms = np.concatenate([singles, pairs])
        weights = np.concatenate([1 + np.log(counts), 2 + 2 * np.log(pair_counts)]).astype(np.float32)
        steps = np.arange(1, bits // 64 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        hashes = mixed(terms[:, None] + steps[None, :])
    signs = np.unpackbits(hashes.view(np.uint8).reshape(len(terms), -1), axis=1)
    votes = 2 * (weights @ signs.astype(np.float32)) - weights.sum()
    return np.packbits(votes > 0)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal bits."""
    return 1 - int(np.bitwise_count(a ^ b).sum()) / (8 * len(a))


def edited(text: str, following: str) -> str:
    """A text whose last third is replaced by the beginning of the one that follows."""
    replaced = len(text) // 3
    return text[: len(text) - replaced] + following[:replaced]


FINGERPRINTS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
_EDGES = FINGERPRINTS + ", part int, last_text string, first_text string"


def _compared(doc_id, text: str, own: np.ndarray, following: str, next_own: np.ndarray, bits: int) -> tuple:
    changed = edited(text, following)
    changed_own = fingerprint(changed, bits)
    digest = hashlib.sha256(changed.encode()).hexdigest()
    near = likeness(own, changed_own), likeness(own, next_own)
    return doc_id, len(text), digest, own.tobytes().hex(), changed_own.tobytes().hex(), *near


def compare_edited(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """Fingerprints of the whole texts of ``docs`` (doc_id, text) and of edited ones, and how alike they are.

    A text is edited by putting the beginning of the next document's text in the
    place of its last third. The next document is that with the next smaller
    doc_id; the first follows the last. ``near_edited`` and ``near_next`` are
    the shares of equal bits with the edited text and with the next document.

    A null text is empty; texts without words have no bit set, and are fully
    alike. Null doc_ids come last; rows that share a doc_id are ordered by text.
    A single row is its own next one, no rows give no rows. Other columns are
    ignored. Texts move once, sorted by doc_id; the neighbours across
    partitions are matched by two rows per partition.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held, first = None, None
        for batch in slices(batches):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                own = fingerprint(text, bits)
                if held is None:
                    first = text
                else:
                    rows.append((*_compared(*held, text, own, bits), part, None, first))
                    first = None
                held = doc_id, text, own
            if rows:
                yield _batch(rows)
        if held is not None:
            doc_id, text, own = held
            yield _batch([(doc_id, len(text), None, own.tobytes().hex(), None, None, None, part, text, first)])

    ordered = (
        pick(docs, "doc_id", "text")
        .select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .repartitionByRange(F.desc_nulls_last("doc_id"))
        .sortWithinPartitions(F.desc_nulls_last("doc_id"), "text")
    )
    found = stage_table(ordered.mapInArrow(run, _EDGES), "fingerprints")
    names = [field.split()[0] for field in FINGERPRINTS.split(", ")]
    inner = found.where("last_text IS NULL").select(*names)
    return inner.unionByName(_edges(found, bits).select(*names))


def _edges(found: DataFrame, bits: int) -> DataFrame:
    """The last rows of the partitions, with the first text of the next partition that has rows."""
    edges = found.where("last_text IS NOT NULL OR first_text IS NOT NULL")
    parts = edges.groupBy("part").agg(
        F.max(F.when(F.col("last_text").isNotNull(), F.struct("doc_id", "last_text"))).alias("last"),
        F.max("first_text").alias("first_text"),
    )
    # One row per partition of the sorted table.
    order = Window.orderBy("part")
    around = F.first("first_text").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    following = F.coalesce(F.lead("first_text").over(order), around)
    pairs = parts.select("last.doc_id", F.col("last.last_text").alias("text"), following.alias("following"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for doc_id, text, other in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own, next_own = fingerprint(text, bits), fingerprint(other, bits)
                rows.append((*_compared(doc_id, text, own, other, next_own, bits), 0, None, None))
            yield _batch(rows)

    return pairs.mapInArrow(run, _EDGES)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    text, number, share = pa.string(), pa.int64(), pa.float64()
    types = [number, number, text, text, text, share, share, pa.int32(), text, text]
    names = [field.split()[0] for field in _EDGES.split(", ")]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names)


def fingerprints(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """doc_id and fingerprint (hex) of the whole texts of ``docs``; nulls as in ``compare_edited``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hashed = [fingerprint(text, bits).tobytes().hex() for text in texts_of(batch.column(1))]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "fingerprint": pa.array(hashed, pa.string())})

    return pick(docs, "doc_id", "text").mapInArrow(run, "doc_id long, fingerprint string")


def _bit_range(number: int, n_blocks: int, bits: int) -> tuple[int, int]:
    digits = bits // 4
    return number * digits // n_blocks, (number + 1) * digits // n_blocks


def near_pairs(
    hashed: DataFrame, radius: int, bits: int = BITS, key_blocks: int = 1, group: int = GROUP
) -> tuple[DataFrame, DataFrame]:
    """All pairs of distinct fingerprints within a Hamming radius, and who has each fingerprint.

    ``hashed`` is (doc_id, fingerprint). Returns pairs (fingerprint_a,
    fingerprint_b, distance), each once, and members (doc_id, fingerprint): equal
    fingerprints are not expanded into pairs. The bits are cut into ``radius``
    + ``key_blocks`` blocks; two fingerprints within the radius agree in
    ``key_blocks`` of them at least. For each choice of that many blocks there is
    a table with these blocks in front, whose equal prefixes are compared, so no
    pair is missed. More ``key_blocks`` make more tables with longer, rarer
    prefixes: choose them so that prefixes have more bits than the logarithm of
    the number of fingerprints. Fingerprints that share a prefix are cut into blocks
    of about ``group``, and each pair of blocks meets on its own. Null fingerprints
    are left out.
    """
    members = pick(hashed, "doc_id", "fingerprint").where("fingerprint IS NOT NULL")
    distinct = members.select("fingerprint").distinct()
    n_blocks = radius + key_blocks
    if n_blocks > bits // 4:
        raise ValueError("too many blocks for fingerprints of this length")

    def prefix(blocks: tuple[int, ...]) -> Column:
        ranges = (_bit_range(b, n_blocks, bits) for b in blocks)
        return F.concat(*(F.substring("fingerprint", start + 1, end - start) for start, end in ranges))

    tables = [
        F.struct(F.lit(number).alias("table"), prefix(blocks).alias("prefix"))
        for number, blocks in enumerate(combinations(range(n_blocks), key_blocks))
    ]
    rows = distinct.select("fingerprint", F.explode(F.array(*tables)).alias("at")).select("fingerprint", "at.*")
    rows = stage_table(rows, "prefixes")
    sizes = rows.groupBy("table", "prefix").agg(F.count("*").alias("size")).where("size > 1")
    # A prefix that only one fingerprint has needs no partner.
    sized = join_per_key(rows, sizes, ["table", "prefix"], "size", F.col("fingerprint"))
    blocks = F.ceil(F.col("size") / group).cast("int")
    blocked = sized.select("table", "prefix", "fingerprint", blocks.alias("blocks")).select(
        "*", F.pmod(F.xxhash64("fingerprint"), F.col("blocks")).cast("int").alias("own")
    )
    met = blocked.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    # The smaller block first; inside one block each pair once, across two each pair in either order.
    keys = ["table", "prefix", "low", "high"]
    met = met.select("table", "prefix", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "fingerprint")
    a, b = met.where("own = low").alias("a"), met.where("own = high").alias("b")
    met = a.join(b, keys).where("low < high OR a.fingerprint < b.fingerprint")
    pairs = met.select(
        F.least("a.fingerprint", "b.fingerprint").alias("fingerprint_a"),
        F.greatest("a.fingerprint", "b.fingerprint").alias("fingerprint_b"),
        _distance(F.col("a.fingerprint"), F.col("b.fingerprint"), bits).alias("distance"),
    )
    return pairs.where(F.col("distance") <= radius).distinct(), members


def _distance(a: Column, b: Column, bits: int) -> Column:
    def word(column: Column, start: int) -> Column:
        # Eight digits at a time fit a long without a sign.
        return F.conv(F.substring(column, start + 1, 8), 16, 10).cast("long")

    total = F.lit(0)
    for start in range(0, bits // 4, 8):
        total = total + F.bit_count(word(a, start).bitwiseXOR(word(b, start)))
    return total
