"""Exact copies: combined locally, then in salted groups, then globally, always by full content."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveysieve.llm.common import packed, pick, unpacked
from surveysieve.sources.sinks import stage_table

# White space that does not count when texts are compared.
WHITE_SPACE = r"[\x20\x09-\x0D]"

# A digest is hot from this many rows on, and from this share of all rows on:
# so at most 1 / HOT_SHARE digests are hot and may be broadcast.
HOT_ROWS = 500
HOT_SHARE = 1e-5


def sha256(content: Column) -> Column:
    return F.unhex(F.sha2(content, 256))


def mark_copies(docs: DataFrame, digest: Callable[[Column], Column] = sha256, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Groups of equal texts in ``docs`` (doc_id, text), one row per row of ``docs``.

    ``keep_id`` is the doc_id of the row that stays: the most code points in its
    text, then the smallest doc_id. ``group_size`` counts the equal texts,
    ``kept`` tells whether this row stays, ``text_sha256`` is the digest of the
    text without white space.

    A null text is empty, and all empty texts are equal. A null doc_id comes
    after all others. Of rows that repeat the doc_id that stays, exactly one has
    ``kept``. No rows give no rows. Other columns are ignored.
    """
    source = _digested(pick(docs, "doc_id", "text"), digest)
    narrow = stage_table(source.drop("content"), "digests")
    marked = _located(narrow, _groups(source, narrow, hot_rows), source)
    return marked.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame, digest: Callable[[Column], Column] = sha256, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The rows of ``docs`` that ``mark_copies`` keeps, with all their columns."""
    source = _digested(pick(docs, "doc_id", "text"), digest)
    narrow = stage_table(source.drop("content"), "digests")
    whole = _digested(packed(docs, "doc_id", "text"), digest)
    marked = _located(whole.drop("content"), _groups(source, narrow, hot_rows), whole)
    return unpacked(marked.where("kept"), docs)


def _digested(rows: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """Adds digest, content and n_chars, and drops the text; every other column stays."""
    text = F.coalesce("text", F.lit(""))
    content = F.regexp_replace(text, WHITE_SPACE, "")
    return rows.select(
        *(c for c in rows.columns if c != "text"), content.alias("content"), F.length(text).alias("n_chars")
    ).select("*", digest(F.col("content")).alias("digest"))


def _best() -> Column:
    """Greater for the row that stays; a null doc_id is least."""
    return F.struct(F.col("n_chars").cast("long").alias("n_chars"), F.bitwise_not("doc_id").alias("inverse_id"))


def _groups(source: DataFrame, narrow: DataFrame, hot_rows: int) -> DataFrame:
    """One row per digest: its size, its best row, the number of different contents, and its lanes."""
    total = narrow.count()
    threshold = max(hot_rows, int(total * HOT_SHARE))
    sizes = narrow.groupBy("digest").agg(F.count("*").alias("n"))
    hot = sizes.where(F.col("n") >= threshold).select("digest", F.ceil(F.col("n") / threshold).cast("int").alias("lanes"))
    rows = source.join(F.broadcast(hot), "digest", "left")
    # A lane holds whole tasks, so that each task's own copies are combined before they are sent.
    lane = F.when(F.col("lanes").isNotNull(), F.spark_partition_id() % F.col("lanes")).otherwise(0)
    salted = (
        rows.withColumn("lane", lane)
        .groupBy("digest", "lanes", "lane", "content")
        .agg(F.count("*").alias("n"), F.max(_best()).alias("best"))
    )
    # Only hot digests have further lanes. The others' rows are combined already: their contents need not
    # be sent again, and a number of its own keeps each of them apart.
    is_hot = F.col("lanes").isNotNull()
    combined = (
        salted.select(
            "digest",
            "lanes",
            F.when(is_hot, F.col("content")).alias("content"),
            F.when(~is_hot, F.monotonically_increasing_id()).alias("settled"),
            "n",
            "best",
        )
        .groupBy("digest", "lanes", "content", "settled")
        .agg(F.sum("n").alias("n"), F.max("best").alias("best"))
    )
    groups = combined.groupBy("digest", "lanes").agg(
        F.sum("n").alias("group_size"), F.max("best").alias("best"), F.count("*").alias("contents")
    )
    return stage_table(groups, "copies")


def _located(rows: DataFrame, groups: DataFrame, source: DataFrame) -> DataFrame:
    """Joins each row with its group: adds keep_id, group_size and kept. ``source`` has the rows with their content."""
    hot = groups.where(F.col("lanes").isNotNull()).select("digest", "lanes")
    lanes = F.coalesce("lanes", F.lit(1))
    spread = (
        rows.join(F.broadcast(hot), "digest", "left")
        .withColumn("lane", F.pmod(F.xxhash64("doc_id"), lanes).cast("int"))
        .drop("lanes")
    )
    copied = groups.withColumn("lane", F.explode(F.sequence(F.lit(0), lanes - 1))).drop("lanes")
    joined = spread.join(copied.where("contents = 1").drop("contents"), ["digest", "lane"])
    collided = groups.where("contents > 1").select("digest")
    if not collided.isEmpty():
        joined = joined.unionByName(_by_content(source, collided))
    order = Window.partitionBy("digest", "lane", "doc_id").orderBy(F.desc("n_chars"))
    return (
        joined.withColumn("keep_id", F.bitwise_not("best.inverse_id"))
        .withColumn("place", F.row_number().over(order))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("place") == 1))
        .drop("best", "place", "lane")
    )


def _by_content(source: DataFrame, collided: DataFrame) -> DataFrame:
    """The rows whose digest belongs to several contents, grouped by content; each content is a lane."""
    equal = Window.partitionBy("digest", "content")
    return (
        source.join(collided, "digest", "left_semi")
        .withColumn("group_size", F.count("*").over(equal))
        .withColumn("best", F.max(_best()).over(equal))
        .withColumn("lane", F.dense_rank().over(Window.partitionBy("digest").orderBy("content")))
        .drop("content")
    )
