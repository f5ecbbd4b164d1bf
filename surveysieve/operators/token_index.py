"""Pairs of texts that share enough of their tokens, found by an inverted index.

The shared tokens of two texts give a score only if they make up a certain part of
one of them, whatever else the other one holds. So if that text's rarest
tokens are set aside until the rest is too little, one of these must be shared: its prefix.
Prefix tokens meet all texts with the token by an equi-join, frequent ones in
lanes; texts that share no prefix token are never compared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surveysieve.operators.skew import join_per_key

# Postings of a token, or of a prefix token, that meet in one lane.
LANE_POSTINGS = 10_000


def token_postings(texts: DataFrame, least: int) -> DataFrame:
    """(token, first_id, long, weight, total, needed, holders, in_prefix) for each distinct token of each text.

    A token weighs its characters and one. ``needed`` is what shared tokens must
    weigh so that the text reaches the score ``least`` by them.
    """
    share = least / (200 - least)
    tokens = F.array_distinct(F.split("form", " "))
    listed = texts.where(F.col("form") != "").select("first_id", "long", F.explode(tokens).alias("token"))
    weighed = listed.withColumn("weight", F.length("token") + 1)
    counts = weighed.groupBy("token").agg(F.count("*").alias("holders"))
    held = join_per_key(weighed, counts, ["token"], "holders", F.col("first_id"))
    text = Window.partitionBy("first_id")
    rarest_last = text.orderBy(F.desc("holders"), F.desc("token")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Rounded down a little, so that no pair at the border is missed.
    needed = F.col("total") * share + (1 - share) - 1e-6
    return (
        held.withColumn("total", F.sum("weight").over(text))
        .withColumn("needed", needed)
        .withColumn("in_prefix", F.sum("weight").over(rarest_last) >= F.col("needed"))
    )


def candidate_pairs(postings: DataFrame, lane_postings: int = LANE_POSTINGS) -> DataFrame:
    """(id_i, id_j) with id_i < id_j, once each, of all texts of which one shares a prefix token with the other and may reach the score."""
    prefix = postings.where("in_prefix")
    sides = postings.groupBy("token").agg(
        F.count("*").alias("holders"), F.count_if("in_prefix").alias("prefixes")
    ).where("prefixes > 0 AND holders > 1")

    def lanes(count: str):
        return F.ceil(F.col(count) / lane_postings).cast("int")

    # Both sides of a frequent token are dealt out, and each lane of one meets each lane of the other.
    hot = sides.where((F.col("holders") > lane_postings)).select("token", lanes("prefixes").alias("left_lanes"), lanes("holders").alias("right_lanes"))
    one = F.lit(1)

    def spread(rows: DataFrame, own: str, other: str, shift: int) -> DataFrame:
        found = rows.join(hot, "token", "left")
        place = F.pmod(F.xxhash64("first_id", F.lit(shift)), F.coalesce(f"{own}_lanes", one)).cast("int")
        copies = F.sequence(F.lit(0), F.coalesce(f"{other}_lanes", one) - 1)
        found = found.withColumn(f"{own}_lane", place).withColumn(f"{other}_lane", F.explode(copies))
        return found.drop("left_lanes", "right_lanes")

    left = spread(prefix.select("token", "first_id", "long", "weight", "total", "needed"), "left", "right", 1)
    right = spread(postings.select("token", F.col("first_id"), F.col("long").alias("other_long")), "right", "left", 2)
    right = right.withColumnRenamed("first_id", "other")
    met = left.join(right, ["token", "left_lane", "right_lane"]).where("first_id <> other AND (long OR other_long)")
    # What is shared of the prefix, and all that is not in it, must weigh enough.
    rest = postings.where("NOT in_prefix").groupBy("first_id").agg(F.sum("weight").alias("rest"))
    shared = met.groupBy("first_id", "other").agg(F.sum("weight").alias("shared"), F.first("needed").alias("needed"))
    enough = shared.join(rest, "first_id", "left").where("shared + coalesce(rest, 0) >= needed")
    return enough.select(F.least("first_id", "other").alias("id_i"), F.greatest("first_id", "other").alias("id_j")).distinct()


def with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs, a stored table, with form and copies of both texts; a text in very many pairs is joined in lanes."""
    for side in ("i", "j"):
        name = f"id_{side}"
        counts = pairs.groupBy(name).agg(F.count("*").alias("pairs"))
        held = texts.select(F.col("first_id").alias(name), F.col("form").alias(f"form_{side}"), F.col("copies").alias(f"copies_{side}"))
        other = "id_j" if side == "i" else "id_i"
        pairs = join_per_key(pairs, held, [name], "pairs", F.col(other), LANE_POSTINGS, sizes=counts)
    return pairs
