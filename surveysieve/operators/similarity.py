"""Pairs of similar answers: exact, within bounds that lose nothing.

Equal texts are merged first. Two texts can reach a score by their characters only if
their lengths and characters are alike: blocks of like texts meet, unless even their bounds are
too far apart (``text_blocks``), and the texts of a block are scored side by side for each
visitor. Scores by shared tokens also come from texts of any length: these pairs are found by an
inverted index on tokens (``token_index``).
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from io import StringIO
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveysieve.functions.columns import col_
from surveysieve.functions.similarity_scores import (
    CHARACTER_CLASSES,
    SCORERS,
    TOKEN_SET_SCORERS,
    Pack,
    Tokens,
    character_counts,
    lcs_lengths,
    pack,
    percent,
    sharing_score,
    token_score,
)
from surveysieve.functions.text import sorted_tokens, strip, text_key
from surveysieve.operators import text_blocks
from surveysieve.operators.skew import HOT_ROWS, is_small, join_per_key
from surveysieve.operators.text_blocks import compare_blocks
from surveysieve.operators.token_index import LANE_POSTINGS, candidate_pairs, token_postings, with_texts
from surveysieve.sources.sinks import stage_rounds, stage_table

MIN_LENGTH = 7
SCORER = "token_sort_ratio"
THRESHOLD = 65

# So many texts are compared each with each.
FEW_TEXTS = 256
# Texts per pack, and how many of them must be asked for to score the whole pack at once.
_PACK, _WORTH_A_PACK = 64, 8
_PAIR = "id_i {key}, id_j {key}, score int, copies_i long, copies_j long"
_PAIR_COLUMNS = ["id_i", "id_j", "score", "copies_i", "copies_j"]


def distinct_texts(df: DataFrame, key: str, column_name: str, min_length: int, scorer: str) -> DataFrame:
    """One row per distinct text: key, first and last response, copies, prepared form.

    Written as a table, so that merging and preparing the texts is done once.
    """
    if scorer not in SCORERS:
        raise ValueError(f"similarity must be one of {SCORERS}, not '{scorer}'")
    text = F.coalesce(col_(column_name).cast("string"), F.lit(""))
    rows = df.select(col_(key).alias("id"), text.alias("text"))
    # The text is grouped by as well, although the key decides: hash aggregation cannot carry it otherwise.
    texts = rows.groupBy(text_key(F.col("text")).alias("text_key"), "text").agg(
        F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
        F.count("*").alias("copies"),
    )
    form = F.col("text") if scorer in ("ratio", "QRatio") else sorted_tokens(F.col("text"))
    prepared = texts.select("*", form.alias("form"), (F.length(strip(F.col("text"))) >= min_length).alias("long"))
    return stage_table(prepared, "texts")


def _check(threshold: float) -> None:
    if not 0 < threshold <= 100:
        raise ValueError("threshold must be above 0 and at most 100")


def _key_type(df: DataFrame, key: str) -> str:
    return df.select(col_(key)).schema[0].dataType.simpleString()


def similar_pairs(
    df: DataFrame,
    key: str,
    column_name: str,
    min_length: int = MIN_LENGTH,
    fuzz_func: str = SCORER,
    threshold: float = THRESHOLD,
    block_characters: int | None = None,
) -> DataFrame:
    """(id_i, id_j, score, copies_i, copies_j) of the similar distinct texts.

    A text goes by the smallest response key that holds it, and ``copies`` says
    how many do; a row with id_i = id_j stands for the copies of one text. A
    pair counts if either text has ``min_length`` characters.
    """
    _check(threshold)
    texts = distinct_texts(df, key, column_name, min_length, fuzz_func)
    pairs = _pairs_of_texts(texts, _key_type(df, key), fuzz_func, threshold, block_characters)
    return pairs.unionByName(
        texts.where("copies > 1 AND long").selectExpr(
            "first_id AS id_i", "first_id AS id_j", "100 AS score", "copies AS copies_i", "copies AS copies_j"
        )
    )


def similar_members(
    df: DataFrame, key: str, column_name: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """(representative, response key) of every response: who stands for its text in ``similar_pairs``.

    With this table the pairs tell all similar responses, at a size that grows with
    the responses and not with the pairs of copies.
    """
    text = F.coalesce(col_(column_name).cast("string"), F.lit(""))
    rows = df.select(col_(key).alias(key), text_key(text).alias("text_key"))
    texts = rows.groupBy("text_key").agg(F.min(col_(key)).alias("representative"), F.count("*").alias("copies"))
    found = join_per_key(rows, texts, ["text_key"], "copies", col_(key), hot_rows)
    return found.select("representative", col_(key))


def _pairs_of_texts(
    texts: DataFrame, key_type: str, scorer: str, threshold: float, block_characters: int | None
) -> DataFrame:
    """The similar pairs of different texts; each is found in one way only."""
    least = math.ceil(threshold)
    schema = _PAIR.format(key=key_type)
    if block_characters is None and is_small(texts, FEW_TEXTS):
        # Not worth a plan.
        return texts.repartition(1).mapInArrow(_all_pairs(scorer, least), schema)

    def compare(block: pd.DataFrame):
        return _Block(block, scorer, least).pairs

    if scorer not in TOKEN_SET_SCORERS:
        shaped = texts.select("first_id", F.col("form").alias("shape"), "long", "copies")
        return compare_blocks(shaped, least, compare, schema, block_characters)
    distinct = F.array_join(F.array_distinct(F.split("form", " ")), " ")
    shaped = texts.select("first_id", distinct.alias("shape"), "form", "long", "copies")
    found = compare_blocks(shaped.where("shape <> ''"), least, compare, schema, block_characters)
    if scorer == "token_ratio":
        whole = texts.select("first_id", F.col("form").alias("shape"), "form", "long", "copies")

        def compare_whole(block: pd.DataFrame):
            return _Block(block, scorer, least, whole=True).pairs

        found = found.unionByName(compare_blocks(whole, least, compare_whole, schema, block_characters))
    return found.unionByName(_pairs_by_tokens(texts, scorer, least, schema))


def _pairs_by_tokens(texts: DataFrame, scorer: str, least: int, schema: str) -> DataFrame:
    """The pairs that reach the score by what they share."""
    postings = stage_table(token_postings(texts, least), "postings")
    candidates = stage_table(candidate_pairs(postings), "candidates")
    # Pairs may be very many more than texts, so they get their texts in rounds.
    held = texts.agg(F.coalesce(F.sum(F.length("form") + 1), F.lit(0)).alias("characters"), F.count("*").alias("texts")).first()
    copied = 2 * candidates.count() * held["characters"] / max(held["texts"], 1)
    rounds = math.ceil(copied / max(text_blocks.ROUND_CHARACTERS, 2 * held["characters"])) or 1

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pandas()
            values = np.zeros(len(rows), dtype=np.int32)
            for n, (a, b) in enumerate(zip(rows["form_i"], rows["form_j"], strict=True)):
                one, other = Tokens.of(a), Tokens.of(b)
                if int(sharing_score(one, other)) >= least:
                    values[n] = token_score(scorer, one, other, least)
            found = rows[values >= least].assign(score=values[values >= least])
            yield pa.RecordBatch.from_pandas(found[_PAIR_COLUMNS], preserve_index=False)

    def scored(pairs: DataFrame) -> DataFrame:
        found = with_texts(pairs, texts)
        return found.select("id_i", "id_j", "form_i", "form_j", "copies_i", "copies_j").mapInArrow(score, schema)

    if rounds == 1:
        return scored(candidates)
    own = F.pmod(F.xxhash64("id_i", "id_j", F.lit(3)), F.lit(rounds))
    parts = (scored(candidates.where(own == number)) for number in range(rounds))
    return stage_rounds(texts.sparkSession, parts, schema, "token-pairs")


def _all_pairs(scorer: str, least: int):
    """All texts of a task, each with each."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pd.concat([pd.DataFrame(), *(batch.to_pandas() for batch in batches)], ignore_index=True)
        found = []
        if len(rows) and scorer in TOKEN_SET_SCORERS:
            texts, long = [Tokens.of(form) for form in rows["form"]], rows["long"].to_list()
            for i, j in combinations(range(len(rows)), 2):
                if (long[i] or long[j]) and (value := token_score(scorer, texts[i], texts[j], least)) >= least:
                    found.append((i, j, value))
        elif len(rows):
            batch = _Block(rows.assign(shape=rows["form"]), scorer, least).pairs(None, None)
            if batch is not None:
                yield batch
        if found:
            yield _pair_batch(rows, rows, *(np.array(column) for column in zip(*found, strict=True)))

    return task


class _Beside:
    """Texts side by side, whose common subsequences with another text are found for a pack of them at once."""

    def __init__(self, texts: list[str]):
        self.texts = texts
        self.packs: dict[int, Pack] = {}
        self.single: dict[int, Pack] = {}

    def common(self, near: np.ndarray, text: str, needed: np.ndarray) -> np.ndarray:
        """Lengths of the longest common subsequences with the texts at ``near``, which ascend.

        Where a length falls short of ``needed``, some smaller one may be returned.
        """
        common = np.zeros(len(near), dtype=np.int64)
        if not len(near):
            return common
        packs = near // _PACK
        starts = np.flatnonzero(np.append(True, packs[1:] != packs[:-1])).tolist()
        for start, stop in zip(starts, [*starts[1:], len(near)], strict=True):
            if stop - start >= _WORTH_A_PACK:
                number = int(packs[start])
                if number not in self.packs:
                    self.packs[number] = pack(self.texts[number * _PACK : (number + 1) * _PACK])
                least = np.full(len(self.packs[number].lengths), np.inf)
                least[near[start:stop] - number * _PACK] = needed[start:stop]
                found = np.array(lcs_lengths(text, self.packs[number], least))
                common[start:stop] = found[near[start:stop] - number * _PACK]
                continue
            for at, place in enumerate(near[start:stop].tolist(), start):
                if place not in self.single:
                    self.single[place] = pack([self.texts[place]])
                common[at] = lcs_lengths(text, self.single[place])[0]
        return common


class _Block:
    """Texts that are scored side by side against one visitor after the other.

    For token sets, ``shape`` has each token once, and pairs that reach the score by
    what they share are left to the index. ``whole`` finds those that remain by all of their tokens.
    """

    def __init__(self, block: pd.DataFrame, scorer: str, least: int, whole: bool = False):
        lengths = block["shape"].str.len()
        self.rows = block.assign(length=lengths).sort_values(["length", "first_id"], ignore_index=True)
        self.scorer, self.least, self.whole = scorer, least, whole
        self.shapes = self.rows["shape"].to_list()
        self.lengths, self.long = self.rows["length"].to_numpy(), self.rows["long"].to_numpy()
        self.counts = character_counts(self.shapes)
        self.whole_shapes = _Beside(self.shapes)
        self.tokens = [Tokens.of(form) for form in self.rows["form"]] if scorer in TOKEN_SET_SCORERS else []
        self.holders: dict[str, list[int]] = defaultdict(list)
        for place, tokens in enumerate(self.tokens):
            for token in tokens.tokens:
                self.holders[token].append(place)

    def pairs(self, _, visitors: pd.DataFrame | None) -> pa.RecordBatch | None:
        """Scores of the visitors, or of the block's own pairs, as a batch of pairs."""
        other = self.rows if visitors is None else visitors
        places, visits, values = [], [], []
        counts = self.counts if visitors is None else character_counts(other["shape"].to_list())
        columns = zip(other["shape"], counts, other["long"], other["form"] if self.tokens else other["shape"], strict=True)
        for visit, (shape, count, is_long, form) in enumerate(columns):
            after = visit + 1 if visitors is None else 0
            place, value = self._matches(shape, count, is_long, form, after)
            if len(place):
                places.append(place)
                visits.append(np.full(len(place), visit))
                values.append(value)
        if not places:
            return None
        i, j, value = map(np.concatenate, (places, visits, values))
        return _pair_batch(self.rows, other, i, j, value)

    def _matches(self, shape: str, count: np.ndarray, is_long: bool, form: str, after: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of the block's texts from ``after`` on that are similar to a text."""
        length = len(shape)
        lengths = self.lengths[after:]
        allowed = percent(np.minimum(lengths, length), lengths + length).astype(np.int64) >= self.least
        if not is_long:
            allowed &= self.long[after:]
        if self.scorer == "QRatio":
            allowed &= (lengths > 0) & (length > 0)
        near = np.flatnonzero(allowed) + after
        if self.tokens and not self.whole:
            return self._token_matches(near, shape, count, Tokens.of(form))
        shared = np.minimum(self.counts[near], count).sum(axis=1)
        near = near[percent(shared, self.lengths[near] + length).astype(np.int64) >= self.least]
        total = self.lengths[near] + length
        needed = np.floor(total * (self.least - 1e-6) / 200)
        values = percent(self.whole_shapes.common(near, shape, needed), total).astype(np.int64)
        near, values = near[values >= self.least], values[values >= self.least]
        if self.whole:
            return self._only_by_whole(near, Tokens.of(form))
        return near, values

    def _token_matches(self, near: np.ndarray, shape: str, count: np.ndarray, text: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """By the tokens that only one of two texts has, for pairs that share too little to be found by that."""
        total = self.lengths[near] + len(shape)
        shared = np.minimum(self.counts[near], count).sum(axis=1)
        near = near[100 - 100 * (total - 2 * shared) / np.maximum(total, 1) >= self.least - 1e-6]
        held = [(len(token), self.holders[token]) for token in text.tokens if token in self.holders]
        size = len(self.rows)
        places = np.concatenate([np.array(p) for _, p in held] or [np.zeros(0, dtype=np.int64)])
        weights = np.repeat([n for n, _ in held], [len(p) for _, p in held])
        number = np.bincount(places, minlength=size)[near]
        letters = np.bincount(places, weights=weights, minlength=size)[near]
        # What both hold, joined; and what each has besides, with the space in between.
        joined = letters + np.maximum(number - 1, 0)
        joint = np.minimum(number, 1)
        total = self.lengths[near] + len(shape)
        own, other = (lengths - joined - joint for lengths in (self.lengths[near], len(shape)))
        by_sharing = np.maximum(
            *(100 - 100 * (joint + rest) / np.maximum(joined + rest + joint + joined, 1) for rest in (own, other))
        ) * joint
        least_edits = 100 - 100 * np.abs(own - other) / np.maximum(total, 1)
        open_ = (by_sharing < self.least + 1e-6) & (least_edits >= self.least - 1e-6)
        near, apart, total = near[open_], (own + other)[open_], total[open_]
        # What the tokens of their own have in common is no longer than what the whole shapes have.
        needed = np.floor((apart - total * (100 - self.least + 1e-6) / 100) / 2)
        edits = apart - 2 * self.whole_shapes.common(near, shape, needed)
        near = near[100 - 100 * edits / np.maximum(total, 1) >= self.least - 1e-6]
        values = np.zeros(len(near), dtype=np.int64)
        for n, place in enumerate(near.tolist()):
            if int(sharing_score(text, self.tokens[place])) < self.least:
                # Without the whole forms, which have a search of their own.
                value = token_score("token_set_ratio", text, self.tokens[place], self.least)
                if value >= self.least:
                    values[n] = token_score(self.scorer, text, self.tokens[place], self.least)
        return near[values > 0], values[values > 0]

    def _only_by_whole(self, near: np.ndarray, text: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """Those that do not reach the score as token sets."""
        values = np.zeros(len(near), dtype=np.int64)
        for n, place in enumerate(near.tolist()):
            if token_score("token_set_ratio", text, self.tokens[place], self.least) < self.least:
                values[n] = token_score(self.scorer, text, self.tokens[place], self.least)
        return near[values > 0], values[values > 0]


def _pair_batch(left: pd.DataFrame, right: pd.DataFrame, i: np.ndarray, j: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
    id_i, id_j = left["first_id"].to_numpy()[i], right["first_id"].to_numpy()[j]
    copies_i, copies_j = left["copies"].to_numpy()[i], right["copies"].to_numpy()[j]
    swap = id_i > id_j
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.where(swap, id_j, id_i)),
            pa.array(np.where(swap, id_i, id_j)),
            pa.array(value.astype(np.int32)),
            pa.array(np.where(swap, copies_j, copies_i)),
            pa.array(np.where(swap, copies_i, copies_j)),
        ],
        _PAIR_COLUMNS,
    )


def similar_answers(
    df: DataFrame,
    key: str,
    column_name: str,
    min_length: int = MIN_LENGTH,
    fuzz_func: str = SCORER,
    threshold: float = THRESHOLD,
    count_name: str = "similar_count",
    list_name: str | None = "similar_list",
    block_characters: int | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """(key, number of similar responses, list of them) for responses that have any.

    The list shows each distinct similar text once, as ``id. (score) "text"``
    with the smallest response key that holds it, followed by ``xN`` if N
    responses do. Pass ``list_name=None`` for the count alone.
    """
    _check(threshold)
    texts = distinct_texts(df, key, column_name, min_length, fuzz_func)
    pairs = _pairs_of_texts(texts, _key_type(df, key), fuzz_func, threshold, block_characters)
    own = texts.where("copies > 1 AND long").select("first_id", (F.col("copies") - 1).alias("n"))
    if list_name is None:
        # Each pair is used once, so it need not be written.
        sides = F.array(F.struct(F.col("id_i").alias("first_id"), F.col("copies_j").alias("n")),
                        F.struct(F.col("id_j").alias("first_id"), F.col("copies_i").alias("n")))
        counted = pairs.select(F.inline(sides)).unionByName(own).groupBy("first_id").agg(F.sum("n").alias(count_name))
        return _per_response(df, key, column_name, texts, counted, hot_rows).select(key, col_(count_name))
    pairs = stage_table(pairs, "similar-pairs")
    lists = similar_lists(pairs, texts, count_name, list_name)
    held = _per_response(df, key, column_name, texts, lists, hot_rows)
    is_first = F.col(key) == F.col("__first_id")
    shown = F.when(is_first, col_(list_name)).otherwise(F.coalesce(F.col("for_copies"), col_(list_name)))
    return held.select(key, col_(count_name), shown.alias(list_name))


def _per_response(df: DataFrame, key: str, column_name: str, texts: DataFrame, per_text: DataFrame, hot_rows: int) -> DataFrame:
    """What the distinct texts have, for each response that holds one; (first_id, ...) -> (key, __first_id, ...)."""
    per_key = texts.select("first_id", "text_key", "copies").join(per_text, "first_id")
    per_key = per_key.withColumnRenamed("first_id", "__first_id")
    rows = df.select(
        col_(key).alias(key), text_key(F.coalesce(col_(column_name).cast("string"), F.lit(""))).alias("text_key")
    )
    return join_per_key(rows, per_key, ["text_key"], "copies", F.col(key), hot_rows, sizes=texts)


def similar_lists(pairs: DataFrame, texts: DataFrame, count_name: str, list_name: str) -> DataFrame:
    """(first_id, count, list, for_copies) of each distinct text that has similar ones.

    One pass over the entries, sorted by text and by whom they name: the task
    holds the list it is writing and a batch of entries. The entry for a text's own copies names
    the last one for the first response and the first one for the others, so texts with copies get a second list.
    """
    own = texts.where("copies > 1 AND long")
    sides = F.array(
        F.struct(F.col("id_i").alias("first_id"), F.col("id_j").alias("other"), "score", F.col("copies_j").alias("n")),
        F.struct(F.col("id_j").alias("first_id"), F.col("id_i").alias("other"), "score", F.col("copies_i").alias("n")),
    )
    entries = stage_table(pairs.select(F.inline(sides)), "similar-sides")
    counts = entries.groupBy("other").agg(F.count("*").alias("entries"))
    named = texts.select(F.col("first_id").alias("other"), "text")
    shown = join_per_key(entries, named, ["other"], "entries", F.col("first_id"), LANE_POSTINGS, sizes=counts)
    # An entry is for both lists, or for one of them.
    columns = ["first_id", "other", "score", "text", "n"]
    itself = own.select("first_id", F.lit(100).alias("score"), "text", (F.col("copies") - 1).alias("n"), "last_id")
    shown = (
        shown.select(*columns, F.lit(0).alias("list"))
        .unionByName(itself.select("first_id", F.col("last_id").alias("other"), "score", "text", "n", F.lit(1).alias("list")))
        .unionByName(itself.select("first_id", F.col("first_id").alias("other"), "score", "text", "n", F.lit(2).alias("list")))
    )
    schema = T.StructType([texts.schema["first_id"]]).add(count_name, T.LongType())
    schema = schema.add(list_name, T.StringType()).add("for_copies", T.StringType())
    return shown.repartition("first_id").sortWithinPartitions("first_id", "other", "list").mapInArrow(_listed(schema.names), schema)


@dataclass
class _List:
    """The list that a task is writing, as text."""

    owner: object
    count: int = 0
    first: StringIO = field(default_factory=StringIO)
    rest: StringIO = field(default_factory=StringIO)
    copies: bool = False

    def add(self, entry: str, n: int, which: int) -> None:
        if which < 2:
            self.count += n
            self.first.write(f"; {entry}" if self.first.tell() else entry)
        if which != 1:
            self.rest.write(f"; {entry}" if self.rest.tell() else entry)
        self.copies = self.copies or which == 2

    def batch(self, names: list[str], kind: pa.DataType) -> pa.RecordBatch:
        row = self.owner, self.count, self.first.getvalue(), self.rest.getvalue() if self.copies else None
        kinds = kind, pa.int64(), pa.string(), pa.string()
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names)


def _listed(names: list[str]):
    """Entries sorted by text -> one row per text."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writing, kind = None, None
        for batch in batches:
            kind = batch.column(0).type
            for owner, other, score, text, n, which in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if writing is None or writing.owner != owner:
                    if writing is not None:
                        yield writing.batch(names, kind)
                    writing = _List(owner)
                writing.add(f'{other}. ({score}) "{text}"' + (f" x{n}" if n > 1 else ""), n, which)
        if writing is not None:
            yield writing.batch(names, kind)

    return task
