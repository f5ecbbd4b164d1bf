"""Tokens of sections and fields, from one encoding of the whole document."""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveysieve.llm.bpe import WORDS
from surveysieve.llm.common import on_worker, pick, slices, texts_of

# Which section gets a token that crosses a boundary: that of its first character,
# that of its last one, or the one with most of its bytes (the first of equals).
RULES = ("first", "last", "most")

# Characters that end a line; a line's section includes the one that ends it.
LINE_END = "\n"


class OffsetEncoder:
    """Encodes whole texts and tells the byte offsets at which tokens end."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self._encoding = tiktoken.Encoding("surveysieve", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        self._sizes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            self._sizes[rank] = len(token)

    def ends(self, text: str) -> np.ndarray:
        return np.cumsum(self._sizes[np.array(self._encoding.encode_ordinary(text), dtype=np.int64)])


def attribute(ends: np.ndarray, section_ends: np.ndarray, rule: str = "first") -> np.ndarray:
    """Tokens of each section. Both sequences of ends ascend and reach to the end of the text.

    The spans of tokens and of sections are joined by binary search, each token
    meeting just the sections at its two ends. Empty sections get no tokens.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}, not '{rule}'")
    starts = np.concatenate([[0], ends])[: len(ends)]
    first = np.searchsorted(section_ends, starts, side="right")
    last = np.searchsorted(section_ends, ends - 1, side="right")
    if rule == "first":
        owner = first
    elif rule == "last":
        owner = last
    else:
        owner = first.copy()
        for token in np.flatnonzero(first != last):
            inner = section_ends[first[token] : last[token]]
            sizes = np.diff(np.concatenate([[starts[token]], inner, [ends[token]]]))
            owner[token] = first[token] + int(np.argmax(sizes))
    return np.bincount(owner.astype(np.int64), minlength=len(section_ends))


def line_sections(text: str) -> list[str]:
    """The lines of a text, each with the character that ends it; an empty text is one empty line."""
    lines = text.split(LINE_END)
    sections = [line + LINE_END for line in lines[:-1]]
    return [*sections, lines[-1]] if lines[-1] or not sections else sections


def _counted(encoder: OffsetEncoder, sections: Sequence[str], rule: str) -> tuple[np.ndarray, int]:
    ends = encoder.ends("".join(sections))
    section_ends = np.cumsum([len(section.encode()) for section in sections])
    return attribute(ends, section_ends, rule), len(ends)


SECTIONS = "doc_id long, section int, start long, length long, n_tokens long, doc_tokens long"


def count_sections(docs: DataFrame, vocabulary: str, rule: str = "first") -> DataFrame:
    """Tokens of each line of the whole texts of ``docs`` (doc_id, text).

    One row per line: section (from 0), start and length in code points (with the
    line break), n_tokens, and doc_tokens of the whole document. Each document is
    encoded once as a whole, so the lines' tokens add up to the document's; a
    token across a line break belongs to one line, by ``rule``: that of its first
    character (``first``), of its last one (``last``), or the one that holds most of
    its bytes (``most``, the first of equals).

    A null text is empty; an empty text is one line of no tokens. A null doc_id
    stays null, repeated rows repeat, no rows give no rows; other columns are
    ignored.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}, not '{rule}'")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = on_worker(("offsets", vocabulary), lambda: OffsetEncoder(vocabulary))
        for batch in slices(batches):
            ids, columns = [], [[] for _ in range(5)]
            for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                sections = line_sections(text)
                counts, total = _counted(encoder, sections, rule)
                lengths = np.array([len(section) for section in sections])
                starts = np.cumsum(lengths) - lengths
                ids += [doc_id] * len(sections)
                for column, values in zip(
                    columns, (np.arange(len(sections)), starts, lengths, counts, np.full(len(sections), total)), strict=True
                ):
                    column.append(values)
            kinds = [pa.int32(), *[pa.int64()] * 4]
            arrays = [pa.array(np.concatenate(column), kind) for column, kind in zip(columns, kinds, strict=True)]
            names = [field.split()[0] for field in SECTIONS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *arrays], names)

    return pick(docs, "doc_id", "text").mapInArrow(run, SECTIONS)


def count_fields(rows: DataFrame, key: str, fields: Sequence[str], vocabulary: str, rule: str = "first") -> DataFrame:
    """Tokens of each of several text columns, encoded once as one text with line breaks between.

    Returns key and ``tokens_<field>`` for each field. The line break behind a
    field counts as part of it; there is none behind the last one. Null fields are
    empty.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}, not '{rule}'")
    narrow = pick(rows, key, *fields)
    kind = narrow.schema[0].dataType.simpleString()
    width = len(fields)
    texts = F.array(*(F.coalesce(F.col(f"t{i}"), F.lit("")) for i in range(width)))
    packed = narrow.toDF("key", *(f"t{i}" for i in range(width))).select("key", texts.alias("texts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = on_worker(("offsets", vocabulary), lambda: OffsetEncoder(vocabulary))
        for batch in batches:
            counts = []
            for texts in batch.column(1).to_pylist():
                sections = [*(text + LINE_END for text in texts[:-1]), texts[-1]]
                counts.append(_counted(encoder, sections, rule)[0].tolist())
            yield pa.RecordBatch.from_pydict({"key": batch.column(0), "counts": pa.array(counts, pa.list_(pa.int64()))})

    counted = packed.mapInArrow(run, f"key {kind}, counts array<bigint>")
    names = [F.col("counts")[i].alias(f"tokens_{name}") for i, name in enumerate(fields)]
    return counted.select(F.col("key").alias(key), *names)
