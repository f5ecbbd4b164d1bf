"""Byte-pair encoding by an index of pair occurrences, and decoding."""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from surveysieve.llm.common import on_worker, pick, slices, texts_of
from surveysieve.llm.parts import PartEncoder

# The split into words that byte-level vocabularies of this kind are made for.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

NO_PAIR = np.int32(2**31 - 1)


def byte_characters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if it is printable, else one from 256 on."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = iter(range(256, 512))
    return [chr(byte) if byte in printable else chr(next(others)) for byte in range(256)]


class PairIndexEncoder:
    """Encodes many words at once.

    All words lie in one array of symbols, linked to their neighbours. An index
    holds, for the rank of each pair that occurs, all positions of that pair. The
    least active rank is applied at all its positions at once; each merge
    changes the two pairs around it, whose positions are added to the lists of
    their new ranks, while outdated entries are dropped when their list is used.
    A pair's rank is above those of the merges that made its parts, so that ranks
    only ever grow.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        vocabulary: dict[str, int] = model["model"]["vocab"]
        characters = byte_characters()
        byte_of = {character: byte for byte, character in enumerate(characters)}
        self.byte_ids = np.array([vocabulary[c] for c in characters], dtype=np.int32)
        self.specials = {token["content"]: token["id"] for token in model["added_tokens"]}
        size = max([*vocabulary.values(), *self.specials.values()]) + 1
        self.token_bytes: list[bytes] = [b""] * size
        for token, number in vocabulary.items():
            self.token_bytes[number] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        for token, number in self.specials.items():
            self.token_bytes[number] = token.encode()
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["model"]["merges"]]
        self.left = np.array([vocabulary[a] for a, _ in merges], dtype=np.int32)
        self.right = np.array([vocabulary[b] for _, b in merges], dtype=np.int32)
        self.merged = np.array([vocabulary[a + b] for a, b in merges], dtype=np.int32)
        self._check_order(size)
        keys = self.left.astype(np.int64) * size + self.right
        self._order = np.argsort(keys)
        self._keys, self._size = keys[self._order], size
        self._special = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")") if self.specials else None
        self._words = regex.compile(WORDS)

    def _check_order(self, size: int) -> None:
        made = np.full(size, -1, dtype=np.int64)
        made[self.merged] = np.arange(len(self.merged))
        ranks = np.arange(len(self.merged))
        if len(set(self.merged.tolist())) < len(ranks) or (made[self.left] >= ranks).any() or (made[self.right] >= ranks).any():
            raise ValueError("a merge of this vocabulary comes before the merges of its parts")

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) * self._size + right
        places = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where(self._keys[places] == keys, self._order[places], NO_PAIR).astype(np.int32)

    def words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each non-empty word, as little-endian unsigned 32-bit integers."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(lengths)
        n = int(ends[-1]) if len(words) else 0
        symbols = self.byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)]
        after = np.arange(1, n + 1, dtype=np.int64)
        before = np.arange(-1, n - 1, dtype=np.int64)
        after[ends - 1] = -1
        before[ends - lengths] = -1
        alive = np.ones(n, dtype=bool)
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def add(positions: np.ndarray) -> None:
            """Puts pairs that start at these positions on the lists of their ranks."""
            ranks = self._ranks(symbols[positions], symbols[after[positions]])
            known = ranks != NO_PAIR
            ranks, positions = ranks[known], positions[known]
            order = np.argsort(ranks, kind="stable")
            ranks, positions = ranks[order], positions[order]
            starts = np.flatnonzero(np.diff(ranks, prepend=-1)) if len(ranks) else ranks
            for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(ranks)]):
                rank = int(ranks[start])
                if rank not in index:
                    index[rank] = []
                    heapq.heappush(active, rank)
                index[rank].append(positions[start:end])

        if n:
            add(np.flatnonzero(after >= 0))
        while active:
            rank = heapq.heappop(active)
            lists = index.pop(rank)
            at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            left, right = self.left[rank], self.right[rank]
            following = after[at]
            valid = alive[at] & (symbols[at] == left) & (following >= 0)
            valid &= symbols[following] == right
            at = at[valid]
            if not len(at):
                continue
            if left == right:
                at = _first_of_runs(at, after)
            gone = after[at]
            symbols[at] = self.merged[rank]
            alive[gone] = False
            beyond = after[gone]
            after[at] = beyond
            inside = beyond >= 0
            before[beyond[inside]] = at[inside]
            previous = before[at]
            add(np.unique(np.concatenate([at[inside], previous[previous >= 0]])))
        kept = np.flatnonzero(alive)
        data = memoryview(symbols[kept].astype("<u4").tobytes())
        cuts = (4 * np.searchsorted(kept, np.concatenate([[0], ends]))).tolist()
        return [bytes(data[a:b]) for a, b in zip(cuts, cuts[1:])]

    def parts(self, parts: list[str]) -> list[bytes]:
        """Ids of parts of texts, which may hold several words; each distinct word is encoded once."""
        split: list[list[bytes | int]] = []
        for part in parts:
            own: list[bytes | int] = []
            for piece in self._special.split(part) if self._special else (part,):
                if piece in self.specials:
                    own.append(self.specials[piece])
                else:
                    own += [word.encode() for word in self._words.findall(piece)]
            split.append(own)
        distinct = sorted({word for own in split for word in own if isinstance(word, bytes)})
        ids: dict = dict(zip(distinct, self.words(distinct), strict=True))
        ids.update((number, np.uint32(number).astype("<u4").tobytes()) for number in self.specials.values())
        return [b"".join([ids[word] for word in own]) for own in split]

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        numbers = np.frombuffer(ids, dtype="<u4").tolist()
        return b"".join(map(self.token_bytes.__getitem__, numbers)).decode("utf-8", "replace")


def _first_of_runs(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of overlapping pairs of equal symbols, every other one from the left."""
    chained = np.zeros(len(at), dtype=bool)
    chained[1:] = after[at[:-1]] == at[1:]
    starts = np.flatnonzero(~chained)
    place = np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))
    return at[place % 2 == 0]


def _model(path: str) -> tuple[PairIndexEncoder, PartEncoder]:
    model = PairIndexEncoder(path)
    return model, PartEncoder(lambda parts: model.parts([part.decode() for part in parts]))


def encode_texts(path: str, texts: list[str]) -> list[bytes]:
    _, encoder = on_worker(("bpe", path), lambda: _model(path))
    return encoder([text.encode() for text in texts])


def decode_ids(path: str, rows: list[bytes | None]) -> list[str | None]:
    model, _ = on_worker(("bpe", path), lambda: _model(path))
    return [None if ids is None else model.decode(ids) for ids in rows]


def encode(docs: DataFrame, vocabulary: str, decoded: bool = False) -> DataFrame:
    """Ids of the whole texts of ``docs`` (doc_id, text): doc_id, ids (little-endian unsigned 32-bit integers).

    With ``decoded`` the text that the ids stand for follows. A null text is
    empty and has no ids; special tokens' spellings in a text become those
    tokens. Rows stay as they are: repeated ones repeat, a null doc_id stays
    null, no rows give no rows. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = encode_texts(vocabulary, texts_of(batch.column(1)))
            columns = {"doc_id": batch.column(0), "ids": pa.array(ids, pa.binary())}
            if decoded:
                columns["decoded"] = pa.array(decode_ids(vocabulary, ids), pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id long, ids binary" + (", decoded string" if decoded else "")
    return pick(docs, "doc_id", "text").mapInArrow(run, schema)


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """Texts of (doc_id, ids): doc_id, text. Null ids give a null text, empty ones an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = decode_ids(vocabulary, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "text": pa.array(texts, pa.string())})

    return pick(encoded, "doc_id", "ids").mapInArrow(run, "doc_id long, text string")
