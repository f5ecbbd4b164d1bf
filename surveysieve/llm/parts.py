"""Encoding texts by parts that recur, found and looked up with numpy."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import xxhash

from surveysieve.llm.hashing import mixed

_SPACES = np.zeros(256, dtype=bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True

_STOPS = np.zeros(256, dtype=bool)
_STOPS[[ord("."), ord(",")]] = True
_ALNUM = np.array([bytes([byte]).isalnum() for byte in range(256)])

# Bytes that end a character of which one cannot tell here that it is no white space.
_UNSURE = _SPACES.copy()
_UNSURE[28:32] = True

# Longer parts are hashed one by one.
LONG_PART = 64

# Odd constants of the two hashes; any would do.
_SEEDS = np.array([0x9E3779B97F4A7C15, 0xD1B54A32D192ED03], dtype=np.uint64)


def final_stops(data: np.ndarray) -> np.ndarray:
    """Places of stops and commas between an ASCII letter or digit and white space, where a token always begins."""
    places = np.flatnonzero(_STOPS[data])
    places = places[(places > 0) & (places < len(data) - 1)]
    return places[_ALNUM[data[places - 1]] & _SPACES[data[places + 1]]]


def word_places(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of what ASCII white space separates, final stops being parts of their own."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = ~_SPACES[data]
    begins, ends = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
    begins[(stops := final_stops(data))] = True
    ends[stops] = True
    return np.flatnonzero(begins), np.flatnonzero(ends)


def chunk_places(data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of parts that begin with white space behind another character, or with a text.

    ``first`` are the places where texts begin. Behind bytes that may end a white
    space character beyond ASCII nothing is cut.
    """
    n = len(data)
    if not n:
        return first[:0], first[:0]
    sure = ~_UNSURE[data]
    wide = np.flatnonzero(data >= 0x80)
    if len(wide):
        before = np.zeros(n + 3, dtype=np.uint8)
        before[3:] = data
        two, three = before[wide + 2], before[wide + 1]
        last = data[wide]
        doubt = (two == 0xC2) & ((last == 0x85) | (last == 0xA0))
        doubt |= (three >= 0xE1) & (three <= 0xE3) & ((two == 0x9A) | (two == 0x80) | (two == 0x81))
        sure[wide] = ~doubt
    cut = np.zeros(n, dtype=bool)
    cut[1:] = _SPACES[data[1:]] & sure[:-1]
    cut[final_stops(data)] = True
    cut[first[first < n]] = True
    starts = np.flatnonzero(cut)
    return starts, np.append(starts[1:], n)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each part."""
    sizes = ends - starts
    padded = np.zeros(len(data) + 8, dtype=np.uint8)
    padded[: len(data)] = data
    # Eight bytes from any place on, without copying.
    words = np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), shape=(len(data) + 1,), strides=(1,))
    with np.errstate(over="ignore"):
        first, second = (mixed(sizes.astype(np.uint64) + seed) for seed in _SEEDS)
        todo, done = np.flatnonzero((sizes > 0) & (sizes <= LONG_PART)), 0
        while len(todo):
            left = sizes[todo] - done
            unused = (8 * np.maximum(8 - left, 0)).astype(np.uint64)
            value = words[starts[todo] + done] & (np.uint64(2**64 - 1) >> unused)
            first[todo] = mixed(first[todo] * np.uint64(3) + value * _SEEDS[0])
            second[todo] = (second[todo] ^ value) * _SEEDS[1]
            second[todo] ^= second[todo] >> np.uint64(29)
            todo, done = todo[left > 8], done + 8
    for place in np.flatnonzero(sizes > LONG_PART).tolist():
        part = data[starts[place] : ends[place]].tobytes()
        first[place], second[place] = xxhash.xxh3_64_intdigest(part), xxhash.xxh3_64_intdigest(part, 1)
    return first, second


class PartEncoder:
    """Encodes texts by their parts, each new part once, and keeps the parts' ids between calls.

    A text is cut where white space follows another character (``words``: at all
    white space, which then counts for nothing), and before a final stop or comma:
    no token of the vocabularies used here crosses such a place, and no part's tokens depend on its neighbours, so
    the parts' ids in a row are the text's ids. Parts are told apart by two
    64-bit hashes. ``encode`` maps new parts to their ids, as little-endian bytes.
    Of the parts, those of the last ``limit`` new ones are kept, and those used
    since the ``limit`` before.
    """

    def __init__(self, encode: Callable[[list[bytes]], list[bytes]], words: bool = False, limit: int = 600_000):
        self._encode, self._words, self._limit = encode, words, limit
        self._kept: dict[bytes, bytes] = {}
        self._older: dict[bytes, bytes] = {}

    def __call__(self, texts: Sequence[bytes]) -> list[bytes]:
        """Ids of each text as one bytes object."""
        # Texts that are cut at all white space are kept apart by some.
        joint = b"\n" if self._words else b""
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + len(joint)
        text_ends = np.cumsum(lengths)
        data = np.frombuffer(joint.join(texts), dtype=np.uint8)
        starts, ends = word_places(data) if self._words else chunk_places(data, text_ends - lengths)
        distinct, keys, parts = _distinct(data, starts, ends)
        ids = self._ids(data, starts[distinct], ends[distinct], keys)
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), dtype="<u4")
        first = np.cumsum(sizes) - sizes
        own = sizes[parts]
        after = np.cumsum(own)
        total = int(after[-1]) if len(after) else 0
        places = np.repeat(first[parts] - (after - own), own) + np.arange(total)
        out = memoryview(flat[places].tobytes())
        # The ids of a text end where the parts that start before its end do.
        counts = np.searchsorted(starts, text_ends)
        cuts = [0, *(4 * np.concatenate([[0], after])[counts]).tolist()]
        return [bytes(out[a:b]) for a, b in zip(cuts, cuts[1:])]

    def _ids(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: list[bytes]) -> list[bytes]:
        """Ids of distinct parts."""
        if len(self._kept) > self._limit:
            self._kept, self._older = {}, self._kept
        kept, older = self._kept, self._older
        ids = list(map(kept.get, keys))
        new = [place for place, own in enumerate(ids) if own is None]
        if older and new:
            for place in new:
                if (own := older.get(keys[place])) is not None:
                    ids[place] = kept[keys[place]] = own
            new = [place for place in new if ids[place] is None]
        if new:
            whole = data.tobytes()
            fresh = self._encode([whole[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist())])
            kept.update(zip([keys[place] for place in new], fresh, strict=True))
            for place, own in zip(new, fresh):
                ids[place] = own
        return ids


def _distinct(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Places and hashes of one of each distinct part, and for each part which of them it is."""
    first, second = hashes(data, starts, ends)
    parts = pa.array(first).dictionary_encode().indices.to_numpy()
    distinct = np.zeros(int(parts.max()) + 1 if len(parts) else 0, dtype=np.int64)
    distinct[parts] = np.arange(len(parts))
    if (second[distinct][parts] != second).any():
        # Some parts share the first hash alone.
        _, distinct, parts = np.unique(np.stack([first, second], axis=1), axis=0, return_index=True, return_inverse=True)
        parts = parts.reshape(-1)
    buffer = np.stack([first[distinct], second[distinct]], axis=1).tobytes()
    return distinct, [buffer[i : i + 16] for i in range(0, len(buffer), 16)], parts
