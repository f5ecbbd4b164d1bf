"""Burrows-Wheeler transforms of sets of strings, and their merge by refining an interleave.

A symbol of a transform is a gram: the ``step`` bytes in front of a suffix. The transform
of a shard lists these in the order of the shard's sorted suffixes. Merging looks
only at the transforms. The interleave, which says whose suffix comes next, starts as
one shard after the other; each round reads the shards' symbols in its order
and deals them out by symbol, stably, which sorts all suffixes by one gram more.
The round in which two neighbours part tells how much of a prefix they share, and
suffixes that never part are a repeated interval. No suffixes of
different shards are ever compared.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

from surveysieve.llm.hashing import mixed

_BYTES_OF_A_CODE = 8
_LOW = 0xFFFFFFFF
# An odd factor and its inverse, modulo 2**64.
FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(FACTOR, -1, 2**64)


@dataclass(frozen=True)
class Strings:
    """Strings one behind the other, each followed by one unused byte, so that every suffix has a place, the empty one too."""

    text: np.ndarray
    begin: np.ndarray
    end: np.ndarray

    @classmethod
    def of(cls, strings: Sequence[bytes]) -> Strings:
        lengths = np.fromiter(map(len, strings), dtype=np.int64, count=len(strings))
        begin = np.cumsum(lengths + 1) - lengths - 1
        return cls(np.frombuffer(b"\0".join([*strings, b""]), dtype=np.uint8), begin, begin + lengths)

    def spread(self, values: np.ndarray) -> np.ndarray:
        """One value per string -> one per place."""
        return np.repeat(values, self.end - self.begin + 1)


@dataclass(frozen=True)
class Suffixes:
    """Suffixes by ascending places, and the gram that each begins with.

    ``gram`` is a number of an alphabet that all strings have in common, or -1 without a whole
    gram; ``following`` is the suffix behind that gram, or -1.
    """

    place: np.ndarray
    gram: np.ndarray
    following: np.ndarray

    def between(self, first: int, last: int) -> Suffixes:
        """The suffixes of whole strings, by their places."""
        start, stop = np.searchsorted(self.place, (first, last))
        following = self.following[start:stop]
        return Suffixes(self.place[start:stop], self.gram[start:stop], np.where(following < 0, -1, following - start))


@dataclass(frozen=True)
class Shard:
    """The transform of some strings.

    ``place`` has the places of the suffixes, sorted by their first grams; the first
    ``ended`` of them have no whole gram. ``before`` is the gram in front of each suffix, or -1,
    and ``back`` the rank of the suffix that this gram begins.
    """

    place: np.ndarray
    before: np.ndarray
    back: np.ndarray
    ended: int


@dataclass(frozen=True)
class Merged:
    """All suffixes in order, and for each the number of whole grams it shares with the one ahead of it."""

    place: np.ndarray
    shared: np.ndarray


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of FACTOR and of its inverse, modulo 2**64; the largest ones asked for are kept."""
    if _powers.shape[1] < n:
        rows = np.ones((2, n), dtype=np.uint64)
        rows[0, 1:], rows[1, 1:] = np.uint64(FACTOR), np.uint64(_INVERSE)
        with np.errstate(over="ignore"):
            globals()["_powers"] = np.multiply.accumulate(rows, axis=1)
    return _powers[0, :n], _powers[1, :n]


_powers = np.ones((2, 1), dtype=np.uint64)
# Random numbers for the bytes, so that no short text has a special hash.
_BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64))


def gram_codes(text: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit number for each run of ``size`` bytes: the bytes themselves if they fit, else a hash."""
    n = len(text) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        if size <= _BYTES_OF_A_CODE:
            codes = np.zeros(n, dtype=np.uint64)
            for place in range(size):
                codes = (codes << np.uint64(8)) | text[place : place + n]
            return codes
        up, down = powers(len(text))
        sums = np.zeros(len(text) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUES[text] * up, out=sums[1:])
        return mixed((sums[size:] - sums[:n]) * down[:n])


def all_suffixes(strings: Strings, step: int) -> Suffixes:
    """Every suffix of the strings, the empty ones too."""
    place = np.arange(len(strings.text))
    known = np.flatnonzero(place + step <= strings.spread(strings.end))
    gram, following = np.full((2, len(place)), -1, dtype=np.int64)
    gram[known] = _numbered(gram_codes(strings.text, step)[known])
    following[known] = known + step
    return Suffixes(place, gram, following)


def in_windows(strings: Strings, step: int, depth: int, often: np.ndarray) -> Suffixes:
    """Of all suffixes, those in windows of ``depth`` grams that may be repeated, since each gram occurs more than once.

    ``often`` marks strings that stand for several.
    """
    every = all_suffixes(strings, step)
    counts = np.bincount(every.gram + 1)
    again = (every.gram >= 0) & ((counts[every.gram + 1] > 1) | strings.spread(often))
    starts = np.flatnonzero(every.place + depth * step <= strings.spread(strings.end))
    for level in range(depth):
        starts = starts[again[starts + level * step]]
    kept = np.zeros(len(again), dtype=bool)
    for level in range(depth + 1):
        kept[starts + level * step] = True
    place = np.flatnonzero(kept)
    number = np.cumsum(kept) - 1
    has = (every.gram[place] >= 0) & kept[np.minimum(place + step, len(kept) - 1)]
    following = np.where(has, number[np.minimum(place + step, len(kept) - 1)], -1)
    return Suffixes(place, np.where(has, every.gram[place], -1), following)


def build(suffixes: Suffixes, depth: int) -> Shard:
    """The transform of one shard; its own suffixes are sorted by doubling the grams they are sorted by."""
    size = len(suffixes.place)
    # Rank by so many first grams, and the suffix behind these.
    ranks, behind = {1: suffixes.gram + 1}, {1: suffixes.following}
    levels, rank, at = 1, ranks[1], behind[1]
    while levels < depth:
        more = levels if 2 * levels <= depth else 1
        rank = _numbered((rank << 32) | np.where(at >= 0, ranks[more][at], 0))
        at = np.where(at >= 0, behind[more][at], -1)
        levels += more
        ranks[levels], behind[levels] = rank, at
    order = _stable(rank)
    place_of = np.empty(size, dtype=np.int64)
    place_of[order] = np.arange(size)
    known = np.flatnonzero(suffixes.following >= 0)
    ahead = np.full(size, -1, dtype=np.int64)
    ahead[suffixes.following[known]] = known
    ahead = ahead[order]
    before = np.where(ahead >= 0, suffixes.gram[ahead], -1)
    back = np.where(ahead >= 0, place_of[ahead], -1)
    return Shard(suffixes.place[order], before, back, size - len(known))


def _numbered(values: np.ndarray) -> np.ndarray:
    """The number of each value among the ascending distinct ones."""
    order = np.argsort(values)
    ordered = values[order]
    new = np.zeros(len(values), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    numbers = np.empty(len(values), dtype=np.int64)
    numbers[order] = np.cumsum(new)
    return numbers


def _stable(symbols: np.ndarray) -> np.ndarray:
    """Stable order of symbols below 2**31: they are sorted together with their places."""
    keys = symbols.astype(np.int64)
    keys <<= 32
    keys |= np.arange(len(symbols))
    keys.sort()
    keys &= _LOW
    return keys


def merge(shards: Sequence[Shard], depth: int) -> Merged:
    """The suffixes of all shards in order, by at most ``depth`` rounds over their transforms."""
    sizes = np.array([len(s.place) for s in shards], dtype=np.int64)
    offsets = np.cumsum(sizes) - sizes
    before = np.concatenate([s.before for s in shards]).astype(np.int32)
    back = np.concatenate([s.back + at for s, at in zip(shards, offsets, strict=True)]).astype(np.int32)
    ended = np.concatenate([np.arange(at, at + s.ended, dtype=np.int32) for s, at in zip(shards, offsets, strict=True)])
    total = int(sizes.sum())
    interleave, block = np.arange(total, dtype=np.int32), np.zeros(total, dtype=np.int32)
    shared = np.full(total, depth, dtype=np.int32)
    parted = np.zeros(total, dtype=bool)
    for level in range(1, depth + 1):
        symbols = before[interleave]
        known = np.flatnonzero(symbols >= 0)
        source = known[_stable(symbols[known])]
        symbols, origin = symbols[source], block[source]
        # Suffixes without a whole gram share nothing with any other.
        new = np.ones(total, dtype=bool)
        new[len(ended) + 1 :] = (symbols[1:] != symbols[:-1]) | (origin[1:] != origin[:-1])
        interleave[len(ended) :] = back[interleave[source]]
        interleave[: len(ended)] = ended
        shared[new & ~parted] = level - 1
        parted = new
        block = np.cumsum(new, dtype=np.int32)
        if new.all():
            break
    return Merged(np.concatenate([s.place for s in shards])[interleave], shared)


def shards_of(strings: Strings, suffixes: Suffixes, depth: int, shard_bytes: int) -> list[Shard]:
    """The transforms of consecutive strings with about ``shard_bytes`` in each shard."""
    bounds, start = [], 0
    while start < len(strings.begin):
        stop = int(np.searchsorted(strings.begin, strings.begin[start] + max(shard_bytes, 1)))
        bounds.append((strings.begin[start], strings.end[stop - 1] + 1))
        start = stop
    parts = (suffixes.between(*bound) for bound in bounds)
    return [build(part, depth) for part in parts if len(part.place)]


def repeated(strings: Sequence[bytes], often: np.ndarray, length: int, step: int, shard_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """(string, offset) of every run of ``length`` bytes that occurs more than once in ``strings``.

    ``often`` marks strings that stand for several equal ones: all their runs count as repeated.
    The strings are cut into shards of about ``shard_bytes``, and ``step`` must divide ``length``.
    """
    depth, rest = divmod(length, step)
    if rest:
        raise ValueError("step must divide length")
    whole_text = Strings.of(strings)
    shards = shards_of(whole_text, in_windows(whole_text, step, depth, often), depth, shard_bytes)
    if not shards:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    merged = merge(shards, depth)
    place, interval = merged.place, np.cumsum(merged.shared < depth)
    string = np.searchsorted(whole_text.begin, place, side="right") - 1
    whole = place + length <= whole_text.end[string]
    if step > _BYTES_OF_A_CODE:
        interval = _by_content(whole_text.text, place, interval, length)
    weights = np.bincount(interval[whole], weights=1 + often[string[whole]])
    found = np.flatnonzero(whole)
    found = found[weights[interval[found]] > 1]
    return string[found], place[found] - whole_text.begin[string[found]]


def _by_content(text: np.ndarray, place: np.ndarray, interval: np.ndarray, length: int) -> np.ndarray:
    """Interval numbers after comparing the bytes: grams of one hash that differ are told apart."""
    same = np.flatnonzero(interval[1:] == interval[:-1])
    differ = np.zeros(len(same), dtype=bool)
    # The eight bytes from every place on, as one number.
    words = np.ndarray(len(text), dtype="<u8", buffer=np.append(text, np.zeros(7, dtype=np.uint8)), strides=(1,))
    for offset in [*range(0, length - 8, 8), max(length - 8, 0)]:
        differ |= words[place[same] + offset] != words[place[same + 1] + offset]
    if not differ.any():
        return interval
    interval = interval.copy()
    free = int(interval.max()) + 1
    for number in np.unique(interval[same[differ]]).tolist():
        numbers: dict[bytes, int] = {}
        for member in np.flatnonzero(interval == number).tolist():
            content = text[place[member] : place[member] + length].tobytes()
            interval[member] = numbers.setdefault(content, free + len(numbers))
        free += len(numbers)
    return interval
