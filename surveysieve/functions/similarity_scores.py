"""Similarity scores of short texts, computed for many partners at once.

All scores rest on the longest common subsequence (LCS) of two texts. A pack
holds several texts side by side in one Python integer, one bit per character
and a guard bit after each text, and the bit-parallel LCS recurrence runs over
all of them together.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

# Scores that depend on the LCS of one prepared form per text.
PLAIN_SCORERS = ("ratio", "QRatio", "token_sort_ratio")
TOKEN_SET_SCORERS = ("token_set_ratio", "token_ratio")
SCORERS = PLAIN_SCORERS + TOKEN_SET_SCORERS


@dataclass(frozen=True)
class Pack:
    lengths: tuple[int, ...]
    offsets: tuple[int, ...]
    positions: dict[str, int]
    full: int


def pack(texts: Sequence[str]) -> Pack:
    lengths, offsets, positions, full, offset = [], [], {}, 0, 0
    for text in texts:
        own: dict[str, int] = {}
        for place, character in enumerate(text):
            own[character] = own.get(character, 0) | (1 << place)
        for character, bits in own.items():
            positions[character] = positions.get(character, 0) | (bits << offset)
        full |= ((1 << len(text)) - 1) << offset
        lengths.append(len(text))
        offsets.append(offset)
        offset += len(text) + 1
    return Pack(tuple(lengths), tuple(offsets), positions, full)


# Where to look whether the rest of a text can still make up for what is missing, as parts of it.
_LOOKS = (0.6, 0.75, 0.88)


def lcs_lengths(text: str, partners: Pack, needed: np.ndarray | None = None) -> list[int]:
    """LCS of a text with each partner; with ``needed``, what was found so far if none can reach its number any more."""
    full, unmatched = partners.full, partners.full
    looks = [int(len(text) * part) for part in _LOOKS] if needed is not None else []
    for start, stop in zip([0, *looks], [*looks, len(text)], strict=True):
        for bits in filter(None, map(partners.positions.get, text[start:stop])):
            matched = unmatched & bits
            # matched is part of unmatched: the exclusive or takes it away, faster than a difference.
            unmatched = ((unmatched + matched) | (unmatched ^ matched)) & full
        if stop < len(text) and (_matched(unmatched, partners) + len(text) - stop < needed).all():
            break
    return _matched(unmatched, partners).tolist()


def _matched(unmatched: int, partners: Pack) -> np.ndarray:
    """Zeros of each partner's part of the state."""
    return np.array(
        [
            length - ((unmatched >> offset) & ((1 << length) - 1)).bit_count()
            for length, offset in zip(partners.lengths, partners.offsets, strict=True)
        ],
        dtype=np.int64,
    )


def percent(common, total):
    """Score of an LCS of ``common`` in texts of ``total`` characters together."""
    if isinstance(total, np.ndarray):
        return (1 - np.divide(total - 2 * common, total, out=np.zeros(len(total)), where=total > 0)) * 100
    return (1 - (total - 2 * common) / total) * 100 if total else 100.0


def token_set_score(a: str, b: str) -> float:
    """Score of the sets of tokens: shared tokens against shared plus own tokens."""
    tokens_a, tokens_b = set(a.split()), set(b.split())
    if not tokens_a or not tokens_b:
        return 0.0
    shared, only_a, only_b = tokens_a & tokens_b, tokens_a - tokens_b, tokens_b - tokens_a
    if shared and (not only_a or not only_b):
        return 100.0
    text_a, text_b = " ".join(sorted(only_a)), " ".join(sorted(only_b))
    shared_length = len(" ".join(shared))
    joint = 1 if shared else 0
    length_a, length_b = (shared_length + joint + len(t) for t in (text_a, text_b))
    edits = len(text_a) + len(text_b) - 2 * lcs_lengths(text_a, pack([text_b]))[0]
    scores = [_from_distance(edits, length_a + length_b)]
    if shared:
        scores += [
            _from_distance(joint + len(text_a), shared_length + length_a),
            _from_distance(joint + len(text_b), shared_length + length_b),
        ]
    return max(scores)


@dataclass(frozen=True)
class Tokens:
    """A prepared form with its set of tokens and their characters, taken apart once."""

    form: str
    tokens: frozenset[str]
    characters: int

    @classmethod
    def of(cls, form: str) -> Tokens:
        tokens = frozenset(form.split())
        return cls(form, tokens, sum(map(len, tokens)))


def sharing_score(a: Tokens, b: Tokens) -> float:
    """The score that two forms reach by the tokens that both have, against those of either one alone."""
    shared = a.tokens & b.tokens
    if not shared:
        return 0.0
    if len(shared) in (len(a.tokens), len(b.tokens)):
        return 100.0
    common = sum(map(len, shared)) + len(shared) - 1
    own = (t.characters + len(t.tokens) - 1 - common for t in (a, b))
    return max(_from_distance(rest, common + common + rest) for rest in own)


def token_score(scorer: str, a: Tokens, b: Tokens, least: int) -> int:
    """The score of two forms by their tokens, if it is at least ``least``; else some lower number.

    What the lengths alone tell is computed first; the common subsequence is only
    looked for where it could raise the score to ``least`` or more.
    """
    best = 0.0
    if a.tokens and b.tokens:
        shared = a.tokens & b.tokens
        if shared and len(shared) in (len(a.tokens), len(b.tokens)):
            return 100
        common, joint = sum(map(len, shared)), 1 if shared else 0
        shared_length = common + max(len(shared) - 1, 0)
        own_a = a.characters - common + len(a.tokens) - len(shared) - 1
        own_b = b.characters - common + len(b.tokens) - len(shared) - 1
        length_a, length_b = shared_length + joint + own_a, shared_length + joint + own_b
        if shared:
            best = max(
                _from_distance(joint + own_a, shared_length + length_a),
                _from_distance(joint + own_b, shared_length + length_b),
            )
        bound = _from_distance(abs(own_a - own_b), length_a + length_b)
        if bound > best and int(bound) >= least:
            text_a, text_b = (" ".join(sorted(tokens - shared)) for tokens in (a.tokens, b.tokens))
            edits = own_a + own_b - 2 * lcs_lengths(text_a, pack([text_b]))[0]
            best = max(best, _from_distance(edits, length_a + length_b))
    if scorer == "token_ratio":
        total = len(a.form) + len(b.form)
        bound = percent(min(len(a.form), len(b.form)), total)
        if bound > best and int(bound) >= least:
            best = max(best, percent(lcs_lengths(a.form, pack([b.form]))[0], total))
    return int(best)


def _from_distance(distance: int, total: int) -> float:
    return 100 - 100 * distance / total if total else 100.0


def score(scorer: str, a: str, b: str) -> float:
    """Score of two prepared forms, one pair at a time."""
    if scorer not in SCORERS:
        raise ValueError(f"similarity must be one of {SCORERS}, not '{scorer}'")
    if scorer == "QRatio" and (not a or not b):
        return 0.0
    if scorer == "token_set_ratio":
        return token_set_score(a, b)
    plain = percent(lcs_lengths(a, pack([b]))[0], len(a) + len(b))
    return max(plain, token_set_score(a, b)) if scorer == "token_ratio" else plain


CHARACTER_CLASSES = 128


def character_counts(texts: Sequence[str], buckets: int = CHARACTER_CLASSES) -> np.ndarray:
    """Occurrences of each character class; characters fall into classes by code point."""
    counts = np.zeros((len(texts), buckets), dtype=np.int32)
    for row, text in enumerate(texts):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        counts[row] = np.bincount(codes % buckets, minlength=buckets)
    return counts
