"""Ids of the tokenizers library, each distinct part of a text encoded once per worker."""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
from tokenizers import Tokenizer

from surveysieve.llm.common import on_process
from surveysieve.llm.parts import PartEncoder

_OTHER_SPACE = re.compile(r"[^\S ]")

# A space and letters that every version of Unicode knows: one word for byte-level vocabularies.
_WORD = re.compile(r" [A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u021f]+")

# Small letters that are whole characters: one word, that stays as it is, for vocabularies that put letters in lower case.
_LOWER_WORD = re.compile(r"[a-z\u00df-\u00f6\u00f8-\u00ff]+")

# How vocabularies of either kind change texts and cut them into words, and their characters for the bytes of these words.
_BYTE_WORDS = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
_LOWER_WORDS = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        _BYTE_WORDS | {"use_regex": False},
    ],
}
_BYTE_CHARACTERS = np.arange(256, dtype="<u4")
_BYTE_CHARACTERS[[0x20, 0xAD]] = 0x120, 0x143
_BYTE_CHARACTERS[0x7F:0xA1] = np.arange(0x121, 0x143)
_LOWER_CASE = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}

# Parts that the library encodes in one call, as one text.
JOINED = 256

# Words that its model encodes before their ids are dealt out.
WORDS = 1_024


def load(path: str) -> Tokenizer:
    """The library's tokenizer without truncation, padding or threads of its own."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class LibraryEncoder:
    """Ids of parts of texts by the library.

    Many parts are given to it as one text, so joined that no token crosses from
    one to the next; the ids are dealt out by the bytes that each token stands
    for. Parts that may hold special tokens or white space other than ASCII's, or
    that the next one could change, are encoded one by one. What is one word to the
    vocabulary goes straight to the library's model, in the characters that stand for its bytes.
    """

    def __init__(self, path: str, joint: bytes):
        self.tokenizer, self.joint = load(path), joint
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        ending = model["model"].get("end_of_word_suffix") or ""
        vocabulary = model["model"]["vocab"]
        self.sizes = np.zeros(max(vocabulary.values()) + 1 + len(model["added_tokens"]), dtype=np.int64)
        for token, number in vocabulary.items():
            # Each character stands for one byte here.
            self.sizes[number] = len(token.removesuffix(ending)) if ending else len(token)
        self.openings = {token["content"][:2] for token in model["added_tokens"]}
        steps = model["normalizer"], model["pre_tokenizer"]
        direct = (
            model["model"]["type"] == "BPE"
            and model["model"].get("dropout") is None
            # A special token of letters alone would have to be looked for in them.
            and not any(token["content"].strip().isalpha() for token in model["added_tokens"])
        )
        self.byte_words = direct and not joint and steps == (None, _BYTE_WORDS)
        self.lower_words = direct and bool(joint) and steps == (_LOWER_CASE, _LOWER_WORDS)

    def __call__(self, parts: list[bytes]) -> list[bytes]:
        encode = self._in_blocks if self.joint else self._in_text
        if not (self.byte_words or self.lower_words):
            return encode(parts)
        word = _WORD if self.byte_words else _LOWER_WORD
        simple = [word.fullmatch(text) is not None for text in map(bytes.decode, parts)]
        words = self._of_words([part for part, whether in zip(parts, simple, strict=True) if whether])
        others = iter(encode([part for part, whether in zip(parts, simple, strict=True) if not whether]))
        return [next(words if whether else others) for whether in simple]

    def _of_words(self, parts: list[bytes]) -> Iterator[bytes]:
        tokenize = self.tokenizer.model.tokenize
        for start in range(0, len(parts), WORDS):
            # The line breaks in between stay as they are.
            data = np.frombuffer(b"\n".join(parts[start : start + WORDS]), dtype=np.uint8)
            found = list(map(tokenize, _BYTE_CHARACTERS[data].tobytes().decode("utf-32-le").split("\n")))
            ids = array("I", [token.id for tokens in found for token in tokens]).tobytes()
            cuts = [0, *accumulate(4 * len(tokens) for tokens in found)]
            yield from (ids[a:b] for a, b in zip(cuts, cuts[1:]))

    def _in_text(self, parts: list[bytes]) -> list[bytes]:
        # The text after a part that ends in white space, or a part without any, could change its tokens.
        joinable = [part[:1].isspace() and (part[-1:].isalnum() or not part.decode()[-1].isspace()) for part in parts]
        together = iter(self._in_blocks([part for part, whether in zip(parts, joinable, strict=True) if whether]))
        apart = iter(self._apart([part for part, whether in zip(parts, joinable, strict=True) if not whether]))
        return [next(together if whether else apart) for whether in joinable]

    def _in_blocks(self, parts: list[bytes]) -> list[bytes]:
        out: list[bytes] = []
        for start in range(0, len(parts), JOINED):
            block = parts[start : start + JOINED]
            text = self.joint.join(block).decode()
            changed = self.tokenizer.normalizer is not None and not text.isascii() and _OTHER_SPACE.search(text)
            if changed or any(opening in text for opening in self.openings):
                out += self._apart(block)
            else:
                out += self._dealt(text, block) or self._apart(block)
        return out

    def _dealt(self, text: str, block: list[bytes]) -> list[bytes] | None:
        ids = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        numbers = np.array(ids, dtype="<u4")
        ends, wanted = np.cumsum(self.sizes[numbers]), np.cumsum(self._sizes(text, block))
        places = np.searchsorted(ends, wanted)
        if places[-1] != len(ends) - 1 or (ends[places] != wanted).any():
            return None
        data = numbers.tobytes()
        cuts = [0, *(4 * (places + 1)).tolist()]
        return [data[a:b] for a, b in zip(cuts, cuts[1:])]

    def _sizes(self, text: str, block: list[bytes]) -> list[int]:
        """Bytes of each part as the vocabulary sees it."""
        if self.tokenizer.normalizer is None or text.isascii():
            return list(map(len, block))
        # Parts are joined by the only white space that there is.
        return list(map(len, self.tokenizer.normalizer.normalize_str(text).encode().split(self.joint)))

    def _apart(self, block: list[bytes]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast([part.decode() for part in block], add_special_tokens=False)
        return [array("I", encoding.ids).tobytes() for encoding in encoded]


def spaced_ids(path: str, texts: list[str]) -> list[bytes]:
    """Ids of whole texts as little-endian unsigned 32-bit integers, for byte-level vocabularies."""
    encoder = on_process(("spaced", path), lambda: PartEncoder(LibraryEncoder(path, b""), limit=400_000))
    return encoder([text.encode() for text in texts])


def word_ids(path: str, texts: list[str]) -> list[bytes]:
    """The same for vocabularies that drop white space and put letters in lower case."""
    encoder = on_process(("words", path), lambda: PartEncoder(LibraryEncoder(path, b" "), words=True, limit=200_000))
    return encoder([_lower(text.encode()) for text in texts])


def _lower(text: bytes) -> bytes:
    """ASCII letters are put in lower case first, so that more parts are the same."""
    # A special token's own spelling counts; only such texts hold "<|".
    return text if b"<|" in text else text.lower()
