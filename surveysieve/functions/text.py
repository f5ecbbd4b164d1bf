"""Text normalisation shared by the checks on names, answers and duplicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space at the ends of an answer.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: a word character is a letter, a number or an underscore of any script.
WORD_CHARACTER = r"[\p{L}\p{N}_]"

# Texts shorter than a SHA-256 digest in hex are their own key.
_DIGEST_LENGTH = 64


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE_SPACE))


def normalise(text: Column) -> Column:
    """Lower case without white space at the ends."""
    return strip(F.lower(text))


def words(text: Column, min_length: int) -> Column:
    """Lower-cased runs of at least ``min_length`` word characters, as an array."""
    pattern = f"({WORD_CHARACTER}{{{int(min_length)},}})"
    return F.regexp_extract_all(normalise(text), F.lit(pattern), F.lit(1))


def text_key(text: Column) -> Column:
    """A key that is equal exactly for equal texts and never long.

    Long texts are replaced by the digest of the whole text, so shuffles on the
    key carry at most 64 bytes a row. A short text cannot equal a digest, since
    it is shorter.
    """
    return F.when(F.octet_length(text) < _DIGEST_LENGTH, text).otherwise(F.sha2(text, 256))


def sorted_tokens(text: Column) -> Column:
    """White-space separated tokens in code point order, joined by one space."""
    tokens = F.split(strip(text), "[" + WHITE_SPACE + "]+")
    return F.array_join(F.array_sort(tokens), " ")
