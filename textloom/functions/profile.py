"""Tokens, flags, keys and lengths used to profile a corpus."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions.clean import let, squash_spaces, strip_special
from textloom.functions.patterns import (
    EMOJI,
    HAS_URL,
    NOT_LETTER,
    SLANG_KEY_LAUGHS,
    SLANG_KEY_WORDS,
    SLANG_MARKS,
    SLANG_WORDS,
    WORD,
)
from textloom.functions.unicode_tables import accent_pairs


def tokens(text: Column) -> Column:
    """Lower-cased maximal runs of word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def strip_accents(text: Column) -> Column:
    """Drop accents as canonical decomposition does; letters such as đ have none to drop."""
    source, target = accent_pairs()
    return F.regexp_replace(F.translate(text, source, target), r"\p{Mn}", "")


def has_emoji(text: Column) -> Column:
    return text.rlike(EMOJI)


def has_url(text: Column) -> Column:
    return text.rlike(HAS_URL)


def no_diacritics(text: Column) -> Column:
    """Has letters, and none of them carries an accent."""
    return let(
        F.regexp_replace(text, NOT_LETTER, ""),
        lambda letters: (letters != "") & (F.lower(strip_accents(letters)) == F.lower(letters)),
    )


def has_slang(text: Column, words: Sequence[str] = SLANG_WORDS, marks: str = SLANG_MARKS) -> Column:
    """A slang word as a whole token, or a mark anywhere in the raw text."""
    listed = F.array(*[F.lit(w) for w in words])
    return F.arrays_overlap(tokens(text), listed) | text.rlike(marks)


def match_key(text: Column) -> Column:
    """Key for comparing texts: lower case, no accents, no punctuation, single spaces."""
    return squash_spaces(strip_special(strip_accents(F.lower(text))))


def has_slang_norm(
    text: Column, words: Sequence[str] = SLANG_KEY_WORDS, laughs: str = SLANG_KEY_LAUGHS
) -> Column:
    """Slang in the match key. Marks such as ``:)`` cannot occur there."""
    listed = F.array(*[F.lit(w) for w in words])
    return let(
        match_key(text),
        lambda key: F.arrays_overlap(F.split(key, " "), listed) | key.rlike(laughs),
    )


def n_tokens(text: Column) -> Column:
    return F.size(tokens(text))


def n_chars(text: Column) -> Column:
    return F.char_length(text)
