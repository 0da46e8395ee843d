"""Word and character n-grams as Column functions (analyzers)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions.clean import let
from textloom.functions.patterns import SPACES
from textloom.functions.profile import tokens

Analyzer = Callable[[Column], Column]


def word_ngrams(words: Column, lo: int = 1, hi: int = 2) -> Column:
    """Space-joined n-grams of a token array for n from lo to hi, shorter ones first.

    The grams of length n+1 are those of length n, each glued to the word that follows, so that
    one pass per length suffices and lambdas read nothing but their own arguments.
    """

    def longer(grams: Column, w: Column, n: int) -> Column:
        count = F.greatest(F.size(w) - F.lit(n), F.lit(0))
        following = F.slice(w, F.lit(n + 1), count)
        return F.zip_with(F.slice(grams, F.lit(1), count), following, lambda g, x: F.concat(g, F.lit(" "), x))

    def collect(grams: Column, w: Column, n: int) -> Column:
        if n == hi:
            return grams
        return let(
            longer(grams, w, n),
            lambda more: F.concat(grams, collect(more, w, n + 1)) if n >= lo else collect(more, w, n + 1),
        )

    return let(words, lambda w: collect(w, w, 1))


def char_ngrams(text: Column, lo: int = 3, hi: int = 5) -> Column:
    """Character n-grams of the lower-cased, space-squashed text with one space on each side.

    A look-ahead captures the longest n-gram at every position, so one regular-expression pass finds all
    overlapping n-grams: shorter ones are its beginnings. Positions inside a surrogate pair are no positions.
    """
    squashed = F.trim(F.regexp_replace(F.lower(text), SPACES, " "))
    padded = F.concat(F.lit(" "), squashed, F.lit(" "))
    longest = F.regexp_extract_all(padded, F.lit(f"(?s)(?![\\x{{DC00}}-\\x{{DFFF}}])(?=(.{{{lo},{hi}}}))"), F.lit(1))

    def of_length(grams: Column, n: int) -> Column:
        # The last n - lo positions are too close to the end for n characters.
        full = F.slice(grams, F.lit(1), F.greatest(F.size(grams) - F.lit(n - lo), F.lit(0)))
        return full if n == hi else F.transform(full, lambda g: F.substring(g, 1, n))

    return let(longest, lambda g: F.concat(*[of_length(g, n) for n in range(lo, hi + 1)]))


def word_analyzer(lo: int = 1, hi: int = 2) -> Analyzer:
    return lambda text: word_ngrams(tokens(text), lo, hi)


def char_analyzer(lo: int = 3, hi: int = 5) -> Analyzer:
    return lambda text: char_ngrams(text, lo, hi)


def long_word_analyzer(lo: int = 1, hi: int = 2, min_chars: int = 2) -> Analyzer:
    """Word n-grams over tokens of at least ``min_chars`` characters."""
    return lambda text: word_ngrams(
        F.filter(tokens(text), lambda t: F.char_length(t) >= min_chars), lo, hi
    )
