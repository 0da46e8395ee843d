"""Cleaning steps for social-media text. Each is Column to Column; their order matters."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterable, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from textloom.functions.patterns import (
    COLLAPSIBLE_LETTERS,
    EMOJI,
    EMOTICON_RULES,
    HASHTAG,
    SPACES,
    SPECIAL,
    URL_RUN,
)
from textloom.functions.unicode_tables import emoji_names, not_nfc_class
from textloom.session import materialize

# A lexicon up to this size is looked up inside the row, as part of the plan; a larger one is a table.
INLINE_LEXICON = 1000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.transform(F.array(value), body)[0]


def nfc(text: Column) -> Column:
    """Unicode NFC. Only texts that may change travel to Python; the others are sent as null."""

    def compose(batch: pd.Series) -> pd.Series:
        return batch.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")

    composed = F.pandas_udf(compose, StringType())
    return F.coalesce(composed(F.when(text.rlike(not_nfc_class()), text)), text)


def strip_urls(text: Column) -> Column:
    return F.regexp_replace(text, URL_RUN, "")


def strip_hashtags(text: Column) -> Column:
    return F.regexp_replace(text, HASHTAG, "")


def _name_spans(names: Mapping[str, str], gap: int = 64) -> list[tuple[int, int]]:
    spans: list[list[int]] = []
    for cp in sorted(map(ord, names)):
        if spans and cp - spans[-1][1] <= gap:
            spans[-1][1] = cp
        else:
            spans.append([cp, cp])
    return [(lo, hi) for lo, hi in spans]


def demojize(text: Column, names: Mapping[str, str] | None = None) -> Column:
    """Replace each emoji by its name between spaces.

    ``names`` maps single characters to names. The name is found by code point in an array, and
    only texts that hold an emoji are taken apart.
    """
    default = names is None
    names = emoji_names() if default else names
    pattern = EMOJI if default else "[" + "".join(f"\\x{{{ord(ch):X}}}" for ch in sorted(names)) + "]"
    spans = _name_spans(names)
    # One literal, split when the plan is optimized; gaps in the spans hold an empty name.
    table = F.split(F.lit("|".join(names.get(chr(cp), "") for lo, hi in spans for cp in range(lo, hi + 1))), "\\|", -1)

    def slot(code: Column) -> Column:
        result, offset = F.lit(None).cast("int"), 0
        for lo, hi in spans:
            result = F.when(code.between(lo, hi), code - F.lit(lo - offset)).otherwise(result)
            offset += hi - lo + 1
        return result

    def named(ch: Column) -> Column:
        name = F.nullif(F.get(table, slot(F.ascii(ch))), F.lit(""))
        return F.coalesce(F.concat(F.lit(" "), name, F.lit(" ")), ch)

    def spelled(t: Column) -> Column:
        found = F.transform(F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), named)
        pieces = F.zip_with(
            F.split(t, pattern, -1), found, lambda piece, name: F.concat(piece, F.coalesce(name, F.lit("")))
        )
        return F.when(t.rlike(pattern), F.array_join(pieces, "")).otherwise(t)

    return let(text, spelled)


def replace_emoticons(text: Column, rules: Iterable[tuple[str, str]] = EMOTICON_RULES) -> Column:
    for pattern, word in rules:
        text = F.regexp_replace(text, pattern, word)
    return text


def strip_special(text: Column) -> Column:
    """Every character that is not a word character or white space becomes a space."""
    return F.regexp_replace(text, SPECIAL, " ")


def collapse_repeats(text: Column, letters: str = COLLAPSIBLE_LETTERS) -> Column:
    """A run of one letter becomes one letter; digits stay."""
    return F.regexp_replace(text, f"([{letters}])\\1+", "$1")


def squash_spaces(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, SPACES, " "))


def expand_slang(df: DataFrame, lexicon: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Replace whole tokens of ``text`` through a lexicon ``(term, expansion)``.

    Up to INLINE_LEXICON terms the lookup stays in the row: a hash test for membership, then the
    map only for the few tokens that pass. A larger lexicon is looked up by ``operators.lookup`` on
    exploded tokens, so no common token gathers in one task, and the tokens are put back in order; both
    give the same text. A stream takes a larger lexicon in ``foreachBatch`` (``streaming.clean_batches``). Of several expansions of a term the
    largest counts; entries without a term or expansion are left out. ``key`` must be unique.
    """
    named = lexicon.filter(F.col("term").isNotNull() & F.col("expansion").isNotNull())
    lexicon = named.groupBy("term").agg(F.max("expansion").alias("expansion"))
    entries = lexicon.limit(INLINE_LEXICON + 1).collect()
    if len(entries) <= INLINE_LEXICON:
        return df.withColumn(text, _expand_inline(F.col(text), {e.term: e.expansion for e in entries}))
    if df.isStreaming:
        raise ValueError(f"a stream looks up {INLINE_LEXICON} terms at most in the row; use streaming.online.clean_batches")
    return _expand_joined(df, materialize(lexicon, "lexicon"), text, key)


def _expand_inline(text: Column, lexicon: Mapping[str, str]) -> Column:
    squashed = squash_spaces(text)
    if not lexicon:
        return squashed
    pairs = F.create_map(*[F.lit(part) for entry in lexicon.items() for part in entry])
    terms = list(lexicon)

    def expand(token: Column) -> Column:
        return F.when(token.isin(terms), F.element_at(pairs, token)).otherwise(token)

    return F.array_join(F.transform(F.split(squashed, " "), expand), " ")


def _expand_joined(df: DataFrame, lexicon: DataFrame, text: str, key: str) -> DataFrame:
    from textloom.operators.lookup import lookup

    tokens = df.select(key, F.posexplode(F.split(squash_spaces(F.col(text)), " ")).alias("pos", "token"))
    replaced = lookup(tokens, lexicon.withColumnRenamed("term", "token"), "token").select(
        key, "pos", F.coalesce("expansion", "token").alias("token")
    )
    ordered = F.array_sort(F.collect_list(F.struct("pos", "token")))["token"]
    texts = replaced.groupBy(key).agg(F.array_join(ordered, " ").alias(text))
    return df.drop(text).join(texts, key, "left").select(*df.columns)


def clean_steps(text: Column, names: Mapping[str, str] | None = None) -> Column:
    """The chain up to collapsed repeats: everything that needs no lexicon. Null becomes empty."""
    text = F.lower(nfc(F.coalesce(text, F.lit(""))))
    text = demojize(strip_hashtags(strip_urls(text)), names)
    return collapse_repeats(strip_special(replace_emoticons(text)))


def clean_text(
    df: DataFrame,
    lexicon: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    phrases: DataFrame | None = None,
    names: Mapping[str, str] | None = None,
) -> DataFrame:
    """The whole chain: clean, expand slang, squash spaces and, with ``phrases``, join phrases."""
    from textloom.operators.phrases import join_phrases

    cleaned = expand_slang(df.withColumn(text, clean_steps(F.col(text), names)), lexicon, text, key)
    cleaned = cleaned.withColumn(text, squash_spaces(F.col(text)))
    return cleaned if phrases is None else join_phrases(cleaned, phrases, text, key)
