"""Phrases: mined from a corpus by pointwise mutual information, then joined with underscores.

The phrases are those the corpus supports, so joined texts differ from what a trained segmenter would give.
``lattice`` segments by a model of words and longer phrases instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.clean import let
from textloom.functions.ngrams import word_ngrams
from textloom.functions.profile import tokens
from textloom.operators.lookup import lookup
from textloom.session import materialize

# Phrases up to this number are tested inside the row, as part of the plan; more are a table.
INLINE_PHRASES = 1000


def gram_counts(docs: DataFrame, words: Column, min_count: int) -> DataFrame:
    """(gram, n) of all words and of the pairs with at least ``min_count``, from one pass, stored.

    Counts are combined on the map side before the shuffle; rare pairs are not stored.
    """
    grams = docs.select(F.explode_outer(word_ngrams(words, 1, 2)).alias("gram"))
    counts = grams.groupBy("gram").agg(F.count("gram").alias("n")).filter(F.col("gram").isNotNull())
    return materialize(counts.filter(~F.col("gram").contains(" ") | (F.col("n") >= min_count)), "grams")


def pairs_by_pmi(counts: DataFrame, min_count: int, min_pmi: float) -> DataFrame:
    """(first, second, n_pair, pmi) of the cohesive pairs of ``gram_counts``."""
    is_pair = F.col("gram").contains(" ")
    words = counts.filter(~is_pair)
    total = words.agg(F.sum("n")).scalar()
    parts = F.split("gram", " ")
    pairs = counts.filter(is_pair & (F.col("n") >= min_count)).select(
        F.get(parts, 0).alias("first"), F.get(parts, 1).alias("second"), F.col("n").alias("n_pair")
    )
    # A word of a frequent pair is frequent itself.
    words = words.filter(F.col("n") >= min_count)
    scored = (
        pairs.join(words.select(F.col("gram").alias("first"), F.col("n").alias("n_first")), "first")
        .join(words.select(F.col("gram").alias("second"), F.col("n").alias("n_second")), "second")
        .withColumn(
            "pmi",
            F.log(F.col("n_pair") * total.cast("double") / (F.col("n_first") * F.col("n_second").cast("double"))),
        )
    )
    return scored.filter(F.col("pmi") >= min_pmi).select("first", "second", "n_pair", "pmi")


def mine_phrases(
    docs: DataFrame, min_count: int = 5, min_pmi: float = 3.0, text: str = "text"
) -> DataFrame:
    """Bigrams that occur at least ``min_count`` times with PMI of at least ``min_pmi``.

    PMI is ln(c12 * N / (c1 * c2)), N being the number of tokens.
    """
    return pairs_by_pmi(gram_counts(docs, tokens(F.col(text)), min_count), min_count, min_pmi)


def _join_flagged(words: Column, flags: Column) -> Column:
    """Join words whose flag is '1' to the next word, left to right, no word used twice; words without a flag count as '0'."""
    # In a run of flags every second one is taken, from the left: '1x' -> '10' does exactly that.
    taken = F.split(F.regexp_replace(F.array_join(flags, ""), "1.", "10"), "")
    glued = F.zip_with(
        words,
        F.slice(taken, F.lit(1), F.size(words)),
        lambda word, take: F.concat(word, F.when(take == "1", F.lit("_")).otherwise(F.lit(" "))),
    )
    return F.trim(F.array_join(glued, ""))


def _flags_at(places: Column) -> Column:
    """Flags of the words up to the last of the ``places`` (from 0, rising), some to an item."""
    before = F.concat(F.array(F.lit(-1)), places)
    return F.zip_with(places, before, lambda p, b: F.concat(F.repeat(F.lit("0"), p - b - 1), F.lit("1")))


def join_phrases(docs: DataFrame, phrases: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Greedy left-to-right joining of the phrases ``(first, second)`` in space-separated texts.

    Repeated phrases count once. ``key`` must be unique: a large phrase table regroups words by it.
    """
    phrases = phrases.select("first", "second").na.drop().distinct()
    listed = phrases.limit(INLINE_PHRASES + 1).collect()
    words = F.split(F.col(text), " ")
    if len(listed) <= INLINE_PHRASES:
        known = [f"{p.first} {p.second}" for p in listed]
        # The last word has no partner: its pair is itself with a trailing space, never a phrase.
        flags = lambda w: F.zip_with(
            w,
            F.slice(w, F.lit(2), F.size(w)),
            lambda a, b: F.when(F.concat(a, F.lit(" "), F.coalesce(b, F.lit(""))).isin(known), "1").otherwise("0"),
        )
        return docs.withColumn(text, let(words, lambda w: _join_flagged(w, flags(w))))
    return _join_by_table(docs, phrases, text, key)


def _join_by_table(docs: DataFrame, phrases: DataFrame, text: str, key: str) -> DataFrame:
    """The same result for a phrase table of any size: pairs are exploded and looked up, common ones by broadcast.

    Of the exploded pairs only the places of phrases are shuffled and collected; words are joined where the text is. Rows
    that share a key are one text, their words in order of place.
    """
    def neighbours(w: Column) -> Column:
        return F.zip_with(w, F.slice(w, F.lit(2), F.size(w)), lambda a, b: F.struct(a.alias("first"), b.alias("second")))

    keyed = docs.where(F.col(key).isNotNull())
    # Not dealt by the key itself: a union of parts that are all dealt by it would pass for dealt as a whole.
    counted = keyed.withColumn("_rows", F.count(F.lit(1)).over(Window.partitionBy(F.struct(key))))
    pairs = counted.select(key, "_rows", F.posexplode(let(F.split(F.col(text), " "), neighbours)).alias("pos", "pair")).select(
        key, "_rows", "pos", "pair.first", "pair.second"
    )
    pairs = pairs.withColumn("pair", F.concat("first", F.lit(" "), "second"))  # null for the last word
    known = phrases.select(F.concat("first", F.lit(" "), "second").alias("pair"), F.lit("1").alias("flag"))
    flagged = lookup(pairs, materialize(known, "phrases"), "pair")
    shared = F.col("_rows") > 1
    item = F.struct("pos", F.when(shared, F.col("first")).alias("word"), F.coalesce("flag", F.lit("0")).alias("flag"))
    ordered = F.array_sort(F.collect_list(item)).alias("_found")
    found = flagged.where(shared | F.col("flag").isNotNull()).groupBy(key).agg(F.max("_rows").alias("_rows"), ordered)
    places = F.coalesce(F.col("_found")["pos"], F.array().cast("array<int>"))
    alone = let(F.split(F.col(text), " "), lambda w: _join_flagged(w, _flags_at(places)))
    merged = _join_flagged(F.col("_found")["word"], F.col("_found")["flag"])
    joined = keyed.join(found, key, "left").withColumn(text, F.when(shared, merged).otherwise(alone)).select(*docs.columns)
    # A null key equals no other: its rows find no words.
    return joined.unionByName(docs.where(F.col(key).isNull()).withColumn(text, F.lit(None).cast("string")))
