"""How filters interact: what each removes in every order, and its Shapley value by the Hart-Mas-Colell potential.

A document is reduced to the set of filters that it fails (a coalition as a bit mask) and its digest; the text is
read once and never shuffled. In the removal game of a part of the corpus a coalition of filters is worth the number of
documents that fail one of them at least. All worths of a part are one array of 2^n numbers, and every figure of
every order follows from it:

* the potential of a coalition is its worth plus the potentials of the coalitions with one filter less, divided by its
  size, with none for the empty one; it is computed from the smaller coalitions up, multiplied by n! so that it stays
  whole. A filter's Shapley value is the potential of all filters minus that of all others;
* the step of a filter after some others is the difference of two coalitions' worths.

Copies (filter ``COPY``) are texts that a smaller doc_id has, wherever it is and whether or not it is removed. Rows are
combined by digest before any of them meet, so a text that a third of all rows share is a few rows.

Defined results: a null text is the empty text; a null part is the part ""; rows without doc_id are copies of nothing
and make none; rows that repeat doc_id and text are counted row by row and are no copies of each other; a document has a
label if any row of ``labels`` with its doc_id has it (null labels are none); an empty table has no parts and gives no
rows. Texts of any length are judged whole. Other columns are not read.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import stored

SPACES = r"[\x20\x09-\x0D]+"
COPY = "E"
FLAGS = ("good", "toxic")


def conditions(text: Column) -> dict[str, Column]:
    """Failure of the filters that look at one text: few words, few distinct words, capitals, symbols."""
    words = F.filter(F.split(text, SPACES), lambda w: w != "")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    return {
        "A": F.size(words) < 200,
        "B": F.size(F.array_distinct(words)).cast("long") * 100 < F.size(words).cast("long") * 50,
        "C": capitals * 100 > F.length(text).cast("long") * 2,
        "D": text.rlike(r"[#$%&*|]"),
    }


def failures(docs: DataFrame, labels: DataFrame, part: str = "source", filters=conditions) -> tuple[DataFrame, str]:
    """(part, mask, good, toxic, n): documents by the set of filters they fail; and the letters of the mask's bits.

    ``filters`` maps a text column to failure conditions by letter; the copy filter is the last bit.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    failed = filters(text)
    own = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(failed.values())), F.lit(0))
    seen = docs.select(
        "doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"), own.alias("mask"),
    )
    rows = seen.groupBy("doc_id", "digest", "part", "mask").agg(F.count("*").alias("n"))
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.col("quality").eqNullSafe(1)).alias("good"), F.max(F.col("toxic").eqNullSafe(1)).alias("toxic")
    )
    rows = rows.join(known, "doc_id", "left").fillna(False, list(FLAGS))
    numbered = F.col("doc_id").isNotNull()
    groups = rows.groupBy("digest", "part", "mask", *FLAGS).agg(
        F.sum("n").alias("n"), F.sum(F.when(numbered, F.col("n")).otherwise(0)).alias("numbered"),
        F.min(F.when(numbered, F.struct("doc_id", "n"))).alias("lowest"),
    )
    groups = stored(groups, "failures")
    first = groups.groupBy("digest").agg(F.min("lowest.doc_id").alias("first"), F.count("*").alias("groups"))
    # Of the rows of a text those without doc_id and those of its first document are originals.
    joined = groups.join(first.where("groups > 1").select("digest", "first"), "digest", "left")
    holds_first = F.col("first").isNull() | (F.col("lowest.doc_id") == F.col("first"))
    originals = F.col("n") - F.col("numbered") + F.when(holds_first, F.coalesce("lowest.n", F.lit(0))).otherwise(0)
    split = F.array(
        F.struct("mask", originals.alias("n")),
        F.struct(F.col("mask").bitwiseOR(1 << len(failed)).alias("mask"), (F.col("n") - originals).alias("n")),
    )
    by_mask = joined.select("part", *FLAGS, F.inline(split)).groupBy("part", "mask", *FLAGS).agg(F.sum("n").alias("n"))
    return by_mask, "".join(failed) + COPY


def worths(by_mask: DataFrame, n_filters: int) -> DataFrame:
    """(part, n_docs, worth, good, toxic): for every coalition, in order of its mask, how many documents it removes."""
    entries = F.collect_list(F.struct("mask", *FLAGS, "n"))  # at most 2^n masks and 4 pairs of flags
    games = by_mask.groupBy("part").agg(F.sum("n").alias("n_docs"), entries.alias("entries"))
    coalitions = F.sequence(F.lit(0), F.lit((1 << n_filters) - 1))

    def removed(counts) -> Column:
        def total(s: Column) -> Column:
            hit = F.filter("entries", lambda e: (e["mask"].bitwiseAND(s) != 0) & counts(e))
            return F.aggregate(hit, F.lit(0).cast("long"), lambda sum_, e: sum_ + e["n"])

        return F.transform(coalitions, total)

    flags = {flag: removed(lambda e, flag=flag: e[flag]) for flag in FLAGS}
    return games.withColumns({"worth": removed(lambda e: F.lit(True)), **flags}).drop("entries")


def potentials(worth: Column, n_filters: int) -> Column:
    """n! times the potential of every coalition, by the recursion over the coalitions with one filter less."""
    bits = F.array(*(F.lit(1 << i) for i in range(n_filters)))

    def step(found: Column, s: Column) -> Column:
        inside = F.filter(bits, lambda b: s.bitwiseAND(b) != 0)
        smaller = F.aggregate(inside, F.lit(0).cast("long"), lambda total, b: total + F.get(found, s.bitwiseXOR(b)))
        total = F.get(worth, s) * F.lit(factorial(n_filters)) + smaller
        return F.array_append(found, F.call_function("div", total, F.size(inside).cast("long")))  # divides evenly

    none = F.array(F.lit(0).cast("long"))
    return F.aggregate(F.sequence(F.lit(1), F.lit((1 << n_filters) - 1)), none, step)


def audit(docs: DataFrame, labels: DataFrame, part: str = "source", filters=conditions) -> DataFrame:
    """One row for each part, order of the filters and step, zeros included.

    (part, filter_order, step, filter, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley,
    potential, n_docs). shapley and potential are multiplied by the number of orders.
    """
    by_mask, letters = failures(docs, labels, part, filters)
    n, everything = len(letters), (1 << len(letters)) - 1
    games = worths(by_mask, n).withColumn("p", potentials(F.col("worth"), n))
    orders = F.array(*(F.lit("".join(order)) for order in permutations(letters)))
    every = games.withColumn("filter_order", F.explode(orders)).select(
        "*", F.posexplode(F.split("filter_order", "")).alias("place", "filter")
    )
    position = {letter: F.instr("filter_order", letter) - 1 for letter in letters}
    every = every.withColumns({
        "step": F.col("place") + 1,
        "bit": sum((F.when(F.col("filter") == c, 1 << i).otherwise(0) for i, c in enumerate(letters)), F.lit(0)),
        "before": sum((F.when(position[c] < F.col("place"), 1 << i).otherwise(0) for i, c in enumerate(letters)), F.lit(0)),
    })
    after = F.col("before").bitwiseOR(F.col("bit"))

    def gained(values: str) -> Column:
        return F.get(F.col(values), after) - F.get(F.col(values), F.col("before"))

    def without(values: str) -> Column:
        others = F.lit(everything).bitwiseXOR(F.col("bit"))
        return F.get(F.col(values), F.lit(everything)) - F.get(F.col(values), others)

    return every.select(
        "part", "filter_order", "step", "filter", (F.col("n_docs") - F.get("worth", after)).alias("kept"),
        gained("worth").alias("removed"), (F.get("worth", F.col("bit")) - gained("worth")).alias("redundant"),
        without("worth").alias("unique_fails"), gained("good").alias("good_lost"), gained("toxic").alias("toxic_lost"),
        without("p").alias("shapley"), F.get("p", F.lit(everything)).alias("potential"), "n_docs",
    )
