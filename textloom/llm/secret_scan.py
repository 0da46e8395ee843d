"""Secrets by pattern and by how many own them: corpus-wide ownership frequency, in DataFrame functions only.

Every text is searched once for assignments, access keys, long hex numbers and, as a kind of its own, tokens (runs of
letters and digits that look generated). What is found becomes a row of lengths and a SHA-256 of its value; texts and
values are not kept. Matches and the gaps between them come from the same pattern, so places are running sums of their
lengths within document and kind. Candidate hashes are then counted over the whole corpus by distinct repositories and
owners: a value that many have is a copied example, one that few repositories of one owner have looks live (``owned``).

Matches of the base kinds are always reported, with their verdict. A token is reported as well if it is owned and touches no
match of a base kind in its text: a credential without the words that give others away.

A value that a third of all rows hold is combined by repository and owner before it is counted, and the join that
returns its verdict is one that adaptive execution can split.

Defined results: a null text is the empty text and holds nothing; a null owner or repository counts as one more name,
the empty one; rows that repeat doc_id are reported row by row and count as one repository if that is doc_id; an empty
table gives an empty one. Texts of any length are searched whole; places are code points. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import stored


@dataclass(frozen=True)
class Kind:
    """Matches of ``pattern`` whose group ``value`` has ``least`` code points or more; shorter ones are used up, not kept."""

    name: str
    pattern: str
    value: int
    least: int


# Fixed values. Runs that are too short hold no longer ones, so the last two can ask for the length at once.
BASE = (
    Kind("assign", r"(?i:(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+))", 2, 8),
    Kind("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    Kind("hex", r"[0-9a-f]{32,}", 0, 32),
)
TOKEN = Kind("token", r"[A-Za-z0-9_-]{16,}", 0, 16)
TOKEN_LONGEST, TOKEN_DISTINCT = 128, 8


def _looks_generated(value: Column) -> Column:
    varied = F.size(F.array_distinct(F.split(value, ""))) >= TOKEN_DISTINCT
    return (F.length(value) <= TOKEN_LONGEST) & value.rlike("[0-9]") & value.rlike("[A-Za-z]") & varied


def _matches(text: Column, kind: Kind, number: int) -> Column:
    """Array of (kind, place in order, gap before it, length, length of the value, hash of the value), empty in most texts."""
    whole = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    values = whole if kind.value == 0 else F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.value))
    zipped = F.arrays_zip(whole.alias("whole"), values.alias("value"), F.split(text, kind.pattern, -1).alias("gap"))

    def facts(m: Column, i: Column) -> Column:
        value, fits = m["value"], F.length(m["value"]) >= kind.least
        if kind is TOKEN:
            fits = _looks_generated(value)
        return F.struct(
            F.lit(number).alias("kind"), i.alias("i"), F.length(m["gap"]).cast("long").alias("gap"), F.length(m["whole"]).cast("long").alias("length"),
            fits.alias("fits"), F.when(fits, F.unhex(F.sha2(value, 256))).alias("hash"),
        )

    # The text behind the last match is a gap without a match.
    return F.when(text.rlike(kind.pattern), F.filter(F.transform(zipped, facts), lambda m: m["length"].isNotNull()))


def candidates(docs: DataFrame, owner: str, repository: str, kinds: tuple[Kind, ...] = (*BASE, TOKEN)) -> tuple[DataFrame, DataFrame]:
    """(row, doc_id) of every document, and (row, kind, start, end, hash, owner, repository) of every candidate.

    A row number stands for a document; both tables are stored, so it stays the same.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    names = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for n, c in (("owner", owner), ("repository", repository))]
    searched = docs.select("doc_id", *names, text.alias("text"))
    searched = searched.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "owner", "repository",
        *(_matches(F.col("text"), kind, k).alias(f"m{k}") for k, kind in enumerate(kinds)),
    )
    searched = stored(searched, "secret-matches")
    found = None
    for k in range(len(kinds)):
        some = searched.where(F.col(f"m{k}").isNotNull()).select("row", "owner", "repository", F.inline(f"m{k}"))
        found = some if found is None else found.unionByName(some)
    before = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = found.withColumn("end", F.sum(F.col("gap") + F.col("length")).over(before)).where("fits")
    placed = placed.select("row", "kind", (F.col("end") - F.col("length")).alias("start"), "end", "hash", "owner", "repository")
    return searched.select("row", "doc_id"), placed


def free_tokens(placed: DataFrame, n_base: int) -> DataFrame:
    """The candidates without the tokens that touch a match of a base kind in their text."""
    order = Window.partitionBy("row").orderBy("start", "kind", "end")
    base = F.col("kind") < n_base
    so_far = F.max(F.when(base, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    later = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("kind"), F.desc("end"))
    next_start = F.min(F.when(base, F.col("start"))).over(later.rowsBetween(Window.unboundedPreceding, -1))
    touched = (F.coalesce(so_far, F.lit(0)) > F.col("start")) | F.coalesce(next_start < F.col("end"), F.lit(False))
    return placed.withColumn("touched", touched).where(base | ~F.col("touched")).drop("touched")


def ownership(placed: DataFrame, max_owners: int, max_repositories: int) -> DataFrame:
    """(hash, n_owners, n_repositories, owned) of every candidate value."""
    counted = placed.groupBy("hash").agg(
        F.count_distinct("owner").alias("n_owners"), F.count_distinct("repository").alias("n_repositories")
    )
    few = (F.col("n_owners") <= max_owners) & (F.col("n_repositories") <= max_repositories)
    return counted.withColumn("owned", few)


def findings(
    docs: DataFrame, owner: str = "source", repository: str = "doc_id", max_owners: int = 1, max_repositories: int = 10,
) -> tuple[DataFrame, DataFrame]:
    """(row, doc_id) of every document, and (row, kind, start, end, hash, n_owners, n_repositories, owned) of every reported span.

    kind: place in ``BASE``, or one more for tokens. owned: at most ``max_owners`` owners and ``max_repositories``
    repositories hold the value, in any kind of match.
    """
    rows, placed = candidates(docs, owner, repository)
    placed = stored(free_tokens(placed, len(BASE)), "secret-candidates")
    judged = placed.drop("owner", "repository").join(ownership(placed, max_owners, max_repositories), "hash")
    return rows, judged.where((F.col("kind") < len(BASE)) | F.col("owned"))


def report(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_spans, n_owned) of every document."""
    rows, spans = findings(docs, **options)
    names = [k.name for k in (*BASE, TOKEN)]
    per_row = spans.groupBy("row").agg(
        *(F.count_if(F.col("kind") == k).alias(f"n_{kind.name}") for k, kind in enumerate(BASE)),
        F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("found"),  # the spans of one text
        F.count("*").alias("n_spans"), F.count_if("owned").alias("n_owned"),
    )

    def joined(found: Column) -> Column:
        name = F.array(*map(F.lit, names))
        return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"], s["end"])), ",")

    done = rows.join(per_row, "row", "left")
    empty = F.lit("")
    base = F.filter("found", lambda s: s["kind"] < len(BASE))
    return done.select(
        "doc_id", *(F.coalesce(f"n_{k.name}", F.lit(0)).alias(f"n_{k.name}") for k in BASE),
        F.sha2(F.coalesce(joined(base), empty), 256).alias("base_sha256"), F.coalesce(joined(F.col("found")), empty).alias("spans"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"), F.coalesce("n_owned", F.lit(0)).alias("n_owned"),
    )
