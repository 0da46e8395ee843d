"""Union of corpora, stratified split, and the training set with an auxiliary corpus."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.operators.ranking import text_key
from textloom.session import materialize


def union_corpora(corpora: Sequence[DataFrame]) -> DataFrame:
    """Stack corpora in order; ``source_rank`` keeps the order of the corpora."""
    ranked = [df.withColumn("source_rank", F.lit(i)) for i, df in enumerate(corpora)]
    return reduce(DataFrame.unionByName, ranked)


def by_source(df: DataFrame, main: Sequence[str], source: str = "source") -> tuple[DataFrame, DataFrame]:
    """Main and auxiliary rows by provenance."""
    is_main = F.col(source).isin(list(main))
    return df.filter(is_main), df.filter(~is_main)


def split_hash(key: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def stratified_split(
    df: DataFrame,
    label: str = "label",
    key: str = "doc_id",
    test_tenths: int = 1,
    valid_tenths: int = 1,
    seed: int = 42,
    exact: bool = True,
) -> DataFrame:
    """Add ``split`` so that each label is cut 80/10/10 (by default) in a seeded random order.

    Exact mode orders each label by a hash of the key and takes the first tenth as test and the
    next as valid. Ranking whole labels would put each in one task; instead the hash at the two
    cuts is found from counts per hash prefix, and rows are ranked only inside the prefix that
    holds a cut. Rows then compare their own hash with the cuts, a stored table of a row per label that
    Catalyst broadcasts while it is small. Rows with a null label are train. With ``exact=False`` the
    hash alone decides and shares are approximate.
    """
    hashed = df.withColumn("_hash", split_hash(F.col(key), seed))
    if not exact:
        tenth = F.conv(F.substring("_hash", 1, 8), 16, 10).cast("long") % 10
        split = F.when(tenth < test_tenths, "test").when(tenth < test_tenths + valid_tenths, "valid")
        return hashed.withColumn("split", split.otherwise("train")).drop("_hash")
    tenths = (test_tenths, test_tenths + valid_tenths)
    cut = hashed.join(_cut_hashes(hashed, label, tenths), F.col(label) == F.col("_label"), "left")
    test_cut, valid_cut = (F.col("_cuts")[t] for t in tenths)
    split = F.when(F.col("_hash") <= test_cut, "test").when(F.col("_hash") <= valid_cut, "valid")
    return cut.select(*df.columns, split.otherwise("train").alias("split"))


def _cut_hashes(hashed: DataFrame, label: str, tenths: Sequence[int]) -> DataFrame:
    """(_label, _cuts): for each label a map from tenths to the hash of the last row before that cut."""
    prefixed = hashed.where(F.col(label).isNotNull()).select(label, "_hash", F.substring("_hash", 1, 4).alias("_prefix"))
    counts = prefixed.groupBy(label, "_prefix").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(label)
    running = counts.select(
        label,
        "_prefix",
        (F.sum("n").over(whole.orderBy("_prefix")) - F.col("n")).alias("before"),
        "n",
        F.sum("n").over(whole).alias("total"),
    )
    targets = F.array(*[F.lit(t) for t in dict.fromkeys(tenths)])
    cuts = materialize(
        running.select("*", F.explode(targets).alias("tenths"))
        .withColumn("position", F.floor(F.col("total") * F.col("tenths") / 10) - F.col("before"))
        .filter((F.col("position") >= 1) & (F.col("position") <= F.col("n")))
        .select(label, "_prefix", "tenths", "position"),
        "split-cuts",
    )
    # One prefix per label and cut.
    inside = Window.partitionBy(label, "_prefix").orderBy("_hash")
    wanted = cuts.select(label, "_prefix").distinct()
    ranked = prefixed.join(wanted, [label, "_prefix"], "left_semi").withColumn("position", F.row_number().over(inside))
    found = ranked.join(cuts, [label, "_prefix", "position"])
    hashes = F.map_from_entries(F.collect_list(F.struct("tenths", "_hash")))
    return materialize(found.groupBy(F.col(label).alias("_label")).agg(hashes.alias("_cuts")), "split-hashes")


def build_training_set(
    main: DataFrame, auxiliary: DataFrame, text: str = "text", order: Sequence[str] = ("source_rank", "doc_id")
) -> DataFrame:
    """Add an auxiliary corpus to the train split only.

    ``main`` carries ``split``. Train rows are made distinct by text, main before auxiliary, and a
    text that is in valid or test does not enter train. One grouping of text hashes decides all.
    """
    everything = main.unionByName(auxiliary.withColumn("split", F.lit("train"))).withColumn(
        "_key", text_key(F.col(text))
    )
    in_train = F.col("split") == "train"
    first = everything.groupBy("_key").agg(
        F.min(F.struct(in_train.alias("train"), *order)).alias("first")
    )
    winners = first.filter(F.col("first")["train"]).select(
        "_key", *[F.col("first")[c].alias(c) for c in order]
    )
    train = everything.filter(in_train).join(winners, ["_key", *order], "left_semi")
    return everything.filter(~in_train).unionByName(train).drop("_key")
