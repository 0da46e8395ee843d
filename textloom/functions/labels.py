"""Label and null handling, as Column functions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.patterns import SPACES

MISSING_LABEL = "<missing>"


def strip_spaces(text: Column) -> Column:
    """Trim Unicode white space on both ends."""
    return F.regexp_replace(text, f"^{SPACES}|{SPACES}$", "")


def map_label(label: Column, mapping: Mapping) -> Column:
    """Map a source label through a small dictionary; labels not in it become null."""
    result = F.lit(None).cast("int")
    for source, target in reversed(list(mapping.items())):
        result = F.when(label == F.lit(source), F.lit(target).cast("int")).otherwise(result)
    return result


def coerce_label(label: Column, sentinel: int = -1) -> Column:
    """Numeric label as int; anything that is not a number becomes the sentinel."""
    return F.coalesce(label.try_cast("double").try_cast("int"), F.lit(sentinel))


def clean_raw_text(text: Column) -> Column:
    """Null to empty, byte-order marks out, trimmed."""
    return strip_spaces(F.replace(F.coalesce(text, F.lit("")), F.lit("\ufeff"), F.lit("")))


def clean_raw_label(label: Column) -> Column:
    """Null to empty, trimmed, upper case."""
    return F.upper(strip_spaces(F.coalesce(label, F.lit(""))))


def label_or_missing(label: Column) -> Column:
    return F.coalesce(F.nullif(strip_spaces(label), F.lit("")), F.lit(MISSING_LABEL))


def label_name(label: Column, names: Mapping) -> Column:
    """Display name of a label; unknown labels have none."""
    result = F.lit(None).cast("string")
    for value, name in reversed(list(names.items())):
        result = F.when(label == F.lit(value), F.lit(name)).otherwise(result)
    return result


def drop_missing(df: DataFrame, subset: Iterable[str]) -> DataFrame:
    return df.na.drop(subset=list(subset))


def keep_complete(df: DataFrame, text: str = "text", label: str = "label") -> DataFrame:
    """Rows with a non-empty text and a non-empty label."""
    filled = F.col(text).isNotNull() & (F.col(text) != "")
    return df.filter(filled & F.col(label).isNotNull() & (F.col(label).cast("string") != ""))


def drop_blank(df: DataFrame, text: str = "text") -> DataFrame:
    """Rows whose text is not empty after trimming."""
    return df.filter(strip_spaces(F.col(text)) != "")


def percent(part: Column, total: Column, digits: int = 4) -> Column:
    """100 * part / total, 0 when the total is 0."""
    return F.round(F.coalesce(F.try_divide(part * F.lit(100.0), total), F.lit(0.0)), digits)


def ratio(part: Column, total: Column, digits: int = 6) -> Column:
    return F.round(F.coalesce(F.try_divide(part, total), F.lit(0.0)), digits)
