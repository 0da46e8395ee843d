"""Fill-in-the-middle: a text is cut at two places and its parts are reordered, so that a model learns to fill the gap.

The places where a text may be cut (here: before every code point, and at its end) are a ``BoundarySet`` over the bytes
of some neighbouring texts. A text with n units has n + 1 boundaries, of consecutive ranks, so both cuts of every text
are two selects. Texts are cut in UTF-8 without being decoded.

Cuts and form follow from a hash of seed and doc_id: the first four 32-bit numbers of SHA-256 of "<seed>:<doc_id>". Of
the documents ``share`` percent are transformed, and of these ``spm`` percent begin with the suffix; the others stay plain, as do
empty texts and texts that hold a marker.

Defined results: a null text is the empty text; a null doc_id counts as the empty text in the hash; rows that repeat
doc_id are cut alike; an empty table gives an empty one; other columns stay, and a clashing column is replaced. Texts
of any length are cut whole: a batch is read in pieces of about ``words.PIECE`` bytes or one text.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.boundaries import BoundarySet
from textloom.llm.words import Texts, pieces

# Markers before prefix, suffix and middle. Fixed values.
MARKERS = ("<P>", "<S>", "<M>")
PLAIN, PSM, SPM = "plain", "psm", "spm"
OUTPUT = (
    T.StructType().add("form", "string").add("n", "long").add("prefix_chars", "long").add("middle_chars", "long").add("fim_text", "string")
)
ADDED = tuple(OUTPUT.names)


def numbers(doc_id: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers of a document, as longs."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def unit_starts(texts: Texts) -> np.ndarray:
    """Which bytes begin a code point."""
    return (texts.bytes & 0xC0) != 0x80


def cut_places(texts: Texts, first: np.ndarray, second: np.ndarray, starts=unit_starts):
    """(units, prefix units, middle units, first cut, second cut) of every text; cuts are places in the piece's bytes.

    first, second: the hash numbers that choose boundaries. One boundary stands behind the last byte.
    """
    inside = np.append(starts(texts), True)
    before = np.append(0, np.cumsum(inside, dtype=np.int64))[texts.offsets]
    units = np.diff(before)
    a, b = first % (units + 1), second % (units + 1)
    low, high = np.minimum(a, b), np.maximum(a, b)
    bounds = BoundarySet(inside)
    return units, low, high - low, bounds.select(before[:-1] + low), bounds.select(before[:-1] + high)


def transform(docs: DataFrame, seed: int = 1, share: int = 90, spm: int = 20, markers: tuple[str, str, str] = MARKERS) -> DataFrame:
    """``docs`` with form, n, prefix_chars, middle_chars and fim_text, the transformed text."""
    p, s, m = (x.encode() for x in markers)
    held = re.compile(b"|".join(re.escape(x) for x in (p, s, m)))

    def run(text: pa.Array, h1: pa.Array, h2: pa.Array, plain: pa.Array, suffix_first: pa.Array) -> pa.Array:
        first, second = h1.to_numpy(), h2.to_numpy()
        stays, turned = (x.to_numpy(zero_copy_only=False) for x in (plain, suffix_first))
        forms, counts, outs = [], [[], [], []], []
        for part in pieces(text):
            rows = slice(part.first, part.first + len(part))
            units, prefix, middle, cut, end = cut_places(part, first[rows], second[rows])
            raw = part.bytes.tobytes()
            bounds = zip(part.offsets[:-1].tolist(), cut.tolist(), end.tolist(), part.offsets[1:].tolist())
            made = np.zeros(len(part), bool)
            for i, (a, b, c, d) in enumerate(bounds):
                if stays[part.first + i] or a == d or held.search(raw, a, d):
                    forms.append(PLAIN)
                    outs.append(raw[a:d])
                    continue
                made[i] = True
                if turned[part.first + i]:
                    forms.append(SPM)
                    outs.append(b"".join((s, raw[c:d], p, raw[a:b], m, raw[b:c])))
                else:
                    forms.append(PSM)
                    outs.append(b"".join((p, raw[a:b], s, raw[c:d], m, raw[b:c])))
            for column, values in zip(counts, (units, prefix, middle)):
                column.append(pa.array(values, pa.int64(), mask=None if column is counts[0] else ~made))
        whole = [pa.concat_arrays(c) if c else pa.array([], pa.int64()) for c in counts]
        return pa.StructArray.from_arrays([pa.array(forms, pa.string()), *whole, pa.array(outs, pa.binary()).cast(pa.string())], ADDED)

    h1, h2, h3, h4 = numbers(F.col("doc_id"), seed)
    udf = F.arrow_udf(run, OUTPUT)
    cut = udf("text", h1, h2, h3 % 100 >= share, h4 % 100 < spm)
    others = docs.drop(*ADDED)
    return others.withColumn("_fim", cut).select(*(f"`{c}`" for c in others.columns), "_fim.*")


def restored(fim_text: str = "fim_text", form: str = "form", markers: tuple[str, str, str] = MARKERS) -> Column:
    """The original text of a transformed one: its parts follow markers that no part holds."""
    parts = F.split(F.col(fim_text), "|".join(rf"\Q{x}\E" for x in markers), -1)
    order = {PSM: (1, 3, 2), SPM: (2, 3, 1)}
    out = F.col(fim_text)
    for name, places in order.items():
        out = F.when(F.col(form) == name, F.concat(*(F.get(parts, i) for i in places))).otherwise(out)
    return out


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) of every document."""
    done = transform(docs.select("doc_id", "text"))
    return done.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("fim_text", 256).alias("output_sha256"),
        F.sha2(restored(), 256).alias("restored_sha256"),
    )
