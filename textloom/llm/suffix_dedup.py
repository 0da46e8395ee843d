"""Removal of long repeated byte strings by sharded suffix arrays.

A byte goes when a string of ``length`` bytes that covers it also starts anywhere else. The work is sharded by content:

1. In each window of ``length`` bytes the gram of ``gram`` bytes with the smallest hash (the leftmost of equals) is its
   anchor, so equal windows have equal anchors at equal places. Neighbouring windows with the same anchor form a
   context, and every window is in exactly one.
2. Anchors that occur once hold nothing repeated. Where all contexts of an anchor are equal, all of them repeat.
3. The other anchors' distinct contexts, once each, go to shards by anchor: induced sorting of the shard's suffixes and
   permuted common prefixes show which windows repeat. An anchor with more than ``split`` distinct contexts is dealt
   over several groups; what their own group does not settle is matched by 128-bit digests of single windows.
4. Ranges are united for each document and cut out of its bytes.

With ``words`` both sizes count words (runs of bytes that are not white space): windows and grams begin and end with whole
words, and the suffix arrays are over words and the white space between them, so a byte goes when ``length`` words that
cover it also stand anywhere else, byte for byte.

Matches never cross documents and are judged on the input. Defined results: null and short texts lose nothing; rows that
repeat a doc_id are judged row by row, and equal rows repeat each other; rows without doc_id take part; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.common import stored
from textloom.llm.suffix_array import common_prefixes, suffix_array
from textloom.llm.words import SOLID, Texts, U, find_words, inverse_powers, mix, pieces, powers

ANCHORS = "h long, d long, id long, th long, start long, n int"
CONTEXTS = "h long, copies long, id long, th long, start long, bytes binary"
FOUND = "id long, th long, begin long, stop long, f1 long, f2 long"
RANGES = "_repeated_ranges"
SEGMENT = 1 << 18
HOT = 1000
TASK_SHARDS = 4
SYMBOL = re.compile(rb"[^ \t-\r]+|[ \t-\r]+")


def _key(doc_id: str | Column, text: str | Column) -> list[Column]:
    """Rows with equal keys have equal texts, and so the same ranges; a null id is no different from -1 here."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("id"), F.xxhash64("text").alias("th")]


def _segments(texts: Texts, length: int):
    """(bytes, starts, stops, owner, shift): parts of at most about SEGMENT bytes; windows begin in [start, stop) only."""
    if len(texts) > 1 or len(texts.bytes) <= SEGMENT:
        starts, stops = texts.offsets[:-1], texts.offsets[1:] - length + 1
        some = np.flatnonzero(stops > starts)
        if len(some):
            yield texts.bytes, starts[some], stops[some], some, starts[some]
        return
    # One long text: its windows in turn, with the bytes that the last of them needs.
    step = SEGMENT - length
    for low in range(0, len(texts.bytes) - length + 1, step):
        high = min(low + step, len(texts.bytes) - length + 1)
        zero = np.zeros(1, np.int64)
        yield texts.bytes[low : high + length - 1], zero, zero + high - low, zero, zero - low


def _lowest(hashes: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest of each ``width`` neighbouring hashes, the leftmost of equals."""
    n = len(hashes)
    bits = U((1 << 21) - 1)
    ranked = (hashes & ~bits) | np.arange(n, dtype=U)
    padded = np.full(-(-n // width) * width, ~U(0), U)
    padded[:n] = ranked
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    windows = n - width + 1
    return (np.minimum(right[:windows], left[width - 1 : width - 1 + windows]) & bits).astype(np.int64)


def window_anchors(raw: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each gram, and the anchor of each window as a position; raw has at least ``length`` bytes."""
    n = len(raw) - gram + 1
    sums = np.append(U(0), np.cumsum((raw.astype(U) + U(1)) * powers(len(raw))))
    hashes = mix((sums[gram:] - sums[:-gram]) * inverse_powers(n))
    return hashes, _lowest(hashes, length - gram + 1)


def _byte_contexts(part: Texts, length: int, gram: int):
    """(bytes, anchor hash, first byte, size, text, place in the text) of the contexts of a piece."""
    for raw, starts, stops, owner, shift in _segments(part, length):
        hashes, anchor = window_anchors(raw, length, gram)
        valid = np.zeros(len(anchor) + 1, bool)
        fresh = np.append(True, anchor[1:] != anchor[:-1])
        for a, b in zip(starts, stops):
            valid[a:b] = True
            fresh[a] = True
        first = np.flatnonzero(fresh & valid[:-1])
        of = np.searchsorted(starts, first, "right") - 1
        # A context ends where the next begins, or with the text's last window.
        stop = np.minimum(np.append(first[1:], len(anchor)), stops[of])
        yield raw, hashes[anchor[first]], first, stop - first + length - 1, owner[of], first - shift[of]


def _word_contexts(part: Texts, length: int, gram: int):
    """The same for windows of words."""
    words = find_words(part, SOLID)
    for low in range(0, len(words.starts) - length + 1, SEGMENT):
        some = slice(low, low + SEGMENT + length - 1)
        starts, ends, text = words.starts[some], words.ends[some], words.text[some]
        valid = np.flatnonzero(text[: len(text) - length + 1] == text[length - 1 :])
        if not len(valid):
            continue
        zero = starts[0]
        raw = part.bytes[zero : ends[-1]]
        sums = np.append(U(0), np.cumsum((raw.astype(U) + U(1)) * powers(len(raw))))
        begin = starts[: len(starts) - gram + 1] - zero
        hashes = mix((sums[ends[gram - 1 :] - zero] - sums[begin]) * inverse_powers(len(raw))[begin])
        anchor = _lowest(hashes, length - gram + 1)[valid]
        fresh = np.append(True, (anchor[1:] != anchor[:-1]) | (text[valid[1:]] != text[valid[:-1]]))
        first = valid[fresh]
        last = valid[np.append(np.flatnonzero(fresh)[1:] - 1, len(valid) - 1)]
        size = ends[last + length - 1] - starts[first]
        yield raw, hashes[anchor[fresh]], starts[first] - zero, size, text[first], starts[first] - part.offsets[text[first]]


def anchors(docs: DataFrame, length: int, gram: int, words: bool = False) -> DataFrame:
    """(h, d, id, th, start, n) of every context: anchor hash, digest of its bytes, its place and size."""
    contexts = _word_contexts if words else _byte_contexts

    def run(batches):
        for batch in batches:
            ids, hashes_of = batch.column("id"), batch.column("th")
            for part in pieces(batch.column("text"), SEGMENT):
                for raw, h, first, n, owner, start in contexts(part, length, gram):
                    view = memoryview(np.ascontiguousarray(raw))
                    digest = b"".join(
                        hashlib.blake2b(view[a : a + k], digest_size=8).digest() for a, k in zip(first.tolist(), n.tolist())
                    )
                    row = pa.array(part.first + owner)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(h.view(np.int64)),
                            pa.array(np.frombuffer(digest, "<i8")),
                            ids.take(row),
                            hashes_of.take(row),
                            pa.array(start),
                            pa.array(n, pa.int32()),
                        ],
                        ["h", "d", "id", "th", "start", "n"],
                    )

    return docs.select(*_key("doc_id", "text"), "text").mapInArrow(run, ANCHORS)


def _fetch(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of one place of each distinct context; wanted: id, th, list of (start, n, h, copies) for each document."""
    names = [f.split()[0] for f in CONTEXTS.split(", ")]

    def run(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                raw = row["text"].encode()
                for c in row["contexts"]:
                    out.append((c["h"], c["copies"], row["id"], row["th"], c["start"], raw[c["start"] : c["start"] + c["n"]]))
            if out:
                types = [pa.int64()] * 5 + [pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    texts = docs.select(*_key("doc_id", "text"), "text")
    return texts.join(wanted, ["id", "th"]).mapInArrow(run, CONTEXTS)


def _byte_symbols(contexts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Characters of the contexts, each with the end mark 1, and a last 0; how many each has; first byte of each."""
    lengths = np.array([len(c) for c in contexts])
    s = np.zeros(int((lengths + 1).sum()) + 1, np.int16)
    joined = np.frombuffer(b"\x00".join(contexts), np.uint8)
    s[: len(joined)] = joined
    s[: len(joined)] += 2
    base = np.cumsum(lengths + 1) - lengths - 1
    s[base + lengths] = 1
    return s, lengths, np.arange(len(s) - 1) - np.repeat(base, lengths + 1)


def _word_symbols(contexts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same with words, and the white space between them, as characters."""
    ranks: dict[bytes, int] = {}
    s, lengths, edges = [], [], []
    for c in contexts:
        found = SYMBOL.findall(c)
        s += [ranks.setdefault(x, len(ranks) + 2) for x in found]
        s.append(1)
        lengths.append(len(found))
        edges.append(np.append(0, np.cumsum([len(x) for x in found])))
    return np.array([*s, 0], np.int32), np.array(lengths), np.concatenate(edges)


def repeated_in_shard(rows: pd.DataFrame, length: int, words: bool = False) -> pd.DataFrame:
    """Ranges of single contexts that repeat within the shard, and digests of the windows of split anchors."""
    # Rows with one key have one text, of which one is enough; the order makes no difference to the result.
    rows = rows.drop_duplicates(["h", "id", "th", "start"])
    contexts = rows["bytes"].tolist()
    s, lengths, edge = (_word_symbols if words else _byte_symbols)(contexts)
    base = np.cumsum(lengths + 1) - lengths - 1
    if words:
        length = 2 * length - 1  # with the white space between
    sa = suffix_array(s)
    long = common_prefixes(s, sa, length) >= length
    context = np.repeat(np.arange(len(base), dtype=np.int32), lengths + 1)
    last = np.repeat((base + lengths - length).astype(np.int32), lengths + 1)
    inside = np.append(np.arange(len(s) - 1, dtype=np.int32) <= last, False)
    if words:
        inside[:-1] &= (np.arange(len(s) - 1) - np.repeat(base, lengths + 1)) % 2 == 0
    order = sa[inside[sa]]
    # A window that shares ``length`` bytes with the suffix before it is in that one's class.
    kind = np.cumsum(~long[order], dtype=np.int32) - 1
    copies = rows["copies"].to_numpy()[context[order]]
    weight = np.bincount(kind, copies)
    single = copies == 1
    id_, th, start = (rows[c].to_numpy() for c in ("id", "th", "start"))
    hit = np.sort(order[single & (weight[kind] > 1)])
    out = []
    if len(hit):
        at = context[hit]
        begins = np.append(True, (hit[1:] > hit[:-1] + length) | (at[1:] != at[:-1]))
        low = hit[begins]
        high = hit[np.append(np.flatnonzero(begins)[1:] - 1, len(hit) - 1)] + length
        c = context[low]
        out.append(pd.DataFrame({"id": id_[c], "th": th[c], "begin": start[c] + edge[low], "stop": start[c] + edge[high]}))
    split = rows["groups"].to_numpy()[context[order]] > 1
    if split.any():
        heads = np.flatnonzero(split & np.append(True, kind[1:] != kind[:-1]))
        at = order[heads]
        c = context[at]
        windows = zip(c.tolist(), edge[at].tolist(), edge[at + length].tolist())
        digest = b"".join(hashlib.blake2b(contexts[i][a:b], digest_size=16).digest() for i, a, b in windows)
        f = np.frombuffer(digest, "<i8").reshape(-1, 2)
        # Settled classes are partners only: they have no place.
        begin = np.where(weight[kind[heads]] > 1, -1, start[c] + edge[at])
        out.append(pd.DataFrame({"id": id_[c], "th": th[c], "begin": begin, "stop": start[c] + edge[at + length], "f1": f[:, 0], "f2": f[:, 1]}))
    names = [f.split()[0] for f in FOUND.split(", ")]
    if not out:
        return pd.DataFrame({n: pd.Series(dtype="Int64") for n in names})
    return pd.concat([x.reindex(columns=names) for x in out]).astype("Int64")


def repeated_ranges(
    docs: DataFrame, length: int = 400, gram: int = 200, shard_bytes: int = 1 << 19, split: int = 1024, words: bool = False
) -> DataFrame:
    """(id, th, _repeated_ranges): unsorted byte ranges [begin, stop) of every text that repeats something."""
    found = stored(anchors(docs, length, gram, words), "anchors")
    groups = found.groupBy("h").agg(F.count("*").alias("n"), (F.min("d") == F.max("d")).alias("equal")).where("n > 1")
    hits = stored(found.join(stored(groups.drop("n"), "groups"), "h"), "hits")
    place = F.struct("id", "th", "start", "n")
    mixed = hits.where("not equal")
    distinct = mixed.groupBy("h", "d").agg(F.count("*").alias("copies"), F.min(place).alias("place"))
    distinct = stored(distinct.select("h", "d", "copies", "place.*"), "distinct")
    sums = distinct.agg(F.sum("n").alias("n"), F.sum("copies").alias("rows")).first()
    # Less than HOT contexts are more than 1 / HOT of all rows: theirs are found where they are, without a shuffle by context.
    often = F.col("copies") * HOT > (sums.rows or 0)
    hot, others = (distinct.where("copies > 1").where(x).select("h", "d") for x in (often, ~often))
    hot = F.broadcast(hot)
    rest = mixed.join(hot, ["h", "d"], "left_anti").join(others, ["h", "d"], "left_semi")
    copied = mixed.join(hot, ["h", "d"], "left_semi").unionByName(rest)
    whole = hits.where("equal").unionByName(copied)
    ranges = whole.select("id", "th", F.col("start").alias("begin"), (F.col("start") + F.col("n")).alias("stop"))

    wanted = distinct.groupBy("id", "th").agg(F.collect_list(F.struct("start", "n", "h", "copies")).alias("contexts"))
    dealt = distinct.groupBy("h").agg(F.ceil(F.count("*") / split).cast("int").alias("groups"))
    shards = max(1, -(-(sums.n or 0) // shard_bytes))
    contexts = _fetch(docs, wanted).join(stored(dealt, "dealt"), "h")
    group = F.pmod(F.xxhash64("id", "th", "start"), F.col("groups"))
    contexts = contexts.withColumn("shard", F.pmod(F.xxhash64("h", F.when(F.col("groups") > 1, group)), F.lit(shards)))
    # A task has some shards, whatever their bytes: sorting suffixes takes far longer than reading them.
    tasks = -(-shards // TASK_SHARDS)
    contexts = contexts.withColumn("task", (F.col("shard") % tasks).cast("int")).repartitionById(tasks, F.col("task"))
    in_shards = contexts.groupBy("task", "shard").applyInPandas(lambda rows: repeated_in_shard(rows, length, words), FOUND)
    in_shards = stored(in_shards, "shards")
    windows = in_shards.where("f1 is not null")
    twice = windows.groupBy("f1", "f2").agg(F.count("*").alias("n")).where("n > 1").select("f1", "f2")
    across = windows.where("begin >= 0").join(twice, ["f1", "f2"], "left_semi")
    found_ranges = in_shards.where("f1 is null").unionByName(across).select("id", "th", "begin", "stop")
    return ranges.unionByName(found_ranges).groupBy("id", "th").agg(F.collect_set(F.struct("begin", "stop")).alias(RANGES))


def with_ranges(docs: DataFrame, **options) -> DataFrame:
    """All rows and columns of ``docs``, and ``_repeated_ranges``: flat byte ranges, sorted and united."""
    names = docs.columns
    repeated = repeated_ranges(docs, **options).withColumnsRenamed({"id": "_repeated_id", "th": "_repeated_th"})
    id_, th = _key("doc_id", "text")
    joined = docs.join(repeated, (id_ == F.col("_repeated_id")) & (th == F.col("_repeated_th")), "left")
    return joined.select(*names, united(F.col(RANGES)).alias(RANGES))


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def united(ranges: pa.Array) -> pa.Array:
    out = []
    for row in ranges.to_pylist():
        flat: list[int] = []
        for r in sorted((r["begin"], r["stop"]) for r in row or ()):
            if flat and r[0] <= flat[-1]:
                flat[-1] = max(flat[-1], r[1])
            else:
                flat += r
        out.append(flat)
    return pa.array(out, pa.list_(pa.int32()))


def _kept(raw: bytes, flat: list[int]) -> bytes:
    ends = [0, *flat, len(raw)]
    return b"".join(raw[a:b] for a, b in zip(ends[::2], ends[1::2]))


FACTS = T.StructType().add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept_sha256", "string")


@F.arrow_udf(FACTS)
def cut_facts(text: pa.Array, ranges: pa.Array) -> pa.Array:
    rows = []
    for raw, flat in zip(text.cast(pa.large_binary()).to_pylist(), ranges.to_pylist()):
        raw = raw or b""
        removed = sum(flat[1::2]) - sum(flat[::2])
        rows.append((len(raw), removed, len(flat) // 2, hashlib.sha256(_kept(raw, flat)).hexdigest()))
    columns = list(zip(*rows)) or [[]] * 4
    types = [pa.int64()] * 3 + [pa.string()]
    return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["n_bytes", "n_removed", "n_spans", "kept_sha256"])


@F.arrow_udf(T.StringType())
def cut_text(text: pa.Array, ranges: pa.Array) -> pa.Array:
    """What is left; a character that loses some of its bytes goes."""
    out = []
    for raw, flat in zip(text.cast(pa.large_binary()).to_pylist(), ranges.to_pylist()):
        out.append(None if raw is None else _kept(raw, flat).decode("utf-8", "ignore"))
    return pa.array(out, pa.string())


def report(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row of ``docs``."""
    facts = with_ranges(docs.select("doc_id", "text"), **options).select("doc_id", cut_facts("text", RANGES).alias("f"))
    return facts.select("doc_id", "f.*")


def trimmed(docs: DataFrame, **options) -> DataFrame:
    """All documents with what repeats cut out of their text; ``n_chars`` follows where there is one."""
    names = docs.columns
    cut = with_ranges(docs, **options).withColumn("text", cut_text("text", RANGES)).drop(RANGES)
    if "n_chars" in names:
        changed = F.length("text").cast(docs.schema["n_chars"].dataType)
        cut = cut.withColumn("n_chars", changed)
    return cut.select(*names)
