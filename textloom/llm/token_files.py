"""Token ids as flat binary files with 64-bit document offsets.

A shard is three files: ``.bin`` holds the ids as unsigned integers (16 bits when the vocabulary fits, else 32), ``.off``
the offset of each document and the end, ``.ids`` the doc_ids and a flag for null ones. Documents are range-partitioned
and sorted by doc_id, so shards follow one another; each shard's base is the prefix sum of the lengths before
it, one row for each shard. Readers memory-map the files (a remote folder is read into memory by shard).

Texts are cut at single blanks between other characters: the tokenizer's pattern always begins a new piece there, so the ids
of the pieces, encoded once and kept in a bounded cache, are the ids of the text.

Defined results: null and empty texts have the end id alone; null doc_ids come first; rows that repeat a doc_id stand
next to each other in an order given by their text's hash; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import mapped, open_new, scratch, stored

SHARD = "part long, prefix string, width int, documents long, tokens long"
# White space other than blanks and line ends; where there is any, or a blank next to a line end, CUT decides.
RARE_SPACE = tuple("\t\v\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000") + tuple(map(chr, range(0x2000, 0x200B)))
CUT = re.compile(r"(?<=\S) (?=\S)")
LETTERS = re.compile(r"[^\W\d_]+")


class Encoder:
    """Ids of whole texts as bytes, by way of cached pieces.

    ``after`` holds pieces that follow a blank (without it), ``alone`` the others. A cache above ``limit`` pieces becomes the
    old generation, from which pieces in use come back. Tokenizers of another kind than byte-level get whole texts.
    """

    def __init__(self, path: str, end_id: int, limit: int = 600_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.type = np.uint16 if max(size, end_id + 1) <= 1 << 16 else np.uint32
        self.end = self.type(end_id).tobytes()
        kind = json.loads(self.tokenizer.to_str())
        split = kind.get("pre_tokenizer") or {}
        regular = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        self.by_pieces = regular and kind.get("normalizer") is None
        # Tokens that begin with a blank, which byte-level vocabularies write as U+0120.
        self.blank = np.array([(self.tokenizer.id_to_token(i) or "").startswith("\u0120") for i in range(size)])
        self.after, self.alone, self.limit = {}, {}, limit
        self.old_after, self.old_alone = {}, {}

    def _batch(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.type).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_alone(self, pieces: set[str]) -> None:
        known = self.old_alone
        new = [p for p in pieces if p not in known]
        self.alone.update((p, known[p]) for p in pieces if p in known)
        self.alone.update(zip(new, self._batch(new)))

    def _learn_words(self, words: list[str]) -> None:
        """Runs of letters after a blank, encoded as one text and cut where a token begins with a blank."""
        for low in range(0, len(words), 4096):
            some = words[low : low + 4096]
            ids = np.array(self.tokenizer.encode_batch_fast([" " + " ".join(some)], add_special_tokens=False)[0].ids, self.type)
            cut = np.append(np.flatnonzero(self.blank[ids]), len(ids)) * ids.itemsize
            if len(cut) != len(some) + 1:
                self.after.update(zip(some, self._batch([" " + w for w in some])))
                continue
            raw, cut = ids.tobytes(), cut.tolist()
            self.after.update((w, raw[i:j]) for w, i, j in zip(some, cut, cut[1:]))

    def _learn_after(self, pieces: set[str]) -> None:
        """Letters and what follows them are encoded apart: a piece of the tokenizer's pattern never holds both."""
        known = self.old_after
        words, tails, joined, other = set(), set(), [], []
        for piece in pieces:
            if piece in known:
                self.after[piece] = known[piece]
                continue
            run = LETTERS.match(piece)
            end = run.end() if run and run.group().isalpha() else 0
            if end == 0:
                other.append(piece)
            elif end == len(piece):
                words.add(piece)
            else:
                head, tail = piece[:end], piece[end:]
                joined.append((piece, head, tail))
                if head not in self.after:
                    words.add(head)
                if tail not in self.alone:
                    tails.add(tail)
        held = {w for w in words if w in known}
        self.after.update((w, known[w]) for w in held)
        self._learn_words(list(words - held))
        self._learn_alone(tails)
        self.after.update(zip(other, self._batch([" " + p for p in other])))
        self.after.update((piece, self.after[head] + self.alone[tail]) for piece, head, tail in joined)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if not self.by_pieces:
            return [raw + self.end for raw in self._batch([t or "" for t in texts])]
        if len(self.after) + len(self.alone) > self.limit:
            self.old_after, self.old_alone = self.after, self.alone
            self.after, self.alone = {}, {}
        cut = [_cut(text) if text else [] for text in texts]
        first = {c[0] for c in cut if c}
        rest = set().union(*(c[1:] for c in cut))
        self._learn_alone(first.difference(self.alone))
        self._learn_after(rest.difference(self.after))
        get, alone = self.after.__getitem__, self.alone
        return [alone[c[0]] + b"".join(map(get, c[1:])) + self.end if c else self.end for c in cut]


def _cut(text: str) -> list[str]:
    """Cut at blanks between other characters; the blank is dropped."""
    parts = text.split(" ")
    if "" in parts or "\n " in text or " \n" in text or any(c in text for c in RARE_SPACE):
        return CUT.split(text)
    return parts


@functools.cache
def _encoder(path: str, end_id: int) -> Encoder:
    """One for each worker process, for all its tasks."""
    return Encoder(path, end_id)


def write_shards(docs: DataFrame, folder: str, tokenizer: str, end_id: int, rows_per_shard: int = 20_000) -> DataFrame:
    """Write all documents in ascending doc_id order; returns the stored list of shards."""
    shards = max(docs.sparkSession.sparkContext.defaultParallelism, -(-docs.count() // rows_per_shard))
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    placed = narrow.repartitionByRange(shards, "doc_id", "h").sortWithinPartitions("doc_id", "h")
    placed = placed.withColumn("part", F.spark_partition_id().cast("long")).drop("h")

    def run(batches):
        encoder = _encoder(tokenizer, end_id)
        prefix = f"{folder}/{uuid.uuid4().hex}"
        out, part = None, None
        lengths, ids, nulls = [], [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                out, part = open_new(prefix + ".bin"), batch.column("part")[0].as_py()
            texts = batch.column("text")
            for low in range(0, len(texts), 256):
                encoded = encoder.encode(texts.slice(low, 256).to_pylist())
                lengths += [len(e) // encoder.type().itemsize for e in encoded]
                out.write(b"".join(encoded))
            doc = batch.column("doc_id")
            ids.append(doc.fill_null(0).to_numpy())
            nulls.append(doc.is_null().to_numpy(zero_copy_only=False))
        if out is None:
            return
        out.close()
        offsets = np.append(0, np.cumsum(lengths)).astype("<i8")
        with open_new(prefix + ".off") as f:
            f.write(offsets.tobytes())
        with open_new(prefix + ".ids") as f:
            f.write(np.concatenate(ids).astype("<i8").tobytes() + np.concatenate(nulls).astype(np.uint8).tobytes())
        row = [[part], [prefix], [encoder.type().itemsize], [len(lengths)], [int(offsets[-1])]]
        types = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], [f.split()[0] for f in SHARD.split(", ")])

    return stored(placed.mapInArrow(run, SHARD), "token-shards")


def with_bases(shards: DataFrame) -> DataFrame:
    """Adds ``base``, the tokens of all shards before: a prefix sum over one row for each shard."""
    rows = shards.orderBy("part").collect()
    bases = list(itertools.accumulate((r.tokens for r in rows), initial=0))
    values = [(*r, base) for r, base in zip(rows, bases)]
    return shards.sparkSession.createDataFrame(values, SHARD + ", base long")


def read_documents(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    tasks = max(1, shards.count())

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = mapped(row["prefix"] + ".bin", f"<u{row['width']}")
                offsets = mapped(row["prefix"] + ".off", "<i8")
                raw = mapped(row["prefix"] + ".ids", "u1")
                n = row["documents"]
                docs, null = np.frombuffer(raw[: 8 * n].tobytes(), "<i8"), raw[8 * n :].astype(bool)
                for low in range(0, n, 10_000):
                    cut = offsets[low : min(n, low + 10_000) + 1]
                    crc = [zlib.crc32(ids[a:b].astype("<u4")) for a, b in zip(cut[:-1], cut[1:])]
                    high = low + len(crc)
                    columns = [pa.array(docs[low:high], mask=null[low:high]), pa.array(cut[:-1] + row["base"]), pa.array(np.diff(cut)), pa.array(crc, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    return shards.repartition(tasks, "part").mapInArrow(run, schema)


def round_trip(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    shards = write_shards(docs, scratch(docs.sparkSession, "tokens"), tokenizer, end_id)
    return read_documents(with_bases(shards))
