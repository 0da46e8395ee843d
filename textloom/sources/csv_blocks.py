"""CSV with quoted line breaks, read in parallel from blocks of a file.

Where a record begins depends on all quotes before it, but only on whether their number is odd. So each block's lines
are counted for quotes first; an exclusive prefix sum over the blocks of a file tells whether a block begins inside a
quoted field. With that every block finds its own records in a second, parallel pass. What a block holds of a
record that began in an earlier one is a fragment; the fragments of a record, at most two from each block, are put
together by file and place. No task reads a whole file.

Quotes stand only around or, doubled, in quoted fields, as in RFC 4180. Lines end in LF or CRLF; a CRLF within a field
stays as it is. The first record of each file is its header. Blank records are left out. Encodings must leave ASCII
bytes alone (not UTF-16). A file without records gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from textloom.session import pinned_session

QUOTE = 34
OPTIONS = {"quote": '"', "escape": '"'}
WHOLE, HEAD, TAIL = 0, 1, 2
FOUND = "record binary, file string, block long, part int, first boolean"


LEAST_BLOCK = 1 << 16


def block_session(spark: SparkSession, path: str, block_bytes: int | None) -> SparkSession:
    """A session like ``spark`` in which scans are cut into blocks of one size, whatever is set later elsewhere.

    Both passes over a file must see the same blocks; a scan keeps the settings of its own session. The size follows
    Spark's: its largest, or less so that all cores have blocks.
    """
    if block_bytes is None:
        total = int(str(spark.read.text(path)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        share = max(LEAST_BLOCK, total // spark.sparkContext.defaultParallelism)
        block_bytes = min(share, int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()))
    files = "spark.sql.files."
    return pinned_session(
        spark,
        {f"{files}maxPartitionBytes": str(block_bytes), f"{files}openCostInBytes": str(min(block_bytes, 4 << 20)), f"{files}minPartitionNum": "1"},
    )


def read_lines(session: SparkSession, path: str) -> DataFrame:
    """(value binary, file, block) of every line, in file order within a block."""
    lines = session.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("value").cast("binary").alias("value"), "_metadata.file_path", "_metadata.file_block_start").toDF(
        "value", "file", "block"
    )


def open_blocks(lines: DataFrame) -> set[tuple[str, int]]:
    """The blocks that begin inside a quoted field. Only these come to the driver: one entry for a block at most."""
    text = F.col("value").cast("string")
    quotes = F.octet_length(text) - F.octet_length(F.replace(text, F.lit('"'), F.lit("")))
    odd = lines.groupBy("file", "block").agg((F.sum(quotes.cast("long")) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    opened = odd.withColumn("before", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).where("before = 1")
    return {(r.file, r.block) for r in opened.select("file", "block").toLocalIterator()}


class _Block:
    """Records of one block from its lines, batch after batch."""

    def __init__(self, file: str, block: int, inside: bool):
        self.file, self.block = file, block
        self.inside = inside
        self.held: list[bytes] = []  # lines of a record that is not complete
        self.part = HEAD if inside else WHOLE  # what the held lines are when they end
        self.first = block == 0  # the next record is the header

    def _rows(self, records: list, part: int, first: bool = False):
        n = len(records)
        array = records if isinstance(records, pa.Array) else pa.array(records, pa.binary())
        return pa.RecordBatch.from_arrays(
            [array, pa.array([self.file] * n), pa.array(np.full(n, self.block)), pa.array(np.full(n, part, np.int32)), pa.array([first] * n)],
            ["record", "file", "block", "part", "first"],
        )

    def _close(self):
        rows = self._rows([b"\n".join(self.held)], self.part, self.first and self.part != HEAD)
        if self.part == WHOLE:
            self.first = False
        self.held, self.part = [], WHOLE
        return rows

    def lines(self, values: pa.Array):
        offsets = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1]
        data = np.frombuffer(values.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        quotes = np.append(0, np.cumsum(data == QUOTE))[offsets - offsets[0]]
        after = ((quotes[1:] - quotes[0] + self.inside) % 2).astype(bool)
        before = np.append(self.inside, after[:-1])
        whole = np.flatnonzero(~before & ~after)
        if self.first and len(whole) and whole[0] == 0 and not self.held:
            yield self._rows(values.slice(0, 1), WHOLE, True)
            self.first, whole = False, whole[1:]
        if len(whole):
            yield self._rows(values.take(pa.array(whole)), WHOLE)
        for i in np.flatnonzero(before | after).tolist():
            self.held.append(values[i].as_py())
            if not after[i]:
                yield self._close()
        self.inside = bool(after[-1]) if len(after) else self.inside

    def end(self):
        """What is left is the beginning of a record that a later block ends, or the middle of one."""
        if self.held:
            if self.part == WHOLE:
                self.part = TAIL
            yield self._close()


def _records(lines: DataFrame, opened: set[tuple[str, int]]) -> DataFrame:
    shared = lines.sparkSession.sparkContext.broadcast(opened)

    def run(batches):
        current = None
        for batch in batches:
            files, blocks = batch.column("file").to_pylist(), batch.column("block").to_numpy()
            changes = [i for i in range(1, len(files)) if blocks[i] != blocks[i - 1] or files[i] != files[i - 1]]
            for low, high in zip([0, *changes], [*changes, len(files)]):
                if low == high:
                    continue
                place = files[low], int(blocks[low])
                if current is None or (current.file, current.block) != place:
                    if current is not None:
                        yield from current.end()
                    current = _Block(*place, place in shared.value)
                yield from current.lines(batch.column("value").slice(low, high - low))
        if current is not None:
            yield from current.end()

    return lines.mapInArrow(run, FOUND)


def _assembled(found: DataFrame) -> DataFrame:
    """Records whose fragments lie in several blocks: a tail, then the heads up to the next tail."""
    order = Window.partitionBy("file").orderBy("block", "part")
    fragments = found.where(F.col("part") != WHOLE).withColumn("number", F.sum(F.when(F.col("part") == TAIL, 1).otherwise(0)).over(order))
    parts = F.array_sort(F.collect_list(F.struct("block", F.col("record").alias("text"))))["text"]
    joined = F.aggregate(
        F.slice(F.col("parts"), F.lit(2), F.size("parts")), F.get("parts", F.lit(0)), lambda a, b: F.concat(a, F.lit(b"\n"), b)
    )
    grouped = fragments.groupBy("file", "number").agg(parts.alias("parts"), F.bool_or("first").alias("first"))
    return grouped.select(joined.alias("record"), "first")


def decoded(record: Column, encoding: str) -> Column:
    """Text of a record; bytes that the encoding does not know become U+FFFD."""
    if encoding.lower() in ("utf-8", "utf8"):
        return F.make_valid_utf8(record.cast("string"))
    return F.decode(record, encoding)


def read_csv_blocks(
    spark: SparkSession, path: str, schema: StructType | str | None = None, encoding: str = "utf-8", block_bytes: int | None = None
) -> DataFrame:
    """CSV files with header and quoted line breaks; every column is a string unless a schema is given.

    ``block_bytes`` is the size of a block, by default as in ``block_session``. One pass counts quotes at once; records are
    found when the result is used.
    """
    session = block_session(spark, path, block_bytes)
    if schema is None:
        names = session.read.options(header=True, multiLine=True, encoding=encoding, **OPTIONS).csv(path).columns
        schema = StructType([StructField(n, StringType()) for n in names])
    lines = read_lines(session, path)
    found = _records(lines, open_blocks(lines))
    whole = found.where(F.col("part") == WHOLE).select("record", "first")
    records = whole.unionByName(_assembled(found)).where(~F.col("first"))
    text = F.regexp_replace(decoded(F.col("record"), encoding), "\\r$", "").alias("text")
    rows = records.select(text).where(F.trim("text") != "")
    parsed = rows.select(F.from_csv("text", schema if isinstance(schema, str) else _ddl(schema), OPTIONS).alias("row"))
    return parsed.select("row.*")


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
