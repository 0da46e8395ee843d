"""Readers for labelled corpora, lexicons and word vectors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from textloom.functions.labels import strip_spaces
from textloom.sources.csv_blocks import read_csv_blocks

# Encodings tried in this order.
ENCODINGS = ("utf-8", "windows-1258", "iso-8859-1")
# Single-byte encodings that Spark does not read by itself.
CODE_PAGES = {"windows-1258": "cp1258"}
# Encodings with several bytes for an ASCII character: their files are read whole.
WIDE = ("utf-16", "utf16", "utf-32", "utf32")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, on any file system Spark can read."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop_path)


def resolve_path(spark: SparkSession, candidates: Sequence[str]) -> str:
    """The first candidate that exists."""
    for path in candidates:
        if path_exists(spark, path):
            return path
    raise FileNotFoundError(f"none of these files exists: {list(candidates)}")


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """The frame itself, or an error that lists the columns it has."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")
    return df


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    encoding: str = "utf-8",
    line_breaks: bool = True,
) -> DataFrame:
    """CSV with header; every column is a string unless a schema is given.

    Fields may hold quoted line breaks; blocks of a file are read in parallel all the same (``csv_blocks``). For files
    whose texts have none, ``line_breaks=False`` saves the pass that counts quotes.
    """
    if line_breaks and not encoding.lower().startswith(WIDE):
        return read_csv_blocks(spark, path, schema, encoding)
    reader = spark.read.options(header=True, multiLine=line_breaks, quote='"', escape='"', encoding=encoding)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def _read_code_page(spark: SparkSession, path: str, codec: str, line_breaks: bool) -> DataFrame:
    """Latin-1 has a character for each byte; those above ASCII become the code page's, U+FFFD where it has none."""
    latin = "".join(map(chr, range(128, 256)))
    page = "".join(bytes([b]).decode(codec, "replace") for b in range(128, 256))
    df = read_csv(spark, path, encoding="iso-8859-1", line_breaks=line_breaks)
    named = str.maketrans(latin, page)
    return df.select(*[F.translate(F.col(f"`{c}`"), latin, page).alias(c.translate(named)) for c in df.columns])


def read_csv_fallback(
    spark: SparkSession, path: str, encodings: Sequence[str] = ENCODINGS, line_breaks: bool = True
) -> DataFrame:
    """Read with the first encoding that decodes the whole file.

    A character that cannot be decoded becomes U+FFFD; one such character anywhere rules the
    encoding out. A byte-order mark is dropped by the UTF-8 reader. The last encoding accepts
    any byte and is not tested. Code pages of CODE_PAGES are read byte by byte and translated;
    encodings beyond these and the standard ones, such as gbk, need spark.sql.legacy.javaCharsets=true.
    """
    for encoding in encodings[:-1]:
        try:
            if encoding in CODE_PAGES:
                df = _read_code_page(spark, path, CODE_PAGES[encoding], line_breaks)
            else:
                df = read_csv(spark, path, encoding=encoding, line_breaks=line_breaks)
            bad = [F.max(F.coalesce(F.contains(F.col(f"`{c}`"), F.lit("�")), F.lit(False))) for c in df.columns]
            broken = df.agg(F.array_contains(F.array(*bad), True)).first()[0]
        except Exception as error:  # noqa: BLE001 - an encoding Spark does not allow is skipped
            if "charset" not in str(error).lower() and "encoding" not in str(error).lower():
                raise
            continue
        if not broken and not any("�" in c for c in df.columns):
            return df
    return read_csv(spark, path, encoding=encodings[-1], line_breaks=line_breaks)


def read_table(
    spark: SparkSession, path: str, schema: StructType | str | None = None, line_breaks: bool = True
) -> DataFrame:
    """Parquet or CSV by file name."""
    if path.rstrip("/").endswith(".csv"):
        return read_csv(spark, path, schema, line_breaks=line_breaks)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_splits(
    spark: SparkSession,
    paths: Mapping[str, str | Sequence[str]],
    schema: StructType | str | None = None,
    required: Sequence[str] = (),
    line_breaks: bool = True,
) -> DataFrame:
    """Read one corpus from a file per split and tag each row with its split.

    A path may be a list of candidates, of which the first that exists is read. Columns that only
    some files have are null in the others; with ``required`` only these are kept. ``line_breaks`` as in ``read_csv``.
    """
    frames = []
    for split, path in paths.items():
        chosen = path if isinstance(path, str) else resolve_path(spark, path)
        df = require_columns(read_table(spark, chosen, schema, line_breaks), required)
        frames.append((df.select(*required) if required else df).withColumn("split", F.lit(split)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


LEXICON_SCHEMA = StructType([StructField("term", StringType()), StructField("expansion", StringType())])


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated ``term, expansion``, lower-cased; a later line wins; no file, no entries."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], LEXICON_SCHEMA)
    lines = spark.read.text(path).select(
        F.lower(strip_spaces(F.col("value"))).alias("line"),
        F.struct("_metadata.file_path", F.monotonically_increasing_id().alias("row")).alias("ordinal"),
    )
    parts = F.split("line", "\t")
    return (
        lines.filter(F.size(parts) >= 2)
        .select(F.get(parts, 0).alias("term"), F.get(parts, 1).alias("expansion"), "ordinal")
        .groupBy("term")
        .agg(F.max_by("expansion", "ordinal").alias("expansion"))
    )


def read_word_vectors(spark: SparkSession, path: str, dim: int = 300) -> DataFrame:
    """``(word, vec)`` from a text file of words and numbers; the header and broken lines drop out."""
    parts = F.split(F.rtrim("value"), " ")
    numbers = F.transform(F.slice(parts, 2, dim), lambda x: x.try_cast("float"))
    rows = spark.read.text(path).filter(F.size(parts) == dim + 1)
    return rows.select(F.get(parts, 0).alias("word"), numbers.alias("vec")).filter(
        ~F.exists("vec", lambda x: x.isNull())
    )
