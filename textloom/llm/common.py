"""What the operators share: stored intermediates, the fold of a document, files in the shared folder."""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.session import shared_dir


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, one folder for each application."""
    return f"{shared_dir(spark)}/textloom-llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage and survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most BATCH_ROWS rows, unless the session asks for fewer: whole texts make rows long."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def bounded_sample(rows: DataFrame, max_rows: int, max_bytes: int) -> DataFrame:
    """At most ``max_rows`` rows and ``max_bytes`` bytes of text of ``rows`` (doc_id, text, and what is learned).

    Rows are taken in the order of a hash of doc_id, then by text, until either bound; rows that repeat doc_id and text
    count once (with the smallest of what differs in them), and texts above ``max_bytes`` are passed over. Only ids and hashes are sorted; the bounded list is broadcast.
    """
    keyed = rows.withColumn("_th", F.xxhash64("text"))
    sized = keyed.select("doc_id", "_th", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("_bytes"))
    order = [F.xxhash64("doc_id").asc(), F.col("doc_id").asc(), F.col("_th").asc()]
    first = sized.where(F.col("_bytes") <= max_bytes).distinct().orderBy(*order).limit(max_rows)
    so_far = F.sum("_bytes").over(Window.orderBy(*order))  # over max_rows rows
    wanted = first.withColumn("_so_far", so_far).where(F.col("_so_far") <= max_bytes).select("doc_id", "_th")
    found = keyed.join(F.broadcast(wanted), ["doc_id", "_th"])
    one = found.groupBy("doc_id", "_th").agg(F.min(F.struct(*rows.columns)).alias("_row"))
    return one.select("_row.*")


def remainder(key: str, parts: int) -> Column:
    """crc32 of an id as text, modulo ``parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % parts


def filesystem(uri: str):
    """The file system of a path and the path within it; a path without a scheme is on a shared mount."""
    if "://" in uri:
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri.removeprefix("file:")


def open_new(uri: str):
    """A writable stream; makes the folders above it."""
    fs, path = filesystem(uri)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return fs.open_output_stream(path, compression=None)


def mapped(uri: str, dtype: str) -> np.ndarray:
    """A file as an array: memory-mapped on a shared mount, else read whole."""
    fs, path = filesystem(uri)
    if fs.type_name == "local":
        return np.memmap(path, dtype, "r") if os.path.getsize(path) else np.zeros(0, dtype)
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype)
