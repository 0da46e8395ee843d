"""Session helpers: defaults for local runs, partitioning by document, bounded intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: str | int = 8, app: str = "textloom", memory: str = "12g") -> SparkSession:
    """A session for tests and benches on one machine; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Stored tables up to this size may be broadcast by callers that know them to be bounded.
BROADCAST_BYTES = 64 * 2**20


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only on a local master with none set."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if path:
        return path
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="textloom-")
    sc.setCheckpointDir(path)
    return path


def stored_root(spark: SparkSession) -> str:
    """Where an application keeps its intermediates: a folder of its own below the shared one."""
    return f"{shared_dir(spark)}/textloom/{spark.sparkContext.applicationId}"


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of the files under a path."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.getContentSummary(hadoop_path).getLength()


def materialize(df: DataFrame, name: str, broadcast_below: int | None = None) -> DataFrame:
    """Write an intermediate (vocabulary, parameters, scores) and read it back.

    This cuts the lineage, survives the loss of executors, and gives later joins the true file
    size, so that Catalyst broadcasts the table only when it is below its threshold. A caller that
    knows its table to be bounded may raise that threshold with ``broadcast_below``; the stored
    size is checked against it.
    """
    spark = df.sparkSession
    path = f"{stored_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    if broadcast_below and stored_bytes(spark, path) <= broadcast_below:
        return F.broadcast(stored)
    return stored


def spread(df: DataFrame, key: str) -> DataFrame:
    """Use all cores when a scan has fewer partitions than cores; leave larger inputs alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


# Stored bytes of documents that one task explodes into features: about twice as much text, some hundred MB of features.
TASK_BYTES = 2 * 2**20


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size of a table: that of its files for a stored one or a scan."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcasts(df: DataFrame) -> bool:
    """Whether Catalyst's size of a table is below the threshold up to which a join broadcasts it."""
    return estimated_bytes(df) <= df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def doc_partitions(scan: DataFrame) -> int:
    """Partitions of documents whose features fit in memory."""
    return max(scan.sparkSession.sparkContext.defaultParallelism, -(-estimated_bytes(scan) // TASK_BYTES))


def by_doc(df: DataFrame, key: str = "doc_id", scan: DataFrame | None = None) -> DataFrame:
    """Hash-partition by document before the text is exploded into features.

    One shuffle of the text makes every later grouping by document local; grouping after the
    explode would move several times the text. The number of partitions follows the size of ``df``, or of the ``scan``
    that it comes from, so that the features of a partition fit in memory whatever the size of the input; fixed, AQE does
    not join small ones up to a size that fits texts, but not what becomes of them.
    """
    return df.repartition(doc_partitions(df if scan is None else scan), key)


def store_by_doc(df: DataFrame, name: str, key: str = "doc_id", bytes_per_bucket: int = 2 * TASK_BYTES) -> DataFrame:
    """Store a corpus in buckets of documents, for work that passes over its texts several times.

    Later groupings by document then need no shuffle of the text in any pass. Buckets follow the bytes of the texts, so
    that the features of one fit in memory. Each task writes one bucket, since the table is partitioned like its buckets.
    """
    spark = df.sparkSession
    texts = [F.coalesce(F.sum(F.octet_length(c)), F.lit(0)) for c, kind in df.dtypes if kind == "string"]
    wanted = -(-sum(df.agg(*texts).first()) // bytes_per_bucket) if texts else 0
    buckets = max(spark.sparkContext.defaultParallelism, wanted)
    table = f"textloom_{name}_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).format("parquet")
    writer.option("path", f"{stored_root(spark)}/{table}").saveAsTable(table)
    return spark.table(table)


def pinned_session(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A session like ``spark`` with some settings of its own: its scans keep them, whatever is set later elsewhere."""
    session = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            session.conf.set(name, value)
    for name, value in settings.items():
        session.conf.set(name, value)
    return session


def store_buckets(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Store a table in buckets of ``key`` and read it with one task for each bucket, without a shuffle."""
    table = f"textloom_{name}_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).format("parquet")
    writer.option("path", f"{stored_root(df.sparkSession)}/{table}").saveAsTable(table)
    return pinned_session(df.sparkSession, {"spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}).table(table)


def clear_stored(spark: SparkSession) -> None:
    """Delete what this application stored, once nothing reads it any more; other applications' folders stay."""
    root = stored_root(spark)
    for table in spark.catalog.listTables():
        if table.name.startswith("textloom_"):
            place = spark.sql(f"DESCRIBE FORMATTED `{table.name}`").where("col_name = 'Location'").first()
            if place and f"/{spark.sparkContext.applicationId}/" in place.data_type:
                spark.sql(f"DROP TABLE IF EXISTS `{table.name}`")
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)
