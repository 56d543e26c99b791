"""Cutting lineage with tables in the folder that all executors share, and joins on hot keys.

The folder is the session's ``spark.checkpoint.dir``, or where that is unset one
under the session's warehouse, which all executors share too.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables, from the session's settings."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_foliate"


def durable(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    The result survives the loss of any executor and has no lineage.  Reading
    with the known schema keeps an empty table readable.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


@contextmanager
def joined_as_dealt(spark: SparkSession) -> Iterator[None]:
    """Within it, joins on a document's key and more, and unions, keep to how tables are dealt already.

    No side is broadcast for its size: Spark takes that from compressed files and counts a list as one value, so
    what is exploded from a small file may be hundreds of times as large in the driver.
    """
    settings = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {s: spark.conf.get(s, None) for s in settings}
    for s, value in settings.items():
        spark.conf.set(s, value)
    try:
        yield
    finally:
        for s, value in before.items():
            if value is None:
                spark.conf.unset(s)
            else:
                spark.conf.set(s, value)


def dealt(df: DataFrame, label: str, buckets: int, by: str = "doc_id") -> DataFrame:
    """As :func:`durable`, in ``buckets`` by a hash of ``by``: windows, groups and joins of tables dealt alike shuffle no row again."""
    spark = df.sparkSession
    name = f"{label}-{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/{name}"
    with joined_as_dealt(spark):
        df.repartition(buckets, by).write.bucketBy(buckets, by).option("path", path).option("compression", "zstd").saveAsTable(f"`{name.replace('-', '_')}`", format="parquet")
    out = spark.table(f"`{name.replace('-', '_')}`")
    out.stored_at = path
    return out


def _path(spark: SparkSession, path: str):
    """The Hadoop path of ``path`` and the file system that holds it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def version(spark: SparkSession, path: str) -> str:
    """Names, sizes and times of the files at ``path``, which change when the table does."""
    at, files = _path(spark, path)
    return ";".join(sorted(f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}" for f in files.listStatus(at)))


def n_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files at and below ``path``."""
    at, files = _path(spark, path)
    return files.getContentSummary(at).getLength()


def exists(df: DataFrame) -> bool:
    """Whether the folder of a table made by :func:`durable` is still there; its files are not listed."""
    at, files = _path(df.sparkSession, df.stored_at)
    return files.exists(at)


def drop(df: DataFrame) -> None:
    """Delete the folder of a table made by :func:`durable` that nothing reads any more."""
    at, files = _path(df.sparkSession, df.stored_at)
    files.delete(at, True)


def split_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``left`` joined with ``right``, an aggregate by ``keys``, so that a hot key of ``left`` may be split.

    Adaptive execution splits a hot partition only where both sides of a join come
    straight from a shuffle and nothing after it relies on how they were dealt.  The
    hash that is joined on beside the keys gives the aggregate a shuffle of its own
    and ends that reliance.  Columns: those of both, the keys once.
    """
    by = F.xxhash64(*keys)
    return left.withColumn("_dealt", by).join(right.withColumn("_dealt", by), ["_dealt", *keys], how).drop("_dealt")
