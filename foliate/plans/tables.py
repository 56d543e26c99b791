"""The intermediate tables that several queries read, each stored once a session for one state of its input.

A stored table between steps keeps later filters from being pushed below the
classification, where it would be computed again for each of them.  All are dealt
by document into equally many buckets, so that lines are shuffled once, when they are made.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from foliate.operators import lines
from foliate.plans.lineage import dealt, exists, n_bytes, version
from foliate.sources import corpus

#: Bytes of stored documents to a bucket.  A task takes pages of 64 MB of memory for each sort and grouping, so smaller buckets cost more than they gain.
BUCKET_BYTES = 12 << 20

#: (application, folder, label) -> state of the documents when the table was made, and the table.
_made: dict[tuple[str, str, str], tuple[str, DataFrame]] = {}
#: (application, folder, bytes of the documents) -> how many buckets they are dealt into.
_buckets: dict[tuple[str, str, int], int] = {}


def buckets(spark: SparkSession, sf_dir: str) -> int:
    """How many buckets the documents are dealt into: as many as there are cores, or a multiple of that for more bytes.

    Executors may come and go, so the first answer for these documents stays.
    """
    size, cores = n_bytes(spark, f"{sf_dir}/documents.parquet"), spark.sparkContext.defaultParallelism
    return _buckets.setdefault((spark.sparkContext.applicationId, sf_dir, size), cores * max(1, -(-size // (BUCKET_BYTES * cores))))


def stored(spark: SparkSession, sf_dir: str, df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table dealt by document into as many buckets as the lines."""
    return dealt(df, label, buckets(spark, sf_dir))


def shared(spark: SparkSession, sf_dir: str, label: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The table ``label`` of ``sf_dir``: that made before in this session, unless the documents or its own files have changed since."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    state = version(spark, f"{sf_dir}/documents.parquet")
    if key not in _made or _made[key][0] != state or not exists(_made[key][1]):
        _made[key] = (state, stored(spark, sf_dir, make(), label))
    return _made[key][1]


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared(spark, sf_dir, "lines", lambda: lines.classified_lines(corpus.exam_lines(spark, sf_dir, buckets(spark, sf_dir))))


def content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared(spark, sf_dir, "content-lines", lambda: lines.content_lines(classified(spark, sf_dir)))
