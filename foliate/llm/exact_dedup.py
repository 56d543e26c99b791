"""Exact duplicates by progressive refinement, with DataFrame functions only.

Rows are compared by length and, within a length, by the hash of a prefix, and those
that share both by the hash of the whole text.  Only rows that survive a step
enter the next shuffle, and no shuffle carries a text.  Lengths and prefixes are
counted before they are shuffled, and no step groups by what the step before
joined on, so that adaptive execution may split a join on a hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliate.plans.lineage import split_join

PREFIX_CHARS = 256


def _shared(df: DataFrame, keys: list[str]) -> DataFrame:
    """Values of ``keys`` that at least two rows have; counted before the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")


def exact_groups(docs: DataFrame, text: str = "text", key: str = "doc_id", normalise=None, prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """Add keep_id, group_size, kept, text_sha256 to (key, text).

    Of equal texts the row with the largest key stays; equality is that of the
    SHA-256 of the whole text after ``normalise`` (a function of a column; none:
    unchanged).  Null counts as the empty text.  Rows repeated with the same key
    count in group_size and are all marked alike.  A null key sorts below every
    other; a group of null keys alone is kept by null.  Other columns of ``docs``
    are not read and cannot clash.
    """
    content: Column = F.coalesce(docs[text].cast("string"), F.lit(""))
    content = normalise(content) if normalise else content
    base = docs.select(docs[key].alias("_key"), content.alias("_text")).select(
        "_key",
        F.octet_length("_text").cast("long").alias("_len"),
        F.xxhash64(F.substring("_text", 1, prefix_chars)).alias("_prefix"),
        F.sha2(F.col("_text").cast("binary"), 256).alias("_sha"),
    )
    # length first: with partial counts by (length, prefix) a length that one row has never leaves its task twice
    prefixes = _shared(base.select("_len", "_prefix"), ["_len", "_prefix"])
    third = split_join(base, prefixes, ["_len", "_prefix"], "left_semi")
    groups = third.groupBy("_sha").agg(F.max("_key").alias("_keep"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    joined = split_join(base.select("_key", "_sha"), groups, ["_sha"], "left")
    alone = F.col("_n").isNull()
    return joined.select(
        F.col("_key").alias(key),
        F.when(alone, F.col("_key")).otherwise(F.col("_keep")).alias("keep_id"),
        F.when(alone, F.lit(1)).otherwise(F.col("_n")).cast("long").alias("group_size"),
        (alone | F.col("_key").eqNullSafe(F.col("_keep"))).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def op8_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """All documents with the group of equal texts each belongs to."""
    return exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


ORACLE = """
SELECT doc_id,
       max(doc_id) OVER w AS keep_id,
       count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
