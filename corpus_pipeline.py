"""From documents to packed training sequences: five stages, each stored before the next.

quality classifier -> line dedup -> near dedup -> mixing to target weights -> packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliate.llm import linededup, mixing, neardup, packing, quality
from foliate.plans.lineage import durable


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts: score at least THRESHOLD."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    held = quality.remainder(F.col("doc_id"), 5) == 0
    model = quality.fit(docs.select("doc_id", "text"), labels.where(~held))
    return quality.score(docs, model, keep=True).where(F.col("score") >= quality.THRESHOLD).select(*(F.col("row")[c].alias(c) for c in docs.columns))


def _with_length(docs: DataFrame) -> DataFrame:
    """n_chars follows the text."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without passages and chunks of lines that occur before it in the corpus."""
    return _with_length(linededup.dedup_passages(docs))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates (shingles of five words)."""
    kept = neardup.near_duplicates(docs).where("kept").select("doc_id").distinct()
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    stays = rows.join(kept, F.col("row")["doc_id"].eqNullSafe(kept["doc_id"]), "left_semi")
    return stays.select(*(F.col("row")[c].alias(c) for c in docs.columns))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix reads, a row for each pass over a document."""
    return _with_length(mixing.mixed_documents(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of the mix lies in which sequence."""
    return packing.pack(docs)


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Learned scores, minhash links, permutations and the tokenizer are beyond SQL; tests hold the line and near stages against brute force, the mix against the words given and run() against the stages in turn.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
