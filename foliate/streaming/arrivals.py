"""Structuring documents as their files arrive.

The order of lines lies inside a file, not in event time, so there is no
watermark: each batch of files is structured whole by the batch operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliate.operators import lines
from foliate.sources.packages import inside, markdown_lines, stem


def watch(spark: SparkSession, folder: str) -> DataFrame:
    """(stem, text) of markdown files as they appear under ``folder``."""
    files = spark.readStream.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.md")
    return files.select(stem(F.input_file_name()).alias("stem"), F.col("value").alias("text"))


def structure(stream: DataFrame, root: str, checkpoint: str, name: str = "lines"):
    """Start a query that appends the classified lines of each arriving document to a table under ``root``."""
    path = inside(root, f"{root.rstrip('/')}/{name}")

    def batch(files: DataFrame, number: int) -> None:
        docs = files.select(F.xxhash64("stem").alias("doc_id"), "stem", "text")
        classified = lines.classified_lines(markdown_lines(docs))
        out = classified.join(docs.select("doc_id", "stem"), "doc_id").withColumn("batch", F.lit(number))
        # a batch that is run again after a failure replaces its own rows
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
