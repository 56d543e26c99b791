"""Reading inputs and writing result tables: lanes, JSON, run events, and files that arrive over time."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliate.functions.text import strip


def stem(path: Column) -> Column:
    """A file's name without folder and ending, in lower case with single underscores."""
    name = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")
    return F.regexp_replace(F.regexp_replace(F.lower(strip(name)), r"[^a-z0-9]+", "_"), r"^_+|_+$", "")


def input_files(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """(path, stem, length) of the folder's files, in order of path; contents are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path", "length")
    return found.select("path", stem(F.col("path")).alias("stem"), "length").orderBy("path")


def page_count(content: Column) -> Column:
    """Best guess at a PDF's pages from its bytes: page objects, else the largest count of a page tree; null for neither."""
    text = F.decode(content, "ISO-8859-1")
    pages = F.regexp_count(text, F.lit(r"/Type\s*/Page(?!s)\b"))
    trees = F.array_max(F.transform(F.regexp_extract_all(text, F.lit(r"/Count\s+(\d{1,9})"), F.lit(1)), lambda n: n.cast("int")))
    return F.when(pages > 0, pages).when(trees > 0, trees)


def markdown(spark: SparkSession, folder: str) -> DataFrame:
    """(stem, path, text): one markdown file of each folder's work, the first by path."""
    files = spark.read.text(f"{folder}/**/*.md", wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))
    first = files.withColumn("stem", stem(F.col("path"))).withColumn("n", F.row_number().over(W.partitionBy("stem").orderBy("path")))
    return first.where("n = 1").select("stem", "path", "text")


def markdown_lines(documents: DataFrame) -> DataFrame:
    """(doc_id, line_number, raw) of (doc_id, text); every kind of line end counts, a last empty line doesn't."""
    pieces = F.split(F.coalesce("text", F.lit("")), "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]", -1)
    lines = F.when(F.element_at(pieces, -1) == "", F.slice(pieces, 1, F.size(pieces) - 1)).otherwise(pieces)
    return documents.select("doc_id", F.posexplode(lines).alias("i", "raw")).select("doc_id", (F.col("i") + 1).alias("line_number"), "raw")


def preferred(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows of ``first``, and of ``second`` for the documents that ``first`` lacks."""
    return first.unionByName(second.join(first.select("doc_id").distinct(), "doc_id", "left_anti"))


def inside(root: str, target: str) -> str:
    """``target``, if it lies under ``root`` and is not root itself."""
    plain = lambda p: re.sub(r"/+", "/", p).rstrip("/")
    if ".." in target.split("/") or not plain(target).startswith(plain(root) + "/"):
        raise ValueError(f"{target} is not under {root}")
    return target


def write_lanes(lanes: DataFrame, root: str, name: str, by: str = "eligibility_status") -> str:
    """Write a table partitioned by lane under ``root`` and return its path."""
    path = inside(root, f"{root.rstrip('/')}/{name}")
    lanes.write.mode("overwrite").partitionBy(by).parquet(path)
    return path


def write_json(texts: DataFrame, root: str, name: str) -> str:
    """Write (doc_id, json) as lines of text, a folder for each document's remainder of 64."""
    path = inside(root, f"{root.rstrip('/')}/{name}")
    texts.select((F.col("doc_id") % 64).alias("shard"), F.col("json").alias("value")).write.mode("overwrite").partitionBy("shard").text(path)
    return path


def append_events(events: DataFrame, root: str, name: str = "run-events") -> str:
    """Append run events as JSON lines."""
    path = inside(root, f"{root.rstrip('/')}/{name}")
    events.write.mode("append").json(path)
    return path
