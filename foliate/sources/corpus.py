"""Exam-like lines derived from the table of documents.

The documents are prose without exam structure, so questions, options, answer
lines, tables, page marks and gaps are laid over their own lines by position and
document number.  One SQL text serves Spark and the SQL that checks it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Over ``numbered`` (doc_id, i, line): i counts a document's lines from 0.
_ASKED = """
placed AS (
  SELECT doc_id, i, line, CAST(i % 6 AS INT) AS m, CAST((i - i % 6) / 6 AS INT) + 1 AS n FROM numbered
), asked AS (
  SELECT *, CASE WHEN doc_id % 7 = 3 AND n = 3 THEN 2 WHEN doc_id % 11 = 5 AND n >= 2 THEN n + 1 ELSE n END AS q,
         substr('abcd', CAST(1 + (doc_id + n) % 4 AS INT), 1) AS right_key,
         CAST((length(line) - length(line) % 2) / 2 AS INT) AS half FROM placed
)"""

#: The lines that each of ``asked`` gives: their order in the document, their text and the condition.
_LAID = [
    ("i * 10 + 1", "'<!-- PageNumber: ' || CAST(CAST((i - i % 12) / 12 AS INT) + 1 AS STRING) || ' -->'", "i % 12 = 0"),
    ("i * 10 + 5", """CASE WHEN m = 0 AND doc_id % 5 = 0 THEN 'Q' || CAST(q AS STRING) || '. ' || line
         WHEN m = 0 AND doc_id % 5 = 1 THEN CAST(q AS STRING) || '. ' || line
         WHEN m = 0 AND doc_id % 5 = 2 THEN 'Question No. ' || CAST(q AS STRING) || ' ' || line
         WHEN m = 0 AND doc_id % 5 = 3 THEN '**Que. ' || CAST(q AS STRING) || '** ' || line
         WHEN m = 0 THEN '(' || CAST(q AS STRING) || ') ' || line
         WHEN m = 2 AND doc_id % 13 = 6 THEN '| (b) ' || substr(line, 1, half) || '<br>x | --- | (c) ' || substr(line, half + 1) || ' |'
         WHEN m BETWEEN 1 AND 4 AND doc_id % 4 = 0 THEN '(' || substr('abcd', m, 1) || ') ' || line
         WHEN m BETWEEN 1 AND 4 AND doc_id % 4 = 1 THEN substr('ABCD', m, 1) || '. ' || line
         WHEN m BETWEEN 1 AND 4 AND doc_id % 4 = 2 THEN substr('abcd', m, 1) || ') ' || line
         WHEN m BETWEEN 1 AND 4 THEN '- **(' || substr('abcd', m, 1) || ')** ' || line
         WHEN (doc_id + n) % 6 = 0 THEN '![figure](assets/p' || CAST(n AS STRING) || '.png) ' || line
         WHEN (doc_id + n) % 6 = 1 THEN '$$x = ' || CAST(n AS STRING) || '$$ ' || line
         WHEN (doc_id + n) % 6 = 2 THEN 'Visit us at www.example.org/' || CAST(n AS STRING) || ' ' || line
         WHEN (doc_id + n) % 6 = 3 THEN '## Section ' || CAST(n AS STRING) || ' ' || line
         WHEN (doc_id + n) % 6 = 4 THEN '| ' || substr(line, 1, half) || ' | ' || substr(line, half + 1) || ' |'
         ELSE line END""", ""),
    ("i * 10 + 6", "''", "m = 4 AND doc_id % 9 = 4"),
    ("1000000000", "CASE doc_id % 6 WHEN 1 THEN '### Explanations' WHEN 2 THEN '**Answers with Explanations**' WHEN 3 THEN '# Answer Key' ELSE '### Solutions' END", "i = 0"),
    ("1000000001 + i * 10", """CASE WHEN (doc_id + q) % 8 = 7 THEN 'Ans. (' || right_key || ')'
    WHEN (doc_id + q) % 8 = 6 THEN 'S' || CAST(q AS STRING) || '. ' || line
    WHEN doc_id % 6 IN (1, 2) THEN '**' || CAST(q AS STRING) || '.** (*' || right_key || '*) ' || line
    ELSE 'S' || CAST(q AS STRING) || '. Ans(' || right_key || ') ' || line END""", "m = 0 AND (doc_id + q) % 10 <> 9"),
    ("1000000003 + i * 10", "'S' || CAST(q AS STRING) || '. Ans(' || right_key || ') ' || line", "m = 0 AND (doc_id + q) % 19 = 0 AND (doc_id + q) % 10 <> 9 AND (doc_id + q) % 8 < 6 AND doc_id % 6 NOT IN (1, 2)"),
    ("1000000002 + i * 10", "'S' || CAST(q AS STRING) || ') Answer: A'", "m = 0 AND (doc_id + q) % 17 = 0"),
]
_LINES = """lines AS (
  SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS INT) AS line_number, raw FROM laid
)
"""

#: Spark lays all rows that a line gives in one pass over the lines.
_EACH = "laid AS (SELECT doc_id, l.ord, l.raw FROM (SELECT doc_id, explode(array_compact(array(" + ", ".join(f"CASE WHEN {when or 'true'} THEN named_struct('ord', CAST({ord_} AS BIGINT), 'raw', {raw}) END" for ord_, raw, when in _LAID) + "))) AS l FROM asked))"
_SPARK = f"WITH numbered AS (SELECT doc_id, CAST(i AS BIGINT) AS i, line FROM {{docs}} LATERAL VIEW posexplode(split(coalesce(text, ''), '\\n', -1)) AS i, line), {_ASKED}, {_EACH}, {_LINES} SELECT doc_id, line_number, raw FROM lines"

#: CTEs up to ``lines`` for the checking SQL.
LINES_SQL = (
    """numbered AS (
  SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS BIGINT) AS i, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), """
    + _ASKED
    + ", laid AS (\n"
    + "\n  UNION ALL\n".join(f"  SELECT doc_id, {ord_}{'' if k else ' AS ord'}, {raw}{'' if k else ' AS raw'} FROM asked" + (f" WHERE {when}" if when else "") for k, (ord_, raw, when) in enumerate(_LAID))
    + "\n), "
    + _LINES
)


def exam_lines(spark: SparkSession, sf_dir: str, buckets: int | None = None) -> DataFrame:
    """(doc_id, line_number, raw) of every document, dealt by document into ``buckets`` before its lines are made."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    docs = docs.repartition(buckets, "doc_id") if buckets else docs
    return spark.sql(_SPARK, docs=docs)
