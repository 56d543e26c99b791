"""Queries over lines, content lines and blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliate.functions import text as T
from foliate.operators import lines as L
from foliate.plans import oracle_lines as O
from foliate.plans import tables
from foliate.sources import corpus


def line_classification(spark, sf_dir):
    """Type, label, confidence and page of every line."""
    out = L.classified_lines(corpus.exam_lines(spark, sf_dir))
    return out.select("doc_id", "line_number", "line_type", "detected_label", "confidence", "issue", "page_number")


def line_type_counts(spark, sf_dir):
    """Lines and documents of every type."""
    out = L.classified_lines(corpus.exam_lines(spark, sf_dir))
    return out.groupBy("line_type").agg(F.count(F.lit(1)).alias("n_lines"), F.count_distinct("doc_id").alias("n_docs"))


def content_lines(spark, sf_dir):
    """Table rows as segments of cells, other lines as they are."""
    out = L.content_lines(tables.classified(spark, sf_dir))
    return out.select("doc_id", "line_number", "parent_line_number", "source_kind", "cell_index", "segment_index", "line_type", "detected_label", "raw", "page_number")


def blocks(spark, sf_dir):
    """Runs of lines of one block type."""
    out = L.blocks(tables.classified(spark, sf_dir))
    return out.select("doc_id", "block_id", "block_type", "start_line", "end_line", "page_start", "page_end", F.round("confidence", 6).alias("confidence"), F.md5("raw_text").alias("raw_md5"), F.concat_ws("+", "issues").alias("issues"))


def classification_gate(spark, sf_dir):
    """Counts and status of every document."""
    lines = tables.classified(spark, sf_dir)
    out = L.document_gate(lines, L.content_lines(lines))
    return out.select("doc_id", "total_lines", "question_anchors", "options", "solution_anchors", "images", "table_rows", "pages", F.coalesce("content_lines", F.lit(0)).alias("content_lines"), "content_anchors", "content_options", "status")


def role_hints(spark, sf_dir):
    """How many lines have each combination of roles."""
    # a column of its own, as the label's patterns each ask for it
    lines = tables.classified(spark, sf_dir).withColumn("plainer", T.target(F.col("plain")))
    hints = lines.select("doc_id", F.concat_ws("+", T.role_hints(F.col("raw"), F.col("plain"), F.col("plainer"))).alias("roles"))
    return hints.groupBy("roles").agg(F.count(F.lit(1)).alias("n_lines"), F.count_distinct("doc_id").alias("n_docs"))


def _hints_sql() -> str:
    P, has = O.P, O.has
    rules = {
        "image_reference_candidate": f"{has('bare', P.IMAGE_REF)} AND starts_with(bare, '![')",
        "table_candidate": has("bare", P.TABLE_ROW),
        "question_anchor_candidate": "coalesce(l2, l1) IS NOT NULL",
        "option_label_candidate": " OR ".join([has("plain", P.OPTION_PAREN), has("plain", P.OPTION_CLOSE), has("plain", P.OPTION_DOT), has("bare", P.BOLD_OPTION)]),
        "answer_key_candidate": " OR ".join([has("plain", P.KEY_NUMERIC), has("plain", P.KEY_INLINE), has("plain", P.ANSWER_MARKER)]),
        "solution_heading_candidate": has("plain", P.SOLUTION_HEADING),
        "section_heading_candidate": has("bare", P.SECTION_HEADING),
        "instruction_candidate": has("plain", P.INSTRUCTION),
        "advertisement_candidate": has("bare", P.ADVERTISEMENT),
        "download_link_candidate": has("bare", P.DOWNLOAD),
        "footer_candidate": has("bare", P.FOOTER),
        "metadata_candidate": " OR ".join([has("plain", P.METADATA), has("bare", P.METADATA_EXAM)]),
    }
    joined = ", ".join(f"CASE WHEN bare <> '' AND ({rule}) THEN '{name}' END" for name, rule in rules.items())
    return f"WITH {O.CLASSIFIED} SELECT roles, count(*) AS n_lines, count(DISTINCT doc_id) AS n_docs FROM (SELECT doc_id, concat_ws('+', {joined}) AS roles FROM marked) GROUP BY roles"


QUERIES = {f.__name__: f for f in (line_classification, line_type_counts, content_lines, blocks, classification_gate, role_hints)}
_COUNT = "count(*) FILTER (line_type {}) AS {}"
ORACLES = {
    "line_classification": f"WITH {O.CLASSIFIED} SELECT doc_id, line_number, line_type, detected_label, confidence, issue, page_number FROM classified",
    "line_type_counts": f"WITH {O.CLASSIFIED} SELECT line_type, count(*) AS n_lines, count(DISTINCT doc_id) AS n_docs FROM classified GROUP BY line_type",
    "content_lines": f"WITH {O.CONTENT} SELECT doc_id, line_number, parent_line_number, source_kind, cell_index, segment_index, line_type, detected_label, raw, page_number FROM content",
    "blocks": f"""WITH {O.BLOCKS} SELECT doc_id, printf('blk_%04d', CAST(b AS INT)) AS block_id, any_value(block_type) AS block_type, min(line_number) AS start_line, max(line_number) AS end_line,
      arg_min(page_number, line_number) FILTER (page_number IS NOT NULL) AS page_start, arg_max(page_number, line_number) FILTER (page_number IS NOT NULL) AS page_end,
      round(avg(confidence), 6) AS confidence, md5(string_agg(raw, chr(10) ORDER BY line_number)) AS raw_md5, coalesce(array_to_string(list_sort(list_distinct(list(issue) FILTER (issue IS NOT NULL))), '+'), '') AS issues
      FROM numbered_blocks GROUP BY doc_id, b""",
    "classification_gate": f"""WITH {O.CONTENT}, a AS (
      SELECT doc_id, count(*) AS total_lines, {_COUNT.format("= 'question_anchor'", 'question_anchors')}, {_COUNT.format("= 'option_candidate'", 'options')},
        {_COUNT.format("IN ('solution_anchor', 'solution_section_heading')", 'solution_anchors')}, {_COUNT.format("= 'image_reference'", 'images')}, {_COUNT.format("= 'table_row'", 'table_rows')},
        count(DISTINCT page_number) FILTER (line_type = 'page_number_marker') AS pages FROM classified GROUP BY doc_id
    ), b AS (SELECT doc_id, count(*) AS content_lines, {_COUNT.format("= 'question_anchor'", 'content_anchors')}, {_COUNT.format("= 'option_candidate'", 'content_options')} FROM content GROUP BY doc_id)
    SELECT a.*, coalesce(content_lines, 0) AS content_lines, content_anchors, content_options, CASE WHEN total_lines > {L.GATE_LINES} AND coalesce(content_anchors, 0) = 0 THEN 'failed' ELSE 'succeeded' END AS status FROM a LEFT JOIN b USING (doc_id)""",
    "role_hints": _hints_sql(),
}
