"""Lines, content lines and blocks of markdown documents.

Every operator shuffles by document at most once: windows over one document's
lines share the partitioning that the line numbers were made with.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliate.functions import patterns as P
from foliate.functions import text as T

GATE_LINES = 100


def classify(lines: DataFrame, raw: str = "raw", **rules: bool) -> DataFrame:
    """Add line_type, detected_label, confidence, issue, page_mark and plain to lines.

    The number of the rule that holds is computed first; what follows from it is
    then looked up, so that no pattern is evaluated once for every output.
    """
    c = F.col
    steps = lines.withColumn("_bare", T.strip(c(raw)))
    steps = steps.withColumn("plain", T.target_of(c("_bare")))
    steps = steps.withColumns({"_plainer": T.target_of(c("plain")), "_label": T.question_label(c("plain"))})
    steps = steps.withColumn("_label2", F.when(c("_plainer") == c("plain"), c("_label")).otherwise(T.question_label(c("_plainer"))))
    ordered = T.line_rules(c(raw), c("_bare"), c("plain"), c("_label"), c("_label2"), **rules)
    number = reduce(lambda case, r: case.when(r[1].holds, r[0]), list(enumerate(ordered))[1:-1], F.when(ordered[0].holds, 0)).otherwise(len(ordered) - 1)
    steps = steps.withColumn("_rule", number)

    def looked_up(field: str) -> Column:
        found = [(n, getattr(r, field)) for n, r in enumerate(ordered) if getattr(r, field) is not None]
        kind = "int" if field == "page" else "string"
        if not found:
            return F.lit(None).cast(kind)
        return reduce(lambda case, x: case.when(c("_rule") == x[0], x[1]), found[1:], F.when(c("_rule") == found[0][0], found[0][1])).cast(kind)

    out = {"line_type": F.get(F.array(*(F.lit(r.kind) for r in ordered)), c("_rule")), "confidence": F.get(F.array(*(F.lit(float(r.confidence)) for r in ordered)), c("_rule"))}
    out |= {"detected_label": looked_up("label"), "issue": looked_up("issue"), "page_mark": looked_up("page")}
    return steps.withColumns(out).drop("_bare", "_plainer", "_label", "_label2", "_rule")


def classified_lines(lines: DataFrame) -> DataFrame:
    """Every line with its class, and the number of the last page mark up to it."""
    order = W.partitionBy("doc_id").orderBy("line_number")
    return classify(lines).withColumn("page_number", F.last("page_mark", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, 0))).drop("page_mark")


def block_type(line_type: Column) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for pair in P.BLOCK_TYPES.items() for x in pair)), line_type)


def blocks(classified: DataFrame) -> DataFrame:
    """Runs of consecutive lines of one block type; a question anchor stands alone."""
    order = W.partitionBy("doc_id").orderBy("line_number")
    typed = classified.withColumn("block_type", block_type(F.col("line_type")))
    same = F.col("block_type").eqNullSafe(F.lag("block_type").over(order)) & (F.col("block_type") != "question_candidate_block")
    numbered = typed.withColumn("fresh", F.when(same, 0).otherwise(1)).withColumn("block", F.sum("fresh").over(order.rowsBetween(W.unboundedPreceding, 0)))
    by_line = lambda c: F.struct("line_number", c)
    with_page = F.when(F.col("page_number").isNotNull(), by_line("page_number"))
    out = numbered.groupBy("doc_id", "block").agg(
        F.first("block_type").alias("block_type"),
        F.min("line_number").alias("start_line"),
        F.max("line_number").alias("end_line"),
        F.min(with_page)["page_number"].alias("page_start"),
        F.max(with_page)["page_number"].alias("page_end"),
        F.avg("confidence").alias("confidence"),
        F.array_join(F.transform(F.array_sort(F.collect_list(by_line("raw"))), lambda x: x["raw"]), "\n").alias("raw_text"),
        F.array_sort(F.collect_set("issue")).alias("issues"),
    )
    return out.withColumn("block_id", F.format_string("blk_%04d", "block")).drop("block")


def content_lines(classified: DataFrame) -> DataFrame:
    """Table rows split into the segments of their cells, classified anew; other lines as they are."""
    inner = F.regexp_replace(F.regexp_replace(T.strip(F.col("raw")), r"^\|", ""), r"\|$", "")
    cells = F.filter(F.transform(F.split(inner, r"\|", -1), T.strip), lambda c: (c != "") & ~T.has(F.replace(c, F.lit(" "), F.lit("")), P.TABLE_SEPARATOR))
    parts = lambda c: F.filter(F.split(c, P.BR_TAG, -1), lambda s: s != "")
    piece = lambda i, j, s: F.struct(i.cast("int").alias("cell_index"), j.cast("int").alias("segment_index"), s.cast("string").alias("segment"))
    of_cell = lambda c, i: F.transform(F.when(F.size(parts(c)) == 0, F.array(c)).otherwise(parts(c)), lambda s, j: piece(i, j, s))
    segments = F.filter(F.flatten(F.transform(cells, of_cell)), lambda p: T.strip(p["segment"]) != "")
    # a line that is no row is one piece without a segment, so that lines are read once and stay where they are dealt
    none = F.lit(None)
    pieces = F.when(F.col("line_type") == "table_row", segments).otherwise(F.array(piece(none, none, none)))
    fields = ("raw", "line_type", "confidence", "detected_label", "issue", "plain")
    both = classified.select("doc_id", F.col("line_number").alias("parent_line_number"), "page_number", F.struct(*fields).alias("_line"), F.explode(pieces).alias("_piece")).select("*", "_piece.*").drop("_piece")
    both = classify(both, "segment", page_markers=False, table_rows=False).drop("page_mark").withColumnRenamed("segment", "raw")
    both = both.withColumns({c: F.when(F.col("cell_index").isNull(), F.col("_line")[c]).otherwise(F.col(c)) for c in fields}).drop("_line")
    order = W.partitionBy("doc_id").orderBy("parent_line_number", "cell_index", "segment_index")
    kind = F.when(F.col("cell_index").isNull(), "raw_line").otherwise("table_cell_segment")
    return both.withColumn("line_number", F.row_number().over(order)).withColumn("source_kind", kind)


def document_gate(classified: DataFrame, content: DataFrame) -> DataFrame:
    """Counts by document, and failure of long documents in which no question begins."""
    of = lambda *kinds: F.count_if(F.col("line_type").isin(*kinds))
    by_line = classified.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("total_lines"),
        of("question_anchor").alias("question_anchors"),
        of("option_candidate").alias("options"),
        of("solution_anchor", "solution_section_heading").alias("solution_anchors"),
        of("image_reference").alias("images"),
        of("table_row").alias("table_rows"),
        F.count_distinct(F.when(F.col("line_type") == "page_number_marker", F.col("page_number"))).alias("pages"),
    )
    by_content = content.groupBy("doc_id").agg(F.count(F.lit(1)).alias("content_lines"), of("question_anchor").alias("content_anchors"), of("option_candidate").alias("content_options"))
    failed = (F.col("total_lines") > GATE_LINES) & (F.coalesce("content_anchors", F.lit(0)) == 0)
    return by_line.join(by_content, "doc_id", "left").withColumn("status", F.when(failed, "failed").otherwise("succeeded"))
