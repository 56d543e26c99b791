"""Sections of a document's evidence, ranked question windows and solution windows.

Input are lines (doc_id, line_number, raw and more); everything is windowed or
grouped by document, so a document's lines are shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliate.functions import anchors as A
from foliate.functions import markers
from foliate.functions import patterns as P
from foliate.functions import text as T
from foliate.operators.evidence import accepted

SURE, UNSURE = 0.95, 0.5
AHEAD = 7  # lines after a heading that may confirm it
DISTANCE = 5  # lines between two anchors of one number
LEAST_SHARE = 0.7  # of the expected questions; with fewer, headings are ignored
FOUR = 4


#: Patterns that a line has if a predicate holds for it; they keep the dear ones off most lines.
_GUARDS = {A.heads_solutions: P.HEADING_GUARD, A.starts_solution: P.START_GUARD, A.is_anchor: P.ANCHOR_GUARD, A.is_key_row: P.KEY_ROW_GUARD, A.is_key_anchor: P.DIGIT}
#: The same for predicates that look for words anywhere.
_INNER_GUARDS = {A.is_noise: P.NOISE_GUARD, A.is_solution_noise: P.NOISE_GUARD, A.is_option_line: P.OPTION_GUARD, A.is_status_line: P.STATUS_GUARD}


def _is(predicate, column: str = "raw") -> Column:
    asked = predicate(A.Spark, column)
    guard = _GUARDS.get(predicate) or _INNER_GUARDS.get(predicate)
    return F.expr(A.guarded(column, guard, asked) if guard else asked)


def headings(lines: DataFrame) -> DataFrame:
    """(doc_id, heading_line, section_type, confidence): each document's surest solution heading, the last of these.

    A heading is sure if one of the lines after it begins a solution.
    """
    order = W.partitionBy("doc_id").orderBy("line_number")
    marked = lines.select("doc_id", "line_number", "raw", _is(A.heads_solutions).alias("heads"), _is(A.starts_solution).alias("starts"))
    sure = F.max("starts").over(order.rowsBetween(1, AHEAD))
    found = marked.withColumn("confidence", F.when(sure, SURE).otherwise(UNSURE)).where("heads")
    best = found.groupBy("doc_id").agg(F.max_by(F.struct("line_number", "raw", "confidence"), F.struct("confidence", "line_number")).alias("best"))
    bare = T.strip(F.col("best.raw"))
    kind = F.when(T.has(bare, P.SECTION_KEY), "answer_key_section").when(F.lower(bare).contains("explanation"), "explanation_section").otherwise("solution_section")
    return best.select("doc_id", F.col("best.line_number").alias("heading_line"), kind.alias("section_type"), F.col("best.confidence").alias("confidence"))


def section_split(lines: DataFrame) -> DataFrame:
    """Where each document's solutions begin, and how many lines stand before and after the heading."""
    sizes = lines.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    heading = F.col("heading_line")
    return sizes.join(headings(lines), "doc_id", "left").select(
        "doc_id",
        heading.isNotNull().alias("detected"),
        "heading_line",
        F.coalesce("section_type", F.lit("question_section")).alias("section_type"),
        F.coalesce("confidence", F.lit(0.0)).alias("confidence"),
        F.when(heading.isNull(), F.col("n")).otherwise(heading - 1).cast("long").alias("question_lines"),
        F.when(heading.isNull(), 0).otherwise(F.col("n") - heading).cast("long").alias("solution_lines"),
    )


def question_anchors(lines: DataFrame) -> DataFrame:
    """(doc_id, line_number, number, raw): lines at which a question begins, repeats of a number close to an accepted one left out."""
    # a filter on the number would be pushed below the projection and evaluate each pattern again, a generator's rows are not
    number = F.when(_is(A.is_anchor), F.when(~_is(A.is_noise), F.array_compact(F.array(_is(A.anchor_number)))))
    found = lines.select("doc_id", "line_number", "raw", F.explode(number).alias("number"))
    # the lines go with their numbers, so that no line is asked again for a join
    places = found.groupBy("doc_id", "number").agg(F.array_sort(F.collect_list(F.struct("line_number", "raw"))).alias("places"))
    kept = places.select("doc_id", "number", F.explode(accepted(F.col("places"), DISTANCE, lambda x: x["line_number"])).alias("x"))
    return kept.select("doc_id", "number", "x.line_number", "x.raw")


def selected_anchors(lines: DataFrame, expected: DataFrame | None = None, anchors: DataFrame | None = None) -> DataFrame:
    """(doc_id, number, line_number): the best-ranked anchor of each number before the solutions.

    After the heading of a mere answer key, anchors that are surely questions count
    too.  ``expected`` (doc_id, expected_count) lets a document with too few anchors
    ignore its heading, if that gives more.  ``anchors`` are the :func:`question_anchors` of the lines,
    found here if not given; read from a stored table, they keep the patterns of both steps
    out of one stage, whose generated code would be too large.
    """
    heads = headings(lines)
    found = (question_anchors(lines) if anchors is None else anchors).where(~_is(A.starts_solution) & ~_is(A.is_key_anchor)).join(heads, "doc_id", "left")
    after = F.coalesce(F.col("line_number") >= F.col("heading_line"), F.lit(False))
    early = ~after | ((F.col("section_type") == "answer_key_section") & _is(A.goes_on))
    ranked = found.select("doc_id", "number", "line_number", early.alias("early"), (_is(A.anchor_rank) - F.when(after, 10000).otherwise(0)).alias("rank"))
    first = F.struct(F.col("rank"), -F.col("line_number"))
    best = ranked.groupBy("doc_id", "number").agg(F.max_by("line_number", first).alias("any"), F.max_by(F.when(F.col("early"), F.col("line_number")), F.when(F.col("early"), first)).alias("strict"))
    if expected is None:
        return best.where("strict is not null").select("doc_id", "number", F.col("strict").alias("line_number"))
    counts = best.groupBy("doc_id").agg(F.count("strict").alias("n_strict"), F.count("any").alias("n_any")).join(expected, "doc_id", "left")
    few = (F.col("n_strict") < F.floor(F.col("expected_count") * F.lit(LEAST_SHARE))) & (F.col("n_any") > F.col("n_strict"))
    chosen = best.join(counts.select("doc_id", F.coalesce(few, F.lit(False)).alias("fallback")), "doc_id")
    return chosen.select("doc_id", "number", F.when(F.col("fallback"), F.col("any")).otherwise(F.col("strict")).alias("line_number"), "fallback").where("line_number is not null")


def windows(lines: DataFrame, anchored: DataFrame) -> DataFrame:
    """One row a question: its lines from its anchor to the next, without rows of answer keys, and what is among them."""
    marked = lines.select("doc_id", "line_number", "raw").join(anchored.select("doc_id", "number", "line_number"), ["doc_id", "line_number"], "left")
    order = W.partitionBy("doc_id").orderBy("line_number").rowsBetween(W.unboundedPreceding, 0)
    placed = marked.withColumn("window", F.count("number").over(order)).where("window > 0").withColumn("key_row", _is(A.is_key_row))
    own = ~F.col("key_row")
    # whether a line is noise is asked last, of the few that count otherwise
    calm = lambda holds: F.when(own & holds, ~_is(A.is_noise))
    labels = F.when(own, _is(A.option_labels))
    chosen = T.has(F.col("raw"), P.CHOSEN_GUARD) & markers.is_chosen_metadata(F.col("raw"))
    by = placed.groupBy("doc_id", "window").agg(
        F.max("number").alias("question_number"),
        F.min("line_number").alias("start_line"),
        F.max(F.when(own, F.col("line_number"))).alias("end_line"),
        F.array_sort(F.collect_list(F.when(own, F.col("line_number")))).alias("line_numbers"),
        F.size(F.array_distinct(F.flatten(F.collect_list(labels)))).alias("options_found"),
        F.count_if(calm(_is(A.is_option_line))).alias("option_lines"),
        F.count_if(calm(chosen)).alias("chosen_lines"),
        F.count_if(calm(_is(A.is_status_line))).alias("status_lines"),
    )
    ready = F.col("options_found") >= FOUR
    return by.withColumns({"window_id": F.format_string("qw_%04d", "window"), "status": F.when(ready, "ready").otherwise("incomplete_options"), "confidence": F.when(ready, 0.8).otherwise(0.4)}).drop("window")


def solution_windows(lines: DataFrame) -> DataFrame:
    """One row a number: the solution that begins at a numbered line with an answer label, after the heading.

    Of several with one number the surest stays, the first of these.
    """
    after = lines.join(headings(lines).select("doc_id", "heading_line"), "doc_id").where(F.col("line_number") > F.col("heading_line"))
    label, number, calm = _is(A.solution_label), _is(A.solution_number), ~_is(A.is_solution_noise)
    starts = _is(A.starts_solution) & calm & number.isNotNull() & label.isNotNull()
    order = W.partitionBy("doc_id").orderBy("line_number").rowsBetween(W.unboundedPreceding, 0)
    placed = after.withColumns({"number": F.when(starts, number), "label": F.when(starts, label)}).withColumn("order", F.count("number").over(order)).where("order > 0")
    by = placed.groupBy("doc_id", "order").agg(
        F.max("number").alias("question_number"),
        F.max("label").alias("answer_label"),
        F.min("line_number").alias("start_line"),
        F.max("line_number").alias("end_line"),
        F.count_if(calm).alias("n_lines"),
        F.min(F.when(calm, F.col("page_number"))).alias("page_start"),
        F.max(F.when(calm, F.col("page_number"))).alias("page_end"),
    )
    first = by.groupBy("doc_id", "question_number").agg(F.min_by(F.struct("order", "answer_label", "start_line", "end_line", "n_lines", "page_start", "page_end"), "order").alias("w"))
    return first.select("doc_id", "question_number", F.format_string("sol_%04d", "w.order").alias("solution_window_id"), *(F.col(f"w.{c}").alias(c) for c in ("answer_label", "start_line", "end_line", "n_lines", "page_start", "page_end")))


def line_signals(lines: DataFrame) -> DataFrame:
    """What each line may be, for routing and review: a flag for every predicate."""
    flags = {"heads_solutions": A.heads_solutions, "starts_solution": A.starts_solution, "key_row": A.is_key_row, "key_anchor": A.is_key_anchor, "instruction": A.is_instruction, "anchor": A.is_anchor, "noise": A.is_noise, "option_line": A.is_option_line, "status_line": A.is_status_line}
    return lines.select("doc_id", "line_number", *(_is(p).alias(name) for name, p in flags.items()))
