"""Answers and solutions: collected after the solution heading, reduced to one a number, joined to questions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliate.functions import patterns as P
from foliate.functions import text as T

LOW_ANSWER = 0.8
COMPACT_CONFIDENCE, SOLUTION_CONFIDENCE = 0.75, 0.9
#: Fixed value: a solution anchor anywhere in a line.  CUT marks where lines are cut at it.
FIND_ANCHOR = r"(?i)(?:\*{1,2})?(?:#{1,6}\s*)?(?:\*{1,2})?S\s*(\d+)\s*[\.\):\-]"
CUT = "\x01"


def solution_lines(content: DataFrame) -> DataFrame:
    """Lines from the solution heading on; all lines where a document has none."""
    whole = W.partitionBy("doc_id")
    heading = (F.col("line_type") == "solution_section_heading") | T.has(F.col("plain"), P.MAPPED_HEADING)
    marked = content.withColumn("solution_start", F.min(F.when(heading, F.col("line_number"))).over(whole))
    return marked.where(F.col("solution_start").isNull() | (F.col("line_number") >= F.col("solution_start")))


def solutions(content: DataFrame) -> DataFrame:
    """One row a solution: from its anchor, which may stand inside a line, to the next anchor.

    Each line is cut at its anchors; the first piece belongs to the solution before it.
    """
    lines = solution_lines(content)
    pieces = F.split(F.regexp_replace("raw", "(" + T.uni(FIND_ANCHOR) + ")", CUT + "$1"), CUT, -1)
    cut = lines.select("doc_id", "line_number", "page_number", "line_type", F.posexplode_outer(pieces).alias("part", "piece"))
    number = F.when(T.has(F.col("piece"), "^(?:" + FIND_ANCHOR + ")"), T.part(F.col("piece"), "^(?:" + FIND_ANCHOR + ")").cast("int"))
    order = W.partitionBy("doc_id").orderBy("line_number", "part")
    cut = cut.withColumn("number", number).withColumn("sol", F.count("number").over(order.rowsBetween(W.unboundedPreceding, 0))).where("sol > 0")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("piece") != "", F.struct("line_number", "part", "piece")))), lambda x: x["piece"]), "\n")
    return cut.groupBy("doc_id", "sol").agg(F.max("number").alias("question_number"), text.alias("raw_text"), F.min("line_number").alias("start_line"), F.max(F.when(F.col("piece") != "", F.col("line_number"))).alias("end_line"), F.min("page_number").alias("page_start"), F.max("page_number").alias("page_end"))


def with_answer(df: DataFrame, *texts: str) -> DataFrame:
    """Add number, key and sure of the first form of answer in the first of ``texts`` that has one; rows without go."""
    forms = [(t, p, c) for t in texts for p, c in P.ANSWER_FORMS]
    case = lambda value, on: reduce(lambda found, x: found.when(on(x[0]), value(*x[1])), list(enumerate(forms))[1:], F.when(on(0), value(*forms[0])))
    which = reduce(lambda found, x: found.when(T.has(F.col(x[1][0]), x[1][1]), x[0]), list(enumerate(forms))[1:], F.when(T.has(F.col(forms[0][0]), forms[0][1]), 0))
    by_form = df.withColumn("form", which).where("form is not null")
    at = lambda n: F.col("form") == n
    return by_form.withColumns({"number": case(lambda t, p, c: T.part(F.col(t), p), at).cast("int"), "key": F.upper(case(lambda t, p, c: T.part(F.col(t), p, 2), at)), "sure": case(lambda t, p, c: F.lit(c), at)}).drop("form")


def answers(content: DataFrame, sols: DataFrame) -> DataFrame:
    """All answers: rows of compact keys (runs of at least two) and those inside solutions."""
    lines = solution_lines(content)
    order = W.partitionBy("doc_id").orderBy("line_number")
    compact = T.has(F.col("plain"), P.COMPACT_KEY)
    runs = lines.withColumn("island", F.sum(F.when(compact, 0).otherwise(1)).over(order.rowsBetween(W.unboundedPreceding, 0))).where(compact)
    runs = runs.withColumn("length", F.count(F.lit(1)).over(W.partitionBy("doc_id", "island"))).where("length >= 2")
    keyed = runs.select("doc_id", T.part(F.col("plain"), P.COMPACT_KEY).cast("int").alias("question_number"), F.upper(T.part(F.col("plain"), P.COMPACT_KEY, 2)).alias("answer_key"), F.lit(COMPACT_CONFIDENCE).alias("confidence"), F.col("line_number").alias("source_line"))
    first = content.select("doc_id", F.col("line_number").alias("start_line"), "plain")
    inside = with_answer(sols.join(first, ["doc_id", "start_line"]).withColumn("whole", T.target(F.col("raw_text"))), "plain", "whole")
    inside = inside.select("doc_id", F.col("number").alias("question_number"), F.col("key").alias("answer_key"), F.col("sure").alias("confidence"), F.col("start_line").alias("source_line"))
    return keyed.unionByName(inside)


def best_answers(found: DataFrame) -> DataFrame:
    """One answer a number: none where keys differ, else the surest, the earliest of these."""
    keep = F.max_by(F.struct("answer_key", "confidence", "source_line"), F.struct("confidence", -F.col("source_line")))
    by = found.groupBy("doc_id", "question_number").agg(F.count_distinct("answer_key").alias("keys"), keep.alias("best"))
    conflict = F.col("keys") > 1
    return by.select("doc_id", "question_number", conflict.alias("conflict"), F.when(~conflict, F.col("best.answer_key")).alias("answer_key"), F.when(~conflict, F.col("best.confidence")).alias("answer_confidence"), F.when(~conflict, F.col("best.source_line")).alias("answer_line"))


def own_key(sols: DataFrame) -> DataFrame:
    """Add own_key: the answer that a solution's text gives for the solution's own number."""
    whole = T.target(F.col("raw_text"))
    forms = [F.when(T.has(whole, p), F.struct(T.part(whole, p).cast("int").alias("number"), F.upper(T.part(whole, p, 2)).alias("key"))) for p, _ in P.ANSWER_FORMS]
    found = F.coalesce(*forms)
    return sols.withColumn("own_key", F.when(found["number"] == F.col("question_number"), found["key"]))


def best_solutions(sols: DataFrame) -> DataFrame:
    """The first solution of each number, how many there are, and whether their answers and texts are the same."""
    return own_key(sols).groupBy("doc_id", "question_number").agg(
        F.min_by(F.struct("raw_text", "start_line", "end_line"), "start_line").alias("solution"),
        F.count(F.lit(1)).alias("solutions"),
        (F.count_distinct(F.coalesce("own_key", F.lit(""))) <= 1).alias("answers_identical"),
        (F.count_distinct(F.coalesce(F.sha2("raw_text", 256), F.lit(""))) <= 1).alias("texts_identical"),
    )


def duplicate_solutions(sols: DataFrame) -> DataFrame:
    """Numbers with several solutions, and what is to be done about them: identical ones are harmless, others a conflict."""
    same = F.col("answers_identical") & F.col("texts_identical")
    decision = F.when(same, "harmless_duplicate_same_text").otherwise("duplicate_conflict")
    return best_solutions(sols).where("question_number is not null and solutions > 1").select("doc_id", "question_number", "solutions", "answers_identical", "texts_identical", F.col("solution.start_line").alias("chosen_line"), decision.alias("safety_decision"))


def mappings(cands: DataFrame, found: DataFrame, sols: DataFrame) -> DataFrame:
    """Each candidate with its answer, solution and mapping status."""
    twice = F.count(F.lit(1)).over(W.partitionBy("doc_id", "question_number")) > 1
    base = cands.select("doc_id", "seq", "question_id", "question_number", "confidence", F.col("issues").alias("own")).withColumn("duplicate", F.col("question_number").isNotNull() & twice)
    joined = base.join(best_answers(found), ["doc_id", "question_number"], "left").join(best_solutions(sols), ["doc_id", "question_number"], "left")
    conflict = F.coalesce("conflict", F.lit(False))
    answer, solution = F.col("answer_key").isNotNull(), F.col("solution").isNotNull()
    low = answer & (F.col("answer_confidence") < LOW_ANSWER)
    status = (
        F.when(conflict | F.col("duplicate"), "duplicate_conflict")
        .when(~answer & ~solution, "not_available")
        .when(low, "needs_review")
        .when(answer & solution, "mapped")
        .when(answer, "answer_only_mapped")
        .otherwise("solution_only_mapped")
    )
    extra = F.array_compact(F.array(F.when(conflict, F.lit("conflicting_answer_keys")), F.when(F.col("duplicate"), F.lit("duplicate_question_candidate_number")), F.when(low, F.lit("low_confidence_answer"))))
    total = F.coalesce("answer_confidence", F.lit(0.0)) + F.when(solution, SOLUTION_CONFIDENCE).otherwise(0.0) + F.col("confidence")
    share = total / (F.lit(1) + answer.cast("int") + solution.cast("int"))
    return joined.select("doc_id", "seq", "question_id", "question_number", "answer_key", "answer_confidence", "answer_line", "solution", F.coalesce("solutions", F.lit(0)).alias("solutions"), F.coalesce(~(F.col("answers_identical") & F.col("texts_identical")), F.lit(False)).alias("solution_conflict"), status.alias("mapping_status"), share.alias("mapping_confidence"), F.array_sort(F.array_distinct(F.concat("own", extra))).alias("mapping_issues"))


def unmatched_solutions(cands: DataFrame, sols: DataFrame) -> DataFrame:
    """Numbers of solutions without a candidate."""
    return sols.select("doc_id", "question_number").distinct().join(cands.select("doc_id", "question_number").distinct(), ["doc_id", "question_number"], "left_anti")
