"""Sections, anchors and windows on small documents with known results."""

import pytest
from pyspark.sql import functions as F

from foliate.functions import anchors as A
from foliate.functions import patterns as P
from foliate.functions import text as T
from foliate.operators import mapping as M
from foliate.operators import sections as S


def table(spark, *docs):
    rows = [(d, i + 1, text, 1) for d, lines in enumerate(docs, 1) for i, text in enumerate(lines)]
    return spark.createDataFrame(rows, "doc_id long, line_number int, raw string, page_number int")


def says(spark, predicate, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, raw string")
    return [r[0] for r in df.orderBy("i").select(F.expr(predicate(A.Spark, "raw"))).collect()]


def test_heading_is_confirmed_by_solutions(spark):
    lines = table(
        spark,
        ["1. Question text", "### **explanatIons**", "**1.** (*c*) Let x be"],
        ["1. Question text", "no heading here"],
        ["Solutions", "text", "Answer Key", "1. (a) because"],
        ["# General Awareness: answers", "Detailed Solutions", "x"],
    )
    got = {r.doc_id: (r.detected, r.heading_line, r.section_type, r.confidence, r.question_lines, r.solution_lines) for r in S.section_split(lines).collect()}
    assert got[1] == (True, 2, "explanation_section", 0.95, 1, 1)
    assert got[2] == (False, None, "question_section", 0.0, 2, 0)
    assert got[3] == (True, 3, "answer_key_section", 0.95, 2, 1)
    assert got[4] == (True, 2, "solution_section", 0.5, 1, 1)


def test_no_window_begins_among_the_solutions(spark):
    lines = table(spark, ["1. What is the value of x?", "1. 10", "2. 20", "3. 30", "4. 40", "### explanations", "**1.** (*c*) Let x be 3", "**2.** (*a*) Then"])
    got = S.windows(lines, S.selected_anchors(lines)).collect()
    # no anchor below the heading counts; the last window reaches to the end, so the labels of its solutions do
    assert [(r.question_number, r.start_line, r.status, r.options_found) for r in got] == [(1, 1, "ready", 6)]
    sols = {r.question_number: (r.answer_label, r.start_line, r.end_line) for r in S.solution_windows(lines).collect()}
    assert sols == {1: ("C", 7, 7), 2: ("A", 8, 8)}


def test_best_anchor_of_a_number(spark):
    far = ["filler"] * 6
    lines = table(
        spark,
        ["1. Short stem here", *far, "Q1. A much longer text of the same question", "(a) x", "2. Next question text"],
        ["1. First question of the paper", *far, "Answer Key", "1. (b) x", "2. Select the right one of these", "7. B | 8. C"],
    )
    got = {(r.doc_id, r.number): r.line_number for r in S.selected_anchors(lines).collect()}
    assert got == {(1, 1): 8, (1, 2): 10, (2, 1): 1, (2, 2): 10}


def test_few_anchors_ignore_the_heading(spark):
    lines = table(spark, ["1. First question text", "Solutions", "2. Second question text", "3. Third question text", "4. Fourth question text"])
    expected = spark.createDataFrame([(1, 4)], "doc_id long, expected_count int")
    assert [r.number for r in S.selected_anchors(lines).collect()] == [1]
    assert sorted(r.number for r in S.selected_anchors(lines, expected).collect()) == [1, 2, 3, 4]
    assert [r.number for r in S.selected_anchors(lines, expected.withColumn("expected_count", F.lit(1))).collect()] == [1]


def test_repeats_close_to_an_anchor_are_passed_over(spark):
    lines = table(spark, [f"5. The same question again, line {i}" if i in (0, 4, 8, 20, 22) else "other" for i in range(24)])
    assert sorted(r.line_number - 1 for r in S.question_anchors(lines).collect()) == [0, 8, 20]


@pytest.mark.parametrize(
    "predicate, yes, no",
    [
        (A.starts_solution, ["1. (a) x", "**12.** (*c*) Let", "Q3) Ans: B. so", "7. Answer: D", "- 4. B) done"], ["1. What is x", "(a) 1.", "", "Answer: B"]),
        (A.is_key_row, ["12. B", "1. A 2. B", "3. C | x", " 9 . d. "], ["1. A question about B", "", "2/3. A", "12. Be it so"]),
        (A.is_key_anchor, ["12. B", "Q5) C", "7. D | rest", "| 3. B | x |"], ["12. Because", "7.", "some text"]),
        (A.is_anchor, ["1. What is the value?", "Q.12 Find x", "| **3.** Which one is it", "4)Determine x from it"], ["1. 5", "(a) option", "2. Paris", "12. B", "1. (a) a solution", "3. Options shown in green are correct", "", "4)12345678"]),
        (A.is_noise, ["Free  Mock tests", "see www.site.org", "Exam Covered"], ["a question", ""]),
        (A.is_option_line, ["(a) x", "1. 5", "- B. text", "Ans 2"], ["plain", "(e)"]),
        (A.is_status_line, ["Status : Answered", "Question ID : 7"], ["state", ""]),
        (A.heads_solutions, ["Solutions:", "**Answer Key**", "## Answers with Explanations", "A n s w e r s"], ["Index of solutions", "Solutions are here", "", "Download PDF solutions"]),
    ],
)
def test_predicates(spark, predicate, yes, no):
    assert says(spark, predicate, yes) == [True] * len(yes)
    assert says(spark, predicate, no) == [False] * len(no)


def test_identical_duplicates_are_harmless(spark):
    sols = spark.createDataFrame(
        [(1, 1, 3, "S3. Ans(a) text", 10, 10), (1, 2, 3, "S3. Ans(a) text", 11, 11), (1, 3, 4, "S4. Ans(a) x", 12, 12), (1, 4, 4, "S4. Ans(b) x", 13, 13), (1, 5, 5, "S5. one", 14, 14), (1, 6, 5, "S5. two", 15, 15), (1, 7, 6, "S6. alone", 16, 16)],
        "doc_id long, sol long, question_number int, raw_text string, start_line int, end_line int",
    )
    got = {r.question_number: (r.answers_identical, r.texts_identical, r.safety_decision, r.chosen_line) for r in M.duplicate_solutions(sols).collect()}
    assert got == {3: (True, True, "harmless_duplicate_same_text", 10), 4: (False, False, "duplicate_conflict", 12), 5: (True, False, "duplicate_conflict", 14)}


def test_strip_removes_what_the_pattern_of_white_space_does(spark):
    chars = [chr(c) for c in range(1, 0x10000) if not 0xD800 <= c <= 0xDFFF]
    df = spark.createDataFrame([(f"{c}a{c}b{c}",) for c in chars] + [("",), (" \n\t ",), (None,)], "t string")
    by_pattern = F.regexp_replace("t", r"(?U)^\s+|\s+$", "")
    assert df.where(~T.strip(F.col("t")).eqNullSafe(by_pattern) | ~F.expr(A.stripped(A.Spark, "t")).eqNullSafe(by_pattern)).count() == 0


def test_guards_let_every_line_pass_for_which_their_predicates_hold(spark):
    marks = ["", " ", "|", "| ", "||| ", "- ", "* ", "**", "- **", "•  ", "_#", " "]
    bodies = ["12. of what colour is it", "Q.3) (a) so", "q 7", "3 . B", "Q 12", "12.  Ans. (c) x", "Solutions", "A n s w e r s", "answer key:", "Explanations", "# detailed solutions", "no", "1) | 2. C | 3. D", "so", "a 9. A"]
    df = spark.createDataFrame([(m + b + e,) for m in marks for b in bodies for e in ("", " ", "** ", "|")], "raw string")
    for predicate in S._GUARDS:
        plain = F.expr(predicate(A.Spark, "raw"))
        assert df.where(~S._is(predicate).eqNullSafe(plain)).count() == 0
        assert df.where(plain).count() > 0


def test_inner_guards_let_every_line_pass_for_which_their_predicates_hold(spark):
    marks = ["", "x ", "x", "1 ", ">", "-  ", "( "]
    bodies = ["Free  Mock", "download pdf", "www.x", "Subſcribe now", "PREVİOUS paper", "prevıous papers", "all  exams", "one subscription", "personaliſed report", "unlimited re-attempt", "exam covered", "refund", "mock test",
              "3 . x", "12) y", "(b) z", "(*c*)z", "(*D) z", "a.  b", "anſ 4", "ans   4", "ANS4", "status :", "ſtatuſ:", "Question  ID", "question", "plain words", ""]
    df = spark.createDataFrame([(m + b + e,) for m in marks for b in bodies for e in ("", " q", ".")] + [(None,)], "raw string")
    for predicate in S._INNER_GUARDS:
        plain = F.expr(predicate(A.Spark, "raw"))
        assert df.where(~S._is(predicate).eqNullSafe(plain)).count() == 0
        assert df.where(plain).count() > 0
    labels = [f"regexp_extract_all(raw, r'(?U){p}', 1)" for p in P.WINDOW_LABELS]
    assert df.where(~F.expr(A.option_labels(A.Spark, "raw")).eqNullSafe(F.expr(f"transform(concat({', '.join(labels)}), x -> upper(x))")) & F.col("raw").isNotNull()).count() == 0
    assert df.where(T.has(F.col("raw"), P.OPTION_NOISE) & ~T.has(F.col("raw"), P.NOISE_GUARD)).count() == 0


def test_anchors_are_found_by_one_look_at_each_line(spark):
    """In a filter each pattern would stand once more for every use of what it is part of."""
    lines = spark.createDataFrame([(1, 1, "1. of what colour is it")], "doc_id long, line_number int, raw string")
    plan = S.question_anchors(lines)._jdf.queryExecution().optimizedPlan()
    assert not [f for f in plan.toString().split("\n") if "Filter" in f and P.ANCHOR_INSTRUCTION in f]


def test_anchors_ask_each_line_once(spark):
    lines = table(spark, ["1. What is the first question?", "x", "1. What is close to it?", "3. A third question here", "a", "b", "1. What is far from it?"])
    got = S.question_anchors(lines)
    assert sorted((r.number, r.line_number, r.raw[:12]) for r in got.collect()) == [(1, 1, "1. What is t"), (1, 7, "1. What is f"), (3, 4, "3. A third q")]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("LocalRelation") + got._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def test_guards_hold_where_their_predicates_do(spark):
    texts = ["1. one", "(a) x", "(*b*) y", "- c. z", "x a. b", "plain words", "Choſen  Option : 2", "1 ) x"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, raw string")
    asked = df.select("raw", T.has(F.col("raw"), P.LABEL_GUARD).alias("guard"), F.expr(A.option_labels(A.Spark, "raw")).alias("labels"), T.has(F.col("raw"), P.CHOSEN_GUARD).alias("chosen")).collect()
    assert [r.raw for r in asked if r.labels and not r.guard] == [] and sum(r.guard for r in asked) == 6
    assert [r.raw for r in asked if r.chosen] == ["Choſen  Option : 2"]


def test_parts_of_predicates_are_computed_once():
    # a text stripped for every use made a line with a number take 0.2 ms
    assert A.is_anchor(A.Spark, "raw").count("regexp_count") <= 3
    assert A.is_anchor(A.Spark, "raw").count("btrim") <= 10
    assert A.is_key_row(A.Spark, "raw").count("regexp_count") == 1
    assert A.heads_solutions(A.Spark, "raw").count("btrim") == 1


def test_key_rows_have_what_guards_ask(spark):
    texts = ["12. B", "1 .A 2\t.  b", "3. C | x", " 9 . d. ", "x.B", "word. Be", "١. A ٢. B", "12.\u00a0B", "", "1 . 2 . c", "1/2. A"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, raw string").orderBy("i")
    got = df.select(S._is(A.is_key_row).alias("guarded"), F.expr(A.is_key_row(A.Spark, "raw")).alias("asked"), T.is_answer_key_line(F.col("raw")).alias("line")).collect()
    assert [r.guarded for r in got] == [r.asked for r in got] == [r.line for r in got]
    assert [r.line for r in got][:6] == [True, True, True, True, False, False]
