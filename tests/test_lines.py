"""Small documents with known results."""

from pyspark.sql import functions as F

from foliate.functions import patterns as P
from foliate.functions import text as T
from foliate.operators import lines as L
from foliate.operators import mapping as M
from foliate.operators import segment as S
from foliate.plans.lineage import durable


def of(spark, *texts, doc=1):
    rows = [(doc, i + 1, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, line_number int, raw string")


def kinds(spark, *texts):
    return [(r.line_type, r.detected_label) for r in L.classified_lines(of(spark, *texts)).orderBy("line_number").collect()]


LINE_TYPES = [
    ("", "blank", None),
    ("  \t", "blank", None),
    ("<!-- PageNumber: 12 -->", "page_number_marker", "12"),
    ("{PAGE_NUMBER: 3}", "page_number_marker", "3"),
    ("<!-- pagebreak -->", "page_break_marker", None),
    ("![fig](a.png)", "image_reference", None),
    ("$$x^2", "math_block", None),
    ("| a | b |", "table_row", None),
    ("### Answer Key", "solution_section_heading", None),
    ("Q1. What is 2+2?", "question_anchor", "Q1"),
    ("**Que. 7** Which one", "question_anchor", "Q7"),
    ("12) Find the value", "question_anchor", "Q12"),
    ("12. B", "text", None),
    ("12. abc", "text", None),
    ("S4. Ans(c) Since", "solution_anchor", "S4"),
    ("## Part one", "heading", None),
    ("Ans. (b)", "answer_marker", "b"),
    ("- **(c)** five", "option_candidate", "C"),
    ("d) six", "option_candidate", "D"),
    ("A. seven", "option_candidate", "A"),
    ("A. x = 1", "text", None),
    ("Visit us at www.example.org", "page_footer_marker", None),
    ("Subject: Maths", "metadata_candidate", None),
    ("१. यह क्या है भाई", "question_anchor", "Q१"),
    ("just words", "text", None),
]


def test_line_types(spark):
    assert kinds(spark, *(x[0] for x in LINE_TYPES)) == [x[1:] for x in LINE_TYPES]


def test_pages_are_carried_forward(spark):
    out = L.classified_lines(of(spark, "a", "<!-- PageNumber: 2 -->", "b", "<!-- PageNumber: 3 -->", "c")).orderBy("line_number")
    assert [r.page_number for r in out.collect()] == [None, 2, 2, 3, 3]


def test_cells_and_breaks(spark):
    out = L.content_lines(L.classified_lines(of(spark, "| A | B |", "| Q1.<br>Question?<br>(a) A | --- | |", "end"))).orderBy("line_number")
    assert [(r.raw, r.cell_index, r.segment_index, r.parent_line_number) for r in out.collect()] == [
        ("A", 0, 0, 1), ("B", 1, 0, 1), ("Q1.", 0, 0, 2), ("Question?", 0, 1, 2), ("(a) A", 0, 2, 2), ("end", None, None, 3),
    ]


def test_blocks_group_lines_of_a_type(spark):
    out = L.blocks(L.classified_lines(of(spark, "one", "", "two", "Q1. What is it?", "Q2. What is that?", "(a) x", "(b) y"))).orderBy("start_line")
    assert [(r.block_type, r.start_line, r.end_line) for r in out.collect()] == [
        ("text_block", 1, 3), ("question_candidate_block", 4, 4), ("question_candidate_block", 5, 5), ("option_candidate_block", 6, 7),
    ]


def content_of(spark, *texts):
    return durable(L.content_lines(durable(L.classified_lines(of(spark, *texts)))))


def candidates(spark, *texts):
    return S.candidates(content_of(spark, *texts)).orderBy("seq").collect()


def test_one_question_with_four_options(spark):
    [c] = candidates(spark, "Q1. What is 2+2?", "(a) 3", "(b) 4", "(c) 5", "(d) 6")
    assert (c.question_number, c.review_status, c.question_text_raw) == (1, "candidate_valid", "Q1. What is 2+2?")
    assert [(o.key, o.key_raw, o.text) for o in c.options] == [("A", "(a)", "3"), ("B", "(b)", "4"), ("C", "(c)", "5"), ("D", "(d)", "6")]


def test_options_continue_split_and_stop(spark):
    [c] = candidates(spark, "Q1. What is it?", "(a) one", "more", "(b) two (c) three", "## head", "lost", "(d) four")
    assert [(o.key, o.text) for o in c.options] == [("A", "one\nmore"), ("B", "two"), ("C", "three"), ("D", "four")]
    assert c.issues == ["same_line_option_split_applied"]


def test_duplicates_and_missing_options(spark):
    got = candidates(spark, "Q1. What is it?", "(a) x", "Q1. Again what?", "Q3. And then?", "### Solutions", "Q9. not one")
    assert [(c.question_number, c.review_status) for c in got] == [(1, "candidate_valid"), (1, "candidate_duplicate"), (3, "candidate_incomplete")]


def test_image_belongs_to_an_empty_option(spark):
    [c] = candidates(spark, "Q1. What is it?", "(a)", "![x](p.png)", "(b) two", "(c) three", "(d) four", "![y](q.png)")
    assert [o.linked for o in c.options] == [True, False, False, False]
    assert c.assets == 2 and c.noise_assets == 1 and "possible_noise_asset_after_options" in c.issues


def test_answers_solutions_and_conflicts(spark):
    content = content_of(spark, "Q1. What is it?", "(a) x", "Q2. What was it?", "### Solutions", "S1. Ans(a) so S4. none", "more", "S2. Ans(b)", "S2) Answer: C")
    sols = M.solutions(content)
    assert sorted((r.question_number, r.raw_text) for r in sols.collect()) == [(1, "S1. Ans(a) so "), (2, "S2) Answer: C"), (2, "S2. Ans(b)"), (4, "S4. none\nmore")]
    maps = M.mappings(S.candidates(content), M.answers(content, sols), sols).orderBy("seq").collect()
    assert [(m.answer_key, m.mapping_status) for m in maps] == [("A", "mapped"), (None, "duplicate_conflict")]
    assert [r.question_number for r in M.unmatched_solutions(S.candidates(content), sols).collect()] == [4]


def test_compact_keys_need_a_run(spark):
    content = content_of(spark, "Answer Key", "1. B", "2. C", "text", "3. D")
    found = M.answers(content, M.solutions(content)).collect()
    assert sorted((a.question_number, a.answer_key) for a in found) == [(1, "B"), (2, "C")]


def test_keys(spark):
    rows = [("(b)", "B"), ("- **A**", "A"), ("Option c", "C"), ("Β", "B"), ("Δ.", "D"), ("x", None), ("", None), (None, None), ("E", "E"), ("**d**.", "D")]
    df = spark.createDataFrame(rows, "raw string, want string")
    assert [(r.raw, r.got) for r in df.select("raw", T.option_key(F.col("raw")).alias("got")).collect()] == rows
    answers = [("Ans (b)", "B"), ("key: a", None), ("answer. c", "C"), ("(d)", "D")]
    df = spark.createDataFrame(answers, "raw string, want string")
    assert [(r.raw, r.got) for r in df.select("raw", T.answer_key(F.col("raw")).alias("got")).collect()] == answers


def test_answer_key_lines(spark):
    rows = [("12. B", True), ("1. A 2. C", True), ("1. A long sentence follows here", False), ("| 3. D |", True), ("2/3. B is not one", False), ("", False), (None, False)]
    df = spark.createDataFrame(rows, "raw string, want boolean")
    assert [(r.raw, r.got) for r in df.select("raw", T.is_answer_key_line(F.col("raw")).alias("got")).collect()] == rows


def test_rows_without_cells_go_and_cells_keep_their_page(spark):
    out = L.content_lines(L.classified_lines(of(spark, "<!-- PageNumber: 3 -->", "| --- |", "| (a) x<br><br>y | <br> |", "(b) z"))).orderBy("line_number")
    assert [(r.raw, r.line_type, r.detected_label, r.page_number, r.cell_index, r.segment_index, r.source_kind) for r in out.collect()] == [
        ("<!-- PageNumber: 3 -->", "page_number_marker", "3", 3, None, None, "raw_line"), ("(a) x", "option_candidate", "A", 3, 0, 0, "table_cell_segment"),
        ("y", "text", None, 3, 0, 1, "table_cell_segment"), ("<br>", "text", None, 3, 1, 0, "table_cell_segment"), ("(b) z", "option_candidate", "B", 3, None, None, "raw_line"),
    ]


def test_guarded_parts_of_the_classification_give_what_their_patterns_give(spark):
    marks = ["", " ", "- ", "* **", "**", "## ", "#", "- # ", "( ", "+ "]
    bodies = ["Q 12. x", "q.7", "Question No. 3", "Que 4", "12. of what", "٣. of what", "(12) of what", "7) words here", "(a) x", "Ans. (b)", "anſ: b", "x**", "**b** c", "WWW.x", "http://x", "copyright", "COPYRİGHT", "all rights reſerved", "viſıt us at", "©", "plain", ""]
    df = spark.createDataFrame([(m + b + e,) for m in marks for b in bodies for e in ("", " ", "** y", "\u3000")] + [(None,)], "raw string").withColumn("bare", T.strip(F.col("raw"))).withColumn("plain", T.target(F.col("raw")))
    raw, bare, plain = F.col("raw"), F.col("bare"), F.col("plain")
    assert df.where(~T.target_of(bare).eqNullSafe(plain) | ~T.target_of(plain).eqNullSafe(T.target(plain))).count() == 0
    for p in (*P.ANCHOR_PREFIXED, *P.ANCHOR_NUMERIC):
        assert df.where(T.has(plain, p) & ~T.has(plain, P.QUESTION_LEAD)).count() == 0
    assert df.where(T.has(raw, P.FOOTER) & ~T.has(raw, P.FOOTER_GUARD)).count() == 0 and df.where(T.has(raw, P.FOOTER)).count() > 200
    assert df.where(~(F.lower(F.substring(plain, 1, 3)) == "ans").eqNullSafe(F.lower(plain).startswith("ans"))).count() == 0
