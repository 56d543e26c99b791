"""Validation of bound items: every finding, the status it leads to, and the counts."""

import pytest

from foliate.operators import binding

ITEM = "doc_id long, question_id string, question_number int, question_text_raw string, question_lines array<int>, options array<struct<key:string,text:string,line:int,asset:boolean>>, answer_key string, answer_text string, answer_lines array<int>, solution_text string, solution_lines array<int>"
LINES = [(1, 1, "**1.** What is two plus two?"), (1, 2, "(a) three"), (1, 3, "(b) four"), (1, 4, "1.B"), (1, 5, "Two and two make four."), (2, 1, "Bare words")]
GOOD = dict(question_text_raw="What is two plus two?", question_lines=[1], options=[("A", "three", 2, False), ("B", "four", 3, False)], answer_key="b", answer_text="1.B", answer_lines=[4], solution_text="Two and two make four.", solution_lines=[5])


def judged(spark, rows, mode="answer_key_only"):
    lines = spark.createDataFrame(LINES, "doc_id long, line_number int, raw string")
    items = [(r.pop("doc_id", 1), str(k), r.pop("question_number", k), *({**GOOD, **r}[c] for c in GOOD)) for k, r in enumerate(map(dict, rows))]
    return binding.validate(spark.createDataFrame(items, ITEM), lines, mode)


CASES = [
    ({}, [], "accepted"),
    ({"question_lines": []}, ["missing_question_source_spans"], "rejected"),
    ({"question_lines": None, "question_text_raw": None}, ["missing_question_source_spans"], "rejected"),
    ({"question_text_raw": "Something nobody wrote"}, ["hallucinated_question_text"], "rejected"),
    ({"options": [("A", "three", None, False), ("B", "four", 3, False)]}, ["missing_option_source_spans:A"], "rejected"),
    ({"options": [("A", "three", None, True), ("B", "five", 3, False)]}, ["hallucinated_option_text:B"], "rejected"),
    ({"options": [("A", "three", 2, False), ("Z", "four", 3, False)], "answer_key": "A"}, ["invalid_option_key:Z"], "review_required"),
    ({"options": [("A", "three", 2, False), ("", "", None, False)], "answer_key": "a"}, [], "accepted"),
    ({"options": []}, ["missing_options"], "review_required"),
    ({"options": None}, ["missing_options"], "review_required"),
    ({"answer_key": "D"}, ["answer_key_not_in_options"], "review_required"),
    ({"answer_lines": []}, ["missing_answer_source_spans"], "review_required"),
    ({"answer_text": "elsewhere"}, ["hallucinated_answer_text"], "rejected"),
    ({"solution_lines": []}, ["missing_solution_source_spans"], "review_required"),
    ({"solution_text": "made up"}, ["hallucinated_solution_text"], "rejected"),
    ({"answer_key": None}, ["missing_answer_answer_key_only_mode"], "review_required"),
    ({"doc_id": 2, "question_text_raw": "Bare words", "options": [], "answer_lines": [1], "answer_text": None, "solution_text": None}, ["missing_options"], "rejected"),
]


def test_findings(spark):
    got = {r.question_id: (r.issues, r.status) for r in judged(spark, [c[0] for c in CASES]).collect()}
    assert [got[str(k)] for k in range(len(CASES))] == [(issues, status) for _, issues, status in CASES]


@pytest.mark.parametrize("mode, issues, status", [
    ("required", ["missing_answer_required_mode", "missing_solution_required_mode"], "review_required"),
    ("optional", ["missing_answer_optional_mode", "missing_solution_optional_mode"], "accepted"),
    ("question_only", [], "accepted"),
])
def test_modes(spark, mode, issues, status):
    bare, full = {"answer_key": None, "solution_text": None}, {}
    got = {r.question_id: (r.issues, r.status) for r in judged(spark, [bare, full], mode).collect()}
    assert got["0"] == (issues, status)
    assert got["1"] == ((["answer_present_question_only_mode_ignored"] if mode == "question_only" else []), "accepted")


def test_counts_and_repeated_numbers(spark):
    found = judged(spark, [{"question_number": 2}, {"question_number": 2, "answer_key": "D"}, {"question_number": 4, "question_lines": []}, {"question_number": None}])
    expected = spark.createDataFrame([(1, 5)], "doc_id long, expected_count int")
    (got,) = binding.validation_counts(found, expected).collect()
    assert got.asDict() == {"doc_id": 1, "total": 4, "accepted": 1, "review_required": 2, "rejected": 1, "source_span_missing": 1, "hallucination_suspected": 0, "option_key_missing": 0, "answer_key_not_in_options": 1, "duplicate_numbers": 1, "missing_numbers": 3}
    assert binding.validation_counts(found.limit(0)).count() == 0
