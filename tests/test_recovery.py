"""Blank options get each line of the other engine once; slots and gates look at the answer's text."""

from foliate.operators import evidence, gates, packages

FIRST = "doc_id long, line_id string, page_number int, place int, text string"
SECOND = FIRST + ", confidence double, is_option boolean"


def recovered(spark, first, second):
    found = evidence.recovered_options(spark.createDataFrame([(1, *r) for r in first], FIRST), spark.createDataFrame([(1, *r) for r in second], SECOND))
    return {r.line_id: (r.option_line, r.option_text) for r in found.collect()}


def test_two_blanks_compete_for_one_line(spark):
    got = recovered(spark, [("a", 1, 1, "1."), ("b", 1, 2, "2)"), ("c", 2, 3, "(full) text")], [("x", 1, 1, "1. red", 0.5, False)])
    assert got == {"a": ("x", "red"), "b": (None, None)}


def test_the_surest_line_goes_first(spark):
    second = [("x", 1, 1, "1. red", 0.5, False), ("y", 1, 2, "2. blue", 0.9, False), ("z", 1, 3, "green", 0.9, True), ("n", 1, 4, "no option", 1.0, False), ("p", 2, 5, "3. far", 1.0, False), ("e", 1, 6, None, 1.0, True)]
    first = [("a", 1, 1, " A) "), ("b", 1, 2, "Ans."), ("c", 1, 3, "d."), ("d", 1, 4, "4."), ("e", None, 5, "1)"), ("f", 3, 6, "1)"), ("g", 1, 7, None)]
    assert recovered(spark, first, second) == {"a": ("y", "blue"), "b": ("z", "green"), "c": ("x", "red"), "d": (None, None), "e": ("p", "far"), "f": (None, None)}
    assert recovered(spark, first[:1], []) == {"a": (None, None)} and recovered(spark, [], second) == {}


ITEM = "doc_id long, seq long, question_id string, question_number int, question_text_raw string, options array<struct<key:string,text:string>>, answer_key string, solution string, issues array<string>, validation_status string, item_confidence double"
FOUR = [(k, f"text {k}") for k in "ABCD"]


def test_slots_ask_for_clean_text_and_the_answers_text(spark):
    rows = [
        (1, 1, "dirty", 1, "What is it", FOUR, "A", "s", ["hallucinated_option_text:A"], "validated", 1.0),
        (1, 2, "clean", 1, "What is it", FOUR, None, None, ["x", "y"], "validated", 1.0),
        (1, 3, "no text", 2, "What is it", FOUR, "E", "s", [], "validated", 1.0),
        (1, 4, "text", 2, "What is it", FOUR, "B", None, ["x"], "validated", 1.0),
    ]
    expected = spark.createDataFrame([(1, 3)], "doc_id long, expected_count int")
    got = {r.question_number: r.final_question_id for r in packages.slots(spark.createDataFrame(rows, ITEM), expected).collect()}
    assert got == {1: "clean", 2: "text", 3: "fq_missing_0003"}


def test_an_answer_outside_the_options(spark):
    rows = [("a", "What", FOUR, "B", "text B"), ("b", "What", FOUR, "E", "given"), ("c", "What", FOUR, "E", " "), ("d", "What", FOUR, None, "given")]
    df = spark.createDataFrame(rows, "question_id string, question_text_raw string, options array<struct<key:string,text:string>>, answer_key string, answer_text string")
    got = {r.question_id: (r.answer_text, r.gate_issues, r.quality) for r in gates.acceptance(df).collect()}
    assert got == {"a": ("text B", [], "accepted_safe"), "b": ("given", ["answer_key_not_in_options"], "review_required"), "c": (None, ["correct_answer_text_unavailable"], "review_required"), "d": ("given", [], "answer_unavailable")}
