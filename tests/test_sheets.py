"""Response sheets: cells, lines near a question, choices, and options filled one after another."""

from foliate.operators import sheets

LINES = "doc_id long, line_number int, raw string, options string"
ITEMS = "doc_id long, question_id string, question_number int, options array<struct<key:string,text:string,start_line:int>>, near string"


def lines(spark, texts):
    return spark.createDataFrame([(1, n, t, "other") for n, t in enumerate(texts, 1)], LINES)


def near(spark, texts, numbers):
    found = sheets.near_options(lines(spark, texts), spark.createDataFrame([(1, n) for n in numbers], "doc_id long, question_number int"))
    return {r.question_number: (r.anchor_line, [(o.key, o.text, o.line) for o in r.near]) for r in found.collect()}


def test_cells_of_a_line(spark):
    texts = ["| Ans | 1. red<br>2. blue | x |", "Ans 3) green", "| Ans 1. a | b |", "(2) plain", "1. no sheet", "| 5. five | 1. one |", "| 2. b 1. a 2. c |", None, "", "| --- |", "Answers: 12.5 m"]
    got = [[tuple(o) for o in r.options] for r in sheets.sheet_lines(lines(spark, texts)).orderBy("line_number").collect()]
    assert got == [[("1", "red"), ("2", "blue")], [("3", "green")], [("1", "a b")], [], [], [], [("1", "a"), ("2", "b")], [], [], [], []]


def test_options_within_eight_lines_of_a_question(spark):
    texts = ["x Q. 2 named", "| 1. far | ", "**1.** what", *["-"] * 5, "Ans 2. b", "Ans 1. a", "Ans 3. late", "1. again"]
    assert near(spark, texts, [1, 2, 2, None, 7]) == {1: (3, [("1", "a", 10), ("2", "b", 9)]), 2: (1, [("1", "far", 2)])}


def test_the_first_option_of_a_key_and_numbers_as_written(spark):
    texts = ["05. no", "5. yes", "Ans 1. first", "Ans 1. second", "Q 55 ", "Ans 2. b"]
    assert near(spark, texts, [5, 55]) == {5: (2, [("1", "first", 3), ("2", "b", 6)]), 55: (5, [("2", "b", 6)])}
    assert near(spark, [], [1]) == {} and near(spark, ["1. x"], [1]) == {}


def test_scopes_keep_lines_apart(spark):
    rows = [(1, "w1", 1, "1. q"), (1, "w1", 2, "Ans 1. own"), (1, "w2", 3, "Ans 2. other")]
    scoped = spark.createDataFrame(rows, "doc_id long, window_id string, line_number int, raw string")
    found = sheets.near_options(scoped, spark.createDataFrame([(1, "w1", 1)], "doc_id long, window_id string, question_number int"), by=("doc_id", "window_id")).collect()
    assert [(o.key, o.text) for o in found[0].near] == [("1", "own")]


def test_the_last_choice_counts(spark):
    texts = ["Chosen Option : A", "1. q", "Chosen Option : 2", "chosen option : b", "2. q", "Chosen Option : --", "3. q", "Chosen Option : 12", "4. q", "Chosen Option: ab", None]
    got = {r.question_number: (r.chosen_label, r.chosen_key, r.chosen_line) for r in sheets.chosen_options(lines(spark, texts)).collect()}
    assert got == {1: ("B", "B", 4), 3: ("12", None, 8)}


def bound(spark, options, found, number=1):
    items = spark.createDataFrame([(1, "q", number, options, "other")], ITEMS)
    told = spark.createDataFrame([(1, 1, 1, found)], "doc_id long, question_number int, anchor_line int, near array<struct<key:string,text:string,line:int>>")
    r = sheets.bind_options(items, told).collect()[0]
    return r.n_filled, [tuple(o) for o in r.options]


def test_options_are_filled_in_turn(spark):
    found = [("1", "red", 5), ("2", "blue", 6)]
    assert bound(spark, None, found) == (2, found)
    assert bound(spark, [], [(str(k), "t", k) for k in range(1, 6)])[0] == 4
    # two blanks without keys compete: the first takes the first, the second what is left, the third nothing
    assert bound(spark, [(None, "", None), (" ", None, 9), ("", " ", None)], found) == (2, [("1", "red", 5), ("2", "blue", 9), ("", " ", None)])
    # its own key, a text that holds the option's, a whole option
    assert bound(spark, [("2.", "", None), (None, "so red it is", 3), ("A", "whole", 4)], found) == (2, [("2", "blue", 6), ("1", "red", 3), ("A", "whole", 4)])
    assert bound(spark, [("A", "", 4)], found, number=None) == (0, [("A", "", 4)])
    assert bound(spark, [("A", "", 4)], []) == (0, [("A", "", 4)])
