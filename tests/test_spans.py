"""Spans of items: the ladder of matchers, options by key and text, and that no span leaves its window."""

import pytest
from pyspark.sql import functions as F

from foliate.operators import families, spans

ITEM = "doc_id long, question_id string, question_number int, question_text_raw string, options array<struct<key:string,text:string,start_line:int>>"
LINES = "doc_id long, question_number int, line_number int, raw string, is_anchor boolean, is_option_line boolean"


def resolved(spark, window, items, answers=None, number=1):
    lines = spark.createDataFrame([(1, number, i, t, i == 0, False) for i, t in enumerate(window)], LINES)
    df = spark.createDataFrame([(1, str(k), *i) for k, i in enumerate(items)], ITEM)
    found = spans.resolve_spans(df, families.read_lines(lines), answers)
    return {r.question_id: r for r in found.collect()}


def test_options_by_key(spark):
    got = resolved(spark, ["**1.** Sample question text here.", "- **A** 50", "- **B** 67", "- **C** 52", "- **D** 63"], [(1, "**1.** Sample question text here.", [("A", "50", None), ("b", "67", None), ("E", "x", None), ("", "52", None), (None, "nowhere", None)])])["0"]
    assert [(o.key, o.line) for o in got.option_lines] == [("A", 1), ("b", 2), ("E", None), ("", 3), (None, None)]
    assert got.matched_by == "block" and got.question_lines == [0] and got.open_options == 2 and got.foreign_options == []


def test_ladder(spark):
    window = ["**1.** Select the related option.", "19 : 34 :: 5 : 6", "- **A** 50", "**2.** Another one", "last"]
    items = [(1, "**1.** Select the related option.", []), (1, "**1.** Select the related option. 19 : 34 :: 5 : 6", []), (1, "well: **1.** Select the related option. and more", []), (1, "5 : 6 :: last", []), (1, "", None), (1, None, None)]
    got = resolved(spark, window, items)
    assert {k: (r.anchor_line, r.matched_by, r.question_lines) for k, r in got.items()} == {"0": (0, "block", [0, 1]), "1": (0, "block", [0, 1]), "2": (0, "anchor", [0]), "3": (0, "none", []), "4": (0, "none", []), "5": (0, "none", [])}


def test_a_block_ends_at_the_next_anchor(spark):
    got = resolved(spark, ["**1.** First", "(a) one", "**2.** Second", "(b) two"], [(1, "First", [("A", "one", None), ("B", "two", None)])])["0"]
    assert [o.line for o in got.option_lines] == [1, None] and got.open_options == 1


def test_unresolved_stays_unresolved(spark):
    answers = spark.createDataFrame([(1, 1, 9), (1, 1, 7)], "doc_id long, question_number int, line_number int")
    got = resolved(spark, ["Unrelated content only."], [(8877, "**8877.** Unique missing phrase xyzzyplughall.", [("A", "ghost-option-xyzzy", None)]), (1, "phrase", [])], answers)
    assert (got["0"].anchor_line, got["0"].matched_by, got["0"].question_lines, got["0"].open_options, got["0"].answer_span) == (None, "none", [], 1, None)
    assert got["1"].answer_span == 7


@pytest.mark.parametrize("n", [1, 2])
def test_spans_never_leave_their_window(spark, n):
    lines = spark.createDataFrame([(1, q, 10 * q + i, f"{q}. What is it" if i == 0 else f"({k}) text {k}", i == 0, i > 0) for q in (1, 2) for i, k in enumerate("-abcd")], LINES)
    items = spark.createDataFrame([(1, "x", n, "What is it", [("A", "text a", 11), ("B", "text b", 22), ("C", "text c", 999), ("D", "text d", None)])], ITEM)
    (got,) = spans.resolve_spans(items, families.read_lines(lines)).collect()
    own = {10 * n + i for i in range(5)}
    assert {*got.question_lines, *(o.line for o in got.option_lines if o.line)} <= own
    assert got.foreign_options == (["B", "C"] if n == 1 else ["A", "C"]) and got.open_options == 0
    assert spans.resolve_spans(items.limit(0), families.read_lines(lines)).count() == 0
