"""Issues, grounding, readiness, review classes and fallbacks on small items with known results."""

from pyspark.sql import functions as F

from foliate.functions import issues as I
from foliate.operators import status as R

ITEM = "doc_id long, question_id string, question_number int, question_text_raw string, options array<struct<key:string,text:string>>, answer_key string, answer_text string, solution struct<raw_text:string>, assets long, issues array<string>, quality string"
FOUR = [("A", "red rose"), ("B", "blue"), ("C", "green"), ("D", "pale")]


def item(i, text="What colour is the sky above the town?", options=FOUR, key="B", answer="blue", assets=0, issues=(), quality="accepted_safe"):
    return (1, f"q_{i:04d}", i, text, options, key, answer, None, assets, list(issues), quality)


def test_public_codes_and_severity(spark):
    cases = {
        "Hallucinated": ("hallucination_suspected", True),
        "hallucinated_option_text:A": ("hallucination_suspected", True),
        "bad_item_classes:duplicate_question_number": ("question_text_uncertain", True),
        "cross_window_option_span_reuse": ("cross_window_option_leakage", True),
        "question_text_missing": ("question_text_uncertain", False),
        "corrupt question": (None, True),
        "expected_answer_missing": ("expected_answer_missing", False),
        "incomplete_options": ("incomplete_options", True),
        "option_incomplete_b": ("incomplete_options", False),
        "formula_lost": ("formula_ocr_uncertain", False),
        "Answer-Unavailable": ("expected_answer_missing", False),
        "a sentence that says something": (None, False),
        "": (None, False),
        None: (None, False),
    }
    df = spark.createDataFrame([(k,) for k in cases], "issue string")
    got = {r.issue: (r.code, r.blocks) for r in df.select("issue", I.public_code(F.col("issue"), F.lit("x")).alias("code"), I.is_blocking(F.col("issue")).alias("blocks")).collect()}
    assert got == cases


def test_readiness(spark):
    rows = [
        item(1),
        item(2, key=None, answer=None),
        item(3, options=FOUR[:3]),
        item(4, text="See the given figure and choose"),
        item(5, issues=["bad_item_classes:x"]),
        item(6, text="  ", quality="blocked"),
        item(7, text=None, quality="review_required"),
        item(8, issues=["hallucinated_question_text"], quality="review_required"),
        item(9, issues=["hallucinated_question_text"], quality="blocked"),
        item(10, options=None),
        item(11, issues=["options_found:2"], assets=1),
    ]
    got = {r.question_number: (r.status, r.quality, sorted(r.review_issues)) for r in R.readiness(spark.createDataFrame(rows, ITEM)).collect()}
    assert got[1] == ("ready", "accepted_safe", [])
    assert got[2] == ("ready", "answer_unavailable", [])
    assert got[3] == ("review", "review_required", ["incomplete_options"])
    assert got[4] == ("visual_required", "visual_required", ["visual_syntax_missing"])
    assert got[5] == ("blocked", "blocked", ["question_text_uncertain"])
    assert got[6] == ("blocked", "blocked", ["question_missing_from_extraction"])
    assert got[7] == ("blocked", "blocked", ["question_text_uncertain"])
    assert got[8] == ("review", "review_required", ["hallucination_suspected", "question_text_uncertain"])
    assert got[9] == ("blocked", "blocked", ["hallucination_suspected"])
    assert got[10][0] == "review" and got[11][0] == "visual_required"
    counts = R.readiness_counts(R.readiness(spark.createDataFrame(rows, ITEM))).first()
    assert (counts.ready_count, counts.review_count, counts.visual_required_count, counts.blocked_count) == (2, 3, 2, 4)
    assert (counts.with_four_options, counts.with_incomplete_options, counts.accepted_with_incomplete_options) == (9, 2, 0)
    late = R.readiness(spark.createDataFrame([item(1, key=None, answer=None)], ITEM), answers_expected=True).first()
    assert (late.status, late.review_issues) == ("ready", ["expected_answer_missing"])


def test_window_holds_or_lacks_an_item(spark):
    lines = spark.createDataFrame([(1, 1, "**1.** What colour is   the sky above the town?"), (1, 2, ""), (1, 3, "(a) red rose (b) blue"), (1, 4, "- (c) green (d) pale"), (1, 5, "2. Something else entirely")], "doc_id long, line_number int, raw string")
    windows = spark.createDataFrame([(1, 1, [1, 2, 3, 4]), (1, 2, [5])], "doc_id long, question_number int, line_numbers array<int>")
    bad = ["hallucinated_question_text"]
    rows = [item(1, issues=bad, quality="blocked"), item(2, issues=bad, quality="blocked"), item(3, issues=bad, quality="blocked")]
    rows.append((1, "q_x", 1, "What colour was the sky above the city?", [("A", "crimson lake")], None, None, None, 0, bad, "blocked"))
    rows.append((1, "q_y", 1, "What colour was the sky above the town hall?", FOUR, None, None, None, 0, [*bad, "cross_window_x"], "blocked"))
    rows.append((1, "q_z", 1, "What colour was the sky above the hall?", FOUR, None, None, None, 0, bad, "blocked"))
    out = {r.question_id: r for r in R.triaged(R.grounded(spark.createDataFrame(rows, ITEM), windows, lines)).collect()}
    assert (out["q_0001"].text_found, out["q_0001"].options_found, out["q_0001"].lifted, out["q_0001"].issues, out["q_0001"].quality) == (True, True, True, [], "review_required")
    assert (out["q_0002"].has_evidence, out["q_0002"].text_found, out["q_0002"].lifted, out["q_0002"].quality) == (True, False, False, "blocked")
    assert (out["q_0003"].has_evidence, out["q_0003"].lifted) == (False, False)
    assert (out["q_x"].text_found, out["q_x"].words_found, out["q_x"].options_found, out["q_x"].lifted) == (False, True, False, False)
    assert (out["q_y"].words_found, out["q_y"].lifted) == (True, False)
    assert (out["q_z"].words_found, out["q_z"].options_found, out["q_z"].lifted) == (True, True, True)


def test_review_classes(spark):
    rows = [item(1), item(2, options=FOUR[:2]), item(3, text="Study the following graph"), item(4, assets=1), item(5, issues=["quarantined"]), item(6, issues=["cross_window_x"]), item(7, key=None, answer=None, options=FOUR[:2])]
    gaps = spark.createDataFrame([(1, "q_0007")], "doc_id long, question_id string")
    got = {r.question_number: (r.review_class, r.action) for r in R.review_items(R.readiness(spark.createDataFrame(rows, ITEM)), gaps).collect()}
    assert {k: v[0] for k, v in got.items()} == {2: "incomplete_options", 3: "table_or_chart_visual", 4: "visual_required", 5: "blocked", 6: "source_text_uncertain", 7: "answer_solution_join_gap"}
    assert all(got[k][1] == R.ACTIONS[got[k][0]] for k in got)


def test_fallback(spark):
    rows = [(1, 100, 50, 45, 49, 50, 0.1, 0.0), (2, 100, 20, 5, 10, 50, 0.6, 0.0), (3, 30, 50, 35, 30, 50, 0.0, 0.5), (4, 100, 50, 35, 44, 50, 0.0, 0.0), (5, None, None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, lines long, windows long, windows_with_four long, items long, expected_count int, scanned_score double, image_ratio double")
    got = {r.doc_id: (r.verdict, r.reasons, r.underbound) for r in R.extraction_fallback(docs).collect()}
    assert got[1] == ("good", [], False)
    assert got[2] == ("weak", ["question_window_count_low", "option_coverage_low", "missing_question_count_high", "scanned_or_screenshot_score_high"], True)
    assert got[3] == ("weak", ["high_image_area_low_marker_lines"], True)
    assert got[4] == ("acceptable", [], True)
    assert got[5] == ("weak", ["marker_line_count_low"], False)


def test_top_issues_keep_the_order_of_equals(spark):
    cands = spark.createDataFrame([(1, 1, 1, ["b", "a"]), (1, 2, 2, ["unlabeled_option_images", "a"]), (1, 3, None, ["unlabeled_visual_assets"]), (2, 1, 1, [])], "doc_id long, seq long, question_number int, issues array<string>")
    assert [tuple(r) for r in R.top_issues(cands, most=2).orderBy("rank").collect()] == [(1, 1, "a", 2), (1, 2, "unlabeled_visual_assets", 2)]
    assert {(r.issue, tuple(r.numbers)) for r in R.issue_numbers(cands).collect()} == {("b", (1,)), ("a", (1, 2)), ("unlabeled_option_images", (2,))}


def test_matchable_texts(spark):
    cases = {" - **Bold** and  wide\tblanks\n": "bold and wide blanks", "(A)  Red": "a red", "plain Text": "plain text", "no\u00a0break": "no break", "a ** b": "a ** b", "": "", "   ": "", None: None}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r.t: r.m for r in df.select("t", R.matchable(F.col("t")).alias("m")).collect()} == cases
    assert R.matchable(F.col("t"))._jc.toString().count("btrim") <= 2


def test_matchable_texts_have_single_blanks_whatever_these_were(spark):
    from foliate.functions import patterns as P

    texts = [f"a{w}b{v}C" for w in ("", " ", "  ", *P.WHITE) for v in ("", " ", "　 ", "\x1c")]
    df = spark.createDataFrame([(t,) for t in texts], "raw string")
    got = df.select(R.matchable(F.col("raw")).alias("m"), F.lower(F.regexp_replace("raw", r"(?U)\s+", " ")).alias("want")).collect()
    assert [r.m for r in got] == [r.want for r in got]
    assert r"\s\s" not in str(df.select(R.matchable(F.col("raw")))._jdf.queryExecution().analyzed())
