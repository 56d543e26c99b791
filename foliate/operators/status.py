"""What becomes of an item: grounding in its window, readiness, review class; and each document's counts and gates.

Items are rows (doc_id, question_id, question_number, question_text_raw, options,
answer_key, answer_text, solution, assets, issues, quality).  Everything is
joined and grouped by document and number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliate.functions import issues as I
from foliate.functions import text as T
from foliate.operators.gates import FOUR, usable_options
from foliate.operators.segment import EXPECTED_KEYS

# --- fixed values -------------------------------------------------------------------
LEADING_NUMBER = r"^\d+\s*[\.\)]\s*"
OPTION_LABEL = r"^\(([A-Da-d])\)\s*"
WORD = r"(?i)[a-z0-9]{3,}"
OTHER_BLANK = r"[^\S ]"
LEAST_WORDS, LEAST_OVERLAP, LONG_WORD, WORDS_TRIED = 3, 0.55, 4, 3
QUALITIES = ("accepted_safe", "review_required", "visual_required", "answer_unavailable", "blocked")
GOOD_WINDOWS, GOOD_OPTIONS, GOOD_MISSING = 0.85, 0.75, 0.10
LEAST_WINDOWS, LEAST_OPTIONS, MOST_MISSING = 0.60, 0.60, 0.30
LEAST_LINES, SCANNED, MUCH_IMAGE = 20, 0.55, 0.50
UNDERBOUND_WINDOWS, ENOUGH_WINDOWS, ENOUGH_ITEMS = 0.70, 0.85, 0.90
MOST_ISSUES = 15
ISSUE_NAMES = {"unlabeled_option_images": "unlabeled_visual_assets"}
ACTIONS = {
    "visual_required": "Attach or render required figure/diagram before question-bank use.",
    "table_or_chart_visual": "Convert chart/table visual or preserve source image reference.",
    "incomplete_options": "Recover options from local window evidence or mark for manual review.",
    "answer_unavailable": "Obtain missing answer for solved-PDF question or hold from pattern ingestion.",
    "answer_solution_join_gap": "Inspect answer-solution map join and option completeness.",
    "formula_uncertain": "Verify formula OCR and option text locally.",
    "source_text_uncertain": "Verify source spans against evidence lines.",
    "blocked": "Quarantine item; do not export to ingestion.",
    "review_required": "Manual review in final questions JSON.",
}


def _some(*pairs) -> Column:
    return F.array_compact(F.array(*(F.when(c, F.lit(i)) for c, i in pairs)))


def _text() -> Column:
    return F.coalesce(F.col("question_text_raw"), F.lit(""))


def matchable(text: Column) -> Column:
    """Text as it is compared with its source: no bold, list mark or option brackets, single blanks, lower case."""
    # each step is computed once, within an array of one; most texts have no bold and single blanks only
    let = lambda value, then: F.get(F.transform(F.array(value), then), F.lit(0))
    plain = let(T.strip(text), lambda t: F.when(t.contains("**"), F.regexp_replace(t, T.uni(T.P.BOLD), "$1")).otherwise(t))
    plain = F.regexp_replace(F.regexp_replace(plain, T.uni(T.P.LIST_PREFIX), ""), OPTION_LABEL, "$1 ")
    return F.lower(T.strip(let(plain, lambda t: F.when(t.contains("  ") | T.has(t, OTHER_BLANK), F.regexp_replace(t, T.uni(r"\s+"), " ")).otherwise(t))))


def _forms(texts: Column) -> Column:
    """Each text as it is compared, and the same without its number."""
    return F.transform(F.transform(texts, matchable), lambda m: F.struct(m.alias("m"), T.strip(F.regexp_replace(m, T.uni(LEADING_NUMBER), "")).alias("bare")))


def in_evidence(texts: Column, combined: Column, lines: Column) -> Column:
    """Whether matchable lines hold one of the texts, with or without its number, or lie within it; blank texts never are."""
    held = lambda t: (t != "") & (combined.contains(t) | F.exists(lines, lambda x: t.contains(x)))
    return F.exists(_forms(texts), lambda f: (f["m"] != "") & (held(f["m"]) | held(f["bare"])))


def grounded(items: DataFrame, windows: DataFrame, lines: DataFrame) -> DataFrame:
    """Add has_evidence, text_found, words_found and options_found: whether the window of an item's number holds it.

    ``windows`` has (doc_id, question_number, line_numbers), ``lines`` (doc_id,
    line_number, raw).  Blank lines are no evidence.  An item without a window, or
    with a blank text, is not found; without options, these are.
    """
    placed = windows.select("doc_id", "question_number", F.explode("line_numbers").alias("line_number"))
    own = placed.join(lines.select("doc_id", "line_number", "raw").where(T.strip(F.col("raw")) != ""), ["doc_id", "line_number"])
    sorted_rows = F.array_sort(F.collect_list(F.struct("line_number", "raw")))
    evidence = own.groupBy("doc_id", "question_number").agg(sorted_rows.alias("rows"))
    evidence = evidence.select("doc_id", "question_number", F.filter(F.transform("rows", lambda r: matchable(r["raw"])), lambda x: x != "").alias("match_lines"), F.lower(F.array_join(F.transform("rows", lambda r: r["raw"]), " ")).alias("said"))
    evidence = evidence.withColumn("combined", F.array_join("match_lines", " "))
    none = F.array().cast("array<string>")
    joined = items.join(evidence, ["doc_id", "question_number"], "left").withColumns({"match_lines": F.coalesce("match_lines", none), "combined": F.coalesce("combined", F.lit("")), "said": F.coalesce("said", F.lit(""))})
    found = lambda texts: in_evidence(texts, F.col("combined"), F.col("match_lines"))
    words = F.regexp_extract_all(_text(), F.lit(WORD), F.lit(0))
    hits = F.size(F.filter(words, lambda w: F.col("said").contains(F.lower(w))))
    longer = lambda t: F.slice(F.filter(F.split(t, T.uni(r"\s+")), lambda w: F.char_length(w) >= LONG_WORD), 1, WORDS_TRIED)
    tried = lambda t: F.when(F.char_length(t) >= LONG_WORD, F.concat(F.array(t), longer(t))).otherwise(F.array(t))
    texts = F.filter(F.transform("options", lambda o: T.strip(F.coalesce(o["text"], F.lit("")))), lambda t: t != "")
    out = joined.withColumns({
        "has_evidence": F.size("match_lines") > 0,
        "text_found": found(F.array(_text())),
        "words_found": (F.size(words) >= LEAST_WORDS) & (hits / F.greatest(F.size(words), F.lit(1)) >= LEAST_OVERLAP),
        "options_found": F.coalesce(F.forall(F.transform(texts, tried), found), F.lit(True)),
    })
    return out.drop("match_lines", "combined", "said")


def triaged(items: DataFrame) -> DataFrame:
    """Grounded items: suspicion of invented text is lifted where the window holds text and options; review remains.

    Items that leak across windows, have no text or are missing stay as they are.  Adds ``lifted``.
    """
    suspected = F.exists("issues", lambda i: I.is_invented(i) | I.is_quarantined(i)) & ~F.array_contains("issues", "question_missing_from_extraction")
    leaks = F.exists("issues", lambda i: F.lower(i).contains("cross_window"))
    lifted = suspected & ~leaks & (T.strip(_text()) != "") & F.col("has_evidence") & (F.col("text_found") | F.col("words_found")) & F.col("options_found")
    rest = F.filter("issues", lambda i: ~(I.is_invented(i) | I.is_quarantined(i) | i.startswith("missing_option_source_spans") | i.startswith("missing_question_source_spans")))
    marked = items.withColumn("lifted", F.coalesce(lifted, F.lit(False)))
    return marked.withColumns({"issues": F.when(F.col("lifted"), F.array_distinct(rest)).otherwise(F.col("issues")), "quality": F.when(F.col("lifted"), "review_required").otherwise(F.col("quality"))})


def readiness(items: DataFrame, answers_expected: bool = False) -> DataFrame:
    """Add status (ready, review, visual_required, blocked), review_issues (public codes, in order) and the quality that follows.

    A figure counts as given where a column ``has_syntax`` says so; an answer that is only the
    chosen option is an issue where a column ``chosen_key`` holds that option.
    """
    no = F.lit(False)
    blank = T.strip(_text()) == ""
    quality = F.coalesce("quality", F.lit(""))
    barred = F.array_contains("issues", "question_missing_from_extraction") | F.exists("issues", I.is_quarantined)
    barred = barred | F.when(F.exists("issues", I.is_invented), quality == "blocked").otherwise((quality == "blocked") & blank)
    live = F.filter("issues", lambda i: ~i.startswith(I.STALE))
    needs_figure = F.size(I.figure_hits(_text(), F.coalesce("assets", F.lit(0)) > 0)) > 0
    if "has_syntax" in items.columns:
        needs_figure = needs_figure & ~F.coalesce("has_syntax", no)
    # columns, as several rules ask for each
    items = items.withColumns({"_usable": usable_options(), "_corrupt": F.exists(live, I.is_corrupt), "_figure": needs_figure})
    usable, corrupt, needs_figure = F.col("_usable"), F.col("_corrupt"), F.col("_figure")
    answered = F.col("answer_key").isNotNull() & (T.strip(F.coalesce("answer_text", F.lit(""))) != "")
    lost = F.array_contains(live, "answer_key_not_in_options") | F.array_contains(live, "correct_answer_text_unavailable")
    own = [(usable < FOUR, "incomplete_options"), (corrupt, "question_text_uncertain"), (lost, "answer_key_not_in_options")]
    if answers_expected:
        unsolved = F.exists(live, lambda i: i.contains("missing_solution") | i.contains("solution_unavailable") | i.contains("solution_missing"))
        solved = T.strip(F.coalesce(F.col("solution.raw_text"), F.lit(""))) != ""
        own += [(~answered, "expected_answer_missing"), (~solved & unsolved, "expected_solution_missing")]
    if "chosen_key" in items.columns:
        own.append((F.coalesce(F.col("chosen_key") == F.col("answer_key"), no), "chosen_option_not_correct_answer_source"))
    gone = F.concat("issues", F.when(blank, F.array(F.lit("question_missing_from_extraction"))).otherwise(F.array().cast("array<string>")))
    marked = items.withColumns({"_barred": F.coalesce(barred, no), "_codes": I.public_codes(F.concat(_some(*own), live), _text())})
    marked = marked.withColumn("_held", F.coalesce(corrupt | F.exists("_codes", I.is_blocking), no))
    status = F.when(F.col("_barred"), "blocked").when(needs_figure, "visual_required").when((usable < FOUR) | F.col("_held"), "review").when(blank, "blocked").otherwise("ready")
    also = _some((~F.col("_barred") & needs_figure, "visual_syntax_missing"), (~needs_figure & (usable < FOUR), "incomplete_options"), (~needs_figure & (usable >= FOUR) & ~F.col("_held") & blank, "question_text_uncertain"))
    codes = F.when(F.col("_barred"), I.public_codes(gone, _text())).otherwise(F.array_distinct(F.concat("_codes", also)))
    judged = marked.withColumns({"status": status, "review_issues": codes})
    kept = F.when(F.col("status").isin("blocked", "visual_required"), F.col("status")).when((F.col("status") == "ready") & F.col("answer_key").isNull(), "answer_unavailable")
    return judged.withColumn("quality", kept.when((F.col("status") == "ready") & answered, "accepted_safe").otherwise("review_required")).drop("_barred", "_codes", "_held", "_usable", "_corrupt", "_figure")


def window_quality(items: DataFrame) -> Column:
    """The quality of an item that was built from its window alone."""
    texts = F.coalesce(F.size(F.filter("options", lambda o: T.strip(F.coalesce(o["text"], F.lit(""))) != "")), F.lit(0))
    drawn = F.coalesce("assets", F.lit(0)) > 0
    keyed = F.col("answer_key").isNotNull()
    said = F.coalesce("answer_text", F.lit("")) != ""
    return F.when(drawn & (texts < 2), "visual_required").when(usable_options() < FOUR, "review_required").when(keyed & said, "accepted_safe").when(keyed, "review_required").otherwise("answer_unavailable")


def readiness_counts(items: DataFrame) -> DataFrame:
    """By document: items by status and by quality, and how many have four usable options."""
    of = lambda column, value: F.count_if(F.col(column) == value)
    whole = usable_options() >= FOUR
    return items.groupBy("doc_id").agg(
        *(of("status", s).alias(f"{n}_count") for s, n in (("ready", "ready"), ("review", "review"), ("visual_required", "visual_required"), ("blocked", "blocked"))),
        F.count_if(F.col("status") != "ready").alias("review_items_count"),
        *(of("quality", s).alias(f"quality_{s}") for s in QUALITIES),
        F.count_if(whole).alias("with_four_options"),
        F.count_if(~whole).alias("with_incomplete_options"),
        F.count_if(~whole & (F.col("quality") == "accepted_safe")).alias("accepted_with_incomplete_options"),
    )


def review_items(items: DataFrame, gaps: DataFrame) -> DataFrame:
    """Items that a person should see, with a class and what to do; ``gaps`` are (doc_id, question_id) without an answer."""
    known = gaps.select("doc_id", "question_id", F.lit(True).alias("gap")).distinct()
    joined = items.join(known, ["doc_id", "question_id"], "left")
    codes, status = F.col("review_issues"), F.col("status")
    unsure = lambda i: i.contains("hallucinated") | i.contains("cross_window")
    charted = F.exists(I.figure_hits(_text(), F.lit(False)), lambda p: p.contains("graph") | p.contains("chart"))
    formula = (_text().contains("\\frac") | _text().contains("\\left")) & (usable_options() < FOUR)
    group = (
        F.when(status == "blocked", "blocked")
        .when(F.col("gap"), "answer_solution_join_gap")
        .when((status == "visual_required") | F.array_contains(codes, "visual_syntax_missing"), F.when(charted, "table_or_chart_visual").otherwise("visual_required"))
        .when(F.array_contains(codes, "incomplete_options") | (usable_options() < FOUR), "incomplete_options")
        .when(F.array_contains(codes, "expected_answer_missing"), "answer_unavailable")
        .when(F.exists("issues", unsure), "source_text_uncertain")
        .when(formula, "formula_uncertain")
        .otherwise("review_required")
    )
    suspicious = F.exists(F.concat("issues", codes), lambda i: unsure(i) | i.contains("answer_key_not_in_options"))
    actions = F.create_map(*(F.lit(x) for pair in ACTIONS.items() for x in pair))
    chosen = joined.where((status != "ready") | suspicious).withColumn("review_class", group)
    advice = F.when((status == "ready") & (F.col("review_class") == "answer_unavailable"), "Question is ready for question bank; answer optional for PYQ export.")
    return chosen.select("doc_id", "question_id", "question_number", "status", "review_class", advice.otherwise(F.element_at(actions, F.col("review_class"))).alias("action"))


def quality_gate(checks: DataFrame, metrics: DataFrame, counts: DataFrame) -> DataFrame:
    """By document of ``checks`` (doc_id, gate): failed, warning or passed.

    ``metrics`` are candidate counters, ``counts`` (doc_id, review_items, count_match).
    """
    joined = checks.select("doc_id", "gate").join(metrics, "doc_id", "left").join(counts, "doc_id", "left")
    some = lambda c: F.coalesce(F.col(c), F.lit(0)) > 0
    warned = some("incomplete_candidates") | some("review_items") | some("visual_dependent_count") | some("candidates_with_noise") | some("candidates_with_no_options") | ~F.coalesce("count_match", F.lit(True))
    return joined.select("doc_id", F.when(F.col("gate") == "failed", "failed").when(warned, "warning").otherwise("passed").alias("quality_gate"))


def extraction_fallback(docs: DataFrame) -> DataFrame:
    """Whether the first reader's lines are too weak, and whether binding found too little, by document.

    ``docs`` has doc_id, lines, windows, windows_with_four, items, expected_count,
    scanned_score and image_ratio; a null counts as 0.
    """
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    wanted = n("expected_count") > 0
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    missing = F.when(wanted, F.greatest(F.lit(0), n("expected_count") - n("windows"))).otherwise(0)
    measured = docs.withColumns({"window_ratio": ratio(n("windows"), n("expected_count")), "option_coverage": ratio(n("windows_with_four"), n("windows")), "missing_questions": missing.cast("long"), "missing_ratio": ratio(missing, n("expected_count"))})
    share, options, gaps = F.col("window_ratio"), F.col("option_coverage"), F.col("missing_ratio")
    good = wanted & (share >= GOOD_WINDOWS) & (options >= GOOD_OPTIONS) & (gaps <= GOOD_MISSING)
    reasons = _some(
        (n("lines") < LEAST_LINES, "marker_line_count_low"),
        (wanted & (share < LEAST_WINDOWS), "question_window_count_low"),
        (wanted & (options < LEAST_OPTIONS), "option_coverage_low"),
        (wanted & (gaps > MOST_MISSING), "missing_question_count_high"),
        (n("scanned_score") >= SCANNED, "scanned_or_screenshot_score_high"),
        ((n("image_ratio") >= MUCH_IMAGE) & (n("lines") < 2 * LEAST_LINES), "high_image_area_low_marker_lines"),
    )
    floor = lambda c, r: F.floor(n(c) * F.lit(r))
    low = (n("items") < floor("windows", UNDERBOUND_WINDOWS)) | (wanted & (n("windows") >= floor("expected_count", ENOUGH_WINDOWS)) & (n("items") < floor("expected_count", ENOUGH_ITEMS)))
    judged = measured.withColumn("reasons", F.when(good, F.array().cast("array<string>")).otherwise(reasons))
    verdict = F.when(good, "good").when(F.size("reasons") > 0, "weak").otherwise("acceptable")
    return judged.withColumns({"verdict": verdict, "fallback": F.size("reasons") > 0, "underbound": (n("windows") > 0) & (n("items") > 0) & low})


def structure_audit(cands: DataFrame) -> DataFrame:
    """By document: how candidates' options and figures are made."""
    keys = F.coalesce("option_keys", F.array().cast("array<string>"))
    expected = keys == F.array(*map(F.lit, EXPECTED_KEYS))
    visual = T.is_visual(_text())
    worded = expected & F.coalesce(F.forall("options", lambda o: o["key"].isNotNull() & (T.strip(o["text"]) != "")), F.lit(False))
    drawn = expected & F.coalesce(F.forall("options", lambda o: o["linked"]), F.lit(False))
    holds = lambda *names: F.count_if(F.arrays_overlap("issues", F.array(*map(F.lit, names))))
    return cands.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("total_candidates"),
        F.count_if((F.size(keys) > 0) & ~expected).alias("invalid_option_count_questions"),
        holds("same_line_option_split_applied").alias("same_line_option_split_count"),
        F.count_if(visual).alias("visual_dependent_count"),
        F.count_if(visual & worded).alias("visual_with_text_options_count"),
        F.count_if(drawn).alias("visual_with_image_options_count"),
        holds("missing_option_labels_for_visual_question", "source_backed_option_labels_missing").alias("visual_missing_option_labels_count"),
        holds("possible_noise_asset_after_options").alias("noise_asset_candidate_count"),
        holds("visual_question_requires_review", "visual_question_requires_diagram_syntax").alias("candidates_requiring_visual_review"),
    )


def issue_numbers(cands: DataFrame) -> DataFrame:
    """(doc_id, issue, numbers): the question numbers with each issue."""
    each = cands.where("question_number is not null").select("doc_id", "question_number", F.explode("issues").alias("issue"))
    return each.groupBy("doc_id", "issue").agg(F.array_sort(F.collect_set("question_number")).alias("numbers"))


def top_issues(cands: DataFrame, most: int = MOST_ISSUES) -> DataFrame:
    """Each document's most frequent issues, of equal ones the first seen: (doc_id, rank, issue, n).  The limit is the report's."""
    each = cands.select("doc_id", "seq", F.posexplode("issues").alias("at", "name")).withColumn("issue", F.coalesce(F.element_at(F.create_map(*(F.lit(x) for p in ISSUE_NAMES.items() for x in p)), F.col("name")), F.col("name")))
    counted = each.groupBy("doc_id", "issue").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("seq", "at")).alias("first"))
    rank = F.row_number().over(W.partitionBy("doc_id").orderBy(F.desc("n"), "first"))
    return counted.withColumn("rank", rank).where(F.col("rank") <= most).select("doc_id", "rank", "issue", "n")
