"""Column functions on names of issues: which block, which hint at invented text, and the public code of each."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliate.functions import text as T

# --- fixed values: issues that hold an item back, and issues of answers that do not ---------
BLOCKING = (
    "question_missing_from_extraction", "question_text_uncertain", "incomplete_options", "visual_syntax_missing", "formula_ocr_uncertain",
    "table_ocr_uncertain", "hallucination_suspected", "cross_window_option_leakage", "corrupt_question_text", "chosen_option_not_correct_answer_source",
)
ANSWER_ONLY = ("expected_answer_missing", "expected_solution_missing", "answer_key_not_in_options", "correct_answer_text_unavailable", "solution_unavailable")
INVENTED = ("hallucinated", "hallucination_suspected")
QUARANTINED = ("quarantined", "quarantined_or_excluded", "rejected_bad_item")
BAD_ITEM = "bad_item_classes:"
CORRUPT = ("hallucinated", "noise_in_question_text", "cross_window", "table_extraction_corrupt", "weak_source_grounding")
STALE = "options_found:"
# --- fixed values: public codes, and the names that stand for them ---------------------------
PUBLIC = (
    "incomplete_options", "question_text_uncertain", "formula_ocr_uncertain", "table_ocr_uncertain", "visual_syntax_missing",
    "answer_key_not_in_options", "answer_solution_conflict", "expected_answer_missing", "expected_solution_missing",
    "question_missing_from_extraction", "chosen_option_not_correct_answer_source", "cross_window_option_leakage", "hallucination_suspected",
)
ALIASES = {
    "source_text_uncertain": "question_text_uncertain",
    "noise_in_question_text": "question_text_uncertain",
    "weak_source_grounding": "question_text_uncertain",
    "question_text_missing": "question_text_uncertain",
    "table_extraction_corrupt": "table_ocr_uncertain",
    "correct_answer_text_unavailable": "answer_key_not_in_options",
    "visual_required": "visual_syntax_missing",
    "original_visual_required": "visual_syntax_missing",
    "answer_unavailable": "expected_answer_missing",
    "missing_answer_answer_key_only_mode": "expected_answer_missing",
    "hallucinated": "hallucination_suspected",
    "cross_window": "cross_window_option_leakage",
    "cross_window_option_span_reuse": "cross_window_option_leakage",
}
FORMULA = r"(?i)\\frac|\\left|\\right|\\sqrt"
LONGEST = 64
#: Phrases of a question that needs a figure.
FIGURE_PHRASES = (
    "given figure", "given graph", "bar graph", "following graph", "study the following graph", "in the given figure", "diagram", "figure",
    "shaded region", "mirror image", "paper folding", "paper cutting", "answer figures", "answer figure",
)


def _any(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _name(issue: Column) -> Column:
    return F.lower(T.strip(F.coalesce(issue, F.lit(""))))


def is_invented(issue: Column) -> Column:
    """The issue says that text has no source."""
    return F.exists(F.array(F.lower(F.coalesce(issue, F.lit("")))), lambda low: _any(low.contains(m) for m in INVENTED))


def is_quarantined(issue: Column) -> Column:
    """The issue puts its item into quarantine."""
    return _name(issue).isin(*QUARANTINED) | _name(issue).startswith(BAD_ITEM)


def is_blocking(issue: Column) -> Column:
    """The issue keeps an item from being ready; issues of answers alone do not."""
    name = _name(issue)
    loose = is_invented(issue) | name.contains("cross_window") | name.startswith(BAD_ITEM) | (name.contains("corrupt") & name.contains("question"))
    return F.when(name.isin(*BLOCKING), True).when((name == "") | name.isin(*ANSWER_ONLY), False).otherwise(loose)


def is_corrupt(issue: Column) -> Column:
    """The issue says that the item's text is damaged."""
    return _any(issue.contains(m) for m in CORRUPT)


def _known(name: Column) -> Column:
    """The public code that a name is or stands for, else null."""
    codes = F.create_map(*(F.lit(x) for pair in ALIASES.items() for x in pair))
    return F.when(name.isin(*PUBLIC), name).otherwise(F.element_at(codes, name))


def _code(name: Column, text: Column) -> Column:
    slug = F.regexp_replace(F.regexp_replace(name, "[^a-z0-9]+", "_"), "^_+|_+$", "")
    prose = (F.char_length(name) > LONGEST) | (name.contains(" ") & ~name.contains(":"))
    table = name.contains("table") & (name.contains("chart") | name.contains("graph") | name.contains("corrupt"))
    formula = name.contains("formula") | (F.coalesce(text, F.lit("")).rlike(FORMULA) & name.contains("option"))
    other = (
        F.when(name.startswith(BAD_ITEM), "question_text_uncertain")
        .when(name.contains("hallucinat"), "hallucination_suspected")
        .when(name.contains("cross_window"), "cross_window_option_leakage")
        .when(name.contains("incomplete_options") | name.contains("option_incomplete"), "incomplete_options")
        .when(name.contains("answer_key_not_in_options"), "answer_key_not_in_options")
        .when(formula, "formula_ocr_uncertain")
        .when(table, "table_ocr_uncertain")
        .when(~prose, _known(slug))
    )
    return F.coalesce(_known(name), other)


def public_code(issue: Column, text: Column) -> Column:
    """The public code of an issue of an item with this question text; null if the issue is not published."""
    return _code(_name(issue), text)


def public_codes(issues: Column, text: Column) -> Column:
    """The public codes of an array of issues, each once, in order."""
    return F.array_distinct(F.array_compact(F.transform(F.transform(issues, _name), lambda n: _code(n, text))))


def figure_hits(text: Column, has_assets: Column) -> Column:
    """Why a question needs a figure: the phrases of its text, and whether one is attached."""
    low = F.array(F.lower(F.coalesce(text, F.lit(""))))
    hits = F.flatten(F.transform(low, lambda t: F.array(*(F.when(t.contains(p), F.lit(p)) for p in FIGURE_PHRASES))))
    return F.array_compact(F.concat(hits, F.array(F.when(has_assets, F.lit("visual_asset_present")))))
