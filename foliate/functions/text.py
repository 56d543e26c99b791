"""Column functions on lines of text: decoration, anchors, keys, classification.

All are built-in expressions, so they stay inside generated code.  White space
and digits are Unicode ones.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliate.functions import patterns as P


def uni(pattern: str) -> str:
    """``pattern`` with Unicode classes."""
    return "(?U)" + pattern


def has(text: Column, pattern: str) -> Column:
    return text.rlike(uni(pattern))


def part(text: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract(text, uni(pattern), group)


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.btrim(text, F.lit(P.WHITE))


def target(text: Column) -> Column:
    """Without list, bold and heading decoration, for matching only."""
    bare = F.regexp_replace(strip(text), uni(P.LIST_PREFIX), "")
    return strip(F.regexp_replace(F.regexp_replace(bare, uni(P.BOLD), "$1"), uni(P.HEADING), ""))


def target_of(bare: Column) -> Column:
    """:func:`target` of a stripped text, which most often has no decoration."""
    return F.when(bare.contains("**") | has(bare, P.MARK_LEAD), target(bare)).otherwise(bare)


def question_label(text: Column) -> Column:
    """``Q<number>`` if the undecorated text begins with a question anchor, else null."""
    found = [F.when(has(text, p), F.concat(F.lit("Q"), part(text, p))) for p in P.ANCHOR_PREFIXED]
    for p in P.ANCHOR_NUMERIC:
        rest = strip(part(text, p, 2))
        prose = (F.char_length(rest) >= 4) & ~has(rest, P.ANSWER_LIKE)
        found.append(F.when(has(text, p) & prose, F.concat(F.lit("Q"), part(text, p))))
    return F.when(has(text, P.QUESTION_LEAD), F.coalesce(*found))


class Rule(NamedTuple):
    """A line type with what it says about a line; the first rule whose condition holds counts."""

    holds: Column | None
    kind: str
    confidence: float
    label: Column | None = None
    issue: Column | None = None
    page: Column | None = None


def line_rules(raw: Column, bare: Column, plain: Column, plain_label: Column, plainer_label: Column, page_markers: bool = True, table_rows: bool = True) -> list[Rule]:
    """The rules in order.  ``bare`` is strip(raw), ``plain`` target(raw); the labels are
    question_label of plain and of target(plain)."""
    dot_rest = part(plain, P.OPTION_DOT, 2)
    rules = [Rule(bare == "", "blank", 1.0)]
    if page_markers:
        comment = raw.contains("<!--")
        rules += [Rule(holds, "page_number_marker", c, part(raw, p), page=part(raw, p).cast("int")) for p, c, holds in ((P.PAGE_NUMBER, 1.0, comment & has(raw, P.PAGE_NUMBER)), (P.MARKER_PAGE, 0.9, has(raw, P.MARKER_PAGE)))]
        rules.append(Rule(comment & has(raw, P.PAGE_BREAK), "page_break_marker", 1.0))
    rules += [
        Rule(bare.startswith("![") & has(raw, P.IMAGE_REF), "image_reference", 1.0),
        Rule(has(raw, P.MATH) | bare.endswith("$$"), "math_block", 0.95),
    ]
    if table_rows:
        rules.append(Rule(has(raw, P.TABLE_ROW), "table_row", 0.95))
    return [
        *rules,
        Rule(has(plain, P.SOLUTION_HEADING), "solution_section_heading", 0.95),
        Rule(plainer_label.isNotNull(), "question_anchor", 0.95, plainer_label),
        Rule(has(plain, P.SOLUTION_ANCHOR), "solution_anchor", 0.9, F.concat(F.lit("S"), part(plain, P.SOLUTION_ANCHOR)), F.when(has(plain, P.ANSWER_MARKER), "contains_answer_marker")),
        Rule(has(bare, P.HEADING), "heading", 0.95),
        Rule(plain_label.isNotNull(), "question_anchor", 0.95, plain_label),
        Rule((F.lower(F.substring(plain, 1, 3)) == "ans") & has(plain, P.ANSWER_MARKER), "answer_marker", 0.85, part(plain, P.ANSWER_MARKER)),
        Rule(has(plain, P.OPTION_PAREN), "option_candidate", 0.9, F.upper(part(plain, P.OPTION_PAREN))),
        Rule(has(plain, P.OPTION_CLOSE), "option_candidate", 0.85, F.upper(part(plain, P.OPTION_CLOSE)), F.lit("close_paren_option")),
        Rule(has(plain, P.OPTION_DOT) & dot_rest.rlike("[=^_]"), "text", 0.6, issue=F.lit("equation_like_content_low_confidence_option")),
        Rule(has(plain, P.OPTION_DOT), "option_candidate", 0.7, F.upper(part(plain, P.OPTION_DOT)), F.lit("dot_option_lower_confidence")),
        Rule(has(raw, P.FOOTER_GUARD) & has(raw, P.FOOTER), "page_footer_marker", 0.85),
        Rule(has(plain, P.METADATA), "metadata_candidate", 0.8),
        Rule(None, "text", 0.9),
    ]


def option_key(raw: Column) -> Column:
    """Canonical key A-E of an option label, look-alike letters included; null if there is none."""
    word = strip(F.regexp_replace(strip(raw), uni(P.OPTION_WORD), ""))
    formed = [F.when(has(word, p), F.upper(part(word, p))) for p in P.KEY_FORMS]
    single = F.translate(F.upper(F.regexp_replace(word, r"^[(). ]+|[(). ]+$", "")), *P.LOOK_ALIKES)
    return F.coalesce(*formed, F.when(single.rlike("^[A-E]$"), single))


def answer_key(raw: Column) -> Column:
    """Canonical key of an answer such as ``Ans (b)``, else that of an option label."""
    bare = strip(raw)
    return F.coalesce(F.when(has(bare, P.ANSWER_PREFIX), F.upper(part(bare, P.ANSWER_PREFIX))), option_key(raw))


def key_pairs(text: Column) -> Column:
    """Number of pairs like ``12. B`` that no digit or slash precedes."""
    return F.regexp_count(strip(text), F.lit(r"(?U)(?<![\d/])" + P.KEY_PAIR))


def is_answer_key_line(text: Column) -> Column:
    """A row or cell of an answer key, not a question."""
    text = F.coalesce(text, F.lit(""))
    bare, pairs = strip(text), key_pairs(text)
    short = F.char_length(bare)
    # every pair has the guard's point and letter; counting pairs is dear, and what one side of an AND repeats is computed ahead for every row, a branch is not
    return F.when(has(text, P.KEY_ROW_GUARD), (bare != "") & (has(bare, P.KEY_BARE) | (pairs >= 2) | ((pairs == 1) & (short < 48) & bare.contains("|")) | ((pairs == 1) & (short < 16)))).otherwise(False)


def is_contaminated(text: Column) -> Column:
    """A question text that looks like what is left of an answer key's table."""
    bare = strip(F.coalesce(text, F.lit("")))
    table = bare.startswith("|") & (key_pairs(bare) >= 1) & (F.char_length(bare) < 120) & ~has(bare, P.ASKING)
    return is_answer_key_line(bare) | table


def role_hints(raw: Column, plain: Column, plainer: Column) -> Column:
    """All roles a line may have, in order; empty for a blank line."""
    bare = strip(raw)
    rules = {
        "image_reference_candidate": has(bare, P.IMAGE_REF) & bare.startswith("!["),
        "table_candidate": has(bare, P.TABLE_ROW),
        "question_anchor_candidate": F.coalesce(question_label(plainer), question_label(plain)).isNotNull(),
        "option_label_candidate": has(plain, P.OPTION_PAREN) | has(plain, P.OPTION_CLOSE) | has(plain, P.OPTION_DOT) | has(bare, P.BOLD_OPTION),
        "answer_key_candidate": has(plain, P.KEY_NUMERIC) | has(plain, P.KEY_INLINE) | has(plain, P.ANSWER_MARKER),
        "solution_heading_candidate": has(plain, P.SOLUTION_HEADING),
        "section_heading_candidate": has(bare, P.SECTION_HEADING),
        "instruction_candidate": has(plain, P.INSTRUCTION),
        "advertisement_candidate": has(bare, P.ADVERTISEMENT),
        "download_link_candidate": has(bare, P.DOWNLOAD),
        "footer_candidate": has(bare, P.FOOTER),
        "metadata_candidate": has(plain, P.METADATA) | has(bare, P.METADATA_EXAM),
    }
    hints = F.array_compact(F.array(*(F.when(rule, F.lit(name)) for name, rule in rules.items())))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(hints)


def is_visual(text: Column) -> Column:
    """The wording asks for a figure."""
    # within the array the text is put in lower case once, not for every phrase
    return F.exists(F.array(F.lower(text)), lambda low: reduce(lambda a, b: a | b, (low.contains(p) for p in P.VISUAL_PHRASES)))
