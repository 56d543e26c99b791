"""Queries on gates, extra and bad items, filling, thresholds and gaps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from foliate.operators import export as X
from foliate.operators import gates as G
from foliate.operators import packages as K
from foliate.plans import evidence_queries as EQ
from foliate.plans import oracle_lines as OL
from foliate.plans import oracle_packages as O
from foliate.plans import package_queries as PQ
from foliate.plans.lineage import durable


def _items(spark, sf_dir):
    items = PQ._items(spark, sf_dir)[1]
    return items, PQ._expected(items)


def acceptance_gate(spark, sf_dir):
    """Quality and gate issues of every item."""
    out = G.acceptance(_items(spark, sf_dir)[0])
    return out.select("doc_id", "question_id", "usable_options", "answer_text", F.concat_ws("+", "gate_issues").alias("gate_issues"), "quality")


def count_reconciliation(spark, sf_dir):
    """Expected against actual counts by document."""
    out = G.count_reconciliation(*_items(spark, sf_dir))
    return out.withColumn("extra_numbers", F.concat_ws(",", F.transform("extra_numbers", lambda x: x.cast("string"))))


def bad_items(spark, sf_dir):
    """Items that are quarantined."""
    out = G.bad_items(*_items(spark, sf_dir))
    return out.withColumn("classes", F.concat_ws("+", "classes"))


def filled_items(spark, sf_dir):
    """Items of validated candidates, filled from question windows."""
    items, _ = _items(spark, sf_dir)
    return G.filled(items.where("validation_status in ('validated', 'needs_review')"), EQ._windows(spark, sf_dir))


def threshold_violations(spark, sf_dir):
    """Shares below their thresholds by document."""
    items, expected = _items(spark, sf_dir)
    return G.threshold_violations(G.acceptance(items), expected).withColumn("violations", F.concat_ws("+", "violations"))


def answer_gaps(spark, sf_dir):
    """Questions without an answer and why."""
    return G.answer_gaps(PQ._mapped(spark, sf_dir)[1])


def eligibility_modes(spark, sf_dir):
    """Lane and reasons of every question for each mode of answers, with those that the review export names."""
    items, _ = _items(spark, sf_dir)
    named = durable(X.review_items(items).select("doc_id", "question_id"), "review-ids")
    lanes = [K.eligibility(items, mode, named).withColumn("mode", F.lit(mode)) for mode in K.ANSWER_MODES]
    out = reduce(lambda a, b: a.unionByName(b), lanes)
    return out.select("doc_id", "question_id", "mode", "eligibility_status", *(F.array_join(c, "+").alias(c) for c in ("blocking_reasons", "review_reasons", "eligibility_reasons")))


QUERIES = {f.__name__: f for f in (eligibility_modes, acceptance_gate, count_reconciliation, bad_items, filled_items, threshold_violations, answer_gaps)}

_EXPECTED = PQ._EXPECTED
_NOTICE = OL.has(OL.strip("stem"), G.NOTICE)
_GATED = f"""{O.ITEMS}, texts AS (SELECT doc_id, seq, key, arg_min({OL.strip('text')}, opt * 1000 + part) AS answer_text FROM opts WHERE {OL.strip('text')} <> '' GROUP BY doc_id, seq, key
), gated AS (SELECT i.*, t.answer_text, {OL.strip('stem')} = '' AS blank, usable < 4 AS few, answered AND t.answer_text IS NULL AS lost FROM items i LEFT JOIN texts t ON t.doc_id = i.doc_id AND t.seq = i.seq AND t.key = i.answer_key)"""
_EXTRA = f"""{O.ITEMS}, {_EXPECTED}, extra AS (SELECT doc_id, question_number, CASE WHEN question_number IS NULL THEN 'n' WHEN question_number < 1 OR question_number > expected_count THEN 'o' WHEN seq > expected_count THEN 'e' END AS reason FROM items JOIN expected USING (doc_id))"""
_WINDOW_CTES = EQ._WINDOWS.split(OL.CLASSIFIED, 1)[1].lstrip(", ")
_PAIRS = f"len(regexp_extract_all({OL.strip('stem')}, {OL.q('(?:^|[^0-9/])' + OL.P.KEY_PAIR)}))"
_BARE = OL.strip("stem")
_KEY_LINE = f"({_BARE} <> '' AND ({OL.has(_BARE, OL.P.KEY_BARE)} OR {_PAIRS} >= 2 OR ({_PAIRS} = 1 AND length({_BARE}) < 48 AND contains({_BARE}, '|')) OR ({_PAIRS} = 1 AND length({_BARE}) < 16)))"
_MODES = ", ".join(f"('{m}')" for m in K.ANSWER_MODES)
ORACLES = {
    "eligibility_modes": f"""WITH {O.LANES}, named AS (SELECT doc_id, question_id FROM ({EQ.ORACLES['review_export']})), em AS (
      SELECT r.doc_id, r.question_id, m.mode, r.answered, list_sort(list_concat(blocking_reasons, CASE WHEN mode = 'required' AND NOT answered THEN ['missing_answer_required_mode'] ELSE [] END)) AS b,
        list_sort(list_concat(list_concat(list_filter(review_reasons, lambda x: x <> 'question_only_no_answer' OR mode = 'optional'), CASE WHEN mode = 'required' AND NOT solved THEN ['missing_solution'] ELSE [] END), CASE WHEN n.question_id IS NOT NULL THEN ['review_export_flagged'] ELSE [] END)) AS v
      FROM reasons r CROSS JOIN (VALUES {_MODES}) m(mode) LEFT JOIN named n ON n.doc_id = r.doc_id AND n.question_id = r.question_id
      ), el AS (SELECT *, CASE WHEN len(b) > 0 THEN 'blocked' WHEN len(v) > 0 THEN 'review_required' ELSE 'eligible_for_ingestion' END AS eligibility_status FROM em)
      SELECT doc_id, question_id, mode, eligibility_status, array_to_string(b, '+') AS blocking_reasons, array_to_string(v, '+') AS review_reasons,
        array_to_string(list_sort(list_distinct(list_concat(list_concat(b, v), list_filter([CASE WHEN eligibility_status = 'eligible_for_ingestion' THEN 'clean_validated_item' END, CASE WHEN mode = 'question_only' AND NOT answered THEN 'question_only_mode' END], lambda x: x IS NOT NULL)))), '+') AS eligibility_reasons FROM el""",
    "acceptance_gate": f"""WITH {_GATED} SELECT doc_id, question_id, CAST(usable AS INT) AS usable_options, answer_text, concat_ws('+', CASE WHEN few THEN 'incomplete_options' END, CASE WHEN lost THEN 'correct_answer_text_unavailable' END, CASE WHEN blank THEN 'question_text_missing' END) AS gate_issues,
      CASE WHEN blank THEN 'blocked' WHEN visual THEN 'visual_required' WHEN few OR lost THEN 'review_required' WHEN NOT answered THEN 'answer_unavailable' ELSE 'accepted_safe' END AS quality FROM gated""",
    "count_reconciliation": f"""WITH {_EXTRA}, x AS (SELECT doc_id, count(reason) AS extra_items, coalesce(array_to_string(list_sort(list_distinct(list(question_number) FILTER (reason IS NOT NULL AND question_number IS NOT NULL))), ','), '') AS extra_numbers, count(*) AS actual FROM extra GROUP BY doc_id)
      SELECT doc_id, expected_count, actual, actual = expected_count AS count_match, greatest(0, actual - expected_count) AS overflow, extra_items, extra_numbers FROM x JOIN expected USING (doc_id)""",
    "bad_items": f"""WITH {O.ITEMS}, {_EXPECTED}, b AS (SELECT doc_id, question_id, question_number, concat_ws('+', CASE WHEN question_number < 1 OR question_number > expected_count THEN 'question_number_out_of_range' END, CASE WHEN row_number() OVER (PARTITION BY doc_id, question_number ORDER BY seq) > 1 THEN 'duplicate_question_number' END,
      CASE WHEN {_KEY_LINE} THEN 'answer_key_without_question' END, CASE WHEN {_NOTICE} THEN 'noise_or_ad_as_question' END, CASE WHEN {_BARE} = '' THEN 'empty_question_text' END) AS classes FROM items JOIN expected USING (doc_id)) SELECT * FROM b WHERE classes <> ''""",
    "filled_items": f"""WITH RECURSIVE {O.ITEMS}, {_WINDOW_CTES}, own AS (SELECT doc_id, question_number, question_id FROM items WHERE validation_status IN ('validated', 'needs_review')), u AS (
      SELECT doc_id, question_number, 'item' AS origin, question_id AS ref FROM own UNION ALL SELECT doc_id, question_number, 'window', window_id FROM wins ANTI JOIN own USING (doc_id, question_number))
      SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY coalesce(question_number, 0), origin, ref) AS INT) AS global_order FROM u""",
    "threshold_violations": f"""WITH {_GATED}, {_EXPECTED}, s AS (SELECT doc_id, count(*) AS items, count(*) FILTER (usable >= 4) AS with_four, count(*) FILTER (answered) AS answered FROM gated GROUP BY doc_id)
      SELECT doc_id, expected_count, items, with_four, answered, concat_ws('+', CASE WHEN items / expected_count < {G.MIN_ITEMS} THEN 'item_count' END, CASE WHEN with_four / expected_count < {G.MIN_FOUR_OPTIONS} THEN 'four_options' END, CASE WHEN answered / expected_count < {G.MIN_ANSWERS} THEN 'answers' END) AS violations
      FROM expected JOIN s USING (doc_id) WHERE expected_count > 0""",
    "answer_gaps": f"WITH {O.MAPPINGS} SELECT doc_id, question_id, question_number, CASE WHEN conflict THEN 'conflicting_answers' WHEN solved THEN 'solution_without_answer' ELSE 'no_entry' END AS reason FROM mappings WHERE NOT answered",
}
