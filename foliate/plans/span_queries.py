"""Queries over spans of items and their validation, with their checking SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliate.functions import anchors as A
from foliate.functions import patterns as P
from foliate.operators import binding as B
from foliate.operators import spans
from foliate.plans import family_queries, package_queries, tables
from foliate.plans import oracle_lines as OL
from foliate.plans import oracle_packages as O
from foliate.plans import status_queries as SQ
from foliate.plans.evidence_queries import _key_sql


def _resolved(spark, sf_dir):
    """Items with their spans; the options of every second question come without their own lines, as a binder gives them."""

    def made():
        _, items = package_queries._items(spark, sf_dir)
        unbound = F.transform("options", lambda o: F.struct(o["key"].alias("key"), o["text"].alias("text"), F.when(F.col("seq") % 2 == 1, o["start_line"]).alias("start_line"), o["linked"].alias("linked")))
        own = items.select("doc_id", "question_id", "question_number", "question_text_raw", unbound.alias("options"), "answer_key", "solution")
        return spans.resolve_spans(own, family_queries.read_lines(spark, sf_dir))

    return tables.shared(spark, sf_dir, "spans", made)


def resolved_spans(spark, sf_dir):
    """Where every item's question and options stand in its ranked window."""
    out = _resolved(spark, sf_dir)
    told = F.transform("option_lines", lambda o: F.concat(F.coalesce(o["key"], F.lit("")), F.lit("@"), F.coalesce(o["line"].cast("string"), F.lit(""))))
    lines = F.array_join(F.transform("question_lines", lambda x: x.cast("string")), ",")
    return out.select("doc_id", "question_id", "question_number", "anchor_line", "matched_by", lines.alias("question_lines"), F.array_join(told, "+").alias("option_lines"), F.array_join("foreign_options", "+").alias("foreign_options"), "open_options")


def _validated(spark, sf_dir):
    """Items validated by their spans; an answer's source is the first line of its solution."""

    def made():
        found = _resolved(spark, sf_dir)
        options = F.transform(F.arrays_zip("options", "option_lines"), lambda z: F.struct(z["options"]["key"].alias("key"), z["options"]["text"].alias("text"), z["option_lines"]["line"].alias("line"), z["options"]["linked"].alias("asset")))
        solved, start = F.col("solution.raw_text").isNotNull(), F.col("solution.start_line")
        items = found.select(
            "doc_id", "question_id", "question_number", "question_text_raw", "question_lines", options.alias("options"), "answer_key", F.lit(None).cast("string").alias("answer_text"), F.when(start.isNotNull(), F.array(start)).alias("answer_lines"),
            F.when(solved, F.col("solution.raw_text")).alias("solution_text"), F.when(solved, F.sequence(start, F.col("solution.end_line"))).alias("solution_lines"),
        )
        return B.validate(items, tables.classified(spark, sf_dir))

    return tables.shared(spark, sf_dir, "validated", made)


def binding_validation(spark, sf_dir):
    """What is wrong with each item's sources, and its status."""
    return _validated(spark, sf_dir).withColumn("issues", F.array_join("issues", "+"))


def binding_counts(spark, sf_dir):
    """Each document's items by status and issue."""
    return B.validation_counts(_validated(spark, sf_dir))


QUERIES = {f.__name__: f for f in (resolved_spans, binding_validation, binding_counts)}

_part = lambda e, p: f"CASE WHEN {OL.has(e, p)} THEN regexp_extract({e}, {OL.q(p)}, 1) END"
_BARE, _NEAR = OL.strip("raw"), f"substr({OL.strip('raw')}, 1, {spans.NUMBER_WITHIN})"
_NUMBERS = ", ".join([*(_part(_NEAR, p) for p in P.NUMBER_PLACES), _part("raw", P.BOLD_ANCHOR)])
#: CTEs from the items to where their parts stand.
_SPANS = f"""{O.ITEMS}, {SQ._MARKED}, {family_queries.OPTION_LINES}, sp_rows AS (
  SELECT doc_id, question_number, line_number, raw, options, {SQ._matchable('raw')} AS m, CAST(coalesce({_part(_BARE, P.BLOCK_ANCHOR)}, {_part(_BARE, P.BOLD_ANCHOR)}) AS INT) AS number, list_filter([{_NUMBERS}], lambda x: x IS NOT NULL) AS numbers FROM fam_read_options
), sp_l AS MATERIALIZED (
  SELECT * EXCLUDE (number), CASE WHEN row_number() OVER (PARTITION BY doc_id, question_number, number ORDER BY line_number) = 1 THEN number END AS anchor FROM sp_rows
), sp_q AS (SELECT doc_id, seq, question_id, question_number, {SQ._matchable("coalesce(stem, '')")} AS q FROM items
), sp_i AS (SELECT *, substr(q, 1, {spans.SNIPPET}) AS snip FROM sp_q
), sp_a AS (
  SELECT i.doc_id, i.seq, i.question_id, i.question_number, i.q, i.snip, coalesce(min(l.line_number) FILTER (l.anchor = i.question_number), min(l.line_number) FILTER (list_contains(l.numbers, i.question_number::VARCHAR)), min(l.line_number) FILTER (i.snip <> '' AND contains(l.m, i.snip))) AS anchor_line
  FROM sp_i i LEFT JOIN sp_l l ON l.doc_id = i.doc_id AND l.question_number = i.question_number GROUP BY ALL
), sp_n AS (
  SELECT a.doc_id, a.seq, a.question_id, a.question_number, a.q, a.snip, a.anchor_line, min(l.line_number) AS next_line
  FROM sp_a a LEFT JOIN sp_l l ON l.doc_id = a.doc_id AND l.question_number = a.question_number AND l.anchor IS NOT NULL AND l.line_number > a.anchor_line GROUP BY ALL
), sp_b AS MATERIALIZED (
  SELECT n.seq, l.*, row_number() OVER (PARTITION BY n.doc_id, n.seq ORDER BY l.line_number) AS k, min(CASE WHEN len(l.options) > 0 THEN l.line_number END) OVER (PARTITION BY n.doc_id, n.seq) AS opt_line
  FROM sp_n n JOIN sp_l l ON l.doc_id = n.doc_id AND l.question_number = n.question_number AND l.line_number >= n.anchor_line AND (n.next_line IS NULL OR l.line_number < n.next_line)
), sp_s AS (
  SELECT doc_id, seq, string_agg(m, ' ' ORDER BY line_number) AS said, string_agg(line_number::VARCHAR, ',' ORDER BY line_number) AS stem_lines, list(line_number ORDER BY line_number) AS stem_list, arg_min(m, line_number) AS head, min(line_number) AS head_line, arg_min(numbers, line_number) AS head_numbers
  FROM sp_b WHERE CASE WHEN opt_line IS NULL THEN k <= {spans.STEM_LINES} ELSE line_number < opt_line END GROUP BY doc_id, seq
), sp_h AS (SELECT n.*, s.said, s.stem_lines, s.stem_list, s.head, s.head_line, s.head_numbers, s.head AS combined, [s.head] AS match_lines FROM sp_n n LEFT JOIN sp_s s USING (doc_id, seq)
), sp_m AS (
  SELECT *, CASE WHEN q <> '' AND contains(said, q) THEN 'block' WHEN q <> '' AND (contains(head, q) OR contains(q, head)) THEN 'anchor'
    WHEN q <> '' AND contains(head, snip) AND (question_number IS NULL OR list_contains(head_numbers, question_number::VARCHAR)) AND {SQ._found('q')} THEN 'snippet' ELSE 'none' END AS matched_by FROM sp_h
), sp_e0 AS (SELECT doc_id, seq, line_number, generate_subscripts(options, 1) AS nth, unnest(options) AS o FROM sp_b
), sp_e1 AS (SELECT *, row_number() OVER (PARTITION BY doc_id, seq, o.key ORDER BY line_number, nth) AS place FROM sp_e0
), sp_e AS (SELECT *, row_number() OVER (PARTITION BY doc_id, seq ORDER BY line_number, nth) AS r, {SQ._matchable('o.text')} AS m FROM sp_e1 WHERE place = 1
), sp_p AS (SELECT p.doc_id, p.seq, p.opt, p.part, p.key, p.text, p.linked, {SQ._matchable("coalesce(p.text, '')")} AS m, CASE WHEN p.seq % 2 = 1 THEN p.start_line END AS own, i.question_number FROM opts2 p JOIN items i ON i.doc_id = p.doc_id AND i.seq = p.seq
), sp_o AS (
  SELECT p.doc_id, p.seq, p.opt, p.part, p.key, p.text, p.linked, p.own, bool_or(l.line_number IS NOT NULL) AS inside, arg_min(e.line_number, e.r) AS found
  FROM sp_p p LEFT JOIN sp_l l ON l.doc_id = p.doc_id AND l.question_number = p.question_number AND l.line_number = p.own
  LEFT JOIN sp_e e ON e.doc_id = p.doc_id AND e.seq = p.seq AND e.r <= {spans.BLOCK_OPTIONS} AND CASE WHEN coalesce({OL.strip('p.key')}, '') = '' THEN p.m <> '' AND contains(e.m, p.m) ELSE e.o.key = upper(p.key) END
  GROUP BY ALL
), sp_t AS (SELECT *, CASE WHEN own IS NULL THEN found WHEN inside THEN own END AS line, own IS NOT NULL AND NOT inside AS away FROM sp_o
), sp_w AS (
  SELECT doc_id, seq, string_agg(coalesce(key, '') || '@' || coalesce(line::VARCHAR, ''), '+' ORDER BY opt, part) AS option_lines, string_agg(coalesce(key, ''), '+' ORDER BY opt, part) FILTER (away) AS foreign_options, count(*) FILTER (line IS NULL AND NOT away) AS open_options FROM sp_t GROUP BY doc_id, seq
)"""
_REFUSED = "CASE WHEN kind IN ('question', 'option') THEN 2 ELSE 1 END"
_NAMED = "CASE WHEN kind = 'option' THEN ':' || key ELSE '' END"
_BARE_KEY = f"regexp_replace({OL.strip('key')}, '\\.+$', '')"
_FINDINGS = f"""{_SPANS}, bv_parts AS (
  SELECT doc_id, m.seq, 0 AS nth, 'question' AS kind, '' AS key, coalesce(i.stem, '') AS text, CASE matched_by WHEN 'block' THEN stem_list WHEN 'none' THEN CAST([] AS INT[]) ELSE [head_line] END AS lines, false AS asset FROM sp_m m JOIN items i USING (doc_id, seq)
  UNION ALL SELECT doc_id, seq, 10 * row_number() OVER (PARTITION BY doc_id, seq ORDER BY opt, part), 'option', coalesce(key, ''), coalesce(text, ''), CASE WHEN line IS NULL THEN CAST([] AS INT[]) ELSE [line] END, linked FROM sp_t
  UNION ALL SELECT doc_id, seq, {B.ANSWER_AT}, 'answer', answer_key, '', CASE WHEN solved THEN [solution_line] ELSE CAST([] AS INT[]) END, false FROM items WHERE answered
  UNION ALL SELECT i.doc_id, i.seq, {B.SOLUTION_AT}, 'solution', '', coalesce(s.raw_text, ''), range(s.start_line, s.end_line + 1), false FROM items i JOIN solutions s ON s.doc_id = i.doc_id AND s.question_number = i.question_number AND s.start_line = i.solution_line WHERE s.raw_text IS NOT NULL
), bv_claims AS (SELECT doc_id, seq, nth, unnest(lines) AS line_number FROM bv_parts
), bv_held AS (SELECT doc_id, seq, nth, list({SQ._matchable('raw')} ORDER BY line_number) AS held FROM bv_claims JOIN classified USING (doc_id, line_number) GROUP BY doc_id, seq, nth
), bv_told AS (
  SELECT p.*, list_filter(coalesce(held, []), lambda x: x <> '') AS match_lines, array_to_string(list_filter(coalesce(held, []), lambda x: x <> ''), ' ') AS combined, {SQ._matchable('p.text')} AS m
  FROM bv_parts p LEFT JOIN bv_held USING (doc_id, seq, nth) WHERE kind <> 'option' OR {OL.strip('p.text')} <> '' OR {OL.strip('p.key')} <> ''
), bv_keys AS (SELECT doc_id, seq, count(*) AS n, list({_key_sql(OL.strip(f"regexp_replace({OL.strip('key')}, {OL.q(P.OPTION_WORD)}, '')"))}) AS keys FROM opts2 GROUP BY doc_id, seq
), bv_hints AS (SELECT doc_id, bool_or({A.is_option_line(A.Checking, 'raw')}) AS hinted FROM classified GROUP BY doc_id
), bv_items AS (
  SELECT i.doc_id, i.seq, i.question_id, i.question_number, i.answered, i.answer_key, coalesce(k.n, 0) AS n, list_filter(coalesce(k.keys, []), lambda x: x IS NOT NULL) AS keys, coalesce(h.hinted, false) AS hinted, count(i.question_number) OVER (PARTITION BY i.doc_id, i.question_number) AS same
  FROM items i LEFT JOIN bv_keys k USING (doc_id, seq) LEFT JOIN bv_hints h USING (doc_id)
), bv_found AS (
  SELECT doc_id, seq, nth + 1 AS nth, 'missing_' || kind || '_source_spans' || {_NAMED} AS issue, {_REFUSED} AS severity FROM bv_told WHERE len(lines) = 0 AND NOT asset
  UNION ALL SELECT doc_id, seq, nth + 1, 'hallucinated_' || kind || '_text' || {_NAMED}, 2 FROM bv_told WHERE len(lines) > 0 AND text <> '' AND NOT {SQ._found('m')}
  UNION ALL SELECT doc_id, seq, nth + 2, 'noise_in_question_text', 1 FROM bv_told WHERE kind = 'question' AND {OL.has('text', P.WINDOW_NOISE)}
  UNION ALL SELECT doc_id, seq, nth + 2, 'invalid_option_key:' || key, 1 FROM bv_told WHERE kind = 'option' AND {_BARE_KEY} <> '' AND upper({OL.strip(_BARE_KEY)}) NOT IN {SQ._in(B.KEYS)}
  UNION ALL SELECT doc_id, seq, {B.OPTIONS_AT}, 'missing_options', CASE WHEN hinted THEN 1 ELSE 2 END FROM bv_items WHERE n = 0
  UNION ALL SELECT doc_id, seq, {B.ANSWER_AT + 2}, 'answer_key_not_in_options', 1 FROM bv_items WHERE answered AND len(keys) > 0 AND NOT list_contains(keys, answer_key)
  UNION ALL SELECT doc_id, seq, {B.NUMBER_AT}, 'duplicate_question_number', 1 FROM bv_items WHERE same > 1
  UNION ALL SELECT doc_id, seq, {B.MODE_AT}, 'missing_answer_answer_key_only_mode', 1 FROM bv_items WHERE NOT answered
), bv_once AS (SELECT doc_id, seq, issue, min(nth) AS nth, max(severity) AS severity FROM bv_found GROUP BY doc_id, seq, issue
), bv_sums AS (SELECT doc_id, seq, list(issue ORDER BY nth, issue) AS issues, max(severity) AS worst FROM bv_once GROUP BY doc_id, seq
), bv AS (SELECT i.doc_id, i.question_id, i.question_number, coalesce(s.issues, CAST([] AS VARCHAR[])) AS issues, CASE coalesce(worst, 0) WHEN 0 THEN 'accepted' WHEN 1 THEN 'review_required' ELSE 'rejected' END AS status FROM bv_items i LEFT JOIN bv_sums s USING (doc_id, seq))"""
_HAVING = "sum(len(list_filter(issues, lambda x: {})))::BIGINT"
ORACLES = {
    "resolved_spans": f"""WITH RECURSIVE {_SPANS}
SELECT m.doc_id, m.question_id, m.question_number, m.anchor_line, m.matched_by, CASE matched_by WHEN 'block' THEN stem_lines WHEN 'none' THEN '' ELSE head_line::VARCHAR END AS question_lines, coalesce(option_lines, '') AS option_lines, coalesce(foreign_options, '') AS foreign_options, coalesce(open_options, 0) AS open_options
FROM sp_m m LEFT JOIN sp_w USING (doc_id, seq)""",
    "binding_validation": f"""WITH RECURSIVE {_FINDINGS} SELECT doc_id, question_id, question_number, array_to_string(issues, '+') AS issues, status FROM bv""",
    "binding_counts": f"""WITH RECURSIVE {_FINDINGS} SELECT doc_id, count(*) AS total, count(*) FILTER (status = 'accepted') AS accepted, count(*) FILTER (status = 'review_required') AS review_required, count(*) FILTER (status = 'rejected') AS rejected,
      {_HAVING.format("contains(x, '_source_spans')")} AS source_span_missing, {_HAVING.format("starts_with(x, 'hallucinated_')")} AS hallucination_suspected, {_HAVING.format("x = 'missing_options'")} AS option_key_missing, {_HAVING.format("x = 'answer_key_not_in_options'")} AS answer_key_not_in_options,
      count(question_number) - count(DISTINCT question_number) AS duplicate_numbers FROM bv GROUP BY doc_id""",
}
