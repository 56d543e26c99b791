"""Checking SQL for candidates, answers, solutions, mappings and packages, as CTEs to build on."""

from __future__ import annotations

from foliate.functions import patterns as P
from foliate.operators import mapping, packages, segment
from foliate.plans.oracle_lines import CONTENT, has, part, q, strip


def _in(values) -> str:
    return "(" + ", ".join(map(q, values)) + ")"


def _list(values) -> str:
    return "[" + ", ".join(map(q, values)) + "]"


_VISUAL = "(" + " OR ".join(f"contains(lower(%s), {q(p)})" for p in P.VISUAL_PHRASES) + ")"
_HEADED = f"(line_type = 'solution_section_heading' OR {has('plain', P.SOLUTION_HEADING)})"
_ROWS = "ORDER BY line_number ROWS UNBOUNDED PRECEDING"
_PAREN, _DOT = has("plain", P.PARSED_PAREN), has("plain", P.PARSED_DOT)


def visual(column: str) -> str:
    return _VISUAL.replace("%s", column)


CANDIDATES = f"""{CONTENT}, sectioned AS (
  SELECT *, min(line_number) FILTER ({_HEADED}) OVER (PARTITION BY doc_id) AS ss FROM content
), w AS (
  SELECT * FROM (SELECT *, count(*) FILTER (line_type = 'question_anchor') OVER (PARTITION BY doc_id {_ROWS}) AS seq FROM sectioned WHERE ss IS NULL OR line_number < ss) WHERE seq > 0
), o1 AS (
  SELECT *, count(*) FILTER (line_type = 'option_candidate') OVER (PARTITION BY doc_id, seq {_ROWS}) AS opt, line_type = 'option_candidate' AS head, {_PAREN} AS by_paren, {_DOT} AS by_dot FROM w
), o2 AS (
  SELECT *, CASE WHEN head THEN nullif(CASE WHEN by_paren THEN {part('plain', P.PARSED_PAREN, 2)} WHEN by_dot THEN {part('plain', P.PARSED_DOT, 2)} ELSE '' END, '')
                 WHEN line_type IN {_in(segment.CONTINUES)} THEN raw END AS piece FROM o1 WHERE opt > 0
), o3 AS (
  SELECT *, count(piece) OVER (PARTITION BY doc_id, seq, opt ORDER BY line_number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > 0 AS has_text FROM o2
), o4 AS (
  SELECT *, max(CASE WHEN NOT head AND ((line_type = 'image_reference' AND has_text) OR line_type NOT IN {_in([*segment.CONTINUES, *segment.PASSED, 'image_reference'])}) THEN 1 ELSE 0 END)
    OVER (PARTITION BY doc_id, seq, opt {_ROWS}) AS stopped FROM o3
), o5 AS (
  SELECT doc_id, seq, opt, max(CASE WHEN by_paren THEN upper({part('plain', P.PARSED_PAREN)}) WHEN by_dot THEN {part('plain', P.PARSED_DOT)} ELSE upper(detected_label) END) FILTER (head) AS key,
    coalesce(string_agg(piece, chr(10) ORDER BY line_number), '') AS text, min(line_number) AS start_line, max(line_number) FILTER (line_type NOT IN {_in(segment.PASSED)}) AS end_line, max(issue) FILTER (head) AS issue
  FROM o4 WHERE stopped = 0 GROUP BY doc_id, seq, opt
), o6 AS (
  SELECT *, list_transform(regexp_split_to_array({strip('text')}, {q(P.EMBEDDED_MARKER)}), lambda x: {strip('x')}) AS texts, regexp_extract_all({strip('text')}, {q(P.EMBEDDED_MARKER)}, 1) AS marks FROM o5
), o7 AS (
  SELECT *, list_concat(CASE WHEN texts[1] <> '' THEN [{{'key': upper(key), 'text': texts[1]}}] ELSE [] END, list_transform(marks, lambda m, i: {{'key': upper(m), 'text': texts[i + 1]}})) AS segs FROM o6
), o8 AS (
  SELECT *, key IS NOT NULL AND len(segs) > 1 AS was_split FROM o7
), opts AS (
  SELECT doc_id, seq, opt, start_line, end_line, issue, was_split, CAST(generate_subscripts(s, 1) AS INT) AS part, unnest(s).key AS key, unnest(s).text AS text
  FROM (SELECT *, CASE WHEN was_split THEN segs ELSE [{{'key': key, 'text': text}}] END AS s FROM o8)
), bounds AS (SELECT doc_id, seq, min(start_line) AS first_line, max(end_line) AS last_line FROM opts GROUP BY doc_id, seq
), pics0 AS (
  SELECT i.doc_id, i.seq, i.line_number, b.first_line, b.last_line,
    (SELECT arg_min({{'opt': o.opt, 'text': o.text}}, o.part) FROM opts o WHERE o.doc_id = i.doc_id AND o.seq = i.seq AND o.start_line = (SELECT max(p.start_line) FROM opts p WHERE p.doc_id = i.doc_id AND p.seq = i.seq AND p.start_line < i.line_number)) AS owner
  FROM w i LEFT JOIN bounds b ON b.doc_id = i.doc_id AND b.seq = i.seq WHERE i.line_type = 'image_reference'
), pics AS (
  SELECT *, CASE WHEN line_number < first_line THEN 'noise_candidate' WHEN owner IS NOT NULL AND {strip('owner.text')} = '' THEN 'option_image' WHEN line_number > last_line THEN 'noise_candidate' WHEN owner IS NOT NULL THEN 'noise_candidate' ELSE 'unknown' END AS role FROM pics0
), linked AS (SELECT DISTINCT doc_id, seq, owner.opt AS opt FROM pics WHERE role = 'option_image'
), opts2 AS (
  SELECT opts.*, linked.opt IS NOT NULL AS linked, NOT was_split AND {strip('text')} = '' AS blank FROM opts LEFT JOIN linked USING (doc_id, seq, opt)
), by_option AS (
  SELECT doc_id, seq, count(*) AS n_options, string_agg(coalesce(key, '?') || '=' || text, '|' ORDER BY opt, part) AS option_texts, list_sort(list_distinct(list(key) FILTER (key IS NOT NULL))) AS option_keys,
    bool_or(was_split) AS was_split, bool_or(NOT linked AND {strip('text')} = '') AS empty_option, bool_or(issue IS NOT NULL OR (blank AND NOT linked)) AS option_issue, bool_and(linked) AS all_linked, bool_and(text <> '') AS all_text,
    count(*) FILTER (key IS NOT NULL AND {strip('text')} <> '') AS usable
  FROM opts2 GROUP BY doc_id, seq
), by_image AS (
  SELECT doc_id, seq, count(*) AS assets, count(*) FILTER (role = 'noise_candidate') AS noise_assets, bool_or(role = 'unknown') AS unlabeled,
    bool_or(role = 'noise_candidate' AND line_number > last_line AND NOT line_number < first_line) AS late_image FROM pics GROUP BY doc_id, seq
), stems AS (
  SELECT *, max(CASE WHEN line_type IN {_in(segment.ENDS_STEM)} THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, seq {_ROWS}) = 0 AND line_type NOT IN {_in(segment.SKIPPED)} AS in_stem FROM w
), base AS (
  SELECT doc_id, seq, CAST(regexp_extract(arg_min(detected_label, line_number), '(\\d+)', 1) AS INT) AS question_number, string_agg(raw, chr(10) ORDER BY line_number) AS raw_text,
    coalesce(string_agg(raw, chr(10) ORDER BY line_number) FILTER (in_stem), '') AS stem, min(line_number) AS start_line, max(line_number) AS end_line, min(page_number) AS page_start, max(page_number) AS page_end, avg(confidence) AS confidence,
    list('noise_inside_candidate_line_' || line_number) FILTER (line_type IN ('page_footer_marker', 'noise_candidate')) AS noise
  FROM stems GROUP BY doc_id, seq
), whole AS (
  SELECT base.*, row_number() OVER (PARTITION BY doc_id, question_number ORDER BY seq) > 1 AS duplicate, n_options, option_texts, option_keys, coalesce(was_split, false) AS was_split, coalesce(empty_option, false) AS empty_option,
    coalesce(option_issue, false) AS option_issue, coalesce(all_linked, false) AS all_linked, coalesce(all_text, false) AS all_text, coalesce(usable, 0) AS usable, n_options IS NOT NULL AS has_options,
    coalesce(assets, 0) AS assets, coalesce(noise_assets, 0) AS noise_assets, coalesce(unlabeled, false) AS unlabeled, coalesce(late_image, false) AS late_image,
    coalesce(option_keys = {_list(segment.EXPECTED_KEYS)}, false) AS expected, {visual('stem')} AS visual
  FROM base LEFT JOIN by_option USING (doc_id, seq) LEFT JOIN by_image USING (doc_id, seq)
), seen AS (
  SELECT *, CASE WHEN NOT has_options AND assets > 0 THEN ['missing_options', 'source_backed_option_labels_missing', 'unlabeled_visual_assets']
      WHEN visual AND expected AND all_text THEN ['visual_question_requires_diagram_syntax'] WHEN expected AND all_linked THEN ['visual_question_requires_review']
      WHEN assets = 0 AND NOT visual THEN CAST([] AS VARCHAR[])
      ELSE list_filter([CASE WHEN visual AND has_options AND NOT expected THEN 'missing_option_labels_for_visual_question' END, CASE WHEN unlabeled THEN 'unlabeled_visual_assets' END,
        CASE WHEN empty_option THEN 'empty_option_text_without_asset' END, CASE WHEN has_options AND NOT expected THEN 'invalid_option_count' END], lambda x: x IS NOT NULL) END AS seen_issues FROM whole
), issued AS (
  SELECT *, list_sort(list_distinct(list_concat(list_filter([CASE WHEN duplicate THEN 'duplicate_question_number' END, CASE WHEN was_split THEN 'same_line_option_split_applied' END,
    CASE WHEN late_image THEN 'possible_noise_asset_after_options' END, CASE WHEN NOT has_options THEN 'missing_options' END], lambda x: x IS NOT NULL), coalesce(noise, CAST([] AS VARCHAR[])), seen_issues))) AS issues FROM seen
), candidates AS (
  SELECT *, printf('q_%04d', CAST(seq AS INT)) AS question_id, CASE WHEN duplicate THEN 'candidate_duplicate' WHEN {strip('stem')} = '' OR NOT has_options OR list_has_any(issues, {_list(segment.INCOMPLETE)}) THEN 'candidate_incomplete'
    WHEN len(list_filter(issues, lambda x: NOT list_contains({_list(segment.HARMLESS)}, x))) > 0 OR option_issue OR confidence < {segment.VALID_CONFIDENCE} THEN 'candidate_needs_review' ELSE 'candidate_valid' END AS review_status FROM issued
)"""

_ANCHORED = "^(?:" + mapping.FIND_ANCHOR + ")"


def _answer(expr: str) -> str:
    forms = [f"CASE WHEN {has(expr, p)} THEN {{'number': CAST({part(expr, p)} AS INT), 'key': upper({part(expr, p, 2)}), 'confidence': CAST({c} AS DOUBLE)}} END" for p, c in P.ANSWER_FORMS]
    return "coalesce(" + ", ".join(forms) + ")"


def _target(expr: str) -> str:
    from foliate.plans.oracle_lines import target

    return target(expr)


MAPPINGS = f"""{CANDIDATES}, mapped_section AS (SELECT *, min(line_number) FILTER (line_type = 'solution_section_heading' OR {has('plain', P.MAPPED_HEADING)}) OVER (PARTITION BY doc_id) AS ms FROM content
), sol_lines AS (SELECT * FROM mapped_section WHERE ms IS NULL OR line_number >= ms
), sol_pieces AS (
  SELECT doc_id, line_number, page_number, CAST(generate_subscripts(p, 1) AS INT) AS part, unnest(p) AS piece
  FROM (SELECT *, string_split(regexp_replace(raw, {q('(' + mapping.FIND_ANCHOR + ')')}, chr(1) || '\\1', 'g'), chr(1)) AS p FROM sol_lines)
), sol_numbered AS (
  SELECT *, CASE WHEN {has('piece', _ANCHORED)} THEN CAST({part('piece', _ANCHORED)} AS INT) END AS number FROM sol_pieces
), sol_grouped AS (
  SELECT * FROM (SELECT *, count(number) OVER (PARTITION BY doc_id ORDER BY line_number, part ROWS UNBOUNDED PRECEDING) AS sol FROM sol_numbered) WHERE sol > 0
), solutions AS (
  SELECT doc_id, sol, max(number) AS question_number, string_agg(piece, chr(10) ORDER BY line_number, part) FILTER (piece <> '') AS raw_text, min(line_number) AS start_line, max(line_number) FILTER (piece <> '') AS end_line FROM sol_grouped GROUP BY doc_id, sol
), keyed0 AS (
  SELECT *, {has('plain', P.COMPACT_KEY)} AS compact FROM sol_lines
), keyed1 AS (
  SELECT *, sum(CASE WHEN compact THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id {_ROWS}) AS island FROM keyed0
), keyed AS (
  SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, island) AS length FROM keyed1 WHERE compact) WHERE length >= 2
), answers AS (
  SELECT doc_id, CAST({part('plain', P.COMPACT_KEY)} AS INT) AS question_number, upper({part('plain', P.COMPACT_KEY, 2)}) AS answer_key, CAST({mapping.COMPACT_CONFIDENCE} AS DOUBLE) AS confidence, line_number AS source_line FROM keyed
  UNION ALL
  SELECT doc_id, found.number, found.key, found.confidence, start_line FROM (
    SELECT s.doc_id, s.start_line, coalesce({_answer('c.plain')}, {_answer(_target('s.raw_text'))}) AS found FROM solutions s JOIN content c ON c.doc_id = s.doc_id AND c.line_number = s.start_line) WHERE found IS NOT NULL
), best_answers AS (
  SELECT doc_id, question_number, count(DISTINCT answer_key) > 1 AS conflict, CASE WHEN count(DISTINCT answer_key) = 1 THEN min(answer_key) END AS answer_key,
    CASE WHEN count(DISTINCT answer_key) = 1 THEN max(confidence) END AS answer_confidence FROM answers GROUP BY doc_id, question_number
), best_solutions AS (
  SELECT doc_id, question_number, count(*) AS solutions, min(start_line) AS solution_line, count(DISTINCT coalesce(CASE WHEN f.number = question_number THEN f.key END, '')) <= 1 AS answers_identical, count(DISTINCT coalesce(raw_text, '')) <= 1 AS texts_identical
  FROM (SELECT *, {_answer(_target('raw_text'))} AS f FROM solutions) GROUP BY doc_id, question_number
), mapped0 AS (
  SELECT c.*, count(*) OVER (PARTITION BY c.doc_id, c.question_number) > 1 AS twice, coalesce(a.conflict, false) AS conflict, a.answer_key, a.answer_confidence, coalesce(s.solutions, 0) AS solutions, coalesce(NOT (s.answers_identical AND s.texts_identical), false) AS solution_conflict, s.solution_line,
    a.answer_key IS NOT NULL AS answered, s.solution_line IS NOT NULL AS solved, a.answer_key IS NOT NULL AND a.answer_confidence < {mapping.LOW_ANSWER} AS low
  FROM candidates c LEFT JOIN best_answers a USING (doc_id, question_number) LEFT JOIN best_solutions s USING (doc_id, question_number)
), mappings AS (
  SELECT *, CASE WHEN conflict OR twice THEN 'duplicate_conflict' WHEN NOT answered AND NOT solved THEN 'not_available' WHEN low THEN 'needs_review' WHEN answered AND solved THEN 'mapped' WHEN answered THEN 'answer_only_mapped' ELSE 'solution_only_mapped' END AS mapping_status,
    (coalesce(answer_confidence, 0) + CASE WHEN solved THEN CAST({mapping.SOLUTION_CONFIDENCE} AS DOUBLE) ELSE 0 END + confidence) / (1 + CAST(answered AS INT) + CAST(solved AS INT)) AS mapping_confidence,
    list_filter([CASE WHEN conflict THEN 'conflicting_answer_keys' END, CASE WHEN twice THEN 'duplicate_question_candidate_number' END, CASE WHEN low THEN 'low_confidence_answer' END], lambda x: x IS NOT NULL) AS extra FROM mapped0
)"""

ITEMS = f"""{MAPPINGS}, items0 AS (
  SELECT * EXCLUDE (issues), answered AND len(option_keys) > 0 AND NOT list_contains(option_keys, answer_key) AS mismatch0, list_concat(issues, extra) AS issues0 FROM mappings
), items1 AS (
  SELECT *, list_sort(list_distinct(list_concat(issues0, list_filter([CASE WHEN coalesce(mismatch0, false) THEN 'answer_option_mismatch' END, CASE WHEN {strip('stem')} = '' THEN 'missing_question_text' END], lambda x: x IS NOT NULL)))) AS issues FROM items0
), items AS (
  SELECT *, CASE WHEN mapping_status = 'duplicate_conflict' OR review_status = 'candidate_duplicate' THEN 'duplicate_conflict' WHEN review_status = 'candidate_incomplete' OR NOT has_options THEN 'incomplete'
    WHEN mapping_status = 'needs_review' OR review_status = 'candidate_needs_review' OR list_contains(issues, 'answer_option_mismatch') OR len(list_filter(issues, lambda x: contains(x, 'noise_inside'))) > 0
      OR confidence < {packages.ITEM_CONFIDENCE} OR mapping_confidence < {packages.ITEM_CONFIDENCE} THEN 'needs_review'
    WHEN NOT answered AND mapping_status = 'not_available' THEN 'question_only_validated' WHEN answered THEN 'validated' ELSE 'needs_review' END AS validation_status,
    (confidence + mapping_confidence + coalesce(answer_confidence, 0) + CASE WHEN solved THEN CAST({mapping.SOLUTION_CONFIDENCE} AS DOUBLE) ELSE 0 END) / (2 + CAST(answered AS INT) + CAST(solved AS INT)) AS item_confidence FROM items1
)"""

LANES = f"""{ITEMS}, reasons AS (
  SELECT *, list_sort(list_distinct(list_concat(list_filter(issues, lambda x: list_contains({_list(packages.BLOCKING)}, x)), list_filter([CASE WHEN {strip('stem')} = '' THEN 'missing_question_text' END,
      CASE WHEN validation_status = 'incomplete' THEN 'validation_incomplete' END, CASE WHEN validation_status = 'duplicate_conflict' THEN 'validation_duplicate_conflict' END, CASE WHEN solutions > 1 AND solution_conflict THEN 'duplicate_solution_conflict' END], lambda x: x IS NOT NULL)))) AS blocking_reasons,
    list_sort(list_distinct(list_concat(list_filter(issues, lambda x: list_contains({_list(packages.REVIEWED)}, x)), list_filter([CASE WHEN validation_status = 'needs_review' THEN 'validation_needs_review' END,
      CASE WHEN (visual OR assets > 0) AND NOT list_has_any(issues, {_list(packages.BLOCKING)}) AND validation_status <> 'validated' THEN 'visual_question_uncertain' END, CASE WHEN solutions > 1 AND NOT solution_conflict THEN 'duplicate_solution_harmless' END, CASE WHEN NOT answered THEN 'question_only_no_answer' END,
      CASE WHEN item_confidence < {packages.ELIGIBLE_CONFIDENCE} THEN 'low_confidence' END], lambda x: x IS NOT NULL)))) AS review_reasons FROM items
), lanes AS (
  SELECT *, CASE WHEN len(blocking_reasons) > 0 THEN 'blocked' WHEN len(review_reasons) > 0 THEN 'review_required' ELSE 'eligible_for_ingestion' END AS eligibility_status FROM reasons
)"""
