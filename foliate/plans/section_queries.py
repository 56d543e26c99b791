"""Queries over sections, ranked question windows and solution windows, with their checking SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliate.functions import anchors as A
from foliate.functions import markers
from foliate.functions import patterns as P
from foliate.operators import sections as S
from foliate.plans import oracle_lines as OL
from foliate.plans import tables


def section_split(spark, sf_dir):
    """Where each document's solutions begin."""
    return S.section_split(tables.classified(spark, sf_dir))


def ranked_windows(spark, sf_dir):
    """The windows of the best-ranked anchors; as many questions are expected as the highest number of an anchor."""

    def made():
        lines = tables.classified(spark, sf_dir)
        anchors = tables.shared(spark, sf_dir, "anchors", lambda: S.question_anchors(lines))
        return S.windows(lines, S.selected_anchors(lines, anchors.groupBy("doc_id").agg(F.max("number").alias("expected_count")), anchors))

    return tables.shared(spark, sf_dir, "ranked-windows", made)


def question_windows(spark, sf_dir):
    """Question windows by the best-ranked anchor of each number, with what is among their lines."""
    out = ranked_windows(spark, sf_dir)
    return out.withColumn("line_numbers", F.concat_ws(",", F.transform("line_numbers", lambda x: x.cast("string"))))


def solution_windows(spark, sf_dir):
    """The solution of each number after the solution heading."""
    return S.solution_windows(tables.classified(spark, sf_dir))


def line_signals(spark, sf_dir):
    """How many lines of each document are what."""
    out = S.line_signals(tables.classified(spark, sf_dir))
    return out.groupBy("doc_id").agg(*(F.count_if(F.col(c)).alias(c) for c in out.columns[2:]))


QUERIES = {f.__name__: f for f in (section_split, question_windows, solution_windows, line_signals)}

_C = A.Checking
_BARE = A.stripped(_C, "raw")
_HEADS = f"""{OL.CLASSIFIED}, flagged AS MATERIALIZED (
  SELECT doc_id, line_number, page_number, raw, {A.heads_solutions(_C, 'raw')} AS heads, {A.starts_solution(_C, 'raw')} AS starts, {A.is_key_row(_C, 'raw')} AS key_row, {A.is_key_anchor(_C, 'raw')} AS key_anchor, {A.is_noise(_C, 'raw')} AS noise FROM classified
), sure AS (SELECT *, CASE WHEN bool_or(starts) OVER (PARTITION BY doc_id ORDER BY line_number ROWS BETWEEN 1 FOLLOWING AND {S.AHEAD} FOLLOWING) THEN {S.SURE} ELSE {S.UNSURE} END AS confidence FROM flagged
), heads AS (SELECT doc_id, line_number AS heading_line, CAST(confidence AS DOUBLE) AS confidence, CASE WHEN {OL.has(_BARE, P.SECTION_KEY)} THEN 'answer_key_section' WHEN contains(lower({_BARE}), 'explanation') THEN 'explanation_section' ELSE 'solution_section' END AS section_type
  FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY confidence DESC, line_number DESC) AS place FROM sure WHERE heads) WHERE place = 1
)"""
_MARKED = f"""{_HEADS}, numbered_anchors AS (
  SELECT * FROM (SELECT f.*, {A.anchor_number(_C, 'raw')} AS number FROM flagged f WHERE NOT noise AND {A.is_anchor(_C, 'raw')}) WHERE number IS NOT NULL
), steps AS (SELECT *, row_number() OVER (PARTITION BY doc_id, number ORDER BY line_number) AS k FROM numbered_anchors
), walked AS (
  SELECT doc_id, number, k, line_number, line_number AS last, true AS kept FROM steps WHERE k = 1
  UNION ALL SELECT s.doc_id, s.number, s.k, s.line_number, CASE WHEN s.line_number - w.last >= {S.DISTANCE} THEN s.line_number ELSE w.last END, s.line_number - w.last >= {S.DISTANCE} FROM walked w JOIN steps s ON s.doc_id = w.doc_id AND s.number = w.number AND s.k = w.k + 1
), anchors AS (SELECT n.* FROM numbered_anchors n JOIN walked w USING (doc_id, number, line_number) WHERE w.kept
), highest AS (SELECT doc_id, max(number) AS expected_count FROM anchors GROUP BY doc_id
), ranked AS (
  SELECT a.doc_id, a.number, a.line_number, NOT coalesce(a.line_number >= h.heading_line, false) OR (h.section_type = 'answer_key_section' AND {A.goes_on(_C, 'raw')}) AS early, {A.anchor_rank(_C, 'raw')} - CASE WHEN a.line_number >= h.heading_line THEN 10000 ELSE 0 END AS rank
  FROM anchors a LEFT JOIN heads h USING (doc_id) WHERE NOT starts AND NOT key_anchor
), best AS (SELECT doc_id, number, first(line_number ORDER BY rank DESC, line_number) AS anyhow, first(line_number ORDER BY rank DESC, line_number) FILTER (early) AS strict FROM ranked GROUP BY doc_id, number
), chosen AS (SELECT doc_id, count(strict) < floor(max(expected_count) * CAST({S.LEAST_SHARE} AS DOUBLE)) AND count(anyhow) > count(strict) AS fallback FROM best JOIN highest USING (doc_id) GROUP BY doc_id
), picked AS (SELECT doc_id, number, CASE WHEN fallback THEN anyhow ELSE strict END AS line_number FROM best JOIN chosen USING (doc_id)
)"""
#: CTEs up to ``wins``, the ranked windows with the number of their lines.
WINDOWS = f"""{_MARKED}, walled AS (
  SELECT f.doc_id, f.line_number, f.key_row, p.number, count(p.number) OVER (PARTITION BY f.doc_id ORDER BY f.line_number ROWS UNBOUNDED PRECEDING) AS win FROM flagged f LEFT JOIN picked p USING (doc_id, line_number)
), wins AS (
  SELECT doc_id, max(number) AS question_number, min(line_number) AS start_line, max(line_number) FILTER (NOT key_row) AS end_line, count(*) FILTER (NOT key_row) AS n_lines, printf('qw_%04d', CAST(win AS INT)) AS window_id FROM walled WHERE win > 0 GROUP BY doc_id, win
)"""
_META = f"({_BARE} <> '' AND NOT {{i}} AND ({OL.has(_BARE, markers.CHOSEN)} OR (contains(lower({_BARE}), 'chosen option') AND contains({_BARE}, ':'))))"
_PHRASED = " OR ".join(f"contains(lower({_BARE}), '{p}')" for p in markers.INSTRUCTION_PHRASES)
_META = _META.format(i=f"({OL.has(_BARE, markers.CHOSEN_INSTRUCTION)} OR {OL.has(_BARE, markers.SHEET_INSTRUCTION)} OR (contains(lower({_BARE}), 'chosen option') AND NOT contains({_BARE}, ':') AND ({_PHRASED})))")
ORACLES = {
    "section_split": f"""WITH {_HEADS}, sizes AS (SELECT doc_id, count(*) AS n FROM classified GROUP BY doc_id)
      SELECT doc_id, heading_line IS NOT NULL AS detected, heading_line, coalesce(section_type, 'question_section') AS section_type, coalesce(confidence, 0) AS confidence, coalesce(heading_line - 1, n)::BIGINT AS question_lines, coalesce(n - heading_line, 0)::BIGINT AS solution_lines FROM sizes LEFT JOIN heads USING (doc_id)""",
    "question_windows": f"""WITH RECURSIVE {_MARKED}, in_window AS (
      SELECT * FROM (SELECT f.*, p.number, count(p.number) OVER (PARTITION BY f.doc_id ORDER BY f.line_number ROWS UNBOUNDED PRECEDING) AS win FROM flagged f LEFT JOIN picked p USING (doc_id, line_number)) WHERE win > 0
      ), told AS (SELECT doc_id, win, max(number) AS question_number, min(line_number) AS start_line, max(line_number) FILTER (NOT key_row) AS end_line, coalesce(string_agg(line_number::VARCHAR, ',' ORDER BY line_number) FILTER (NOT key_row), '') AS line_numbers,
        CAST(len(list_distinct(flatten(coalesce(list({A.option_labels(_C, 'raw')}) FILTER (NOT key_row), [])))) AS INT) AS options_found, count(*) FILTER (NOT key_row AND NOT noise AND {A.is_option_line(_C, 'raw')}) AS option_lines,
        count(*) FILTER (NOT key_row AND NOT noise AND {_META}) AS chosen_lines, count(*) FILTER (NOT key_row AND NOT noise AND {A.is_status_line(_C, 'raw')}) AS status_lines FROM in_window GROUP BY doc_id, win)
      SELECT * EXCLUDE (win), printf('qw_%04d', CAST(win AS INT)) AS window_id, CASE WHEN options_found >= {S.FOUR} THEN 'ready' ELSE 'incomplete_options' END AS status, CASE WHEN options_found >= {S.FOUR} THEN CAST(0.8 AS DOUBLE) ELSE 0.4 END AS confidence FROM told""",
    "solution_windows": f"""WITH {_HEADS}, later AS (SELECT f.*, {A.is_solution_noise(_C, 'raw')} AS loud, {A.solution_label(_C, 'raw')} AS said, {A.solution_number(_C, 'raw')} AS own FROM flagged f JOIN heads USING (doc_id) WHERE line_number > heading_line
      ), begun AS (SELECT *, NOT loud AND starts AND own IS NOT NULL AND said IS NOT NULL AS begins FROM later
      ), in_window AS (SELECT *, count(*) FILTER (begins) OVER (PARTITION BY doc_id ORDER BY line_number ROWS UNBOUNDED PRECEDING) AS k FROM begun
      ), told AS (SELECT doc_id, k, max(own) FILTER (begins) AS question_number, max(said) FILTER (begins) AS answer_label, min(line_number) AS start_line, max(line_number) AS end_line, count(*) FILTER (NOT loud) AS n_lines, min(page_number) FILTER (NOT loud) AS page_start, max(page_number) FILTER (NOT loud) AS page_end FROM in_window WHERE k > 0 GROUP BY doc_id, k)
      SELECT * EXCLUDE (k, place), printf('sol_%04d', CAST(k AS INT)) AS solution_window_id FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, question_number ORDER BY k) AS place FROM told) WHERE place = 1""",
    "line_signals": f"""WITH {_HEADS} SELECT doc_id, count(*) FILTER (heads) AS heads_solutions, count(*) FILTER (starts) AS starts_solution, count(*) FILTER (key_row) AS key_row, count(*) FILTER (key_anchor) AS key_anchor, count(*) FILTER ({A.is_instruction(_C, 'raw')}) AS instruction, count(*) FILTER ({A.is_anchor(_C, 'raw')}) AS anchor,
      count(*) FILTER (noise) AS noise, count(*) FILTER ({A.is_option_line(_C, 'raw')}) AS option_line, count(*) FILTER ({A.is_status_line(_C, 'raw')}) AS status_line FROM flagged GROUP BY doc_id""",
}
