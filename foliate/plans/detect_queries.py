"""Queries on answer-key evidence, numeric options, layouts, sanity and coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliate.operators import detect as D
from foliate.operators import segment as S
from foliate.plans import evidence_queries as EQ
from foliate.plans import oracle_lines as OL
from foliate.plans import oracle_packages as O
from foliate.plans import package_queries as PQ
from foliate.plans import tables
from foliate.plans.lineage import durable


def answer_key_candidates(spark, sf_dir):
    """Pairs of question number and key in lines of keys and answers."""
    lines = tables.classified(spark, sf_dir)
    n = F.col("line_number")
    letter = lambda k: F.substring(F.lit("abcdABCD"), ((n + k) % 8 + 1).cast("int"), F.lit(1))
    row = F.concat(n, F.lit(". "), letter(0), F.lit(" | "), n + 1, F.lit(") "), letter(3), F.lit(" 3/4. A"))
    key_row = (F.col("doc_id") + n) % 7 == 3
    return D.answer_key_candidates(lines.withColumns({c: F.when(key_row, row).otherwise(F.col(c)) for c in ("raw", "plain")}))


def _numbered():
    n = F.col("line_number") + F.col("doc_id")
    key, rest = (n % 6 + 1).cast("string"), F.col("raw")
    return F.when(n % 5 == 0, F.concat(key, F.lit(". "), rest)).when(n % 5 == 1, F.concat(F.lit("Ans "), key, F.lit(") "), rest)).when(n % 5 == 2, F.concat(F.lit("( "), key, F.lit(" )<br>"), rest)).when(n % 5 == 3, F.concat(key, F.lit(" "), rest)).otherwise(F.concat(F.lit("answer"), key, F.lit("."), rest))


def numeric_options(spark, sf_dir):
    """Options with numbers for keys."""
    lines = tables.classified(spark, sf_dir).where("line_type = 'option_candidate'").select("doc_id", "line_number", D.numeric_option(_numbered()).alias("o"))
    return lines.select("doc_id", "line_number", "o.key", "o.canonical_key", "o.text")


def layout_signals(spark, sf_dir):
    """Marks of response sheets by document."""
    lines = tables.classified(spark, sf_dir)
    sheet = F.when((F.col("doc_id") % 9 == 2) & (F.col("line_number") % 7 == 3), F.concat(F.lit("Question ID : "), F.col("line_number"))).when((F.col("doc_id") % 11 == 4) & (F.col("line_number") % 5 == 2), "Chosen Option : B").otherwise(F.col("raw"))
    out = D.layouts(durable(lines.withColumn("raw", sheet), "sheets"))
    return out.withColumn("repeated_numbers", F.concat_ws(",", F.transform("repeated_numbers", lambda x: x.cast("string"))))


def section_sanity(spark, sf_dir):
    """Whether each document has about as many windows and solutions as expected."""
    cands = PQ._candidates(spark, sf_dir)[1]
    return D.section_sanity(PQ._expected(cands), EQ._windows(spark, sf_dir), PQ._solutions(spark, sf_dir))


def question_coverage(spark, sf_dir):
    """Expected question numbers without a candidate."""
    cands = PQ._candidates(spark, sf_dir)[1]
    return D.coverage(PQ._expected(cands), cands)


QUERIES = {f.__name__: f for f in (answer_key_candidates, numeric_options, layout_signals, section_sanity, question_coverage)}

_LETTER = "substr('abcdABCD', CAST((line_number + {}) % 8 + 1 AS INT), 1)"
_KEY_ROW = f"line_number || '. ' || {_LETTER.format(0)} || ' | ' || (line_number + 1) || ') ' || {_LETTER.format(3)} || ' 3/4. A'"
_OPENS = f"({OL.has('bare', D.KEY_HEADING)} OR (line_type = 'solution_section_heading' AND contains(lower(bare), 'answer')))"
_KEYED = " OR ".join(OL.has("plain", p) for p in (OL.P.KEY_NUMERIC, OL.P.KEY_INLINE, OL.P.ANSWER_MARKER))
_SAFE = "regexp_replace(bare, '([\\d/])(\\d{1,3}\\s*[\\.\\)\\-]\\s*[A-Da-d]\\b)', '\\1#\\2', 'g')"
_FREE = r"(?:^|[^\d/#])" + D.NUMERIC_KEY


def _found(text: str, pattern: str, rank: int) -> str:
    p = OL.q(pattern)
    return f"list_transform(list_zip(regexp_extract_all({text}, {p}, 1), regexp_extract_all({text}, {p}, 2)), lambda z: {{'rank': {rank}, 'n': CAST(z[1] AS INT), 'k': upper(z[2])}})"


_EVERY = f"list_concat(list_concat({_found('bare', _FREE, 0)}, {_found('bare', D.Q_KEY, 1)}), {_found('bare', D.MARKED_KEY, 2)})"
_OPTION_TEXT = "CASE n % 5 WHEN 0 THEN key || '. ' || rest WHEN 1 THEN 'Ans ' || key || ') ' || rest WHEN 2 THEN '( ' || key || ' )<br>' || rest WHEN 3 THEN key || ' ' || rest ELSE 'answer' || key || '.' || rest END"
_BARE = OL.strip("regexp_replace(t, '(?i)<br\\s*/?>', ' ', 'g')")
_FORM = lambda g: f"CASE WHEN {OL.has('b', D.NUMERIC_OPTION)} THEN {OL.part('b', D.NUMERIC_OPTION, g)} WHEN {OL.has('b', D.PAREN_OPTION)} THEN {OL.part('b', D.PAREN_OPTION, g)} END"
_EXPECTED = "expected AS (SELECT doc_id, CAST(count(*) + doc_id % 4 - 1 AS INT) AS expected_count FROM candidates GROUP BY doc_id)"
_SHEET_RAW = "CASE WHEN doc_id % 9 = 2 AND line_number % 7 = 3 THEN 'Question ID : ' || line_number WHEN doc_id % 11 = 4 AND line_number % 5 = 2 THEN 'Chosen Option : B' ELSE raw END"
_METADATA = f"(b <> '' AND NOT {EQ._INSTR} AND ({OL.has('b', EQ.markers.CHOSEN)} OR (contains(lower(b), 'chosen option') AND contains(b, ':'))))"
_WINDOW_CTES = EQ._WINDOWS.split(OL.CLASSIFIED, 1)[1].lstrip(", ")
ORACLES = {
    "answer_key_candidates": f"""WITH {OL.CLASSIFIED}, keys AS (SELECT doc_id, line_number, line_type, CASE WHEN (doc_id + line_number) % 7 = 3 THEN {_KEY_ROW} ELSE raw END AS raw, CASE WHEN (doc_id + line_number) % 7 = 3 THEN {_KEY_ROW} ELSE plain END AS plain FROM classified), bared AS (SELECT *, {OL.strip('raw')} AS bare FROM keys), s AS (SELECT *, bool_or({_OPENS}) OVER (PARTITION BY doc_id ORDER BY line_number ROWS UNBOUNDED PRECEDING) AS in_section, len(regexp_extract_all({_SAFE}, {OL.q(_FREE)}, 0)) AS pairs FROM bared WHERE bare <> ''
      ), e AS (SELECT doc_id, line_number, in_section, {_EVERY} AS ev FROM s WHERE in_section OR {_KEYED} OR pairs >= 2 OR (pairs = 1 AND length(bare) < 40 AND {OL.has('bare', D.LONE_KEY)})
      ), f AS (SELECT doc_id, line_number, in_section, generate_subscripts(ev, 1) AS pos, unnest(ev) AS f FROM e)
      SELECT doc_id, f.n AS question_number, f.k AS answer_key, line_number, CASE WHEN in_section THEN CAST(0.9 AS DOUBLE) ELSE 0.75 END AS confidence FROM f WHERE f.n BETWEEN 1 AND {D.MOST_NUMBER} QUALIFY row_number() OVER (PARTITION BY doc_id, f.n, f.k ORDER BY line_number, pos) = 1""",
    "numeric_options": f"""WITH {OL.CLASSIFIED}, n AS (SELECT doc_id, line_number, line_number + doc_id AS n, CAST((line_number + doc_id) % 6 + 1 AS STRING) AS key, raw AS rest FROM classified WHERE line_type = 'option_candidate'), t AS (SELECT doc_id, line_number, {_OPTION_TEXT} AS t FROM n), b AS (SELECT doc_id, line_number, {_BARE} AS b FROM t),
      k AS (SELECT doc_id, line_number, {_FORM(1)} AS key, {OL.strip(_FORM(2))} AS text FROM b) SELECT doc_id, line_number, key, CASE WHEN regexp_full_match(key, '[1-4]') THEN translate(key, '1234', 'ABCD') END AS canonical_key, text FROM k""",
    "layout_signals": f"""WITH {OL.CLASSIFIED}, r AS (SELECT doc_id, line_number, line_type, detected_label, {_SHEET_RAW} AS raw FROM classified), b AS (SELECT *, {OL.strip('raw')} AS b, CASE WHEN line_type = 'question_anchor' THEN CAST(regexp_extract(detected_label, '(\\d+)', 1) AS INT) END AS number FROM r),
      g AS (SELECT *, CASE WHEN {OL.has('raw', D.SHEET)} AND NOT {EQ._INSTR} THEN 1 ELSE 0 END + CASE WHEN contains(lower(raw), 'question id') THEN 1 ELSE 0 END AS hits, {_METADATA} AS chosen, line_number - lag(line_number) OVER (PARTITION BY doc_id, number ORDER BY line_number) AS gap FROM b),
      d AS (SELECT doc_id, sum(hits)::BIGINT AS sheet_hits, bool_or(chosen) AS chosen_option_detected, coalesce(array_to_string(list_sort(list_distinct(list(number) FILTER (number IS NOT NULL AND gap >= {D.REPEAT_DISTANCE}))), ','), '') AS repeated_numbers FROM g GROUP BY doc_id)
      SELECT *, sheet_hits >= 3 OR (chosen_option_detected AND sheet_hits >= 1) AS response_sheet, chosen_option_detected AS unsupported FROM d""",
    "section_sanity": f"""WITH RECURSIVE {O.MAPPINGS}, {_WINDOW_CTES}, {_EXPECTED}, q AS (SELECT doc_id, count(*) AS n FROM wins GROUP BY doc_id), s AS (SELECT doc_id, count(*) AS n FROM solutions GROUP BY doc_id), j AS (
      SELECT doc_id, expected_count, coalesce(q.n, 0) AS question_windows, coalesce(s.n, 0) AS solution_windows FROM expected LEFT JOIN q USING (doc_id) LEFT JOIN s USING (doc_id)), c AS (
      SELECT *, expected_count > 0 AND question_windows < floor(expected_count * CAST({D.MIN_WINDOWS} AS DOUBLE)) AS few, expected_count > 0 AND solution_windows > floor(expected_count * CAST({D.MOST_SOLUTIONS} AS DOUBLE)) AS many FROM j), r AS (
      SELECT *, CASE WHEN few AND many THEN 'question_solution_split_failed' WHEN few OR question_windows = 0 THEN 'question_window_build_failed' WHEN many THEN 'solution_over_detection' END AS failure_reason FROM c)
      SELECT doc_id, expected_count, question_windows, solution_windows, failure_reason, failure_reason IS NULL AS passed FROM r""",
    "question_coverage": f"""WITH {O.CANDIDATES}, {_EXPECTED}, wanted AS (SELECT doc_id, unnest(range(1, expected_count + 1))::INT AS question_number FROM expected WHERE expected_count > 0), l AS (SELECT doc_id, max(question_number) AS last FROM candidates GROUP BY doc_id)
      SELECT doc_id, question_number, CASE WHEN question_number < last THEN 'inside' ELSE 'after_last' END AS place FROM wanted ANTI JOIN candidates USING (doc_id, question_number) LEFT JOIN l USING (doc_id)""",
}
