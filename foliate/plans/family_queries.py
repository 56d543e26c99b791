"""The query over option families in question windows, with its checking SQL.

The SQL has no look-ahead: it puts marks before each key and tests what lies between two marks.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from foliate.functions import anchors as A
from foliate.functions import patterns as P
from foliate.operators import detect, families
from foliate.plans import oracle_lines as OL
from foliate.plans import section_queries, tables
from foliate.plans.evidence_queries import _key_sql


def window_lines(lines, windows):
    """The lines of ``windows``, one row each, with what :func:`families.window_options` asks of them."""
    own = windows.select("doc_id", "question_number", "start_line", F.explode("line_numbers").alias("line_number"))
    both = own.join(lines.select("doc_id", "line_number", "raw"), ["doc_id", "line_number"])
    return both.select("doc_id", "question_number", "line_number", "raw", (F.col("line_number") == F.col("start_line")).alias("is_anchor"), F.expr(A.is_option_line(A.Spark, "raw")).alias("is_option_line"))


def read_lines(spark, sf_dir):
    """The lines of the ranked windows with their options."""
    made = lambda: families.read_lines(window_lines(tables.classified(spark, sf_dir), section_queries.ranked_windows(spark, sf_dir)))
    return tables.shared(spark, sf_dir, "read-lines", made)


def window_options(spark, sf_dir):
    """The options and the stem of each ranked question window."""
    out = families.window_options(read_lines(spark, sf_dir))
    told = F.array_join(F.transform("options", lambda o: F.concat(o["key"], F.lit("="), o["text"])), "\n")
    return out.select("doc_id", "question_number", F.array_join(F.transform("options", lambda o: o["key"]), "").alias("keys"), F.size("options").cast("long").alias("n_options"), told.alias("options"), "stem")


QUERIES = {"window_options": window_options}

_C = A.Checking
_has, _q, _strip = OL.has, OL.q, OL.strip


def _normal(text: str) -> str:
    return _strip(f"regexp_replace({_strip(text)}, {_q(P.LINE_BULLET)}, '')")


def _looks(text: str) -> str:
    return f"(NOT {_has(text, P.BOLD_OPTION_LINE)} AND {_has(text, P.ANCHOR_LOOK)})"


def _unnumbered(text: str) -> str:
    return _strip(f"regexp_replace({text}, {_q(P.ANCHOR_STRIP)}, '')")


def _split(marker: str) -> str:
    """Key and text of each marker of ``t``, with the key that follows."""
    pieces = f"string_split(regexp_replace(t, {_q(marker)}, chr(1) || '\\1' || chr(2), 'g'), chr(1))[2:]"
    return f"list_transform(list_zip({pieces}, list_concat(({pieces})[2:], ['']))[1:len({pieces})], lambda z: {{'k': split_part(z[1], chr(2), 1), 't': split_part(z[1], chr(2), 2), 'next': split_part(z[2], chr(2), 1)}})"


def _entries(found: str, rank: str, key: str = "upper(x.k)", text: str = "x.t", only: str = "true") -> str:
    return f"list_transform(list_filter({found}, lambda x: {only}), lambda x: {{'rank': {rank}, 'key': {key}, 'text': {_strip(text)}}})"


def _single(text: str, pattern: str, rank: int, key: str = "upper({})", ok: str = "true") -> str:
    raw = f"regexp_extract({text}, {_q(pattern)}, 1)"
    return f"CASE WHEN {_has(text, pattern)} AND {ok} THEN [{{'rank': {rank}, 'key': {key.format(raw)}, 'text': {_strip(f'regexp_extract({text}, {_q(pattern)}, 2)')}}}] ELSE [] END"


_DIGIT_KEY = "CASE WHEN {0} IN ('1', '2', '3', '4') THEN translate({0}, '1234', 'ABCD') END"
#: Markers, and how the text after one reads; null or empty where it is none.
_DOT_TEXT = "regexp_extract(x.t || CASE WHEN x.next <> '' THEN ' ' || x.next || '.' ELSE '' END, '^\\s+([^A-D.]+?)(?:\\s+[A-D]\\.|$)', 1)"
_MARKED = ((r"\(\*?([A-Da-d])\*?\)", "x.t", "NOT regexp_matches(x.t, '[(*]')"), (r"[-*+]\s+\*\*([A-Da-d])\*\*", "x.t", "NOT regexp_matches(x.t, '[-*]')"), (r"\*\*([A-Da-d])\*\*", "x.t", "NOT contains(x.t, '*')"), (r"\(([A-Da-d])\)", "x.t", "NOT regexp_matches(x.t, '[()]')"), (r"(?:^|\s)([A-Da-d])\.", _DOT_TEXT, "true"))
_TRIMMED = "regexp_replace(x.t, '^[ \\-:;,]+|[ \\-:;,]+$', '', 'g')"
_BEFORE_NEXT = "CASE WHEN x.next <> '' THEN regexp_replace(x.t, '(?i)\\s*(Ans(?:wer)?\\s*)?$', '') ELSE x.t END"
_CELL_KEY = _key_sql(_strip(f"regexp_replace({_strip('c')}, {_q(P.OPTION_WORD)}, '')"))
_TABLE_KEY = _key_sql(_strip(f"regexp_replace({_strip('r')}, {_q(P.OPTION_WORD)}, '')"))
_EARLY = [
    _single("t", P.PIPE_TABLE_OPTION, families.PIPE_TABLE, ok=f"NOT starts_with(regexp_extract(t, {_q(P.PIPE_TABLE_OPTION)}, 2), '-')"),
    f"CASE WHEN {_has('t', P.MATHSF_OPTION)} THEN [{{'rank': {families.MATHSF}, 'key': upper(regexp_extract(t, {_q(P.MATHSF_OPTION)}, 1)), 'text': t}}] ELSE [] END",
    f"list_transform(pairs, lambda x: {{'rank': CASE WHEN bars >= 3 AND len(pairs) >= 2 THEN {families.WIDE_ROW} ELSE {families.ROW} END, 'key': x.key, 'text': x.text}})",
    *(_entries(_split(m), f"CASE WHEN labels > 1 THEN {families.MARKED + k} ELSE {families.LAST + k} END", text=text, only=only) for k, (m, text, only) in enumerate(_MARKED)),
    *(_single("bare", p, families.ONE + k) for k, p in enumerate(P.SINGLE)),
    f"CASE WHEN {_has('t', P.TABLE_OPTION)} THEN list_transform([regexp_extract(t, {_q(P.TABLE_OPTION)}, 1)], lambda r: {{'rank': {families.ONE + len(P.SINGLE)}, 'key': {_TABLE_KEY}, 'text': {_strip(f'regexp_extract(t, {_q(P.TABLE_OPTION)}, 2)')}}}) ELSE [] END",
]
_NO_BREAK = "NOT regexp_matches(t, '(?i)<br\\s*/?>')"
_LATE = [
    _entries(_split(P.PAREN_LABEL), str(families.DELIMITED), text=_TRIMMED),
    _entries(_split(r"(\d+)\s*[\.\)]"), str(families.NUMBERED), key=_DIGIT_KEY.format("x.k"), text=_BEFORE_NEXT, only="NOT regexp_matches(x.t, '[0-9]')"),
    *(_single("t", p, families.NUMERIC, key=_DIGIT_KEY, ok=_NO_BREAK) for p in (detect.NUMERIC_OPTION, detect.PAREN_OPTION)),
]
_LABELS = " + ".join(f"len(regexp_extract_all(t, {_q(p)}))" for p in P.EXPLICIT_LABELS)
_FIRSTS = "list_filter({0}, lambda x, i: list_position(list_transform({0}, lambda y: y.key), x.key) = i)"
_RAW = A.stripped(_C, "raw")
_BARE = _strip("regexp_replace(" + _strip("regexp_replace(t, '(?i)</?b>', '', 'g')") + ", '^\\|+|\\|+$', '', 'g')")


def _chain(lists: list[str]) -> str:
    out = "CAST([] AS STRUCT(rank INT, key VARCHAR, text VARCHAR)[])"
    for one in lists:
        out = f"list_concat({out}, {one})"
    return out


#: CTEs from the ranked anchors to the options of every line of their windows.
OPTION_LINES = f"""fam_in_window AS (
  SELECT * FROM (SELECT f.*, p.number, count(p.number) OVER (PARTITION BY f.doc_id ORDER BY f.line_number ROWS UNBOUNDED PRECEDING) AS win FROM flagged f LEFT JOIN picked p USING (doc_id, line_number)) WHERE win > 0
), fam_set_lines AS (
  SELECT doc_id, win, line_number, raw, key_row, max(number) OVER w AS question_number, line_number = min(line_number) OVER w AS is_anchor FROM fam_in_window WINDOW w AS (PARTITION BY doc_id, win)
), fam_read AS (
  SELECT *, {A.is_option_line(_C, 'raw')} AS is_option_line FROM fam_set_lines
  WHERE NOT key_row AND {_RAW} <> '' AND NOT {_has(_RAW, P.OPTION_NOISE)} AND NOT (regexp_matches({_RAW}, {_q(P.IMAGE_REF)}) AND length({_strip(f"regexp_replace({_RAW}, {_q(P.IMAGE_REF)}, '', 'g')")}) < {families.IMAGE_ALONE})
), fam_cut AS (SELECT *, {_normal('raw')} AS n FROM fam_read
), fam_rested AS (SELECT *, is_anchor OR {_looks('n')} AS cut FROM fam_cut
), fam_rests AS (SELECT *, CASE WHEN cut THEN {_unnumbered('n')} ELSE n END AS rest FROM fam_rested
), fam_firsts AS (SELECT *, CASE WHEN NOT cut OR {_has('rest', P.FIRST_MARKER)} THEN {_normal('rest')} ELSE '' END AS u FROM fam_rests
), fam_texts AS (SELECT *, CASE WHEN {_looks('u')} AND NOT {_has(_unnumbered('u'), P.FIRST_MARKER)} THEN '' ELSE u END AS t FROM fam_firsts
), fam_parts AS (
  SELECT *, {_LABELS} AS labels, length(t) - length(replace(t, '|', '')) AS bars, {A.is_key_row(_C, 't')} AS t_key_row,
    {_BARE} AS bare,
    list_transform(list_filter(list_transform(string_split(t, '|'), lambda c: {_strip('c')}), lambda c: c <> ''), lambda c: {{'c': c, 'k': {_CELL_KEY}}}) AS cells FROM fam_texts
), fam_paired AS (
  SELECT *, CASE WHEN bars > 0 AND len(cells) >= 2 THEN list_reduce(cells, lambda a, x: CASE WHEN a.wants IS NOT NULL THEN {{'c': '', 'k': '', 'wants': CAST(NULL AS VARCHAR), 'found': list_append(a.found, {{'key': a.wants, 'text': x.c}})}}
      ELSE {{'c': '', 'k': '', 'wants': CASE WHEN x.k IS NOT NULL AND NOT list_contains(list_transform(a.found, lambda y: y.key), x.k) THEN x.k END, 'found': a.found}} END,
      {{'c': '', 'k': '', 'wants': CAST(NULL AS VARCHAR), 'found': CAST([] AS STRUCT(key VARCHAR, text VARCHAR)[])}}).found[1:{families.MOST_IN_ROW}] ELSE [] END AS pairs FROM fam_parts
), fam_entries AS (
  SELECT *, list_filter(CASE WHEN t = '' THEN [] WHEN t_key_row THEN {_chain(_LATE)} ELSE {_chain(_EARLY + _LATE)} END, lambda x: x.key IS NOT NULL AND x.text <> '') AS every FROM fam_paired
), fam_ranked_entries AS (SELECT *, list_min(list_transform(every, lambda x: x.rank)) AS best_rank FROM fam_entries
), fam_choices AS (SELECT *, list_filter(every, lambda x: x.rank = best_rank) AS mine, list_filter(every, lambda x: x.rank = {families.DELIMITED}) AS delimited FROM fam_ranked_entries
), fam_distinct_choices AS (SELECT *, {_FIRSTS.format('mine')} AS own, {_FIRSTS.format('delimited')} AS other FROM fam_choices
), fam_read_options AS (
  SELECT doc_id, question_number, line_number, raw, is_anchor, is_option_line, CASE WHEN best_rank < {families.DELIMITED} AND len(other) > len(own) THEN other ELSE own END AS options FROM fam_distinct_choices
)"""
ORACLES = {
    "window_options": f"""WITH RECURSIVE {section_queries._MARKED}, {OPTION_LINES}, fam_said AS (
  SELECT *, CASE WHEN is_anchor OR len(options) = 0 THEN {_strip(f"split_part(regexp_replace(CASE WHEN is_anchor THEN {_unnumbered(_RAW)} ELSE {_RAW} END, {_q(P.FIRST_MARKER)}, chr(1)), chr(1), 1)")} ELSE '' END AS stem FROM fam_read_options
), fam_flat AS (
  SELECT doc_id, question_number, is_option_line, line_number, generate_subscripts(options, 1) AS nth, unnest(options) AS o FROM fam_said
), fam_first_of AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, question_number, o.key ORDER BY NOT is_option_line, line_number, nth) AS place FROM fam_flat
), fam_kept AS (
  SELECT doc_id, question_number, o.key AS key, o.text AS text, row_number() OVER (PARTITION BY doc_id, question_number ORDER BY o.key) AS k FROM fam_first_of WHERE place = 1
), fam_joined AS (
  SELECT doc_id, question_number, string_agg(key, '' ORDER BY key) AS keys, count(*) AS n_options, string_agg(key || '=' || text, chr(10) ORDER BY key) AS options FROM fam_kept WHERE k <= {families.MOST_OPTIONS} GROUP BY doc_id, question_number
), fam_stems AS (
  SELECT doc_id, question_number, coalesce(string_agg(stem, ' ' ORDER BY NOT is_option_line, line_number) FILTER (stem <> ''), '') AS stem FROM fam_said GROUP BY doc_id, question_number
)
SELECT doc_id, question_number, coalesce(keys, '') AS keys, coalesce(n_options, 0) AS n_options, coalesce(options, '') AS options, stem FROM fam_stems LEFT JOIN fam_joined USING (doc_id, question_number)"""
}
