"""Queries over response sheets laid around the documents' lines, with their checking SQL.

The SQL walks an item's options by recursion, where the operator folds them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from foliate.functions import markers
from foliate.operators import detect as D
from foliate.operators import sheets as S
from foliate.plans import family_queries, package_queries, tables
from foliate.plans import oracle_lines as OL
from foliate.plans import oracle_packages as O

#: Sheets laid around whole lines, as SQL for both engines: options become cells and answers' lines, some lines state a choice.
_LAID = """CASE WHEN line_type = 'option_candidate' AND (doc_id + line_number) % 4 = 0 THEN '| Ans | ' || (line_number % 5 + 1) || '. ' || raw || ' |'
  WHEN line_type = 'option_candidate' AND (doc_id + line_number) % 4 = 1 THEN 'Ans ' || (line_number % 5 + 1) || ') ' || raw
  WHEN line_type = 'option_candidate' AND (doc_id + line_number) % 4 = 2 THEN '| ' || (line_number % 4 + 1) || '. ' || raw || '<br>' || ((line_number + 1) % 4 + 1) || ') ' || raw || ' |'
  WHEN line_type = 'option_candidate' THEN raw
  WHEN line_number % 7 = 3 THEN raw || ' Chosen Option : ' || substr('AbC4-25', CAST(line_number % 8 + 1 AS INT), 1)
  WHEN line_type = 'question_anchor' AND doc_id % 5 = 2 THEN (CAST((line_number - line_number % 8) / 8 AS INT) + 1) || '. ' || raw ELSE raw END"""


def _sheets(spark, sf_dir):
    made = lambda: tables.classified(spark, sf_dir).select("doc_id", "line_number", F.expr(_LAID).alias("raw"))
    return tables.shared(spark, sf_dir, "sheets", made)


def _items(spark, sf_dir):
    """Items as a binder leaves them: one of three without options, the others with keys and texts missing here and there."""
    items = package_queries._items(spark, sf_dir)[1]
    bare = F.transform("options", lambda o, i: F.struct(F.when((F.col("seq") + i) % 3 != 1, o["key"]).alias("key"), F.when((F.col("seq") + i) % 4 < 2, o["text"]).otherwise("").alias("text"), o["start_line"].alias("start_line")))
    return items.select("doc_id", "seq", "question_id", "question_number", F.when(F.col("seq") % 3 != 0, bare).alias("options"))


def _near(spark, sf_dir):
    made = lambda: S.near_options(_sheets(spark, sf_dir), _items(spark, sf_dir))
    return tables.shared(spark, sf_dir, "near-options", made)


def _told(options):
    return F.array_join(F.transform(options, lambda o: F.concat(F.coalesce(o["key"], F.lit("")), F.lit("="), F.coalesce(o["text"], F.lit("")), F.lit("@"), F.coalesce(o["line"].cast("string"), F.lit("")))), "+")


def sheet_options(spark, sf_dir):
    """The options of response sheets near each question."""
    return _near(spark, sf_dir).select("doc_id", "question_number", "anchor_line", _told(F.col("near")).alias("options"))


def chosen_by_question(spark, sf_dir):
    """The option that a candidate chose for each number."""
    return S.chosen_options(_sheets(spark, sf_dir))


def sheet_items(spark, sf_dir):
    """Items with the options that response sheets fill in, and what was chosen."""
    bound = S.bind_options(_items(spark, sf_dir), _near(spark, sf_dir))
    chosen = S.chosen_options(_sheets(spark, sf_dir)).select("doc_id", "question_number", "chosen_key")
    return bound.join(chosen, ["doc_id", "question_number"], "left").select("doc_id", "question_id", "question_number", "n_filled", _told(F.col("options")).alias("options"), "chosen_key")


QUERIES = {f.__name__: f for f in (sheet_options, chosen_by_question, sheet_items)}

_BARE = OL.strip("raw")
_BREAK = "(?i)<br\\s*/?>"
_OK = "regexp_full_match({}, '[1-4]')"
_MANY = f"list_transform(list_filter({family_queries._split('(' + chr(92) + 'd+)' + chr(92) + 's*[' + chr(92) + '.' + chr(92) + ')]')}, lambda x: {_OK.format('x.k')} AND {OL.strip('x.t')} <> '' AND NOT regexp_matches(x.t, '[0-9]')), lambda x: {{'key': x.k, 'text': {OL.strip('x.t')}}})"


def _one(pattern: str) -> str:
    key, text = OL.part("t", pattern), OL.strip(OL.part("t", pattern, 2))
    return f"CASE WHEN {OL.has('t', pattern)} AND {_OK.format(key)} AND {text} <> '' THEN {{'key': {key}, 'text': {text}}} END"


_LABEL = OL.strip(OL.part("raw", markers.CHOSEN))
_NO = "(" + ", ".join(map(OL.q, markers.NO_CHOICE)) + ")"
_TOLD = "coalesce(x.key, '') || '=' || coalesce(x.text, '') || '@' || coalesce(x.line::VARCHAR, '')"
_SHEETS = f"""sh AS MATERIALIZED (SELECT doc_id, line_number, {_LAID} AS raw FROM classified)"""
_NEAR = f"""{_SHEETS}, sh_cells AS (
  SELECT doc_id, line_number, raw, CASE WHEN {OL.has('raw', S.NUMBERED)} AND (starts_with({_BARE}, '|') OR contains(lower(raw), 'ans')) THEN CASE WHEN contains(raw, '|')
    THEN coalesce(list_filter(list_filter(list_transform(string_split(raw, '|'), lambda c: {OL.strip('c')}), lambda c: c <> ''), lambda c: {OL.has('c', S.NUMBERED)} AND NOT {OL.has('c', S.ANSWER_CELL)})[1], array_to_string(list_filter(list_transform(string_split(raw, '|'), lambda c: {OL.strip('c')}), lambda c: c <> ''), ' ')) ELSE raw END ELSE '' END AS cell FROM sh
), sh_texts AS (SELECT *, {OL.strip(f"regexp_replace(cell, '{_BREAK}', chr(10), 'g')")} AS t FROM sh_cells
), sh_many AS (SELECT *, {_MANY} AS many, coalesce({_one(D.NUMERIC_OPTION)}, {_one(D.PAREN_OPTION)}) AS single FROM sh_texts
), sh_told AS (SELECT doc_id, line_number, raw, CASE WHEN len(many) > 0 THEN many WHEN single IS NOT NULL THEN [single] ELSE [] END AS options FROM sh_many
), sh_numbers AS (
  SELECT doc_id, line_number, unnest(list_concat(CASE WHEN {OL.has(_BARE, S.BEGINS)} THEN [{OL.part(_BARE, S.BEGINS)}] ELSE [] END, regexp_extract_all({_BARE}, {OL.q(S.NAMED)}, 1))) AS n FROM sh
), sh_anchors AS (
  SELECT doc_id, TRY_CAST(n AS INT) AS question_number, min(line_number) AS anchor_line FROM sh_numbers WHERE TRY_CAST(n AS INT)::VARCHAR = n GROUP BY ALL
), sh_flat AS (SELECT doc_id, line_number, generate_subscripts(options, 1) AS nth, unnest(options) AS o FROM sh_told
), sh_first AS (
  SELECT a.doc_id, a.question_number, a.anchor_line, f.o.key AS key, arg_min({{'key': f.o.key, 'text': f.o.text, 'line': f.line_number}}, f.line_number * 1000 + f.nth) AS o
  FROM (SELECT * FROM sh_anchors SEMI JOIN items USING (doc_id, question_number)) a JOIN sh_flat f ON f.doc_id = a.doc_id AND f.line_number BETWEEN a.anchor_line AND a.anchor_line + {S.NEAR - 1} GROUP BY ALL
), sh_near AS (SELECT doc_id, question_number, anchor_line, list(o ORDER BY key) AS near FROM sh_first GROUP BY ALL)"""
_CHOSEN = f"""sh_read AS (SELECT doc_id, line_number, TRY_CAST(CASE WHEN {OL.has(_BARE, S.CHOICE_OF)} THEN {OL.part(_BARE, S.CHOICE_OF)} END AS INT) AS n, CASE WHEN contains(lower(raw), 'chosen option') THEN CASE WHEN regexp_full_match({_LABEL}, '[0-9]+') THEN {_LABEL} WHEN length({_LABEL}) = 1 AND {_LABEL} NOT IN {_NO} THEN upper({_LABEL}) END END AS label FROM sh
), sh_stated AS (SELECT *, last_value(n IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_number ROWS UNBOUNDED PRECEDING) AS question_number FROM sh_read
), sh_last AS (SELECT doc_id, question_number, arg_max(label, line_number) AS chosen_label, max(line_number) AS chosen_line FROM sh_stated WHERE label IS NOT NULL AND question_number IS NOT NULL GROUP BY ALL
), sh_chosen AS (SELECT doc_id, question_number, chosen_label, CASE WHEN regexp_full_match(translate(chosen_label, '1234', 'ABCD'), '[A-D]') THEN translate(chosen_label, '1234', 'ABCD') END AS chosen_key, chosen_line FROM sh_last)"""
_BIND = f"""sh_own AS (
  SELECT doc_id, seq, list({{'key': CASE WHEN (seq + i) % 3 <> 1 THEN key END, 'text': CASE WHEN (seq + i) % 4 < 2 THEN text ELSE '' END, 'line': start_line::INT}} ORDER BY i) AS options
  FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, seq ORDER BY opt, part) - 1 AS i FROM opts2) WHERE seq % 3 <> 0 GROUP BY ALL
), sh_items AS MATERIALIZED (
  SELECT i.doc_id, i.seq, i.question_id, i.question_number, coalesce(o.options, []) AS options, coalesce(n.near, []) AS near FROM items i LEFT JOIN sh_own o USING (doc_id, seq) LEFT JOIN sh_near n ON n.doc_id = i.doc_id AND n.question_number = i.question_number
), sh_walk AS (
  SELECT doc_id, seq, 0 AS i, list_transform(options, lambda x: {OL.strip("coalesce(x.key, '')")}) AS keys, options AS done, 0 AS filled FROM sh_items
  UNION ALL
  SELECT doc_id, seq, i + 1, list_transform(keys, lambda k, j: CASE WHEN j = i + 1 AND pick IS NOT NULL THEN pick.key ELSE k END),
    list_transform(done, lambda x, j: CASE WHEN j = i + 1 AND pick IS NOT NULL THEN {{'key': pick.key, 'text': pick.text, 'line': coalesce(x.line, pick.line)}} ELSE x END), filled + CAST(pick IS NOT NULL AS INT)
  FROM (SELECT *, CASE WHEN k = '' OR {OL.strip('said')} = '' THEN coalesce(list_filter(near, lambda n: regexp_replace(k, '\\.+$', '') = n.key OR (regexp_replace(k, '\\.+$', '') = '' AND contains(said, n.text)))[1],
      CASE WHEN {OL.strip('said')} = '' THEN list_filter(near, lambda n: NOT list_contains(keys, n.key))[1] END) END AS pick
    FROM (SELECT w.*, s.near, {OL.strip("coalesce(s.options[i + 1].key, '')")} AS k, coalesce(s.options[i + 1].text, '') AS said FROM sh_walk w JOIN sh_items s USING (doc_id, seq) WHERE i < len(s.options)))
), sh_bound AS (SELECT w.* FROM sh_walk w JOIN sh_items s USING (doc_id, seq) WHERE w.i = len(s.options))"""
ORACLES = {
    "sheet_options": f"WITH {O.ITEMS}, {_NEAR} SELECT doc_id, question_number, anchor_line, array_to_string(list_transform(near, lambda x: {_TOLD}), '+') AS options FROM sh_near",
    "chosen_by_question": f"WITH {OL.CLASSIFIED}, {_SHEETS}, {_CHOSEN} SELECT * FROM sh_chosen",
    "sheet_items": f"""WITH RECURSIVE {O.ITEMS}, {_NEAR}, {_CHOSEN}, {_BIND}
SELECT s.doc_id, s.question_id, s.question_number, CASE WHEN len(s.options) = 0 THEN least(len(s.near), {S.MOST_OPTIONS})::INT ELSE b.filled END AS n_filled, array_to_string(list_transform(CASE WHEN len(s.options) = 0 THEN s.near[1:{S.MOST_OPTIONS}] ELSE b.done END, lambda x: {_TOLD}), '+') AS options, c.chosen_key
FROM sh_items s JOIN sh_bound b USING (doc_id, seq) LEFT JOIN sh_chosen c ON c.doc_id = s.doc_id AND c.question_number = s.question_number""",
}
