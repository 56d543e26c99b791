"""Queries over reviewers' patches laid around the documents' questions, with their checking SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliate.operators import gates as G
from foliate.operators import patches as R
from foliate.plans import gate_queries as GQ
from foliate.plans import oracle_lines as OL
from foliate.plans import oracle_packages as O
from foliate.plans import package_queries as PQ
from foliate.plans import span_queries, tables
from foliate.plans.evidence_queries import _key_sql

#: Patches of two questions in three and second ones of some, as SQL for both engines over (doc_id, seq, question_id, question_number, stem).
_LAID = """SELECT doc_id, CAST(seq + 1000 * again AS BIGINT) AS position, CASE WHEN seq % 5 = 4 THEN question_id ELSE 'p' || (seq + 1000 * again) END AS patch_id,
  CASE WHEN seq % 5 = 4 THEN NULL WHEN seq % 11 = 3 THEN question_number + 500 ELSE question_number END AS question_number,
  CASE WHEN again = 1 OR (doc_id + seq) % 7 < 4 THEN 'accept_with_manual_patch' WHEN (doc_id + seq) % 7 = 4 THEN 'block' WHEN (doc_id + seq) % 7 = 5 THEN 'hold_for_review' ELSE 'drop' END AS action,
  CASE WHEN again = 1 THEN 'Again: ' || stem WHEN seq % 4 = 0 THEN 'Reviewed: ' || stem ELSE '' END AS question_text_raw,
  CASE WHEN seq % 3 = 1 THEN '(b)' END AS correct_answer_key, CASE WHEN seq % 6 = 5 THEN 'Because ' || stem END AS solution_text_raw,
  seq % 8 <> 7 AS confirm_no_guessing, CASE WHEN seq % 9 = 8 THEN '  ' ELSE 'seen by a reviewer' END AS reviewer_notes, seq % 2 = 0 OR seq % 3 = 1 AND doc_id % 2 = 0 AS listed, seq
FROM {items} WHERE again = 0 AND (doc_id + seq) % 3 <> 0 OR again = 1 AND (doc_id + seq) % 5 = 1"""


def _reviewed(spark, sf_dir):
    """Gated and validated items, and their judged patches."""

    def own():
        gated = G.acceptance(PQ._items(spark, sf_dir)[1]).select("doc_id", "seq", "question_id", "question_number", "question_text_raw", "options", "answer_key", F.col("solution.raw_text").alias("solution_text"), F.col("solution").isNotNull().alias("grounded"), F.col("quality").alias("gate"))
        return gated.join(span_queries._validated(spark, sf_dir).select("doc_id", "question_id", "issues", "status"), ["doc_id", "question_id"])

    def judged():
        twice = items.select("doc_id", "seq", "question_id", "question_number", F.col("question_text_raw").alias("stem"), F.explode(F.array(F.lit(0), F.lit(1))).alias("again"))
        laid = spark.sql(_LAID.format(items="{twice}"), twice=twice)
        shown = F.transform("options", lambda o: F.struct(o["key"].alias("key"), F.concat(o["text"], F.lit(".")).alias("text")))
        full = laid.join(items.select("doc_id", "seq", shown.alias("shown")), ["doc_id", "seq"]).withColumn("options", F.when(F.col("listed"), F.col("shown")))
        return R.judge(items, full.drop("seq", "shown", "listed"))

    items = tables.shared(spark, sf_dir, "reviewed-items", own)
    return items, tables.shared(spark, sf_dir, "judged-patches", judged)


def patch_findings(spark, sf_dir):
    """What each patch is for, and why it is refused."""
    return _reviewed(spark, sf_dir)[1].select("doc_id", "position", "patch_id", "question_number", "action", "question_id", "matched_by", "applied", F.array_join("errors", "+").alias("errors"))


def patch_counts(spark, sf_dir):
    """Each document's patches by what became of them."""
    return R.patch_counts(_reviewed(spark, sf_dir)[1])


def patched_items(spark, sf_dir):
    """The items that are exported with patches, and where each field comes from."""
    out = R.final_export(*_reviewed(spark, sf_dir))
    told = F.array_join(F.transform("options", lambda o: F.concat(F.coalesce(o["key"], F.lit("")), F.lit("="), o["text"])), "\n")
    return out.select("doc_id", "question_id", "question_number", "question_text_raw", told.alias("options"), "answer_key", "answer_text", "solution_text", "answer_source", "export_status", *(F.array_join(c, "+").alias(c) for c in ("issues", "provenance", "origins")))


QUERIES = {f.__name__: f for f in (patch_findings, patch_counts, patched_items)}

_GATES = GQ._GATED.split(O.ITEMS, 1)[1].lstrip(", ")
_QUALITY = "CASE WHEN blank THEN 'blocked' WHEN visual THEN 'visual_required' WHEN few OR lost THEN 'review_required' WHEN NOT answered THEN 'answer_unavailable' ELSE 'accepted_safe' END"
_WORD = lambda e: OL.strip(f"regexp_replace({OL.strip(e)}, {OL.q(OL.P.OPTION_WORD)}, '')")
_ANSWER = lambda e: f"coalesce(CASE WHEN {OL.has(OL.strip(e), OL.P.ANSWER_PREFIX)} THEN upper({OL.part(OL.strip(e), OL.P.ANSWER_PREFIX)}) END, {_key_sql(_WORD(e))})"
_JUDGED = f"""{span_queries._FINDINGS}, {_GATES}, pt_options AS (SELECT doc_id, seq, list({{'key': key, 'text': text}} ORDER BY opt, part) AS options FROM opts2 GROUP BY ALL
), pt_items AS MATERIALIZED (
  SELECT g.doc_id, g.seq, g.question_id, g.question_number, g.stem, coalesce(o.options, []) AS options, g.answer_key, s.raw_text AS solution_text, g.solved, {_QUALITY} AS gate, b.issues, b.status
  FROM gated g JOIN bv b ON b.doc_id = g.doc_id AND b.question_id = g.question_id LEFT JOIN pt_options o ON o.doc_id = g.doc_id AND o.seq = g.seq LEFT JOIN solutions s ON s.doc_id = g.doc_id AND s.question_number = g.question_number AND s.start_line = g.solution_line
), pt_twice AS (SELECT *, unnest([0, 1]) AS again FROM pt_items
), pt_laid AS ({_LAID.format(items='pt_twice')}
), pt_patches AS (
  SELECT l.*, CASE WHEN listed THEN list_transform(i.options, lambda o: {{'key': o.key, 'text': o.text || '.'}}) END AS options FROM pt_laid l JOIN pt_items i ON i.doc_id = l.doc_id AND i.seq = l.seq
), pt_numbers AS (SELECT doc_id, question_number, arg_max(question_id, seq) AS n_id, arg_max(status, seq) AS n_status FROM pt_items WHERE question_number IS NOT NULL GROUP BY ALL
), pt_met AS (
  SELECT p.*, coalesce(n.n_id, i.question_id) AS question_id, coalesce(n.n_status, i.status) AS status, CASE WHEN n.n_id IS NOT NULL THEN 'number' WHEN i.question_id IS NOT NULL THEN 'id' END AS matched_by
  FROM pt_patches p LEFT JOIN pt_numbers n ON n.doc_id = p.doc_id AND n.question_number = p.question_number LEFT JOIN pt_items i ON i.doc_id = p.doc_id AND i.question_id = p.patch_id
), pt_judged AS (
  SELECT *, CASE WHEN question_id IS NULL THEN 'target_question_not_found' WHEN status = 'accepted' THEN 'cannot_patch_accepted_item_without_flag' WHEN action IN ('block', 'hold_for_review') THEN ''
    WHEN action = 'accept_with_manual_patch' THEN concat_ws('+', CASE WHEN NOT confirm_no_guessing THEN 'confirm_no_guessing_required' END, CASE WHEN {OL.strip('reviewer_notes')} = '' THEN 'reviewer_notes_required' END,
      CASE WHEN question_text_raw = '' AND coalesce(len(options), 0) = 0 AND correct_answer_key IS NULL AND coalesce(solution_text_raw, '') = '' THEN 'manual_patch_requires_at_least_one_field' END, CASE WHEN correct_answer_key IS NOT NULL AND coalesce(len(options), 0) = 0 THEN 'correct_answer_key_requires_options_for_text_derivation' END)
    ELSE 'unknown_action:' || action END AS errors FROM pt_met
)"""
ORACLES = {
    "patch_findings": f"WITH RECURSIVE {_JUDGED} SELECT doc_id, position, patch_id, question_number, action, question_id, matched_by, errors = '' AS applied, errors FROM pt_judged",
    "patch_counts": f"""WITH RECURSIVE {_JUDGED} SELECT doc_id, count(*) AS total, count(*) FILTER (errors = '' AND action = 'accept_with_manual_patch') AS applied, count(*) FILTER (errors = '' AND action = 'block') AS blocked, count(*) FILTER (errors = '' AND action = 'hold_for_review') AS held, count(*) FILTER (errors <> '') AS rejected FROM pt_judged GROUP BY doc_id""",
    "patched_items": f"""WITH RECURSIVE {_JUDGED}, pt_last AS (
  SELECT * FROM pt_judged WHERE errors = '' AND action = 'accept_with_manual_patch' AND matched_by = 'number' QUALIFY row_number() OVER (PARTITION BY doc_id, question_id ORDER BY position DESC) = 1
), pt_safe AS (SELECT *, bool_or(gate = 'accepted_safe') OVER (PARTITION BY doc_id, question_number) AS safe FROM pt_items
), pt_out AS (
  SELECT i.doc_id, i.question_id, i.question_number, i.gate, i.issues, i.solved, p.patch_id IS NOT NULL AS patched, CASE WHEN coalesce(p.question_text_raw, '') <> '' THEN p.question_text_raw ELSE i.stem END AS question_text_raw, CASE WHEN coalesce(len(p.options), 0) > 0 THEN p.options ELSE i.options END AS options,
    coalesce(p.correct_answer_key, i.answer_key) AS said, CASE WHEN coalesce(p.solution_text_raw, '') <> '' THEN p.solution_text_raw ELSE i.solution_text END AS solution_text,
    'text=' || CASE WHEN coalesce(p.question_text_raw, '') <> '' THEN p.patch_id ELSE 'bound' END || '+options=' || CASE WHEN coalesce(len(p.options), 0) > 0 THEN p.patch_id ELSE 'bound' END || '+answer=' || CASE WHEN p.correct_answer_key IS NOT NULL THEN p.patch_id ELSE 'bound' END || '+solution=' || CASE WHEN coalesce(p.solution_text_raw, '') <> '' THEN p.patch_id ELSE 'bound' END AS origins
  FROM pt_safe i LEFT JOIN pt_last p ON p.doc_id = i.doc_id AND p.question_id = i.question_id AND i.gate <> 'accepted_safe' WHERE i.gate = 'accepted_safe' OR (p.patch_id IS NOT NULL AND NOT coalesce(i.safe, false))
), pt_keyed AS (SELECT *, {_ANSWER('said')} AS answer_key FROM pt_out
), pt_told AS (SELECT *, {OL.strip(f"list_filter(options, lambda o: {_ANSWER('o.key')} = answer_key AND {OL.strip('o.text')} <> '')[1].text")} AS answer_text FROM pt_keyed)
SELECT doc_id, question_id, question_number, question_text_raw, array_to_string(list_transform(options, lambda o: coalesce(o.key, '') || '=' || o.text), chr(10)) AS options, answer_key, answer_text, solution_text,
  CASE WHEN patched THEN 'manual_review' WHEN answer_key IS NOT NULL AND solved THEN 'source_grounded' ELSE 'unavailable' END AS answer_source, 'ready_for_pattern_input' AS export_status,
  array_to_string(list_concat(issues, CASE WHEN answer_key IS NOT NULL AND answer_text IS NULL THEN ['correct_answer_text_unavailable'] ELSE [] END), '+') AS issues,
  CASE WHEN patched THEN 'semantic_binding+manual_patch' WHEN answer_key IS NOT NULL AND solved THEN 'semantic_binding+semantic_repair' ELSE 'semantic_binding' END AS provenance, origins FROM pt_told""",
}
