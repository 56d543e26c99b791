"""Queries over chunks of evidence: diagnostics, roll-up and what is done again, with their checking SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliate.operators import evidence as V
from foliate.operators import replay as R
from foliate.plans import evidence_queries as EQ
from foliate.plans import oracle_packages as O
from foliate.plans import package_queries as PQ
from foliate.plans import section_queries, span_queries, tables
from foliate.plans.lineage import durable

SETTINGS = f"foliate|answer_key_only|{EQ.CHUNK}"
#: One chunk in some has failed, in SQL for both engines.
_ERROR = "CASE WHEN (doc_id + chunk_index) % 13 = 4 THEN 'no response' END"


def _chunks(spark, sf_dir):
    """Windows with their chunks, and the lines of chunks."""

    def lines():
        wins = section_queries.ranked_windows(spark, sf_dir).select("doc_id", "window_id", F.explode("line_numbers").alias("line_number"))
        own = wins.join(placed.select("doc_id", "window_id", "chunk_index"), ["doc_id", "window_id"])
        return own.join(tables.classified(spark, sf_dir).select("doc_id", "line_number", "raw"), ["doc_id", "line_number"]).select("doc_id", "chunk_index", "line_number", "raw")

    placed = tables.shared(spark, sf_dir, "chunk-windows", lambda: V.chunk_windows(EQ._windows(spark, sf_dir), EQ.CHUNK))
    return placed, tables.shared(spark, sf_dir, "chunk-lines", lines)


def _diagnosed(spark, sf_dir):
    """Validated items with their chunks, diagnostics and expected counts."""
    placed = _chunks(spark, sf_dir)[0]
    items = PQ._items(spark, sf_dir)[1]
    expected = PQ._expected(items)

    def located():
        own = items.select("doc_id", "question_id", "seq", "start_line").join(span_queries._validated(spark, sf_dir), ["doc_id", "question_id"])
        return R.chunk_of_items(own, placed)

    found = tables.shared(spark, sf_dir, "chunk-items", located)
    chunks = placed.groupBy("doc_id", "chunk_index").agg(F.sum("n_lines").alias("n_lines")).withColumn("error", F.expr(_ERROR))
    return found, expected, tables.shared(spark, sf_dir, "chunk-diagnostics", lambda: R.chunk_diagnostics(found, chunks, expected))


def _list(column):
    return F.array_join(F.transform(column, lambda x: x.cast("string")), ",").alias(column)


def chunk_diagnostics(spark, sf_dir):
    """What each chunk gave, what is wrong and why it is done again."""
    out = _diagnosed(spark, sf_dir)[2]
    counts = F.array_join(F.transform("issue_counts", lambda c: F.concat(c["kind"], F.lit("="), c["n"])), "+")
    return out.select("doc_id", "chunk_index", "n_lines", "items", _list("numbers"), "non_numeric", _list("out_of_range"), _list("repeated"), "noise_items", counts.alias("issue_counts"), "question_range", "status", F.array_join("reasons", "+").alias("reasons"))


def chunk_rollup(spark, sf_dir):
    """Chunks and items of each document against what is expected."""
    found, expected, diagnosed = _diagnosed(spark, sf_dir)
    out = R.roll_up(diagnosed, found, expected)
    return out.select("doc_id", "total_chunks", "items", "expected_count", "count_match", "extra_items", "non_numeric_items", _list("missing_numbers"), _list("duplicate_numbers"), "hallucination_suspected", _list("chunks_to_replay"), F.array_join("warnings", "+").alias("warnings"))


def chunk_replay(spark, sf_dir):
    """Chunks against those of an earlier state, and the characters of each, counted again only where lines changed.

    In the earlier state lines of one chunk in three end otherwise, one in seven is not there, and one in eleven has since gone.
    """
    told = _chunks(spark, sf_dir)[1]
    place = F.col("doc_id") + F.col("chunk_index")
    older = told.withColumn("raw", F.when(place % 3 == 1, F.concat("raw", F.lit("."))).otherwise(F.col("raw"))).where(place % 7 != 5)
    now = told.where(place % 11 != 9)
    measure = lambda lines: lines.groupBy(*R.KEYS).agg(F.sum(F.char_length("raw")).alias("n_chars"))
    stored = durable(R.chunk_hashes(older, SETTINGS), "stored-hashes")
    changed = durable(R.changes(R.chunk_hashes(now, SETTINGS), stored), "changed-chunks")
    results = R.replay(now, changed, durable(measure(older), "stored-results"), measure)
    return changed.join(results, list(R.KEYS), "left")


def evidence_hashes(spark, sf_dir):
    """One hash of each document's evidence, made of its chunks'."""
    return R.document_hashes(R.chunk_hashes(_chunks(spark, sf_dir)[1], SETTINGS))


QUERIES = {f.__name__: f for f in (chunk_diagnostics, chunk_rollup, chunk_replay, evidence_hashes)}

_C = EQ.CHUNKED.split(EQ.OL.CLASSIFIED, 1)[1].lstrip(", ").removeprefix(section_queries._MARKED.split(EQ.OL.CLASSIFIED, 1)[1].lstrip(", ")).lstrip(", ")
#: Findings bring the ranked anchors already; the windows and chunks come after them.
_ITEMS = f"""{span_queries._FINDINGS}, {_C}, {PQ._EXPECTED}, rp_items AS (
  SELECT i.doc_id, i.seq, b.question_id, b.question_number, b.issues, coalesce(arg_max(c.chunk_index, c.start_line), 0)::INT AS chunk_index
  FROM items i JOIN bv b ON b.doc_id = i.doc_id AND b.question_id = i.question_id LEFT JOIN chunked c ON c.doc_id = i.doc_id AND c.start_line <= i.start_line GROUP BY ALL
), rp_chunks AS (SELECT doc_id, chunk_index, sum(n_lines)::BIGINT AS n_lines, {_ERROR} AS error FROM chunked GROUP BY doc_id, chunk_index
), rp_number AS (
  SELECT doc_id, chunk_index, question_number, count(*) AS n, bool_or(len(list_filter(issues, lambda x: contains(x, 'duplicate_question_number'))) > 0) AS twice, count(*) FILTER (list_contains(issues, 'noise_in_question_text')) AS noise FROM rp_items GROUP BY ALL
), rp_by AS (
  SELECT doc_id, chunk_index, sum(n)::BIGINT AS items, list(question_number ORDER BY question_number) FILTER (question_number IS NOT NULL) AS numbers, coalesce(sum(n) FILTER (question_number IS NULL), 0)::BIGINT AS non_numeric,
    list(question_number ORDER BY question_number) FILTER (question_number < 1 OR question_number > expected_count) AS out_of_range, list(question_number ORDER BY question_number) FILTER (question_number IS NOT NULL AND (n > 1 OR twice)) AS repeated, sum(noise)::BIGINT AS noise_items
  FROM rp_number LEFT JOIN expected USING (doc_id) GROUP BY doc_id, chunk_index
), rp_kinds AS (SELECT doc_id, chunk_index, split_part(issue, ':', 1) AS kind, count(*) AS n FROM (SELECT doc_id, chunk_index, unnest(issues) AS issue FROM rp_items) GROUP BY ALL
), rp_counts AS (
  SELECT doc_id, chunk_index, string_agg(kind || '=' || n, '+' ORDER BY kind) AS issue_counts, bool_or(starts_with(kind, 'hallucinated')) AS unlike, bool_or(kind = 'missing_question_source_spans' AND n > {R.MOST_MISSING_SPANS}) AS unfounded FROM rp_kinds GROUP BY ALL
), rp_all AS (
  SELECT c.doc_id, c.chunk_index, n_lines, error, coalesce(items, 0) AS items, coalesce(numbers, []) AS numbers, coalesce(non_numeric, 0) AS non_numeric, coalesce(out_of_range, []) AS out_of_range, coalesce(repeated, []) AS repeated, coalesce(noise_items, 0) AS noise_items,
    coalesce(issue_counts, '') AS issue_counts, coalesce(unlike, false) AS unlike, coalesce(unfounded, false) AS unfounded FROM rp_chunks c LEFT JOIN rp_by USING (doc_id, chunk_index) LEFT JOIN rp_counts USING (doc_id, chunk_index)
), rp_told AS (
  SELECT *, CASE WHEN unlike THEN 'warning' WHEN error IS NOT NULL THEN 'failed' WHEN non_numeric > 0 OR len(out_of_range) > 0 OR len(repeated) > 0 OR noise_items > 0 THEN 'warning' ELSE 'ok' END AS status FROM rp_all
), rp AS (
  SELECT *, concat_ws('+', CASE WHEN status = 'failed' THEN 'failed_provider_response' END, CASE WHEN non_numeric > 0 THEN 'non_numeric_item' END, CASE WHEN len(out_of_range) > 0 THEN 'out_of_range_question' END, CASE WHEN len(repeated) > 0 THEN 'duplicate_question' END,
    CASE WHEN noise_items > 0 THEN 'suspected_noise' END, CASE WHEN unlike THEN 'hallucination' END, CASE WHEN unfounded THEN 'high_missing_spans' END) AS reasons FROM rp_told
)"""
_TEXT = "array_to_string({0}, ',') AS {0}"
_LINES = f"""{EQ.CHUNKED}, rp_lines AS (
  SELECT c.doc_id, c.chunk_index, w.line_number, f.raw FROM (SELECT doc_id, win, line_number FROM walled WHERE win > 0 AND NOT key_row) w JOIN chunked c ON c.doc_id = w.doc_id AND c.window_id = printf('qw_%04d', CAST(w.win AS INT)) JOIN flagged f ON f.doc_id = w.doc_id AND f.line_number = w.line_number
)"""


def _hashed(name: str, of: str) -> str:
    return f"""{name}_blocks AS (
  SELECT doc_id, chunk_index, line_number // {R.BLOCK} AS block, sum(length(raw))::BIGINT AS chars, sha256(string_agg(sha256(line_number || ':' || raw), ',' ORDER BY line_number)) AS digest FROM ({of}) GROUP BY ALL
), {name} AS (SELECT doc_id, chunk_index, sum(chars)::BIGINT AS n_chars, substr(sha256(string_agg(digest, ',' ORDER BY block) || '|{SETTINGS}'), 1, {R.HASH_CHARS}) AS evidence_hash FROM {name}_blocks GROUP BY ALL)"""


ORACLES = {
    "chunk_diagnostics": f"""WITH RECURSIVE {_ITEMS} SELECT doc_id, chunk_index, n_lines, items, {_TEXT.format('numbers')}, non_numeric, {_TEXT.format('out_of_range')}, {_TEXT.format('repeated')}, noise_items, issue_counts,
      CASE WHEN len(numbers) > 0 THEN list_min(numbers) || '..' || list_max(numbers) END AS question_range, status, reasons FROM rp""",
    "chunk_rollup": f"""WITH RECURSIVE {_ITEMS}, ru_chunks AS (SELECT doc_id, count(*) AS total_chunks, coalesce(string_agg(chunk_index::VARCHAR, ',' ORDER BY chunk_index) FILTER (reasons <> ''), '') AS chunks_to_replay FROM rp GROUP BY doc_id
      ), ru_numbers AS (SELECT doc_id, question_number, count(*) AS n FROM rp_items GROUP BY ALL
      ), ru_own AS (SELECT doc_id, sum(n)::BIGINT AS items, coalesce(sum(n) FILTER (question_number IS NULL), 0)::BIGINT AS non_numeric_items, coalesce(string_agg(question_number::VARCHAR, ',' ORDER BY question_number) FILTER (n > 1), '') AS duplicate_numbers, list(question_number) AS have FROM ru_numbers GROUP BY doc_id
      ), ru_items AS (SELECT doc_id, sum(len(list_filter(issues, lambda x: starts_with(x, 'hallucinated'))))::BIGINT AS hallucination_suspected, count(*) FILTER (question_number IS NULL OR question_number < 1 OR question_number > expected_count OR seq > expected_count) AS extra_items FROM rp_items JOIN expected USING (doc_id) GROUP BY doc_id
      ), ru AS (SELECT c.doc_id, total_chunks, coalesce(items, 0) AS items, expected_count, coalesce(items, 0) = expected_count AS m, coalesce(extra_items, 0) AS extra_items, coalesce(non_numeric_items, 0) AS non_numeric_items, array_to_string(list_filter(range(1, coalesce(expected_count, 0) + 1), lambda x: NOT list_contains(coalesce(have, []), x)), ',') AS missing_numbers,
        coalesce(duplicate_numbers, '') AS duplicate_numbers, coalesce(hallucination_suspected, 0) AS hallucination_suspected, chunks_to_replay FROM ru_chunks c LEFT JOIN ru_own USING (doc_id) LEFT JOIN ru_items USING (doc_id) LEFT JOIN expected USING (doc_id))
      SELECT * EXCLUDE (m), coalesce(m, true) AS count_match, concat_ws('+', CASE WHEN NOT m THEN 'expected_count_mismatch: expected=' || expected_count || ' actual=' || items END, CASE WHEN extra_items > 0 THEN 'extra_item_count:' || extra_items END) AS warnings FROM ru""",
    "chunk_replay": f"""WITH RECURSIVE {_LINES}, {_hashed('was', "SELECT doc_id, chunk_index, line_number, CASE WHEN (doc_id + chunk_index) % 3 = 1 THEN raw || '.' ELSE raw END AS raw FROM rp_lines WHERE (doc_id + chunk_index) % 7 <> 5")}, {_hashed('now', 'SELECT * FROM rp_lines WHERE (doc_id + chunk_index) % 11 <> 9')}
      SELECT doc_id, chunk_index, n.evidence_hash, CASE WHEN w.evidence_hash IS NULL THEN 'new' WHEN n.evidence_hash IS NULL THEN 'gone' WHEN w.evidence_hash = n.evidence_hash THEN 'same' ELSE 'changed' END AS state, n.n_chars FROM now n FULL JOIN was w USING (doc_id, chunk_index)""",
    "evidence_hashes": f"""WITH RECURSIVE {_LINES}, {_hashed('now', 'SELECT * FROM rp_lines')} SELECT doc_id, substr(sha256(string_agg(evidence_hash, ',' ORDER BY chunk_index)), 1, {R.HASH_CHARS}) AS evidence_hash FROM now GROUP BY doc_id""",
}
