"""Queries over layout responses, evidence of two engines, windows, public questions and review."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliate.functions import markers
from foliate.functions import text as T
from foliate.operators import evidence as V
from foliate.operators import export as X
from foliate.plans import oracle_lines as OL
from foliate.plans import oracle_packages as O
from foliate.plans import package_queries as PQ
from foliate.plans import section_queries, tables
from foliate.plans.lineage import durable
from foliate.sources import layout
from foliate.sources.corpus import LINES_SQL

CHUNK = 40


def _responses(spark, sf_dir):
    """Layout responses of the documents: pages of ten lines, one table, some figures."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.split(F.coalesce("text", F.lit("")), "\n", -1).alias("l"))
    lines = F.transform("l", lambda x, i: F.struct(F.struct(x.alias("content"), F.array(*(v.cast("double") for v in (i, i * 2, i + 10, i * 2, i + 10, i * 2 + 3, i, i * 2 + 3))).alias("polygon")).alias("line"), F.floor(i / 10).cast("int").alias("p")))
    pages = F.transform(F.sequence(F.lit(0), F.floor((F.size("l") - 1) / 10).cast("int")), lambda p: F.struct((p + 1).alias("pageNumber"), F.transform(F.filter(lines, lambda x: x["p"] == p), lambda x: x["line"]).alias("lines")))
    tables_ = F.when(F.col("doc_id") % 2 == 0, F.array(F.struct(F.lit(1).alias("rowCount"), F.lit(1).alias("columnCount"))))
    figures = F.when(F.col("doc_id") % 5 == 0, F.array(F.struct(F.lit("f1").alias("id"))))
    return docs.select("doc_id", F.to_json(F.struct(pages.alias("pages"), tables_.alias("tables"), figures.alias("figures"))).alias("response"))


def layout_lines(spark, sf_dir):
    """The lines of layout responses with their boxes."""
    out = layout.layout_lines(layout.parsed(durable(_responses(spark, sf_dir), "responses")))
    return out.select("doc_id", "page_number", "line_index", "text_raw", *(F.get("bbox", F.lit(i)).alias(c) for i, c in enumerate(("x0", "y0", "x1", "y1"))))


def layout_summary(spark, sf_dir):
    """Counts of what each layout response holds."""
    return layout.layout_summary(layout.parsed(durable(_responses(spark, sf_dir), "responses")))


def _engines(spark, sf_dir):
    """Lines of two engines: the second reads some letters otherwise and some lines not at all."""
    lines = tables.classified(spark, sf_dir).select("doc_id", F.concat(F.lit("m_"), F.col("line_number")).alias("line_id"), "page_number", F.col("raw").alias("text"), "line_number")
    misread = F.when(F.col("line_number") % 4 == 0, F.regexp_replace("text", "[aeo]", "c")).when(F.col("line_number") % 4 == 1, F.concat("text", F.lit(" ."))).otherwise(F.col("text"))
    second = lines.where("(doc_id + line_number) % 5 <> 0").select("doc_id", F.concat(F.lit("o_"), F.col("line_number")).alias("line_id"), F.coalesce("page_number", F.lit(1)).alias("page_number"), misread.alias("text"))
    return lines.drop("line_number"), second


def recovered_options(spark, sf_dir):
    """Options whose text the first engine lost, with the line of the second that each gets."""
    lines = tables.classified(spark, sf_dir).withColumn("option", F.col("line_type") == "option_candidate")
    lost = F.col("option") & (F.col("line_number") % 3 != 1)
    label = F.concat(F.lower(F.regexp_extract("raw", "([A-Da-d])", 1)), F.lit(")"))
    first = lines.select("doc_id", F.concat(F.lit("m_"), F.col("line_number")).alias("line_id"), F.when(F.col("line_number") % 11 != 0, F.col("page_number")).alias("page_number"), F.col("line_number").alias("place"), F.when(lost, label).otherwise(F.col("raw")).alias("text"))
    read = F.when(F.col("option") & (F.col("line_number") % 2 == 0), F.concat((F.col("line_number") % 4 + 1).cast("string"), F.lit(". "), F.col("raw"))).otherwise(F.col("raw"))
    second = lines.where("line_number % 5 <> 0").select("doc_id", F.concat(F.lit("o_"), F.col("line_number")).alias("line_id"), F.coalesce("page_number", F.lit(1)).alias("page_number"), F.col("line_number").alias("place"), read.alias("text"), (F.col("line_number") * 37 % 10).cast("double").alias("confidence"), (F.col("option") & (F.col("line_number") % 7 == 0)).alias("is_option"))
    return V.recovered_options(first, second)


def ocr_merge(spark, sf_dir):
    """Lines of two engines without near repeats: how many of each engine stay, by document."""
    first, second = _engines(spark, sf_dir)
    return V.merged(first, second).groupBy("doc_id", "engine").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.char_length("text")).alias("n_chars"))


def _windows(spark, sf_dir):
    return section_queries.ranked_windows(spark, sf_dir).withColumn("n_lines", F.size("line_numbers").cast("long"))


def binder_chunks(spark, sf_dir):
    """Windows packed into chunks of bounded size."""
    return V.chunks(_windows(spark, sf_dir), CHUNK)


def number_ranges(spark, sf_dir):
    """Runs of consecutive question numbers by document."""
    lines = tables.classified(spark, sf_dir).where("line_type = 'question_anchor'")
    return V.ranges(lines.select("doc_id", F.regexp_extract("detected_label", r"(\d+)", 1).try_cast("int").alias("number")))


def _public(spark, sf_dir):
    return X.public_questions(PQ._items(spark, sf_dir)[1])


def public_questions(spark, sf_dir):
    """Public form of every question."""
    out = _public(spark, sf_dir)
    return out.select("doc_id", "external_id", "status", F.size("question.options").alias("n_options"), F.col("question.correctAnswer.label").alias("answer_label"), F.col("question.correctAnswer.text").alias("answer_text"))


def public_status_counts(spark, sf_dir):
    """Questions of each status by document."""
    return X.status_counts(_public(spark, sf_dir))


def public_audit(spark, sf_dir):
    """Contract errors by document."""
    items = PQ._items(spark, sf_dir)[1]
    return X.public_audit(X.public_questions(items), PQ._expected(items))


def public_json(spark, sf_dir):
    """The public JSON of every document."""
    return X.public_json(_public(spark, sf_dir))


def review_export(spark, sf_dir):
    """Items for review with their first reason."""
    return X.review_items(PQ._items(spark, sf_dir)[1])


def review_merge(spark, sf_dir):
    """Questions after an edited review: by external id, else by number."""
    base = tables.stored(spark, sf_dir, _public(spark, sf_dir).select("doc_id", "seq", "external_id", "question_number", "status"), "public")
    edited = base.where("status <> 'ready' and (doc_id + seq) % 3 = 0")
    lost_id = F.when(F.col("seq") % 2 == 0, F.col("external_id"))
    review = edited.select("doc_id", lost_id.alias("external_id"), "question_number", F.lit("ready").alias("status"), F.col("seq").alias("position"))
    return X.merge_review(base.drop("seq"), review).groupBy("doc_id", "status", "patched").agg(F.count(F.lit(1)).alias("n_questions"))


def solution_overlap(spark, sf_dir):
    """Shared tokens of each question with its solution."""
    cands, maps = PQ._mapped(spark, sf_dir)
    both = cands.select("doc_id", "seq", "question_id", "question_text_raw").join(maps.where("solution is not null").select("doc_id", "seq", F.col("solution.raw_text").alias("solution")), ["doc_id", "seq"])
    return both.select("doc_id", "question_id", F.round(markers.overlap(F.col("question_text_raw"), F.col("solution")), 6).alias("overlap"))


def _sheet_line():
    n = F.col("conv_id") + F.col("turn")
    pick = F.substring(F.lit("A2-c14bD"), (n % 8 + 1).cast("int"), F.lit(1))
    return F.when(n % 6 == 0, F.concat(F.lit("Chosen Option : "), pick)).when(n % 6 == 1, "Chosen option on the right indicates the choice").when(n % 6 == 2, "Chosen Option: --").when(n % 6 == 3, "The chosen option : none").otherwise(F.col("text"))


def chosen_options(spark, sf_dir):
    """Chosen-option rows and directions among the turns of conversations."""
    lines = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", _sheet_line().alias("line"))
    return lines.select("conv_id", "turn", markers.is_chosen_instruction(F.col("line")).alias("instruction"), markers.is_chosen_metadata(F.col("line")).alias("metadata"), markers.chosen_key(F.col("line")).alias("chosen_key"))


def language_profiles(spark, sf_dir):
    """Scripts of each conversation's turns."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    text = F.when(F.col("conv_id") % 3 == 0, F.concat(F.coalesce("text", F.lit("")), F.lit(" हिन्दी"))).when(F.col("conv_id") % 7 == 1, "१२ ।").when(F.col("conv_id") % 7 == 2, "12").otherwise(F.col("text"))
    return turns.groupBy("conv_id").agg(markers.language_profile(F.collect_list(text)).alias("profile"))


def option_keys(spark, sf_dir):
    """Canonical keys of what may be a label: the first and the second word of every line, and both."""
    words = F.split(T.strip(F.col("raw")), T.uni(r"\s+"))
    second = F.coalesce(F.get(words, F.lit(1)), F.lit(""))
    labels = F.array(F.get(words, F.lit(0)), second, F.when(second != "", F.concat_ws(" ", F.get(words, F.lit(0)), second)).otherwise(""))
    lines = tables.classified(spark, sf_dir).select(F.explode(labels).alias("label")).where("label <> ''")
    return lines.select("label", T.option_key(F.col("label")).alias("option_key"), T.answer_key(F.col("label")).alias("answer_key")).groupBy("label", "option_key", "answer_key").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    f.__name__: f
    for f in (layout_lines, layout_summary, ocr_merge, recovered_options, binder_chunks, number_ranges, public_questions, public_status_counts, public_audit, public_json, review_export, review_merge, solution_overlap, chosen_options, language_profiles, option_keys)
}

_NUMBERED = LINES_SQL.split("placed AS")[0].rstrip().rstrip(",")
_WINDOWS = section_queries.WINDOWS
_FITS = f"(f.size = 0 OR f.size + o.n_lines <= {CHUNK})"
#: CTEs up to ``chunked``, the ranked windows with their chunks.
CHUNKED = f"""{_WINDOWS}, in_order AS (SELECT doc_id, window_id, start_line, n_lines, row_number() OVER (PARTITION BY doc_id ORDER BY start_line) AS rn FROM wins
), chunked AS (
  SELECT doc_id, window_id, start_line, n_lines, rn, 0 AS chunk_index, n_lines AS size FROM in_order WHERE rn = 1 UNION ALL
  SELECT o.doc_id, o.window_id, o.start_line, o.n_lines, o.rn, CASE WHEN {_FITS} THEN f.chunk_index ELSE f.chunk_index + 1 END, CASE WHEN {_FITS} THEN f.size + o.n_lines ELSE o.n_lines END FROM chunked f JOIN in_order o ON o.doc_id = f.doc_id AND o.rn = f.rn + 1
)"""
_STATUS = f"CASE WHEN {OL.strip('stem')} = '' THEN 'blocked' WHEN visual THEN 'visual_required' WHEN usable < 4 OR list_contains(issues, 'answer_option_mismatch') THEN 'review' ELSE 'ready' END"
_PUBLIC = f"""{O.ITEMS}, pub AS (SELECT doc_id, seq, question_number, printf('Q%03d', question_number) AS external_id, {_STATUS} AS status, answer_key FROM items
), pub_options AS (SELECT doc_id, seq, count(*) FILTER ({OL.strip('text')} <> '' OR key IS NOT NULL) AS n_options FROM opts GROUP BY doc_id, seq
), pub_answers AS (SELECT doc_id, seq, key, arg_min(text, opt * 1000 + part) AS text FROM opts GROUP BY doc_id, seq, key
)"""
_COUNTS = ", ".join(f"count(*) FILTER (status = '{s}') AS {s}_count" for s in X.STATUSES)
_SHEET = "CASE WHEN n % 6 = 0 THEN 'Chosen Option : ' || substr('A2-c14bD', CAST(n % 8 + 1 AS INT), 1) WHEN n % 6 = 1 THEN 'Chosen option on the right indicates the choice' WHEN n % 6 = 2 THEN 'Chosen Option: --' WHEN n % 6 = 3 THEN 'The chosen option : none' ELSE text END"
_PHRASED = " OR ".join(f"contains(lower(b), '{p}')" for p in markers.INSTRUCTION_PHRASES)
_INSTR = f"({OL.has('b', markers.CHOSEN_INSTRUCTION)} OR {OL.has('b', markers.SHEET_INSTRUCTION)} OR (contains(lower(b), 'chosen option') AND NOT contains(b, ':') AND ({_PHRASED})))"
_CHOICE = f"regexp_extract(b, {OL.q(markers.CHOSEN)}, 1)"
_TOKENS = "list_distinct(regexp_extract_all(lower({}), '[\\p{{L}}\\p{{N}}\\p{{M}}_]+'))"


def _key_sql(word: str) -> str:
    P = OL.P
    formed = ", ".join(f"CASE WHEN {OL.has(word, p)} THEN upper({OL.part(word, p)}) END" for p in P.KEY_FORMS)
    single = f"translate(upper(regexp_replace({word}, '^[(). ]+|[(). ]+$', '', 'g')), '{P.LOOK_ALIKES[0]}', '{P.LOOK_ALIKES[1]}')"
    return f"coalesce({formed}, CASE WHEN regexp_full_match({single}, '[A-E]') THEN {single} END)"


_WORD = OL.strip(f"regexp_replace({OL.strip('label')}, {OL.q(OL.P.OPTION_WORD)}, '')")
ORACLES = {
    "recovered_options": f"""WITH RECURSIVE {OL.CLASSIFIED}, known AS (SELECT *, line_type = 'option_candidate' AS option FROM classified
      ), blanks AS (SELECT doc_id, line_id, page_number, row_number() OVER (PARTITION BY doc_id ORDER BY line_number) AS k FROM (
        SELECT doc_id, line_number, 'm_' || line_number AS line_id, CASE WHEN line_number % 11 <> 0 THEN page_number END AS page_number, CASE WHEN option AND line_number % 3 <> 1 THEN lower(regexp_extract(raw, '([A-Da-d])', 1)) || ')' ELSE raw END AS text FROM known) WHERE {OL.has(OL.strip('text'), V.BLANK_OPTION)}
      ), read_by AS (SELECT doc_id, line_number, coalesce(page_number, 1) AS page_number, CASE WHEN option AND line_number % 2 = 0 THEN (line_number % 4 + 1)::VARCHAR || '. ' || raw ELSE raw END AS text, line_number * 37 % 10 AS confidence, option AND line_number % 7 = 0 AS is_option FROM known WHERE line_number % 5 <> 0
      ), offers0 AS (SELECT doc_id, line_number, page_number, confidence, CASE WHEN {OL.has(OL.strip('text'), V.NUMBERED_TEXT)} THEN {OL.strip(f"regexp_extract({OL.strip('text')}, {OL.q(V.NUMBERED_TEXT)}, 2)")} WHEN is_option THEN {OL.strip('text')} END AS said FROM read_by
      ), offers AS (SELECT doc_id, 'o_' || line_number AS line_id, page_number, said, row_number() OVER (PARTITION BY doc_id ORDER BY confidence DESC, line_number) AS r FROM offers0 WHERE said <> ''
      ), walk AS (
        SELECT doc_id, 0::BIGINT AS k, CAST([] AS BIGINT[]) AS used, CAST(NULL AS BIGINT) AS pick FROM blanks WHERE k = 1
        UNION ALL
        SELECT doc_id, k, CASE WHEN pick IS NULL THEN used ELSE list_append(used, pick) END, pick FROM (
          SELECT w.doc_id, b.k, w.used, min(o.r) AS pick FROM walk w JOIN blanks b ON b.doc_id = w.doc_id AND b.k = w.k + 1 LEFT JOIN offers o ON o.doc_id = w.doc_id AND (b.page_number IS NULL OR o.page_number = b.page_number) AND NOT list_contains(w.used, o.r) GROUP BY w.doc_id, b.k, w.used)
      ) SELECT b.doc_id, b.line_id, o.line_id AS option_line, o.said AS option_text FROM blanks b JOIN walk w ON w.doc_id = b.doc_id AND w.k = b.k LEFT JOIN offers o ON o.doc_id = w.doc_id AND o.r = w.pick""",
    "layout_lines": f"WITH {_NUMBERED} SELECT doc_id, CAST((i - i % 10) / 10 AS INT) + 1 AS page_number, CAST(i % 10 AS INT) AS line_index, line AS text_raw, CAST(i AS DOUBLE) AS x0, CAST(i * 2 AS DOUBLE) AS y0, CAST(i + 10 AS DOUBLE) AS x1, CAST(i * 2 + 3 AS DOUBLE) AS y1 FROM numbered",
    "layout_summary": f"WITH {_NUMBERED} SELECT doc_id, CAST((max(i) - max(i) % 10) / 10 AS INT) + 1 AS pages, CAST(count(*) AS INT) AS lines, CASE WHEN doc_id % 2 = 0 THEN 1 ELSE 0 END AS tables, 0 AS paragraphs, CASE WHEN doc_id % 5 = 0 THEN 1 ELSE 0 END AS figures FROM numbered GROUP BY doc_id",
    "binder_chunks": f"""WITH RECURSIVE {CHUNKED}
      SELECT doc_id, chunk_index, count(*) AS windows, sum(n_lines)::BIGINT AS n_lines, min(window_id) AS first_window, max(window_id) AS last_window FROM chunked GROUP BY doc_id, chunk_index""",
    "number_ranges": f"""WITH {OL.CLASSIFIED}, d AS (SELECT DISTINCT doc_id, CAST(regexp_extract(detected_label, '(\\d+)', 1) AS INT) AS number FROM classified WHERE line_type = 'question_anchor')
      SELECT doc_id, min(number) AS first, max(number) AS last, count(*) AS n FROM (SELECT *, number - row_number() OVER (PARTITION BY doc_id ORDER BY number) AS island FROM d) GROUP BY doc_id, island""",
    "public_questions": f"WITH {_PUBLIC} SELECT p.doc_id, external_id, status, CAST(coalesce(n_options, 0) AS INT) AS n_options, answer_key AS answer_label, a.text AS answer_text FROM pub p LEFT JOIN pub_options o USING (doc_id, seq) LEFT JOIN pub_answers a ON a.doc_id = p.doc_id AND a.seq = p.seq AND a.key = p.answer_key",
    "public_status_counts": f"WITH {_PUBLIC} SELECT doc_id, count(*) AS total_questions, {_COUNTS}, count(*) FILTER (status <> 'ready') AS non_ready_count FROM pub GROUP BY doc_id",
    "public_audit": f"""WITH {_PUBLIC}, expected AS (SELECT doc_id, CAST(count(*) + doc_id % 4 - 1 AS INT) AS expected_count FROM items GROUP BY doc_id), checked AS (
      SELECT doc_id, expected_count, count(*) AS total, CAST(count(*) - count(DISTINCT question_number) AS INT) AS repeated_numbers, CAST(count(*) FILTER (question_number < 1 OR question_number > expected_count) AS INT) AS out_of_range,
        CAST(greatest(expected_count, 0) - count(DISTINCT question_number) FILTER (question_number BETWEEN 1 AND expected_count) AS INT) AS missing_ids FROM pub JOIN expected USING (doc_id) GROUP BY doc_id, expected_count)
      SELECT *, total = expected_count AND repeated_numbers = 0 AND out_of_range = 0 AND missing_ids = 0 AS passed FROM checked""",
    "review_export": f"""WITH {O.ITEMS}, reasoned AS (SELECT *, regexp_matches(raw_text, '!\\[[^\\]]*\\]\\([^)]+\\)') AND assets = 0 AS pictured, list_contains(issues, 'answer_option_mismatch') AS mismatch FROM items), risky AS (
      SELECT *, validation_status IN ('duplicate_conflict', 'incomplete', 'rejected') OR mismatch OR pictured AS risk FROM reasoned)
      SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY seq) AS INT) AS place, question_id, validation_status, CASE WHEN validation_status = 'duplicate_conflict' THEN 'duplicate_conflict' WHEN validation_status = 'incomplete' THEN 'incomplete' WHEN mismatch THEN 'answer_option_mismatch' WHEN risk THEN 'high_risk' WHEN validation_status = 'needs_review' THEN 'needs_review' ELSE 'validated' END AS reason
      FROM risky WHERE risk OR validation_status NOT IN ('validated', 'question_only_validated')""",
    "review_merge": f"""WITH {_PUBLIC}, edited AS (SELECT *, CASE WHEN seq % 2 = 0 THEN external_id END AS eid FROM pub WHERE status <> 'ready' AND (doc_id + seq) % 3 = 0)
      SELECT doc_id, CASE WHEN patched THEN 'ready' ELSE status END AS status, patched, count(*) AS n_questions FROM (
        SELECT doc_id, status, EXISTS (SELECT 1 FROM edited e WHERE e.doc_id = p.doc_id AND (e.eid = p.external_id OR e.question_number = p.question_number)) AS patched FROM pub p) GROUP BY ALL""",
    "solution_overlap": f"""WITH {O.MAPPINGS}, firsts AS (SELECT doc_id, question_number, arg_min(raw_text, start_line) AS solution FROM solutions GROUP BY doc_id, question_number), t AS (
      SELECT c.doc_id, c.question_id, {_TOKENS.format('stem')} AS a, {_TOKENS.format('solution')} AS b FROM candidates c JOIN firsts USING (doc_id, question_number))
      SELECT doc_id, question_id, CASE WHEN len(a) = 0 THEN 0 ELSE round(len(list_intersect(a, b)) / len(a), 6) END AS overlap FROM t""",
    "chosen_options": f"""WITH l AS (SELECT conv_id, turn, coalesce({OL.strip('line')}, '') AS b FROM (SELECT *, {_SHEET} AS line FROM (SELECT *, conv_id + turn AS n FROM conversations)))
      SELECT conv_id, turn, {_INSTR} AS instruction, b <> '' AND NOT {_INSTR} AND ({OL.has('b', markers.CHOSEN)} OR (contains(lower(b), 'chosen option') AND contains(b, ':'))) AS metadata,
        CASE WHEN regexp_full_match(translate(upper({_CHOICE}), '1234', 'ABCD'), '[A-D]') THEN translate(upper({_CHOICE}), '1234', 'ABCD') END AS chosen_key FROM l""",
    "language_profiles": """WITH t AS (SELECT conv_id, CASE WHEN conv_id % 3 = 0 THEN coalesce(text, '') || ' हिन्दी' WHEN conv_id % 7 = 1 THEN '१२ ।' WHEN conv_id % 7 = 2 THEN '12' ELSE text END AS x FROM conversations),
      g AS (SELECT conv_id, bool_or(regexp_matches(x, '[ऀ-ॿ]')) AS d, bool_or(regexp_matches(x, '[A-Za-z]')) AS l FROM t GROUP BY conv_id)
      SELECT conv_id, CASE WHEN d AND l THEN 'mixed' WHEN d THEN 'hindi' WHEN l THEN 'english' ELSE 'unknown' END AS profile FROM g""",
    "option_keys": f"""WITH {LINES_SQL}, words AS (SELECT string_split_regex({OL.strip('raw')}, '\\s+') AS w FROM lines), labels AS (SELECT unnest([w[1], coalesce(w[2], ''), CASE WHEN len(w) > 1 THEN w[1] || ' ' || w[2] ELSE '' END]) AS label FROM words), k AS (SELECT label FROM labels WHERE label <> ''), w AS (SELECT label, {_WORD} AS word FROM k), r AS (
      SELECT label, {_key_sql('word')} AS option_key, coalesce(CASE WHEN {OL.has('label', OL.P.ANSWER_PREFIX)} THEN upper({OL.part('label', OL.P.ANSWER_PREFIX)}) END, {_key_sql('word')}) AS answer_key FROM w)
      SELECT label, option_key, answer_key, count(*) AS n FROM r GROUP BY ALL""",
}
