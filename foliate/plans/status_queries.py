"""Queries on grounding, readiness, review, gates and audits, with their checking SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliate.functions import issues as I
from foliate.functions import patterns as P
from foliate.operators import gates as G
from foliate.operators import packages as K
from foliate.operators import sections as S
from foliate.operators import segment
from foliate.operators import status as R
from foliate.plans import gate_queries as GQ
from foliate.plans import oracle_lines as OL
from foliate.plans import oracle_packages as O
from foliate.plans import package_queries as PQ
from foliate.plans import section_queries as SQ
from foliate.plans import tables


#: What is judged of an item, besides the text of its solution.
_JUDGED = ("doc_id", "seq", "question_id", "question_number", "question_text_raw", "options", "answer_key", "assets", "issues")


def _windows(spark, sf_dir):
    return SQ.ranked_windows(spark, sf_dir)


def _judged(spark, sf_dir):
    """Items with what the gates, the quarantine and their windows say about them, and their status."""

    def made():
        items, expected = GQ._items(spark, sf_dir)
        items = items.select(*_JUDGED, F.struct("solution.raw_text").alias("solution"))  # the text of a whole window is left out
        bad = G.bad_items(items, expected).select("doc_id", "question_id", F.concat(F.lit(I.BAD_ITEM), F.concat_ws(",", "classes")).alias("bad"))
        joined = G.acceptance(items).join(bad, ["doc_id", "question_id"], "left")
        found = R.grounded(joined, _windows(spark, sf_dir), tables.classified(spark, sf_dir))
        strange = F.col("has_evidence") & ~F.col("text_found")
        every = F.concat("issues", "gate_issues", F.array_compact(F.array("bad", F.when(strange, F.lit("hallucinated_question_text")))))
        flagged = found.withColumns({"issues": F.array_distinct(every), "quality": F.when(strange, "blocked").otherwise(F.col("quality"))})
        return R.readiness(R.triaged(tables.stored(spark, sf_dir, flagged, "grounded")), answers_expected=True)

    return tables.shared(spark, sf_dir, "judged", made)


def item_readiness(spark, sf_dir):
    """Status, quality and public issues of every item, and whether its window holds it."""
    out = _judged(spark, sf_dir)
    return out.select("doc_id", "question_id", "has_evidence", "text_found", "words_found", "options_found", "lifted", "status", "quality", R.window_quality(out).alias("window_quality"), F.concat_ws("+", F.array_sort("review_issues")).alias("review_issues"))


def readiness_counts(spark, sf_dir):
    """Items by status and quality of each document."""
    return R.readiness_counts(_judged(spark, sf_dir))


def review_items(spark, sf_dir):
    """Items for a person, with class and action."""
    return R.review_items(_judged(spark, sf_dir), G.answer_gaps(PQ._mapped(spark, sf_dir)[1]))


def quality_gate(spark, sf_dir):
    """Failed, warning or passed by document."""
    cands, items = PQ._items(spark, sf_dir)
    counts = _judged(spark, sf_dir).groupBy("doc_id").agg(F.count_if(F.col("status") != "ready").alias("review_items"))
    match = G.count_reconciliation(items, PQ._expected(items)).select("doc_id", "count_match")
    return R.quality_gate(K.reconcile(cands, items, K.eligibility(items)), segment.candidate_metrics(cands), counts.join(match, "doc_id", "left"))


def extraction_fallback(spark, sf_dir):
    """Whether the lines of a document are too weak for its questions.

    The documents are text and have no measured pages: the shares of image lines and of plain lines stand in for image area and scan score.
    """
    items, expected = GQ._items(spark, sf_dir)
    lines = tables.classified(spark, sf_dir).groupBy("doc_id").agg(F.count(F.lit(1)).alias("lines"), F.avg((F.col("line_type") == "image_reference").cast("double")).alias("image_ratio"), F.avg((F.col("line_type") == "text").cast("double")).alias("scanned_score"))
    windows = _windows(spark, sf_dir).groupBy("doc_id").agg(F.count(F.lit(1)).alias("windows"), F.count_if(F.col("status") == "ready").alias("windows_with_four"))
    bound = items.where("validation_status in ('validated', 'needs_review')").groupBy("doc_id").agg(F.count(F.lit(1)).alias("items"))
    out = R.extraction_fallback(lines.join(expected, "doc_id", "left").join(windows, "doc_id", "left").join(bound, "doc_id", "left"))
    shares = {c: F.round(c, 4) for c in ("window_ratio", "option_coverage", "missing_ratio")}
    return out.withColumns(shares).withColumn("reasons", F.concat_ws("+", "reasons")).select("doc_id", *shares, "missing_questions", "reasons", "verdict", "fallback", "underbound")


def structure_audit(spark, sf_dir):
    """How each document's candidates are made."""
    return R.structure_audit(PQ._candidates(spark, sf_dir)[1])


def issue_numbers(spark, sf_dir):
    """Question numbers by issue and document."""
    out = R.issue_numbers(PQ._candidates(spark, sf_dir)[1])
    return out.withColumn("numbers", F.concat_ws(",", F.transform("numbers", lambda x: x.cast("string"))))


def top_issues(spark, sf_dir):
    """The most frequent issues of each document."""
    return R.top_issues(PQ._candidates(spark, sf_dir)[1])


QUERIES = {f.__name__: f for f in (item_readiness, readiness_counts, review_items, quality_gate, extraction_fallback, structure_audit, issue_numbers, top_issues)}

_OLD = "CAST(count(*) + doc_id % 4 - 1 AS INT)"
_MARKED = SQ._MARKED.split(OL.CLASSIFIED, 1)[1].lstrip(", ")


def _in(names) -> str:
    return "(" + ", ".join(map(OL.q, names)) + ")"


def _some(column: str, condition: str) -> str:
    return f"(len(list_filter({column}, lambda x: {condition})) > 0)"


def _matchable(e: str) -> str:
    plain = f"regexp_replace(regexp_replace({OL.strip(e)}, {OL.q(P.BOLD)}, '\\1', 'g'), {OL.q(P.LIST_PREFIX)}, '')"
    plain = f"regexp_replace({plain}, {OL.q(R.OPTION_LABEL)}, '\\1 ')"
    spaced = f"regexp_replace({plain}, '\\s+', ' ', 'g')"
    return f"lower({OL.strip(spaced)})"


def _held(e: str) -> str:
    return f"(contains(combined, {e}) OR len(list_filter(match_lines, lambda x: contains({e}, x))) > 0)"


def _found(m: str) -> str:
    bare = OL.strip(f"regexp_replace({m}, {OL.q(R.LEADING_NUMBER)}, '')")
    return f"({m} <> '' AND ({_held(m)} OR ({bare} <> '' AND {_held(bare)})))"


def _either(e: str, parts) -> str:
    return "(" + " OR ".join(f"contains({e}, {OL.q(p)})" for p in parts) + ")"


def _known(n: str) -> str:
    return f"CASE WHEN {n} IN {_in(I.PUBLIC)} THEN {n} " + " ".join(f"WHEN {n} = '{a}' THEN '{b}'" for a, b in I.ALIASES.items()) + " END"


def _code(x: str) -> str:
    n, bare = f"lower({OL.strip(x)})", OL.strip(x)
    slug = f"regexp_replace(regexp_replace({n}, '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')"
    prose = f"(length({bare}) > {I.LONGEST} OR (contains({bare}, ' ') AND NOT contains({bare}, ':')))"
    return f"""CASE WHEN {_known(n)} IS NOT NULL THEN {_known(n)} WHEN starts_with({n}, '{I.BAD_ITEM}') THEN 'question_text_uncertain' WHEN contains({n}, 'hallucinat') THEN 'hallucination_suspected' WHEN contains({n}, 'cross_window') THEN 'cross_window_option_leakage'
      WHEN {_either(n, ('incomplete_options', 'option_incomplete'))} THEN 'incomplete_options' WHEN contains({n}, 'answer_key_not_in_options') THEN 'answer_key_not_in_options' WHEN contains({n}, 'formula') OR ({OL.has('stem', I.FORMULA)} AND contains({n}, 'option')) THEN 'formula_ocr_uncertain'
      WHEN contains({n}, 'table') AND {_either(n, ('chart', 'graph', 'corrupt'))} THEN 'table_ocr_uncertain' WHEN NOT {prose} THEN {_known(slug)} END"""


_INVENTED = _either("lower(x)", I.INVENTED)
_QUARANTINED = f"(lower({OL.strip('x')}) IN {_in(I.QUARANTINED)} OR starts_with(lower({OL.strip('x')}), '{I.BAD_ITEM}'))"
_BLOCKS = f"(x IN {_in(I.BLOCKING)} OR (x NOT IN {_in(I.ANSWER_ONLY)} AND ({_INVENTED} OR contains(x, 'cross_window') OR starts_with(x, '{I.BAD_ITEM}') OR (contains(x, 'corrupt') AND contains(x, 'question')))))"
_FIGURE = f"({_either('lower(stem)', I.FIGURE_PHRASES)} OR assets > 0)"
_LIST = "list_filter([{}], lambda x: x IS NOT NULL)"
_CODES = "list_distinct(list_filter(list_transform({}, lambda x: {}), lambda x: x IS NOT NULL))"
_OWN = _LIST.format("CASE WHEN usable < 4 THEN 'incomplete_options' END, CASE WHEN corrupt THEN 'question_text_uncertain' END, CASE WHEN list_contains(iss2, 'answer_key_not_in_options') OR list_contains(iss2, 'correct_answer_text_unavailable') THEN 'answer_key_not_in_options' END, CASE WHEN NOT said_key THEN 'expected_answer_missing' END")
_EVIDENCE = f"""{_MARKED}, win_lines AS (SELECT f.doc_id, f.line_number, f.raw, f.key_row, count(p.number) OVER (PARTITION BY f.doc_id ORDER BY f.line_number ROWS UNBOUNDED PRECEDING) AS win, p.number FROM flagged f LEFT JOIN picked p USING (doc_id, line_number)
), numbered_lines AS (SELECT *, max(number) OVER (PARTITION BY doc_id, win) AS question_number FROM win_lines WHERE win > 0
), evidence0 AS MATERIALIZED (SELECT doc_id, question_number, list_filter(list({_matchable('raw')} ORDER BY line_number), lambda x: x <> '') AS match_lines, lower(string_agg(raw, ' ' ORDER BY line_number)) AS said FROM numbered_lines WHERE NOT key_row AND {OL.strip('raw')} <> '' GROUP BY doc_id, question_number
), evidence AS (SELECT *, array_to_string(match_lines, ' ') AS combined FROM evidence0)"""
_READY = f"""{GQ._GATED}, {_EVIDENCE}, old_expected AS (SELECT doc_id, {_OLD} AS n FROM items GROUP BY doc_id
), near AS MATERIALIZED (
  SELECT g.*, coalesce(e.match_lines, CAST([] AS VARCHAR[])) AS match_lines, coalesce(e.combined, '') AS combined, coalesce(e.said, '') AS said, {_matchable('g.stem')} AS m, regexp_extract_all(g.stem, {OL.q(R.WORD)}) AS words,
    coalesce(question_number < 1 OR question_number > x.n, false) OR row_number() OVER (PARTITION BY g.doc_id, question_number ORDER BY seq) > 1 OR {GQ._KEY_LINE} OR {GQ._NOTICE} OR {GQ._BARE} = '' AS bad
  FROM gated g JOIN old_expected x USING (doc_id) LEFT JOIN evidence e USING (doc_id, question_number)
), choice_texts AS (SELECT o.doc_id, o.seq, {OL.strip('o.text')} AS t, match_lines, combined FROM opts2 o JOIN near n ON n.doc_id = o.doc_id AND n.seq = o.seq WHERE {OL.strip('o.text')} <> ''
), choice_words AS (SELECT *, {_matchable('t')} AS m, list_slice(list_filter(regexp_split_to_array(t, '\\s+'), lambda w: length(w) >= {R.LONG_WORD}), 1, {R.WORDS_TRIED}) AS ws FROM choice_texts
), backed AS (SELECT doc_id, seq, bool_and({_found('m')} OR (length(t) >= {R.LONG_WORD} AND len(list_filter(list_transform(ws, lambda w: {_matchable('w')}), lambda v: {_found('v')})) > 0)) AS options_found FROM choice_words GROUP BY doc_id, seq
), looked AS MATERIALIZED (
  SELECT n.*, len(match_lines) > 0 AS has_evidence, {_found('m')} AS text_found, len(words) >= {R.LEAST_WORDS} AND len(list_filter(words, lambda w: contains(said, lower(w)))) / greatest(len(words), 1) >= CAST({R.LEAST_OVERLAP} AS DOUBLE) AS words_found, coalesce(b.options_found, true) AS options_found,
    CASE WHEN blank THEN 'blocked' WHEN visual THEN 'visual_required' WHEN few OR lost THEN 'review_required' WHEN NOT answered THEN 'answer_unavailable' ELSE 'accepted_safe' END AS q0 FROM near n LEFT JOIN backed b USING (doc_id, seq)
), told AS (
  SELECT *, CASE WHEN has_evidence AND NOT text_found THEN 'blocked' ELSE q0 END AS q1, list_distinct(list_concat(issues, {_LIST.format("CASE WHEN few THEN 'incomplete_options' END, CASE WHEN lost THEN 'correct_answer_text_unavailable' END, CASE WHEN blank THEN 'question_text_missing' END, CASE WHEN bad THEN 'bad_item_classes:x' END, CASE WHEN has_evidence AND NOT text_found THEN 'hallucinated_question_text' END")})) AS iss1 FROM looked
), weighed AS (
  SELECT *, {_some('iss1', f'{_INVENTED} OR {_QUARANTINED}')} AND NOT list_contains(iss1, 'question_missing_from_extraction') AND NOT {_some('iss1', "contains(lower(x), 'cross_window')")} AND NOT blank AND has_evidence AND (text_found OR words_found) AND options_found AS lifted FROM told
), freed AS (
  SELECT *, CASE WHEN lifted THEN list_filter(iss1, lambda x: NOT ({_INVENTED} OR {_QUARANTINED} OR starts_with(x, 'missing_option_source_spans') OR starts_with(x, 'missing_question_source_spans'))) ELSE iss1 END AS iss2, CASE WHEN lifted THEN 'review_required' ELSE q1 END AS q2 FROM weighed
), ready0 AS (
  SELECT *, list_contains(iss2, 'question_missing_from_extraction') OR {_some('iss2', _QUARANTINED)} OR CASE WHEN {_some('iss2', _INVENTED)} THEN q2 = 'blocked' ELSE q2 = 'blocked' AND blank END AS barred, {_some('iss2', _either('x', I.CORRUPT))} AS corrupt, answered AND answer_text IS NOT NULL AS said_key, {_FIGURE} AS figure FROM freed
), ready1 AS (
  SELECT *, {_CODES.format(f'list_concat({_OWN}, iss2)', _code('x'))} AS codes FROM ready0
), ready2 AS (
  SELECT *, corrupt OR {_some('codes', _BLOCKS)} AS held FROM ready1
), ready3 AS (
  SELECT *, CASE WHEN barred THEN 'blocked' WHEN figure THEN 'visual_required' WHEN usable < 4 OR held THEN 'review' WHEN blank THEN 'blocked' ELSE 'ready' END AS status,
    CASE WHEN barred THEN {_CODES.format("list_concat(iss2, CASE WHEN blank THEN ['question_missing_from_extraction'] ELSE CAST([] AS VARCHAR[]) END)", _code('x'))}
      ELSE list_distinct(list_concat(codes, {_LIST.format("CASE WHEN figure THEN 'visual_syntax_missing' END, CASE WHEN NOT figure AND usable < 4 THEN 'incomplete_options' END, CASE WHEN NOT figure AND usable >= 4 AND NOT held AND blank THEN 'question_text_uncertain' END")})) END AS review_issues FROM ready2
), judged AS MATERIALIZED (
  SELECT *, CASE WHEN status IN ('blocked', 'visual_required') THEN status WHEN status = 'ready' AND NOT answered THEN 'answer_unavailable' WHEN status = 'ready' AND said_key THEN 'accepted_safe' ELSE 'review_required' END AS quality,
    CASE WHEN assets > 0 AND coalesce(filled, 0) < 2 THEN 'visual_required' WHEN usable < 4 THEN 'review_required' WHEN answered AND answer_text IS NOT NULL THEN 'accepted_safe' WHEN answered THEN 'review_required' ELSE 'answer_unavailable' END AS window_quality
  FROM ready3 LEFT JOIN (SELECT doc_id, seq, count(*) AS filled FROM choice_texts GROUP BY doc_id, seq) USING (doc_id, seq)
)"""
_CLASS = f"""CASE WHEN status = 'blocked' THEN 'blocked' WHEN NOT answered THEN 'answer_solution_join_gap' WHEN status = 'visual_required' OR list_contains(review_issues, 'visual_syntax_missing') THEN CASE WHEN {_either('lower(stem)', [p for p in I.FIGURE_PHRASES if 'graph' in p or 'chart' in p])} THEN 'table_or_chart_visual' ELSE 'visual_required' END
  WHEN list_contains(review_issues, 'incomplete_options') OR usable < 4 THEN 'incomplete_options' WHEN list_contains(review_issues, 'expected_answer_missing') THEN 'answer_unavailable' WHEN {_some('iss2', _either('x', ('hallucinated', 'cross_window')))} THEN 'source_text_uncertain'
  WHEN (contains(stem, '\\frac') OR contains(stem, '\\left')) AND usable < 4 THEN 'formula_uncertain' ELSE 'review_required' END"""
_ACTION = "CASE review_class " + " ".join(f"WHEN '{c}' THEN {OL.q(a)}" for c, a in R.ACTIONS.items()) + " END"
_METRIC = f"review_status = 'candidate_incomplete' OR visual OR NOT has_options OR {PQ._NOISY}"
_HOLDS = "count(*) FILTER (list_has_any(issues, {}))"
_PICK = lambda *names: _HOLDS.format("[" + ", ".join(map(OL.q, names)) + "]")
_COUNTED = ", ".join(f"count(*) FILTER (status = '{s}') AS {s}_count" for s in ("ready", "review", "visual_required", "blocked"))
_BY_QUALITY = ", ".join(f"count(*) FILTER (quality = '{s}') AS quality_{s}" for s in R.QUALITIES)
ORACLES = {
    "item_readiness": f"WITH RECURSIVE {_READY} SELECT doc_id, question_id, has_evidence, text_found, words_found, options_found, lifted, status, quality, window_quality, coalesce(array_to_string(list_sort(review_issues), '+'), '') AS review_issues FROM judged",
    "readiness_counts": f"WITH RECURSIVE {_READY} SELECT doc_id, {_COUNTED}, count(*) FILTER (status <> 'ready') AS review_items_count, {_BY_QUALITY}, count(*) FILTER (usable >= 4) AS with_four_options, count(*) FILTER (usable < 4) AS with_incomplete_options, count(*) FILTER (usable < 4 AND quality = 'accepted_safe') AS accepted_with_incomplete_options FROM judged GROUP BY doc_id",
    "review_items": f"""WITH RECURSIVE {_READY} SELECT *, CASE WHEN status = 'ready' AND review_class = 'answer_unavailable' THEN 'Question is ready for question bank; answer optional for PYQ export.' ELSE {_ACTION} END AS action FROM (SELECT doc_id, question_id, question_number, status, {_CLASS} AS review_class FROM judged
      WHERE status <> 'ready' OR {_some('list_concat(iss2, review_issues)', _either('x', ('hallucinated', 'cross_window', 'answer_key_not_in_options')))})""",
    "quality_gate": f"""WITH RECURSIVE {_READY}, lanes0 AS (SELECT doc_id, max(CASE WHEN {_METRIC} THEN 1 ELSE 0 END) AS rough FROM candidates GROUP BY doc_id), counted AS (SELECT doc_id, count(*) FILTER (status <> 'ready') AS review_items, count(*) AS n FROM judged GROUP BY doc_id)
      SELECT doc_id, CASE WHEN rough > 0 OR review_items > 0 OR counted.n <> old_expected.n THEN 'warning' ELSE 'passed' END AS quality_gate FROM lanes0 JOIN counted USING (doc_id) JOIN old_expected USING (doc_id)""",
    "extraction_fallback": f"""WITH RECURSIVE {O.ITEMS}, {_EVIDENCE}, l AS (SELECT doc_id, count(*) AS lines, avg(CASE WHEN line_type = 'image_reference' THEN CAST(1 AS DOUBLE) ELSE 0 END) AS image_ratio, avg(CASE WHEN line_type = 'text' THEN CAST(1 AS DOUBLE) ELSE 0 END) AS scanned FROM classified GROUP BY doc_id
      ), labels AS (SELECT doc_id, question_number, len(list_distinct(flatten(coalesce(list({SQ.A.option_labels(SQ._C, 'raw')}) FILTER (NOT key_row), [])))) AS found FROM numbered_lines GROUP BY doc_id, question_number
      ), v AS (SELECT doc_id, count(*) AS windows, count(*) FILTER (found >= {S.FOUR}) AS four FROM labels GROUP BY doc_id
      ), i AS (SELECT doc_id, {_OLD} AS wanted, count(*) FILTER (validation_status IN ('validated', 'needs_review')) AS items FROM items GROUP BY doc_id
      ), m AS (SELECT doc_id, lines, image_ratio, scanned, coalesce(windows, 0) AS windows, coalesce(four, 0) AS four, coalesce(wanted, 0) AS wanted, coalesce(items, 0) AS items FROM l LEFT JOIN v USING (doc_id) LEFT JOIN i USING (doc_id)
      ), r AS (SELECT *, CASE WHEN wanted > 0 THEN windows / wanted ELSE 0 END AS wr, CASE WHEN windows > 0 THEN four / windows ELSE 0 END AS oc, CASE WHEN wanted > 0 THEN greatest(0, wanted - windows) ELSE 0 END AS missing FROM m
      ), s AS (SELECT *, CASE WHEN wanted > 0 THEN missing / wanted ELSE 0 END AS mr FROM r
      ), t AS (SELECT *, wanted > 0 AND wr >= CAST({R.GOOD_WINDOWS} AS DOUBLE) AND oc >= CAST({R.GOOD_OPTIONS} AS DOUBLE) AND mr <= CAST({R.GOOD_MISSING} AS DOUBLE) AS good, concat_ws('+', CASE WHEN lines < {R.LEAST_LINES} THEN 'marker_line_count_low' END, CASE WHEN wanted > 0 AND wr < CAST({R.LEAST_WINDOWS} AS DOUBLE) THEN 'question_window_count_low' END,
        CASE WHEN wanted > 0 AND oc < CAST({R.LEAST_OPTIONS} AS DOUBLE) THEN 'option_coverage_low' END, CASE WHEN wanted > 0 AND mr > CAST({R.MOST_MISSING} AS DOUBLE) THEN 'missing_question_count_high' END, CASE WHEN scanned >= CAST({R.SCANNED} AS DOUBLE) THEN 'scanned_or_screenshot_score_high' END, CASE WHEN image_ratio >= CAST({R.MUCH_IMAGE} AS DOUBLE) AND lines < {2 * R.LEAST_LINES} THEN 'high_image_area_low_marker_lines' END) AS why FROM s
      ) SELECT doc_id, round(wr, 4) AS window_ratio, round(oc, 4) AS option_coverage, round(mr, 4) AS missing_ratio, CAST(missing AS BIGINT) AS missing_questions, CASE WHEN good THEN '' ELSE why END AS reasons, CASE WHEN good THEN 'good' WHEN why <> '' THEN 'weak' ELSE 'acceptable' END AS verdict, NOT good AND why <> '' AS fallback,
        windows > 0 AND items > 0 AND (items < floor(windows * CAST({R.UNDERBOUND_WINDOWS} AS DOUBLE)) OR (wanted > 0 AND windows >= floor(wanted * CAST({R.ENOUGH_WINDOWS} AS DOUBLE)) AND items < floor(wanted * CAST({R.ENOUGH_ITEMS} AS DOUBLE)))) AS underbound FROM t""",
    "structure_audit": f"""WITH {O.CANDIDATES} SELECT doc_id, count(*) AS total_candidates, count(*) FILTER (has_options AND len(option_keys) > 0 AND NOT expected) AS invalid_option_count_questions, {_PICK('same_line_option_split_applied')} AS same_line_option_split_count, count(*) FILTER (visual) AS visual_dependent_count,
      count(*) FILTER (visual AND expected AND usable = n_options) AS visual_with_text_options_count, count(*) FILTER (expected AND all_linked) AS visual_with_image_options_count, {_PICK('missing_option_labels_for_visual_question', 'source_backed_option_labels_missing')} AS visual_missing_option_labels_count,
      {_PICK('possible_noise_asset_after_options')} AS noise_asset_candidate_count, {_PICK('visual_question_requires_review', 'visual_question_requires_diagram_syntax')} AS candidates_requiring_visual_review FROM candidates GROUP BY doc_id""",
    "issue_numbers": f"WITH {O.CANDIDATES} SELECT doc_id, issue, array_to_string(list_sort(list(DISTINCT question_number)), ',') AS numbers FROM (SELECT doc_id, question_number, unnest(issues) AS issue FROM candidates WHERE question_number IS NOT NULL) GROUP BY doc_id, issue",
    "top_issues": f"""WITH {O.CANDIDATES}, each AS (SELECT doc_id, seq, generate_subscripts(issues, 1) AS place, unnest(issues) AS name FROM candidates), renamed AS (SELECT doc_id, seq, place, CASE name WHEN 'unlabeled_option_images' THEN 'unlabeled_visual_assets' ELSE name END AS issue FROM each
      ), tallied AS (SELECT doc_id, issue, count(*) AS n, min(seq * 100000 + place) AS earliest FROM renamed GROUP BY doc_id, issue) SELECT * FROM (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, earliest) AS INT) AS rank, issue, n FROM tallied) WHERE rank <= {R.MOST_ISSUES}""",
}
