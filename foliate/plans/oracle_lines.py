"""Checking SQL for lines, content lines and blocks, as CTEs to build on."""

from __future__ import annotations

from foliate.functions import patterns as P
from foliate.sources.corpus import LINES_SQL


def q(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def has(expr: str, pattern: str) -> str:
    return f"regexp_matches({expr}, {q(pattern)})"


def part(expr: str, pattern: str, group: int = 1) -> str:
    return f"regexp_extract({expr}, {q(pattern)}, {group})"


def strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^\\s+|\\s+$', '', 'g')"


def target(expr: str) -> str:
    bare = f"regexp_replace({strip(expr)}, {q(P.LIST_PREFIX)}, '')"
    return strip(f"regexp_replace(regexp_replace({bare}, {q(P.BOLD)}, '\\1', 'g'), {q(P.HEADING)}, '')")


def label(expr: str) -> str:
    found = [f"CASE WHEN {has(expr, p)} THEN 'Q' || {part(expr, p)} END" for p in P.ANCHOR_PREFIXED]
    for p in P.ANCHOR_NUMERIC:
        rest = strip(part(expr, p, 2))
        found.append(f"CASE WHEN {has(expr, p)} AND length({rest}) >= 4 AND NOT {has(rest, P.ANSWER_LIKE)} THEN 'Q' || {part(expr, p)} END")
    return "coalesce(" + ", ".join(found) + ")"


def rules(page_markers: bool = True, table_rows: bool = True) -> str:
    """line_type, detected_label, confidence, issue, page_mark from raw, bare, plain, l1 and l2."""
    dot = f"regexp_matches({part('plain', P.OPTION_DOT, 2)}, '[=^_]')"
    found: list[tuple[str, str, str, str, str, str]] = [("bare = ''", "blank", "1.0", "NULL", "NULL", "NULL")]
    if page_markers:
        found += [(has("raw", p), "page_number_marker", c, part("raw", p), "NULL", f"CAST({part('raw', p)} AS INT)") for p, c in ((P.PAGE_NUMBER, "1.0"), (P.MARKER_PAGE, "0.9"))]
        found.append((has("raw", P.PAGE_BREAK), "page_break_marker", "1.0", "NULL", "NULL", "NULL"))
    found += [
        (f"{has('raw', P.IMAGE_REF)} AND starts_with(bare, '![')", "image_reference", "1.0", "NULL", "NULL", "NULL"),
        (f"{has('raw', P.MATH)} OR suffix(bare, '$$')", "math_block", "0.95", "NULL", "NULL", "NULL"),
    ]
    if table_rows:
        found.append((has("raw", P.TABLE_ROW), "table_row", "0.95", "NULL", "NULL", "NULL"))
    found += [
        (has("plain", P.SOLUTION_HEADING), "solution_section_heading", "0.95", "NULL", "NULL", "NULL"),
        ("l2 IS NOT NULL", "question_anchor", "0.95", "l2", "NULL", "NULL"),
        (has("plain", P.SOLUTION_ANCHOR), "solution_anchor", "0.9", f"'S' || {part('plain', P.SOLUTION_ANCHOR)}", f"CASE WHEN {has('plain', P.ANSWER_MARKER)} THEN 'contains_answer_marker' END", "NULL"),
        (has("bare", P.HEADING), "heading", "0.95", "NULL", "NULL", "NULL"),
        ("l1 IS NOT NULL", "question_anchor", "0.95", "l1", "NULL", "NULL"),
        (f"{has('plain', P.ANSWER_MARKER)} AND starts_with(lower(plain), 'ans')", "answer_marker", "0.85", part("plain", P.ANSWER_MARKER), "NULL", "NULL"),
        (has("plain", P.OPTION_PAREN), "option_candidate", "0.9", f"upper({part('plain', P.OPTION_PAREN)})", "NULL", "NULL"),
        (has("plain", P.OPTION_CLOSE), "option_candidate", "0.85", f"upper({part('plain', P.OPTION_CLOSE)})", "'close_paren_option'", "NULL"),
        (f"{has('plain', P.OPTION_DOT)} AND {dot}", "text", "0.6", "NULL", "'equation_like_content_low_confidence_option'", "NULL"),
        (has("plain", P.OPTION_DOT), "option_candidate", "0.7", f"upper({part('plain', P.OPTION_DOT)})", "'dot_option_lower_confidence'", "NULL"),
        (has("raw", P.FOOTER), "page_footer_marker", "0.85", "NULL", "NULL", "NULL"),
        (has("plain", P.METADATA), "metadata_candidate", "0.8", "NULL", "NULL", "NULL"),
    ]
    rule = "CASE " + " ".join(f"WHEN {cond} THEN {n}" for n, (cond, *_) in enumerate(found)) + f" ELSE {len(found)} END"
    found.append(("", "text", "0.9", "NULL", "NULL", "NULL"))
    pick = lambda k, wrap=str: "CASE rule " + " ".join(f"WHEN {n} THEN {wrap(x[k])}" for n, x in enumerate(found) if x[k] != "NULL") + " END"
    columns = f"{pick(1, q)} AS line_type, {pick(3)} AS detected_label, CAST({pick(2)} AS DOUBLE) AS confidence, {pick(4)} AS issue"
    mark = pick(5) if page_markers else "CAST(NULL AS INT)"
    return f"SELECT *, {columns}, {mark} AS page_mark FROM (SELECT *, {rule} AS rule FROM (SELECT *, {strip('raw')} AS bare, {label('plain')} AS l1, {label('plainer')} AS l2 FROM (SELECT *, {target('plain')} AS plainer FROM (SELECT *, {target('raw')} AS plain FROM %s))))"


CLASSIFIED = f"""{LINES_SQL}, marked AS ({rules() % 'lines'}
), classified AS (
  SELECT doc_id, line_number, raw, plain, line_type, detected_label, confidence, issue,
         last_value(page_mark IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_number ROWS UNBOUNDED PRECEDING) AS page_number
  FROM marked
)"""

_INNER = f"regexp_replace(regexp_replace({strip('raw')}, '^\\|', ''), '\\|$', '')"
_CELLS = f"list_filter(list_transform(string_split({_INNER}, '|'), lambda x: {strip('x')}), lambda c: c <> '' AND NOT regexp_full_match(replace(c, ' ', ''), {q(P.TABLE_SEPARATOR)}))"
_PARTS = f"list_filter(regexp_split_to_array(cell, {q(P.BR_TAG)}), lambda s: s <> '')"

CONTENT = f"""{CLASSIFIED}, cells AS (
  SELECT doc_id, line_number, page_number, CAST(generate_subscripts(c, 1) - 1 AS INT) AS cell_index, unnest(c) AS cell
  FROM (SELECT doc_id, line_number, page_number, {_CELLS} AS c FROM classified WHERE line_type = 'table_row')
), segments AS (
  SELECT doc_id, line_number, page_number, cell_index, CAST(generate_subscripts(p, 1) - 1 AS INT) AS segment_index, unnest(p) AS raw
  FROM (SELECT *, CASE WHEN len({_PARTS}) = 0 THEN [cell] ELSE {_PARTS} END AS p FROM cells)
), segment_lines AS ({rules(False, False) % ("(SELECT * FROM segments WHERE " + strip("raw") + " <> '')")}
), content AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY parent_line_number, cell_index NULLS FIRST, segment_index NULLS FIRST) AS INT) AS line_number,
         CASE WHEN cell_index IS NULL THEN 'raw_line' ELSE 'table_cell_segment' END AS source_kind
  FROM (
    SELECT doc_id, line_number AS parent_line_number, CAST(NULL AS INT) AS cell_index, CAST(NULL AS INT) AS segment_index, raw, plain, line_type, detected_label, confidence, issue, page_number FROM classified WHERE line_type <> 'table_row'
    UNION ALL
    SELECT doc_id, line_number, cell_index, segment_index, raw, plain, line_type, detected_label, confidence, issue, page_number FROM segment_lines
  )
)"""

_BLOCK = "CASE line_type " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in P.BLOCK_TYPES.items()) + " END"

BLOCKS = f"""{CLASSIFIED}, typed AS (SELECT *, {_BLOCK} AS block_type FROM classified
), fresh AS (
  SELECT *, CASE WHEN block_type <> 'question_candidate_block' AND block_type IS NOT DISTINCT FROM lag(block_type) OVER (PARTITION BY doc_id ORDER BY line_number) THEN 0 ELSE 1 END AS f FROM typed
), numbered_blocks AS (
  SELECT *, sum(f) OVER (PARTITION BY doc_id ORDER BY line_number ROWS UNBOUNDED PRECEDING) AS b FROM fresh
)"""
