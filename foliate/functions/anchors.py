"""What a line of evidence is: solution heading or start, question anchor, noise, option, key residue.

Each predicate is written once, as SQL text over another expression, for two
dialects: Spark's, which the operators evaluate as built-in expressions, and that of the SQL
which checks queries.  Literal cases in the tests hold the predicates themselves.
"""

from __future__ import annotations

from foliate.functions import markers
from foliate.functions import patterns as P


class Spark:
    """Spark's functions; classes in patterns are Unicode ones."""

    @staticmethod
    def quoted(pattern: str) -> str:
        return f"r'{pattern}'"

    @classmethod
    def has(cls, text: str, pattern: str) -> str:
        return f"rlike({text}, {cls.quoted('(?U)' + pattern)})"

    @classmethod
    def part(cls, text: str, pattern: str, group: int = 1) -> str:
        return f"regexp_extract({text}, {cls.quoted('(?U)' + pattern)}, {group})"

    @classmethod
    def every(cls, text: str, pattern: str, guard: str) -> str:
        return f"CASE WHEN {cls.has(text, guard)} THEN regexp_extract_all({text}, {cls.quoted('(?U)' + pattern)}, 1) ELSE array() END"

    @classmethod
    def replaced(cls, text: str, pattern: str, by: str) -> str:
        return f"regexp_replace({text}, {cls.quoted('(?U)' + pattern)}, '{by}')"

    @classmethod
    def pairs(cls, text: str) -> str:
        return f"regexp_count({text}, {cls.quoted('(?U)(?<![' + chr(92) + 'd/])' + P.KEY_PAIR)})"

    @staticmethod
    def stripped(text: str) -> str:
        return f"btrim({text}, '{P.WHITE}')"

    @staticmethod
    def let(name: str, value: str, body) -> str:
        """``body`` of ``value``, which is computed once, however often the body names it."""
        return f"get(transform(array({value}), {name} -> {body(name)}), 0)"

    first, length, joined = "$1", "char_length", "concat"


class Checking:
    """Functions of the SQL that checks queries."""

    @staticmethod
    def quoted(pattern: str) -> str:
        return "'" + pattern.replace("'", "''") + "'"

    @classmethod
    def has(cls, text: str, pattern: str) -> str:
        return f"regexp_matches({text}, {cls.quoted(pattern)})"

    @classmethod
    def part(cls, text: str, pattern: str, group: int = 1) -> str:
        return f"regexp_extract({text}, {cls.quoted(pattern)}, {group})"

    @classmethod
    def every(cls, text: str, pattern: str, guard: str) -> str:
        return f"regexp_extract_all({text}, {cls.quoted(pattern)}, 1)"

    @classmethod
    def replaced(cls, text: str, pattern: str, by: str) -> str:
        return f"regexp_replace({text}, {cls.quoted(pattern)}, '{by}', 'g')"

    @classmethod
    def pairs(cls, text: str) -> str:
        return f"len(regexp_extract_all({text}, {cls.quoted('(?:^|[^0-9/])' + P.KEY_PAIR)}))"

    @classmethod
    def stripped(cls, text: str) -> str:
        return cls.replaced(text, r"^\s+|\s+$", "")

    @staticmethod
    def let(name: str, value: str, body) -> str:
        return body(value)

    first, length, joined = r"\1", "length", "list_concat"


def guarded(text: str, pattern: str, predicate: str) -> str:
    """``predicate``, asked only of texts with ``pattern``, which is cheap and which every text that it holds for has."""
    # a branch, as what an AND's right side repeats is computed ahead for every row; of a null nothing is known
    return f"CASE WHEN {Spark.has(text, pattern)} THEN {predicate} WHEN {text} IS NOT NULL THEN false END"


def stripped(d, text: str) -> str:
    return d.stripped(text)


def unpiped(d, text: str) -> str:
    """Without the bars of a table row before the text."""
    return stripped(d, d.replaced(stripped(d, text), r"^(?:\|+\s*)+", ""))


def starts_solution(d, text: str) -> str:
    """A numbered line that carries an answer label."""
    bare = d.replaced(d.replaced(stripped(d, text), r"^[-•*]\s+", ""), r"^\*{1,2}", "")
    numbered = d.replaced(bare, P.NUMBER_PREFIX, d.first + ". ")
    return d.has(stripped(d, numbered), P.SOLUTION_START)


def squeezed(d, text: str) -> str:
    return f"lower({d.replaced(text, r'[*#_' + chr(92) + 's]+', '')})"


def heads_solutions(d, text: str) -> str:
    """A heading under which solutions may follow."""
    named = ", ".join(f"'{name}'" for name in P.SOLUTION_NAMES)
    strong = ", ".join(f"'{name}'" for name in (*P.SOLUTION_NAMES, *P.STRONG_NAMES))

    def holds(bare: str) -> str:
        known = f"({d.has(bare, P.SECTION_SOLUTION)} OR {squeezed(d, bare)} IN ({named}))"
        other = f"({d.has(bare, P.OTHER_HEADING)} AND {squeezed(d, bare)} NOT IN ({strong}))"
        return f"({bare} <> '' AND NOT {d.has(bare, P.SECTION_NOISE)} AND NOT {other} AND {known})"

    return d.let("head", stripped(d, text), holds)


def is_key_row(d, text: str) -> str:
    """A row or cell of an answer key."""

    def holds(bare: str) -> str:
        return d.let("pairs", d.pairs(bare), lambda n: f"({bare} <> '' AND ({d.has(bare, P.KEY_BARE)} OR {n} >= 2 OR ({n} = 1 AND {d.length}({bare}) < 48 AND contains({bare}, '|')) OR ({n} = 1 AND {d.length}({bare}) < 16)))")

    return d.let("key_row", stripped(d, text), holds)


def is_key_anchor(d, text: str) -> str:
    """A numbered line that is left of an answer key, not a question."""

    def holds(bare: str) -> str:
        short = lambda rest: f"(contains({bare}, '|') AND {d.pairs(bare)} >= 1 AND {d.length}({rest}) < 12)"
        left = d.let("key_rest", stripped(d, d.part(bare, P.KEY_ANCHOR, 2)), lambda rest: f"{rest} <> '' AND ({d.has(rest, P.KEY_REST)} OR {short(rest)})")
        return f"({is_key_row(d, text)} OR ({d.has(bare, P.KEY_ANCHOR)} AND {left}))"

    return d.let("key_anchor", stripped(d, text), holds)


def is_instruction(d, text: str) -> str:
    """A direction to candidates that looks like an anchor."""

    def holds(bare: str) -> str:
        phrased = " OR ".join(f"contains(lower({bare}), '{p}')" for p in markers.INSTRUCTION_PHRASES)
        chosen = f"({d.has(bare, markers.CHOSEN_INSTRUCTION)} OR {d.has(bare, markers.SHEET_INSTRUCTION)} OR (contains(lower({bare}), 'chosen option') AND NOT contains({bare}, ':') AND ({phrased})))"
        return f"({chosen} OR {d.has(bare, P.ANCHOR_INSTRUCTION)})"

    return d.let("told", stripped(d, text), holds)


def is_anchor(d, text: str) -> str:
    """A line at which a question begins."""
    return d.let("bare", stripped(d, text), lambda bare: d.let("plain", unpiped(d, text), lambda plain: _anchors(d, bare, plain)))


def _anchors(d, bare: str, plain: str) -> str:
    strong = f"({d.has(bare, P.STRONG_ANCHOR)} OR {d.has(plain, P.STRONG_ANCHOR)})"
    used = f"CASE WHEN {d.has(bare, P.WINDOW_ANCHOR)} THEN {d.length}({d.part(bare, P.WINDOW_ANCHOR, 0)}) ELSE {d.length}({d.part(plain, P.WINDOW_ANCHOR, 0)}) END"
    begun = d.let("begun", stripped(d, f"substr({plain}, CAST({used} + 1 AS INT))"), lambda rest: f"{d.length}({rest}) >= 8 AND NOT {d.has(rest, '^[0-9]+$')}")
    loose = f"(({d.has(bare, P.WINDOW_ANCHOR)} OR {d.has(plain, P.WINDOW_ANCHOR)}) AND {begun})"
    no = f"{plain} = '' OR {d.has(plain, P.BARE_OPTION)} OR {is_instruction(d, plain)} OR {is_key_anchor(d, plain)} OR {starts_solution(d, plain)}"
    return f"(NOT ({no}) AND ({strong} OR {d.has(plain, P.LETTER_ANCHOR)} OR {loose}))"


def anchor_number(d, text: str) -> str:
    """The number of an anchor, by its prefix or the first ``Q`` number inside; null without one."""
    bare = stripped(d, text)
    return f"CAST(coalesce(nullif({d.part(bare, P.WINDOW_ANCHOR)}, ''), nullif({d.part(bare, P.INLINE_ANCHOR)}, '')) AS INT)"


def anchor_rank(d, text: str) -> str:
    """How much a line looks like the question of its number, apart from where it stands."""
    bare = stripped(d, text)
    rank = f"{d.length}({bare})"
    for holds, points in ((starts_solution(d, text), -5000), (is_instruction(d, text), -20000), (f"({d.has(bare, P.EXPLICIT_ANCHOR)} OR {d.has(bare, P.PIPE_ANCHOR)})", 500), (is_key_anchor(d, text), -1000), (f"(contains({bare}, '|') AND {d.pairs(bare)} >= 1)", -500)):
        rank += f" + CASE WHEN {holds} THEN {points} ELSE 0 END"
    return f"CAST({rank} AS INT)"


def goes_on(d, text: str) -> str:
    """An anchor that counts even after the heading of an answer key."""
    bare = stripped(d, text)
    plain = stripped(d, d.replaced(bare, r"^\|+", ""))
    used = f"CASE WHEN {d.has(plain, P.WINDOW_ANCHOR)} THEN {d.length}({d.part(plain, P.WINDOW_ANCHOR, 0)}) ELSE {d.length}({d.part(bare, P.WINDOW_ANCHOR, 0)}) END"
    rest = stripped(d, d.replaced(stripped(d, f"substr({bare}, CAST({used} + 1 AS INT))"), r"^\|+", ""))
    long = f"(({d.has(plain, P.WINDOW_ANCHOR)} OR {d.has(bare, P.WINDOW_ANCHOR)}) AND {d.length}({rest}) >= 12 AND NOT {is_key_row(d, bare)})"
    return f"({d.has(bare, P.STRONG_ANCHOR)} OR {d.has(plain, P.STRONG_ANCHOR)} OR {long})"


def option_labels(d, text: str) -> str:
    """Every label of an option in a line of a window, in capitals."""
    found = [d.every(text, p, g) for p, g in zip(P.WINDOW_LABELS, P.LABEL_GUARDS, strict=True)]
    joined = f"{d.joined}({found[0]}, {d.joined}({found[1]}, {found[2]}))"
    return f"transform({joined}, x -> upper(x))" if d is Spark else f"list_transform({joined}, lambda x: upper(x))"


def solution_label(d, text: str) -> str:
    """The first answer label in a line, in capitals; null without one."""
    groups = ", ".join(f"nullif({d.part(stripped(d, text), P.SOLUTION_LABEL, g)}, '')" for g in (1, 2, 3))
    return f"upper(coalesce({groups}))"


def solution_number(d, text: str) -> str:
    return f"CAST(nullif({d.part(stripped(d, text), P.SOLUTION_NUMBER)}, '') AS INT)"


def is_noise(d, text: str) -> str:
    return d.has(text, P.WINDOW_NOISE)


def is_solution_noise(d, text: str) -> str:
    return d.has(text, P.SOLUTION_NOISE)


def is_option_line(d, text: str) -> str:
    return f"({d.has(text, P.WINDOW_OPTION)} OR {d.has(text, P.NUMBERED_ANSWER)})"


def is_status_line(d, text: str) -> str:
    return f"({d.has(text, P.STATUS_LINE)} OR {d.has(text, P.QUESTION_ID)})"
