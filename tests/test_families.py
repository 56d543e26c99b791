"""Options inside lines: literal cases of every family, and of windows."""

import pytest

from foliate.operators import families


def by_line(spark, texts, anchors=()):
    df = spark.createDataFrame([(i, t, i in anchors) for i, t in enumerate(texts)], "i int, raw string, is_anchor boolean")
    from pyspark.sql import functions as F

    return [{o.key: o.text for o in r.options} for r in families.line_options(df, anchor=F.col("is_anchor")).orderBy("i").collect()]


CASES = [
    ("(a) 20,28 (b) 15,21", {"A": "20,28", "B": "15,21"}),
    ("  - (a) 20,28 (b) 15,21", {"A": "20,28", "B": "15,21"}),
    ("- - (c) 25,40 (d) 10,14", {"C": "25,40", "D": "10,14"}),
    ("(d) Cannot be determined", {"D": "Cannot be determined"}),
    ("1. Alpha 2. Beta 3. Gamma 4. Delta", {"A": "Alpha", "B": "Beta", "C": "Gamma", "D": "Delta"}),
    ("(a) f(x) = 2 (b) g(y)", {"A": "f(x) = 2", "B": "g(y)"}),
    ("(*a*) one (*b*) two", {"A": "one", "B": "two"}),
    ("**A** first **B** second", {"A": "first", "B": "second"}),
    ("A. one B. two", {"A": "one", "B": "two"}),
    ("A. One two", {"A": "One two"}),
    ("c plain text", {"C": "plain text"}),
    ("✓ B. <b>ticked</b>", {"B": "ticked"}),
    ("| A | red | B | blue |", {"A": "red", "B": "blue"}),
    ("| А | look-alike |", {"A": "look-alike"}),
    ("|| B   from a table |", {"B": "from a table"}),
    (r"$$\mathsf{c} x^2$$", {"C": r"$$\mathsf{c} x^2$$"}),
    ("(3) third", {"C": "third"}),
    ("Ans 2. two", {"B": "two"}),
    ("7. not an option number", {}),
    ("12. B", {}),
    ("plain words of a stem", {}),
    ("", {}),
    (None, {}),
]


def test_families(spark):
    got = by_line(spark, [c[0] for c in CASES])
    assert [(t, g) for (t, _), g in zip(CASES, got, strict=True)] == CASES


def test_anchors_are_read_after_their_number(spark):
    lines = ["- **1.** The ages of A and B are in the ratio 5:7", "**2.** Which is it? (a) one (b) two", "Q3. (a) x (b) y"]
    assert by_line(spark, lines, {0, 1, 2}) == [{}, {"A": "one", "B": "two"}, {"A": "x", "B": "y"}]
    assert by_line(spark, lines) == [{}, {"A": "one", "B": "two"}, {"A": "x", "B": "y"}]


@pytest.mark.parametrize("rows, options, stem", [
    ([("- **1.** The ages of A and B are in the ratio 5:7. Five years ago, their ages were in the", True, False), ("  - (a) 20,28 (b) 15,21", False, True), ("- - (c) 25,40 (d) 10,14", False, True)],
     {"A": "20,28", "B": "15,21", "C": "25,40", "D": "10,14"}, "The ages of A and B are in the ratio 5:7. Five years ago, their ages were in the"),
    ([("**2.** Four years ago, the ratio was 3 : 5.", True, False), ("more of it", False, False), ("(a) 32 years (b) 24 years", False, True), ("(a) again (c) 26", False, True), ("www.site.org (d) no", False, True), ("![x](y.png)", False, False)],
     {"A": "32 years", "B": "24 years", "C": "26"}, "Four years ago, the ratio was 3 : 5. more of it"),
    ([("5. Which one (a) x", True, False), ("(b) from an option line", False, True), ("(a) of another", False, True), ("", False, False), (None, False, False), ("3. B", False, True)], {"A": "of another", "B": "from an option line"}, "Which one"),
])
def test_windows(spark, rows, options, stem):
    df = spark.createDataFrame([(1, 1, i, *r) for i, r in enumerate(rows)], "doc_id long, question_number int, line_number int, raw string, is_anchor boolean, is_option_line boolean")
    (got,) = families.window_options(families.read_lines(df)).collect()
    assert {o.key: o.text for o in got.options} == options and got.stem == stem
    assert families.window_options(families.read_lines(df.limit(0))).count() == 0


def test_noise_is_asked_of_lines_that_may_be(spark):
    from pyspark.sql import functions as F

    from foliate.functions import patterns as P
    from foliate.functions import text as T

    noise = ["Free  Mock", "DOWNLOAD pdf", "www.x", "ſubscribe now", "all EXAMS", "one subscription", "attempt free mock", "personalIsed report", "unlimited re-attempt", "exam covered", "Refund", "unlİmited reattempt"]
    df = spark.createDataFrame([(t,) for t in [*noise, "a plain line"]], "raw string")
    raw = F.col("raw")
    told = df.select("raw", T.has(raw, P.OPTION_NOISE).alias("noise"), (F.lower(raw).rlike(P.OPTION_NOISE_GUARD) | raw.rlike(P.FOLDED)).alias("asked")).collect()
    assert [r.raw for r in told if r.noise and not r.asked] == [] and not told[-1].asked
    assert sum(r.noise for r in told) >= 11


def test_options_of_one_line_are_split_as_their_pattern_groups_them(spark):
    from pyspark.sql import functions as F

    from foliate.functions import patterns as P
    from foliate.functions import text as T

    texts = ["(a) one (*b*) two  (c)   (d)", "(a)  x (b)", "- **a** one * **b** two", "**a** x **b**  **c** y z", "a. one b. two", "x A.  one B. two\rC. three", "1. one 2) two Ans 3 . three", "answer 12) x ٣. y", "(a) (b) c", "plain"]
    df = spark.createDataFrame([(t + e,) for t in texts for e in ("", " (b) end", " **c** end", " D. end", " 4) end")], "raw string")
    for pattern in (*P.SEVERAL, P.SEVERAL_NUMERIC):
        every = [F.regexp_extract_all("raw", F.lit(T.uni(pattern)), F.lit(g)) for g in (1, 2)]
        entries = families._several(F.col("raw"), pattern, 1, F.lit(True))
        found = df.select(F.transform(entries, lambda e: F.concat_ws("|", e["raw"], e["text"])).alias("got"), F.zip_with(*every, lambda k, t: F.concat_ws("|", k, T.strip(t))).alias("want")).collect()
        assert [r.got for r in found] == [r.want for r in found] and any(len(r.got) > 1 for r in found)
    plan = df.select(families._several(F.col("raw"), P.SEVERAL[0], 1, F.lit(True)).alias("x"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("regexp_extract_all") == 1
