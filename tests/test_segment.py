"""Question candidates on one small document."""

from foliate.operators import lines as L
from foliate.operators import segment as S

TEXTS = ["Q1. which of these is it", "![f](stem.png)", "(a) one", "more of one", "![f](late.png)", "this is cut off", "(b)", "![f](b.png)", "(c) three (d) four", "Q2. and which of those", "### Solutions", "S1. Ans(a)"]


def content(spark):
    df = spark.createDataFrame([(1, i + 1, t) for i, t in enumerate(TEXTS)], "doc_id long, line_number int, raw string")
    return L.content_lines(L.classified_lines(df))


def test_images_meet_their_options_and_windows_end_at_the_solutions(spark):
    one, two = S.candidates(content(spark)).orderBy("seq").collect()
    assert [(o.key, o.text, o.linked) for o in one.options] == [("A", "one\nmore of one", False), ("B", "", True), ("C", "three", False), ("D", "four", False)]
    assert (one.assets, one.noise_assets, one.question_text_raw) == (3, 2, "Q1. which of these is it")
    assert (two.options, two.end_line, two.raw_text) == (None, 10, "Q2. and which of those")


def test_candidates_shuffle_lines_by_document_once_and_join_nothing(spark):
    stored = content(spark).localCheckpoint()
    plan = S.candidates(stored)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_role_hints_undecorate_a_line_once(spark, tmp_path):
    from foliate.functions import patterns as P
    from foliate.plans import line_queries

    spark.createDataFrame([(1, "one word")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    plan = line_queries.role_hints(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(P.BOLD) == 1
