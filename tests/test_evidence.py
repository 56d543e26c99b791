"""Evidence, export, sources and streaming on small inputs."""

import json

import pytest
from pyspark.sql import functions as F

from foliate.functions import markers
from foliate.operators import detect as D
from foliate.operators import evidence as V
from foliate.operators import export as X
from foliate.operators import gates as G
from foliate.operators import packages as K
from foliate.plans.lineage import drop, durable
from foliate.sources import layout, packages
from foliate.streaming import arrivals


def test_layout_json_to_lines(spark):
    good = {"content": "a b", "pages": [{"pageNumber": 1, "lines": [{"content": "first", "polygon": [1, 2, 5, 2, 5, 4, 1, 4]}, {"content": "bare"}]}, {"pageNumber": 2, "lines": []}], "tables": [{"rowCount": 1}]}
    df = spark.createDataFrame([(1, json.dumps(good)), (2, "not json"), (3, None)], "doc_id long, response string")
    got = layout.layout_lines(layout.parsed(df)).collect()
    assert [(r.doc_id, r.page_number, r.line_index, r.text_raw, r.bbox) for r in got] == [(1, 1, 0, "first", [1.0, 2.0, 5.0, 4.0]), (1, 1, 1, "bare", None)]
    counts = {r.doc_id: (r.pages, r.lines, r.tables, r.figures) for r in layout.layout_summary(layout.parsed(df)).collect()}
    assert counts[1] == (2, 2, 1, 0) and counts[2] == (0, 0, 0, 0) and counts[3] == (0, 0, 0, 0)


def test_second_engine_adds_only_new_lines(spark):
    kinds = "doc_id long, line_id string, page_number int, text string"
    first = spark.createDataFrame([(1, "m1", 1, "The quick brown fox jumps over the dog"), (1, "m2", None, "A line without a page number here"), (2, "m3", 1, "other")], kinds)
    second = spark.createDataFrame([(1, "o1", 1, "The quick brown fox jumps over the dot"), (1, "o2", 2, "The quick brown fox jumps over the dog"), (1, "o3", 7, "a line without a page number here"), (1, "o4", 1, " "), (2, "o5", 1, "new"), (3, "o6", 1, "alone")], kinds)
    got = {(r.line_id, r.duplicate) for r in V.duplicates(second, first).collect()}
    assert got == {("o1", True), ("o2", False), ("o3", True), ("o4", True), ("o5", False), ("o6", False)}
    assert sorted(r.line_id for r in V.merged(first, second).collect()) == ["m1", "m2", "m3", "o2", "o5", "o6"]


def test_repeats_are_measured_from_the_last_accepted(spark):
    df = spark.createDataFrame([([0, 4, 8, 20, 22],), ([],), ([3],)], "p array<int>")
    assert [r.k for r in df.select(V.accepted(F.col("p"), 5).alias("k")).collect()] == [[0, 8, 20], [], [3]]


def test_chunks_start_anew(spark):
    rows = [(1, i, f"qw_{i:04d}", n) for i, n in enumerate([30, 80, 20, 200, 5, 5], 1)]
    got = V.chunks(spark.createDataFrame(rows, "doc_id long, start_line int, window_id string, n_lines long")).orderBy("chunk_index").collect()
    assert [(r.windows, r.n_lines) for r in got] == [(2, 110), (1, 20), (1, 200), (2, 10)]


def test_ranges(spark):
    df = spark.createDataFrame([(1, n) for n in (5, 1, 2, 2, 7, 6, None)], "doc_id long, number int")
    assert sorted((r["first"], r["last"], r.n) for r in V.ranges(df).collect()) == [(1, 2, 2), (5, 7, 3)]


def test_chosen_options_and_scripts(spark):
    rows = [("Chosen Option : 2", False, True, "B"), ("chosen option: c", False, True, "C"), ("Chosen Option : --", False, True, None), ("Chosen option on the right indicates it", True, False, None), ("Options shown in green are right", True, False, None), ("", False, False, None)]
    df = spark.createDataFrame(rows, "t string, i boolean, m boolean, k string")
    got = df.select("t", markers.is_chosen_instruction(F.col("t")), markers.is_chosen_metadata(F.col("t")), markers.chosen_key(F.col("t")))
    assert [tuple(r) for r in got.collect()] == rows
    scripts = [(["abc", "हिन्दी"], "mixed"), (["हिन्दी"], "hindi"), (["x"], "english"), (["12", None], "unknown"), ([], "unknown")]
    df = spark.createDataFrame(scripts, "t array<string>, p string")
    assert [r.got for r in df.select(markers.language_profile(F.filter("t", lambda x: x.isNotNull())).alias("got")).collect()] == [p for _, p in scripts]


ITEM = "doc_id long, seq long, question_id string, question_number int, question_text_raw string, raw_text string, options array<struct<key:string,text:string>>, answer_key string, solution struct<raw_text:string>, issues array<string>, assets long, validation_status string, item_confidence double"


def item(seq, number, text="What is it?", keys="ABCD", answer="A", issues=(), status="validated"):
    return (1, seq, f"q_{seq:04d}", number, text, text, [(k, f"text {k}") for k in keys], answer, ("because",), list(issues), 0, status, 0.9)


def test_slots_keep_the_best_and_fill_gaps(spark):
    items = spark.createDataFrame([item(1, 1, keys="AB"), item(2, 1), item(3, 3, text="12. B"), item(4, 3, answer=None), item(5, 9)], ITEM)
    expected = spark.createDataFrame([(1, 4), (2, 1), (3, 0)], "doc_id long, expected_count int")
    got = sorted((r.doc_id, r.question_number, r.final_question_id, r.status, r.competitors) for r in K.slots(items, expected).collect())
    assert got == [(1, 1, "q_0002", "validated", 2), (1, 2, "fq_missing_0002", "blocked", 0), (1, 3, "q_0004", "validated", 2), (1, 4, "fq_missing_0004", "blocked", 0), (2, 1, "fq_missing_0001", "blocked", 0)]


def test_public_json_audit_and_review(spark, tmp_path):
    items = spark.createDataFrame([item(1, 1), item(2, 2, keys="AB"), item(3, 2, text=""), item(4, 5, text="Look at the diagram")], ITEM)
    public = durable(X.public_questions(items))
    assert sorted((r.external_id, r.status) for r in public.collect()) == [("Q001", "ready"), ("Q002", "blocked"), ("Q002", "review"), ("Q005", "visual_required")]
    [row] = X.public_json(public).collect()
    questions = json.loads(row.json)["questions"]
    assert [q["externalId"] for q in questions] == ["Q001", "Q002", "Q002", "Q005"]
    assert questions[0]["correctAnswer"] == {"label": "A", "text": "text A"} and questions[2]["questionText"] is None
    [audit] = X.public_audit(public, spark.createDataFrame([(1, 4)], "doc_id long, expected_count int")).collect()
    assert (audit.total, audit.repeated_numbers, audit.out_of_range, audit.missing_ids, audit.passed) == (4, 1, 1, 2, False)
    [counts] = X.status_counts(public).collect()
    assert (counts.ready_count, counts.review_count, counts.non_ready_count) == (1, 1, 3)
    base = public.select("doc_id", "external_id", "question_number", "status")
    review = spark.createDataFrame([(1, "Q005", 5, "ready", 1), (1, None, 2, "review", 2), (1, None, 2, "ready", 3)], "doc_id long, external_id string, question_number int, status string, position int")
    merged = sorted((r.question_number, r.status, r.patched) for r in X.merge_review(base, review).collect())
    assert merged == [(1, "ready", False), (2, "ready", True), (2, "ready", True), (5, "ready", True)]
    path = packages.write_json(X.public_json(public), str(tmp_path), "public")
    assert spark.read.text(path).count() == 1
    lanes = packages.write_lanes(items.withColumn("eligibility_status", F.col("validation_status")), str(tmp_path), "lanes")
    assert spark.read.parquet(lanes).count() == 4
    packages.append_events(spark.createDataFrame([("a",)], "event string"), str(tmp_path))
    assert spark.read.json(packages.append_events(spark.createDataFrame([("b",)], "event string"), str(tmp_path))).count() == 2
    drop(public)


def test_paths_stay_inside(tmp_path):
    for bad in ("/etc/x", str(tmp_path), f"{tmp_path}/../x", f"{tmp_path}x/y"):
        with pytest.raises(ValueError):
            packages.inside(str(tmp_path), bad)


def test_files_and_line_ends(spark, tmp_path):
    (tmp_path / "My Paper (1).pdf").write_bytes(b"%PDF /Type /Pages /Count 3 /Type /Page x /Type /Page ")
    (tmp_path / "b.pdf").write_bytes(b"/Count 12")
    (tmp_path / "c.txt").write_text("no")
    assert [(r.stem, r.length) for r in packages.input_files(spark, str(tmp_path)).collect()] == [("my_paper_1", 53), ("b", 9)]
    pdfs = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(str(tmp_path)).orderBy("path")
    assert [r.n for r in pdfs.select(packages.page_count(F.col("content")).alias("n")).collect()] == [2, 12]
    docs = spark.createDataFrame([(1, "a\r\nb\x0bc\n\nd\n"), (2, ""), (3, None)], "doc_id long, text string")
    assert [(r.doc_id, r.line_number, r.raw) for r in packages.markdown_lines(docs).orderBy("doc_id", "line_number").collect()] == [(1, 1, "a"), (1, 2, "b"), (1, 3, "c"), (1, 4, ""), (1, 5, "d")]
    both = packages.preferred(docs.where("doc_id = 1"), docs.withColumn("text", F.lit("x")))
    assert sorted((r.doc_id, r.text[:1]) for r in both.collect()) == [(1, "a"), (2, "x"), (3, "x")]


def test_arriving_files_are_structured_once(spark, tmp_path):
    source, root = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    for round_, name in enumerate(("one", "two")):
        (source / f"{name}.md").write_text("Q1. What is it?\n(a) x\n")
        arrivals.structure(arrivals.watch(spark, str(source)), str(root), str(tmp_path / "checkpoint")).awaitTermination()
        got = spark.read.parquet(str(root / "lines"))
        assert got.count() == 2 * (round_ + 1) and got.where("line_type = 'question_anchor'").count() == round_ + 1


def test_numeric_options(spark):
    rows = [("1. one 2) two 3. three", ["1A:one", "2B:two", "3C:three"]), ("Ans 2) so", ["2B:so"]), ("( 4 )<br>four", ["4D:four"]), ("7. odd", ["7-:odd"]), ("1. a 1. b", ["1A:a"]), ("none", []), ("", [])]
    df = spark.createDataFrame([r[0] for r in rows], "string").select(D.numeric_options(F.col("value")).alias("o"))
    assert [[f"{o.key}{o.canonical_key or '-'}:{o.text}" for o in r.o] for r in df.collect()] == [r[1] for r in rows]


def test_answer_key_evidence(spark):
    texts = ["1. A", "see 2. B there", "3. C 4) d", "Answer Key", "anything 5-a here", "Key: 6 B", "4. D", "2/7. A", "301. B"]
    rows = [(1, i + 1, t, t, "text") for i, t in enumerate(texts)]
    got = D.answer_key_candidates(spark.createDataFrame(rows, "doc_id long, line_number int, raw string, plain string, line_type string"))
    assert sorted((r.question_number, r.answer_key, r.line_number, r.confidence) for r in got.collect()) == [(1, "A", 1, 0.75), (3, "C", 3, 0.75), (4, "D", 3, 0.75), (5, "A", 5, 0.9), (6, "B", 6, 0.9)]


def test_response_sheets_and_sanity(spark):
    rows = [(1, 1, "Question ID : 5", "text", None), (1, 2, "Status : Answered", "text", None), (1, 3, "Chosen Option : 2", "text", None), (2, 1, "Q1. x", "question_anchor", "Q1"), (2, 20, "Q1. x", "question_anchor", "Q1"), (2, 24, "Chosen option on the right", "text", None)]
    got = {r.doc_id: r for r in D.layouts(spark.createDataFrame(rows, "doc_id long, line_number int, raw string, line_type string, detected_label string")).collect()}
    assert got[1].response_sheet and got[1].unsupported and got[1].sheet_hits == 4
    assert not got[2].unsupported and got[2].repeated_numbers == [1]
    expected = spark.createDataFrame([(1, 10), (2, 10), (3, 0), (4, 10)], "doc_id long, expected_count int")
    ids = lambda *n: spark.createDataFrame([(d,) for d, k in n for _ in range(k)], "doc_id long")
    checked = D.section_sanity(expected, ids((1, 7), (2, 6), (3, 1), (4, 10)), ids((1, 13), (2, 14), (4, 14)))
    assert {r.doc_id: r.failure_reason for r in checked.collect()} == {1: None, 2: "question_solution_split_failed", 3: None, 4: "solution_over_detection"}


def test_gates(spark):
    items = spark.createDataFrame([item(1, 1), item(2, 2, keys="AB", answer="C"), item(3, 2, text=""), item(4, 9, text="Visit www.x.org now", answer=None), item(5, 3, answer=None, text="Look at the diagram")], ITEM)
    expected = spark.createDataFrame([(1, 4), (2, 2)], "doc_id long, expected_count int")
    gated = durable(G.acceptance(items))
    assert [(r.quality, r.answer_text, r.gate_issues) for r in gated.orderBy("seq").collect()] == [
        ("accepted_safe", "text A", []),
        ("review_required", None, ["incomplete_options", "correct_answer_text_unavailable"]),
        ("blocked", "text A", ["question_text_missing"]),
        ("answer_unavailable", None, []),
        ("visual_required", None, []),
    ]
    assert sorted((r.question_id, r.reason) for r in G.extra_items(items, expected).collect()) == [("q_0004", "out_of_range_question_number"), ("q_0005", "extra_question_candidate")]
    counts = {r.doc_id: (r.actual, r.count_match, r.overflow, r.extra_numbers) for r in G.count_reconciliation(items, expected).collect()}
    assert counts == {1: (5, False, 1, [3, 9]), 2: (0, False, 0, [])}
    bad = {r.question_id: r.classes for r in G.bad_items(items, expected).collect()}
    assert bad == {"q_0003": ["duplicate_question_number", "empty_question_text"], "q_0004": ["question_number_out_of_range", "noise_or_ad_as_question"]}
    windows = spark.createDataFrame([(1, 2, "qw_0001"), (1, 4, "qw_0002"), (2, 1, "qw_0003")], "doc_id long, question_number int, window_id string")
    assert [(r.global_order, r.ref) for r in G.filled(items, windows).where("doc_id = 1").orderBy("global_order").collect()] == [(1, "q_0001"), (2, "q_0002"), (3, "q_0003"), (4, "q_0005"), (5, "qw_0002"), (6, "q_0004")]
    violations = {r.doc_id: r.violations for r in G.threshold_violations(gated, expected).collect()}
    assert violations == {1: ["answers"], 2: ["item_count", "four_options", "answers"]}


def test_only_near_lines_are_compared(spark):
    import random
    from difflib import SequenceMatcher

    kinds = "doc_id long, line_id string, page_number int, text string"
    rnd = random.Random(7)
    words = ["stone", "river", "late", "cloud", "a", "the", "market", "Öl", "été"]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randrange(2, 60))) for _ in range(30)]
    change = lambda t, k: t.replace("e", "c", k) + " ." * (k % 2)
    own = [(1, f"o{i}", i % 3 + 1, change(t, i % 6)) for i, t in enumerate(texts)] + [(1, "far", 1, "x" * 40)]
    other = [(1, f"m{i}", None if i % 10 == 0 else i % 3 + 1, t) for i, t in enumerate(texts)] + [(1, "near", 1, "x" * 20 + "e" * 20)]
    second, first = spark.createDataFrame(own, kinds), spark.createDataFrame(other, kinds)
    pairs = {(r.line_id, r.u) for r in V.near_pairs(second, first).collect()}
    assert ("far", "x" * 20 + "e" * 20) not in pairs
    alike = lambda t, u: SequenceMatcher(None, t, u).ratio() >= V.SIMILAR
    want = {(i, any((q is None or q == p) and alike(t.lower(), u.lower()) for _, _, q, u in other)) for _, i, p, t in own}
    assert {(r.line_id, r.duplicate) for r in V.duplicates(second, first).collect()} == want


def test_slots_may_rank_remains_of_keys_by_their_other_merits(spark):
    kind = "doc_id long, seq int, question_id string, question_number int, question_text_raw string, issues array<string>, options array<struct<key:string,text:string>>, answer_key string, solution struct<raw_text:string>, validation_status string, item_confidence double"
    options = [(k, "text") for k in "ABCD"]
    rows = [(1, 1, "key", 1, "3. a and 4. b", [], options, "A", ("s",), "validated", 0.9), (1, 2, "plain", 1, "What is it", [], None, None, None, "incomplete", 0.9)]
    items, expected = spark.createDataFrame(rows, kind), spark.createDataFrame([(1, 1)], "doc_id long, expected_count int")
    assert [r.final_question_id for r in K.slots(items, expected).collect()] == ["plain"]
    assert [r.final_question_id for r in K.slots(items, expected, keys_last=False).collect()] == ["key"]
