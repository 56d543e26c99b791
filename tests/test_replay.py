"""Chunks: hashes that follow lines, places and settings; only changed chunks are done again; diagnostics by literal cases."""

from pyspark.sql import functions as F

from foliate.operators import replay as R

TOLD = "doc_id long, chunk_index int, line_number int, raw string"
ITEMS = "doc_id long, chunk_index int, question_id string, seq long, question_number int, issues array<string>"


def hashes(spark, rows, settings=""):
    return R.chunk_hashes(spark.createDataFrame(rows, TOLD), settings)


def by_chunk(df, column="evidence_hash"):
    return {(r.doc_id, r.chunk_index): r[column] for r in df.collect()}


def test_hashes_follow_lines_places_and_settings(spark):
    base = [(1, 0, 1, "a"), (1, 0, 2, "b"), (1, 1, 2000, None), (1, 1, 1, "x")]
    one = by_chunk(hashes(spark, base))
    assert all(len(h) == R.HASH_CHARS for h in one.values()) and one == by_chunk(hashes(spark, base[::-1]))
    assert one != by_chunk(hashes(spark, base, "other"))
    for k, other in ((0, (1, 0, 1, "b")), (1, (1, 0, 3, "b")), (2, (1, 1, 2000, ""))):
        changed = by_chunk(hashes(spark, [*base[:k], other, *base[k + 1 :]]))
        assert [c for c in one if one[c] != changed[c]] == [other[:2]]
    docs = lambda rows: R.document_hashes(hashes(spark, rows)).collect()[0].evidence_hash
    assert docs(base) != docs([*base[:3], (1, 1, 1, "y")])
    assert hashes(spark, []).count() == 0


def test_only_changed_chunks_are_done_again(spark):
    old = [(1, 0, 1, "a"), (1, 1, 2, "b"), (1, 2, 3, "c"), (2, 0, 1, "d")]
    new = [(1, 0, 1, "a"), (1, 1, 2, "B"), (2, 0, 1, "d"), (2, 1, 2, "e")]
    changed = R.changes(hashes(spark, new), hashes(spark, old))
    assert by_chunk(changed, "state") == {(1, 0): "same", (1, 1): "changed", (1, 2): "gone", (2, 0): "same", (2, 1): "new"}
    stored = spark.createDataFrame([(1, 0, "kept"), (1, 1, "old"), (1, 2, "old"), (2, 0, "kept")], "doc_id long, chunk_index int, said string")
    seen = spark.sparkContext.accumulator(0)

    def compute(lines):
        def count(row):
            seen.add(1)
            return row.raw

        return lines.select("doc_id", "chunk_index", F.udf(count)(F.struct("raw")).alias("said"))

    got = R.replay(spark.createDataFrame(new, TOLD), changed, stored, compute)
    assert by_chunk(got, "said") == {(1, 0): "kept", (1, 1): "B", (2, 0): "kept", (2, 1): "e"} and seen.value == 2
    plan = spark.createDataFrame([(2, 0), (2, 0), (1, 1)], "doc_id long, chunk_index int")
    assert by_chunk(R.replay(spark.createDataFrame(new, TOLD), changed, stored, compute, plan), "said") == {(1, 0): "kept", (1, 1): "B", (2, 0): "d", (2, 1): "e"}


def test_items_belong_to_the_window_before_them(spark):
    items = spark.createDataFrame([(1, 1, "x", 9), (1, 5, "y", 9), (1, 30, "z", 9), (2, 3, "w", 9)], "doc_id long, start_line int, question_id string, chunk_index int")
    placed = spark.createDataFrame([(1, 0, 5), (1, 1, 12), (1, 2, 40)], "doc_id long, chunk_index int, start_line int")
    assert {r.question_id: r.chunk_index for r in R.chunk_of_items(items, placed).collect()} == {"x": 0, "y": 0, "z": 1, "w": 0}


def test_what_is_wrong_with_chunks(spark):
    spans = ["missing_question_source_spans"]
    items = [
        (1, 0, "a", 1, 1, []), (1, 0, "b", 2, 2, ["invalid_option_key:X"]),
        (1, 1, "c", 3, None, ["noise_in_question_text"]), (1, 1, "d", 4, 9, spans), (1, 1, "e", 5, 9, spans), (1, 1, "f", 6, 3, ["duplicate_question_number", *spans]),
        (1, 2, "g", 7, 4, ["hallucinated_option_text:A", "hallucinated_option_text:B"]),
    ]
    chunks = [(1, k, 10 * k, e) for k, e in enumerate((None, None, "broken", "broken", None))]
    df, expected = spark.createDataFrame(items, ITEMS), spark.createDataFrame([(1, 5)], "doc_id long, expected_count int")
    found = R.chunk_diagnostics(df, spark.createDataFrame(chunks, "doc_id long, chunk_index int, n_lines int, error string"), expected)
    got = {r.chunk_index: r for r in found.collect()}
    assert [(got[k].status, got[k]["items"], got[k].question_range) for k in range(5)] == [("ok", 2, "1..2"), ("warning", 4, "3..9"), ("warning", 1, "4..4"), ("failed", 0, None), ("ok", 0, None)]
    assert (got[1].out_of_range, got[1].repeated, got[1].non_numeric, got[1].noise_items) == ([9], [3, 9], 1, 1)
    assert [tuple(c) for c in got[2].issue_counts] == [("hallucinated_option_text", 2)]
    assert got[1].reasons == ["non_numeric_item", "out_of_range_question", "duplicate_question", "suspected_noise", "high_missing_spans"]
    assert (got[2].reasons, got[3].reasons, got[4].reasons) == (["hallucination"], ["failed_provider_response"], [])
    assert sorted(r.chunk_index for r in R.replay_plan(found).collect()) == [1, 2, 3]
    assert by_chunk(R.replay_plan(found, only_suspicious=False), "reasons")[(1, 0)] == ["manual_replay"]
    whole = R.roll_up(found, df, expected).collect()[0]
    assert (whole.total_chunks, whole["items"], whole.count_match, whole.extra_items, whole.missing_numbers, whole.duplicate_numbers, whole.hallucination_suspected, whole.chunks_to_replay) == (5, 7, False, 5, [5], [9], 2, [1, 2, 3])
    assert whole.warnings == ["expected_count_mismatch: expected=5 actual=7", "extra_item_count:5"]
