"""Patches: what is refused and why, which one counts, and where each field of an exported item comes from."""

from foliate.operators import patches as R

ITEMS = "doc_id long, seq long, question_id string, question_number int, question_text_raw string, options array<struct<key:string,text:string>>, answer_key string, solution_text string, grounded boolean, gate string, issues array<string>, status string"
PATCHES = "doc_id long, position long, patch_id string, question_number int, action string, question_text_raw string, options array<struct<key:string,text:string>>, correct_answer_key string, solution_text_raw string, confirm_no_guessing boolean, reviewer_notes string"
FOUR = [(k, f"text {k}") for k in "ABCD"]


def item(seq, number, gate="review_required", status="review_required", key="A"):
    return (1, seq, f"q{seq}", number, f"text {seq}", FOUR, key, None, True, gate, ["x"], status)


def patch(position, number, action=R.ACCEPT, text="new", options=None, key=None, solution=None, sure=True, notes="seen", name=None):
    return (1, position, name or f"p{position}", number, action, text, options, key, solution, sure, notes)


def both(spark, items, patches, **more):
    own = spark.createDataFrame(items, ITEMS)
    return own, R.judge(own, spark.createDataFrame(patches, PATCHES), **more)


def test_what_is_refused(spark):
    items = [item(1, 1), item(2, 2, status="accepted"), item(3, None), item(4, 1)]
    patches = [
        patch(1, 9), patch(2, 2), patch(3, 1, R.BLOCK), patch(4, 1, R.HOLD), patch(5, 1, "drop"), patch(6, 1, None), patch(7, None, name="q3"),
        patch(8, 1, sure=None, notes=" ", text=None), patch(9, 1, text="", key="B"), patch(10, 1, text="", options=FOUR, key="B"), patch(11, 9, name="q1"),
    ]
    judged = both(spark, items, patches)[1]
    got = {r.position: (r.question_id, r.matched_by, r.errors) for r in judged.collect()}
    assert got[1] == (None, None, ["target_question_not_found"]) and got[2][2] == ["cannot_patch_accepted_item_without_flag"]
    # of two items with one number the last counts
    assert got[3] == ("q4", "number", []) and got[4][2] == [] and got[5][2] == ["unknown_action:drop"] and got[6][2] == ["unknown_action:"]
    assert got[7] == ("q3", "id", []) and got[11] == ("q1", "id", [])
    assert got[8][2] == ["confirm_no_guessing_required", "reviewer_notes_required", "manual_patch_requires_at_least_one_field"]
    assert got[9][2] == ["correct_answer_key_requires_options_for_text_derivation"] and got[10][2] == []
    assert [tuple(r) for r in R.patch_counts(judged).collect()] == [(1, 11, 3, 1, 1, 6)]
    assert {r.position: r.applied for r in both(spark, items, patches, allow_accepted=True)[1].collect()}[2]
    assert both(spark, items, [])[1].count() == 0


def export(spark, items, patches, mode="accepted_plus_patched"):
    return {r.question_id: r for r in R.final_export(*both(spark, items, patches), mode).collect()}


def test_the_last_patch_replaces_what_it_gives(spark):
    items = [item(1, 1), item(2, 2), item(3, 3, gate="accepted_safe"), item(4, 3), item(5, 5, gate="blocked", key="E")]
    five = [("(a)", "alpha"), ("(b)", " beta ")]
    patches = [patch(1, 1, text="first"), patch(2, 1, text="", options=five, key="Ans (b)", solution="so"), patch(3, 3, text="not taken"), patch(4, 2, R.HOLD), patch(5, None, name="q2"), patch(6, 5, text="kept out of nothing")]
    got = export(spark, items, patches)
    assert set(got) == {"q1", "q3", "q5"}
    one = got["q1"]
    assert (one.question_text_raw, [tuple(o) for o in one.options], one.answer_key, one.answer_text, one.solution_text) == ("text 1", five, "B", "beta", "so")
    assert one.origins == ["text=bound", "options=p2", "answer=p2", "solution=p2"] and one.provenance == ["semantic_binding", "manual_patch"]
    assert (one.answer_source, one.export_status, one.issues) == ("manual_review", "ready_for_pattern_input", ["x"])
    # what the gate accepts stays as it is, and no other item of its number is taken
    assert got["q3"].question_text_raw == "text 3" and got["q3"].answer_source == "source_grounded"
    assert got["q5"].issues == ["x", "correct_answer_text_unavailable"] and got["q5"].answer_text is None


def test_modes(spark):
    items = [item(1, 1), item(2, 2, gate="accepted_safe"), item(3, None, gate="blocked", key=None)]
    assert set(export(spark, items, [patch(1, 1)], "accepted_only")) == {"q2"}
    every = export(spark, items, [patch(1, 1)], "all_with_status")
    assert {k: r.export_status for k, r in every.items()} == {"q1": "hold_for_review", "q2": "ready_for_pattern_input", "q3": "blocked"}
    assert every["q1"].question_text_raw == "text 1" and every["q3"].answer_source == "unavailable"
    assert export(spark, [], []) == {}
