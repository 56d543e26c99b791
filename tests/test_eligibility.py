"""Lanes of items by mode of answers: literal cases."""

import pytest

from foliate.operators import packages as K

ITEM = "doc_id long, seq long, question_id string, question_text_raw string, assets int, solutions long, solution_conflict boolean, issues array<string>, validation_status string, answer_key string, solution string, item_confidence double"


def row(name, status="validated", key="A", solution="s", issues=(), solutions=1, conflict=False, assets=0, confidence=0.9, text="What is it"):
    return (1, 1, name, text, assets, solutions, conflict, list(issues), status, key, solution, confidence)


ROWS = [
    row("clean"), row("incomplete", status="incomplete"), row("mismatch", issues=["answer_option_mismatch"]), row("conflict", solutions=2, conflict=True), row("harmless", solutions=2),
    row("unanswered", key=None, status="question_only_validated"), row("unsolved", solution=None), row("named"), row("rejected", status="rejected"), row("linked", assets=2, issues=["visual_question_requires_review"]), row("unlabeled", assets=1, issues=["unlabeled_option_images"]),
]


def lanes(spark, mode):
    named = spark.createDataFrame([(1, "named"), (1, "named"), (2, "clean")], "doc_id long, question_id string")
    out = K.eligibility(spark.createDataFrame(ROWS, ITEM), mode, named).collect()
    assert len(out) == len(ROWS)
    return {r.question_id: (r.eligibility_status, r.eligibility_reasons) for r in out}


@pytest.mark.parametrize("mode", K.ANSWER_MODES)
def test_what_no_mode_changes(spark, mode):
    got = lanes(spark, mode)
    assert got["clean"] == ("eligible_for_ingestion", ["clean_validated_item"])
    assert got["incomplete"] == ("blocked", ["validation_incomplete"]) and got["rejected"] == ("blocked", ["validation_rejected"])
    assert got["mismatch"] == ("blocked", ["answer_option_mismatch"]) and got["conflict"] == ("blocked", ["duplicate_solution_conflict"])
    assert got["harmless"] == ("review_required", ["duplicate_solution_harmless"]) and got["named"] == ("review_required", ["review_export_flagged"])
    assert got["linked"] == ("review_required", ["visual_question_requires_review"]) and got["unlabeled"] == ("blocked", ["unlabeled_option_images"])


def test_what_each_mode_asks(spark):
    required, optional, only = (lanes(spark, m) for m in K.ANSWER_MODES)
    assert required["unanswered"] == ("blocked", ["missing_answer_required_mode"]) and required["unsolved"] == ("review_required", ["missing_solution"])
    assert optional["unanswered"] == ("review_required", ["question_only_no_answer"]) and optional["unsolved"][0] == "eligible_for_ingestion"
    assert only["unanswered"] == ("eligible_for_ingestion", ["clean_validated_item", "question_only_mode"])
    with pytest.raises(ValueError):
        K.eligibility(spark.createDataFrame(ROWS, ITEM), "other")
