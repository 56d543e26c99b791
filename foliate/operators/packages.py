"""Final items, eligibility lanes, pattern input, slots and audits of question packages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliate.functions import issues as I
from foliate.functions import text as T
from foliate.operators.mapping import SOLUTION_CONFIDENCE

ITEM_CONFIDENCE, ELIGIBLE_CONFIDENCE = 0.75, 0.8
#: Issues that block an item, and issues and statuses that ask for review.
BLOCKING = [
    "missing_option_labels_for_visual_question", "unlabeled_option_images", "unlabeled_visual_assets", "source_backed_option_labels_missing",
    "invalid_option_count", "linked_asset_missing", "answer_option_mismatch", "solution_contains_next_anchor", "missing_options",
    "missing_question_text", "conflicting_answer_keys", "duplicate_question_number", "empty_option_text_without_asset",
]
REVIEWED = ["visual_question_requires_review", "visual_question_requires_diagram_syntax", "low_confidence_answer"]
EXPORT_MODES = {"eligible_only": ["eligible_for_ingestion"], "include_review": ["eligible_for_ingestion", "review_required"], "all": ["eligible_for_ingestion", "review_required", "blocked"]}
ANSWER_MODES = ("required", "optional", "question_only")
OVER_DETECTION = 1.5


def final_items(cands: DataFrame, maps: DataFrame) -> DataFrame:
    """Candidates with their mapping and a validation status."""
    m = maps.drop("question_number", "question_id")
    joined = cands.join(m, ["doc_id", "seq"], "left")
    answer, solution = F.col("answer_key").isNotNull(), F.col("solution").isNotNull()
    mismatch = answer & (F.size("option_keys") > 0) & ~F.array_contains("option_keys", F.col("answer_key"))
    none = F.array().cast("array<string>")
    extra = F.array_compact(F.array(F.when(mismatch, F.lit("answer_option_mismatch")), F.when(T.strip(F.col("question_text_raw")) == "", F.lit("missing_question_text"))))
    joined = joined.withColumn("issues", F.array_sort(F.array_distinct(F.concat("issues", F.coalesce("mapping_issues", none), extra))))
    review, mapped = F.col("review_status"), F.col("mapping_status")
    unsure = (mapped == "needs_review") | (review == "candidate_needs_review") | F.array_contains("issues", "answer_option_mismatch") | F.exists("issues", lambda i: i.contains("noise_inside"))
    unsure = unsure | (F.col("confidence") < ITEM_CONFIDENCE) | (F.col("mapping_confidence") < ITEM_CONFIDENCE)
    status = (
        F.when((mapped == "duplicate_conflict") | (review == "candidate_duplicate"), "duplicate_conflict")
        .when((review == "candidate_incomplete") | F.col("options").isNull(), "incomplete")
        .when(unsure, "needs_review")
        .when(~answer & (mapped.isNull() | (mapped == "not_available")), "question_only_validated")
        .when(answer, "validated")
        .otherwise("needs_review")
    )
    sums = F.col("confidence") + F.col("mapping_confidence") + F.coalesce("answer_confidence", F.lit(0.0)) + F.when(solution, SOLUTION_CONFIDENCE).otherwise(0.0)
    mean = sums / (F.lit(2) + answer.cast("int") + solution.cast("int"))
    return joined.withColumn("validation_status", status).withColumn("item_confidence", mean)


def package_counts(items: DataFrame) -> DataFrame:
    """Counters of each document's package."""
    of = lambda *s: F.count_if(F.col("validation_status").isin(*s))
    return items.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("total_questions"),
        of("validated", "question_only_validated").alias("valid_questions"),
        of("needs_review", "incomplete", "duplicate_conflict", "rejected").alias("review_required_questions"),
        of("question_only_validated").alias("question_only_count"),
        F.count_if(F.col("answer_key").isNotNull()).alias("answered_count"),
        F.count_if(F.col("solution").isNotNull()).alias("solved_count"),
        F.count_if(F.col("assets") > 0).alias("visual_question_count"),
        F.count_if(F.array_contains("issues", "answer_option_mismatch")).alias("answer_option_mismatch_count"),
    )


def eligibility(items: DataFrame, mode: str = "optional", review_ids: DataFrame | None = None) -> DataFrame:
    """Blocking and review reasons, all reasons and the lane of each item.

    ``mode`` is one of ANSWER_MODES: where answers are required an item without one is blocked and one without a solution reviewed; where
    they are optional one without is reviewed; with question_only it is told and no more.  ``review_ids``
    (doc_id, question_id), repeats allowed, are items that the review export names.
    """
    if mode not in ANSWER_MODES:
        raise ValueError(f"mode is one of {', '.join(ANSWER_MODES)}")
    unanswered = F.col("answer_key").isNull()
    if review_ids is None:
        items = items.withColumn("_flagged", F.lit(False))
    else:
        named = review_ids.select("doc_id", "question_id").distinct().withColumn("_flagged", F.lit(True))
        items = items.join(named, ["doc_id", "question_id"], "left").withColumn("_flagged", F.coalesce("_flagged", F.lit(False)))
    status = F.col("validation_status")
    visual = T.is_visual(F.col("question_text_raw")) | (F.col("assets") > 0)
    some = lambda *pairs: F.array_compact(F.array(*(F.when(c, F.lit(i)) for c, i in pairs)))
    repeated = F.col("solutions") > 1
    conflict = repeated & F.col("solution_conflict")
    blocking = F.concat(
        F.array_intersect("issues", F.array(*map(F.lit, BLOCKING))),
        some(
            (T.strip(F.col("question_text_raw")) == "", "missing_question_text"),
            (status == "incomplete", "validation_incomplete"),
            (status == "duplicate_conflict", "validation_duplicate_conflict"),
            (status == "rejected", "validation_rejected"),
            (conflict, "duplicate_solution_conflict"),
            (unanswered & F.lit(mode == "required"), "missing_answer_required_mode"),
        ),
    )
    held = F.arrays_overlap("issues", F.array(*map(F.lit, BLOCKING)))
    review = F.concat(
        F.array_intersect("issues", F.array(*map(F.lit, REVIEWED))),
        some(
            (status == "needs_review", "validation_needs_review"),
            (visual & ~held & (status != "validated"), "visual_question_uncertain"),
            (repeated & ~conflict, "duplicate_solution_harmless"),
            (unanswered & F.lit(mode == "optional"), "question_only_no_answer"),
            (F.col("solution").isNull() & F.lit(mode == "required"), "missing_solution"),
            (F.col("_flagged"), "review_export_flagged"),
            (F.col("item_confidence") < ELIGIBLE_CONFIDENCE, "low_confidence"),
        ),
    )
    judged = items.withColumns({"blocking_reasons": F.array_sort(F.array_distinct(blocking)), "review_reasons": F.array_sort(F.array_distinct(review))})
    lane = F.when(F.size("blocking_reasons") > 0, "blocked").when(F.size("review_reasons") > 0, "review_required").otherwise("eligible_for_ingestion")
    told = some((lane == "eligible_for_ingestion", "clean_validated_item"), (unanswered & F.lit(mode == "question_only"), "question_only_mode"))
    reasons = F.array_sort(F.array_distinct(F.concat("blocking_reasons", "review_reasons", told)))
    return judged.withColumns({"eligibility_status": lane, "eligibility_reasons": reasons}).drop("_flagged")


def pattern_input(lanes: DataFrame, mode: str = "eligible_only") -> DataFrame:
    """The items that an export mode lets through, in source order, with what is to be done with each."""
    action = F.when(F.col("eligibility_status") == "eligible_for_ingestion", "ready_for_ingestion").when(F.col("eligibility_status") == "review_required", "manual_review").otherwise("blocked_do_not_ingest")
    chosen = lanes.where(F.col("eligibility_status").isin(EXPORT_MODES[mode])).withColumn("ingestion_action", action)
    return chosen.withColumn("source_order", F.row_number().over(W.partitionBy("doc_id").orderBy("seq")))


def slots(items: DataFrame, expected: DataFrame, keys_last: bool = True) -> DataFrame:
    """Slots 1 .. expected_count of each document of ``expected``: the best item of each number, or a placeholder.

    Items rank by clean text (some, and no issue of corruption), four options, an answer whose
    option has a text, a solution, few issues, and place.  With ``keys_last`` those whose text is left of an answer key rank behind all others.
    """
    usable = F.size(F.filter("options", lambda o: o["key"].isNotNull() & (T.strip(o["text"]) != "")))
    contaminated = T.is_contaminated(F.col("question_text_raw")) if keys_last else F.lit(False)
    clean = (T.strip(F.col("question_text_raw")) != "") & ~F.exists("issues", I.is_corrupt)
    told = F.exists("options", lambda o: (T.option_key(o["key"]) == F.col("answer_key")) & (T.strip(o["text"]) != ""))
    score = F.when(contaminated, F.struct(F.lit(-3).alias("a"), F.lit(-1).alias("b"), F.lit(-1).alias("c"), F.lit(-1).alias("d"), F.lit(-999).alias("e"))).otherwise(
        F.struct(clean.cast("int").alias("a"), F.coalesce((usable >= 4).cast("int"), F.lit(0)).alias("b"), F.coalesce(told, F.lit(False)).cast("int").alias("c"), F.col("solution").isNotNull().cast("int").alias("d"), (-F.size("issues")).alias("e"))
    )
    bounded = items.join(expected, "doc_id").where("question_number between 1 and expected_count")
    ranked = bounded.withColumn("place", F.row_number().over(W.partitionBy("doc_id", "question_number").orderBy(score.desc(), "seq")))
    counts = ranked.groupBy("doc_id", "question_number").agg(F.count(F.lit(1)).alias("competitors"))
    spine = expected.where("expected_count > 0").select("doc_id", F.explode_outer(F.sequence(F.lit(1), "expected_count")).alias("question_number"))
    best = ranked.where("place = 1").select("doc_id", "question_number", "question_id", "validation_status", "item_confidence")
    filled = spine.join(best, ["doc_id", "question_number"], "left").join(counts, ["doc_id", "question_number"], "left")
    missing = F.col("question_id").isNull()
    return filled.select("doc_id", "question_number", F.coalesce("question_id", F.format_string("fq_missing_%04d", "question_number")).alias("final_question_id"), F.when(missing, "blocked").otherwise(F.col("validation_status")).alias("status"), F.coalesce("item_confidence", F.lit(0.0)).alias("confidence"), F.coalesce("competitors", F.lit(0)).alias("competitors"), missing.alias("placeholder"))


def count_audit(counts: DataFrame, expected: DataFrame) -> DataFrame:
    """Whether a package has about as many questions as expected: within max(5, 10 per cent)."""
    joined = expected.join(counts, "doc_id", "left").withColumn("total_questions", F.coalesce("total_questions", F.lit(0)))
    allowed = F.greatest(F.lit(5), (F.col("expected_count") * F.lit(0.1)).cast("int"))
    off = F.abs(F.col("total_questions") - F.col("expected_count"))
    different = F.when(F.col("expected_count") <= 0, off > 0).otherwise(off > allowed)
    return joined.select("doc_id", "expected_count", "total_questions", different.alias("very_different"))


def reconcile(cands: DataFrame, items: DataFrame, lanes: DataFrame) -> DataFrame:
    """Checks across artifacts by document: the same ids everywhere, counts that add up, no unsafe eligible item."""
    one, two, three = cands.select("doc_id", "seq", F.lit(1).alias("c")), items.select("doc_id", "seq", F.lit(1).alias("f")), lanes.select("doc_id", "seq", F.lit(1).alias("l"), "eligibility_status", "blocking_reasons")
    every = one.join(two, ["doc_id", "seq"], "full").join(three, ["doc_id", "seq"], "full")
    unsafe = (F.col("eligibility_status") == "eligible_for_ingestion") & (F.size("blocking_reasons") > 0)
    counted = every.groupBy("doc_id").agg(F.count("c").alias("candidates"), F.count("f").alias("items"), F.count("l").alias("laned"), F.count_if(F.col("c").isNull() | F.col("f").isNull() | F.col("l").isNull()).alias("unmatched_ids"), F.count_if(unsafe).alias("unsafe_eligible"))
    failed = (F.col("candidates") != F.col("items")) | (F.col("items") != F.col("laned")) | (F.col("unmatched_ids") > 0) | (F.col("unsafe_eligible") > 0)
    return counted.withColumn("gate", F.when(failed, "failed").otherwise("passed"))
