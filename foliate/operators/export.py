"""Public questions, their audit, and the loop of human review."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliate.functions import text as T

STATUSES = ["ready", "review", "visual_required", "blocked"]


def public_questions(items: DataFrame) -> DataFrame:
    """(doc_id, question_number, external_id, status, question): the public structure of each item.

    Ready needs clean text and four usable options; questions that ask for a figure without having one need it.
    """
    usable = F.coalesce(F.size(F.filter("options", lambda o: o["key"].isNotNull() & (T.strip(o["text"]) != ""))), F.lit(0))
    text = T.strip(F.col("question_text_raw"))
    status = F.when(text == "", "blocked").when(T.is_visual(F.col("question_text_raw")), "visual_required").when((usable < 4) | F.array_contains("issues", "answer_option_mismatch"), "review").otherwise("ready")
    options = F.transform(F.filter("options", lambda o: (T.strip(o["text"]) != "") | o["key"].isNotNull()), lambda o: F.struct(F.coalesce(F.substring(F.upper(o["key"]), 1, 1), F.lit("?")).alias("label"), o["text"].alias("text")))
    answer = F.get(F.filter("options", lambda o: o["key"] == F.col("answer_key")), F.lit(0))["text"]
    meta = F.struct(F.col("question_number").alias("questionNumber"), status.alias("status"), F.col("issues").alias("reviewIssues"))
    question = F.struct(
        F.coalesce(F.format_string("Q%03d", "question_number"), F.col("question_id")).alias("externalId"),
        F.nullif(F.col("question_text_raw"), F.lit("")).alias("questionText"),
        F.lit("single_choice").alias("questionType"),
        F.coalesce(options, F.array().cast("array<struct<label:string,text:string>>")).alias("options"),
        F.struct(F.col("answer_key").alias("label"), answer.alias("text")).alias("correctAnswer"),
        F.col("solution.raw_text").alias("solutionText"),
        meta.alias("metadata"),
    )
    return items.select("doc_id", "seq", "question_number", question["externalId"].alias("external_id"), status.alias("status"), question.alias("question"))


def public_json(questions: DataFrame) -> DataFrame:
    """One JSON text a document, its questions in order of number and place."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(F.coalesce("question_number", F.lit(0)).alias("n"), "seq", "question"))), lambda x: x["question"])
    return questions.groupBy("doc_id").agg(F.to_json(F.struct(ordered.alias("questions")), {"ignoreNullFields": "false"}).alias("json"))


def status_counts(questions: DataFrame) -> DataFrame:
    """Questions of each status by document."""
    of = lambda s: F.count_if(F.col("status") == s).alias(f"{s}_count")
    return questions.groupBy("doc_id").agg(F.count(F.lit(1)).alias("total_questions"), *map(of, STATUSES), F.count_if(F.col("status") != "ready").alias("non_ready_count"))


def public_audit(questions: DataFrame, expected: DataFrame) -> DataFrame:
    """Errors of each document against the contract: size, repeated and out-of-range numbers, ids that are missing."""
    by = questions.groupBy("doc_id").agg(F.count(F.lit(1)).alias("total"), F.collect_list("question_number").alias("numbers"), F.collect_set("external_id").alias("ids"))
    joined = expected.join(by, "doc_id", "left").withColumn("total", F.coalesce("total", F.lit(0)))
    numbers = F.coalesce("numbers", F.array().cast("array<int>"))
    slots = F.when(F.col("expected_count") > 0, F.transform(F.sequence(F.lit(1), "expected_count"), lambda i: F.format_string("Q%03d", i))).otherwise(F.array().cast("array<string>"))
    out = joined.select("doc_id", "expected_count", "total", (F.size(numbers) - F.size(F.array_distinct(numbers))).alias("repeated_numbers"), F.size(F.filter(numbers, lambda n: (n < 1) | (n > F.col("expected_count")))).alias("out_of_range"), F.size(F.array_except(slots, F.coalesce("ids", F.array().cast("array<string>")))).alias("missing_ids"))
    return out.withColumn("passed", (F.col("total") == F.col("expected_count")) & (F.col("repeated_numbers") == 0) & (F.col("out_of_range") == 0) & (F.col("missing_ids") == 0))


def merge_review(base: DataFrame, review: DataFrame) -> DataFrame:
    """Base rows, each replaced by the review row of its external id, else of its number; the last of several counts.

    Both have doc_id, external_id, question_number, status; ``review`` also position.
    """
    last = lambda key: F.max_by(F.struct("external_id", "question_number", "status"), "position").alias(f"by_{key}")
    by_id = review.where("external_id is not null").groupBy("doc_id", "external_id").agg(last("id"))
    by_number = review.where("question_number is not null").groupBy("doc_id", "question_number").agg(last("number"))
    joined = base.join(by_id, ["doc_id", "external_id"], "left").join(by_number, ["doc_id", "question_number"], "left")
    new = F.coalesce("by_id", "by_number")
    return joined.select("doc_id", F.coalesce(new["external_id"], F.col("external_id")).alias("external_id"), F.when(new.isNotNull(), new["question_number"]).otherwise(F.col("question_number")).alias("question_number"), F.coalesce(new["status"], F.col("status")).alias("status"), new.isNotNull().alias("patched"))


def review_items(items: DataFrame, include_validated: bool = False) -> DataFrame:
    """Items for review with the first reason that applies, in order of urgency."""
    status = F.col("validation_status")
    mismatch = F.array_contains("issues", "answer_option_mismatch")
    pictured = F.col("raw_text").rlike(r"!\[[^\]]*\]\([^)]+\)") & (F.col("assets") == 0)
    risky = status.isin("duplicate_conflict", "incomplete", "rejected") | mismatch | pictured
    reason = F.when(status == "duplicate_conflict", "duplicate_conflict").when(status == "incomplete", "incomplete").when(mismatch, "answer_option_mismatch").when(risky, "high_risk").when(status == "needs_review", "needs_review").otherwise("validated")
    wanted = F.lit(include_validated) | risky | ~status.isin("validated", "question_only_validated")
    ranked = items.withColumn("reason", reason).where(wanted)
    return ranked.withColumn("place", F.row_number().over(W.partitionBy("doc_id").orderBy("seq"))).select("doc_id", "place", "question_id", "validation_status", "reason")
