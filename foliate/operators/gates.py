"""Gates on final items: acceptance, extra and bad items, filling from windows, thresholds, answer gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliate.functions import text as T

FOUR = 4
# --- fixed values: notices that are no question, and the shares a document must reach -------
NOTICE = r"(?i)(?:Free\s+Mock\s+Test|Download\s+PDF|www\.|http://|https://|Subscribe\s+Now|Previous\s+Papers?)"
MIN_ITEMS, MIN_FOUR_OPTIONS, MIN_ANSWERS = 0.95, 0.90, 0.90


def usable_options():
    """Options with a key and text."""
    return F.coalesce(F.size(F.filter("options", lambda o: o["key"].isNotNull() & (T.strip(o["text"]) != ""))), F.lit(0))


def acceptance(items: DataFrame) -> DataFrame:
    """Add usable_options, answer_text, gate_issues and quality to items of single choice.

    The answer's text is that of the option with its key; accepted is what has
    text, four usable options and an answer among them.  An item that brings an ``answer_text`` of its own keeps
    it where no option has the key, and its key is then not in the options.
    """
    owner = F.get(F.filter("options", lambda o: (T.option_key(o["key"]) == F.col("answer_key")) & (T.strip(o["text"]) != "")), F.lit(0))
    given = F.coalesce(T.strip(F.col("answer_text")), F.lit("")) if "answer_text" in items.columns else F.lit("")
    outside = F.col("answer_key").isNotNull() & owner["text"].isNull() & (given != "")
    marked = items.withColumns({"usable_options": usable_options(), "_outside": outside, "answer_text": F.coalesce(T.strip(owner["text"]), F.when(given != "", given))})
    keyed = F.col("answer_key").isNotNull()
    lost = keyed & F.col("answer_text").isNull()
    few = F.col("usable_options") < FOUR
    blank = T.strip(F.col("question_text_raw")) == ""
    issues = F.array_compact(F.array(F.when(few, F.lit("incomplete_options")), F.when(lost, F.lit("correct_answer_text_unavailable")), F.when(F.col("_outside"), F.lit("answer_key_not_in_options")), F.when(blank, F.lit("question_text_missing"))))
    quality = F.when(blank, "blocked").when(T.is_visual(F.col("question_text_raw")), "visual_required").when(few | lost | F.col("_outside"), "review_required").when(~keyed, "answer_unavailable").otherwise("accepted_safe")
    return marked.withColumns({"gate_issues": issues, "quality": quality}).drop("_outside")


def extra_items(items: DataFrame, expected: DataFrame) -> DataFrame:
    """Items beyond what is expected, with the reason."""
    joined = items.join(expected, "doc_id")
    number = F.col("question_number")
    reason = F.when(number.isNull(), "non_numeric_question_number").when((number < 1) | (number > F.col("expected_count")), "out_of_range_question_number").when(F.col("seq") > F.col("expected_count"), "extra_question_candidate")
    return joined.withColumn("reason", reason).where("reason is not null").select("doc_id", "question_id", "question_number", "reason")


def count_reconciliation(items: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected and actual counts by document, and what is over."""
    extra = extra_items(items, expected).groupBy("doc_id").agg(F.count(F.lit(1)).alias("extra_items"), F.array_sort(F.collect_set("question_number")).alias("extra_numbers"))
    actual = items.groupBy("doc_id").agg(F.count(F.lit(1)).alias("actual"))
    joined = expected.join(actual, "doc_id", "left").join(extra, "doc_id", "left").na.fill(0, ["actual", "extra_items"])
    return joined.select("doc_id", "expected_count", "actual", (F.col("actual") == F.col("expected_count")).alias("count_match"), F.greatest(F.lit(0).cast("long"), F.col("actual") - F.col("expected_count")).alias("overflow"), "extra_items", F.coalesce("extra_numbers", F.array().cast("array<int>")).alias("extra_numbers"))


def bad_items(items: DataFrame, expected: DataFrame) -> DataFrame:
    """Items that are no question, with all classes that hold; they are quarantined."""
    joined = items.join(expected, "doc_id", "left")
    number, text = F.col("question_number"), T.strip(F.col("question_text_raw"))
    again = F.row_number().over(W.partitionBy("doc_id", "question_number").orderBy("seq")) > 1
    classes = F.array_compact(
        F.array(
            F.when(number.isNull(), F.lit("non_numeric_question_number")),
            F.when((number < 1) | (number > F.col("expected_count")), F.lit("question_number_out_of_range")),
            F.when(number.isNotNull() & again, F.lit("duplicate_question_number")),
            F.when(T.is_answer_key_line(F.col("question_text_raw")), F.lit("answer_key_without_question")),
            F.when(T.has(text, NOTICE), F.lit("noise_or_ad_as_question")),
            F.when(text == "", F.lit("empty_question_text")),
        )
    )
    return joined.withColumn("classes", classes).where(F.size("classes") > 0).select("doc_id", "question_id", "question_number", "classes")


def filled(items: DataFrame, windows: DataFrame) -> DataFrame:
    """Items, and windows of the numbers that no item has: (doc_id, question_number, origin, ref), in order of number."""
    own = items.select("doc_id", "question_number", F.lit("item").alias("origin"), F.col("question_id").alias("ref"))
    missing = windows.join(items.select("doc_id", "question_number").distinct(), ["doc_id", "question_number"], "left_anti")
    both = own.unionByName(missing.select("doc_id", "question_number", F.lit("window").alias("origin"), F.col("window_id").alias("ref")))
    order = W.partitionBy("doc_id").orderBy(F.coalesce("question_number", F.lit(0)), "origin", "ref")
    return both.withColumn("global_order", F.row_number().over(order))


def threshold_violations(gated: DataFrame, expected: DataFrame) -> DataFrame:
    """Shares of each document below what it must reach, from gated items."""
    by = gated.groupBy("doc_id").agg(F.count(F.lit(1)).alias("items"), F.count_if(F.col("usable_options") >= FOUR).alias("with_four"), F.count_if(F.col("answer_key").isNotNull()).alias("answered"))
    joined = expected.where("expected_count > 0").join(by, "doc_id", "left").na.fill(0, ["items", "with_four", "answered"])
    share = lambda c: F.col(c) / F.col("expected_count")
    found = F.array_compact(F.array(F.when(share("items") < MIN_ITEMS, F.lit("item_count")), F.when(share("with_four") < MIN_FOUR_OPTIONS, F.lit("four_options")), F.when(share("answered") < MIN_ANSWERS, F.lit("answers"))))
    return joined.select("doc_id", "expected_count", "items", "with_four", "answered", found.alias("violations"))


def answer_gaps(maps: DataFrame) -> DataFrame:
    """Questions without an answer and why, from mappings."""
    reason = F.when(F.array_contains("mapping_issues", "conflicting_answer_keys"), "conflicting_answers").when(F.col("solution").isNotNull(), "solution_without_answer").otherwise("no_entry")
    return maps.where("answer_key is null").select("doc_id", "question_id", "question_number", reason.alias("reason"))
