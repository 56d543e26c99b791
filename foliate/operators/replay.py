"""Chunks of evidence: their hashes, what is wrong in each, and doing again only what changed.

A chunk's hash covers its lines, their places and the settings.  Stored hashes decide by a join which
chunks are computed again; the results of the others are kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliate.operators import gates

#: Characters of a hash, and missing spans of questions from which a chunk is done again.
HASH_CHARS, MOST_MISSING_SPANS = 24, 2
#: Lines that are hashed together before a chunk's hash is made of these, so that no group holds a long document's lines.
BLOCK = 1024
KEYS = ("doc_id", "chunk_index")


def _joined(order: Column | str, digest: Column) -> Column:
    pairs = F.sort_array(F.collect_list(F.struct(order, digest.alias("digest"))))
    return F.array_join(F.transform(pairs, lambda p: p["digest"]), ",")


def chunk_hashes(told: DataFrame, settings: str = "") -> DataFrame:
    """(doc_id, chunk_index, n_lines, evidence_hash) of each chunk.

    ``told`` are (doc_id, chunk_index, line_number, raw); ``settings`` names what else results depend on, such as the
    engine, mode and chunk size.  A null text and an empty one differ; equal rows count as often as they come.
    """
    line = F.sha2(F.concat(F.col("line_number").cast("string"), F.when(F.col("raw").isNull(), "-").otherwise(":"), F.coalesce("raw", F.lit(""))), 256)
    blocks = told.withColumn("block", F.floor(F.col("line_number") / BLOCK)).groupBy(*KEYS, "block").agg(F.count(F.lit(1)).alias("n"), F.sha2(_joined("line_number", line), 256).alias("of_block"))
    whole = F.sha2(F.concat(_joined("block", F.col("of_block")), F.lit("|" + settings)), 256)
    return blocks.groupBy(*KEYS).agg(F.sum("n").alias("n_lines"), F.substring(whole, 1, HASH_CHARS).alias("evidence_hash"))


def document_hashes(hashes: DataFrame) -> DataFrame:
    """(doc_id, evidence_hash): the hash of each document's chunks in order."""
    return hashes.groupBy("doc_id").agg(F.substring(F.sha2(_joined("chunk_index", F.col("evidence_hash")), 256), 1, HASH_CHARS).alias("evidence_hash"))


def changes(hashes: DataFrame, stored: DataFrame) -> DataFrame:
    """(doc_id, chunk_index, evidence_hash, state) of every chunk now or before: new, changed, same or gone."""
    before = stored.select(*KEYS, F.col("evidence_hash").alias("old"))
    now = F.col("evidence_hash")
    state = F.when(F.col("old").isNull(), "new").when(now.isNull(), "gone").when(now == F.col("old"), "same").otherwise("changed")
    return hashes.select(*KEYS, "evidence_hash").join(before, list(KEYS), "full").select(*KEYS, "evidence_hash", state.alias("state"))


def replay(told: DataFrame, changed: DataFrame, results: DataFrame, compute: Callable[[DataFrame], DataFrame], plan: DataFrame | None = None) -> DataFrame:
    """``results`` brought up to date: those of chunks that stay the same, and what ``compute`` makes of the lines of all others.

    ``changed`` are the :func:`changes`; ``plan`` (doc_id, chunk_index) names chunks that are done again although
    they are the same.  ``compute`` takes lines (doc_id, chunk_index, line_number, raw) and returns rows with the
    columns of ``results``; it sees no line of a chunk that is kept.  Results of chunks that are gone go.
    """
    keys = list(KEYS)
    same = changed.where("state = 'same'").select(*keys)
    todo = changed.where("state in ('new', 'changed')").select(*keys)
    if plan is not None:
        wanted = plan.select(*keys).distinct()
        todo = todo.unionByName(same.join(wanted, keys, "left_semi"))
        same = same.join(wanted, keys, "left_anti")
    fresh = compute(told.join(todo, keys, "left_semi"))
    return results.join(same, keys, "left_semi").unionByName(fresh.select(*results.columns))


def chunk_of_items(items: DataFrame, placed: DataFrame) -> DataFrame:
    """``items`` (doc_id, start_line and more) with the chunk_index of the last window that begins at or before them.

    ``placed`` are windows (doc_id, chunk_index, start_line).  Items before the first window are of chunk 0.
    """
    marks = placed.select("doc_id", F.col("start_line").alias("_at"), F.lit(0).alias("_kind"), "chunk_index", F.lit(None).cast(items.select(F.struct("*")).schema[0].dataType).alias("_item"))
    own = items.select("doc_id", F.col("start_line").alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast("int").alias("chunk_index"), F.struct(*(items[c] for c in items.columns)).alias("_item"))
    order = W.partitionBy("doc_id").orderBy("_at", "_kind").rowsBetween(W.unboundedPreceding, 0)
    both = marks.unionByName(own).withColumn("chunk_index", F.coalesce(F.last("chunk_index", ignorenulls=True).over(order), F.lit(0))).where("_kind = 1")
    return both.select(*(F.col("_item")[c].alias(c) for c in items.columns if c != "chunk_index"), "chunk_index")


def chunk_diagnostics(items: DataFrame, chunks: DataFrame, expected: DataFrame) -> DataFrame:
    """What each chunk gave and what is wrong with it, with the reasons for doing it again.

    ``items`` are (doc_id, chunk_index, question_number, issues), ``chunks`` (doc_id, chunk_index, n_lines, error),
    ``expected`` (doc_id, expected_count).  A chunk without items is there with none; a number is out of range only
    where a count is expected.  Items are summed by number first, so no chunk's items are gathered.
    """
    keys = list(KEYS)
    number, holds = F.col("question_number"), lambda test: F.exists(F.coalesce("issues", F.array().cast("array<string>")), test)
    by_number = items.groupBy(*keys, "question_number").agg(
        F.count(F.lit(1)).alias("n"),
        F.max(holds(lambda i: i.contains("duplicate_question_number"))).alias("named_twice"),
        F.count_if(holds(lambda i: i == "noise_in_question_text")).alias("noise"),
        F.max(holds(lambda i: i.contains("hallucinated"))).alias("unlike"),
    ).join(expected, "doc_id", "left")
    outside = number.isNotNull() & F.col("expected_count").isNotNull() & ((number < 1) | (number > F.col("expected_count")))
    distinct = lambda c: F.sort_array(F.collect_list(F.when(c, number)))
    by = by_number.groupBy(*keys).agg(
        F.sum("n").alias("items"),
        distinct(number.isNotNull()).alias("numbers"),
        F.sum(F.when(number.isNull(), F.col("n")).otherwise(0)).alias("non_numeric"),
        distinct(outside).alias("out_of_range"),
        distinct(number.isNotNull() & ((F.col("n") > 1) | F.col("named_twice"))).alias("repeated"),
        F.sum("noise").alias("noise_items"),
        F.max("unlike").alias("unlike"),
    )
    kinds = items.select(*keys, F.explode("issues").alias("issue")).groupBy(*keys, F.split_part("issue", F.lit(":"), F.lit(1)).alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    counted = kinds.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("kind", "n"))).alias("issue_counts"))
    out = chunks.select(*keys, "n_lines", "error").join(by, keys, "left").join(counted, keys, "left").na.fill(0, ["items", "non_numeric", "noise_items"])
    none = F.array().cast("array<int>")
    out = out.withColumns({c: F.coalesce(c, none) for c in ("numbers", "out_of_range", "repeated")}).withColumns({"unlike": F.coalesce("unlike", F.lit(False)), "issue_counts": F.coalesce("issue_counts", F.array().cast("array<struct<kind:string,n:bigint>>"))})
    failed = F.col("error").isNotNull()
    wrong = (F.col("non_numeric") > 0) | (F.size("out_of_range") > 0) | (F.size("repeated") > 0) | (F.col("noise_items") > 0)
    status = F.when(F.col("unlike"), "warning").when(failed, "failed").when(wrong, "warning").otherwise("ok")
    begins = F.exists("issue_counts", lambda c: c["kind"].startswith("hallucinated"))
    unfounded = F.exists("issue_counts", lambda c: (c["kind"] == "missing_question_source_spans") & (c["n"] > MOST_MISSING_SPANS))
    reasons = {
        "failed_provider_response": F.col("status") == "failed",
        "non_numeric_item": F.col("non_numeric") > 0,
        "out_of_range_question": F.size("out_of_range") > 0,
        "duplicate_question": F.size("repeated") > 0,
        "suspected_noise": F.col("noise_items") > 0,
        "hallucination": begins,
        "high_missing_spans": unfounded,
    }
    spread = F.when(F.size("numbers") > 0, F.concat(F.array_min("numbers").cast("string"), F.lit(".."), F.array_max("numbers").cast("string")))
    out = out.withColumns({"question_range": spread, "status": status}).drop("unlike")
    return out.withColumn("reasons", F.array_compact(F.array(*(F.when(c, F.lit(name)) for name, c in reasons.items()))))


def replay_plan(diagnostics: DataFrame, only_suspicious: bool = True) -> DataFrame:
    """(doc_id, chunk_index, reasons): the chunks to be done again; with ``only_suspicious`` false all, the others as manual_replay."""
    plan = diagnostics.select(*KEYS, F.when(F.size("reasons") > 0, F.col("reasons")).otherwise(F.array(F.lit("manual_replay"))).alias("reasons"), (F.size("reasons") > 0).alias("_suspicious"))
    return (plan.where("_suspicious") if only_suspicious else plan).drop("_suspicious")


def roll_up(diagnostics: DataFrame, items: DataFrame, expected: DataFrame) -> DataFrame:
    """Each document's chunks and items against what is expected.

    ``items`` are (doc_id, question_id, seq, question_number, issues).  Documents come from the chunks; without an expected count
    every count matches and no number is missing.
    """
    by = diagnostics.groupBy("doc_id").agg(F.count(F.lit(1)).alias("total_chunks"), F.array_sort(F.collect_list(F.when(F.size("reasons") > 0, F.col("chunk_index")))).alias("chunks_to_replay"))
    numbers = items.groupBy("doc_id", "question_number").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size(F.filter("issues", lambda i: i.startswith("hallucinated")))).alias("unlike"))
    own = numbers.groupBy("doc_id").agg(
        F.sum("n").alias("items"),
        F.sum(F.when(F.col("question_number").isNull(), F.col("n")).otherwise(0)).alias("non_numeric_items"),
        F.sort_array(F.collect_list(F.when(F.col("n") > 1, F.col("question_number")))).alias("duplicate_numbers"),
        F.sum("unlike").alias("hallucination_suspected"),
        F.collect_set("question_number").alias("_have"),
    )
    extra = gates.extra_items(items, expected).groupBy("doc_id").agg(F.count(F.lit(1)).alias("extra_items"))
    out = by.join(own, "doc_id", "left").join(extra, "doc_id", "left").join(expected, "doc_id", "left").na.fill(0, ["items", "non_numeric_items", "extra_items", "hallucination_suspected"])
    none = F.array().cast("array<int>")
    wanted = F.when(F.col("expected_count") > 0, F.sequence(F.lit(1), F.col("expected_count"))).otherwise(none)
    out = out.withColumns({"missing_numbers": F.array_except(wanted, F.coalesce("_have", none)), "duplicate_numbers": F.coalesce("duplicate_numbers", none), "count_match": F.coalesce(F.col("items") == F.col("expected_count"), F.lit(True))})
    said = F.array_compact(F.array(F.when(~F.col("count_match"), F.concat(F.lit("expected_count_mismatch: expected="), F.col("expected_count"), F.lit(" actual="), F.col("items"))), F.when(F.col("extra_items") > 0, F.concat(F.lit("extra_item_count:"), F.col("extra_items")))))
    return out.withColumn("warnings", said).drop("_have")
