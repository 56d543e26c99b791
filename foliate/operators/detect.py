"""Answer-key evidence, numeric options, response sheets, and sanity of a document's windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliate.functions import markers
from foliate.functions import text as T

# --- fixed values -------------------------------------------------------------------
KEY_HEADING = r"(?i)^(?:Answer\s*Key|Answers?\s*(?:Key|Sheet)?)\s*:?\s*$"
NUMERIC_KEY = r"(\d{1,3})\s*[\.\)\-]\s*([A-Da-d])\b"
Q_KEY = r"(?i)\bQ\s*(\d{1,3})\s+([A-Da-d])\b"
MARKED_KEY = r"(?i)\b(?:Ans(?:wer)?|Key)\s*[\.\:]?\s*\(?\s*(\d{1,3})\s*[\.\)\-]?\s*([A-Da-d])\s*\)?"
LONE_KEY = r"(?i)^\d{1,3}\s*[\.\)\-]\s*[A-Da-d]\.?$"
MOST_NUMBER = 300
NUMERIC_OPTION = r"(?i)^(?:Ans(?:wer)?\s*)?(\d+)\s*[\.\)]\s*(.*)$"
PAREN_OPTION = r"^\(\s*(\d+)\s*\)\s*(.*)$"
SEVERAL_OPTIONS = r"(\d+)\s*[\.\)]\s*([^0-9]+?)(?=\s*\d+\s*[\.\)]|$)"
SHEET = r"(?i)(?:question\s*id|chosen\s*option|status\s*:|\bans\s*\d)"
REPEAT_DISTANCE = 15
MIN_WINDOWS, MOST_SOLUTIONS, MOST_MAPPED = 0.7, 1.3, 1.3

_NOT_BEFORE = r"(?<![\d/])"


def answer_key_candidates(lines: DataFrame) -> DataFrame:
    """(doc_id, question_number, answer_key, line_number, confidence): each pair once, at its first place.

    Once an answer-key heading has come, every later line of the document counts as a key line.
    ``lines`` has raw, plain and line_type.
    """
    raw = T.strip(F.col("raw"))
    order = W.partitionBy("doc_id").orderBy("line_number")
    opens = T.has(raw, KEY_HEADING) | ((F.col("line_type") == "solution_section_heading") & F.lower(raw).contains("answer"))
    seen = lines.withColumn("bare", raw).where("bare <> ''").withColumn("in_section", F.max(opens).over(order.rowsBetween(W.unboundedPreceding, 0)))
    bare = F.col("bare")
    pairs = F.regexp_count(bare, F.lit(T.uni(_NOT_BEFORE + NUMERIC_KEY)))
    keyed = T.has(F.col("plain"), T.P.KEY_NUMERIC) | T.has(F.col("plain"), T.P.KEY_INLINE) | T.has(F.col("plain"), T.P.ANSWER_MARKER)
    seen = seen.where(F.col("in_section") | keyed | (pairs >= 2) | ((pairs == 1) & (F.char_length(bare) < 40) & T.has(bare, LONE_KEY)))

    def found(pattern: str, rank: int) -> Column:
        all_of = lambda g: F.regexp_extract_all(bare, F.lit(T.uni(pattern)), F.lit(g))
        return F.transform(F.arrays_zip(all_of(1).alias("n"), all_of(2).alias("k")), lambda z: F.struct(F.lit(rank).alias("rank"), z["n"].cast("int").alias("n"), F.upper(z["k"]).alias("k")))

    every = F.concat(found(_NOT_BEFORE + NUMERIC_KEY, 0), found(Q_KEY, 1), found(MARKED_KEY, 2))
    flat = seen.select("doc_id", "line_number", "in_section", F.posexplode_outer(every).alias("at", "f")).where(F.col("f.n").between(1, MOST_NUMBER))
    first = F.row_number().over(W.partitionBy("doc_id", "f.n", "f.k").orderBy("line_number", "at"))
    return flat.withColumn("place", first).where("place = 1").select("doc_id", F.col("f.n").alias("question_number"), F.col("f.k").alias("answer_key"), "line_number", F.when(F.col("in_section"), 0.9).otherwise(0.75).alias("confidence"))


def numeric_option(text: Column) -> Column:
    """struct(key, canonical_key, text) of a line such as ``2) so``; null if it is none.  Keys 1-4 are A-D."""
    bare = T.strip(F.regexp_replace(text, r"(?i)<br\s*/?>", " "))
    forms = [F.when(T.has(bare, p), _option(T.part(bare, p), T.part(bare, p, 2))) for p in (NUMERIC_OPTION, PAREN_OPTION)]
    return F.coalesce(*forms)


def _option(key: Column, text: Column) -> Column:
    return F.struct(key.alias("key"), F.when(key.rlike("^[1-4]$"), F.translate(key, "1234", "ABCD")).alias("canonical_key"), T.strip(text).alias("text"))


def numeric_options(text: Column) -> Column:
    """All numeric options of one line or cell, the first of each key; else the line's single one."""
    bare = T.strip(F.regexp_replace(text, r"(?i)<br\s*/?>", " "))
    all_of = lambda g: F.regexp_extract_all(bare, F.lit(T.uni(SEVERAL_OPTIONS)), F.lit(g))
    many = F.transform(F.arrays_zip(all_of(1).alias("k"), all_of(2).alias("t")), lambda z: _option(z["k"], z["t"]))
    first = F.filter(many, lambda o, i: F.array_position(F.transform(many, lambda x: x["key"]), o["key"]) == i + 1)
    return F.when(F.size(many) > 0, first).when(numeric_option(text).isNotNull(), F.array(numeric_option(text))).otherwise(F.array().cast("array<struct<key:string,canonical_key:string,text:string>>"))


def layouts(lines: DataFrame) -> DataFrame:
    """By document: marks of response sheets, numbers that come again far below, and whether global binding is safe."""
    raw = F.col("raw")
    hits = (T.has(raw, SHEET) & ~markers.is_chosen_instruction(raw)).cast("int") + F.lower(raw).contains("question id").cast("int")
    marked = lines.withColumn("number", F.when(F.col("line_type") == "question_anchor", F.regexp_extract("detected_label", r"(\d+)", 1).try_cast("int")))
    before = F.lag("line_number").over(W.partitionBy("doc_id", "number").orderBy("line_number"))
    marked = marked.withColumn("far", F.col("number").isNotNull() & (F.col("line_number") - before >= REPEAT_DISTANCE))
    by = marked.groupBy("doc_id").agg(F.sum(hits).alias("sheet_hits"), F.max(markers.is_chosen_metadata(raw)).alias("chosen_option_detected"), F.array_sort(F.collect_set(F.when(F.col("far"), F.col("number")))).alias("repeated_numbers"))
    sheet = (F.col("sheet_hits") >= 3) | (F.col("chosen_option_detected") & (F.col("sheet_hits") >= 1))
    return by.withColumn("response_sheet", sheet).withColumn("unsupported", F.col("chosen_option_detected"))


def section_sanity(expected: DataFrame, windows: DataFrame, solutions: DataFrame) -> DataFrame:
    """By document of ``expected``: too few question windows, too many solutions, and whether binding may go on."""
    count = lambda df, name: df.groupBy("doc_id").agg(F.count(F.lit(1)).alias(name))
    joined = expected.join(count(windows, "question_windows"), "doc_id", "left").join(count(solutions, "solution_windows"), "doc_id", "left").na.fill(0, ["question_windows", "solution_windows"])
    share = lambda r: (F.col("expected_count") * F.lit(r)).cast("int")
    some = F.col("expected_count") > 0
    few = some & (F.col("question_windows") < share(MIN_WINDOWS))
    many = some & (F.col("solution_windows") > share(MOST_SOLUTIONS))
    reason = F.when(few & many, "question_solution_split_failed").when(few | (F.col("question_windows") == 0), "question_window_build_failed").when(many, "solution_over_detection")
    return joined.select("doc_id", "expected_count", "question_windows", "solution_windows", reason.alias("failure_reason"), reason.isNull().alias("passed"))


def coverage(expected: DataFrame, cands: DataFrame) -> DataFrame:
    """Expected numbers without a candidate, by document, and whether a later candidate exists."""
    wanted = expected.where("expected_count > 0").select("doc_id", F.explode_outer(F.sequence(F.lit(1), "expected_count")).alias("question_number"))
    have = cands.select("doc_id", "question_number").distinct()
    last = cands.groupBy("doc_id").agg(F.max("question_number").alias("last"))
    missing = wanted.join(have, ["doc_id", "question_number"], "left_anti").join(last, "doc_id", "left")
    return missing.select("doc_id", "question_number", F.when(F.col("question_number") < F.col("last"), "inside").otherwise("after_last").alias("place"))
