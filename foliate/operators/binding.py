"""Validation of bound items: what their spans say, as findings with a severity, and the status that these add up to.

Every part of an item that claims a source (question, option, answer, solution) is a row with
its lines; rows meet the document's lines in one join, and each rule gives findings.
A status is the greatest severity of an item's findings, so escalation is a grouped maximum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliate.functions import anchors as A
from foliate.functions import patterns as P
from foliate.functions import text as T
from foliate.operators.status import in_evidence, matchable

#: Statuses by severity, modes of answers, and keys that an option may have.
STATUSES = ("accepted", "review_required", "rejected")
MODES = ("required", "answer_key_only", "question_only", "optional")
KEYS = ("A", "B", "C", "D", "E", "1", "2", "3", "4")
REVIEW, REJECT = 1, 2
#: Where each kind of finding stands in an item's list.
OPTIONS_AT, ANSWER_AT, SOLUTION_AT, MODE_AT, NUMBER_AT = 1_000_000, 2_000_000, 3_000_000, 4_000_000, 5_000_000
_PART = "struct<at:int,kind:string,key:string,text:string,lines:array<int>,asset:boolean>"


def _part(at: Column, kind: str, key: Column, text: Column, lines: Column, asset: Column) -> Column:
    return F.struct(at.cast("int").alias("at"), F.lit(kind).alias("kind"), key.cast("string").alias("key"), text.alias("text"), F.coalesce(lines, F.array().cast("array<int>")).alias("lines"), F.coalesce(asset, F.lit(False)).alias("asset")).cast(_PART)


def _finding(at: Column | int, issue: Column | str, severity: int) -> Column:
    return F.struct((F.lit(at) if isinstance(at, int) else at).cast("int").alias("at"), (F.lit(issue) if isinstance(issue, str) else issue).alias("issue"), F.lit(severity).alias("severity"))


def _blank(text: Column) -> Column:
    return T.strip(F.coalesce(text, F.lit(""))) == ""


def source_findings(items: DataFrame, lines: DataFrame) -> DataFrame:
    """(doc_id, question_id, at, issue, severity): parts without lines, and parts whose lines don't hold their text."""
    none = F.lit(None)
    options = F.transform(F.coalesce("options", F.array().cast(items.schema["options"].dataType)), lambda o, i: _part(10 * (i + 1), "option", o["key"], o["text"], F.when(o["line"].isNotNull(), F.array(o["line"])), o["asset"]))
    question = _part(F.lit(0), "question", none, F.col("question_text_raw"), F.col("question_lines"), none)
    answer = F.when(F.col("answer_key").isNotNull(), _part(F.lit(ANSWER_AT), "answer", F.col("answer_key"), F.col("answer_text"), F.col("answer_lines"), none))
    solution = F.when(F.col("solution_text").isNotNull(), _part(F.lit(SOLUTION_AT), "solution", none, F.col("solution_text"), F.col("solution_lines"), none))
    parts = items.select("doc_id", "question_id", F.explode(F.concat(F.array(question), options, F.array_compact(F.array(answer, solution)))).alias("p")).select("doc_id", "question_id", "p.*")
    parts = parts.where((F.col("kind") != "option") | ~_blank(F.col("text")) | ~_blank(F.col("key")))
    claimed = parts.select("doc_id", "question_id", "at", F.explode("lines").alias("line_number"))
    shown = claimed.join(lines.select("doc_id", "line_number", "raw"), ["doc_id", "line_number"]).withColumn("m", matchable(F.col("raw")))
    shown = shown.groupBy("doc_id", "question_id", "at").agg(F.sort_array(F.collect_list(F.when(F.col("m") != "", F.struct("line_number", "m")))).alias("held"))
    shown = shown.select("doc_id", "question_id", "at", F.transform("held", lambda x: x["m"]).alias("held"))
    told = parts.join(shown, ["doc_id", "question_id", "at"], "left").withColumn("held", F.coalesce("held", F.array().cast("array<string>")))
    kind, at, text = F.col("kind"), F.col("at"), F.coalesce("text", F.lit(""))
    lost, named = (F.size("lines") == 0) & ~F.col("asset"), F.coalesce("key", F.lit(""))
    unlike = (F.size("lines") > 0) & (text != "") & ~in_evidence(F.array(text), F.array_join("held", " "), F.col("held"))
    of = lambda name: F.concat(F.lit(name), F.when(kind == "option", F.concat(F.lit(":"), named)).otherwise(""))
    missing = F.concat(F.lit("missing_"), kind, F.lit("_source_spans"))
    # answers and solutions without lines are looked at again, the rest is refused
    severe = F.when(lost, F.when(kind.isin("question", "option"), REJECT).otherwise(REVIEW)).otherwise(REJECT)
    issue = F.when(lost, F.when(kind == "option", F.concat(missing, F.lit(":"), named)).otherwise(missing)).when(unlike, F.when(kind == "option", of("hallucinated_option_text")).otherwise(F.concat(F.lit("hallucinated_"), kind, F.lit("_text"))))
    first = F.when(issue.isNotNull(), F.struct((at + 1).alias("at"), issue.alias("issue"), severe.alias("severity")))
    bare = F.regexp_replace(T.strip(named), r"\.+$", "")
    noisy = F.when((kind == "question") & T.has(text, P.NOISE_GUARD) & T.has(text, P.WINDOW_NOISE), _finding(at + 2, "noise_in_question_text", REVIEW))
    invalid = F.when((kind == "option") & (bare != "") & ~F.upper(T.strip(bare)).isin(*KEYS), _finding(at + 2, F.concat(F.lit("invalid_option_key:"), named), REVIEW))
    return told.select("doc_id", "question_id", F.explode(F.array_compact(F.array(first, noisy, invalid))).alias("f")).select("doc_id", "question_id", "f.*")


def validate(items: DataFrame, lines: DataFrame, mode: str = "answer_key_only") -> DataFrame:
    """(doc_id, question_id, question_number, issues, status) of every item.

    ``items`` are (doc_id, question_id, question_number, question_text_raw, question_lines, options of key,
    text, line and asset, answer_key, answer_text, answer_lines, solution_text, solution_lines); ``lines``
    (doc_id, line_number, raw) of the documents.  ``mode`` is one of MODES.  A question or
    an option without lines or that its lines don't hold is rejected; an answer outside the
    options, a repeated number and the like are for review.  Items without a text, options or
    a number are validated alike; (doc_id, question_id) must name an item.
    """
    hints = lines.groupBy("doc_id").agg(F.max(F.expr(A.guarded("raw", P.OPTION_GUARD, A.is_option_line(A.Spark, "raw")))).alias("hinted"))
    own = items.join(hints, "doc_id", "left").withColumn("same", F.count("question_number").over(W.partitionBy("doc_id", "question_number")))
    answered, solved = F.col("answer_key").isNotNull(), F.col("solution_text").isNotNull()
    keys = F.array_compact(F.transform(F.coalesce("options", F.array().cast(items.schema["options"].dataType)), lambda o: T.option_key(o["key"])))
    without, wrong = F.size(F.coalesce("options", F.array().cast(items.schema["options"].dataType))) == 0, T.answer_key(F.col("answer_key"))
    rules = [
        (without & F.coalesce("hinted", F.lit(False)), OPTIONS_AT, "missing_options", REVIEW),
        (without & ~F.coalesce("hinted", F.lit(False)), OPTIONS_AT, "missing_options", REJECT),
        (answered & wrong.isNotNull() & (F.size(keys) > 0) & ~F.array_contains(keys, wrong), ANSWER_AT + 2, "answer_key_not_in_options", REVIEW),
        (F.col("same") > 1, NUMBER_AT, "duplicate_question_number", REVIEW),
    ]
    if mode == "required":
        rules += [(~answered, MODE_AT, "missing_answer_required_mode", REVIEW), (~solved, MODE_AT + 1, "missing_solution_required_mode", REVIEW)]
    elif mode == "answer_key_only":
        rules.append((~answered, MODE_AT, "missing_answer_answer_key_only_mode", REVIEW))
    elif mode == "question_only":
        rules.append((answered, MODE_AT, "answer_present_question_only_mode_ignored", 0))
    else:
        rules += [(~answered, MODE_AT, "missing_answer_optional_mode", 0), (~solved, MODE_AT + 1, "missing_solution_optional_mode", 0)]
    whole = own.select("doc_id", "question_id", F.explode(F.array_compact(F.array(*(F.when(c, _finding(at, issue, s)) for c, at, issue, s in rules)))).alias("f")).select("doc_id", "question_id", "f.*")
    found = source_findings(items, lines).unionByName(whole).groupBy("doc_id", "question_id").agg(F.sort_array(F.collect_list(F.struct("at", "issue"))).alias("found"), F.max("severity").alias("worst"))
    out = items.select("doc_id", "question_id", "question_number").join(found, ["doc_id", "question_id"], "left")
    issues = F.coalesce(F.array_distinct(F.transform("found", lambda f: f["issue"])), F.array().cast("array<string>"))
    return out.select("doc_id", "question_id", "question_number", issues.alias("issues"), F.element_at(F.array(*map(F.lit, STATUSES)), F.coalesce("worst", F.lit(0)) + 1).alias("status"))


def validation_counts(validated: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """Each document's items by status and by kind of issue; with ``expected`` (doc_id, expected_count) how many numbers are missing."""
    having = lambda test: F.size(F.filter("issues", test))
    kinds = {
        "source_span_missing": lambda i: i.contains("_source_spans"),
        "hallucination_suspected": lambda i: i.startswith("hallucinated_"),
        "option_key_missing": lambda i: i == "missing_options",
        "answer_key_not_in_options": lambda i: i == "answer_key_not_in_options",
    }
    out = validated.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("total"),
        *(F.count_if(F.col("status") == s).alias(s) for s in STATUSES),
        *(F.sum(having(test)).cast("long").alias(name) for name, test in kinds.items()),
        (F.count("question_number") - F.count_distinct("question_number")).alias("duplicate_numbers"),
        F.collect_set("question_number").alias("_numbers"),
    )
    if expected is not None:
        out = out.join(expected, "doc_id", "left")
        out = out.withColumn("missing_numbers", (F.greatest(F.col("expected_count"), F.lit(0)) - F.size(F.filter("_numbers", lambda n: n.between(1, F.col("expected_count"))))).cast("long"))
    return out.drop("_numbers", "expected_count")
