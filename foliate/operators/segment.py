"""Question candidates: windows of lines from one anchor to the next, and the options in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliate.functions import patterns as P
from foliate.functions import text as T

VALID_CONFIDENCE = 0.85
EXPECTED_KEYS = ["A", "B", "C", "D"]
#: Line types that a stem skips, that end it, and that continue an option.
SKIPPED = ["page_number_marker", "page_break_marker", "page_footer_marker", "noise_candidate"]
ENDS_STEM = ["option_candidate", "image_reference"]
CONTINUES = ["text", "math_block", "table_row"]
PASSED = ["page_number_marker", "page_break_marker", "page_footer_marker"]
#: Issues that make a candidate incomplete, and that do not count for review.
INCOMPLETE = ["missing_options", "source_backed_option_labels_missing", "missing_option_labels_for_visual_question", "unlabeled_visual_assets", "invalid_option_count", "empty_option_text_without_asset"]
HARMLESS = ["visual_question_requires_diagram_syntax", "possible_noise_asset_after_options", "same_line_option_split_applied"]


def candidate_lines(content: DataFrame) -> DataFrame:
    """The lines of each question's window, with seq, the number of its anchor in the document.

    Windows end where the solution section begins.
    """
    upto = W.partitionBy("doc_id").orderBy("line_number").rowsBetween(W.unboundedPreceding, 0)
    heading = (F.col("line_type") == "solution_section_heading") | T.has(F.col("plain"), P.SOLUTION_HEADING)
    marked = content.withColumns({"solutions": F.count_if(heading).over(upto), "seq": F.count_if(F.col("line_type") == "question_anchor").over(upto)})
    return marked.where("solutions = 0 and seq > 0").drop("solutions")


def _option_lines(lines: DataFrame) -> DataFrame:
    """``lines`` with opt, the number of the option before or at each in its window, 0 before the first, with piece, what
    the line says of it, and ``kept``, whether it belongs to the option.

    An option's own counts are running counts of the window less those at its head, so that all share one order of the lines.
    """
    order = W.partitionBy("doc_id", "seq").orderBy("line_number")
    upto, before = order.rowsBetween(W.unboundedPreceding, 0), order.rowsBetween(W.unboundedPreceding, -1)
    plain, kind = F.col("plain"), F.col("line_type")
    is_head = kind == "option_candidate"
    # only the heads are parsed
    form = F.when(is_head, F.when(T.has(plain, P.PARSED_PAREN), 1).when(T.has(plain, P.PARSED_DOT), 2).otherwise(0))
    out = lines.withColumn("form", form)
    out = out.withColumn("rest", F.when(F.col("form") == 1, T.part(plain, P.PARSED_PAREN, 2)).when(F.col("form") == 2, T.part(plain, P.PARSED_DOT, 2)).otherwise(""))
    out = out.withColumn("piece", F.when(is_head, F.when(F.col("rest") != "", F.col("rest"))).when(kind.isin(CONTINUES), F.col("raw")))
    out = out.withColumns({"opt": F.count_if(is_head).over(upto), "said": F.count("piece").over(before)})
    out = out.withColumn("has_text", F.col("said") > F.last(F.when(is_head, F.col("said")), ignorenulls=True).over(upto))
    image = kind == "image_reference"
    stops = ~is_head & ((image & F.col("has_text")) | ~kind.isin([*CONTINUES, *PASSED, "image_reference"]))
    out = out.withColumn("stops", F.count_if(stops).over(upto))
    kept = (F.col("opt") > 0) & (F.col("stops") == F.last(F.when(is_head, F.col("stops")), ignorenulls=True).over(upto))
    return out.withColumn("kept", F.coalesce(kept, F.lit(False))).drop("said", "has_text", "stops", "rest")


def _option_fields() -> list[Column]:
    """What the lines of :func:`_option_lines` say of their option, for a grouping by (doc_id, seq, opt)."""
    plain, kept, kind = F.col("plain"), F.col("kept"), F.col("line_type")
    is_head = kind == "option_candidate"
    head = lambda c: F.max(F.when(is_head, c))
    form = F.col("form")
    key = F.when(form == 1, F.upper(T.part(plain, P.PARSED_PAREN))).when(form == 2, T.part(plain, P.PARSED_DOT)).otherwise(F.upper("detected_label"))
    key_raw = F.when(form == 1, F.concat(F.lit("("), T.part(plain, P.PARSED_PAREN), F.lit(")"))).when(form == 2, F.concat(T.part(plain, P.PARSED_DOT), F.lit("."))).otherwise(F.col("detected_label"))
    return [
        head(key).alias("key"),
        head(key_raw).alias("key_raw"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(kept & F.col("piece").isNotNull(), F.struct("line_number", "piece")))), lambda x: x["piece"]), "\n").alias("text"),
        F.min(F.when(kept, F.col("line_number"))).alias("start_line"),
        F.max(F.when(kept & ~kind.isin(PASSED), F.col("line_number"))).alias("end_line"),
        F.min(F.when(kept & (is_head | kind.isin(CONTINUES)), F.col("confidence"))).alias("confidence"),
        head(F.col("issue")).alias("issue"),
    ]


def _parts(one: DataFrame) -> DataFrame:
    """``one`` row an option with ``parts``, (part, key, key_raw, text, issues) of what it is split into at markers inside its text."""
    bare = T.strip(F.col("text"))
    texts = F.transform(F.split(bare, T.uni(P.EMBEDDED_MARKER), -1), T.strip)
    marks = F.regexp_extract_all(bare, F.lit(T.uni(P.EMBEDDED_MARKER)), F.lit(1))
    out = one.withColumns({"texts": texts, "marks": marks})
    first = F.when(F.get("texts", F.lit(0)) != "", F.array(F.struct(F.upper("key").alias("key"), F.concat(F.lit("("), F.lower("key"), F.lit(")")).alias("key_raw"), F.get("texts", F.lit(0)).alias("text")))).otherwise(F.array().cast("array<struct<key:string,key_raw:string,text:string>>"))
    later = F.transform("marks", lambda m, i: F.struct(F.upper(m).alias("key"), F.concat(F.lit("("), m, F.lit(")")).alias("key_raw"), F.get("texts", i + 1).alias("text")))
    out = out.withColumn("segments", F.concat(first, later)).withColumn("was_split", F.col("key").isNotNull() & (F.size("segments") > 1))
    out = out.withColumn("segments", F.when(F.col("was_split"), F.col("segments")).otherwise(F.array(F.struct("key", "key_raw", "text"))))
    # a line's own text decides whether it is empty, before it is split
    blank = lambda s: ~F.col("was_split") & (T.strip(s["text"]) == "")
    issues = lambda s: F.array_compact(F.array("issue", F.when(blank(s), "empty_option_text")))
    return out.withColumn("parts", F.transform("segments", lambda s, i: F.struct(i.alias("part"), s["key"].alias("key"), s["key_raw"].alias("key_raw"), s["text"].alias("text"), issues(s).alias("issues")))).drop("texts", "marks", "segments", "issue")


def options(lines: DataFrame) -> DataFrame:
    """The options of each window with their continuation lines: one row an option, in order.

    A line after an option continues it until one of another kind comes; an image
    ends it once it has text.  Text with further markers inside is split at them.
    """
    one = _option_lines(lines).where("kept").groupBy("doc_id", "seq", "opt").agg(*_option_fields())
    out = _parts(one).select("doc_id", "seq", "opt", "start_line", "end_line", "confidence", "was_split", F.explode("parts").alias("s"))
    return out.select("doc_id", "seq", "opt", *(F.col(f"s.{c}").alias(c) for c in ("part", "key", "key_raw", "text")), "start_line", "end_line", "confidence", "was_split", F.col("s.issues").alias("issues"))


def _with_images(df: DataFrame) -> DataFrame:
    """``df`` with ``pics``, the lines of each window's images, as (role, late, opt): what each is and the option that it belongs to.

    ``opts`` are the window's options by number and part, null without one.
    """
    first_line, last_line = F.array_min(F.transform("opts", lambda o: o["start_line"])), F.array_max(F.transform("opts", lambda o: o["end_line"]))
    out = df.withColumns({"first_line": first_line, "last_line": last_line})
    nearest = lambda p: F.array_max(F.transform(F.filter("opts", lambda o: o["start_line"] < p), lambda o: o["start_line"]))
    out = out.withColumn("pics", F.transform("pics", lambda p: F.struct(p.alias("line"), nearest(p).alias("nearest"))))
    out = out.withColumn("pics", F.transform("pics", lambda p: F.struct(p["line"].alias("line"), F.get(F.filter("opts", lambda o: o["start_line"] == p["nearest"]), F.lit(0)).alias("owner"))))

    def role(p: Column) -> Column:
        return (
            F.when(p["line"] < F.col("first_line"), "noise_candidate")
            .when(p["owner"].isNotNull() & (T.strip(p["owner"]["text"]) == ""), "option_image")
            .when(p["line"] > F.col("last_line"), "noise_candidate")
            .when(p["owner"].isNotNull(), "noise_candidate")
            .otherwise("unknown")
        )

    out = out.withColumn("pics", F.transform("pics", lambda p: F.struct(p["line"].alias("line"), p["owner"].alias("owner"), role(p).alias("role"))))
    late = lambda p: F.coalesce((p["line"] > F.col("last_line")) & (p["role"] == "noise_candidate") & ~(p["line"] < F.col("first_line")), F.lit(False))
    return out.withColumn("pics", F.transform("pics", lambda p: F.struct(p["role"].alias("role"), late(p).alias("late"), F.when(p["role"] == "option_image", p["owner"]["opt"]).alias("opt")))).drop("first_line", "last_line")


def _stem(lines: DataFrame) -> DataFrame:
    window = W.partitionBy("doc_id", "seq").orderBy("line_number").rowsBetween(W.unboundedPreceding, 0)
    ended = F.max(F.when(F.col("line_type").isin(ENDS_STEM), 1).otherwise(0)).over(window)
    return lines.withColumn("in_stem", (ended == 0) & ~F.col("line_type").isin(SKIPPED))


def candidates(content: DataFrame) -> DataFrame:
    """One row a question: number, stem, options, trace, confidence, issues and review status.

    Shuffles by document only, and joins nothing: lines are grouped by option and then by
    question, and images meet their options inside the question's row.
    """
    # of lines without a number nothing is cast: a cast that fails costs an exception
    number = F.nullif(F.regexp_extract("detected_label", r"(\d+)", 1), F.lit("")).try_cast("int")
    by_option = _option_lines(_stem(candidate_lines(content))).groupBy("doc_id", "seq", "opt").agg(
        *_option_fields(),
        F.collect_list(F.struct("line_number", "raw", "in_stem", F.col("confidence").alias("sure"))).alias("lines"),
        F.min(F.struct("line_number", number.alias("number"), "detected_label")).alias("anchor"),
        F.max("line_number").alias("last_line"),
        F.min("page_number").alias("first_page"),
        F.max("page_number").alias("last_page"),
        F.collect_list(F.when(F.col("line_type").isin("page_footer_marker", "noise_candidate"), F.concat(F.lit("noise_inside_candidate_line_"), F.col("line_number")))).alias("noise"),
        F.collect_list(F.when(F.col("line_type") == "image_reference", F.col("line_number"))).alias("pics"),
    )
    mine = F.transform("parts", lambda s: F.struct("opt", s["part"].alias("part"), s["key"].alias("key"), s["key_raw"].alias("key_raw"), s["text"].alias("text"), "start_line", "end_line", "confidence", "was_split", s["issues"].alias("issues")))
    parts = _parts(by_option).withColumn("parts", F.when(F.col("opt") > 0, mine))
    every = lambda c: F.flatten(F.collect_list(c))
    base = parts.groupBy("doc_id", "seq").agg(
        F.min("anchor").alias("anchor"),
        F.array_sort(every("lines")).alias("lines"),
        F.max("last_line").alias("end_line"),
        F.min("first_page").alias("page_start"),
        F.max("last_page").alias("page_end"),
        F.array_sort(every("noise")).alias("noise"),
        F.array_sort(every("pics")).alias("pics"),
        F.array_sort(every("parts")).alias("opts"),
    )
    text = lambda found: F.array_join(F.transform(found, lambda x: x["raw"]), "\n")
    sums = F.aggregate("lines", F.lit(0.0), lambda s, x: s + x["sure"])
    base = base.select(
        "doc_id", "seq", F.col("anchor.number").alias("question_number"), F.col("anchor.detected_label").alias("question_number_raw"),
        text("lines").alias("raw_text"), text(F.filter("lines", lambda x: x["in_stem"])).alias("question_text_raw"),
        F.col("anchor.line_number").alias("start_line"), "end_line", "page_start", "page_end", (sums / F.size("lines")).alias("confidence"), "noise", "pics",
        F.when(F.size("opts") > 0, F.col("opts")).alias("opts"),
    )
    seen = W.partitionBy("doc_id", "question_number").orderBy("seq")
    base = base.withColumn("duplicate", F.col("question_number").isNotNull() & (F.row_number().over(seen) > 1))
    whole = _with_images(base).withColumn("linked", F.transform(F.filter("pics", lambda p: p["role"] == "option_image"), lambda p: p["opt"]))
    linked = lambda o: F.array_contains("linked", o["opt"])
    issues = lambda o: F.when(linked(o), F.array_remove(o["issues"], "empty_option_text")).otherwise(o["issues"])
    whole = whole.withColumn("was_split", F.exists("opts", lambda o: o["was_split"]))
    whole = whole.withColumn("options", F.transform("opts", lambda o: F.struct(*(o[c].alias(c) for c in ("key", "key_raw", "text", "start_line", "end_line", "confidence")), linked(o).alias("linked"), issues(o).alias("issues"))))
    whole = whole.withColumns(
        {
            "option_keys": F.array_sort(F.array_distinct(F.array_compact(F.transform("options", lambda o: o["key"])))),
            "empty_option": F.exists("options", lambda o: ~o["linked"] & (T.strip(o["text"]) == "")),
            "option_issue": F.exists("options", lambda o: F.size(o["issues"]) > 0),
            "all_linked": F.forall("options", lambda o: o["linked"]),
            "all_text": F.forall("options", lambda o: F.coalesce(o["text"] != "", F.lit(True))),
            "assets": F.size("pics").cast("long"),
            "noise_assets": F.size(F.filter("pics", lambda p: p["role"] == "noise_candidate")).cast("long"),
            "late_image": F.exists("pics", lambda p: p["late"]),
            "unlabeled": F.exists("pics", lambda p: p["role"] == "unknown"),
        }
    )
    return _judged(whole)


def _judged(df: DataFrame) -> DataFrame:
    """Issues and status of candidates."""
    no = F.lit(False)
    flag = lambda c: F.coalesce(F.col(c), no)
    has_options, assets = F.col("options").isNotNull(), F.coalesce("assets", F.lit(0)) > 0
    df, visual = df.withColumn("_visual", T.is_visual(F.col("question_text_raw"))), F.col("_visual")  # a column, as it is asked several times
    expected = F.coalesce(F.col("option_keys") == F.array(*map(F.lit, EXPECTED_KEYS)), no)
    some = lambda *pairs: F.array_compact(F.array(*(F.when(c, F.lit(i)) for c, i in pairs)))
    none = F.array().cast("array<string>")
    seen = (
        F.when(~has_options & assets, F.array(*map(F.lit, ("missing_options", "source_backed_option_labels_missing", "unlabeled_visual_assets"))))
        .when(visual & expected & flag("all_text"), F.array(F.lit("visual_question_requires_diagram_syntax")))
        .when(expected & flag("all_linked"), F.array(F.lit("visual_question_requires_review")))
        .when(~assets & ~visual, none)
        .otherwise(some((visual & has_options & ~expected, "missing_option_labels_for_visual_question"), (flag("unlabeled"), "unlabeled_visual_assets"), (flag("empty_option"), "empty_option_text_without_asset"), (has_options & ~expected, "invalid_option_count")))
    )
    own = some((F.col("duplicate"), "duplicate_question_number"), (flag("was_split"), "same_line_option_split_applied"), (flag("late_image"), "possible_noise_asset_after_options"), (~has_options, "missing_options"))
    judged = df.withColumn("_seen", seen).withColumn("issues", F.array_sort(F.array_distinct(F.concat(own, "noise", "_seen"))))
    blocking = F.arrays_overlap("issues", F.array(*map(F.lit, INCOMPLETE)))
    real = F.size(F.array_except("issues", F.array(*map(F.lit, HARMLESS)))) > 0
    status = (
        F.when(F.col("duplicate"), "candidate_duplicate")
        .when((T.strip(F.col("question_text_raw")) == "") | ~has_options | blocking, "candidate_incomplete")
        .when(real | flag("option_issue") | (F.col("confidence") < VALID_CONFIDENCE), "candidate_needs_review")
        .otherwise("candidate_valid")
    )
    out = judged.withColumn("review_status", status).withColumn("question_id", F.format_string("q_%04d", "seq")).withColumn("assets", F.coalesce("assets", F.lit(0))).withColumn("noise_assets", F.coalesce("noise_assets", F.lit(0)))
    return out.select("doc_id", "seq", "question_id", "question_number", "question_number_raw", "raw_text", "question_text_raw", "options", "option_keys", "assets", "noise_assets", "start_line", "end_line", "page_start", "page_end", "confidence", "review_status", "issues")


def candidate_metrics(cands: DataFrame) -> DataFrame:
    """Counters of each document's candidates."""
    status = lambda s: F.count_if(F.col("review_status") == s)
    holds = lambda i: F.count_if(F.array_contains("issues", i))
    expected = F.array(*map(F.lit, EXPECTED_KEYS))
    noisy = (F.col("noise_assets") > 0) | F.array_contains("issues", "possible_noise_asset_after_options") | F.exists("issues", lambda i: i.contains("noise_inside"))
    partial = F.count_if(F.col("options").isNotNull() & (F.col("option_keys") != expected))
    return cands.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("total_candidates"),
        status("candidate_valid").alias("valid_candidates"),
        status("candidate_needs_review").alias("needs_review_candidates"),
        status("candidate_incomplete").alias("incomplete_candidates"),
        status("candidate_duplicate").alias("duplicate_candidates"),
        F.count_if(F.col("assets") > 0).alias("candidates_with_images"),
        F.count_if(noisy).alias("candidates_with_noise"),
        F.sum("noise_assets").alias("noise_asset_count"),
        F.count_if(F.col("options").isNull()).alias("candidates_with_no_options"),
        partial.alias("candidates_with_partial_options"),
        F.count_if(T.is_visual(F.col("question_text_raw"))).alias("visual_dependent_count"),
        holds("same_line_option_split_applied").alias("same_line_option_split_count"),
        holds("possible_noise_asset_after_options").alias("possible_noise_asset_after_options_count"),
    )


def sequence_issues(cands: DataFrame) -> DataFrame:
    """Numbers that occur twice and numbers that are missing up to the largest, by document."""
    numbers = cands.where("question_number is not null").groupBy("doc_id", "question_number").agg(F.count(F.lit(1)).alias("n"))
    by_doc = numbers.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.when(F.col("n") > 1, F.col("question_number")))).alias("duplicates"), F.max("question_number").alias("last"), F.collect_set("question_number").alias("present"))
    missing = F.when(F.col("last") >= 1, F.array_except(F.sequence(F.lit(1), "last"), "present")).otherwise(F.array().cast("array<int>"))
    return by_doc.select("doc_id", "duplicates", missing.alias("missing"))
