"""Where the lines stand that an item was made of: its block in its window, its question, options and answer.

Items meet the lines of their own number's window by a join on document and number, so
a span can't leave the window.  A window's lines are one sorted array; the block begins at the item's
anchor and ends at the next, and a ladder of matchers picks the lines: the whole stem holds
the question, the anchor's line and the question hold one another, or the line
begins like it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliate.functions import patterns as P
from foliate.functions import text as T
from foliate.operators.status import in_evidence, matchable

#: Characters of a question that must be found, of a line that may hold its number; stem lines without options; options of a block.
SNIPPET, NUMBER_WITHIN, STEM_LINES, BLOCK_OPTIONS = 80, 40, 3, 4
_NONE = "array<int>"


def _number(raw: Column) -> Column:
    bare = T.strip(raw)
    return F.coalesce(F.when(T.has(bare, P.BLOCK_ANCHOR), T.part(bare, P.BLOCK_ANCHOR)), F.when(T.has(bare, P.BOLD_ANCHOR), T.part(bare, P.BOLD_ANCHOR))).cast("int")


def _numbers(raw: Column) -> Column:
    """All numbers that stand where a question's may."""
    near = F.substring(T.strip(raw), 1, NUMBER_WITHIN)
    inline = F.when(T.has(raw, P.BOLD_ANCHOR), T.part(raw, P.BOLD_ANCHOR))
    return F.array_compact(F.array(*(F.when(T.has(near, p), T.part(near, p)) for p in P.NUMBER_PLACES), inline))


def window_blocks(told: DataFrame) -> DataFrame:
    """(doc_id, question_number, lines): the read lines of each window in order, with what is matched; of repeated numbers the first is an anchor."""
    rows = told.select("doc_id", "question_number", F.struct("line_number", "raw", matchable(F.col("raw")).alias("m"), _number(F.col("raw")).alias("number"), _numbers(F.col("raw")).alias("numbers"), "options").alias("x"))
    by = rows.groupBy("doc_id", "question_number").agg(F.sort_array(F.collect_list("x")).alias("lines"))
    first = lambda x, i: F.when(F.array_position(F.transform("lines", lambda y: y["number"]), x["number"]) == i + 1, x["number"])
    anchored = F.transform("lines", lambda x, i: F.struct(x["line_number"].alias("line"), x["raw"].alias("raw"), x["m"].alias("m"), first(x, i).alias("anchor"), x["numbers"].alias("numbers"), x["options"].alias("options")))
    return by.select("doc_id", "question_number", anchored.alias("lines"))


def _first(lines: Column, holds) -> Column:
    return F.array_min(F.transform(F.filter(lines, holds), lambda x: x["line"]))


def resolve_spans(items: DataFrame, told: DataFrame, answers: DataFrame | None = None) -> DataFrame:
    """``items`` with anchor_line, matched_by, question_lines, option_lines, foreign_options, open_options and, with ``answers``, answer_span.

    ``items`` are (doc_id, question_number, question_text_raw, options of key, text and start_line); ``told``
    the :func:`families.read_lines` of all windows; ``answers`` (doc_id, question_number, line_number).
    matched_by is block, anchor, snippet or none.  option_lines has (key, line) for
    each option: its own line if that is in the window, else the block's option
    of its key or, without a key, with its text.  An option whose own line lies
    in no line of the window loses it and is named in foreign_options; what
    has no line else is counted in open_options.  Items without a window or a text match nothing.
    """
    q = matchable(F.coalesce("question_text_raw", F.lit("")))
    out = items.join(window_blocks(told), ["doc_id", "question_number"], "left").withColumn("_q", q).withColumn("_snip", F.substring("_q", 1, SNIPPET))
    number, begins = F.col("question_number"), lambda x: (F.col("_snip") != "") & x["m"].contains(F.col("_snip"))
    anchor = F.coalesce(_first("lines", lambda x: x["anchor"] == number), _first("lines", lambda x: F.array_contains(x["numbers"], number.cast("string"))), _first("lines", begins))
    out = out.withColumn("anchor_line", anchor)
    out = out.withColumn("_next", _first("lines", lambda x: x["anchor"].isNotNull() & (x["line"] > F.col("anchor_line"))))
    out = out.withColumn("_block", F.filter("lines", lambda x: (x["line"] >= F.col("anchor_line")) & (F.col("_next").isNull() | (x["line"] < F.col("_next")))))
    out = out.withColumn("_opt", _first("_block", lambda x: F.size(x["options"]) > 0))
    out = out.withColumn("_stem", F.when(F.col("_opt").isNull(), F.slice("_block", 1, STEM_LINES)).otherwise(F.filter("_block", lambda x: x["line"] < F.col("_opt"))))
    out = out.withColumns({"_said": F.array_join(F.transform("_stem", lambda x: x["m"]), " "), "_head": F.get("_stem", F.lit(0))})
    head, asked = F.col("_head.m"), F.col("_q") != ""
    numbered = number.isNull() | F.array_contains(F.col("_head.numbers"), number.cast("string"))
    backed = in_evidence(F.array(F.coalesce("question_text_raw", F.lit(""))), head, F.array(head))
    by = F.when(asked & F.col("_said").contains(F.col("_q")), "block").when(asked & (head.contains(F.col("_q")) | F.col("_q").contains(head)), "anchor").when(asked & head.contains(F.col("_snip")) & numbered & backed, "snippet").otherwise("none")
    out = out.withColumn("matched_by", by)
    mine = F.when(F.col("matched_by") == "block", F.transform("_stem", lambda x: x["line"])).when(F.col("matched_by") != "none", F.array("_head.line")).otherwise(F.array().cast(_NONE))
    shown = F.flatten(F.transform("_block", lambda x: F.transform(x["options"], lambda o: F.struct(o["key"].alias("key"), matchable(o["text"]).alias("m"), x["line"].alias("line")))))
    out = out.withColumns({"question_lines": mine, "_shown": F.coalesce(shown, F.array().cast("array<struct<key:string,m:string,line:int>>")), "_own": F.coalesce(F.transform("lines", lambda x: x["line"]), F.array().cast(_NONE))})
    once = F.filter("_shown", lambda o, i: F.array_position(F.transform("_shown", lambda y: y["key"]), o["key"]) == i + 1)
    out = out.withColumn("_shown", F.slice(once, 1, BLOCK_OPTIONS))
    keyless = lambda o: F.coalesce(T.strip(o["key"]), F.lit("")) == ""
    text = lambda o: matchable(F.coalesce(o["text"], F.lit("")))
    fits = lambda o: F.filter("_shown", lambda e: F.when(keyless(o), (text(o) != "") & e["m"].contains(text(o))).otherwise(e["key"] == F.upper(o["key"])))
    inside = lambda o: F.array_contains("_own", o["start_line"])
    line = lambda o: F.when(o["start_line"].isNull(), F.get(fits(o), F.lit(0))["line"]).when(inside(o), o["start_line"])
    options = F.coalesce("options", F.array().cast(items.schema["options"].dataType))
    out = out.withColumn("option_lines", F.transform(options, lambda o: F.struct(o["key"].alias("key"), line(o).alias("line"), (o["start_line"].isNotNull() & ~inside(o)).alias("foreign"))))
    foreign = F.transform(F.filter("option_lines", lambda o: o["foreign"]), lambda o: F.coalesce(o["key"], F.lit("")))
    missing = F.size(F.filter("option_lines", lambda o: o["line"].isNull() & ~o["foreign"])).cast("long")
    out = out.withColumns({"foreign_options": foreign, "open_options": missing})
    if answers is not None:
        first = answers.groupBy("doc_id", "question_number").agg(F.min("line_number").alias("answer_span"))
        out = out.join(first, ["doc_id", "question_number"], "left")
    return out.drop("lines", "_q", "_snip", "_next", "_block", "_opt", "_stem", "_said", "_head", "_shown", "_own")
