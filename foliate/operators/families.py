"""Options and stems inside the lines of a question's window.

A line is read once by every family of markers; each gives (rank, key, raw, text)
entries, and the first family in rank that has any decides.  Ranks replace nested
conditions: every step is a column of its own, so plans stay flat and nothing is evaluated
twice, and a line's entries never leave its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliate.functions import patterns as P
from foliate.functions import text as T
from foliate.operators.detect import NUMERIC_OPTION, PAREN_OPTION

#: Options of one line and one window at most, and the characters around an image that make it more.
MOST_IN_ROW, MOST_OPTIONS, IMAGE_ALONE = 4, 5, 20
#: Ranks of the families, in the order in which they are asked.
PIPE_TABLE, MATHSF, WIDE_ROW, MARKED, ONE, ROW, LAST, DELIMITED, NUMBERED, NUMERIC = 10, 20, 30, 41, 50, 60, 71, 80, 91, 93
_ENTRY = "array<struct<rank:int,key:string,raw:string,text:string>>"


def _entry(rank: Column | int, key: Column, raw: Column, text: Column) -> Column:
    return F.struct(F.lit(rank).cast("int").alias("rank") if isinstance(rank, int) else rank.cast("int").alias("rank"), key.alias("key"), raw.alias("raw"), text.alias("text"))


def _none() -> Column:
    return F.array().cast(_ENTRY)


def _numeric_key(raw: Column) -> Column:
    return F.when(raw.rlike("^[1-4]$"), F.translate(raw, "1234", "ABCD"))


def _several(text: Column, pattern: str, rank: Column | int, asked: Column, key=F.upper) -> Column:
    """The entries of ``pattern``, which only texts that are ``asked`` may have."""
    # looking ahead for the next marker at every character is dear, so it is done once and not for each group
    alone = f"^{pattern.split('(?=')[0].removesuffix('+?)')}+)$"
    found = F.regexp_extract_all(text, F.lit(T.uni(pattern)), F.lit(0))
    split = F.transform(found, lambda m: F.struct(T.part(m, alone).alias("k"), T.part(m, alone, 2).alias("t")))
    return F.when(asked, F.transform(split, lambda z: _entry(rank, key(z["k"]), z["k"], T.strip(z["t"])))).otherwise(_none())


def _one(text: Column, pattern: str, rank: int, key=F.upper) -> Column:
    raw = T.part(text, pattern)
    return F.when(T.has(text, pattern), F.array(_entry(rank, key(raw), raw, T.strip(T.part(text, pattern, 2))))).otherwise(_none())


def _delimited(text: Column) -> Column:
    """What stands between labels in brackets, brackets inside it included."""
    keys = F.regexp_extract_all(text, F.lit(P.PAREN_LABEL), F.lit(1))
    pieces = F.split(text, P.PAREN_LABEL, -1)
    trimmed = lambda t: F.regexp_replace(t, r"^[ \-:;,]+|[ \-:;,]+$", "")
    return F.transform(F.arrays_zip(keys.alias("k"), F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))).alias("t")), lambda z: _entry(DELIMITED, F.upper(z["k"]), z["k"], trimmed(z["t"])))


def _row(cells: Column) -> Column:
    """A walk over the cells (cell, key) of a table's row: a cell that is a new key takes the next cell as its text."""
    start = F.struct(_none().alias("found"), F.lit(None).cast("struct<cell:string,key:string>").alias("wants"))

    def step(s: Column, c: Column) -> Column:
        taken = F.concat(s["found"], F.array(_entry(ROW, s["wants"]["key"], s["wants"]["cell"], c["cell"])))
        fresh = c["key"].isNotNull() & ~F.exists(s["found"], lambda o: o["key"] == c["key"])
        return F.when(s["wants"].isNotNull(), F.struct(taken.alias("found"), F.lit(None).cast("struct<cell:string,key:string>").alias("wants"))).otherwise(F.struct(s["found"].alias("found"), F.when(fresh, c).alias("wants")))

    return F.slice(F.aggregate(cells, start, step)["found"], 1, MOST_IN_ROW)


def _first_of_each(entries: Column) -> Column:
    """The first entry of each key, in order."""
    add = lambda found, o: F.when(F.exists(found, lambda x: x["key"] == o["key"]), found).otherwise(F.concat(found, F.array(o)))
    return F.aggregate(entries, _none(), add)


def _normal(text: Column) -> Column:
    return T.strip(F.regexp_replace(T.strip(text), T.uni(P.LINE_BULLET), ""))


def _looks_anchored(text: Column) -> Column:
    return ~T.has(text, P.BOLD_OPTION_LINE) & T.has(text, P.ANCHOR_LOOK)


def line_options(lines: DataFrame, text: str = "raw", anchor: Column | None = None) -> DataFrame:
    """``lines`` with ``options``, an array of (key, raw, text) with keys A to E, each once, in the line's order.

    ``anchor`` tells the lines at which a question begins: of these, and of lines that look like
    one, only what follows the number is read, and only if it holds a marker.  Null texts have no options.
    """
    own = lines.columns
    out = lines.withColumn("_n", _normal(F.coalesce(F.col(text), F.lit(""))))
    out = out.withColumn("_cut", (anchor if anchor is not None else F.lit(False)) | _looks_anchored(F.col("_n")))
    out = out.withColumn("_rest", F.when(F.col("_cut"), T.strip(F.regexp_replace(F.col("_n"), T.uni(P.ANCHOR_STRIP), ""))).otherwise(F.col("_n")))
    out = out.withColumn("_t", F.when(~F.col("_cut") | T.has(F.col("_rest"), P.FIRST_MARKER), _normal(F.col("_rest"))).otherwise(""))
    # what is left may look like an anchor again
    again = _looks_anchored(F.col("_t")) & ~T.has(T.strip(F.regexp_replace(F.col("_t"), T.uni(P.ANCHOR_STRIP), "")), P.FIRST_MARKER)
    out = out.withColumn("_t", F.when(~again & T.has(F.col("_t"), P.MATCHED_ANYWHERE), F.col("_t")).otherwise(""))
    t, key_line = F.col("_t"), T.is_answer_key_line(F.col("_t"))
    # what a text must have for a family of markers, so that the dear patterns are asked of few
    out = out.withColumns({"_bold": t.contains("**"), "_paren": t.contains("(") & t.rlike(P.PAREN_LABEL), "_dot": T.has(t, P.DOT_LABEL), "_digit": T.has(t, P.NUMBER_LABEL), "_bar": t.contains("|")})
    bold, paren, dot, bar = F.col("_bold"), F.col("_paren"), F.col("_dot"), F.col("_bar")
    labels = sum((F.when(asked, F.regexp_count(t, F.lit(T.uni(p)))).otherwise(0) for p, asked in zip(P.EXPLICIT_LABELS, (bold, paren, paren, dot), strict=True)), F.lit(0))
    cells = F.filter(F.transform(F.split(t, r"\|", -1), T.strip), lambda c: c != "")
    bare = T.strip(F.regexp_replace(T.strip(F.regexp_replace(t, "(?i)</?b>", "")), r"^\|+|\|+$", ""))
    out = out.withColumns({"_labels": labels, "_bare": bare, "_key_line": key_line, "_cells": F.when(bar, F.transform(cells, lambda c: F.struct(c.alias("cell"), T.option_key(c).alias("key"))))})
    out = out.withColumn("_row", F.when(F.size("_cells") >= 2, _row(F.col("_cells"))).otherwise(_none()))
    wide = (F.size(F.split(t, r"\|", -1)) > 3) & (F.size("_row") >= 2)
    row = F.transform("_row", lambda o: _entry(F.when(wide, WIDE_ROW).otherwise(ROW), o["key"], o["raw"], o["text"]))
    bare = F.col("_bare")
    table = F.when(bar & ~T.part(t, P.PIPE_TABLE_OPTION, 2).startswith("-"), _one(t, P.PIPE_TABLE_OPTION, PIPE_TABLE)).otherwise(_none())
    mathsf = F.when(t.contains("\\") & T.has(t, P.MATHSF_OPTION), F.array(_entry(MATHSF, F.upper(T.part(t, P.MATHSF_OPTION)), T.part(t, P.MATHSF_OPTION), t))).otherwise(_none())
    marked = [_several(t, p, F.when(F.col("_labels") > 1, MARKED + k).otherwise(LAST + k), asked) for k, (p, asked) in enumerate(zip(P.SEVERAL, (paren, bold, bold, paren, dot), strict=True))]
    single = [_one(bare, p, ONE + k) for k, p in enumerate(P.SINGLE)]
    early = F.concat(table, mathsf, row, *marked, *single, F.when(bar, _one(t, P.TABLE_OPTION, ONE + len(P.SINGLE), T.option_key)).otherwise(_none()))
    numeric = F.concat(*(_one(t, p, NUMERIC, _numeric_key) for p in (NUMERIC_OPTION, PAREN_OPTION)))
    late = F.concat(F.when(paren, _delimited(t)).otherwise(_none()), _several(t, P.SEVERAL_NUMERIC, NUMBERED, F.col("_digit"), _numeric_key), F.when(~t.rlike(r"(?i)<br\s*/?>"), numeric).otherwise(_none()))
    out = out.withColumn("_all", F.when(t == "", _none()).when(F.col("_key_line"), late).otherwise(F.concat(early, late)))
    out = out.withColumn("_all", F.filter("_all", lambda o: o["key"].isNotNull() & (o["text"] != "")))
    out = out.withColumn("_rank", F.array_min(F.transform("_all", lambda o: o["rank"])))
    of = lambda rank: _first_of_each(F.filter("_all", lambda o: o["rank"] == rank))
    out = out.withColumns({"_mine": of(F.col("_rank")), "_delimited": of(F.lit(DELIMITED))})
    best = F.when((F.col("_rank") < DELIMITED) & (F.size("_delimited") > F.size("_mine")), F.col("_delimited")).otherwise(F.col("_mine"))
    options = F.transform(F.coalesce(best, _none()), lambda o: F.struct(o["key"].alias("key"), o["raw"].alias("raw"), o["text"].alias("text")))
    return out.select(*(c for c in own if c != "options"), options.alias("options"))


def stem_of(text: Column, anchor: Column) -> Column:
    """What a line says before its first marker; of an anchor without its number."""
    bare = T.strip(text)
    bare = F.when(anchor, T.strip(F.regexp_replace(bare, T.uni(P.ANCHOR_STRIP), ""))).otherwise(bare)
    return T.strip(F.split(bare, T.uni(P.FIRST_MARKER), 2)[0])


def read_lines(lines: DataFrame) -> DataFrame:
    """Those of ``lines`` (doc_id, question_number, line_number, raw, is_anchor, is_option_line) that say something, with their ``options``.

    Blank lines, noise, rows of answer keys and lone images say nothing.
    """
    raw = T.strip(F.coalesce(F.col("raw"), F.lit("")))
    without = T.strip(F.regexp_replace(raw, P.IMAGE_REF, ""))
    lone = raw.contains("![") & raw.rlike(P.IMAGE_REF) & (F.char_length(without) < IMAGE_ALONE)
    noise = T.has(raw, P.NOISE_GUARD) & T.has(raw, P.OPTION_NOISE)
    says = lines.where((raw != "") & ~noise & ~T.is_answer_key_line(raw) & ~lone)
    return line_options(says, anchor=F.col("is_anchor"))


def window_options(told: DataFrame) -> DataFrame:
    """(doc_id, question_number, options, stem) of each window, from the :func:`read_lines` of all.

    Option lines are read before the others, and the first option of a
    key counts; at most MOST_OPTIONS stay, by key.  A line without options adds
    what stands before its first marker to the stem.
    """
    says = F.when(F.col("is_anchor") | (F.size("options") == 0), stem_of(F.col("raw"), F.col("is_anchor"))).otherwise("")
    by = told.groupBy("doc_id", "question_number").agg(F.sort_array(F.collect_list(F.struct((~F.col("is_option_line")).alias("later"), "line_number", "options", says.alias("stem")))).alias("lines"))
    add = lambda found, o: F.when(F.exists(found, lambda x: x["key"] == o["key"]), found).otherwise(F.concat(found, F.array(o)))
    every = F.aggregate(F.flatten(F.transform("lines", lambda x: x["options"])), F.array().cast("array<struct<key:string,raw:string,text:string>>"), add)
    stem = F.array_join(F.filter(F.transform("lines", lambda x: x["stem"]), lambda s: s != ""), " ")
    return by.select("doc_id", "question_number", F.slice(F.sort_array(every), 1, MOST_OPTIONS).alias("options"), stem.alias("stem"))
