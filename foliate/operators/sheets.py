"""Response sheets: options in cells near a question, what a candidate chose, and items filled from both.

Every line is read once: its options, the questions it may begin and the choice it
states.  A question meets its few lines by their places, so the join is on equal keys
and no line meets a question that is not near.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliate.functions import markers
from foliate.functions import text as T
from foliate.operators.detect import NUMERIC_OPTION, PAREN_OPTION, SEVERAL_OPTIONS

# --- fixed values: marks of cells and questions, lines read from a question on, options of one item ---
NUMBERED = r"\d+\s*[\.\)]"
ANSWER_CELL = r"(?i)\bAns\b"
BEGINS = r"^\*?\*?([0-9]+)\s*[\.\)]"
NAMED = r"(?i)\bQ\.?\s*([0-9]+)\b"
CHOICE_OF = r"^\*?\*?(\d+)\."
NEAR, MOST_OPTIONS = 8, 4
_READ = "array<struct<key:string,text:string>>"
_BOUND = "array<struct<key:string,text:string,line:int>>"


def _valid(key: Column, text: Column) -> Column:
    """(key, text) of an option 1 to 4 that has a text, else null."""
    said = T.strip(text)
    return F.when(key.rlike("^[1-4]$") & (said != ""), F.struct(key.alias("key"), said.alias("text")))


def _single(text: Column) -> Column:
    bare = T.strip(F.regexp_replace(text, r"(?i)<br\s*/?>", "\n"))
    return F.coalesce(*(F.when(T.has(bare, p), _valid(T.part(bare, p), T.part(bare, p, 2))) for p in (NUMERIC_OPTION, PAREN_OPTION)))


def _firsts(options: Column) -> Column:
    """The first option of each key, by key."""
    once = F.filter(options, lambda o, i: F.array_position(F.transform(options, lambda x: x["key"]), o["key"]) == i + 1)
    return F.sort_array(once)


def sheet_lines(lines: DataFrame) -> DataFrame:
    """``lines`` with ``options`` (key 1 to 4, text), those of a row or an answer's line of a response sheet; of others none.

    Of a table's row the first numbered cell that is no answer's is read, of one without
    such a cell all.  Null and empty lines have none.
    """
    raw = F.coalesce("raw", F.lit(""))
    bare, numbered = T.strip(raw), T.has(raw, NUMBERED)
    cells = F.filter(F.transform(F.split(raw, r"\|", -1), T.strip), lambda c: c != "")
    first = F.get(F.filter(cells, lambda c: T.has(c, NUMBERED) & ~T.has(c, ANSWER_CELL)), F.lit(0))
    cell = F.when(raw.contains("|"), F.coalesce(first, F.array_join(cells, " "))).otherwise(raw)
    own = [c for c in lines.columns if c != "options"]
    out = lines.withColumn("_cell", F.when(numbered & (bare.startswith("|") | F.lower(raw).contains("ans")), cell).otherwise(""))
    out = out.withColumn("_t", T.strip(F.regexp_replace("_cell", r"(?i)<br\s*/?>", "\n")))
    every = lambda g: F.regexp_extract_all("_t", F.lit(T.uni(SEVERAL_OPTIONS)), F.lit(g))
    out = out.withColumn("_many", F.array_compact(F.transform(F.arrays_zip(every(1).alias("k"), every(2).alias("t")), lambda z: _valid(z["k"], z["t"]))))
    parts = F.array_compact(F.transform(F.split("_cell", r"[\n|]+", -1), _single))
    out = out.withColumn("_read", F.when(F.size("_many") > 0, F.col("_many")).when(_single(F.col("_cell")).isNotNull(), F.array(_single(F.col("_cell")))).otherwise(parts))
    return out.select(*own, _firsts(F.col("_read")).cast(_READ).alias("options"))


def near_options(lines: DataFrame, questions: DataFrame, by: tuple[str, ...] = ("doc_id",), near: int = NEAR) -> DataFrame:
    """(by, question_number, anchor_line, near): the options in the line that begins a question and the ``near`` - 1 after it.

    ``lines`` are (by, line_number, raw); ``questions`` (by, question_number), repeats and nulls allowed.
    ``by`` names the scope whose lines belong together, a document or a window of one.  A question
    begins at the first line that its number begins or that names it.  ``near`` has (key, text, line), the
    first option of each key.  Numbers that no line begins, and those without options, have no row.
    """
    keys = list(by)
    placed = sheet_lines(lines.select(*keys, "line_number", "raw")).withColumn("place", F.row_number().over(W.partitionBy(*keys).orderBy("line_number")))
    bare = T.strip(F.coalesce("raw", F.lit("")))
    numbers = F.concat(F.when(T.has(bare, BEGINS), F.array(T.part(bare, BEGINS))).otherwise(F.array().cast("array<string>")), F.regexp_extract_all(bare, F.lit(T.uni(NAMED)), F.lit(1)))
    found = placed.select(*keys, "line_number", "place", F.explode(F.array_distinct(numbers)).alias("n")).withColumn("question_number", F.col("n").try_cast("int"))
    found = found.where(F.col("question_number").cast("string") == F.col("n")).join(questions.select(*keys, "question_number").distinct(), [*keys, "question_number"], "left_semi")
    anchors = found.groupBy(*keys, "question_number").agg(F.min_by(F.struct("line_number", "place"), "place").alias("a"))
    wanted = anchors.select(*keys, "question_number", F.col("a.line_number").alias("anchor_line"), F.explode(F.transform(F.sequence(F.lit(0), F.lit(near - 1)), lambda i: F.col("a.place") + i)).alias("place"))
    told = wanted.join(placed.where(F.size("options") > 0).select(*keys, "place", "line_number", "options"), [*keys, "place"])
    flat = told.select(*keys, "question_number", "anchor_line", F.col("line_number").alias("line"), F.explode("options").alias("o"))
    once = flat.groupBy(*keys, "question_number", "anchor_line", F.col("o.key").alias("key")).agg(F.min_by(F.struct(F.col("o.text").alias("text"), "line"), "line").alias("first"))
    return once.groupBy(*keys, "question_number", "anchor_line").agg(F.sort_array(F.collect_list(F.struct("key", F.col("first.text").alias("text"), F.col("first.line").cast("int").alias("line")))).alias("near"))


def chosen_options(lines: DataFrame) -> DataFrame:
    """(doc_id, question_number, chosen_label, chosen_key, chosen_line): the last choice stated after each question's number.

    chosen_label is the digit or letter as stated, chosen_key A to D.  Lines before the first number
    and those that state no option count for nothing.
    """
    raw = F.coalesce("raw", F.lit(""))
    bare, said = T.strip(raw), T.strip(T.part(raw, markers.CHOSEN))
    label = F.when(said.rlike("^[0-9]+$"), said).when((F.char_length(said) == 1) & ~said.isin(*markers.NO_CHOICE), F.upper(said))
    read = lines.select("doc_id", "line_number", F.when(T.has(bare, CHOICE_OF), T.part(bare, CHOICE_OF)).try_cast("int").alias("n"), F.when(F.lower(raw).contains("chosen option"), label).alias("label"))
    order = W.partitionBy("doc_id").orderBy("line_number").rowsBetween(W.unboundedPreceding, 0)
    stated = read.withColumn("question_number", F.last("n", ignorenulls=True).over(order)).where("label is not null and question_number is not null")
    last = stated.groupBy("doc_id", "question_number").agg(F.max_by(F.struct("label", "line_number"), "line_number").alias("c"))
    key = F.translate(F.col("c.label"), *markers.DIGIT_KEYS)
    return last.select("doc_id", "question_number", F.col("c.label").alias("chosen_label"), F.when(key.rlike("^[A-D]$"), key).alias("chosen_key"), F.col("c.line_number").alias("chosen_line"))


def bind_options(items: DataFrame, found: DataFrame, by: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``items`` with options (key, text, line) filled from :func:`near_options`, and ``n_filled``, how many changed.

    ``items`` have (by, question_number, options of key, text and start_line).  One without options gets the first four.
    An option without key or text takes the sheet's option of its key, or without a key that whose
    text it holds; else, if it has no text, the first whose key no option of the item has by then.  That is a
    fold over the item's options, as what is taken counts for the next.  Whole options, items without a number and
    those that no sheet tells of stay.
    """
    keys = [*by, "question_number"]
    none = F.array().cast(_BOUND)
    have = F.coalesce(F.transform("options", lambda o: F.struct(o["key"].alias("key"), o["text"].alias("text"), o["start_line"].cast("int").alias("line"))), none).cast(_BOUND)
    out = items.withColumn("options", have).join(found.select(*keys, F.col("near").cast(_BOUND).alias("_near")), keys, "left").withColumn("_near", F.coalesce("_near", none))
    said = lambda c: T.strip(F.coalesce(c, F.lit("")))
    start = F.struct(F.transform("options", lambda o: said(o["key"])).alias("keys"), none.alias("done"), F.lit(0).alias("filled"))

    def step(state: Column, option: Column) -> Column:
        key, text = said(option["key"]), F.coalesce(option["text"], F.lit(""))
        bare, open_ = F.regexp_replace(key, r"\.+$", ""), (key == "") | (said(option["text"]) == "")
        same = F.filter("_near", lambda n: (bare == n["key"]) | ((bare == "") & text.contains(n["text"])))
        fresh = F.filter("_near", lambda n: ~F.array_contains(state["keys"], n["key"]))
        pick = F.when(open_, F.coalesce(F.get(same, F.lit(0)), F.when(said(option["text"]) == "", F.get(fresh, F.lit(0)))))
        now = F.struct(F.coalesce(pick["key"], option["key"]).alias("key"), F.coalesce(pick["text"], option["text"]).alias("text"), F.coalesce(option["line"], pick["line"]).alias("line"))
        at = F.size(state["done"])
        taken = F.transform(state["keys"], lambda k, i: F.when((i == at) & pick.isNotNull(), pick["key"]).otherwise(k))
        return F.struct(taken.alias("keys"), F.concat(state["done"], F.array(now)).alias("done"), (state["filled"] + pick.isNotNull().cast("int")).alias("filled"))

    out = out.withColumn("_bound", F.aggregate("options", start, step))
    whole = F.slice("_near", 1, MOST_OPTIONS)
    empty = F.size("options") == 0
    return out.withColumns({"n_filled": F.when(empty, F.size(whole)).otherwise(F.col("_bound.filled")), "options": F.when(empty, whole).otherwise(F.col("_bound.done"))}).drop("_near", "_bound")
