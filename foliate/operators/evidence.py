"""Evidence of two engines: duplicates by similarity, merging, recovered options, chunks of bounded size."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliate.functions import text as T

SIMILAR = 0.92
#: Groups of letters whose counts bound the similarity of two lines.
LETTERS = ("aeiou",)
ANCHOR_DISTANCE = 5
CHUNK_LINES = 120
# --- fixed values: options that lost their text, and lines that hold one ----------------------
BLANK_OPTION = r"^(?:\d+\s*[\.\)]\s*|[A-Da-d]\s*[\.\)]\s*|Ans\.?)$"
NUMBERED_TEXT = r"^(\d+)\s*[\.\)]\s+(.+)$"


def near_pairs(second: DataFrame, first: DataFrame) -> DataFrame:
    """(doc_id, line_id, t, u): lines of the second engine with those of the first on their page that they may be nearly the same as.

    Lengths and counts of letters that exclude the ratio SIMILAR exclude a pair; they are counted once a line.
    """
    size = lambda c: F.char_length(c)
    bags = lambda c: [(size(c) - size(F.translate(c, group, ""))) for group in LETTERS]
    own = second.select("doc_id", "line_id", "page_number", F.lower(F.trim(F.coalesce("text", F.lit("")))).alias("t")).where("t <> ''")
    other = first.select(F.col("doc_id").alias("d"), F.col("page_number").alias("p"), F.lower(F.trim(F.coalesce("text", F.lit("")))).alias("u")).where("u <> ''").distinct()
    own = own.select("*", size("t").alias("a"), *(n.alias(f"a{k}") for k, n in enumerate(bags(F.col("t")))))
    other = other.select("*", size("u").alias("b"), *(n.alias(f"b{k}") for k, n in enumerate(bags(F.col("u")))))
    named = lambda c: [F.col(f"{c}{k}") for k in range(len(LETTERS))]
    rest = lambda c: F.col(c) - sum(named(c)[1:], named(c)[0])
    shared = sum((F.least(x, y) for x, y in zip(named("a"), named("b"), strict=True)), F.least(rest("a"), rest("b")))
    both = F.col("a") + F.col("b")
    least = SIMILAR * both - 1e-6  # what rounding might exclude is left to the comparison
    possible = (F.least("a", "b") * 2.0 >= least) & (shared * 2.0 >= least)
    equal_page = own.join(other.where("p is not null"), (F.col("doc_id") == F.col("d")) & (F.col("page_number") == F.col("p")) & possible)
    any_page = own.join(other.where("p is null"), (F.col("doc_id") == F.col("d")) & possible)
    return equal_page.unionByName(any_page).select("doc_id", "line_id", "t", "u")


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines with a similar text; a line is asked no more once it has one, of equal texts and equal beginnings first."""
    for batch in batches:
        rows = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
        found = {(d, line) for d, line, t, u in rows if t == u}
        bags: dict[str, Counter] = {}
        for d, line, t, u in sorted((r for r in rows if r[:2] not in found), key=lambda r: r[2][:8] != r[3][:8]):
            if (d, line) in found:
                continue
            for text in (t, u):
                if text not in bags:
                    bags[text] = Counter(text)
            # the bound of quick_ratio, without a matcher
            if 2.0 * (bags[t] & bags[u]).total() / (len(t) + len(u)) >= SIMILAR and SequenceMatcher(None, t, u).ratio() >= SIMILAR:
                found.add((d, line))
        yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in found], pa.int64()), pa.array([line for _, line in found], pa.string())], ["doc_id", "line_id"])


def duplicates(second: DataFrame, first: DataFrame) -> DataFrame:
    """Lines of the second engine, each with whether a line of the first on its page is nearly the same.

    Both have doc_id, line_id, page_number and text.  A page of null in ``first``
    matches any page.  Empty lines are duplicates.  Lines are similar when the
    ratio of matching blocks is at least SIMILAR; only the :func:`near_pairs` are compared.
    """
    same = near_pairs(second, first).mapInArrow(_similar, "doc_id long, line_id string").distinct().withColumn("same", F.lit(True))
    empty = F.trim(F.coalesce("text", F.lit(""))) == ""
    return second.select("doc_id", "line_id", empty.alias("empty")).join(same, ["doc_id", "line_id"], "left").select("doc_id", "line_id", (F.col("same").isNotNull() | F.col("empty")).alias("duplicate"))


def merged(first: DataFrame, second: DataFrame) -> DataFrame:
    """All lines of the first engine and those of the second that it doesn't have."""
    fresh = second.join(duplicates(second, first).where("not duplicate"), ["doc_id", "line_id"], "left_semi")
    return first.withColumn("engine", F.lit("first")).unionByName(fresh.withColumn("engine", F.lit("second")))


def recovered_options(first: DataFrame, second: DataFrame) -> DataFrame:
    """(doc_id, line_id, option_line, option_text): for each option of ``first`` without a text the line of ``second`` that it gets.

    ``first`` has (doc_id, line_id, page_number, place, text), ``second`` (doc_id, line_id, page_number, place, text,
    confidence, is_option).  In the order of their places each blank option takes the surest line of its page
    that no other has taken, the first of equals; one without a page takes a line of any.  A line offers the
    text after its number or, if it is known as an option, all of it.  A document's
    blanks are one fold, as what is taken is carried along; null where nothing is left.
    """
    bare = T.strip(F.coalesce("text", F.lit("")))
    blanks = first.where(T.has(bare, BLANK_OPTION)).groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("place", "line_id", "page_number"))).alias("blanks"))
    told = F.when(T.has(bare, NUMBERED_TEXT), T.strip(T.part(bare, NUMBERED_TEXT, 2))).when(F.col("is_option"), bare)
    offers = second.select("doc_id", "line_id", "page_number", "place", "confidence", told.alias("said")).where("said <> ''")
    offers = offers.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct((-F.col("confidence")).alias("order"), "place", "line_id", "page_number", "said"))).alias("offers"))
    both = blanks.join(offers, "doc_id", "left")
    start = F.struct(F.array().cast("array<string>").alias("used"), F.array().cast("array<struct<line_id:string,option_line:string,option_text:string>>").alias("found"))

    def step(state: Column, blank: Column) -> Column:
        free = F.filter("offers", lambda o: (blank["page_number"].isNull() | (o["page_number"] == blank["page_number"])) & ~F.array_contains(state["used"], o["line_id"]))
        best = F.get(free, F.lit(0))
        got = F.struct(blank["line_id"].alias("line_id"), best["line_id"].alias("option_line"), best["said"].alias("option_text"))
        return F.struct(F.when(best.isNotNull(), F.array_append(state["used"], best["line_id"])).otherwise(state["used"]).alias("used"), F.array_append(state["found"], got).alias("found"))

    return both.select("doc_id", F.explode(F.aggregate("blanks", start, step)["found"]).alias("f")).select("doc_id", "f.*")


def accepted(places: Column, distance: int = ANCHOR_DISTANCE, at=lambda x: x) -> Column:
    """Of ascending places, the first and every one at least ``distance`` after the last accepted; ``at`` tells where a place is."""
    start = F.struct(F.slice(places, 1, 0).alias("kept"), F.lit(None).cast("int").alias("last"))

    def step(acc: Column, x: Column) -> Column:
        take = acc["last"].isNull() | (at(x) - acc["last"] >= distance)
        return F.struct(F.when(take, F.array_append(acc["kept"], x)).otherwise(acc["kept"]).alias("kept"), F.when(take, at(x)).otherwise(acc["last"]).alias("last"))

    return F.aggregate(places, start, step, lambda acc: acc["kept"])


def chunk_windows(wins: DataFrame, most: int = CHUNK_LINES) -> DataFrame:
    """(doc_id, chunk_index, window_id, start_line, n_lines): windows packed in order into chunks of at most ``most`` lines; a longer window stands alone.

    The sum starts anew with each chunk, so it is folded over each document's windows.
    """
    ordered = wins.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("start_line", "window_id", "n_lines"))).alias("w"))
    start = F.struct(F.array().cast("array<int>").alias("ids"), F.lit(0).alias("chunk"), F.lit(0).cast("long").alias("size"))

    def step(acc: Column, x: Column) -> Column:
        fits = (acc["size"] == 0) | (acc["size"] + x["n_lines"] <= most)
        chunk = F.when(fits, acc["chunk"]).otherwise(acc["chunk"] + 1)
        return F.struct(F.array_append(acc["ids"], chunk).alias("ids"), chunk.alias("chunk"), F.when(fits, acc["size"] + x["n_lines"]).otherwise(x["n_lines"]).alias("size"))

    placed = ordered.withColumn("ids", F.aggregate("w", start, step, lambda acc: acc["ids"])).select("doc_id", F.explode(F.arrays_zip("w", "ids")).alias("z"))
    return placed.select("doc_id", F.col("z.ids").alias("chunk_index"), *(F.col(f"z.w.{c}").alias(c) for c in ("window_id", "start_line", "n_lines")))


def chunks(wins: DataFrame, most: int = CHUNK_LINES) -> DataFrame:
    """What each chunk of :func:`chunk_windows` holds."""
    return chunk_windows(wins, most).groupBy("doc_id", "chunk_index").agg(F.count(F.lit(1)).alias("windows"), F.sum("n_lines").alias("n_lines"), F.min("window_id").alias("first_window"), F.max("window_id").alias("last_window"))


def ranges(numbers: DataFrame) -> DataFrame:
    """Runs of consecutive numbers by document: first, last and how many."""
    distinct = numbers.select("doc_id", "number").where("number is not null").distinct()
    island = F.col("number") - F.row_number().over(W.partitionBy("doc_id").orderBy("number"))
    return distinct.withColumn("island", island).groupBy("doc_id", "island").agg(F.min("number").alias("first"), F.max("number").alias("last"), F.count(F.lit(1)).alias("n")).drop("island")
