"""Line deduplication over content-defined chunks of lines, with DataFrame functions only.

A line ends a chunk where the rolling hash over its hash and that of the line
before it begins with a hex digit below 8, so boundaries move with the lines and
not with their numbers.  A line of over MOST_WORDS words is a passage itself and makes a
chunk alone.  Such chunks and those of several lines that occur more than once in the
corpus are grouped by hash and bytes; all but the first occurrence go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WINDOW_LINES = 2
MIN_LINES = 2
BREAK_BELOW = "8"  # of the rolling hash's first hex digit: half of all lines end a chunk
_PLACES = 1_000_000_000
MOST_WORDS = 50  # of a run of lines that may be repeated
LONG_WORD = 16  # characters: longer words, as in scripts without blanks, count as several


def _run(begin: Column, end: Column) -> Column:
    """begin .. end - 1; empty where that is empty."""
    return F.when(end > begin, F.sequence(begin, end - 1)).otherwise(F.array().cast("array<int>"))


def _rolling(hashes: Column, i: Column) -> Column:
    """The hash over the hashes of line i and the WINDOW_LINES - 1 lines before it."""
    return F.md5(F.concat(*(F.coalesce(F.get(hashes, i - k), F.lit("")) for k in range(WINDOW_LINES - 1, -1, -1))))


def _words(line: Column) -> Column:
    """How many words a line has, or would have if LONG_WORD characters were the longest."""
    return F.greatest(F.regexp_count(line, F.lit(r"\S+")), F.ceil(F.char_length(line) / LONG_WORD)).cast("long")


def line_chunks(docs: DataFrame, text: str, alone: bool = False) -> DataFrame:
    """Add _lines, _ends (index of each chunk's last line) and _chunks (texts) to ``docs``.

    With ``alone`` lines of over MOST_WORDS words are chunks of their own.
    """
    out = docs.withColumn("_lines", F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1))
    out = out.withColumn("_hashes", F.transform("_lines", lambda x: F.md5(x)))
    # a line of more words has at least a character and a blank for each but one
    long = lambda x: (F.char_length(x) > 2 * MOST_WORDS) & (_words(x) > MOST_WORDS) if alone else F.lit(False)
    out = out.withColumn("_long", F.transform("_lines", long))
    last = F.size("_hashes") - 1
    out = out.withColumn("_ends", F.filter(F.sequence(F.lit(0), last), lambda i: (i == last) | F.get("_long", i) | F.get("_long", i + 1) | (F.substring(_rolling(F.col("_hashes"), i), 1, 1) < BREAK_BELOW)))

    def chunk(end: Column, k: Column) -> Column:
        begin = F.when(k == 0, F.lit(0)).otherwise(F.get("_ends", k - 1) + 1)
        return F.struct(F.array_join(F.transform(_run(begin, end + 1), lambda i: F.get("_lines", i)), "\n").alias("text"), (end - begin + 1).alias("lines"), F.get("_long", end).alias("long"))

    return out.withColumn("_chunks", F.transform("_ends", chunk)).drop("_hashes", "_long")


def dedup_lines(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with repeated chunks cut out of ``text``; removed_chunks and removed_lines are added (or replaced).

    Of equal chunks (at least MIN_LINES lines, not all blank, or one line of over MOST_WORDS words) the one in the
    document with the smallest key stays, the first of them within it; documents
    with a null key come last.  Keys must be whole numbers.  Chunks are equal when their bytes are.  A text
    from which nothing is cut is unchanged, null included; one that is cut whole
    becomes empty and its row stays.  Rows repeated alike are treated alike.
    Other columns pass through unchanged, whatever their names.
    """
    base = docs.select(F.struct(*(docs[c] for c in docs.columns if c != text)).alias("row"), docs[key].alias("key"), docs[text].alias("text"), F.xxhash64(docs[text]).alias("print"))
    made = line_chunks(base.select("key", "print", "text"), "text", alone=True)
    # an outer generator, so that no filter on the array's size is pushed below it and evaluates it again
    chunks = made.select("key", "print", F.posexplode_outer("_chunks").alias("pos", "chunk")).where(F.col("chunk.long") | (F.col("chunk.lines") >= MIN_LINES) & F.col("chunk.text").rlike(r"[^\s]"))
    place = F.coalesce(F.col("key").cast("decimal(28,0)"), F.lit("9223372036854775808").cast("decimal(28,0)")) * F.lit(_PLACES).cast("decimal(10,0)") + F.col("pos")
    chunks = chunks.select("key", "print", "pos", place.cast("decimal(38,0)").alias("place"), F.col("chunk.lines").alias("n"), F.md5(F.col("chunk.text")).alias("hash"), F.col("chunk.text").alias("bytes"))
    repeated = chunks.groupBy("hash", "bytes").agg(F.count(F.lit(1)).alias("times"), F.min("place").alias("first")).where("times > 1").select(F.col("hash").alias("again"), "first")
    cuts = chunks.drop("bytes").join(repeated, F.col("hash") == F.col("again")).where("place <> first")
    cuts = cuts.groupBy(F.col("key").alias("cut_key"), F.col("print").alias("cut_print")).agg(F.sort_array(F.collect_set(F.struct("pos", "n"))).alias("cuts"))
    out = base.join(cuts, F.col("key").eqNullSafe(F.col("cut_key")) & (F.col("print") == F.col("cut_print")), "left")
    new = _without(out)
    kept = [F.col("new").alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns if c not in ("removed_chunks", "removed_lines")]
    return new.select(*kept, "removed_chunks", "removed_lines")


def _without(df: DataFrame) -> DataFrame:
    """Cut the chunks in ``cuts`` from ``text``: what lies between two cuts is joined again, as ``new``."""
    cut = F.col("cuts").isNotNull()
    own = line_chunks(df.withColumn("part", F.when(cut, F.col("text"))), "part", alone=True)

    def between(k: Column) -> Column:
        low = F.when(k == 0, F.lit(0)).otherwise(F.get("cuts", k - 1)["pos"] + 1)
        high = F.when(k == F.size("cuts"), F.size("_chunks")).otherwise(F.get("cuts", k)["pos"])
        return F.transform(_run(low, high), lambda i: F.get("_chunks", i)["text"])

    kept = F.flatten(F.transform(F.sequence(F.lit(0), F.size("cuts")), between))
    lines = F.aggregate("cuts", F.lit(0), lambda a, c: a + c["n"])
    return own.select(
        "row",
        F.when(cut, F.array_join(kept, "\n")).otherwise(F.col("text")).alias("new"),
        F.when(cut, F.size("cuts")).otherwise(0).cast("long").alias("removed_chunks"),
        F.when(cut, lines).otherwise(0).cast("long").alias("removed_lines"),
    )


def _passages(docs: DataFrame) -> DataFrame:
    """(key, print, begin, end, hash) of the shortest runs of over MOST_WORDS words from and up to each line of ``docs`` (key, print, text).

    Any longer run is covered by such runs inside it.  Lines without words neither
    begin nor end a run and are passed over within.
    """
    line = F.col("line")
    # numbered before the lines are, so that repeated rows stay apart
    rows = docs.withColumn("row", F.monotonically_increasing_id()).select("row", "key", "print", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    rows = rows.where(F.col("line").rlike(r"\S")).select("row", "key", "print", "pos", F.unhex(F.sha2(line, 256)).alias("hash"), _words(line).alias("words"))
    upto = F.sum("words").over(Window.partitionBy("row").orderBy("pos"))
    rows = rows.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("words"))
    rows = rows.withColumn("n", F.row_number().over(Window.partitionBy("row").orderBy("pos")))
    ahead = Window.partitionBy("row").orderBy("before").rangeBetween(Window.unboundedPreceding, MOST_WORDS)
    back = Window.partitionBy("row").orderBy(F.col("upto").desc()).rangeBetween(Window.unboundedPreceding, MOST_WORDS)
    rows = rows.withColumns({"last": F.max("n").over(ahead), "first": F.min("n").over(back)})
    whole = rows.groupBy("row", "key", "print").agg(F.sort_array(F.collect_list(F.struct("n", "pos", "hash", "before", "upto", "last", "first"))).alias("lines"))
    at = lambda n: F.get("lines", n - 1)

    def run(begin: Column, end: Column) -> Column:
        hashes = F.transform(F.slice("lines", begin, end - begin + 1), lambda x: F.hex(x["hash"]))
        enough = at(end)["upto"] - at(begin)["before"] > MOST_WORDS
        return F.when(enough, F.struct(at(begin)["pos"].alias("begin"), at(end)["pos"].alias("end"), F.unhex(F.sha2(F.array_join(hashes, ""), 256)).alias("hash")))

    both = F.array_distinct(F.concat(F.transform("lines", lambda x: run(x["n"], x["last"])), F.transform("lines", lambda x: run(x["first"], x["n"]))))
    return whole.select("key", "print", F.explode(both).alias("run")).where("run is not null").select("key", "print", "run.*")


def _chunk_runs(docs: DataFrame) -> DataFrame:
    """(key, print, begin, end, hash) of the chunks of ``docs`` (key, print, text) that may be cut."""
    spans = F.zip_with("_ends", "_chunks", lambda e, c: F.struct((e - c["lines"] + 1).alias("begin"), e.alias("end"), F.unhex(F.sha2(F.when(c["text"].rlike(r"[^\s]"), c["text"]), 256)).alias("hash")))
    runs = line_chunks(docs, "text").select("key", "print", F.explode_outer(spans).alias("run")).select("key", "print", "run.*")
    return runs.where((F.col("end") - F.col("begin") + 1 >= MIN_LINES) & F.col("hash").isNotNull())


def dedup_passages(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with every line cut out of ``text`` that lies in a repeated passage: a run of lines with over
    MOST_WORDS words, or a chunk as in :func:`dedup_lines`, that stands at an earlier place too.

    Runs are equal when the SHA-256 of their lines are.  Places are ordered by key (null last), then text's print, then line; a line's first
    place stays.  Lines without words between cut lines go with them.  A text from which
    nothing is cut is unchanged, null included; rows repeated alike are treated alike.
    """
    base = docs.select(F.struct(*(docs[c] for c in docs.columns if c != text)).alias("row"), docs[key].alias("key"), docs[text].alias("text"), F.xxhash64(docs[text]).alias("print"))
    texts = base.select("key", "print", "text")
    found = _passages(texts).unionByName(_chunk_runs(texts)).withColumn("place", F.struct(F.col("key").isNull(), "key", "print", "begin"))
    again = found.groupBy("hash").agg(F.min("place").alias("head"), F.max("place").alias("tail")).where("head <> tail").select(F.col("hash").alias("again"), "head")
    cuts = found.join(again, F.col("hash") == F.col("again")).where("place <> head").groupBy(F.col("key").alias("cut_key"), F.col("print").alias("cut_print")).agg(F.collect_set(F.struct("begin", "end")).alias("runs"))
    gone = F.array_distinct(F.flatten(F.transform("runs", lambda r: F.sequence(r["begin"], r["end"]))))
    out = base.join(cuts, F.col("key").eqNullSafe(F.col("cut_key")) & (F.col("print") == F.col("cut_print")), "left")
    out = out.withColumn("lines", F.when(F.col("runs").isNotNull(), F.split("text", "\n", -1)))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), gone)
    new = F.when(F.col("runs").isNull(), F.col("text")).otherwise(F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n"))
    return out.select("row", new.alias("new")).select(*(F.col("new").alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns))


def op10_line_dedup(spark, sf_dir: str) -> DataFrame:
    """All documents without repeated chunks of lines."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "text", "removed_chunks", "removed_lines")


ORACLE = """
WITH lines AS (
  SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS l FROM documents
), hashed AS (
  SELECT *, list_transform(l, lambda x: md5(x)) AS h,
         list_transform(l, lambda x: length(x) > 800 OR len(regexp_extract_all(x, '[^ \\t\\n\\x0B\\f\\r]+')) > 50) AS long
  FROM lines
), ended AS (
  SELECT *, list_filter(range(len(l)), lambda i: i = len(l) - 1 OR long[i + 1] OR long[i + 2] OR
      substr(md5(CASE WHEN i = 0 THEN h[1] ELSE h[i] || h[i + 1] END), 1, 1) < '8') AS e
  FROM hashed
), chunked AS (
  SELECT doc_id, text, list_transform(range(len(e)), lambda k: {
      'p': k,
      'n': e[k + 1] - (CASE WHEN k = 0 THEN -1 ELSE e[k] END),
      'long': long[e[k + 1] + 1],
      't': array_to_string(l[(CASE WHEN k = 0 THEN 0 ELSE e[k] + 1 END) + 1 : e[k + 1] + 1], chr(10))}) AS c
  FROM ended
), flat AS (
  SELECT doc_id, u.p AS p, u.n AS n, u.t AS t, u.long AS long FROM (SELECT doc_id, unnest(c) AS u FROM chunked)
), marked AS (
  SELECT *, (long OR n >= 2 AND regexp_matches(t, '[^ \\t\\n\\x0B\\f\\r]'))
      AND row_number() OVER (PARTITION BY t ORDER BY doc_id, p) > 1 AS cut
  FROM flat
)
SELECT doc_id,
       coalesce(string_agg(t, chr(10) ORDER BY p) FILTER (NOT cut), '') AS text,
       count(*) FILTER (cut) AS removed_chunks,
       coalesce(sum(n) FILTER (cut), 0)::BIGINT AS removed_lines
FROM marked GROUP BY doc_id
"""
