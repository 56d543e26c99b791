"""Benchmark decontamination by winnowing.

Of every WINDOW consecutive words the least of their GRAM-word hashes is kept (the
last of equal ones), in documents as in benchmark items.  A passage of WINDOW
words keeps the same place wherever it stands, so documents and items that
share one meet in a join of these fingerprints.  What meets is extended word by word
to both sides, as far as a window through the fingerprint can reach; words are
compared as text, so a hash that collides finds nothing.

An item of fewer words is its own fingerprint, and documents keep every place of
such lengths.  Documents keep only what a bit table of the items' fingerprints lets
through; its size is bounded, and what it wrongly lets through does not join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliate.llm.textarrays import SYMBOLS, bounded_batches, find_words, joined, spans, utf8
from foliate.plans.lineage import durable, split_join

WINDOW, GRAM = 10, 5
BATCH_BYTES = 1 << 20
#: The bit table holds at most so many bits (8 MB); an item's fingerprint sets one.
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 26
_HIT = "fp long, left array<string>, right array<string>"


def winnowed(hashes: np.ndarray, row: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Places whose hash of ``gram`` words is kept, and these hashes; ``row`` says which text a word belongs to."""
    grams = joined(hashes, gram)
    n = max(0, len(hashes) - window + 1)
    whole = row[:n] == row[window - 1 : window - 1 + n]
    best, at = grams[:n].copy(), np.arange(n)
    for k in range(1, window - gram + 1):
        other = grams[k : k + n]
        less = other <= best
        best[less] = other[less]
        at[less] = np.flatnonzero(less) + k
    kept = np.unique(at[whole])
    return kept, grams[kept]


class _Texts:
    """The words of a block of texts, and fingerprints with what stands beside them."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        self.hashes, self.row, self.begin, self.end = find_words(raw, offsets, gap=SYMBOLS)
        self.bytes = raw.tobytes().lower()  # bytes.lower changes A-Z alone
        self.bounds = np.searchsorted(self.row, np.arange(len(offsets)))

    def words(self, a: int, b: int) -> list[str]:
        return [self.bytes[x:y].decode() for x, y in zip(self.begin[a:b].tolist(), self.end[a:b].tolist(), strict=True)]

    def short(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Every place where ``length`` words of one text follow, and their hashes."""
        grams = joined(self.hashes, length, salt=1)
        at = np.flatnonzero(self.row[: len(grams)] == self.row[length - 1 :]) if len(grams) else np.zeros(0, np.int64)
        return at, grams[at]

    def beside(self, at: int) -> tuple[list[str], list[str]]:
        """Of a winnowed place, the words before it, nearest first, and those from it on, as far as a window reaches."""
        low, high = self.bounds[self.row[at]], self.bounds[self.row[at] + 1]
        return self.words(max(low, at - WINDOW + GRAM), at)[::-1], self.words(at, min(high, at + WINDOW))


def item_fingerprints(items: DataFrame, text: str, key: str) -> DataFrame:
    """(fp, left, right, gram, need, items): fingerprints of ``items`` with what stands beside them, each once.

    An occurrence has ``need`` words in all and ``gram`` in the fingerprint.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = utf8(batch.column(1))
            for i, j in spans(offsets, BATCH_BYTES):
                block = _Texts(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                ids = batch.column(0).slice(i, j - i).to_pylist()
                rows = [(int(fp), *block.beside(at), GRAM, WINDOW, ids[block.row[at]]) for at, fp in zip(*(x.tolist() for x in winnowed(block.hashes, block.row)), strict=True)]
                counts = np.diff(block.bounds)
                for length in np.unique(counts[(counts > 0) & (counts < WINDOW)]).tolist():
                    for at, fp in zip(*(x.tolist() for x in block.short(length)), strict=True):
                        if counts[block.row[at]] == length:
                            rows.append((fp, [], block.words(at, at + length), length, length, ids[block.row[at]]))
                columns = list(zip(*rows, strict=True)) or [[]] * 6
                fps = pa.array(np.array(columns[0], np.uint64).view(np.int64))
                lists = (pa.array(list(c), pa.list_(pa.string())) for c in columns[1:3])
                yield pa.RecordBatch.from_arrays([fps, *lists, pa.array(columns[3], pa.int32()), pa.array(columns[4], pa.int32()), pa.array(columns[5], pa.string())], ["fp", "left", "right", "gram", "need", "item"])

    texts = items.select(items[key].cast("string").alias("item"), items[text].cast("string").alias("text"))
    found = texts.mapInArrow(run, f"{_HIT}, gram int, need int, item string")
    return found.groupBy("fp", "left", "right", "gram", "need").agg(F.collect_set("item").alias("items"))


def _bit_table(fingerprints: DataFrame) -> tuple[int, np.ndarray]:
    """The number of leading bits looked at, and a table with a bit for each value of these: at most MOST_BITS."""
    n = fingerprints.count()
    lead = max(LEAST_BITS, min(MOST_BITS, 1 << (32 * n).bit_length())).bit_length() - 1
    slot = F.shiftrightunsigned("fp", 64 - lead)
    cells = fingerprints.select(slot.alias("slot")).groupBy(F.shiftrightunsigned("slot", 6).alias("cell")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits")).toArrow()  # at most MOST_BITS / 64 rows
    table = np.zeros((1 << lead) >> 6, np.uint64)
    table[cells.column("cell").to_numpy()] = cells.column("bits").to_numpy().view(np.uint64)
    return lead, table


def document_fingerprints(docs: DataFrame, fingerprints: DataFrame, text: str, key: str) -> DataFrame:
    """(row, key, n, hits): for each row of ``docs`` its number of words and the fingerprints that the bit table lets through, each with its places."""
    lead, table = _bit_table(fingerprints)
    lengths = [r[0] for r in fingerprints.where(F.col("need") < WINDOW).select("need").distinct().collect()]  # less than WINDOW
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value

        def through(at: np.ndarray, fp: np.ndarray) -> Iterator[tuple[int, int]]:
            slot = fp >> np.uint64(64 - lead)
            known = (bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
            return zip(at[known].tolist(), fp[known].view(np.int64).tolist(), strict=True)

        for batch in batches:
            raw, offsets = utf8(batch.column(2))
            for i, j in spans(offsets, BATCH_BYTES):
                block = _Texts(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                hits: list[dict] = [{} for _ in range(j - i)]

                def hold(at: int, fp: int, left: list[str], right: list[str], block=block, hits=hits) -> None:
                    row = block.row[at]
                    hits[row].setdefault((fp, tuple(left), tuple(right)), []).append(at - int(block.bounds[row]))

                for at, fp in through(*winnowed(block.hashes, block.row)):
                    hold(at, fp, *block.beside(at))
                for length in lengths:
                    for at, fp in through(*block.short(length)):
                        hold(at, fp, [], block.words(at, at + length))
                made = [[{"fp": fp, "left": left, "right": right, "at": at} for (fp, left, right), at in one.items()] for one in hits]
                kind = pa.list_(pa.struct([("fp", pa.int64()), ("left", pa.list_(pa.string())), ("right", pa.list_(pa.string())), ("at", pa.list_(pa.int64()))]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(np.diff(block.bounds)), pa.array(made, kind)], ["row", "key", "n", "hits"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), docs[key].alias("key"), docs[text].cast("string").alias("text"))
    return rows.mapInArrow(run, f"row long, key {docs.schema[key].dataType.simpleString()}, n long, hits array<struct<{_HIT.replace(' ', ':').replace(',:', ',')},at:array<long>>>")


def _alike(one: str, two: str) -> Column:
    """How many words two lists have in common from their beginning on."""
    differs = F.array_position(F.zip_with(one, two, lambda x, y: x.eqNullSafe(y)), False)
    return F.when(differs > 0, differs - 1).otherwise(F.size(one).cast("long"))


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", item_text: str = "text", item_key: str = "item_id") -> DataFrame:
    """(key, n_words, n_hit, hit_items, hit_spans) for every row of ``docs``.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z in lower case.  A word is
    hit inside any occurrence of WINDOW consecutive words of an item, or of the
    whole of an item with fewer, but some.  hit_items are the keys, as sorted
    strings, of the items that occur; hit_spans the word spans (begin, end) of the
    occurrences, which overlap.  Null or wordless texts hit nothing, and null or
    wordless items are never hit; an item with a null key hits words and is not listed.  Items and
    rows repeated alike are treated alike, keys are passed on, and other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    asked = durable(item_fingerprints(items, item_text, item_key), "item-prints")
    found = durable(document_fingerprints(docs, asked, text, key), "doc-prints")
    each = found.where(F.size("hits") > 0).select("row", F.explode("hits").alias("hit")).select("row", "hit.fp", F.col("hit.left").alias("l"), F.col("hit.right").alias("r"), "hit.at")
    met = split_join(each, asked, ["fp"]).select("row", "at", "gram", "need", "items", _alike("l", "left").alias("back"), _alike("r", "right").alias("on"))
    met = met.where((F.col("on") >= F.col("gram")) & (F.col("back") + F.col("on") >= F.col("need")))
    span = F.transform("at", lambda a: F.struct((a - F.col("back")).alias("begin"), (a + F.col("on")).alias("end")))
    by_row = met.groupBy("row").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_set(span)))).alias("hit_spans"), F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("hit_items"))
    start = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("reach"))
    more = lambda s, x: F.struct((s["total"] + F.greatest(x["end"] - F.greatest(x["begin"], s["reach"]), F.lit(0))).alias("total"), F.greatest(s["reach"], x["end"]).alias("reach"))
    by_row = by_row.withColumn("n_hit", F.aggregate("hit_spans", start, more)["total"])
    out = found.drop("hits").join(by_row, "row", "left")
    return out.select(
        F.col("key").alias(key),
        F.col("n").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("hit_items", F.array().cast("array<string>")).alias("hit_items"),
        F.coalesce("hit_spans", F.array().cast("array<struct<begin:bigint,end:bigint>>")).alias("hit_spans"),
    )


def op11_decontamination(spark, sf_dir: str) -> DataFrame:
    """All documents with the words and benchmark items that they share."""
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    found = decontaminate(docs.select("doc_id", "text"), items.select("item_id", "text"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"), F.sha2(F.array_join("hit_items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
ORACLE = f"""
WITH items AS (
  SELECT item_id, {_WORDS} AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS m, unnest(list_transform(range(greatest(len(w) - {WINDOW}, 0) + 1), lambda i: array_to_string(w[i + 1 : i + {WINDOW}], ' '))) AS gram
  FROM items WHERE len(w) > 0
), docs AS (
  SELECT doc_id, {_WORDS} AS w FROM documents
), grams AS (
  SELECT doc_id, m, u.i AS i, u.gram AS gram FROM (
    SELECT doc_id, m, unnest(list_transform(range(len(w) - m + 1), lambda i: {{'i': i, 'gram': array_to_string(w[i + 1 : i + m], ' ')}})) AS u
    FROM docs, (SELECT DISTINCT m FROM windows) WHERE len(w) >= m)
), hits AS (
  SELECT doc_id, i, m, item_id FROM grams JOIN windows USING (m, gram)
), hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hits) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""
