"""Ranked lexical search with hashed max-sketches.

A document's sketch has a coordinate for each value of COORDINATE_BITS bits of a term's
hash and holds in each the greatest impact of the document's terms that fall there; only coordinates that are
not zero are stored.  As the impact grows with a term's frequency alone, once the document is given, the
frequency that has it is stored, and the index stays right when the corpus's averages
change.  A query's term weights times the impacts at its terms' coordinates sum
to an upper bound of the document's score.

Queries are looked up in blocks of bounded size, a block at a time against all sketches.  The
documents with the greatest bounds are scored exactly from their texts; the score of the
TOP-th best is then a threshold, and every document whose bound reaches it is scored too.  No
other document can be among the best, so the result is that of scoring every document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliate.llm.textarrays import SYMBOLS, bounded_batches, find_words, spans, utf8
from foliate.plans.lineage import drop, durable

TOP = 10
#: Documents of the greatest bounds that are scored first, for each query.
FIRST = 32
COORDINATE_BITS = 16
MOST_FREQUENT = 255  # a stored frequency so large stands for any larger one
#: A block of queries holds about so many, or so many bytes of text.
BLOCK_QUERIES, BLOCK_TEXT = 512, 1 << 22
BATCH_BYTES = 1 << 20
_PRODUCTS = 1 << 20  # terms of documents times queries that have them, at once
_CELLS = 1 << 21  # documents times queries at once
#: Fixed values of the score.
PERCENT_LENGTH, WEIGHT_SCALE, IMPACT_SCALE = 75, 1000, 1_000_000_000


def term_counts(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, term hash, frequency) of each text's distinct terms in order, and every text's number of terms."""
    hashes, row, _, _ = find_words(raw, offsets, gap=SYMBOLS)
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.flatnonzero(np.append(True, (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1]))) if len(row) else np.zeros(0, np.int64)
    return row[new], hashes[new], np.diff(np.append(new, len(row))), np.bincount(row, minlength=len(offsets) - 1)


def impact(frequency: np.ndarray, m: np.ndarray) -> np.ndarray:
    """A term's impact on a document whose length factor is ``m``; it never falls as the frequency grows."""
    return (IMPACT_SCALE * frequency) // (1000 * frequency + 8 * m)


def length_factor(n: np.ndarray, documents: int, length: int) -> np.ndarray:
    return 100 - PERCENT_LENGTH + (PERCENT_LENGTH * n * documents) // max(1, length)


class _Postings:
    """For each slot (a term or a coordinate) the queries that look there, and with what weight."""

    def __init__(self, slot: np.ndarray, query: np.ndarray, weight: np.ndarray, slots: int, queries: int):
        both, at = np.unique(slot * queries + query, return_inverse=True)
        self.queries = queries
        self.query, self.weight = both % queries, np.bincount(at, weights=weight)
        self.start = np.searchsorted(both // queries, np.arange(slots + 1))

    def sums(self, row: np.ndarray, slot: np.ndarray, value: np.ndarray, rows: int) -> Iterator[tuple[int, np.ndarray]]:
        """(first row, sums of value * weight by row and query) for blocks of rows in order."""
        many = self.start[slot + 1] - self.start[slot]
        products = np.concatenate([[0], np.cumsum(np.bincount(row, weights=many, minlength=rows).astype(np.int64))])
        edge = np.searchsorted(row, np.arange(rows + 1))
        for i, j in spans(products, _PRODUCTS):
            for low in range(i, j, max(1, _CELLS // self.queries)):
                high = min(j, low + max(1, _CELLS // self.queries))
                mine = slice(edge[low], edge[high])
                n = many[mine]
                ends = np.cumsum(n)
                take = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n - self.start[slot[mine]], n)
                cell = np.repeat((row[mine] - low) * self.queries, n) + self.query[take]
                total = np.bincount(cell, weights=np.repeat(value[mine].astype(float), n) * self.weight[take], minlength=(high - low) * self.queries)
                yield low, total.reshape(high - low, self.queries)  # whole numbers below 2^53, so the sums are exact


class QueryBlock:
    """Queries of one block: their distinct terms, and how often each has which."""

    def __init__(self, texts: list[str | None]):
        raw, offsets = utf8(pa.array(texts, pa.string()))
        self.n = len(texts)
        query, term, self.times, _ = term_counts(raw, offsets)
        self.terms, self.term = np.unique(term, return_inverse=True)
        self.query = query

    def known(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``hashes`` are terms of the block, and the numbers of these."""
        at = np.searchsorted(self.terms, hashes)
        at[at == len(self.terms)] = 0
        found = np.flatnonzero(self.terms[at] == hashes) if len(self.terms) else np.zeros(0, np.int64)
        return found, at[found]

    def weigh(self, holders: np.ndarray, documents: int, bits: int) -> None:
        """Weights of all terms from the numbers of documents that hold them, by term and by coordinate of ``bits`` bits."""
        weight = np.floor(WEIGHT_SCALE * np.log((2 * documents + 2) / (2 * holders + 1)))[self.term] * self.times
        self.exact = _Postings(self.term, self.query, weight, len(self.terms), self.n)
        self.hashed = _Postings((self.terms[self.term] >> np.uint64(64 - bits)).astype(np.int64), self.query, weight, 1 << bits, self.n)


def _texts(function: Callable) -> Callable:
    """Arrow function that calls ``function(batch, raw, offsets)`` on blocks of rows, the text in the last column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = utf8(batch.column(batch.num_columns - 1))
            for i, j in spans(offsets, BATCH_BYTES):
                yield function(batch.slice(i, j - i), raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])

    return run


def _sketched(batch: pa.RecordBatch, raw: np.ndarray, offsets: np.ndarray, bits: int) -> pa.RecordBatch:
    """(key, print, text) -> key, print, number of terms, coordinates and the greatest frequency in each."""
    row, term, frequency, n = term_counts(raw, offsets)
    at = (term >> np.uint64(64 - bits)).astype("<u2")  # terms are in order, so equal coordinates stand together
    new = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (row[1:] != row[:-1]))) if len(row) else np.zeros(0, np.int64)
    greatest = np.minimum(np.maximum.reduceat(frequency, new), MOST_FREQUENT).astype(np.uint8) if len(new) else np.zeros(0, np.uint8)
    bounds = np.searchsorted(row[new], np.arange(len(offsets)))
    cut = lambda a: pa.array([a[x:y].tobytes() for x, y in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())
    return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n), cut(at[new]), cut(greatest)], ["key", "print", "n", "coordinates", "frequencies"])


def sketch_index(docs: DataFrame, text: str = "text", key: str = "doc_id", bits: int = COORDINATE_BITS) -> DataFrame:
    """The stored index: key, print of the text, number of terms, and the sketch of 2 ** ``bits`` coordinates (at most 16 bits), for every row of ``docs``."""
    bounded_batches(docs.sparkSession)
    rows = _rows(docs, text, key)
    return durable(rows.mapInArrow(_texts(partial(_sketched, bits=bits)), "key long, print long, n long, coordinates binary, frequencies binary"), "sketches")


def _rows(docs: DataFrame, text: str, key: str) -> DataFrame:
    return docs.select(docs[key].cast("long").alias("key"), F.xxhash64(docs[text].cast("string")).alias("print"), docs[text].cast("string").alias("text"))


def _holders(docs: DataFrame, text: str, block: QueryBlock) -> np.ndarray:
    """The number of documents that hold each term of the block."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def count(batch: pa.RecordBatch, raw: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
        _, at = shared.value.known(term_counts(raw, offsets)[1])
        term, n = np.unique(at, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(term), pa.array(n)], ["term", "n"])

    counts = docs.select(docs[text].cast("string")).mapInArrow(_texts(count), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # a row a term of the block
    out = np.zeros(len(block.terms), np.int64)
    out[counts.column("term").to_numpy()] = counts.column("n").to_numpy()
    return out


def _bounds(index: DataFrame, shared, corpus: tuple[int, int], first: int = 0, threshold: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """(key, print, query, bound): each task's ``first`` greatest bounds of a query, or all that reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        held: list[tuple[np.ndarray, ...]] = []
        least = np.zeros(block.n)  # of a query, the bound that a row must exceed to be among the first

        def out(rows: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
            columns = [np.concatenate(c) for c in zip(*rows, strict=True)] if rows else [np.zeros(0, np.int64)] * 5
            return pa.RecordBatch.from_arrays([pa.array(columns[0], mask=columns[4].astype(bool)), *(pa.array(c.astype(np.int64)) for c in columns[1:4])], ["key", "print", "query", "bound"])

        def best() -> None:
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            order = np.lexsort((-columns[3], columns[2]))
            query = columns[2][order]
            rank = np.arange(len(order)) - np.searchsorted(query, query)
            stay = order[rank < first]
            held[:] = [tuple(c[stay] for c in columns)]
            last = order[rank == first - 1]
            least[columns[2][last]] = columns[3][last]

        for batch in batches:
            key, nothing = batch.column(0).fill_null(np.iinfo(np.int64).max).to_numpy(), batch.column(0).is_null().to_numpy(zero_copy_only=False)
            prints, n = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            flat, offsets = utf8(batch.column(3))
            frequency, _ = utf8(batch.column(4))
            coordinate = np.frombuffer(flat.tobytes(), "<u2").astype(np.int64)
            row = np.repeat(np.arange(batch.num_rows), np.diff(offsets) // 2)
            looked = np.flatnonzero(np.diff(block.hashed.start)[coordinate])
            row, coordinate, often = row[looked], coordinate[looked], frequency[looked].astype(np.int64)
            value = np.where(often == MOST_FREQUENT, IMPACT_SCALE // 1000, impact(often, length_factor(n, *corpus)[row]))
            for low, total in block.hashed.sums(row, coordinate, value, batch.num_rows):
                own = key[low : low + len(total)]
                if threshold is None:
                    r, q = np.nonzero(total > least)
                else:
                    r, q = np.nonzero(total >= threshold[0])
                    near = (total[r, q] > threshold[0][q]) | (own[r] <= threshold[1][q])
                    r, q = r[near], q[near]
                held.append((own[r], prints[low + r], q, total[r, q], nothing[low + r]))
                if threshold is None and sum(len(h[0]) for h in held) > 4 * first * block.n:
                    best()
            if threshold is not None and held:
                yield out(held)
                held.clear()
        if held:
            if threshold is None:
                best()
            yield out(held)

    return index.mapInArrow(run, "key long, print long, query long, bound long")


def _scored(docs: DataFrame, asked: DataFrame, shared, corpus: tuple[int, int], text: str, key: str) -> DataFrame:
    """(query, key, score) of the rows of ``docs`` that ``asked`` (key, print, queries) names."""

    def score(batch: pa.RecordBatch, raw: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
        block = shared.value
        row, term, frequency, n = term_counts(raw, offsets)
        found, at = block.known(term)
        row, value = row[found], impact(frequency[found], length_factor(n, *corpus)[row[found]])
        want = batch.column(1)
        query, of = want.flatten().to_numpy(), np.repeat(np.arange(batch.num_rows), want.value_lengths().to_numpy())
        scores = np.zeros(len(query), np.int64)
        for low, total in block.exact.sums(row, at, value, batch.num_rows):
            mine = slice(*np.searchsorted(of, [low, low + len(total)]))
            scores[mine] = total[of[mine] - low, query[mine]].astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(query), batch.column(0).take(pa.array(of)), pa.array(scores)], ["query", "key", "score"])

    named = asked.select(F.col("key").alias("k"), F.col("print").alias("p"), "queries")
    rows = _rows(docs, text, key).join(named, F.col("key").eqNullSafe(F.col("k")) & (F.col("print") == F.col("p"))).select("key", "queries", "text")
    return rows.mapInArrow(_texts(score), "query long, key long, score long").where("score > 0")


def _best(scores: DataFrame, most: int) -> DataFrame:
    """Each query's ``most`` best, equal scores by ascending key, null keys last."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _search_block(index: DataFrame, docs: DataFrame, block: QueryBlock, corpus: tuple[int, int], text: str, key: str, top: int, many: int, bits: int) -> DataFrame:
    spark = docs.sparkSession
    block.weigh(_holders(docs, text, block), corpus[0], bits)
    shared = spark.sparkContext.broadcast(block)
    queries = lambda found: found.groupBy("key", "print").agg(F.sort_array(F.collect_set("query")).alias("queries"))
    order = Window.partitionBy("query").orderBy(F.desc("bound"))
    first = _bounds(index, shared, corpus, first=many).withColumn("n", F.row_number().over(order)).where(F.col("n") <= many)
    first = durable(queries(first), "first")  # at most ``many`` rows a query of the block
    limit = _best(_scored(docs, F.broadcast(first), shared, corpus, text, key), top).where(F.col("rank") == top).collect()  # a row a query of the block
    score, last = np.ones(block.n), np.full(block.n, np.iinfo(np.int64).max)  # scores are above 0
    for r in limit:
        score[r["query"]], last[r["query"]] = r["score"], last[0] if r["key"] is None else r["key"]
    rest = durable(queries(_bounds(index, shared, corpus, threshold=(score, last))), "reached")
    best = durable(_best(_scored(docs, rest, shared, corpus, text, key), top), "best")
    drop(first)
    drop(rest)
    return best


def search(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", item_text: str = "text", item_key: str = "item_id", top: int = TOP, first: int = FIRST, bits: int = COORDINATE_BITS, index: DataFrame | None = None) -> DataFrame:
    """(item key, rank, key, score): the ``top`` rows of ``docs`` for each row of ``items``, best first.

    Terms are ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` with A-Z in lower case.  Equal
    scores rank by ascending key, null keys last; rows repeated with one key are
    documents of their own.  Items repeated alike are one; a null or empty item finds
    nothing, as does one without terms; null texts hold none.  Keys must be integers.  The ``first``
    documents by bound (``top`` at least) set a query's threshold.  ``index`` is a
    :func:`sketch_index` of the same ``docs`` and ``bits``, made here if not given.  Other
    columns are not read.
    """
    bounded_batches(docs.sparkSession)
    spark = docs.sparkSession
    index = sketch_index(docs, text, key, bits) if index is None else index
    corpus = tuple(int(x or 0) for x in index.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first())
    asked = items.select(items[item_key].alias("item"), items[item_text].cast("string").alias("text")).distinct()
    size = asked.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    blocks = max(1, -(-size[0] // BLOCK_QUERIES), -(-int(size[1] or 0) // BLOCK_TEXT))
    kind = items.schema[item_key].dataType.simpleString()
    found = []
    for b in range(blocks):  # every block is a pass over the index
        own = asked.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b).collect()  # about BLOCK_QUERIES rows
        if own:
            names = F.broadcast(spark.createDataFrame([(q, r["item"]) for q, r in enumerate(own)], f"query long, item {kind}"))
            found.append(_search_block(index, docs, QueryBlock([r["text"] for r in own]), corpus, text, key, top, max(top, first), bits).join(names, "query"))
    if not found:
        return spark.createDataFrame([], f"{item_key} {kind}, rank int, {key} long, score long")
    return reduce(DataFrame.unionAll, found).select(F.col("item").alias(item_key), "rank", F.col("key").alias(key), "score")


def op12_lexical_search(spark, sf_dir: str) -> DataFrame:
    """The ten documents that score highest for each benchmark item."""
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return search(docs.select("doc_id", "text"), items.select("item_id", "text"))


_TERMS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
ORACLE = f"""
WITH words AS (
  SELECT doc_id, {_TERMS} AS w FROM documents
), facts AS (
  SELECT count(*) FILTER (len(w) > 0) AS docs, sum(len(w))::BIGINT AS length FROM words
), frequencies AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM words) GROUP BY doc_id, term
), holders AS (
  SELECT term, count(*) AS df FROM frequencies GROUP BY term
), asked AS (
  SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY item_id, term
), scored AS (
  SELECT item_id, doc_id, sum(times * floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT
      * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * len(w) * docs) // length))))::BIGINT AS score
  FROM asked JOIN holders USING (term) JOIN frequencies USING (term) JOIN words USING (doc_id), facts
  GROUP BY item_id, doc_id
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
