"""Packing documents into sequences by multiway Karmarkar-Karp differencing.

A document's ids are cut into full windows and a rest of pieces of at most
PIECE ids.  Pieces are dealt by hash into groups of about GROUP_PIECES, whatever
document they come from, so a group's size is bounded.  Within a group partial
partitions are merged, the two with the largest imbalance first and the large
sums of one upon the small sums of the other, until one partition into near-equal
windows is left; while a window exceeds the capacity, their number rises.
Only piece lengths are shuffled, never ids or texts.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliate.llm.textarrays import bounded_batches, spans, utf8
from foliate.llm.tokencount import BATCH_BYTES, SPLITTABLE, token_ids

CAPACITY = 2048
PIECE = 512
GROUP_PIECES = 2000
END_ID = 1
#: Pieces of rests that a document has on average at most, for the number of groups.
RESTS = 4
_WINDOWS = 1 << 24  # sequence ids of one group


def cuts(n: int, capacity: int = CAPACITY, piece: int = PIECE) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: full windows, then near-equal parts of the rest."""
    full = n // capacity
    out = [(i * capacity, capacity) for i in range(full)]
    rest, start = n - full * capacity, full * capacity
    parts = -(-rest // piece)
    for i in range(parts):
        length = rest // parts + (i < rest % parts)
        out.append((start, length))
        start += length
    return out


def difference(lengths: np.ndarray, windows: int) -> tuple[np.ndarray, np.ndarray]:
    """The window of each length and the windows' sums, by largest differencing.

    A partial partition is a vector of sums in descending order, less its
    smallest, and for each window the tree of lengths in it.
    """
    n = len(lengths)
    left, right = [-1] * n, [-1] * n
    order = np.argsort(-lengths, kind="stable")
    heap, parts = [], {}
    for rank, i in enumerate(order.tolist()):
        sums, trees = np.zeros(windows, np.int64), np.full(windows, -1, np.int64)
        sums[0], trees[0] = lengths[i], i
        heap.append((-int(lengths[i]), rank))
        parts[rank] = (sums, trees)
    heapq.heapify(heap)
    tick = n
    while len(heap) > 1:
        a_sums, a_trees = parts.pop(heapq.heappop(heap)[1])
        b_sums, b_trees = parts.pop(heapq.heappop(heap)[1])
        sums, b_trees = a_sums + b_sums[::-1], b_trees[::-1]
        trees = np.where(a_trees < 0, b_trees, a_trees)
        both = np.flatnonzero((a_trees >= 0) & (b_trees >= 0))
        if len(both):
            trees[both] = np.arange(len(left), len(left) + len(both))
            left.extend(a_trees[both].tolist())
            right.extend(b_trees[both].tolist())
        by = np.argsort(-sums, kind="stable")
        sums, trees = sums[by], trees[by]
        sums -= sums[-1]
        parts[tick] = (sums, trees)
        heapq.heappush(heap, (-int(sums[0]), tick))
        tick += 1
    window = np.zeros(n, np.int64)
    if n:
        _, trees = parts[heap[0][1]]
        for w, root in enumerate(trees.tolist()):
            stack = [root] if root >= 0 else []
            while stack:
                node = stack.pop()
                if node < n:
                    window[node] = w
                else:
                    stack += [left[node], right[node]]
    return window, np.bincount(window, lengths, windows).astype(np.int64)


def pack_group(lengths: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """A window for each piece, no window above ``capacity``; full pieces stand alone."""
    lengths = np.asarray(lengths, np.int64)
    window = np.zeros(len(lengths), np.int64)
    full = lengths >= capacity
    window[full] = np.arange(full.sum())
    rest = lengths[~full]
    if len(rest):
        total = int(rest.sum())
        k = -(-total // capacity)
        while True:
            got, sums = difference(rest, k)
            over = int(sums.max()) - total // k
            if sums.max() <= capacity:
                break
            k = min(max(k + 1, -(-total // max(1, capacity - over // 2))), len(rest))
        window[~full] = got + full.sum()
    return window


def _tokenise(name: str, capacity: int, piece: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = token_ids(name)
        for batch in batches:
            _, offsets = utf8(batch.column(1))
            for i, j in spans(offsets, BATCH_BYTES):
                rows: list[tuple[int, int, int, int, int]] = []
                for k, text in enumerate(batch.column(1).slice(i, j - i).to_pylist(), i):
                    ids = np.append(encode(text), END_ID).astype("<u4")
                    rows += [(k, start, length, zlib.crc32(ids[start : start + length]), len(ids)) for start, length in cuts(len(ids), capacity, piece)]
                at, *rest = (pa.array(c, pa.int64()) for c in zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in (0, 2)), *rest], ["key", "row", "start", "length", "ids_crc32", "doc_tokens"])

    return run


def pack(docs: DataFrame, text: str = "text", key: str = "doc_id", name: str = SPLITTABLE, capacity: int = CAPACITY, piece: int = PIECE, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """One row for each piece of a document: where it lies in which sequence.

    Columns: key, start, length, ids_crc32, doc_tokens, sequence_id, offset, and
    doc_row, a number that tells rows of ``docs`` with the same key apart.  A
    null or empty text is the end id alone.  Null and repeated keys are packed as
    rows of their own; other columns are not read.  ``docs`` must give its rows in
    the same order when read again, as a stored table does.
    """
    bounded_batches(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.count()  # answered by the file footers where docs is a stored table
    groups = max(1, -(-rows * RESTS // group_pieces))
    base = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text"), F.monotonically_increasing_id().alias("row"))
    cut = base.mapInArrow(_tokenise(name, capacity, piece), f"key {kind}, row long, start long, length long, ids_crc32 long, doc_tokens long")
    dealt = cut.withColumn("group", F.pmod(F.xxhash64("row", "start"), F.lit(groups)))

    def placed(group: pa.Table) -> pa.Table:
        group = group.sort_by([("row", "ascending"), ("start", "ascending")])
        lengths = group.column("length").to_numpy().astype(np.int64)
        window = pack_group(lengths, capacity)
        order = np.argsort(window, kind="stable")
        before = np.cumsum(lengths[order]) - lengths[order]
        first = np.searchsorted(window[order], np.arange(window.max() + 1))
        offset = np.empty(len(lengths), np.int64)
        offset[order] = before - before[first[window[order]]]
        names = ["key", "row", "start", "length", "ids_crc32", "doc_tokens"]
        sequence = group.column("group").to_numpy().astype(np.int64) * _WINDOWS + window
        return pa.table([*(group.column(c) for c in names), pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    out = dealt.groupBy("group").applyInArrow(placed, f"key {kind}, row long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return out.select(F.col("key").alias(key), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", F.col("row").alias("doc_row"))


def op2_packing(spark, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most CAPACITY ids."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
