"""Near duplicates: a multi-index Hamming join over b-bit minhash signatures.

A document's signature has CHUNKS * WIDTH positions of 16 bits.  It is split
into CHUNKS chunks; two signatures that differ in at most
CHUNKS * (ERRORS + 1) - 1 positions agree, by pigeonhole, in some chunk up to
ERRORS positions.  Each chunk therefore emits one key for every way of leaving
ERRORS positions out, and every such pair meets under a key.  A pair with the
Jaccard similarity 0.8 escapes all keys with a probability of about 10^-6.

Pairs that meet are not enumerated.  A key's smallest row is its head.  First every
row is held against the heads of its keys (the exact test on full shingle
sets), and what passes is linked into components.  All rows that meet under a key
share its head, so what is left are pairs under one head in different
components.  Rows that have none of their rarest shingles in common with
another component cannot be half of such a pair and are left out (the families of
texts that share a template and nothing else); of the rest each head's rows that are not
in its largest component are held against all of the head's, in blocks of bounded size inside tasks
that emit only links between components.  No link between two components is lost.  Documents with
equal shingle sets are one class from the start.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliate.llm.textarrays import mix, shingle_sets, bounded_batches, spans, utf8
from foliate.plans.lineage import drop, durable, split_join

# Joins with the shingle sets carry a merge hint: both their sides grow with the corpus, so none of them is to be broadcast.
SHINGLE_WORDS = 5
SIMILARITY = 80  # per cent
CHUNKS, WIDTH, ERRORS = 13, 6, 1
#: Positions of the 128-bit sketch (one bit a minhash) in which a pair may differ.
#: At similarity 0.8 they number 12.8 on average; more than 36 occur once in 10^9.
SKETCH_BITS, SKETCH_DISTANCE = 128, 36
BATCH_BYTES = 1 << 20
GROUP_ROWS = 256
BLOCK_SHINGLES = 1 << 20
BUCKETS = 1 << 18

_POSITIONS = CHUNKS * WIDTH
_FACTORS = mix(np.arange(1, _POSITIONS + SKETCH_BITS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _fingerprints(words: int):
    """Arrow function: (doc_id, text) -> size, 128-bit set hash, signature and sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = utf8(batch.column(1))
            for i, j in spans(offsets, BATCH_BYTES):
                sets = shingle_sets(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], words)
                sizes = np.array([len(s) for s in sets], np.int64)
                n = j - i
                h1, h2 = np.zeros(n, np.int64), np.zeros(n, np.int64)
                values = np.zeros((n, _POSITIONS + SKETCH_BITS), np.uint64)
                some = np.flatnonzero(sizes)
                if len(some):
                    flat = np.concatenate([sets[k] for k in some])
                    starts = np.concatenate([[0], np.cumsum(sizes[some])[:-1]])
                    h1[some] = np.add.reduceat(mix(flat ^ np.uint64(0xA5A5A5A5)), starts).view(np.int64)
                    h2[some] = np.add.reduceat(mix(flat + np.uint64(0xC2B2AE3D27D4EB4F)), starts).view(np.int64)
                    for k, factor in enumerate(_FACTORS):
                        values[some, k] = np.minimum.reduceat(flat * factor, starts)
                    values = mix(values)
                signature = np.ascontiguousarray((values[:, :_POSITIONS] & np.uint64(0xFFFF)).astype("<u2"))
                sketch = np.packbits((values[:, _POSITIONS:] & np.uint64(1)).astype(np.uint8), axis=1).view("<i8")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, n), pa.array(sizes), pa.array(h1), pa.array(h2), pa.array([r.tobytes() for r in signature], pa.binary()), pa.array(sketch[:, 0].copy()), pa.array(sketch[:, 1].copy())],
                    ["doc_id", "n", "h1", "h2", "sig", "s1", "s2"],
                )

    return run


def _chunk_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow function: a class's signature -> its keys, each chunk with ERRORS positions left out."""
    left_out = list(combinations(range(WIDTH), ERRORS))
    for batch in batches:
        for i in range(0, batch.num_rows, 2000):
            part = batch.slice(i, 2000)
            sig = np.frombuffer(b"".join(part.column(1).to_pylist()), "<u2").reshape(-1, CHUNKS, WIDTH).astype(np.uint64)
            keys = np.empty((len(sig), CHUNKS, len(left_out)), np.uint64)
            chunk = np.arange(CHUNKS, dtype=np.uint64)
            for v, out in enumerate(left_out):
                value = np.broadcast_to(mix(chunk * np.uint64(64) + np.uint64(v + 1)), (len(sig), CHUNKS))
                for p in range(WIDTH):
                    if p not in out:
                        value = mix(value * np.uint64(0x9FB21C651E98DF25) + sig[:, :, p])
                keys[:, :, v] = value
            take = pa.array(np.repeat(np.arange(len(sig)), CHUNKS * len(left_out)))
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), part.column(0).take(take)], ["key", "rep"])


def _alike():
    """Sizes that allow the similarity, and sketches within the distance, of a row and its head."""
    one, two = F.col("head_n"), F.col("n")
    apart = F.bit_count(F.col("head_s1").bitwiseXOR(F.col("s1"))) + F.bit_count(F.col("head_s2").bitwiseXOR(F.col("s2")))
    return (F.least(one, two) * 100 >= F.greatest(one, two) * SIMILARITY) & (apart <= SKETCH_DISTANCE)


def shingles_of(needed: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """(id, grams): the sorted shingle hashes of each text whose id is in ``needed``, as bytes; a row for each distinct text of an id."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = utf8(batch.column(1))
            for i, j in spans(offsets, BATCH_BYTES):
                got = shingle_sets(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], words)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array([s.tobytes() for s in got], pa.binary())], ["id", "grams"])

    texts = docs.select(F.col("doc_id").alias("id"), "text").join(needed.hint("merge"), "id", "left_semi")
    return texts.withColumn("print", F.xxhash64("text")).dropDuplicates(["id", "print"]).select("id", "text").mapInArrow(sets, "id long, grams binary")


def _against_heads(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of ``pairs`` (head a, row b) those with 100 * intersection >= SIMILARITY * union on full sets.

    A head's rows are dealt into groups of about GROUP_ROWS, each of which gets
    the head's set once.
    """
    sizes = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / GROUP_ROWS).alias("parts"))
    pairs = split_join(pairs, sizes, ["a"]).withColumn("salt", F.pmod(F.xxhash64("b"), "parts").cast("int"))
    owners = pairs.select(F.col("a").alias("id"), "a", "salt", F.lit(True).alias("owner")).distinct()
    asked = owners.unionByName(pairs.select(F.col("b").alias("id"), "a", "salt", F.lit(False).alias("owner")))

    def held(group: pa.Table) -> pa.Table:
        owner, ids = group.column("owner").to_pylist(), group.column("id").to_pylist()
        grams = [np.frombuffer(g.as_buffer(), np.uint64) for g in group.column("grams")]
        own = [k for k, mine in enumerate(owner) if mine]
        links = []
        for k, other in enumerate(grams):
            if not owner[k]:
                both = (np.intersect1d(grams[at], other, assume_unique=True).size for at in own)
                if any(100 * n >= SIMILARITY * (len(grams[at]) + len(other) - n) for n, at in zip(both, own, strict=True)):
                    links.append(ids[k])
        return pa.table({"a": pa.array([ids[own[0]]] * len(links), pa.int64()), "b": pa.array(links, pa.int64())})

    return sets.join(asked.hint("merge"), "id").groupBy("a", "salt").applyInArrow(held, "a long, b long")


def prefix_length(n: np.ndarray) -> np.ndarray:
    """How many of its rarest shingles a set of n must show: two sets of the similarity have one of these in common,
    in any one order of all shingles, as they share SIMILARITY per cent of the larger at least."""
    return n - -(-n * SIMILARITY // 100) + 1


def _active(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """(rep): those of ``rows`` (rep, part) that share one of their rarest shingles with a row of another component.

    No other row can be linked across components.  Shingles are ordered by how many
    of them fall into their bucket of BUCKETS, a table of a fixed size; the order
    decides how many rows are left, never which links are found.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint64)
            bucket, n = np.unique(flat % np.uint64(BUCKETS), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(bucket.astype(np.int64)), pa.array(n)], ["bucket", "n"])

    held = durable(sets.join(rows.hint("merge"), F.col("id") == F.col("rep")).select("rep", "part", "grams"), "held")
    counts = held.select("grams").mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # at most BUCKETS rows
    table = np.zeros(BUCKETS, np.int64)
    table[counts.column("bucket").to_numpy()] = counts.column("n").to_numpy()
    shared = rows.sparkSession.sparkContext.broadcast(np.minimum(table, (1 << 32) - 1).astype(np.uint32))

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = shared.value
        for batch in batches:
            grams = [np.frombuffer(g.as_buffer(), np.uint64) for g in batch.column(2)]
            sizes = np.array([len(g) for g in grams], np.int64)
            flat = np.concatenate([np.zeros(0, np.uint64), *grams])
            row = np.repeat(np.arange(len(grams)), sizes)
            order = np.lexsort((flat, often[flat % np.uint64(BUCKETS)], row))
            rank = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            keep = rank < prefix_length(sizes)[row]
            take = pa.array(row[keep])
            yield pa.RecordBatch.from_arrays([pa.array(flat[order][keep].view(np.int64)), batch.column(0).take(take), batch.column(1).take(take)], ["token", "rep", "part"])

    rare = held.mapInArrow(rarest, "token long, rep long, part long")
    across = rare.groupBy("token").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high").select("token")
    return split_join(rare, across, ["token"], "left_semi").select("rep").distinct()


def _across(group: pa.Table) -> pa.Table:
    """Links between components in one block: its queries against its targets; at most one for each component joined.

    Only rows that share one of their rarest shingles in the block are compared.
    """
    ids, parts = group.column("id").to_numpy(), group.column("part").to_numpy()
    asks, takes = (np.array(group.column(c).to_pylist(), bool) for c in ("query", "target"))
    grams = [np.frombuffer(g.as_buffer(), np.uint64) for g in group.column("grams")]
    sizes = np.array([len(g) for g in grams], np.int64)
    _, at, often = np.unique(np.concatenate(grams), return_inverse=True, return_counts=True)
    starts, row = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(grams)), sizes)
    rare = np.empty(len(often), np.int64)
    rare[np.argsort(often, kind="stable")] = np.arange(len(often))
    order = np.lexsort((rare[at], row))
    keep = np.arange(len(at)) - starts[row] < prefix_length(sizes)[row]
    tokens, owner = at[order][keep], row[keep]
    posting = np.argsort(tokens, kind="stable")
    posting = posting[takes[owner[posting]]]
    bounds = np.searchsorted(tokens[posting], np.arange(len(often) + 1))
    shown = np.searchsorted(owner, np.arange(len(grams) + 1))
    label = np.unique(parts, return_inverse=True)[1]
    links, mine = [], np.zeros(len(often), bool)
    for q in np.flatnonzero(asks).tolist():
        near = [owner[posting[bounds[t] : bounds[t + 1]]] for t in tokens[shown[q] : shown[q + 1]].tolist()]
        near = np.unique(np.concatenate(near)) if near else np.zeros(0, np.int64)
        near = near[(label[near] != label[q]) & (100 * np.minimum(sizes[near], sizes[q]) >= SIMILARITY * np.maximum(sizes[near], sizes[q]))]
        if not len(near):
            continue
        mine[at[starts[q] : starts[q] + sizes[q]]] = True
        for k in near.tolist():
            if label[k] != label[q]:
                both = int(mine[at[starts[k] : starts[k] + sizes[k]]].sum())
                if 100 * both >= SIMILARITY * (sizes[k] + sizes[q] - both):
                    links.append((int(ids[q]), int(ids[k])))
                    label[label == label[k]] = label[q]
        mine[at[starts[q] : starts[q] + sizes[q]]] = False
    return pa.table({"a": pa.array([x[0] for x in links], pa.int64()), "b": pa.array([x[1] for x in links], pa.int64())})


def _mixed(members: DataFrame) -> DataFrame:
    """A row for each head of ``members`` whose rows are in several components: its largest one, and its blocks of targets and queries."""
    by_part = members.groupBy("head", "part").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("grams"))
    heads = by_part.groupBy("head").agg(F.max(F.struct("rows", "part", "grams")).alias("most"), F.sum("rows").alias("rows"), F.sum("grams").alias("grams"), F.count(F.lit(1)).alias("parts"))
    return heads.where("parts > 1").select("head", "rows", F.col("most.part").alias("main"), F.ceil(F.col("grams") / BLOCK_SHINGLES).alias("targets"), F.ceil((F.col("grams") - F.col("most.grams")) / BLOCK_SHINGLES).alias("queries"))


def _between_components(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between rows of one head that are in different components, from ``members`` (head, rep, n, part).

    Rows without a rare shingle in common with another component are left out first.  Of
    the others, the rows outside the head's largest component are queries and all are
    targets; both are dealt into blocks of about BLOCK_SHINGLES, and every block of
    queries meets every block of targets.
    """
    unsettled = split_join(members, _mixed(members).where("rows > 2").select("head"), ["head"], "left_semi")
    active = durable(_active(unsettled.select("rep", "part").distinct(), sets), "active")
    members = durable(members.join(active, "rep", "left_semi"), "members")
    mixed = split_join(members, _mixed(members).drop("rows"), ["head"]).withColumn("asks", F.col("part") != F.col("main"))
    own = F.xxhash64("rep")
    every = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    asking = mixed.where("asks").select("head", "rep", "part", F.explode_outer(every("targets")).alias("i"), F.pmod(own, "queries").alias("j"), F.lit(True).alias("query"), F.lit(False).alias("target"))
    taking = mixed.select("head", "rep", "part", F.pmod(own, "targets").alias("i"), F.explode_outer(every("queries")).alias("j"), F.lit(False).alias("query"), F.lit(True).alias("target"))
    both = asking.unionByName(taking).withColumn("cell", F.xxhash64("head", "i", "j"))
    cells = both.groupBy("cell", "head", "i", "j", F.col("rep").alias("id"), "part").agg(F.max("query").alias("query"), F.max("target").alias("target"))
    return sets.join(cells.hint("merge"), "id").groupBy("cell", "head", "i", "j").applyInArrow(_across, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that links (a, b) connect each node with.

    Alternating large-star and small-star steps; every step is a grouped minimum
    and a join, and writes its edges to the shared folder.
    """
    edges = durable(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        done = durable(small, "edges")
        after = state(done)
        drop(edges)
        edges = done
        if after == before:
            break
        before = after
    return edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = SHINGLE_WORDS) -> DataFrame:
    """(key, n_shingles, component_id, kept) for every row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z in lower case.  A text
    with fewer than ``words`` words is one shingle; an empty, blank or null one has
    none and is linked with nothing.  Links are symmetric and exact: 100 *
    intersection >= 80 * union of the whole sets.  A row whose key is null stays
    alone, with a null component, and is kept.  Rows repeated with one key are one
    document, which has the links of all its texts.  Keys must be integers; other
    columns are not read.
    """
    bounded_batches(docs.sparkSession)
    docs = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    prints = durable(docs.mapInArrow(_fingerprints(words), "doc_id long, n long, h1 long, h2 long, sig binary, s1 long, s2 long"), "prints")
    linked = prints.where("doc_id is not null and n > 0")
    classes = linked.groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig"), F.first("s1").alias("s1"), F.first("s2").alias("s2"))
    classes = durable(classes, "classes")
    keys = classes.select("rep", "sig").mapInArrow(_chunk_keys, "key long, rep long")
    shared = keys.groupBy("key").agg(F.min("rep").alias("head"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    met = keys.join(shared, "key").where("rep <> head").groupBy("head", "rep").agg(F.max("rows").alias("rows"))
    facts = classes.select("rep", "n", "s1", "s2")
    met = met.join(facts, "rep").join(facts.select(F.col("rep").alias("head"), F.col("n").alias("head_n"), F.col("s1").alias("head_s1"), F.col("s2").alias("head_s2")), "head")
    # a row that is unlike its head may still be like another row under the key, if there is one
    met = durable(met.select("head", "head_n", "rep", "n", "rows", _alike().alias("alike")).where("alike or rows > 2"), "met")

    needed = met.select(F.col("rep").alias("id")).union(met.select("head")).distinct()
    sets = durable(shingles_of(needed, docs, words), "sets")
    links = durable(_against_heads(met.where("alike").select(F.col("head").alias("a"), F.col("rep").alias("b")).distinct(), sets), "links")
    parts = components(links)
    members = met.select("head", "rep", "n").unionByName(met.select("head", F.col("head").alias("rep"), F.col("head_n").alias("n"))).distinct()
    members = durable(members.join(parts, F.col("rep") == F.col("node"), "left").select("head", "rep", "n", F.coalesce("component", "rep").alias("part")), "members")
    more = durable(_between_components(members, sets), "links")
    if not more.isEmpty():
        parts = components(links.unionByName(more))

    reps = classes.select("h1", "h2", F.col("n").alias("size"), "rep").join(parts, F.col("rep") == F.col("node"), "left").select(F.col("h1").alias("c1"), F.col("h2").alias("c2"), "size", F.coalesce("component", "rep").alias("home"))
    out = prints.select("doc_id", "n", "h1", "h2").join(reps, (F.col("h1") == F.col("c1")) & (F.col("h2") == F.col("c2")) & (F.col("n") == F.col("size")), "left")
    home = F.when(F.col("doc_id").isNotNull(), F.coalesce("home", "doc_id"))
    return out.select(F.col("doc_id").alias(key), F.col("n").alias("n_shingles"), home.alias("component_id"), home.eqNullSafe(F.col("doc_id")).alias("kept"))


def op9_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Components of all documents under shingles of two words."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), words=2)
