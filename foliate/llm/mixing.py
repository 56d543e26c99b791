"""Mixing sources to target weights, with DataFrame functions only.

Each source's words form one stream, cut into blocks of BLOCK_WORDS.  The mix is a
row of slots in output shards.  How many of a shard's slots each source gets is a
multinomial draw, conditioned on the sources' totals so that these stay at their
targets, and a source's n-th slot reads the block
to which a pseudorandom permutation of that source's block indexes maps n.  The
permutation is a swap-or-not shuffle: a bijection on any range, computed for each
index alone.  Every further pass over a source has a permutation of its own, so a
block is read at most once a pass.  Slots and blocks meet by a join on the index.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliate.plans.lineage import durable

WEIGHTS = (5, 2, 1)
MOST_PASSES = 3
BLOCK_WORDS = 64
SHARD_SLOTS = 4096
#: Slots of one source that one row of a plan stands for before it is dealt to a task.
RUN_SLOTS = 16_384
#: Tasks that slots are made in, at most; beyond that a task makes more runs.
MOST_TASKS = 20_000
ROUNDS = 12
SEED = 20240229
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_PASSES) -> DataFrame:
    """(source, source_size) -> with rank and target.

    Sources by code point, null last, weigh ``weights`` in turn.  Targets share the
    sum of all sizes by weight, none above ``most`` times its source's size: a
    level L is found with sum(min(most * size, L * weight)) = sum(size).  There is
    one row a source here, so windows over all rows are small.
    """
    n = len(weights)
    ranked = sizes.withColumn("rank", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("rank") % n + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size").cast("double") * most)
    order = W.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    after = order.rowsBetween(0, W.unboundedFollowing)
    whole = W.partitionBy()
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    ranked = ranked.withColumn("level", left / F.sum("weight").over(after))
    settled = F.when(F.col("cap") / F.col("weight") >= F.col("level"), F.col("level"))
    ranked = ranked.withColumn("found", F.min(F.struct(F.when(settled.isNull(), 1).otherwise(0).alias("no"), (F.col("cap") / F.col("weight")).alias("ratio"), "rank", settled.alias("level"))).over(whole)["level"])
    target = F.least("cap", F.col("found") * F.col("weight"))
    return ranked.select("source", "source_size", "rank", F.coalesce(target, F.col("cap")).alias("target"))


def permuted(index: Column, n: Column, *seeds: Column) -> Column:
    """The place of ``index`` under a pseudorandom permutation of 0 .. n - 1."""

    def swap(x: Column, i: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(*seeds, i), n) - x, n)
        heads = F.xxhash64(*seeds, i, F.greatest(x, partner)).bitwiseAND(F.lit(1)) == 1
        return F.when(heads, partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), index, swap)


def _streams(docs: DataFrame) -> DataFrame:
    """Give each row of (doc_id, source, print, size) its first word's place in its source.

    Rows are dealt into about sqrt(rows) buckets, so neither the sums over
    buckets nor the running sums within one grow with a source.
    """
    buckets = max(1, int(docs.count() ** 0.5))
    dealt = docs.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "print", F.lit(SEED)), F.lit(buckets)))
    sums = dealt.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    by_bucket = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("words").over(by_bucket), F.lit(0)).alias("base"))
    within = W.partitionBy("source", "bucket").orderBy("doc_id", "print").rowsBetween(W.unboundedPreceding, -1)
    local = dealt.withColumn("local", F.coalesce(F.sum("size").over(within), F.lit(0)))
    joined = local.join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    return joined.select("doc_id", "source", "print", "size", (F.col("base") + F.col("local")).alias("begin"))


def slots(mixed: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """(rank, pass, block, shard): which blocks the mix reads, from the table of targets.

    The mix has as many slots as its targets have blocks.  Which source a slot
    takes is drawn at random, given each source's number of slots: a permutation of
    all slots deals every source's n-th one to its place, so a shard's counts are a
    multinomial draw on the condition that the mix meets its targets.
    """
    blocks = F.ceil(F.col("source_size") / block_words).cast("long")
    wanted = F.least(F.round(F.col("target") / F.col("source_size") * blocks).cast("long"), blocks * MOST_PASSES)
    share = mixed.where("source_size > 0").select("rank", blocks.alias("blocks"), wanted.alias("wanted"))
    share = share.withColumn("before", F.coalesce(F.sum("wanted").over(W.orderBy("rank").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))  # a row a source
    total = int(share.agg(F.coalesce(F.sum("wanted"), F.lit(0))).first()[0])  # one number
    # runs of a source's slots, dealt to as many tasks as their number asks for
    runs = share.where("wanted > 0").select("rank", "blocks", "wanted", "before", F.explode_outer(F.sequence(F.lit(0).cast("long"), F.floor((F.col("wanted") - 1) / RUN_SLOTS))).alias("run"))
    runs = runs.repartition(min(MOST_TASKS, max(1, -(-total // (4 * RUN_SLOTS)))), "rank", "run")
    begin = F.col("run") * RUN_SLOTS
    slot = runs.select("rank", "blocks", "before", F.explode_outer(F.sequence(begin, F.least(begin + RUN_SLOTS, F.col("wanted")) - 1)).alias("nth"))
    slot = slot.withColumn("pass", F.floor(F.col("nth") / F.col("blocks")))
    place = permuted(F.col("before") + F.col("nth"), F.lit(total).cast("long"), F.lit(seed))
    block = permuted(F.col("nth") % F.col("blocks"), F.col("blocks"), F.lit(seed), F.col("rank"), F.col("pass"))
    return slot.select("rank", "pass", F.floor(place / shard_slots).alias("shard"), block.alias("block"))


def _read_blocks(docs: DataFrame, text: str, key: str, source: str, options: dict) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The documents' streams, the targets, and a row for each read of a part of a document."""
    block_words, shard_slots, seed = (options.get(k, v) for k, v in (("block_words", BLOCK_WORDS), ("shard_slots", SHARD_SLOTS), ("seed", SEED)))
    base = docs.select(docs[key].alias("doc_id"), docs[source].alias("source"), F.xxhash64(docs[text]).alias("print"), word_count(docs[text]).alias("size"))
    streams = durable(_streams(base), "streams")
    mixed = durable(targets(streams.groupBy("source").agg(F.sum("size").alias("source_size")), options.get("weights", WEIGHTS)), "targets")
    reads = slots(mixed, block_words, shard_slots, seed).groupBy("rank", "block", "pass").agg(F.count(F.lit(1)).alias("times"))
    parts = streams.join(mixed.select(F.col("source").alias("s"), "rank"), F.col("source").eqNullSafe(F.col("s"))).where("size > 0")
    last = F.floor((F.col("begin") + F.col("size") - 1) / block_words)
    parts = parts.withColumn("block", F.explode_outer(F.sequence(F.floor(F.col("begin") / block_words), last)))
    start = F.greatest(F.col("block") * block_words - F.col("begin"), F.lit(0))
    end = F.least((F.col("block") + 1) * block_words - F.col("begin"), F.col("size"))
    parts = parts.select("doc_id", "print", "rank", "begin", "size", "block", start.alias("start"), (end - start).alias("words"))
    # both sides grow with the corpus, though the plan sees only the small table that the reads are drawn from
    return streams, mixed, parts.join(reads.hint("merge"), ["rank", "block"])


def mix_sources(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", **options) -> DataFrame:
    """(key, source, size, source_size, target, taken) for every row of ``docs``.

    ``taken`` counts the words that the mix reads of the row, repeats included; it is
    at most MOST_PASSES times the size.  A null or blank text has no words and is
    never read.  Null sources are one source, the last.  Repeated rows are rows of
    their own in the stream.  The result depends on the rows' contents only.
    Options: weights, block_words, shard_slots, seed.
    """
    streams, mixed, reads = _read_blocks(docs, text, key, source, options)
    taken = reads.groupBy("rank", "begin").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    out = streams.join(mixed.select(F.col("source").alias("s"), "source_size", "rank", "target"), F.col("source").eqNullSafe(F.col("s")))
    out = out.join(taken.select(F.col("rank").alias("r"), F.col("begin").alias("b"), "taken"), (F.col("size") > 0) & (F.col("rank") == F.col("r")) & (F.col("begin") == F.col("b")), "left")
    return out.select(F.col("doc_id").alias(key), F.col("source").alias(source), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", **options) -> DataFrame:
    """The mix as documents: a row of ``docs`` for each pass that reads words of it.

    ``text`` holds the words read, with the white space after each, in the
    document's order; a document read whole in a pass is unchanged.  Rows that are
    never read are left out, as are rows without words.
    """
    block_words = options.get("block_words", BLOCK_WORDS)
    _, _, reads = _read_blocks(docs, text, key, source, options)
    wanted = reads.groupBy("doc_id", "print", "begin", "size", "pass").agg(F.sort_array(F.collect_list((F.col("block") - F.floor(F.col("begin") / block_words)).cast("int"))).alias("parts"), F.sum("words").alias("read"))
    # rows repeated alike share doc_id and print: the n-th of them reads the n-th stream
    wanted = wanted.withColumn("nth", F.dense_rank().over(W.partitionBy("doc_id", "print").orderBy("begin")))
    wanted = wanted.select("doc_id", F.col("print").alias("p"), F.col("nth").alias("n"), F.pmod("begin", F.lit(block_words)).cast("int").alias("skip"), "size", "parts", "read")
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns if c != text)).alias("row"), docs[key].alias("key"), docs[text].alias("text"), F.xxhash64(docs[text]).alias("print"))
    rows = rows.withColumn("nth", F.row_number().over(W.partitionBy("key", "print").orderBy(F.lit(1))))
    out = rows.join(wanted, F.col("key").eqNullSafe(F.col("doc_id")) & (F.col("print") == F.col("p")) & (F.col("nth") == F.col("n")))
    # words that stand for those before the text in its first block make every block begin at a multiple of block_words
    before = F.repeat(F.lit("x "), F.col("skip"))
    cut = F.regexp_extract_all(F.concat(before, F.regexp_replace("text", r"^[\x20\x09-\x0D]+", "")), F.lit(rf"(?:[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+){{1,{block_words}}}"), F.lit(0))
    # the lambda's argument is evaluated once, however many parts are taken from it
    taken = F.transform(F.array(cut), lambda blocks: F.array_join(F.transform("parts", lambda i: F.when(i == 0, F.substr(F.get(blocks, i), 2 * F.col("skip") + 1)).otherwise(F.get(blocks, i))), ""))
    new = F.when(F.col("read") < F.col("size"), F.get(taken, F.lit(0))).otherwise(F.col("text"))
    return out.select(*(new.alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns))


def op4_mixing(spark, sf_dir: str) -> DataFrame:
    """How often the mix reads each document."""
    return mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")).drop("source")
