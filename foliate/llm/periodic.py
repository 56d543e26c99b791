"""Runs of words with a period, found in tiles of every period octave.

For periods from P to 2P - 1 a run holds so many words that at least one of the
boundaries at every STEP words lies in it with half a step of repeated words before
or after.  Each boundary is the centre of a tile that reaches one step to both
sides (and 2P further).  Boundaries where no half step comes again at a distance of
the octave cannot be in a run; they are told by hashes of whole blocks, which array
operations compare for all boundaries of a batch of texts at once, and no tile is made for them.

Tiles are rows: they are dealt over tasks whatever text they come from, and each is
solved alone.  Z-functions from the boundary onward and back tell for each
period how far the text agrees with itself.  Such pieces are shuffled by document and period and
stitched where they touch; what is long enough is a run.  Texts without any tile
are complete after the first step, and neither they nor their words are shuffled.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliate.llm.textarrays import bounded_batches, find_words, mix, power, spans, utf8
from foliate.plans.lineage import durable

LEAST_LENGTH = 12  # words of a run, and at least twice its period
BATCH_BYTES = 1 << 20
TILES = "octave int, left int, words binary, start long, periods array<int>"


def step(octave: int) -> int:
    """Words from boundary to boundary for the periods octave .. 2 * octave - 1.

    Words that agree with those a period on number max(period, LEAST_LENGTH - period) at least in a run.
    """
    return octave if octave >= 8 else 8 if octave < 4 else 4


def _smallest_factors(most: int) -> np.ndarray:
    """The smallest prime factor of every number up to ``most``."""
    least = np.arange(most + 1)
    for p in range(2, int(most**0.5) + 1):
        if least[p] == p:
            multiple = least[p * p :: p]
            multiple[multiple == np.arange(p * p, most + 1, p)] = p
    return least


class _Blocks:
    """Hashes of stretches of a sequence of word hashes."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * power("up", len(hashes))[: len(hashes)], out=self.sums[1:])
        self.down = power("down", len(hashes) + 1)

    def at(self, where: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        """A value for the ``length`` hashes from ``where`` on, equal for equal stretches."""
        return (self.sums[where + length] - self.sums[where]) * self.down[where]


def _roots(blocks: _Blocks, at: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which of the stretches of ``period`` words from ``at`` on are no power of a shorter one."""
    if not len(at):
        return np.zeros(0, bool)
    factors = _smallest_factors(int(period.max()))
    root, left = period.copy(), period.copy()
    while (left > 1).any():
        p = np.where(left > 1, factors[left], 1)
        shorter = np.where(p > 1, root // p, root)
        same = (p > 1) & (blocks.at(at, period - shorter) == blocks.at(at + shorter, period - shorter))
        root = np.where(same, shorter, root)
        left = left // p
    power_of = np.flatnonzero(root < period)
    ok = np.ones(len(at), bool)
    for d in np.unique(root[power_of]):  # blocks agree by hash; what leaves a period out must hold word by word
        differ = np.zeros(len(blocks.hashes) + 1, np.int64)
        np.cumsum(blocks.hashes[d:] != blocks.hashes[:-d], out=differ[1 : len(blocks.hashes) - d + 1])
        mine = power_of[root[power_of] == d]
        ok[mine] = differ[at[mine] + period[mine] - d] != differ[at[mine]]
    return ok


def _pairs(blocks: _Blocks, octave: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(boundary, period) where half a step before or after the boundary comes again a period on."""
    every, half = step(octave), step(octave) // 2
    value = blocks.at(np.arange(size - half + 1), half)
    found = [np.zeros(0, np.int64)]
    for back in (0, half):
        bounds = np.arange(every if back else 0, size - half + back + 1, every)
        own = value[bounds - back]
        if every == octave:  # the places compared with one boundary end where those of the next begin
            rest = value[bounds[0] - back + octave :]
            same = np.flatnonzero(rest == np.repeat(own, octave)[: len(rest)])
            found.append(bounds[same // octave] * (2 * octave) + same % octave + octave)
        else:
            for q in range(octave, 2 * octave):
                inside = bounds[bounds - back + q + half <= size]
                same = inside[value[inside - back] == value[inside - back + q]]
                found.append(same * (2 * octave) + q)
    both = np.unique(np.concatenate(found))
    return both // (2 * octave), both % (2 * octave)


def candidate_tiles(hashes: np.ndarray, row: np.ndarray) -> Iterator[tuple[int, int, int, np.ndarray, int, np.ndarray]]:
    """(row, octave, words before the boundary, words, first word, periods) of every tile with a candidate.

    Words are given as small numbers, equal within a tile where the hashes are.
    """
    counts = np.bincount(row, minlength=int(row[-1]) + 1 if len(row) else 0)
    octave = 1
    while True:
        of = np.flatnonzero(counts >= max(2 * octave, LEAST_LENGTH))
        if not len(of):
            return
        mine = np.flatnonzero(np.isin(row, of)) if len(of) < len(counts) else np.arange(len(row))
        owner, word = row[mine], hashes[mine]
        # a text's last word is followed by one that occurs nowhere else
        ends = np.flatnonzero(np.append(owner[1:] != owner[:-1], True)) + 1
        line = np.insert(word, ends, mix(owner[ends - 1].astype(np.uint64) + np.uint64(0xD1B54A32D192ED03)))
        shift = np.repeat(np.arange(len(ends)), np.diff(np.append(0, ends)) + 1)  # of each place in ``line``, the text's number here
        first = np.append(0, ends[:-1]) + np.arange(len(ends))  # of each text, its first place in ``line``
        last = ends + np.arange(len(ends))
        blocks = _Blocks(line)
        at, period = _pairs(blocks, octave, len(line))
        text = shift[at]
        whole = (at < last[text]) & (at + period < last[text] + 1)
        at, period, text = at[whole], period[whole], text[whole]
        primitive = _roots(blocks, at, period)
        at, period, text = at[primitive], period[primitive], text[primitive]
        edges = np.flatnonzero(np.diff(at, prepend=-1, append=-1)).tolist() if len(at) else []
        for a, b in pairwise(edges):
            t, mid = text[a], int(at[a])
            low = max(int(first[t]), mid - step(octave))
            high = min(int(last[t]), mid + step(octave) + 2 * octave)
            words = np.unique(line[low:high], return_inverse=True)[1].astype("<i4")
            yield int(owner[ends[t] - 1]), octave, mid - low, words, low - int(first[t]), period[a:b].astype(np.int32)
        octave *= 2


def z_function(s: list[int]) -> list[int]:
    """For each place of ``s`` how many values from there on equal those from its beginning on."""
    n, z, left, right = len(s), [0] * len(s), 0, 0
    if n:
        z[0] = n
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def solve_tile(octave: int, left: int, words: list[int], periods: list[int], start: int) -> list[tuple[int, int, int]]:
    """(period, begin, end) of the stretches at the boundary whose words agree with those a period on, if a run may hold them.

    ``left`` words lie before the boundary.  Stretches end a step from the
    boundary at most; one that ends there may go on in the next tile.
    """
    reach = step(octave)
    on = z_function(words[left:])
    before = words[:left][::-1]
    # matched against the whole tile backwards: what precedes the boundary, then a mark that equals nothing
    back = z_function([*before, -1, *words[::-1]])[left + 1 :]
    found = []
    for q in periods:
        if left + q > len(words):
            continue
        ahead = min(on[q], reach) if q < len(on) else 0
        behind = min(back[len(words) - left - q], left)
        if ahead >= reach or behind >= reach or ahead + behind >= max(q, LEAST_LENGTH - q):
            found.append((q, start + left - behind, start + left + ahead))
    return found


def _prepared(change: Callable | None) -> Callable:
    """Arrow function: (row, key, text) -> the words' number, hash and, where a tile was made, the words and the tiles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = utf8(batch.column(2))
            for i, j in spans(offsets, BATCH_BYTES):
                at = offsets[i : j + 1] - offsets[i]
                part = raw[offsets[i] : offsets[j]]
                hashes, row, _, _ = find_words(part, at, lower=False)
                keys = batch.column(1).slice(i, j - i).to_pylist()
                bounds = np.searchsorted(row, np.arange(j - i + 1))
                texts = [part[at[k] : at[k + 1]].tobytes().split() for k in range(j - i)]  # bytes.split cuts at the same six characters
                for k, key in enumerate(keys):
                    order = change(key, len(texts[k])) if change else None
                    if order is not None:
                        hashes[bounds[k] : bounds[k + 1]] = hashes[bounds[k] : bounds[k + 1]][order]
                        texts[k] = [texts[k][o] for o in order.tolist()]
                tiles: list[list[dict]] = [[] for _ in keys]
                for r, octave, left, words, start, periods in candidate_tiles(hashes, row):
                    tiles[r].append({"octave": octave, "left": left, "words": words.tobytes(), "start": start, "periods": periods})
                bodies = [b" ".join(t) for t in texts]
                kind = pa.list_(pa.struct([("octave", pa.int32()), ("left", pa.int32()), ("words", pa.binary()), ("start", pa.int64()), ("periods", pa.list_(pa.int32()))]))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, j - i),
                        batch.column(1).slice(i, j - i),
                        pa.array([hashlib.sha256(b).hexdigest() for b in bodies]),
                        pa.array([b.decode() if t else None for b, t in zip(bodies, tiles, strict=True)], pa.string()),
                        pa.array(tiles, kind),
                    ],
                    ["row", "key", "sha", "body", "tiles"],
                )

    return run


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow function: tiles -> (row, period, begin, end)."""
    for batch in batches:
        rows, found = [], []
        for row, octave, left, words, start, periods in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            got = solve_tile(octave, left, np.frombuffer(words, "<i4").tolist(), periods, start)
            found += got
            rows += [row] * len(got)
        columns = list(zip(*found, strict=True)) or [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), *(pa.array(c, pa.int64()) for c in columns)], ["row", "period", "begin", "end"])


def stitched(pieces: DataFrame) -> DataFrame:
    """(row, start, length, period) of the runs that ``pieces`` (row, period, begin, end) make where they touch."""
    before = Window.partitionBy("row", "period").orderBy("begin", "end").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("row", "period").orderBy("begin", "end").rowsBetween(Window.unboundedPreceding, 0)
    marked = pieces.withColumn("reach", F.max("end").over(before)).withColumn("new", F.when(F.col("reach") >= F.col("begin"), 0).otherwise(1))
    numbered = marked.withColumn("piece", F.sum("new").over(upto))
    whole = numbered.groupBy("row", "period", "piece").agg(F.min("begin").alias("start"), F.max("end").alias("end"))
    whole = whole.select("row", "start", (F.col("end") - F.col("start") + F.col("period")).alias("length"), "period")
    return whole.where(F.col("length") >= F.greatest(F.lit(LEAST_LENGTH), 2 * F.col("period")))


def _collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow function: words and runs -> the words without repeats, joined."""
    for batch in batches:
        for i, j in spans(utf8(batch.column(1))[1], BATCH_BYTES):
            out = []
            for body, runs in zip(batch.column(1).slice(i, j - i).to_pylist(), batch.column(2).slice(i, j - i), strict=True):
                words = body.split(" ")
                turn = np.zeros(len(words) + 1, np.int64)
                start, length, period = (np.asarray(runs.values.field(f)) for f in ("start", "length", "period"))
                np.add.at(turn, start + period, 1)
                np.add.at(turn, start + length, -1)
                stays = np.cumsum(turn)[:-1] == 0
                out.append(" ".join([w for w, s in zip(words, stays.tolist(), strict=True) if s]))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), pa.array(out)], ["row", "runs", "collapsed"])


_RUNS = "array<struct<start:bigint,period:bigint,length:bigint>>"


def periodic_runs(docs: DataFrame, text: str = "text", key: str = "doc_id", change: Callable | None = None) -> DataFrame:
    """(key, runs, collapsed, collapsed_sha256) for every row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+``.  A run is a stretch of words with a smallest
    period q (words q apart are identical) and a length of at least LEAST_LENGTH and 2 * q that
    keeps its period no longer when a neighbouring word is added.  runs are sorted by start, then
    period.  collapsed are the words that no run holds after its first period, joined by
    a blank, for texts with runs (null for others, whose words all stay);
    collapsed_sha256 is that of the words that stay in any text.

    ``change`` gives, for a key and a number of words, the order in which words are
    taken (an array of as many word numbers) or None for their own.  A null text has no words.
    Keys are passed on, null and repeated ones too: every row is a text of its
    own.  Other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), docs[key].alias("key"), docs[text].cast("string").alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    made = durable(rows.mapInArrow(_prepared(change), f"row long, key {kind}, sha string, body string, tiles array<struct<{TILES.replace(', ', ',').replace(' ', ':')}>>"), "tiles")
    tiles = made.where(F.size("tiles") > 0).select("row", F.explode("tiles").alias("tile")).select("row", "tile.*")
    dealt = tiles.repartition("row", "octave", "start").select("row", "octave", "left", "words", "start", "periods")  # a long text's tiles go to many tasks
    runs = stitched(dealt.mapInArrow(_solved, "row long, period long, begin long, end long"))
    by_row = runs.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    bodies = made.where(F.col("body").isNotNull()).select("row", "body").join(by_row, "row").mapInArrow(_collapsed, f"row long, runs {_RUNS}, collapsed string")
    out = made.select("row", "key", "sha").join(bodies, "row", "left")
    return out.select(
        F.col("key").alias(key), F.coalesce("runs", F.array().cast(_RUNS)).alias("runs"), "collapsed", F.coalesce(F.sha2(F.col("collapsed").cast("binary"), 256), "sha").alias("collapsed_sha256")
    )


def planted_order(key: int | None, n: int) -> np.ndarray | None:
    """The order that the contract of op13 gives the ``n`` words of a document: a tenth of them end in a period."""
    h = zlib.crc32(str(key).encode()) if key is not None else 1
    g = h // 10
    if h % 10 or not n:
        return None
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


def op13_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """All documents with their runs: how many, the longest, and digests of all and of the text without repeats."""
    found = periodic_runs(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), change=planted_order)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("under"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listing = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    found = found.withColumn("best", longest).withColumns({"start": -F.col("best.before"), "length": F.col("best.length"), "period": -F.col("best.under")})
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "start",
        "length",
        "period",
        F.expr("(1000 * length) div period").alias("exponent_milli"),
        F.sha2(listing.cast("binary"), 256).alias("runs_sha256"),
        "collapsed_sha256",
    )
