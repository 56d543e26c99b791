"""Language identification, word first: known words by their log frequency in each
language, others by the longest character n-grams that are known.

Words and n-grams are counted by Spark.  A model holds at most ``max_words`` words and
``max_grams`` n-grams of each language, each with its count in the languages that chose it, so
it grows with the number of languages and is broadcast.  In a task the words of a
block of texts are hashed on its Arrow buffer, each different word is looked up once, and
a text's score is the sum over its words.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliate.llm.textarrays import bounded_batches, find_words, joined, spans, utf8
from foliate.plans.lineage import durable

#: The bounded sample that the classifier is fitted on, in documents of each language.
MAX_TRAIN = 4000
#: The bounded size of the model, in words and n-grams of each language.
MAX_WORDS, MAX_GRAMS = 20_000, 20_000
LONGEST = 4
SMOOTHING = 0.5
UNKNOWN = "und"
_CELLS = 1 << 20  # words or texts times languages at once
_LETTER = re.compile(r"[^\W\d_]")
#: ASCII that is not a letter separates words; other bytes belong to them.
_GAP = np.array([c < 128 and not chr(c).isalpha() for c in range(256)])
_ASCII_LETTER = np.array([c < 128 and chr(c).isalpha() for c in range(256)])
_OPEN, _CLOSE = ord("<"), ord(">")


def _framed(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of ``<word>`` for all words in a row, and the number of the word at each."""
    codes = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le"), "<u4").astype(np.uint64)
    return codes, np.cumsum(codes == _OPEN) - 1


def _sums(values: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """The sum of the rows of ``values`` in each group; groups are in order."""
    out = np.zeros((groups, values.shape[1]))
    if len(group):
        first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        out[group[first]] = np.add.reduceat(values, first, axis=0)
    return out


class _Table:
    """Smoothed log frequencies of one kind of entry: those that are held, and each language's of an entry that it lacks."""

    def __init__(self, hashes: np.ndarray, column: np.ndarray, n: np.ndarray, langs: int):
        self.keys, entry = np.unique(hashes, return_inverse=True)
        order = np.argsort(entry, kind="stable")
        total = np.bincount(column, weights=n, minlength=langs) + SMOOTHING * max(1, len(self.keys))
        self.column, self.held = column[order], np.log((n + SMOOTHING) / total[column])[order]
        self.start = np.searchsorted(entry[order], np.arange(len(self.keys) + 1))
        self.base = np.log(SMOOTHING / total)

    def rows(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``hashes`` are known, and the log frequencies of these in every language."""
        at = np.searchsorted(self.keys, hashes)
        at[at == len(self.keys)] = 0
        known = np.flatnonzero(self.keys[at] == hashes) if len(self.keys) else np.zeros(0, np.int64)
        at = at[known]
        many = self.start[at + 1] - self.start[at]
        ends = np.cumsum(many)
        take = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - many - self.start[at], many)
        out = np.tile(self.base, (len(at), 1))
        out[np.repeat(np.arange(len(at)), many), self.column[take]] = self.held[take]
        return known, out


class Model:
    """Log frequencies of words, and of n-grams of each length, in each language."""

    def __init__(self, langs: list[str], word_counts: Iterable[tuple[str, str, int]], gram_counts: Iterable[tuple[str, str, int]], longest: int = LONGEST):
        self.langs, self.longest = langs, longest
        column = {lang: i for i, lang in enumerate(langs)}
        words, grams = (list(zip(*counts, strict=True)) or [(), (), ()] for counts in (list(word_counts), list(gram_counts)))
        place = lambda rows: (np.array([column[x] for x in rows[1]], np.int64), np.array(rows[2], float))
        self.words = _Table(self._hashes(list(words[0])), *place(words), len(langs))
        length = np.array([len(g) for g in grams[0]], np.int64)
        where, n = place(grams)
        self.grams = {}
        for k in range(1, longest + 1):
            mine = np.flatnonzero(length == k)
            codes = np.frombuffer("".join(grams[0][i] for i in mine).encode("utf-32-le"), "<u4").astype(np.uint64)
            self.grams[k] = _Table(joined(codes, k)[::k], where[mine], n[mine], len(langs))

    @staticmethod
    def _hashes(words: list[str]) -> np.ndarray:
        return find_words(*utf8(pa.array(words, pa.string())), lower=False, gap=_GAP)[0]

    def backoff(self, words: list[str]) -> np.ndarray:
        """For each word the mean over its known n-grams of the greatest length that has any; zeros without one."""
        out = np.zeros((len(words), len(self.langs)))
        left = np.arange(len(words))
        for k in range(self.longest, 0, -1):
            if not len(left):
                break
            codes, word = _framed([words[i] for i in left.tolist()])
            grams = joined(codes, k)
            within = np.flatnonzero(word[: len(grams)] == word[k - 1 :]) if len(grams) else np.zeros(0, np.int64)
            known, rows = self.grams[k].rows(grams[within])
            of = word[within[known]]
            found = np.bincount(of, minlength=len(left))
            some = np.flatnonzero(found)
            out[left[some]] = _sums(rows, of, len(left))[some] / found[some][:, None]
            left = left[found == 0]
        return out

    def block_bytes(self) -> int:
        """Bytes of text that are scored at once."""
        return max(1 << 14, _CELLS // max(1, len(self.langs)) * 2)

    def scores(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The likeliest language (its number, -1 if unknown) of each lower-case text, and its probability."""
        n = len(offsets) - 1
        hashes, row, begin, end = find_words(raw, offsets, lower=False, gap=_GAP)
        letters = np.concatenate([[0], np.cumsum(_ASCII_LETTER[raw])])
        known = letters[offsets[1:]] > letters[offsets[:-1]]
        for i in np.flatnonzero(~known & (np.diff(offsets) > 0)).tolist():
            known[i] = bool(_LETTER.search(raw[offsets[i] : offsets[i + 1]].tobytes().decode(errors="replace")))
        count = np.bincount(row, minlength=n)
        known &= (count > 0) & bool(self.langs)
        best, odds = np.full(n, -1), np.zeros(n)
        if not known.any():
            return best, odds
        different, first, at = np.unique(hashes, return_index=True, return_inverse=True)
        value = np.zeros((len(different), len(self.langs)))
        found, rows = self.words.rows(different)
        value[found] = rows
        unseen = np.setdiff1d(np.arange(len(different)), found)
        text = raw.tobytes()
        value[unseen] = self.backoff([text[a:b].decode(errors="replace") for a, b in zip(begin[first[unseen]].tolist(), end[first[unseen]].tolist(), strict=True)])
        total = _sums(value[at], row, n) / np.sqrt(np.maximum(count, 1))[:, None]
        likely = np.exp(total - total.max(axis=1)[:, None])
        best[known] = likely.argmax(axis=1)[known]
        odds[known] = (likely.max(axis=1) / likely.sum(axis=1))[known]
        return best, odds

    def score(self, text: str) -> tuple[str, float]:
        """The likeliest language of one text and its probability."""
        (best,), (odds,) = self.scores(*utf8(pa.array([text.lower()], pa.string())))
        return (self.langs[best] if best >= 0 else UNKNOWN), float(odds)


def remainder(key: Column, by: int) -> Column:
    """crc32 of the key as text, modulo ``by``; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % by


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow function: (lang, lower-case text) -> (lang, word, n) of a block of texts."""
    for batch in batches:
        raw, offsets = utf8(batch.column(1))
        langs = batch.column(0).dictionary_encode()
        column, names = langs.indices.to_numpy(), langs.dictionary
        for i, j in spans(offsets, 1 << 20):
            part = raw[offsets[i] : offsets[j]]
            hashes, row, begin, end = find_words(part, offsets[i : j + 1] - offsets[i], lower=False, gap=_GAP)
            of = column[i:j][row]
            order = np.lexsort((hashes, of))
            new = np.flatnonzero(np.diff(hashes[order], prepend=~hashes[order[:1]]).astype(bool) | np.diff(of[order], prepend=-1).astype(bool)) if len(order) else np.zeros(0, np.int64)
            n, text = np.diff(np.append(new, len(order))), part.tobytes()
            word = [text[a:b].decode(errors="replace") for a, b in zip(begin[order[new]].tolist(), end[order[new]].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([names.take(pa.array(of[order[new]])), pa.array(word, pa.string()), pa.array(n)], ["lang", "word", "n"])


def fit(
    docs: DataFrame, text: str = "text", lang: str = "lang", max_train: int = MAX_TRAIN, key: str = "doc_id", max_words: int = MAX_WORDS, max_grams: int = MAX_GRAMS, longest: int = LONGEST
) -> Model:
    """Learn from ``docs`` with a language and a text: about ``max_train`` rows of each language, chosen by a hash of their key and text.

    Rows repeated alike are chosen alike, null keys too; other columns are not
    read.  The model holds each language's ``max_words`` most frequent words and
    ``max_grams`` most frequent n-grams of the sample.  Without a
    row to learn from, every prediction is UNKNOWN.
    """
    bounded_batches(docs.sparkSession)
    known = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text"), docs[lang].cast("string").alias("lang")).where("lang is not null and text is not null")
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}  # a row a language
    if not sizes:
        return Model([], [], [])
    share = F.create_map(*(F.lit(x) for name, n in sorted(sizes.items()) for x in (name, min(1.0, max_train / n))))
    sample = known.where(F.pmod(F.xxhash64("key", "text", F.lit(3)), F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30)).select("lang", F.lower("text"))
    counts = durable(sample.mapInArrow(_counted, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    framed = F.concat(F.lit("<"), F.col("word"), F.lit(">"))

    def places(n: int) -> Column:
        """All n-grams of a framed word."""
        begins = F.when(F.char_length(framed) >= n, F.sequence(F.lit(1), F.char_length(framed) - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(begins, lambda i: F.substring(framed, i, F.lit(n)))

    grams = counts.select("lang", "n", F.explode(F.flatten(F.array(*(places(n) for n in range(1, longest + 1))))).alias("gram"))
    grams = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n"))

    def top(table: DataFrame, entry: str, most: int) -> list[tuple[str, str, int]]:
        """Each language's ``most`` most frequent entries, with their counts in it."""
        first = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), entry))
        rows = table.withColumn("first", first).where(F.col("first") <= most).select(entry, "lang", "n").toArrow()  # at most ``most`` rows a language
        return sorted(zip(*(c.to_pylist() for c in rows.columns), strict=True))

    return Model(sorted(sizes), top(counts, "word", max_words), top(grams, "gram", max_grams), longest)


def predict(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, lang_pred, score) of every whole text; null, or without a letter: UNKNOWN and 0.

    Keys are passed on, null and repeated ones too; other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = pa.array([*model.langs, UNKNOWN])
        for batch in batches:
            raw, offsets = utf8(batch.column(1))
            for i, j in spans(offsets, model.block_bytes()):
                best, odds = model.scores(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), names.take(pa.array(best % len(names))), pa.array(odds)], ["key", "lang_pred", "score"])

    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(docs[key].alias("key"), F.lower(docs[text].cast("string")).alias("text")).mapInArrow(run, f"key {kind}, lang_pred string, score double")
    return out.withColumnRenamed("key", key)


def op3_language_id(spark, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    out = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))  # a row without a key is not held out
    model = fit(docs.where(~out))
    return predict(docs, model).select("doc_id", out.alias("held_out"), "lang_pred", "score")
