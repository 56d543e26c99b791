"""Token counts: texts are encoded inside Arrow functions, only lengths leave them.

Batches hold about the same number of bytes, and a long text is split where no
token can cross: before white space that follows another character, and after a
Han, kana or Hangul letter before punctuation.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliate.llm.textarrays import bounded_batches, spans, utf8

BATCH_BYTES = 1 << 20
PIECE_CHARS = 1 << 16
TOKEN_LIMIT = 1024
#: The vocabulary whose split pattern is known, so that long texts can be cut without changing their tokens.
SPLITTABLE = "byte_bpe_50k.json"
MOST_RUN = 2000
#: Characters for which both libraries split texts alike (checked by a test); a
#: text with any other goes to the vocabulary's own library.
_COMMON = re.compile(r"[\x00-ʯ̀-ͯ‐-‧‰-⁞₠-₿]*")
#: A run of white space or of anything else, found in one pass.
_RUN = re.compile(rf"(?<!\s)\s{{{MOST_RUN},}}+|(?<!\S)\S{{{MOST_RUN},}}+")
#: Between a character that isn't white space and a blank, tab or line end, or between a kana, Han or Hangul letter and the punctuation after it.
_SAFE = re.compile(r"(?<=\S)(?=[ \t\r\n])|(?<=[ぁ-ゖァ-ヺ一-龥가-힣])(?=[、。，！？；：])")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """The place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def encoder(name: str):
    """A function text -> array of ids as the vocabulary's own library gives them.

    Texts of any length and content are encoded.  ``byte_bpe_50k.json`` also exists
    as ranks for a faster library with the same merges, split pattern and special
    token; it encodes the texts on which both agree.  Texts with other characters or
    with a run of over MOST_RUN characters, where the faster one would exhaust its
    stack or slow down, go to the own library, as do all texts of other vocabularies.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if name.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=vocabulary(name))
        return lambda text: np.asarray(model.encode(text, num_threads=1), np.uint32)
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(vocabulary(name))

    def exact(text: str) -> np.ndarray:
        return np.asarray(own.encode(text, add_special_tokens=False).ids, np.uint32)

    if name != SPLITTABLE:
        return exact
    import public_tokenizers
    import tiktoken

    with open(vocabulary("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    special = {"<|endoftext|>": len(ranks)}
    fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(text: str) -> np.ndarray:
        if (text.isascii() or _COMMON.fullmatch(text)) and not (len(text) > MOST_RUN and _RUN.search(text)):
            return fast.encode_to_numpy(text, allowed_special="all")
        return exact(text)

    return encode


def pieces(text: str, most: int = PIECE_CHARS) -> Iterator[str]:
    """``text`` in parts of about ``most`` characters whose tokens are those of the whole.

    The split pattern of SPLITTABLE never puts white space behind another character
    into one token, nor a letter before punctuation; its special token holds
    neither white space nor such letters as are asked for here.  A text without
    such a place is one part.
    """
    begin = 0
    while len(text) - begin > most:
        place = _SAFE.search(text, begin + most)
        if place is None:
            break
        yield text[begin : place.start()]
        begin = place.start()
    yield text[begin:]


def token_ids(name: str):
    """A function text -> all ids of the whole text, null as the empty one; encoded in parts where that is safe."""
    encode = encoder(name)

    def run(text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        if name != SPLITTABLE or len(text) <= PIECE_CHARS:
            return encode(text)
        return np.concatenate([encode(x) for x in pieces(text)])

    return run


def token_counts(docs: DataFrame, text: str = "text", key: str = "doc_id", name: str = SPLITTABLE, limit: int = TOKEN_LIMIT) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of every text.

    Null counts as the empty text (0 bytes, 0 tokens).  Keys are passed on as
    they are, null and repeated ones too; other columns are not read.  A text that
    has no safe place to be cut, such as millions of blanks, is encoded whole, at
    about 200 bytes of memory a character.
    """
    bounded_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, split = encoder(name), name == SPLITTABLE
        for batch in batches:
            raw, offsets = utf8(batch.column(1))
            for i, j in spans(offsets, BATCH_BYTES):
                texts = batch.column(1).slice(i, j - i).to_pylist()
                counts = [0 if not t else sum(len(encode(x)) for x in pieces(t)) if split and len(t) > PIECE_CHARS else len(encode(t)) for t in texts]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(np.diff(offsets[i : j + 1])), pa.array(counts, pa.int64())], ["key", "n_bytes", "n_tokens"])

    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text")).mapInArrow(count, f"key {kind}, n_bytes bigint, n_tokens bigint")
    return out.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op5_token_counts(spark, sf_dir: str) -> DataFrame:
    """Token counts of all documents."""
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
