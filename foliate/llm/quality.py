"""Quality scores by attention-based multiple-instance learning.

A document is a bag of passages of about PASSAGE bytes.  Each passage is encoded
from its bytes (classes, hashed pairs of bytes, repeated words); gated attention
weighs the encodings and a logistic unit scores their weighted mean.  Only
document labels are needed to fit it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from foliate.llm.langid import remainder
from foliate.llm.textarrays import bounded_batches, spans, utf8, word_hashes

PASSAGE = 1024
PAIRS, HIDDEN, GATE = 64, 16, 8
#: The bounded sample that the classifier is fitted on: labelled documents, and passages of each.
MAX_TRAIN, MAX_PASSAGES = 4000, 32
STEPS, RATE, SEED = 200, 0.02, 7
THRESHOLD = 0.3
BATCH_BYTES = 2 << 20
#: Byte classes: other ASCII 0, lower 1, upper 2, digit 3, blank 4, line end 5, full stop 6, comma 7, bar 8, symbols 9, exclamation 10, beyond ASCII 11.
_CLASS = np.zeros(256, np.int64)
for _name, _bytes in enumerate((b"", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r", b".", b",", b"|", b"%&*#$@^~<>{}[]\\_=", b"!", bytes(range(128, 256)))):
    _CLASS[list(_bytes)] = _name
CLASSES = 12
FEATURES = CLASSES + PAIRS + 3


def encode_passages(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage of every row, and each row's first passage (n + 1 entries).

    A row has as many equal passages as it begins PASSAGE bytes, at least one.
    """
    sizes = np.diff(offsets)
    counts = np.maximum(1, -(-sizes // PASSAGE))
    first = np.concatenate([[0], np.cumsum(counts)])
    owner = np.repeat(np.arange(len(sizes)), counts)
    rank = np.arange(first[-1]) - first[owner]
    edges = np.append(offsets[:-1][owner] + sizes[owner] * rank // counts[owner], offsets[-1])
    total = len(edges) - 1
    length = np.maximum(np.diff(edges), 1)[:, None]
    home = np.repeat(np.arange(total), np.diff(edges))
    kinds = np.bincount(home * CLASSES + _CLASS[raw], minlength=total * CLASSES).reshape(total, CLASSES) / length
    pair = (raw[:-1].astype(np.int64) * 31 + raw[1:]) % PAIRS
    pairs = np.bincount(home[:-1] * PAIRS + pair, minlength=total * PAIRS).reshape(total, PAIRS) / length
    words, at = word_hashes(raw, edges)
    n = np.bincount(at, minlength=total)
    again = np.bincount(at[1:][(words[1:] == words[:-1]) & (at[1:] == at[:-1])], minlength=total) / np.maximum(n, 1)
    rest = np.stack([again, length[:, 0] / np.maximum(n, 1) / 16, np.log1p(np.diff(edges)) / 8], axis=1)
    return np.concatenate([kinds, pairs, rest], axis=1).astype(np.float32), first


class Attention:
    """Gated attention over passages: a_k ~ exp(w (tanh(V h_k) * sigmoid(U h_k)))."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, base: float):
        rng = np.random.default_rng(SEED)
        self.mean, self.scale = mean, scale
        shapes = {"W": (FEATURES, HIDDEN), "b": (HIDDEN,), "V": (HIDDEN, GATE), "U": (HIDDEN, GATE), "w": (GATE,), "c": (HIDDEN,), "d": ()}
        self.p = {k: rng.normal(0, 1 / np.sqrt(max(1, s[0] if s else 1)), s) for k, s in shapes.items()}
        self.p["b"][:] = 0
        self.p["d"] = np.array(base)

    def forward(self, features: np.ndarray, first: np.ndarray) -> dict:
        x = (features - self.mean) / self.scale
        p = self.p
        h = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        logit = (t * s) @ p["w"]
        owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
        e = np.exp(logit - np.maximum.reduceat(logit, first[:-1])[owner])
        a = e / np.add.reduceat(e, first[:-1])[owner]
        z = np.add.reduceat(h * a[:, None], first[:-1])
        return {"x": x, "h": h, "t": t, "s": s, "a": a, "z": z, "owner": owner, "y": 1 / (1 + np.exp(-(z @ p["c"] + p["d"])))}

    def score(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        return self.forward(features, first)["y"]

    def train(self, features: np.ndarray, first: np.ndarray, labels: np.ndarray) -> None:
        """Adam on the mean logistic loss of the documents."""
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        for step in range(1, STEPS + 1):
            f, p = self.forward(features, first), self.p
            dy = (f["y"] - labels) / len(labels)
            dz = dy[:, None] * p["c"]
            dzo = dz[f["owner"]]
            da = (dzo * f["h"]).sum(axis=1)
            mean = np.add.reduceat(da * f["a"], first[:-1])[f["owner"]]
            dl = f["a"] * (da - mean)
            dg = dl[:, None] * p["w"]
            dt, ds = dg * f["s"] * (1 - f["t"] ** 2), dg * f["t"] * f["s"] * (1 - f["s"])
            dh = (dzo * f["a"][:, None] + dt @ p["V"].T + ds @ p["U"].T) * (1 - f["h"] ** 2)
            grads = {"W": f["x"].T @ dh + 1e-4 * p["W"], "b": dh.sum(axis=0), "V": f["h"].T @ dt, "U": f["h"].T @ ds, "w": (f["t"] * f["s"]).T @ dl, "c": f["z"].T @ dy, "d": dy.sum()}
            for k, g in grads.items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                self.p[k] = p[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality", max_train: int = MAX_TRAIN, max_passages: int = MAX_PASSAGES) -> Attention:
    """Learn from the documents that ``labels`` (key, label 0 or 1) marks: at most ``max_train``, chosen by a hash of their key.

    Of a longer document ``max_passages`` passages are learned from, evenly spread over it; scores
    are of all passages.  Null labels and null keys don't count; of several labels of a key
    the highest does, and of several rows of a key one is learned from, chosen by a hash of its text.  Other columns are not
    read.  Without labels of both kinds every score is their share.
    """
    bounded_batches(docs.sparkSession)
    marked = labels.select(labels[key].alias("k"), labels[label].cast("double").alias("y")).where("k is not null and y in (0, 1)")
    marked = marked.groupBy("k").agg(F.max("y").alias("y")).orderBy(F.xxhash64("k"), "k").limit(max_train)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = utf8(batch.column(1))
            for i, j in spans(offsets, BATCH_BYTES):
                got, first = encode_passages(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                few = [got[a:b][np.unique(np.linspace(0, b - a - 1, min(b - a, max_passages)).astype(int))] for a, b in zip(first[:-1], first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), pa.array([f.tobytes() for f in few], pa.binary())], ["k", "y", "f"])

    texts = docs.select(docs[key].alias("k"), docs[text].cast("string").alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    chosen = texts.join(F.broadcast(marked), "k").groupBy("k").agg(F.min_by(F.coalesce("text", F.lit("")), F.xxhash64("text")).alias("text"), F.max("y").alias("y"))  # at most max_train rows are broadcast
    sample = chosen.mapInArrow(features, f"k {kind}, y double, f binary")
    got = sorted(sample.collect(), key=lambda r: (r["k"], bytes(r["f"])))
    y = np.array([r["y"] for r in got])
    bags = [np.frombuffer(r["f"], np.float32).reshape(-1, FEATURES) for r in got]
    share = (y.sum() + 0.5) / (len(y) + 1)
    stacked = np.concatenate(bags) if bags else np.zeros((1, FEATURES), np.float32)
    model = Attention(stacked.mean(axis=0), stacked.std(axis=0) + 1e-3, float(np.log(share / (1 - share))))
    if len(np.unique(y)) < 2:
        model.p["c"][:] = 0
        return model
    model.train(stacked, np.concatenate([[0], np.cumsum([len(b) for b in bags])]), y)
    return model


def score(docs: DataFrame, model: Attention, text: str = "text", key: str = "doc_id", keep: bool = False) -> DataFrame:
    """(key, score) of every whole text; with ``keep`` (row, score), where row holds all columns of ``docs``.

    Null and empty texts get a score too: that of a document with one empty passage.
    Keys are passed on, null and repeated ones too; without ``keep`` other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = utf8(batch.column(1))
            for i, j in spans(offsets, BATCH_BYTES):
                got = shared.value.score(*encode_passages(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(got.astype(np.float64))], ["row", "score"])

    whole = F.struct(*(docs[c] for c in docs.columns)) if keep else docs[key]
    base = docs.select(whole.alias("row"), docs[text].cast("string").alias("text"))
    out = base.mapInArrow(run, StructType([base.schema["row"], StructField("score", DoubleType())]))
    return out if keep else out.withColumnRenamed("row", key)


def op6_quality(spark, sf_dir: str) -> DataFrame:
    """The quality score of every document, learned from labels that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    held = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False))  # a row without a key is not held out
    scored = score(docs, fit(docs, labels.where(~held)))
    return scored.select("doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).cast("int").alias("predicted"))
