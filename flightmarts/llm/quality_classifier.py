"""Supervised subword embeddings: averaged hashed n-gram vectors under a softmax."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightmarts.llm.common import small_batches, stored, table, text_or_empty
from flightmarts.llm.hashing import Prefixes, mix, word_bounds

BITS = 18  # buckets of hashed n-grams: 2^18
DIMENSIONS, RATE = 12, 0.8
STEPS = 24_000  # of descent at least, in whole passes over the examples
# Labelled documents that a model is fitted on at most, the first by a hash of their id.
TRAIN_DOCS = 4_000
# Distinct buckets of these documents together at most, 400 MB on the driver; further ones are left out.
TRAIN_BUCKETS = 50_000_000
THRESHOLD = 0.3
FOLDS = 5
_SAME, _AGAIN, _WORD = 0, 1, 2  # buckets of their own

_U = np.uint64


def features(text: bytes) -> np.ndarray:
    """Buckets of a text's n-grams, one entry per occurrence.

    Words and pairs of words; runs of three and four bytes with the spaces around
    them; a pair of the same word, and a five-word run that came before, fall on
    buckets of their own, whatever the words.
    """
    data = np.frombuffer(text, np.uint8)
    starts, ends = word_bounds(data)
    if not len(starts):
        return np.zeros(0, np.int32)
    shift = _U(64 - BITS)
    words = Prefixes(data).of(starts, ends)
    pairs = mix(words[:-1] * _U(3) + words[1:])
    found = [words >> shift, np.where(words[:-1] == words[1:], _U(_SAME), pairs >> shift)]
    if len(words) >= 5:
        runs = words[:-4] * _U(0x9E3779B97F4A7C15)
        for k in range(1, 5):
            runs = (runs + words[k : len(words) - 4 + k]) * _U(0x9E3779B97F4A7C15)
        again = len(runs) - len(np.unique(runs))
        found.append(np.full(again, _AGAIN, _U))
    found.append(np.full(len(words), _WORD, _U))
    wide = np.concatenate([[32], data, [32]]).astype(np.uint32)
    three = wide[:-2] | wide[1:-1] << np.uint32(8) | wide[2:] << np.uint32(16)
    four = three[:-1] | wide[3:] << np.uint32(24)
    small = np.uint32(32 - BITS)
    return np.concatenate(
        [
            *(f.astype(np.int32) for f in found),
            (three * np.uint32(0x9E3779B1) >> small).astype(np.int32),
            (four * np.uint32(0x85EBCA6B) >> small).astype(np.int32),
        ]
    )


@dataclass
class Model:
    vectors: np.ndarray  # a row per bucket
    output: np.ndarray  # dimensions by two classes
    bias: np.ndarray

    def table(self) -> np.ndarray:
        """What each bucket adds to the log-odds of class 1.

        The average of vectors times the output matrix is the average of these.
        """
        return (self.vectors @ (self.output[:, 1] - self.output[:, 0])).astype(np.float32)

    def offset(self) -> float:
        return float(self.bias[1] - self.bias[0])


def fit(examples: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 1) -> Model:
    """Stochastic gradient descent on the softmax loss, a document at a time.

    ``examples`` are distinct buckets, their counts, and the class. The rate
    falls linearly to nothing. Without examples the model says one half.
    """
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (1 << BITS, DIMENSIONS)).astype(np.float32)
    output, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
    passes = -(-STEPS // max(1, len(examples)))
    steps, done = passes * len(examples), 0
    for _ in range(passes):
        for i in random.permutation(len(examples)):
            buckets, counts, label = examples[i]
            rate = np.float32(RATE * (1 - done / steps))
            done += 1
            weights = (counts / max(1, counts.sum())).astype(np.float32)
            hidden = weights @ vectors[buckets]
            logits = hidden @ output + bias
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[label] -= 1
            back = output @ error
            output -= rate * np.outer(hidden, error)
            bias -= rate * np.float32(0.1) * error
            vectors[buckets] -= rate * weights[:, None] * back
    return Model(vectors, output, bias)


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text is divisible by the number of folds; not for a null id."""
    fold = F.crc32(doc_id.cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == 0, F.lit(False))


def training_examples(
    docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCS, buckets: int = TRAIN_BUCKETS
) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Counted buckets of at most ``limit`` labelled documents outside the held-out fold.

    The one thing brought to the driver, of a size that both limits bound: the
    first documents by a hash of their id that have no more than ``buckets``
    distinct buckets together. The labels' ids are broadcast. Of rows that share a
    chosen id one is learnt from, the first by a hash of the text; map tasks find
    it, so however many there are, one per task is shuffled.
    """
    chosen = (
        labels.filter(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    )
    texts = docs.select("doc_id", text_or_empty().cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counted = [np.unique(features(t.as_py()), return_counts=True) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("label"),
                    pa.array([b.astype(np.int32).tobytes() for b, _ in counted], pa.binary()),
                    pa.array([c.astype(np.int32).tobytes() for _, c in counted], pa.binary()),
                ],
                ["doc_id", "label", "buckets", "counts"],
            )

    small_batches(docs.sparkSession)
    schema = T.StructType([docs.schema["doc_id"]]).add("label", "integer")
    one = F.min(F.struct(F.xxhash64("text"), "text"))
    examples = stored(
        texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(one.alias("one"))
        .select("doc_id", "label", "one.text")
        .mapInArrow(run, schema.add("buckets", "binary").add("counts", "binary")),
        "examples",
    )
    # A row of two numbers per chosen document.
    so_far = Window.orderBy(F.xxhash64("doc_id"), "doc_id")
    sizes = examples.select("doc_id", (F.octet_length("buckets") / 4).alias("n"))
    first = sizes.withColumn("sum", F.sum("n").over(so_far)).filter(F.col("sum") <= buckets).select("doc_id")
    rows = examples.join(F.broadcast(first), "doc_id").select(*examples.columns).toArrow().to_pylist()
    rows.sort(key=lambda r: (r["doc_id"], r["buckets"]))
    return [
        (np.frombuffer(r["buckets"], np.int32), np.frombuffer(r["counts"], np.int32), r["label"])
        for r in rows
    ]


def train(
    docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCS, buckets: int = TRAIN_BUCKETS
) -> Model:
    """A model of ``labels.quality``, from texts alone."""
    return fit(training_examples(docs, labels, limit, buckets))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted``, one row per row of ``docs``.

    The probability of class 1 for the whole text. A null, empty or blank text
    has no n-grams and gets what the bias says. Repeated rows score alike, and
    an empty table gives an empty result. Reads ``doc_id`` and ``text`` only.

    No shuffle. Broadcast is one number per bucket, 1 MB: an average of vectors
    under a linear output needs no more.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.table(), model.offset()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, offset = shared.value
        for batch in batches:
            odds = []
            for text in batch.column(1):
                found = features(text.as_py())
                odds.append(offset + (float(parts[found].mean(dtype=np.float64)) if len(found) else 0.0))
            scores = 1 / (1 + np.exp(-np.clip(np.array(odds), -500, 500)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"]
            )

    scored = docs.select("doc_id", text_or_empty().cast("binary").alias("text")).mapInArrow(
        run, T.StructType([docs.schema["doc_id"]]).add("score", "double")
    )
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
