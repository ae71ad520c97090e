"""Quality classifier: hashed word and character n-gram vectors, averaged, softmax, trained by SGD.

A document is the mean of the learned vectors of its features: every word, the character
n-grams of the word with a space on either side, and for a word that follows its equal the
pair, once for each of its bytes. All are hashed into ``BUCKETS`` rows. Training reads a
bounded sample (``SAMPLE`` labelled documents, the smallest by a hash of their id, whole
texts) in one task that returns one number per bucket: behind a mean, the softmax over two
classes only needs each vector's projection on the difference of the two output rows.
Scoring is one scan of all documents, in pieces of ``PIECE`` bytes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import id_and_text, slices, utf8

BITS = 18
BUCKETS = 1 << BITS
REPEAT = BUCKETS  # one more row: a word after its equal
NGRAMS = (2, 3, 4)
VECTOR = 8
SAMPLE = 4000
EPOCHS = 5
RATE = 0.15
FOLDS = 5
THRESHOLD = 0.3
PIECE = 1 << 18
ROWS_AT_ONCE = 500

#: Odd multipliers of the two hashes: the polynomial's base, and the one that mixes to a bucket.
BASE, MIX = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)


class QualityModel(NamedTuple):
    """A bias and the share of each bucket in the logit of label 1."""

    weights: np.ndarray
    bias: float


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return ((hashes * MIX) >> np.uint64(64 - BITS)).astype(np.int32)


def _features(words: list[bytes]) -> tuple[np.ndarray, int]:
    """Buckets of the words and their n-grams, with repeats, and the count of the pair feature."""
    octets = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint64)
    blank = octets == 32
    ends = np.flatnonzero(blank)
    starts, sizes = ends[:-1] + 1, np.diff(ends) - 1
    found, hashes = [], octets.copy()
    for n in range(2, max(NGRAMS) + 1):
        hashes = hashes[:-1] * BASE + octets[n - 1 :]
        if n in NGRAMS:  # a blank may only be the first or the last of an n-gram's bytes
            whole = np.ones(len(hashes), bool)
            for inner in range(1, n - 1):
                whole &= ~blank[inner : inner + len(hashes)]
            found.append(_bucket(hashes[whole] + np.uint64(n)))
    place = np.arange(len(octets), dtype=np.int64)
    place[1:] -= np.repeat(starts, sizes + 1)
    powers = np.cumprod(np.full(int(sizes.max()) + 2, BASE))
    of_word = np.add.reduceat(octets * powers[place], starts)
    found.append(_bucket(of_word))
    again = of_word[1:] == of_word[:-1]
    return np.concatenate(found), int(sizes[1:][again].sum())


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some hundred thousand bytes at a time."""
    start = 0
    while start < len(text):
        stop = start + PIECE
        while stop < len(text) and text[stop] not in b" \t\n\x0b\x0c\r":
            stop += 1
        if words := text[start:stop].split():
            yield words
        start = stop


def document_features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, share of each in the document's mean); empty for a text without words."""
    found, repeats = [np.empty(0, np.int32)], 0
    for words in _pieces(text):
        buckets, more = _features(words)
        found.append(buckets)
        repeats += more
    ids, counts = np.unique(np.concatenate(found), return_counts=True)
    if repeats:
        ids, counts = np.append(ids, np.int32(REPEAT)), np.append(counts, repeats)
    return ids, (counts / max(counts.sum(), 1)).astype(np.float32)


def fit(examples: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> QualityModel:
    """SGD over the mean-of-vectors softmax classifier, one example at a time, seeded.

    Steps are scaled per row by the gradients it has seen, as rare n-grams get few. With no
    examples, or all of one label, the model is the smoothed share of the labels.
    """
    ones = int(labels.sum())
    bias = float(np.log((ones + 1) / (len(labels) - ones + 1)))
    if not 0 < ones < len(labels):
        return QualityModel(np.zeros(BUCKETS + 1, np.float32), bias)
    rng = np.random.default_rng(7)
    vectors = rng.uniform(-1 / VECTOR, 1 / VECTOR, (BUCKETS + 1, VECTOR)).astype(np.float32)
    out = rng.uniform(-1, 1, (2, VECTOR)).astype(np.float32)
    base = np.array([0.0, bias], np.float32)
    seen = np.full(BUCKETS + 1, 1e-8, np.float32)
    steps, total = 0, EPOCHS * len(examples)
    for _ in range(EPOCHS):
        for at in rng.permutation(len(examples)):
            rate = RATE * (1 - steps / total)
            steps += 1
            ids, share = examples[at]
            if not len(ids):
                continue
            rows = vectors[ids]
            hidden = share @ rows
            logits = out @ hidden + base
            likely = np.exp(logits - logits.max())
            likely /= likely.sum()
            likely[labels[at]] -= 1  # gradient of the log loss by the logits
            back = likely @ out
            seen[ids] += share * share * (back @ back)
            step = rate * share / np.sqrt(seen[ids])
            vectors[ids] = rows - step[:, None] * back
            out -= rate * np.outer(likely, hidden)
            base -= 0.1 * rate * likely
    return QualityModel((vectors @ (out[1] - out[0])).astype(np.float32), float(base[1] - base[0]))


def _train(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    examples, labels = [], []
    for batch in slices(batches, ROWS_AT_ONCE):
        examples += map(document_features, utf8(batch.column(0)))
        labels += batch.column(1).to_pylist()
    model = fit(examples, np.array(labels, np.int64))
    yield pa.RecordBatch.from_arrays(
        [pa.array([model.weights.tobytes()], pa.binary()), pa.array([model.bias])], names=["weights", "bias"]
    )


def _remainder(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> QualityModel:
    """The model of ``docs`` whose ``labels.quality`` (0 or 1) is known.

    Only ids whose crc32 modulo ``FOLDS`` is not 0 are learned from. Labels without id or
    quality are ignored; of several labels of one id the highest holds, of several texts the smallest. ``sample`` bounds
    the number of labels used (those of the smallest hashed ids), and so the one task and
    the broadcast of their ids.
    """
    known = (
        labels.select(F.col("doc_id").cast("bigint").alias("label_id"), (F.col("quality") > 0).alias("good"))
        .where("label_id is not null and good is not null")
        .where(_remainder(F.col("label_id")) != 0)
        .groupBy("label_id")
        .agg(F.max("good").alias("good"))
        .orderBy(F.xxhash64("label_id"), "label_id")
        .limit(sample)
    )
    rows = id_and_text(docs).join(F.broadcast(known), F.col("doc_id") == F.col("label_id"))
    # One row of each id: a labelled id that repeats without end brings a row a task here.
    once = rows.groupBy("doc_id", F.col("good").cast("bigint").alias("good")).agg(F.min("text").alias("text"))
    one_task = once.select("text", "good", "doc_id").repartition(1)
    ordered = one_task.sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "text").select("text", "good")
    found = ordered.mapInArrow(_train, "weights binary, bias double").first()
    if found is None:
        return fit([], np.empty(0, np.int64))
    return QualityModel(np.frombuffer(bytes(found.weights), np.float32), found.bias)


def score_text(text: bytes, model: QualityModel) -> float:
    total, features = 0.0, 0
    for words in _pieces(text):
        buckets, repeats = _features(words)
        total += float(model.weights[buckets].sum()) + repeats * float(model.weights[REPEAT])
        features += len(buckets) + repeats
    logit = model.bias + total / max(features, 1)
    return float(1 / (1 + np.exp(-np.clip(logit, -500, 500))))


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """One row per row of ``docs``: (doc_id, held_out, score, predicted).

    ``score`` is the likelihood of label 1, between 0 and 1; a text without words gets the
    model's bias. ``predicted`` is 1 from ``THRESHOLD`` on. ``held_out`` marks the ids that
    training never reads; a missing id is one of them. The model, one number per bucket, goes
    to the tasks with the function.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS_AT_ONCE):
            scores = [score_text(t, model) for t in utf8(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    scored = id_and_text(docs).mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        F.coalesce(_remainder(F.col("doc_id")) == 0, F.lit(True)).alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def keep_quality(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores at least ``threshold``; no shuffle."""
    at = docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS_AT_ONCE):
            yield batch.filter(pa.array([score_text(t, model) >= threshold for t in utf8(batch.column(at))], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
