"""Quality classifier on learned subword embeddings.

A document is the average of the learned vectors of its hashed words, word pairs and character n-grams; a softmax
layer on top gives the label (Joulin et al., 2016). Trained with stochastic gradient descent in numpy on a bounded
sample of labelled rows. Since the layers are linear, the trained model is one number per feature when it scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshlark.llm import common

BUCKETS = 1 << 15
#: Kinds of features, each with buckets of its own: words, word pairs, and the lengths of character n-grams.
CHARACTERS = (3, 5)
KINDS = 2 + len(CHARACTERS)
DIMENSIONS = 12
#: Labelled rows to learn from: those with the least hash of their id.
TRAIN_ROWS = 3_000
EPOCHS, RATE, SEED = 12, 0.5, 5
_SAME = np.uint64(0x5851F42D4C957F2D)


def features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Feature numbers and the row of each, kind by kind.

    Words ignore the case of A-Z, character n-grams do not; n-grams run over bytes, may begin or end with white
    space but not hold it inside. A pair of one word with itself is a feature of its own, whatever the word.
    """
    rows = len(offsets) - 1
    hashes, counts = common.words(data, offsets)
    own = np.repeat(np.arange(rows), np.diff(counts))
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    yield (hashes >> shift).astype(np.int64), own
    near = np.flatnonzero(own[1:] == own[:-1])
    pairs = np.where(hashes[near] == hashes[near + 1], _SAME,
                     common.mixed(hashes[near] * np.uint64(3) + hashes[near + 1]))
    yield (pairs >> shift).astype(np.int64) + BUCKETS, own[near]
    space = common._IS_SPACE[data]
    plain = np.where(space, np.uint8(32), data).astype(np.uint64)
    row = np.repeat(np.arange(rows, dtype=np.int32), np.diff(offsets))
    solid = np.concatenate(([0], np.cumsum(space)))
    for kind, n in enumerate(CHARACTERS):
        size = len(plain) - n + 1
        if size <= 0:
            continue
        code = np.zeros(size, np.uint64)
        for k in range(n):
            code |= plain[k:k + size] << np.uint64(8 * k)
        inside = solid[n - 1:n - 1 + size] - solid[1:1 + size]
        at = np.flatnonzero((row[:size] == row[n - 1:]) & (inside == 0))
        code = (code[at] * np.uint64(0x9E3779B97F4A7C15)) >> shift
        yield code.astype(np.int64) + (2 + kind) * BUCKETS, row[at].astype(np.int64)


@dataclass
class QualityModel:
    """Softmax difference that each feature adds per occurrence, and that of a text without features."""

    weights: np.ndarray
    bias: float


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS, rate: float = RATE,
          seed: int = SEED) -> QualityModel:
    """Stochastic gradient descent over documents given as feature numbers and their shares."""
    random = np.random.RandomState(seed)
    vectors = random.uniform(-1, 1, (KINDS * BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    layer, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
    steps, done = max(1, epochs * len(rows)), 0
    for _ in range(epochs):
        for i in random.permutation(len(rows)):
            now = rate * (1 - done / steps)
            done += 1
            ids, share = rows[i]
            hidden = share @ vectors[ids]
            scores = hidden @ layer + bias
            p = np.exp(scores - scores.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = layer @ p
            layer -= now * np.outer(hidden, p)
            bias -= now * p
            vectors[ids] -= now * share[:, None] * back
    return QualityModel((vectors @ (layer[:, 1] - layer[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def _features_of_sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = common.utf8(batch.column(0))
        for start, stop in common.slices(offsets, 500_000):
            found = list(features(data[offsets[start]:offsets[stop]], offsets[start:stop + 1] - offsets[start]))
            ids, row = (np.concatenate(x) for x in zip(*found))
            cell, n = np.unique(row * (KINDS * BUCKETS) + ids, return_counts=True)
            own = cell // (KINDS * BUCKETS)
            sizes = np.bincount(own, minlength=stop - start)
            ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).slice(start, stop - start), batch.column(2).slice(start, stop - start),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array((cell % (KINDS * BUCKETS)).astype(np.int32))),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(n.astype(np.int32)))], ["place", "label", "ids", "n"])


def fit_quality(docs: DataFrame, labels: DataFrame, train_on: Column, label: str = "quality",
                train_rows: int = TRAIN_ROWS) -> QualityModel:
    """Learn from the rows of ``docs`` where ``train_on`` (on ``doc_id``) holds and ``labels`` has 0 or 1.

    Of these at most ``train_rows`` are used, those with the least hash of their id, whole texts each; their ids are
    few enough to be sent to all tasks. An id that is labelled twice counts with its larger label. Without labelled
    rows every text scores one half.
    """
    usable = (labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).where(F.coalesce(train_on, F.lit(False)))
              .groupBy("doc_id").agg(F.max(label).cast("int").alias("label")))
    place = F.xxhash64("doc_id", F.lit(SEED))
    chosen = usable.withColumn("place", place).orderBy("place", "doc_id").limit(train_rows)
    rows = docs.select("doc_id", common.text_or_empty().alias("text")).join(F.broadcast(chosen), "doc_id")
    found = rows.select("text", "place", "label").mapInArrow(
        _features_of_sample, "place long, label int, ids array<int>, n array<int>").toArrow()
    order = np.argsort(found["place"].to_numpy(), kind="stable")
    ids, counts = found["ids"].combine_chunks(), found["n"].combine_chunks()
    sample, known = [], found["label"].to_numpy()
    for i in order:
        n = counts[int(i)].values.to_numpy().astype(np.float32)
        sample.append((ids[int(i)].values.to_numpy(), n / max(n.sum(), 1)))
    return train(sample, known[order])


def _score(model: QualityModel):
    def per_slice(batch, data, offsets):
        rows = len(offsets) - 1
        total, count = np.zeros(rows), np.zeros(rows)
        for ids, row in features(data, offsets):
            total += np.bincount(row, model.weights[ids], rows)
            count += np.bincount(row, minlength=rows)
        scores = 1 / (1 + np.exp(-(total / np.maximum(count, 1) + model.bias)))
        kept = [i for i, name in enumerate(batch.schema.names) if name != "text"]
        return pa.RecordBatch.from_arrays([*[batch.column(i) for i in kept], pa.array(scores)],
                                          [*[batch.schema.names[i] for i in kept], "score"])

    return common.text_kernel(per_slice)


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``doc_id, score``: for each row of ``docs`` the probability of label 1, from the whole text alone. Null text is
    empty; a text without words has the prior of the sample. Equal texts have equal scores."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_or_empty().alias("text")).mapInArrow(
        _score(model), "doc_id long, score double")
