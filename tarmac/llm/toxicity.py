"""Toxicity by a factorization machine over hashed terms.

The score of a document is ``sigmoid(bias + sum w_i + sum_{i<j} <v_i, v_j>)`` over its distinct terms, so
a pair such as an insult and the mention of a group can weigh more than its two parts. Terms are the
lower-cased words and the beginnings of words, hashed into buckets. All terms of ``SUPPORT`` or more learned
documents get weights and factors. Those whose own counts in the two classes do not differ beyond chance are
shrunk by what chance alone would move them, so long texts do not add up noise, and a term that matters only
beside another one is still learned. A pair too rare to stand out from chance is shrunk away.

Null and empty texts have no terms and score ``sigmoid(bias)``. Repeated rows score alike. Extra columns
are ignored. Without any labelled document of both classes, the bias is the only weight.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tarmac.llm.buffers import LOWER, Block, blocks, lists, ranges, stretch_hashes, word_spans
from tarmac.llm.labels import held_out, learning_sample

BUCKETS_LOG2 = 20
PREFIXES = (4, 6)
FACTORS = 4

#: A model is fitted on at most so many labelled documents.
SAMPLE = 8000

#: Terms of fewer learned documents get no weights.
SUPPORT = 3

#: Least log-likelihood ratio (twice the difference, in nats) between the classes for a term to be fitted freely.
EVIDENCE = 15.0

#: The other terms are shrunk by so many standard deviations of their gradient under chance.
SHRINK = 4.0


def terms(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Distinct term buckets of every text, one text after another, and how many each has."""
    starts, ends, first = word_spans(block)
    hashes = stretch_hashes(LOWER[block.data], starts, ends, *(np.minimum(starts + p, ends) for p in PREFIXES))
    text = np.repeat(np.arange(len(block), dtype=np.uint64), np.diff(first)) << np.uint64(32)
    # the kind of term is part of its bucket, so a word and a like beginning differ
    keys = [text | ((h + np.uint64(i)) >> np.uint64(64 - BUCKETS_LOG2)) for i, h in enumerate(hashes)]
    keys = np.unique(np.concatenate(keys))
    counts = np.bincount((keys >> np.uint64(32)).astype(np.int64), minlength=len(block))
    return (keys & np.uint64(0xFFFFFFFF)).astype(np.int32), counts


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive rows of ``values``, ``counts`` rows each."""
    total = np.zeros((len(values) + 1, *values.shape[1:]))
    np.cumsum(values, axis=0, out=total[1:])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


@dataclass
class Machine:
    """Bias, linear weights and factors of the buckets in ``seen`` (sorted); all other buckets weigh nothing."""

    bias: float
    seen: np.ndarray
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        slot = np.full(1 << BUCKETS_LOG2, len(self.seen), np.int32)
        slot[self.seen] = np.arange(len(self.seen))
        at = slot[buckets]
        known = at < len(self.seen)
        row = np.repeat(np.arange(len(counts)), counts)[known]
        counts, at = np.bincount(row, minlength=len(counts)), at[known]
        v = self.factors[at]
        pairs = (_sums(v, counts) ** 2 - _sums(v**2, counts)).sum(axis=1) / 2
        return self.bias + _sums(self.weights[at], counts) + pairs


def _xlogy(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(y, 1e-300)), 0.0)


def _evidence(support: np.ndarray, positive: np.ndarray, documents: int, toxic: int) -> np.ndarray:
    """Log-likelihood ratio of each term's share in toxic documents and in the others against one share."""

    def fitted(hits: np.ndarray, n: float) -> np.ndarray:
        return _xlogy(hits, hits / n) + _xlogy(n - hits, (n - hits) / n)

    rest = support - positive
    return 2 * (fitted(positive, toxic) + fitted(rest, documents - toxic) - fitted(support, documents))


def _soft(values: np.ndarray, less: np.ndarray) -> np.ndarray:
    return np.sign(values) * np.maximum(np.abs(values) - less, 0)


def fit(buckets: np.ndarray, counts: np.ndarray, labels: np.ndarray, epochs: int = 12, seed: int = 7) -> Machine:
    """Adagrad on the log loss with a slight decay; terms without evidence of their own are shrunk at each step."""
    rate = (labels.sum() + 0.5) / (len(labels) + 1.0)
    machine = Machine(float(np.log(rate / (1 - rate))), np.empty(0, np.int64), np.empty(0), np.empty((0, FACTORS)))
    if len(labels) == 0 or labels.min() == labels.max():
        return machine
    row = np.repeat(np.arange(len(counts)), counts)
    support = np.bincount(buckets, minlength=1 << BUCKETS_LOG2).astype(float)
    positive = np.bincount(buckets, labels[row], minlength=1 << BUCKETS_LOG2)
    seen = np.flatnonzero(support >= SUPPORT)
    support, positive = support[seen], positive[seen]
    shrunk = _evidence(support, positive, len(labels), int(labels.sum())) < EVIDENCE
    # for the mean loss, from one document
    chance = SHRINK * np.sqrt(rate * (1 - rate)) / len(labels) * shrunk
    less_w, less_v = chance * np.sqrt(support), None
    slot = np.full(1 << BUCKETS_LOG2, -1, np.int64)
    slot[seen] = np.arange(len(seen))
    at = slot[buckets]
    at, counts = at[at >= 0], np.bincount(row[at >= 0], minlength=len(counts))
    ends = np.cumsum(counts)
    rng = np.random.default_rng(seed)
    w, v = np.zeros(len(seen)), rng.normal(0, 0.02, (len(seen), FACTORS))
    gw, gv, gb, bias = np.full(len(seen), 1e-4), np.full(v.shape, 1e-4), 1e-4, machine.bias
    step, decay = 0.1, 1e-4
    for _ in range(epochs):
        squares = np.zeros(v.shape)
        order = rng.permutation(len(labels))
        for batch in np.array_split(order, max(1, len(order) // 128)):
            size = counts[batch]
            idx = at[ranges(ends[batch] - size, size)]
            rows, vi = np.repeat(np.arange(len(batch)), size), v[idx]
            total = _sums(vi, size)
            raw = bias + _sums(w[idx], size) + (total**2 - _sums(vi**2, size)).sum(axis=1) / 2
            error = (sigmoid(raw) - labels[batch]) / len(batch)
            dw = np.bincount(idx, error[rows], len(seen)) + decay * w
            others = total[rows] - vi
            squares += np.stack([np.bincount(idx, others[:, f] ** 2, len(seen)) for f in range(FACTORS)], axis=1)
            dv = error[rows][:, None] * others
            dv = np.stack([np.bincount(idx, dv[:, f], len(seen)) for f in range(FACTORS)], axis=1) + decay * v
            gw, gv, gb = gw + dw**2, gv + dv**2, gb + error.sum() ** 2
            bias -= step * error.sum() / np.sqrt(gb)
            w = _soft(w - step * dw / np.sqrt(gw), step * less_w / np.sqrt(gw))
            v -= step * dv / np.sqrt(gv)
            if less_v is not None:
                v = _soft(v, step * less_v / np.sqrt(gv))
        less_v = chance[:, None] * np.sqrt(squares)
    used = (w != 0) | (v != 0).any(axis=1)
    return Machine(float(bias), seen[used], w[used], v[used])


def _term_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch["text"]):
            found, counts = terms(block)
            label = batch["label"].slice(block.first, len(block))
            yield pa.RecordBatch.from_arrays([label, lists(found, counts)], names=["label", "terms"])


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    rows = learning_sample(documents, labels, "toxic", sample)
    table = rows.select("text", "label").mapInArrow(_term_batches, "label int, terms array<int>").toArrow()
    found = table["terms"].combine_chunks()
    if not len(table):
        return fit(np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0))
    return fit(
        found.flatten().to_numpy(zero_copy_only=False),
        found.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64),
        table["label"].to_numpy().astype(float),
    )


def score(documents: DataFrame, machine: Machine) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch["text"]):
                value = sigmoid(machine.raw(*terms(block)))
                part = batch.slice(block.first, len(block))
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(value)], names=["doc_id", "score"]
                )

    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = rows.mapInArrow(scored, "doc_id long, score double")
    return rows.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
