"""Quality by a linear-chain conditional random field over the lines of a document.

Every line is good or bad. A line's own features and those of the lines around it give its odds, and a
transition table ties neighbours together. Forward and backward messages give each line's marginal, the
marginals weighted by line length give the document's share of good text, and a logistic curve fitted on
the learning sample turns that share into a probability.

The labels are of documents. Lines of good documents are learned as good; in bad documents, a first model
without transitions picks the bad lines, at least one each, and the chain is then learned from these lines.

Texts without any visible character (null and empty ones too) have no lines: score 0, no good and no bad
line. Repeated rows score alike, extra columns are ignored, and lines of any length and number are
handled: messages are products of two-by-two matrices, taken by doubling over all lines of a block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from tarmac.llm.buffers import Block, blocks, lists, stretch_hashes, word_spans
from tarmac.llm.columns import free_names
from tarmac.llm.labels import held_out, learning_sample
from tarmac.llm.memory import returning

#: A model is fitted on at most so many labelled documents.
SAMPLE = 4000

#: Score from which a document is kept.
THRESHOLD = 0.3

UPPER, LETTER, DIGIT, BLANK, STOP, SYMBOL = range(6)
KINDS = np.full(256, SYMBOL, np.uint8)
KINDS[0x41:0x5B] = UPPER
KINDS[0x61:0x7B] = LETTER
KINDS[0x80:] = LETTER
KINDS[0x30:0x3A] = DIGIT
KINDS[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = BLANK
KINDS[[ord(c) for c in ".,;:'\"-()"]] = STOP
NEWLINE = 0x0A

OWN = 9  # features of a line itself


def line_features(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every line with a visible character, its bytes, and the number of such lines of each text."""
    starts, ends, first = word_spans(block)
    if not len(starts):
        return np.empty((0, OWN)), np.empty(0, np.int64), np.zeros(len(block), np.int64)
    # the line of a word: breaks before it in the block, where a text's start breaks too
    breaks = np.zeros(len(block.data) + 1, np.int32)
    np.cumsum(block.data == NEWLINE, out=breaks[1:])
    text = np.repeat(np.arange(len(block)), np.diff(first))
    new = np.ones(len(starts), bool)
    new[1:] = (breaks[starts[1:]] != breaks[starts[:-1]]) | (text[1:] != text[:-1])
    head = np.flatnonzero(new)
    words = np.diff(np.append(head, len(starts)))
    begin, end = starts[head], ends[head + words - 1]
    size = end - begin

    line_of = np.repeat(np.arange(len(head)), words)
    # bytes of lines only; what lies between lines is blank
    kinds = np.empty((6, len(head)))
    running = np.zeros(len(block.data) + 1, np.int32)
    classes = KINDS[block.data]
    for kind in range(6):
        np.cumsum(classes == kind, out=running[1:])
        kinds[kind] = running[end] - running[begin]
    (hashes,) = stretch_hashes(block.data, starts, ends)
    again = np.zeros(len(starts), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & ~new[1:]
    alike = np.bincount(line_of, again, len(head))
    (whole,) = stretch_hashes(block.data, begin, end)
    repeat = np.zeros(len(head), bool)
    repeat[1:] = (whole[1:] == whole[:-1]) & (text[head][1:] == text[head][:-1])

    visible = np.maximum(size - kinds[BLANK], 1)
    features = np.stack(
        [
            np.log1p(size),
            kinds[UPPER] / visible,
            kinds[DIGIT] / visible,
            kinds[SYMBOL] / visible,
            kinds[STOP] / visible,
            np.log(visible / words),
            alike / words,
            np.minimum(kinds[SYMBOL] / words, 3.0),
            repeat,
        ],
        axis=1,
    )
    return features, size, np.bincount(text[head], minlength=len(block))


def with_neighbours(features: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The line's features, those of the line before and after it (zeros at the ends), and a constant."""
    n = len(features)
    before, after = np.zeros_like(features), np.zeros_like(features)
    if n:
        index = place(counts)
        before[1:] = np.where((index[1:] > 0)[:, None], features[:-1], 0)
        after[:-1] = np.where((index[1:] > 0)[:, None], features[1:], 0)
    return np.hstack([features, before, after, np.ones((n, 1))])


def place(counts: np.ndarray) -> np.ndarray:
    """The index of every line in its text."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _products(steps: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Products of the matrices from a text's first line up to each line, scaled; ``steps`` is 2 x 2 x lines."""
    out, reach = steps.copy(), 1
    while reach <= (index.max() if len(index) else 0):
        at = np.flatnonzero(index >= reach)
        a, b = out[:, :, at - reach], out[:, :, at]
        new = a[:, :1] * b[:1] + a[:, 1:] * b[1:]
        out[:, :, at] = new / new.max(axis=(0, 1))
        reach *= 2
    return out


def marginals(odds: np.ndarray, ties: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chance of each line to be good, and of each pair of states (2 x 2) of a line and the one before."""
    n = len(odds)
    index = place(counts)
    odds = np.clip(odds, -30, 30)
    node = np.stack([np.exp(-np.maximum(odds, 0)), np.exp(np.minimum(odds, 0))])  # of bad and good, at most 1
    steps = np.exp(ties)[:, :, None] * node[None]
    steps[:, :, index == 0] = node[None][:, :, index == 0]
    forward = _products(steps, index)[0]
    # messages from behind: the same products in reverse, of transposed matrices
    remaining = np.repeat(counts, counts) - 1 - index
    back = steps.transpose(1, 0, 2)[:, :, ::-1]
    behind = _products(back, remaining[::-1])[:, :, ::-1].transpose(1, 0, 2).sum(axis=1)
    backward = np.ones((2, n))
    inner = np.flatnonzero(remaining > 0)
    backward[:, inner] = behind[:, inner + 1]
    both = forward * backward
    good = both[1] / np.maximum(both.sum(axis=0), 1e-300)
    pairs = np.zeros((2, 2, n))
    later = np.flatnonzero(index > 0)
    pairs[:, :, later] = forward[:, None, later - 1] * steps[:, :, later] * backward[None][:, :, later]
    pairs[:, :, later] /= np.maximum(pairs[:, :, later].sum(axis=(0, 1)), 1e-300)
    return good, pairs


@dataclass
class Field:
    """Centre and scale of the features, weights of the odds, the transition table, and the final curve."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    ties: np.ndarray
    curve: tuple[float, float]

    def line_chances(self, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
        odds = with_neighbours((features - self.centre) / self.scale, counts) @ self.weights
        return marginals(odds, self.ties, counts)[0]

    def scores(self, features: np.ndarray, size: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        chance = self.line_chances(features, counts)
        return _curve(_share(chance, size, counts), self.curve) * (counts > 0), chance


def _share(chance: np.ndarray, size: np.ndarray, counts: np.ndarray) -> np.ndarray:
    text = np.repeat(np.arange(len(counts)), counts)
    total = np.bincount(text, size, len(counts))
    return np.bincount(text, size * chance, len(counts)) / np.maximum(total, 1)


def _curve(share: np.ndarray, curve: tuple[float, float]) -> np.ndarray:
    share = np.clip(share, 1e-4, 1 - 1e-4)
    return 1 / (1 + np.exp(-np.clip(curve[0] + curve[1] * np.log(share / (1 - share)), -40, 40)))


class _Adam:
    def __init__(self, *values: np.ndarray, pace: float):
        self.values, self.pace, self.n = [v.copy() for v in values], pace, 0
        self.first, self.second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]

    def step(self, *slopes: np.ndarray) -> None:
        self.n += 1
        for v, a, b, g in zip(self.values, self.first, self.second, slopes, strict=True):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            v -= self.pace * (a / (1 - 0.9**self.n)) / (np.sqrt(b / (1 - 0.99**self.n)) + 1e-8)


def fit(features: np.ndarray, size: np.ndarray, counts: np.ndarray, labels: np.ndarray, rounds: int = 150) -> Field:
    """Likelihood ascent on the learning sample; texts without lines play no part."""
    labels, counts = labels[counts > 0], counts[counts > 0]
    if not len(counts) or labels.min() == labels.max():
        always = 30.0 if len(counts) and labels.max() == 1 else -30.0 if len(counts) else 0.0
        weights = np.zeros(3 * OWN + 1)
        return Field(np.zeros(OWN), np.ones(OWN), weights, np.zeros((2, 2)), (always, 0.0))
    centre, scale = features.mean(axis=0), features.std(axis=0) + 1e-6
    x = with_neighbours((features - centre) / scale, counts)
    n = len(x)
    y = np.repeat(labels, counts).astype(float)

    plain = _Adam(np.zeros(x.shape[1]), pace=0.1)
    for _ in range(rounds):
        w = plain.values[0]
        chance = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        plain.step(x.T @ (chance - y) / n + 1e-4 * w)
    chance = 1 / (1 + np.exp(-np.clip(x @ plain.values[0], -30, 30)))
    lowest = np.minimum.reduceat(chance, np.cumsum(counts) - counts)
    y = np.where((y == 0) & (chance > 0.5) & (chance > np.repeat(lowest, counts)), 1.0, y)

    later = np.flatnonzero(place(counts) > 0)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[later - 1].astype(int), y[later].astype(int)), 1)
    chain = _Adam(plain.values[0], np.zeros((2, 2)), pace=0.05)
    for _ in range(rounds):
        w, ties = chain.values
        good, pairs = marginals(x @ w, ties, counts)
        chain.step(x.T @ (good - y) / n + 1e-4 * w, (pairs.sum(axis=2) - seen) / n + 1e-3 * ties)
    w, ties = chain.values

    share = _share(marginals(x @ w, ties, counts)[0], size, counts)
    share = np.clip(share, 1e-4, 1 - 1e-4)
    logit = np.log(share / (1 - share))
    line = _Adam(np.array([0.0, 1.0]), pace=0.05)
    for _ in range(2 * rounds):
        error = 1 / (1 + np.exp(-np.clip(line.values[0][0] + line.values[0][1] * logit, -40, 40))) - labels
        line.step(np.array([error.mean(), (error * logit).mean()]) + 1e-3 * line.values[0])
    return Field(centre, scale, w, ties, (float(line.values[0][0]), float(line.values[0][1])))


@returning
def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch["text"]):
            features, size, counts = line_features(block)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["label"].slice(block.first, len(block)),
                    lists(features.astype(np.float32).ravel(), counts * OWN),
                    lists(size, counts),
                ],
                names=["label", "features", "size"],
            )


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Field:
    rows = learning_sample(documents, labels, "quality", sample).select("text", "label")
    schema = "label int, features array<float>, size array<long>"
    table = rows.mapInArrow(_feature_batches, schema).toArrow()
    if not len(table):
        return fit(np.empty((0, OWN)), np.empty(0), np.empty(0, np.int64), np.empty(0))
    size = table["size"].combine_chunks()
    features = table["features"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return fit(
        features.astype(float).reshape(-1, OWN),
        size.flatten().to_numpy(zero_copy_only=False),
        size.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64),
        table["label"].to_numpy(),
    )


ADDED = ("quality_score", "n_lines", "n_bad_lines")


def score(documents: DataFrame, field: Field) -> DataFrame:
    """Every column of the documents, with ``quality_score`` and the numbers of lines and of bad lines.

    Columns of these names that the documents already have are replaced.
    """
    return _scored(documents.select(*[F.col(f"`{c}`") for c in documents.columns if c.lower() not in ADDED]), field, ADDED)


def _scored(kept: DataFrame, field: Field, added: tuple[str, ...]) -> DataFrame:
    """``score`` under names that the documents do not have."""
    schema = StructType(kept.schema.fields[:]).add(added[0], "double").add(added[1], "long").add(added[2], "long")

    @returning
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch["text"]):
                features, size, counts = line_features(block)
                value, chance = field.scores(features, size, counts)
                bad = np.bincount(np.repeat(np.arange(len(counts)), counts), chance < 0.5, len(counts))
                part = batch.slice(block.first, len(block))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(value), pa.array(counts), pa.array(bad.astype(np.int64))],
                    names=[*part.schema.names, *added],
                )

    return kept.mapInArrow(scored, schema)


def digest(documents: DataFrame, field: Field) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document, and its lines by kind."""
    scored = score(documents.select("doc_id", "text"), field)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted"),
        "n_lines",
        "n_bad_lines",
    )


def keep_good(documents: DataFrame, field: Field) -> DataFrame:
    """The documents that score at least the threshold, with their own columns only, whatever their names."""
    names = documents.columns
    added = free_names(documents, *ADDED)
    scored = _scored(documents, field, tuple(added)).where(F.col(added[0]) >= THRESHOLD)
    return scored.select(*[F.col(f"`{c}`") for c in names])
