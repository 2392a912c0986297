"""Language of a text by a bidirectional gated recurrent network over its bytes.

Two small gated networks read windows of bytes, one forwards and one backwards; from both states every
byte position gets chances of the languages, and their mean over all positions of the text is the text's.
Gates and candidates are piecewise linear (``clip``), which is several times cheaper than ``tanh``. The
network is trained here by backpropagation through time on windows cut from a bounded sample of texts.

A text that is null, empty or without any letter is ``und`` with score 0; so is every text when nothing
could be learned. Ties go to the first language in alphabetical order. Repeated rows are judged alike,
extra columns are ignored, and texts of any length are read whole, window by window.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tarmac.llm.buffers import blocks, byte_column, ranges
from tarmac.llm.labels import held_out

#: The network is fitted on windows from at most so many texts.
SAMPLE = 6000

STATES = 6
WINDOW = 128  # bytes read from a fresh state
LEARNED_WINDOW = 64

#: The counts of so many languages are broadcast; of more, they are joined by a shuffle.
MOST_LANGUAGES = 100_000
_DRAWN = 1_000_003  # ids are drawn by their hashes modulo this prime

#: Texts of each language that are learned from at least, however many languages there are.
LEAST_PER_LANGUAGE = 20
WINDOWS_PER_TEXT = 4
WIDTH = 2048  # windows read side by side


class Reader:
    """One direction: ``h = c + z * (h_before - c)`` with gates ``z, r`` and candidate ``c``."""

    def __init__(self, table: np.ndarray, inner: np.ndarray):
        self.table, self.inner = table, inner  # 3 states x 256 bytes, 3 states x states

    @classmethod
    def fresh(cls, rng: np.random.Generator) -> Reader:
        table = rng.normal(0, 0.3, (3 * STATES, 256))
        table[: 2 * STATES] += 0.5
        return cls(table.astype(np.float32), rng.normal(0, 0.3, (3 * STATES, STATES)).astype(np.float32))

    def read(self, order: range, bytes_at: np.ndarray, alive: np.ndarray | None, out: np.ndarray) -> None:
        """States after each step into ``out`` (steps x states x windows); a dead position leaves state zero."""
        s, width = STATES, bytes_at.shape[1]
        h = np.zeros((s, width), np.float32)
        into, from_h = np.empty((3 * s, width), np.float32), np.empty((3 * s, width), np.float32)
        for t in order:
            for row in range(3 * s):
                self.table[row].take(bytes_at[t], out=into[row], mode="clip")
            np.dot(self.inner, h, out=from_h)
            gates = into[: 2 * s]
            gates += from_h[: 2 * s]
            np.maximum(gates, 0, out=gates)
            np.minimum(gates, 1, out=gates)
            c = from_h[2 * s :]
            c *= gates[s:]
            c += into[2 * s :]
            np.maximum(c, -1, out=c)
            np.minimum(c, 1, out=c)
            h -= c
            h *= gates[:s]
            h += c
            if alive is not None:
                h *= alive[t]
            out[t] = h

    def learn(self, order: range, bytes_at: np.ndarray, out: np.ndarray, slope: np.ndarray) -> list[np.ndarray]:
        """Slopes of table and inner weights, given the loss slopes of all states, back through time."""
        s, (steps, width) = STATES, bytes_at.shape
        d_in = np.zeros((steps, 3 * s, width), np.float32)
        d_inner = np.zeros_like(self.inner)
        d_h = np.zeros((s, width), np.float32)
        order = list(order)
        for k in range(steps - 1, -1, -1):
            t = order[k]
            h = out[order[k - 1]] if k else np.zeros((s, width), np.float32)
            into, from_h = self.table[:, bytes_at[t]], self.inner @ h
            gates = np.clip(into[: 2 * s] + from_h[: 2 * s], 0, 1)
            z, r, q = gates[:s], gates[s:], from_h[2 * s :]
            raw = into[2 * s :] + r * q
            c = np.clip(raw, -1, 1)
            d_h += slope[t]
            d_raw = d_h * (1 - z) * (np.abs(raw) < 1)
            d_gates = np.concatenate([d_h * (h - c), d_raw * q]) * ((gates > 0) & (gates < 1))
            back = np.concatenate([d_gates, d_raw * r])
            d_in[t] = np.concatenate([d_gates, d_raw])
            d_inner += back @ h.T
            d_h = d_h * z + self.inner.T @ back
        flat = bytes_at.ravel()
        rows = d_in.transpose(1, 0, 2).reshape(3 * s, -1)
        return [np.stack([np.bincount(flat, row, 256) for row in rows]), d_inner]


@dataclass
class Network:
    languages: list[str]
    ahead: Reader
    behind: Reader
    out: np.ndarray  # languages x (states of both directions and a constant)

    def states(self, bytes_at: np.ndarray, alive: np.ndarray | None) -> np.ndarray:
        steps, width = bytes_at.shape
        both = np.empty((2, steps, STATES, width), np.float32)
        self.ahead.read(range(steps), bytes_at, None, both[0])
        self.behind.read(range(steps - 1, -1, -1), bytes_at, alive, both[1])
        return both

    def chances(self, both: np.ndarray) -> np.ndarray:
        """Of every language at every position: steps x languages x windows."""
        odds = self.out[:, :STATES] @ both[0] + self.out[:, STATES : 2 * STATES] @ both[1]
        odds += self.out[:, -1:]
        odds -= odds.max(axis=1, keepdims=True)
        np.exp(odds, out=odds)
        odds /= odds.sum(axis=1, keepdims=True)
        return odds

    def texts(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The mean chances over all positions of each text: texts x languages."""
        size = np.diff(bounds)
        windows = -(-size // WINDOW)
        text = np.repeat(np.arange(len(size)), windows)
        begin = bounds[:-1][text] + ranges(np.zeros(len(size), np.int64), windows) * WINDOW
        length = np.minimum(WINDOW, bounds[1:][text] - begin)
        total = np.zeros((len(size), len(self.languages)))
        steps = np.arange(WINDOW)[:, None]
        for at in range(0, len(text), WIDTH):
            cut = slice(at, at + WIDTH)
            upto = int(length[cut].max())
            where = begin[cut] + steps[:upto]
            alive = (steps[:upto] < length[cut]).astype(np.float32)
            bytes_at = data.take(where, mode="clip").astype(np.intp)
            chances = self.chances(self.states(bytes_at, alive))
            chances *= alive[:, None]
            pooled = chances.sum(axis=0)
            for k in range(len(self.languages)):
                total[:, k] += np.bincount(text[cut], pooled[k], len(size))
        return total / np.maximum(size, 1)[:, None]


def fit(windows: np.ndarray, labels: np.ndarray, languages: list[str], rounds: int = 400, seed: int = 3) -> Network:
    """Cross entropy at every position of the windows (windows x bytes), by Adam."""
    rng = np.random.default_rng(seed)
    net = Network(languages, Reader.fresh(rng), Reader.fresh(rng), np.empty(0))
    net.out = rng.normal(0, 0.3, (len(languages), 2 * STATES + 1)).astype(np.float32)
    if not len(windows) or len(languages) < 2:
        return net
    values = [net.ahead.table, net.ahead.inner, net.behind.table, net.behind.inner, net.out]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    steps = windows.shape[1]
    for n in range(1, rounds + 1):
        pick = rng.integers(0, len(windows), 256)
        bytes_at = windows[pick].T.astype(np.intp)
        both = net.states(bytes_at, None)
        slope = net.chances(both)
        slope[:, labels[pick], np.arange(len(pick))] -= 1
        slope /= steps * len(pick)
        d_out = np.concatenate(
            [np.einsum("tlw,tsw->ls", slope, both[0]), np.einsum("tlw,tsw->ls", slope, both[1]),
             slope.sum(axis=(0, 2))[:, None]], axis=1,
        )
        slopes = [
            *net.ahead.learn(range(steps), bytes_at, both[0], net.out[:, :STATES].T @ slope),
            *net.behind.learn(
                range(steps - 1, -1, -1), bytes_at, both[1], net.out[:, STATES : 2 * STATES].T @ slope
            ),
            d_out,
        ]
        pace = 0.02 * (1 - 0.9 * n / rounds)
        for v, a, b, g in zip(values, first, second, slopes, strict=True):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            v -= (pace * (a / (1 - 0.9**n)) / (np.sqrt(b / (1 - 0.99**n)) + 1e-7)).astype(np.float32)
    return net


def _window_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows spread evenly over each text; a text too short for one fills one by being said again and again."""
    for batch in batches:
        data, bounds = byte_column(batch["text"])
        size = np.diff(bounds)
        long, short = np.flatnonzero(size >= LEARNED_WINDOW), np.flatnonzero((size > 0) & (size < LEARNED_WINDOW))
        row = np.repeat(long, WINDOWS_PER_TEXT)
        part = np.tile(np.arange(WINDOWS_PER_TEXT), len(long)) / (WINDOWS_PER_TEXT - 1)
        begin = bounds[row] + ((size[row] - LEARNED_WINDOW) * part).astype(np.int64)
        place = np.arange(LEARNED_WINDOW)
        again = place % (size[short] + 1)[:, None]  # with a space between
        padded = np.append(data, np.uint8(0x20))
        said = np.where(again < size[short][:, None], bounds[short][:, None] + again, len(data))
        cut = padded[np.concatenate([begin[:, None] + place, said])]
        if not len(cut):
            continue
        window = pa.FixedSizeBinaryArray.from_buffers(
            pa.binary(LEARNED_WINDOW), len(cut), [None, pa.py_buffer(np.ascontiguousarray(cut))]
        )
        yield pa.RecordBatch.from_arrays(
            [batch["lang"].take(pa.array(np.concatenate([row, short]))), window.cast(pa.binary())], names=["lang", "window"]
        )


def train(documents: DataFrame, sample: int = SAMPLE) -> Network:
    """Learn from texts with a language that are not held out, the same number of ids for every language.

    Of each language as many ids as its even part of ``sample``, and at least ``LEAST_PER_LANGUAGE``, are
    drawn by their hashes, so that a rare language is learned from a table of any size. The numbers hold on
    average: an id is drawn or not by itself. Each text gives a few windows of 64 bytes to the driver.
    """
    known = documents.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    known = known.where(F.octet_length("text") > 0)
    counts = known.groupBy("lang").agg(F.count("*").alias("n"))
    languages = counts.count()
    quota = max(LEAST_PER_LANGUAGE, sample // max(1, languages))
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(_DRAWN)) < F.ceil(F.lit(_DRAWN * quota) / F.col("n"))
    side = F.broadcast(counts) if languages <= MOST_LANGUAGES else counts
    rows = known.join(side, "lang").where(drawn)
    table = rows.select("text", "lang").mapInArrow(_window_batches, "lang string, window binary").toArrow().sort_by(
        [("lang", "ascending"), ("window", "ascending")]
    )
    found = table["lang"].to_pylist()
    languages = sorted(set(found))
    windows = np.frombuffer(b"".join(table["window"].to_pylist()), np.uint8).reshape(-1, LEARNED_WINDOW)
    number = {language: k for k, language in enumerate(languages)}
    return fit(windows, np.array([number[x] for x in found], np.int64), languages)


def predict(documents: DataFrame, network: Network) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every document."""

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch["text"]):
                chances = network.texts(block.data, block.bounds)
                best = chances.argmax(axis=1)
                part = batch.slice(block.first, len(block))
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"],
                        part["lettered"],
                        pa.array([network.languages[k] for k in best], pa.string()),
                        pa.array(np.clip(chances[np.arange(len(best)), best], 0, 1)),
                    ],
                    names=["doc_id", "lettered", "lang_pred", "score"],
                )

    text = F.col("text").cast("string")
    rows = documents.select(
        F.col("doc_id").cast("long"),
        text.alias("text"),
        F.coalesce(F.regexp_like(text, F.lit(r"\p{L}")), F.lit(False)).alias("lettered"),
    )
    if network.languages:
        schema = "doc_id long, lettered boolean, lang_pred string, score double"
        rows = rows.mapInArrow(predicted, schema)
    else:
        rows = rows.withColumn("lettered", F.lit(False)).withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)})
    return rows.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.when(F.col("lettered"), F.col("lang_pred")).otherwise("und").alias("lang_pred"),
        F.when(F.col("lettered"), F.col("score")).otherwise(0.0).alias("score"),
    )
