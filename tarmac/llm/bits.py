"""A bit table of bounded size for hashes, which spares a scan most of the rows that a later join drops."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

#: 2**20 words of 64 bits. Beyond some ten million keys the table lets most rows pass, and the join does the work.
WORDS_LOG2 = 20


def bit_table(hashes: DataFrame) -> np.ndarray:
    """The table in which the bits of all values of ``hashes (h)`` are set; at most 8 MB reach the driver."""
    word = F.shiftrightunsigned(F.col("h"), 64 - WORDS_LOG2)
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {58 - WORDS_LOG2}) & 63 as int))")
    rows = hashes.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    table = np.zeros(1 << WORDS_LOG2, np.int64)
    table[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return table.view(np.uint64)


def likely(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Where the hashes' bits are set: all that are in the table, and few others."""
    h = hashes.view(np.uint64)
    words = table[(h >> np.uint64(64 - WORDS_LOG2)).astype(np.int64)]
    return np.flatnonzero((words >> ((h >> np.uint64(58 - WORDS_LOG2)) & np.uint64(63))) & np.uint64(1))
