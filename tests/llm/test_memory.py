import os
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tarmac.llm import line_dedup, memory, ngram_join
from tarmac.llm.buffers import blocks, lists, sliced
from tarmac.llm.memory import give_back

ROLLUP = "/proc/self/smaps_rollup"


def own_mb() -> int:
    with open(ROLLUP) as file:
        return int(re.search(r"\nPss_Anon:\s+(\d+)", file.read())[1]) // 1024


@pytest.fixture(scope="module")
def batch():
    """20 MB of texts, of different words each."""
    rnd = random.Random(9)
    some = np.array(["".join(rnd.choices("abcdefghijklmnop", k=rnd.randint(2, 8))) for _ in range(60_000)])
    texts = [" ".join(np.random.default_rng(i).choice(some, 600)) for i in range(6000)]
    texts = [t[:1500] + "\n" + t[1500:] for t in texts]
    columns = [pa.array(range(6000), pa.int64()), pa.array([1] * 6000, pa.int32()), pa.array(texts)]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "mark", "text"])


@pytest.mark.skipif(not os.path.exists(ROLLUP), reason="needs the memory of the process as Linux tells it")
@pytest.mark.parametrize("operator", ["lines", "meetings", "prefixes"])
def test_a_task_leaves_no_freed_memory_in_its_worker(spark, make, monkeypatch, batch, operator):
    tasks, documents = [], make([(1, "some words")])
    plain = type(documents).mapInArrow
    monkeypatch.setattr(type(documents), "mapInArrow", lambda self, f, *a, **b: tasks.append(f) or plain(self, f, *a, **b))
    if operator == "lines":
        line_dedup.line_table(documents)
    elif operator == "meetings":
        line_dedup.meetings(documents)
    else:
        ngram_join.shared_prefixes(documents, ngram_join.Orders(np.empty(0, np.int64), 12))
    (task,) = tasks
    small = batch.slice(0, 1)
    for _ in task(iter([small])):  # what the first use of a library takes stays
        pass
    give_back()
    before = own_mb()
    for _ in task(iter([batch])):
        pass
    assert own_mb() - before < 60  # 32 of it are the powers that hashes are made of


def test_memory_is_given_back_once_the_last_rows_are_taken(monkeypatch):
    given = []
    monkeypatch.setattr(memory, "give_back", lambda: given.append(1))
    rows = memory.returning(lambda batches: iter(batches))(iter([1, 2]))
    assert [next(rows), next(rows), given] == [1, 2, []]
    assert list(rows) == [] and given == [1]
    assert memory.returning_group(lambda table: table + 1)(2) == 3 and given == [1, 1]


def test_parts_and_slices_hold_every_row_in_order():
    texts = ["", "abc", "x" * 50, "", "de", "y" * 9, ""]
    (block,) = blocks(pa.array(texts))
    for size in (1, 4, 12, 1000):
        parts = list(block.parts(size))
        assert [p.text(i).decode() for p in parts for i in range(len(p))] == texts
        assert [p.first for p in parts] == np.cumsum([0, *map(len, parts)])[:-1].tolist()
    batch = pa.RecordBatch.from_arrays([lists(np.arange(100), np.arange(14) % 8)], names=["a"]).slice(1)
    for parts in (1, 3, 16):
        cut = list(sliced(batch, parts))
        assert [x for c in cut for x in c["a"].to_pylist()] == batch["a"].to_pylist() and len(cut) <= parts
    assert not list(sliced(batch.slice(0, 0)))
