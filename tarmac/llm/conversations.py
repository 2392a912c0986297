"""Repair of the structure of conversations, by alignment with the alternating grammar.

A sound conversation is empty, or an optional system turn and then pairs of a user's and an assistant's turn.
Its turns are aligned, as Wagner and Fischer align two strings, to the grammar's string of every feasible
length. All these strings end alike, so one table from the end serves them all; only the cells in Ukkonen's
band around the diagonal are filled, whose width follows from the cost of a repair already at hand. Of equally
cheap alignments the audits, traced back through the table, are compared, and the least one is kept.

Edits: keep (free), rerole to user or assistant (1), delete (2), insert an empty turn of either (5); a turn
that is truncated and not deleted adds 5. Blank turns and repeated ones (same role and text) must be deleted.

The conversations of up to ``LONG_TURNS`` turns and ``LONG_BYTES`` bytes are gathered whole, one row each.
Longer ones, which a table of that kind does not fit, are never gathered: sorted by Spark, they stream twice
through a task. Backwards, the least cost to go from each state of the grammar gives every turn its best edits;
forwards, these are followed. Both ways give the same least audit. Only a conversation's audit, a byte for
each turn, is held.

Null roles and texts read as one space: a space is no role of the grammar, and a text without visible
characters is blank. Rows with a null id are one conversation. Null turns come first; rows with the same turn
stand in the order of role and text. A conversation without rows is sound: zeros and an empty audit. Texts
are read whole. An empty table has no rows. Extra columns, of whatever name, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tarmac.session import materialize

#: Larger conversations stream through a task; the bounds only choose the way, not the result.
LONG_TURNS = 512
LONG_BYTES = 4 << 20

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}
_PAIRS = {"su", "ua", "au"}
_BLANK = " \t\n\x0b\x0c\r"
_FAR = 1 << 60

# A turn is one letter to the alignment: its role's initial (or ``o`` for others), in capitals if truncated,
# or ``x`` if it must be deleted.
_MUST_GO = "x"


def coded(roles: list[str], texts: list[str]) -> tuple[str, dict[str, int]]:
    """The letters of a conversation's turns, and how many are blank, duplicate and truncated."""
    seen: set[tuple[str, str]] = set()
    letters, faults = [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for role, text in zip(roles, texts, strict=True):
        letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
        visible = text.strip(_BLANK)
        if not visible:
            faults["blank"] += 1
            letter = _MUST_GO
        elif (role, text) in seen:
            faults["duplicate"] += 1
            letter = _MUST_GO
        elif visible[-1] not in ".!?":
            faults["truncated"] += 1
            letter = letter.upper()
        seen.add((role, text))
        letters.append(letter)
    return "".join(letters), faults


def _incumbent(letters: str) -> int:
    """The cost of a plain repair: delete what is faulty, rerole what does not alternate, close the last pair."""
    cost, wanted, opened = 0, "u", False
    for letter in letters:
        if letter == _MUST_GO or letter.isupper():
            cost += DELETE
        elif letter == "s" and not opened:
            wanted, opened = "u", True
            cost += DELETE  # it may turn out that nothing follows
        else:
            cost += 0 if letter == wanted else REROLE
            wanted, opened = "a" if wanted == "u" else "u", True
    return min(cost + (INSERT if wanted == "a" else 0), DELETE * len(letters))


class _Table:
    """Least costs to align the turns from ``i`` on with the last ``r`` letters of ``...uaua``, within the band."""

    def __init__(self, letters: str):
        self.letters, n = letters, len(letters)
        bound = _incumbent(letters)
        # beyond, deletes or inserts alone would cost more than the repair at hand
        self.down, self.up = bound // DELETE, bound // INSERT
        self.rows: list[list[int]] = [[]] * (n + 1)
        for i in range(n, -1, -1):
            left = n - i
            first = max(0, left - self.down)
            row: list[int] = []
            for r in range(first, left + self.up + 1):
                if i == n:
                    row.append(INSERT * r)
                    continue
                cost = DELETE + self.at(i + 1, r)
                if r:
                    cost = min(cost, self.match(i, r) + self.at(i + 1, r - 1))
                    if r > first:
                        cost = min(cost, INSERT + row[-1])
                row.append(cost)
            self.rows[i] = row

    def at(self, i: int, r: int) -> int:
        place = r - max(0, len(self.letters) - i - self.down)
        return self.rows[i][place] if 0 <= place < len(self.rows[i]) else _FAR

    def match(self, i: int, r: int) -> int:
        """The cost of turn ``i`` standing where ``r`` letters are left."""
        letter = self.letters[i]
        if letter == _MUST_GO:
            return _FAR
        return (0 if letter.lower() == "au"[r % 2 == 0] else REROLE) + (TRUNCATED if letter.isupper() else 0)

    def audit(self, i: int, r: int) -> str:
        """The least audit of the cheapest alignments from ``i, r`` on; its letters in the order of ASCII."""
        found, n = [], len(self.letters)
        while i < n or r:
            cost = self.at(i, r)
            if i < n and cost == DELETE + self.at(i + 1, r):
                found.append("D")
                i += 1
            elif r and cost == INSERT + self.at(i, r - 1):
                found.append("I")
                r -= 1
            else:
                found.append("K" if self.letters[i].lower() == "au"[r % 2 == 0] else "R")
                i, r = i + 1, r - 1
        return "".join(found)


@lru_cache(100_000)
def align(letters: str) -> tuple[int, str]:
    """The least cost and, of the repairs that cost so much, the least audit."""
    table, n = _Table(letters), len(letters)
    longest = n + table.up
    ends = [(table.at(0, r), 0, r, False) for r in range(0, longest + 1, 2)]
    for i, letter in enumerate(letters):
        if letter in "sS":  # kept as the first turn; all before it go
            cost = DELETE * i + (TRUNCATED if letter == "S" else 0)
            ends += [(cost + table.at(i + 1, r), i, r, True) for r in range(2, n - i + table.up, 2)]
    least = min(end[0] for end in ends)
    audits = [
        "D" * i + "K" + table.audit(i + 1, r) if system else table.audit(i, r)
        for cost, i, r, system in ends
        if cost == least
    ]
    return least, min(audits)


class Follower:
    """Follows edits turn by turn: cost, audit and the hash of the repaired text, or the repaired turns."""

    def __init__(self, keep_turns: bool):
        self.cost, self.audit, self.state, self.kept = 0, [], "", 0
        self.hash = hashlib.sha256()
        self.turns: list[tuple[str, str, str]] | None = [] if keep_turns else None

    def edit(self, edit: str, letter: str = "", role: str = "", text: str = "") -> None:
        self.audit.append(edit)
        if edit == "D":
            self.cost += DELETE
            return
        if edit == "K":
            self.state = role[:1]
        else:
            self.state = "a" if self.state == "u" else "u"
            role = ROLES[self.state]
            self.cost += INSERT if edit == "I" else REROLE
        if letter.isupper():
            self.cost += TRUNCATED
        if self.turns is not None:
            self.turns.append((edit, role, text))
        self.hash.update(f"{chr(10) if self.kept else ''}{role}:{text}".encode())
        self.kept += 1


_SUMMARY = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)
_TURN = "place long, edit string, role string, text string"
_NAMES = {s: [f.split()[0] for f in s.split(", ")] for s in (_SUMMARY, _TURN)}


def _gaps(turns: list[int | None]) -> int:
    known = {turn for turn in turns if turn is not None}
    return max(known) - min(known) + 1 - len(known) if known else 0


def _illegal(roles: list[str]) -> int:
    return sum(a[:1] + b[:1] not in _PAIRS for a, b in zip(roles, roles[1:], strict=False))


def _gathered(keep_turns: bool):
    """Repairs conversations that are one row each: ``conv_id, turns``, a sorted list of turn, role and text."""

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["turns"]
            bounds = (lists.offsets.to_numpy() - lists.offsets[0].as_py()).tolist()
            turns, roles, texts = (c.to_pylist() for c in lists.flatten().flatten())
            rows = []
            for conv, a, b in zip(batch["conv_id"].to_pylist(), bounds, bounds[1:], strict=False):
                letters, faults = coded(roles[a:b], texts[a:b])
                _, audit = align(letters)
                follower, place = Follower(keep_turns), a
                for edit in audit:
                    if edit == "I":
                        follower.edit(edit)
                    else:
                        follower.edit(edit, letters[place - a], roles[place], texts[place])
                        place += 1
                if keep_turns:
                    rows += [(conv, i, *turn) for i, turn in enumerate(follower.turns)]
                else:
                    counts = (_gaps(turns[a:b]), *faults.values(), _illegal(roles[a:b]))
                    rows.append((conv, *counts, follower.cost, audit, follower.hash.hexdigest()))
            yield _batch(batch["conv_id"].type, rows, _TURN if keep_turns else _SUMMARY)

    return repaired


def _batch(id_type: pa.DataType, rows: list[tuple], schema: str) -> pa.RecordBatch:
    types = [id_type, *[pa.int64() if f.endswith(" long") else pa.string() for f in schema.split(", ")]]
    columns = zip(*rows, strict=True) if rows else [[] for _ in types]
    arrays = [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=["conv_id", *_NAMES[schema]])


# The states of the grammar, by the last turn: none, system, user, assistant.
_STATES = ("", "s", "u", "a")
_AFTER = {"": "u", "s": "u", "u": "a", "a": "u"}  # the state that a user's or assistant's turn leads to
_CLOSING = {"": "", "s": "II", "u": "I", "a": ""}


def _step_back(ahead: dict[str, int], letter: str) -> tuple[dict[str, int], str]:
    """Least costs to go before a turn, given those after it, and from each state the best edits up to the turn."""
    through: dict[str, dict[str, int]] = {}
    for state in _STATES:
        edits = {"D": DELETE + ahead[state]}
        if letter != _MUST_GO:
            extra, then = TRUNCATED if letter.isupper() else 0, _AFTER[state]
            same = letter.lower() == then
            edits["K" if same else "R"] = (0 if same else REROLE) + extra + ahead[then]
            if not state and letter.lower() == "s":
                edits["K"] = extra + ahead["s"]
        through[state] = edits
    costs = {state: min(edits.values()) for state, edits in through.items()}
    for _ in _STATES:
        costs = {state: min(cost, INSERT + costs[_AFTER[state]]) for state, cost in costs.items()}
    best = []
    for state in _STATES:
        edits = ""
        while True:
            cost = costs[state]
            if through[state]["D"] == cost:
                edits += "D"
                break
            if INSERT + costs[_AFTER[state]] == cost:
                edits, state = edits + "I", _AFTER[state]
                continue
            edits += min(edit for edit, c in through[state].items() if c == cost)
            break
        best.append(edits)
    return costs, ",".join(best)


def _backwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The best edits of every turn, for turns that come conversation by conversation and last ones first."""
    step = lru_cache(10_000)(lambda *ahead, letter: _step_back(dict(zip(_STATES, ahead, strict=True)), letter))
    conv, ahead = None, None
    for batch in batches:
        best = []
        for own, letter in zip(batch["conv_id"].to_pylist(), batch["letter"].to_pylist(), strict=True):
            if ahead is None or own != conv:
                conv, ahead = own, [INSERT * len(_CLOSING[s]) for s in _STATES]
            least = min(ahead)  # only differences matter, and without the rest few cases occur
            costs, edits = step(*[cost - least for cost in ahead], letter=letter)
            ahead = list(costs.values())
            best.append(edits)
        yield pa.RecordBatch.from_arrays([batch["at"], pa.array(best, pa.string())], names=["at", "best"])


def _forwards(keep_turns: bool):
    """Follows the best edits of conversations whose turns come in order."""

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, follower, last, illegal, begun, id_type = None, None, None, 0, 0, None

        def turns() -> Iterator[pa.RecordBatch]:
            """The repaired turns so far."""
            nonlocal begun
            if keep_turns and follower.turns:
                rows = [(conv, begun + i, *turn) for i, turn in enumerate(follower.turns)]
                begun += len(rows)
                follower.turns.clear()
                yield _batch(id_type, rows, _TURN)

        def close() -> Iterator[pa.RecordBatch]:
            for edit in _CLOSING[follower.state]:
                follower.edit(edit)
            if keep_turns:
                yield from turns()
            else:
                row = (conv, 0, 0, 0, 0, illegal, follower.cost, "".join(follower.audit), follower.hash.hexdigest())
                yield _batch(id_type, [row], _SUMMARY)

        for batch in batches:
            id_type = batch["conv_id"].type
            columns = (batch[c].to_pylist() for c in ("conv_id", "letter", "role", "text", "best"))
            for own, letter, role, text, best in zip(*columns, strict=True):
                if follower is None or own != conv:
                    if follower:
                        yield from close()
                    conv, follower, illegal, begun = own, Follower(keep_turns), 0, 0
                elif last[:1] + role[:1] not in _PAIRS:
                    illegal += 1
                last = role
                for edit in best.split(",")[_STATES.index(follower.state)]:
                    if edit == "I":
                        follower.edit(edit)
                    else:
                        follower.edit(edit, letter, role, text)
            yield from turns()
        if follower:
            yield from close()

    return repaired


def _letter(role: Column, text: Column, first: Column) -> Column:
    """As ``coded`` has it, for one row; and the fault that counts."""
    visible = F.rtrim(text, F.lit(_BLANK))
    letter = F.when(F.substring(role, 1, 1).isin("s", "u", "a"), F.substring(role, 1, 1)).otherwise("o")
    fault = (
        F.when(visible == "", "blank").when(~first, "duplicate").when(~F.right(visible, F.lit(1)).isin(".", "!", "?"), "truncated")
    )
    must_go = F.coalesce(fault != "truncated", F.lit(False))
    return F.struct(
        F.when(must_go, _MUST_GO).when(fault.isNotNull(), F.upper(letter)).otherwise(letter).alias("letter"),
        fault.alias("fault"),
    )


def _streamed(rows: DataFrame, keep_turns: bool) -> DataFrame:
    """Repairs the conversations of ``conv_id, turn, role, text`` without gathering any."""
    id_type = rows.schema["conv_id"].dataType.simpleString()
    # range bounds go to the driver, so they are cut; the order within a range is by whole texts
    bounds = ["conv_id", "turn", F.substring("role", 1, 64), F.substring("text", 1, 64)]
    placed = rows.repartitionByRange(*bounds).sortWithinPartitions("conv_id", "turn", "role", "text")
    placed = materialize(placed.withColumn("at", F.monotonically_increasing_id()), "long-conversations")
    firsts = placed.groupBy("conv_id", "role", "text").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    judged = placed.join(firsts, "at", "left")
    code = _letter(F.col("role"), F.col("text"), F.coalesce("first", F.lit(False)))
    judged = materialize(judged.select("at", "conv_id", "turn", "role", "text", code.alias("code")), "coded-turns")
    letters = judged.select("conv_id", "at", "code.letter")
    back = letters.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("at"))
    best = back.mapInArrow(_backwards, "at long, best string")
    ahead = judged.select("at", "conv_id", "code.letter", "role", "text").join(best, "at")
    ahead = ahead.repartition("conv_id").sortWithinPartitions("conv_id", "at")
    if keep_turns:
        return ahead.mapInArrow(_forwards(True), f"conv_id {id_type}, {_TURN}")
    followed = ahead.mapInArrow(_forwards(False), f"conv_id {id_type}, {_SUMMARY}")
    per_turn = judged.groupBy("conv_id", "turn").agg(
        *[F.count_if(F.col("code.fault") == fault).alias(fault) for fault in ("blank", "duplicate", "truncated")]
    )
    counts = per_turn.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"),
        *[F.sum(fault).alias(fault) for fault in ("blank", "duplicate", "truncated")],
    )
    counts = counts.withColumnRenamed("conv_id", "counted")
    joined = followed.drop(*_NAMES[_SUMMARY][:4]).join(counts, F.col("conv_id").eqNullSafe(F.col("counted")))
    return joined.select("conv_id", *_NAMES[_SUMMARY])


def _turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text``, nulls as one space, and ``gone``, true for rows that only name a conversation."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    return conversations.select("conv_id", F.col("turn").cast("long"), *text, F.lit(False).alias("gone"))


def _repaired(turns: DataFrame, keep_turns: bool, long_turns: int, long_bytes: int) -> DataFrame:
    id_type = turns.schema["conv_id"].dataType.simpleString()
    there, held = ~F.col("gone"), F.octet_length("text") + F.octet_length("role")
    sizes = turns.where(there).groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(held).alias("bytes"))
    large = sizes.where((F.col("n") > long_turns) | (F.col("bytes") > long_bytes)).select(F.col("conv_id").alias("large"))
    large = materialize(large, "long-ids")
    some = not large.isEmpty()
    is_large = F.col("conv_id").eqNullSafe(F.col("large"))
    short = turns.join(large, is_large, "left_anti") if some else turns
    turn = F.when(there, F.struct("turn", "role", "text"))
    gathered = short.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    found = gathered.mapInArrow(_gathered(keep_turns), f"conv_id {id_type}, {_TURN if keep_turns else _SUMMARY}")
    if some:
        rows = turns.where(there).join(large, is_large, "left_semi").drop("gone")
        found = found.unionByName(_streamed(rows, keep_turns))
    return found


def audits(conversations: DataFrame, long_turns: int = LONG_TURNS, long_bytes: int = LONG_BYTES) -> DataFrame:
    """One row for each conversation: its faults, the cost and audit of its repair and the repaired text's hash."""
    return _repaired(_turns(conversations), False, long_turns, long_bytes)


def repaired(conversations: DataFrame, long_turns: int = LONG_TURNS, long_bytes: int = LONG_BYTES) -> DataFrame:
    """The repaired turns ``conv_id, place, edit, role, text``; places are numbered from 0."""
    return _repaired(_turns(conversations), True, long_turns, long_bytes)


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows as ``_turns`` has them, with the faults that the checksum of id and turn calls for."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = _turns(conversations.select("conv_id", "turn", "role", "text")).withColumn("damage", F.crc32(key) % 20)
    damage = F.col("damage")
    text = F.when(damage == 1, "").when(damage == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.withColumns(
        {
            "gone": damage == 0,
            "text": text,
            "role": F.when(damage == 4, "user").otherwise(F.col("role")),
            "copy": F.explode(F.when(damage == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))),
        }
    )
    return rows.drop("damage", "copy")


def digest(conversations: DataFrame, long_turns: int = LONG_TURNS, long_bytes: int = LONG_BYTES) -> DataFrame:
    """``audits`` of the damaged conversations."""
    return _repaired(damaged(conversations), False, long_turns, long_bytes)
