import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tarmac.llm import conversations as conv

SCHEMA = "conv_id bigint, turn bigint, role string, text string, gone string, At int, n string, turns map<string,int>, best int"
GRAMMAR = re.compile(r"(s?(ua)+)?")
NO_ROWS = hashlib.sha256(b"").hexdigest()


def least_repair(turns):
    """Of all repairs, tried one after another without any table: the cheapest and then least audit."""
    best = (10**9, "")
    for inserted in range(len(turns) + 3):
        for audit in sequences(turns, inserted):
            cost, output = applied(turns, audit)
            if cost is not None and (cost, audit) < best and GRAMMAR.fullmatch("".join(r[:1] or "-" for r, _ in output)):
                best = (cost, audit)
    return best


def sequences(turns, inserted):
    for edits in itertools.product(*["D" if fault in ("blank", "duplicate") else "DKR" for _, _, fault in turns]):
        for places in itertools.combinations_with_replacement(range(len(turns) + 1), inserted):
            yield "".join("I" * places.count(i) + (edits[i] if i < len(turns) else "") for i in range(len(turns) + 1))


def applied(turns, audit):
    """Cost and rows of an audit; reroled and inserted rows take the role that alternates."""
    cost, output, rows = 0, [], iter(turns)
    for edit in audit:
        other = "assistant" if output and output[-1][0][:1] == "u" else "user"
        role, text, fault = ("", "", None) if edit == "I" else next(rows)
        cost += {"K": 0, "R": 1, "D": 2, "I": 5}[edit] + (5 if fault == "truncated" and edit != "D" else 0)
        if edit != "D":
            output.append((role if edit == "K" else other, text))
    return cost, output


def table_of_states(letters):
    """Least cost and audit by a shortest path over the grammar's states, whole audits compared at every step."""
    after = {"": "u", "s": "u", "u": "a", "a": "u"}
    reach = {"": (0, "")}

    def with_inserts(reach):
        for _ in range(4):
            for state, (cost, audit) in list(reach.items()):
                new = (cost + 5, audit + "I")
                if after[state] not in reach or new < reach[after[state]]:
                    reach[after[state]] = new
        return reach

    for letter in letters:
        reach, then = with_inserts(reach), {}
        for state, (cost, audit) in reach.items():
            options = [(state, cost + 2, "D")]
            if letter != "x":
                extra = 5 if letter.isupper() else 0
                kept = letter.lower() == after[state]
                options.append((after[state], cost + extra + (not kept), "K" if kept else "R"))
                if not state and letter.lower() == "s":
                    options.append(("s", cost + extra, "K"))
            for target, total, edit in options:
                if target not in then or (total, audit + edit) < then[target]:
                    then[target] = (total, audit + edit)
        reach = then
    reach = with_inserts(reach)
    return min(reach[state] for state in ("", "a") if state in reach)


def damaged(rows):
    found = defaultdict(list)
    for cid, turn, role, text in rows:
        found[cid] += []
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if cid is None else cid}:{' ' if turn is None else turn}"
        damage = zlib.crc32(key.encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(damage, text)
        role = "user" if damage == 4 else role
        found[cid] += [(turn, role, text)] * {0: 0, 3: 2}.get(damage, 1)
    return found


def expected(rows, repair):
    for cid, turns in damaged(rows).items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        judged, seen = [], set()
        for _, role, text in turns:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else None
            fault = fault or (None if solid[-1] in ".!?" else "truncated")
            seen.add((role, text))
            judged.append((role, text, fault))
        known = [t for t, _, _ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        faults = [sum(f == name for _, _, f in judged) for name in ("blank", "duplicate", "truncated")]
        pairs = zip(judged, judged[1:], strict=False)
        illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in pairs)
        cost, audit = repair(judged) if judged else (0, "")
        _, output = applied(judged, audit)
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in output).encode()).hexdigest()
        yield cid, gaps, *faults, illegal, cost, audit, sha


def letters_of(judged):
    for role, _, fault in judged:
        letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
        yield "x" if fault in ("blank", "duplicate") else letter.upper() if fault else letter


def by_states(judged):
    return table_of_states("".join(letters_of(judged)))


def test_alignment_equals_trying_every_repair():
    turns = {
        **{c: ({"s": "system", "u": "user", "a": "assistant", "o": "tool"}[c], "t", None) for c in "suao"},
        **{c: ({"S": "system", "U": "user", "A": "assistant", "O": "tool"}[c], "t", "truncated") for c in "SUAO"},
        "x": ("user", "", "blank"),
    }
    for n in range(4):
        for letters in itertools.product("suaoSUx", repeat=n):
            assert conv.align("".join(letters)) == least_repair([turns[c] for c in letters]), letters


def test_alignment_equals_a_shortest_path_over_states():
    rnd = random.Random(5)
    for _ in range(3000):
        letters = "".join(rnd.choices("suaoSUAOx", weights=(1, 6, 6, 1, 1, 2, 2, 1, 2), k=rnd.randrange(40)))
        assert conv.align(letters) == table_of_states(letters), letters


@pytest.fixture(scope="module")
def odd_rows():
    rnd = random.Random(9)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "User", "unknown", "é"]
    texts = ["Yes.", "No!", "Why?", "cut", "Yes. \n", "", " \t\x0b", None, "Ünd.  ", "ok?　", "1.\n2"]
    rows = []
    for cid in range(400):
        for turn in range(rnd.randrange(1, 7)):
            role = rnd.choice(roles) if rnd.random() < 0.3 else ("user", "assistant")[turn % 2]
            text = rnd.choice(texts) if rnd.random() < 0.6 else f"Text {rnd.random()}."
            rows.append((cid, rnd.choice([turn, turn, turn, None, turn + 3]), role, text))
    rows += [(None, t, ("user", "assistant")[(t or 0) % 2], f"T {t}.") for t in (None, 0, 1, 2, 2, 5)]
    rows += [(1000, None, None, None), (-5, 2, "user", "x" * 100_000 + "."), (-5, 3, "assistant", "y" * 100_000)]
    rows += [(2000 + i, t, "user", "same.") for i in range(60) for t in (0, 0, 1)] + rows[:20]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "g", 1, "n", {"k": 1}, 2) for r in rows], SCHEMA).repartition(4)


def check(found, rows, repair):
    assert found.columns == ["conv_id", *"gaps blank duplicate truncated illegal cost audit repaired_sha256".split()]
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, expected(rows, repair)))


def test_equals_brute_force_on_odd_rows(spark, odd_rows):
    assert any(not turns for turns in damaged(odd_rows).values())
    check(conv.digest(frame(spark, odd_rows)), odd_rows, by_states)


@pytest.mark.parametrize(("turns", "size"), [(0, 1 << 30), (2, 1 << 30), (100, 50)])
def test_streamed_conversations_equal_brute_force(spark, odd_rows, turns, size):
    check(conv.digest(frame(spark, odd_rows), long_turns=turns, long_bytes=size), odd_rows, by_states)


def test_equals_brute_force_on_the_given_table(spark, sf):
    table = spark.read.parquet(f"{sf}/conversations.parquet")
    check(conv.digest(table), [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()], by_states)


def test_a_conversation_with_a_third_of_all_rows(spark):
    rnd = random.Random(1)
    long = [(7, t, rnd.choice(["user", "assistant"]), f"T {rnd.randrange(900)}{rnd.choice(['.', '.', ''])}") for t in range(3000)]
    rows = long + [(i, t, ("user", "assistant")[t % 2], f"T {t}.") for i in range(10, 1510) for t in range(4)]
    check(conv.digest(frame(spark, rows)), rows, by_states)


@pytest.mark.parametrize("limit", [conv.LONG_TURNS, 0])
def test_repaired_turns_alternate_and_repair_to_themselves(spark, odd_rows, limit):
    turns = conv.repaired(frame(spark, odd_rows), long_turns=limit).persist()
    order = F.transform(F.sort_array(F.collect_list(F.struct("place", "role"))), lambda t: F.substring(t["role"], 1, 1))
    found = turns.groupBy("conv_id").agg(F.array_join(order, "").alias("initials"), F.max("place").alias("last"), F.count("*").alias("n"))
    for row in found.collect():
        assert GRAMMAR.fullmatch(row["initials"]) and row["last"] == row["n"] - 1
    hashes = {r["conv_id"]: r["repaired_sha256"] for r in conv.audits(frame(spark, odd_rows)).collect()}
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", F.concat("role", F.lit(":"), "text").alias("t")))), lambda t: t["t"]), "\n")
    for row in turns.groupBy("conv_id").agg(F.sha2(text, 256).alias("sha")).collect():
        assert hashes.pop(row["conv_id"]) == row["sha"]
    assert set(hashes.values()) <= {NO_ROWS}


def test_no_rows(spark):
    assert conv.digest(frame(spark, [(1, 1, "u", "t")]).limit(0)).collect() == []
    assert conv.repaired(frame(spark, [(1, 1, "u", "t")]).limit(0)).collect() == []
