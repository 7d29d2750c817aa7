"""Conversation repair against a plain search over all edits."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from encore.llm import blocktables, repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
NEXT = {"0": {"s": "1", "u": "2"}, "1": {"u": "2"}, "2": {"a": "3"}, "3": {"u": "2"}}


def cheapest(rows):
    """(cost, audit, lines) of rows (role, text, fault), forward with the least audit of each state."""
    best = {"0": (0, "", [])}

    def inserted(b):
        for _ in range(3):
            for q, (c, audit, lines) in list(b.items()):
                for role in "ua":
                    to = NEXT[q].get(role)
                    if to:
                        made = (c + 3, audit + "I", lines + [{"u": "user:", "a": "assistant:"}[role]])
                        if to not in b or made[:2] < b[to][:2]:
                            b[to] = made
        return b

    best = inserted(best)
    for role, text, fault in rows:
        new = {}

        def offer(to, made):
            if to not in new or made[:2] < new[to][:2]:
                new[to] = made

        for q, (c, audit, lines) in best.items():
            offer(q, (c + 4, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more = 3 * (fault == "truncated")
            for initial, to in NEXT[q].items():
                if role[:1] == initial:
                    offer(to, (c + more, audit + "K", lines + [f"{role}:{text}"]))
                elif initial != "s":
                    name = {"u": "user", "a": "assistant"}[initial]
                    offer(to, (c + more + 3, audit + "R", lines + [f"{name}:{text}"]))
        best = inserted(new)
    return min(best[q] for q in "03" if q in best)


def key(row):
    turn, role, text = row
    return (turn is not None, turn or 0, role, hashlib.sha256(f"{len(role)}:{role}:{text}".encode()).digest())


def plain_report(rows, damage=True):
    convs = {}
    for c, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        held = convs.setdefault(c, [])
        if k == 1:
            text = ""
        if k == 2:
            text = re.sub("[.!?]", "", text)
        if k == 4:
            role = "user"
        held += [(turn, role, text)] * {0: 0, 3: 2}.get(k, 1)
    out = []
    for c, held in convs.items():
        held.sort(key=key)
        seen, marked, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}
        for turn, role, text in held:
            body = re.sub(r"[\x20\x09-\x0D]+\Z", "", text) if len(text) < 1000 else text
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
            seen.add((role, text))
            counts[fault] += 1
            marked.append((role, text, fault))
        turns = [t for t, _, _ in held if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(held, held[1:]))
        cost, audit, lines = cheapest(marked)
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((c, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, sha))
    return sorted(out, key=repr)


def got(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def some(seed, convs=40, longest=40):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        for turn in range(rng.choice([1, 2, 5, longest])):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None])
            text = rng.choice(["Yes.", "No!", "cut", "", " \n", None, f"{c} {turn}?", f"{turn} and", "end. \t", "é。"])
            rows.append((c * 3, turn if rng.random() < 0.9 else rng.choice([None, turn + 40]), role, text))
    return rows


ODD = [
    (None, 1, "user", "Hi."), (None, None, "assistant", "Ho."), (7, 5, "", "a."), (7, 6, "Üser", "b."), (-4, 2, "s", "."),
    (9, 1, "user", "x."), (9, 1, "user", "x."), (9, 1, "user", "y."), (10, None, None, None), (11, 2, "user", "a\nb.\nc"),
]


def test_tables_against_the_search():
    rng = random.Random(1)
    vectors, low = blocktables.tables()[:2]
    for _ in range(1500):
        rows = [(rng.choice(["s", "u", "a", "x", "u", "a"]), "", rng.choice(["", "", "truncated", "blank"])) for _ in range(rng.randint(0, 11))]
        symbols = np.array([
            blocktables.GONE if f == "blank" else blocktables.SYMBOLS.index((r if r in "sua" else "?", int(f == "truncated")))
            for r, _, f in rows
        ], np.int64)
        at, total = blocktables.through(symbols)
        edits, tail, _ = blocktables.trace(symbols, 0, 0, True)
        audit = "".join("I" * len(i) + e for i, e, _ in edits) + "I" * len(tail)
        assert (int(total[0] + vectors[at[0]][0]) + low, audit) == cheapest(rows)[:2]


@pytest.mark.parametrize("segment", [5, 2048])
def test_against_the_search(spark, monkeypatch, segment):
    monkeypatch.setattr(repair, "SEGMENT", segment)
    rows = some(2) + ODD
    source = repair.readable(spark.createDataFrame(rows, SCHEMA))
    assert got(repair.repair_report(repair.damaged(source), source)) == plain_report(rows)


def test_without_damage(spark):
    rows = some(5, 12) + ODD
    source = repair.readable(spark.createDataFrame(rows, SCHEMA))
    assert got(repair.repair_report(source)) == plain_report(rows, damage=False)
    lines = {}
    for r in repair.repaired_lines(source).orderBy("place", "sub").collect():
        lines.setdefault(r.conv_id, []).append(r.line)
    for c, *_, sha in plain_report(rows, damage=False):
        assert hashlib.sha256("\n".join(lines.get(c, [])).encode()).hexdigest() == sha


def test_one_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(repair, "SEGMENT", 64)
    rng = random.Random(8)
    rows = [(1, t, rng.choice(["user", "assistant"]), f"{t % 900}{rng.choice(['.', ''])}") for t in range(3000)]
    source = repair.readable(spark.createDataFrame(rows, SCHEMA))
    assert got(repair.repair_report(repair.damaged(source), source)) == plain_report(rows)


def test_empty_table_long_text_and_clashing_columns(spark):
    empty = repair.readable(spark.createDataFrame([], SCHEMA))
    assert got(repair.repair_report(repair.damaged(empty), empty)) == []
    assert repair.repaired_lines(empty).collect() == []
    rows = [(1, 0, "user", "x . " * 500_000 + "."), (1, 1, "assistant", "." * 1_000_000 + " " * 1_000_000 + "x"), (2, 0, "user", "é" * 400_000)]
    wide = spark.createDataFrame(rows, SCHEMA).select(
        "*", *[F.lit("x").alias(c) for c in ("c", "void", "place", "digest", "fault", "initial", "seg", "line", "_copy", "start")]
    )
    source = repair.readable(wide.withColumnRenamed("role", "named"), role_col="named")
    assert got(repair.repair_report(source)) == plain_report(rows, damage=False)


def test_every_row_dropped(spark):
    gone = next(t for t in itertools.count() if zlib.crc32(f"3:{t}".encode()) % 20 == 0)
    source = repair.readable(spark.createDataFrame([(3, gone, "user", "Hi.")], SCHEMA))
    assert got(repair.repair_report(repair.damaged(source), source)) == [(3, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
