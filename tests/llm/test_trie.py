"""The prefix trie against dictionaries of prefixes."""

import hashlib
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from encore.llm import trie
from encore.llm.streamhash import sha256_of_runs

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def plain_trie(rows, rebuild):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}:{text}".encode()).digest()
            convs.setdefault(c, []).append((turn is not None, turn or 0, role, digest, text))
    convs = {c: [(x[2], x[4]) for x in sorted(v)] for c, v in convs.items()}
    if rebuild:
        made = {}
        for c, own in convs.items():
            h = zlib.crc32(str(c).encode()) % 6
            made[c] = convs.get(c - int(math.fmod(c, 100)), [])[:h] + own[h:]
        convs = made
    members, ends, children = {}, {}, {}
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members.setdefault(tuple(convs[c][:d]), []).append(c)
        ends.setdefault(tuple(convs[c]), []).append(str(c))
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    out = []

    def visit(p):
        here = children.get(p, [])
        below = [visit(x) for x in here]
        leaves = sum(b[0] for b in below) or 1
        saved = sum(b[1] for b in below) + ((len(members[p]) - 1) * len(p[-1][1]) if p else 0)
        out.append((
            members[p][0], len(p), members[p[:-1]][0] if p else None, len(members[p]), len(here), leaves, saved,
            hashlib.sha256(",".join(ends.get(p, [])).encode()).hexdigest(),
        ))
        return leaves, saved

    if convs:
        visit(())
    return sorted(out, key=repr)


def got(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def families(seed):
    rng = random.Random(seed)
    rows, long = [], [("user" if i % 2 == 0 else "assistant", f"text {i}") for i in range(11)]
    for c in range(60):
        kind = rng.random()
        if kind < 0.4:  # a hot family, some its very copies
            turns = long[:rng.choice([3, 5, 11])] + [("user", f"own {rng.randint(0, 3)}")] * rng.choice([0, 1, 2])
        elif kind < 0.7:
            turns = [(rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "", None])) for _ in range(rng.randint(1, 7))]
        else:
            turns = [("user", f"{c} {i}") for i in range(rng.randint(1, 9))]
        start = rng.choice([0, 3])
        rows += [(c * 7, start + i, r, t) for i, (r, t) in enumerate(turns)]
    return rows


ODD = [
    (0, None, None, None), (0, 1, "user", "x"), (0, 1, "user", "y"), (0, 1, "assistant", "x"), (5, 9, "a", "b"),
    (None, 1, "user", "lost"), (-3, 2, "user", "é😀"), (100, 1, "user", "x"), (101, 1, "user", "x"), (101, 1, "user", "x"),
    (107, 3, "user", ""), (107, None, "", "user"), (100, 0, "1:", ""), (200, 0, "1", ":"),
]


@pytest.mark.parametrize("rebuild", [False, True])
@pytest.mark.parametrize("widths", [(2, 3), (8, 16)])
def test_against_dictionaries(spark, widths, rebuild):
    rows = families(3) + ODD
    made = trie.conversation_trie(
        spark.createDataFrame(rows, SCHEMA), rebuild=rebuild, first=widths[0], further=widths[1]
    )
    assert made.columns[:3] == ["conv_id", "depth", "parent_conv_id"]
    assert got(made) == plain_trie(rows, rebuild)


def test_a_chain_longer_than_a_step(spark):
    rows = [(c, i, "user", f"{c if i > 20 else 0} {i}") for c in (1, 2) for i in range(4200)]
    made = {r[:2]: r for r in got(trie.conversation_trie(spark.createDataFrame(rows, SCHEMA)))}
    assert set(made) == {(1, d) for d in range(4201)} | {(2, d) for d in range(22, 4201)}
    for (c, d), (_, _, parent, members, children, leaves, _, ends) in made.items():
        assert parent == (None if d == 0 else 1 if d <= 22 else c)
        assert (members, leaves) == ((2, 2) if d <= 21 else (1, 1))
        assert children == (0 if d == 4200 else 2 if d == 21 else 1)
        assert ends == hashlib.sha256(str(c).encode() if d == 4200 else b"").hexdigest()


@pytest.mark.parametrize("rows", [[], [(4, 1, "user", "x")], [(None, 1, "user", "x")], [(3, 1, None, None), (4, 1, "", "")]])
def test_few_rows(spark, rows):
    for rebuild in (False, True):
        assert got(trie.conversation_trie(spark.createDataFrame(rows, SCHEMA), rebuild=rebuild)) == plain_trie(rows, rebuild)


def test_very_long_text_and_clashing_columns(spark):
    rows = [(1, 0, "user", "x" * 3_000_000), (2, 0, "user", "x" * 3_000_000), (2, 1, "user", "y")]
    wide = spark.createDataFrame(rows, SCHEMA).select(
        "*", *[F.lit("x").alias(c) for c in ("pos", "digest", "size", "above", "path", "t1", "m1", "gid", "depth", "h", "place", "first")]
    )
    assert got(trie.conversation_trie(wide)) == plain_trie(rows, False)


def test_hash_of_runs(spark):
    rows = [(k, i, "é" * (i % 50) + str(i)) for k in (1, 2, None) for i in range(3000 if k == 1 else 7)]
    df = spark.createDataFrame(rows, "k int, i int, s string")
    for pack in (True, False):
        made = {r.k: r.sha for r in sha256_of_runs(df, ["k"], ["i"], "s", ",", "sha", pack).collect()}
        for k in (1, 2, None):
            assert made[k] == hashlib.sha256(",".join(s for a, _, s in rows if a == k).encode()).hexdigest()
