"""The Jaccard join against a comparison of all pairs."""

import random
from collections import Counter

import numpy as np
import plain
import pytest

from encore.llm import graph, hashing, jaccard
from encore.llm.common import Scratch


def run(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = jaccard.jaccard_components(docs).collect()
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in got)


def family(rng, base, count, edits):
    out = []
    for _ in range(count):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_awkward_rows(spark):
    rows = [(r[0], r[1]) for r in plain.awkward()]
    assert run(spark, rows) == Counter(plain.jaccard_groups(rows))
    assert run(spark, rows[:0]) == Counter()
    assert run(spark, [(1, None), (2, ""), (3, "a b"), (4, "A  b")]) == Counter([(1, 0, 1), (2, 0, 2), (3, 1, 3), (4, 1, 3)])


def test_given_rows(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    want = plain.jaccard_groups(rows)
    assert len({c for *_, c in want}) < len(rows)
    assert run(spark, rows) == Counter(want)


@pytest.mark.parametrize("block", [256, 8])
def test_families_at_the_threshold(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rng = random.Random(block)
    texts = []
    shared = [f"line{i}" for i in range(60)]
    for f in range(12):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.randint(8, 120))] + (shared if f % 2 else [])
        texts += family(rng, base, 30, max(2, len(base) // 25))
        texts.append(" ".join(base[: int(len(base) * 0.8)]))
    texts += [" ".join(shared + [f"z{rng.randrange(10**6)}" for _ in range(rng.randint(10, 30))]) for _ in range(60)]
    rng.shuffle(texts)
    rows = [(i * 7 % 100_003, t) for i, t in enumerate(texts)]
    want = plain.jaccard_groups(rows)
    assert 12 < len({c for *_, c in want}) < len(rows)
    assert run(spark, rows) == Counter(want)


def test_bounds_lose_nothing():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    sets = [np.unique(rng.choice(pool[o:o + 300], rng.integers(1, 280))) for o in range(0, 3000, 100) for _ in range(3)]
    sets += [np.unique(np.r_[s[1:], pool[i:i + 1]]) for i, s in enumerate(sets)]
    sizes = np.array([len(s) for s in sets])
    at = np.arange(len(sets))
    got = {tuple(p) for p in jaccard.bounded_pairs(at, sizes, at, [jaccard.signature(s) for s in sets], at, None)}
    for i in at:
        for j in at[i + 1:]:
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 75 * (sizes[i] + sizes[j] - both):
                assert (i, j) in got
    assert len(got) < len(at) ** 2 / 8


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)]
    links += [(rng.randrange(5000, 5400), rng.randrange(5000, 5400)) for _ in range(200)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    name = {n: n for pair in links for n in pair}
    for _ in range(300):
        for a, b in links:
            name[a] = name[b] = min(name[a], name[b])
    assert got == name


def test_components_of_long_chains(spark, monkeypatch):
    """Few rounds, and no estimate that grows from round to round."""
    rounds, stored = [], Scratch.stored
    monkeypatch.setattr(Scratch, "stored", lambda self, df: rounds.append(df.columns) or stored(self, df))
    rng = random.Random(5)
    names = list({rng.getrandbits(63) - (1 << 62) for _ in range(600)})
    chains = [names[:400], names[400:599], names[599:] * 2]  # the last is a link with itself
    links = [pair for chain in chains for pair in zip(chain, chain[1:])]
    found = graph.components(spark.createDataFrame(links, "a bigint, b bigint"))
    assert {r.node: r.component for r in found.collect()} == {n: min(chain) for chain in chains for n in chain}
    assert found.count() == 600
    assert rounds.count(["a", "name", "old"]) <= 14
    assert len(str(found._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 12


def test_merged_components(spark):
    """Names of known components and further links are one graph, also when later links join what was apart."""
    rng = random.Random(8)
    first, more = ([(rng.randrange(300), rng.randrange(300)) for _ in range(n)] for n in (90, 60))
    frame = lambda links: spark.createDataFrame(links, "a bigint, b bigint")
    got = jaccard._merged(graph.components(frame(first)), frame(more), Scratch(spark))
    want = graph.components(frame(first + more))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert len(str(got._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 12


def test_bit_table(spark):
    values = [0, 1, -1, 2**40 + 5, -(2**50), 32767, 32768, (1 << 24) - 1, hashing.TABLE_BITS - 1]
    table = hashing.bit_table(spark.createDataFrame([(v,) for v in values], "v bigint"), "v")
    bits = np.frombuffer(table, np.uint8)
    assert hashing.in_table(bits, np.array(values, np.int64).astype(np.uint64)).all()
    assert np.unpackbits(bits).sum() == len({v % hashing.TABLE_BITS for v in values})


def test_word_hashes(monkeypatch):
    texts = ["", " ", "a", "A b\tB\x0bb\n é É ñandú 😀 \x1c x y", "w" * 300 + " " + "v" * 40, "ab ba aab aba baa " * 50]
    for block in (1 << 20, 16):
        monkeypatch.setattr(hashing, "_BLOCK", block)
        hashing._powers.clear()
        seen = {}
        for text in texts:
            words = plain.words(plain.lower(text))
            hashes = hashing.word_hashes(text)
            assert len(hashes) == len(words)
            for w, h in zip(words, hashes.tolist()):
                assert seen.setdefault(w, h) == h
        assert len(set(seen.values())) == len(seen)
    hashing._powers.clear()


def test_overlap_of_sorted_arrays():
    import numpy as np

    from encore.llm.jaccard import overlap

    rng = np.random.default_rng(6)
    top = np.iinfo(np.uint64).max
    for n, m in ((0, 0), (0, 5), (1, 1), (40, 3), (200, 300)):
        a, b = (np.unique(rng.integers(0, 400, k).astype(np.uint64)) for k in (n, m))
        a, b = (np.unique(np.append(x, top)) if k > 40 else x for x, k in ((a, n), (b, m)))
        assert overlap(a, b) == overlap(b, a) == len(set(a.tolist()) & set(b.tolist()))
