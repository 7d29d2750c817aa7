"""The language model against one held in dictionaries, and the sequences under it."""

import math
import os
import random
from collections import Counter

import numpy as np
import plain
import pytest

from encore.llm import eliasfano, lm, registry


@pytest.mark.parametrize("n, universe", [(0, 10), (1, 1 << 64), (5, 6), (1000, 1 << 40), (3000, 700), (2000, 2001)])
def test_sequences(n, universe):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, min(universe, 1 << 62), n, dtype=np.uint64))
    if n > 100 and universe > 1 << 30:
        values[:60] = np.arange(60) + 5  # a dense stretch
        values.sort()
    arrays = eliasfano.encode(values, universe)
    seq = eliasfano.EliasFano(arrays)
    assert (seq.access(np.arange(n)) == values).all()
    keys = np.unique(np.r_[values, values + np.uint64(1), rng.integers(0, min(universe, 1 << 62), 500, dtype=np.uint64), np.uint64(0)])
    keys = keys[keys < np.uint64(min(universe, (1 << 64) - 1))]
    assert (seq.successor(keys) == np.searchsorted(values, keys)).all()
    assert ((seq.find(keys) >= 0) == np.isin(keys, values)).all()


def test_file(tmp_path):
    arrays = {"a": np.arange(10, dtype=np.int64), "b": np.zeros(0, np.uint8), "c": np.array([1.5, 2.5])}
    (tmp_path / "x").write_bytes(eliasfano.to_bytes(arrays))
    back = eliasfano.from_file(str(tmp_path / "x"))
    assert all((back[k] == v).all() and back[k].dtype == v.dtype for k, v in arrays.items())


class Plain:
    """The same model with dictionaries and without quantisation."""

    def __init__(self, texts, order, min_count, discount):
        runs = [["\n", *plain.words(plain.lower(t)), "\n"] for t in texts]
        self.one = Counter(w for r in runs for w in r[1:])
        self.n, self.v, self.order, self.d = sum(self.one.values()), len(self.one), order, discount
        self.grams, self.whole, self.kept = {}, {}, {1: {(w,) for w in self.one}}
        for k in range(2, order + 1):
            grams = Counter(tuple(r[i:i + k]) for r in runs for i in range(len(r) - k + 1) if tuple(r[i:i + k - 1]) in self.kept[k - 1])
            self.whole[k] = Counter()
            for g, c in grams.items():
                self.whole[k][g[:-1]] += c
            self.grams[k] = {g: c for g, c in grams.items() if c >= min_count}
            self.kept[k] = set(self.grams[k])
        self.left = {
            k: {u: 1 - sum((c - discount) / w for g, c in self.grams[k].items() if g[:-1] == u) for u, w in self.whole[k].items()}
            for k in self.whole
        }

    def p(self, context, word):
        if not context:
            return (self.one[word] + 1) / (self.n + self.v + 1)
        k = len(context) + 1
        if context not in self.kept[k - 1]:
            return self.p(context[1:], word)
        left = self.left[k].get(context, 1.0)
        own = max(self.grams[k].get((*context, word), 0) - self.d, 0) / self.whole[k][context] if self.whole[k][context] else 0
        return own + left * self.p(context[1:], word)

    def score(self, text):
        r = ["\n", *plain.words(plain.lower(text)), "\n"]
        return sum(math.log10(self.p(tuple(r[max(0, i - self.order + 1):i]), r[i])) for i in range(1, len(r)))


def held(doc_id):
    return plain.crc("" if doc_id is None else str(doc_id)) % 7 == 2


def corpus():
    rng = random.Random(4)
    rows = [(r[0], r[1]) for r in plain.awkward()]
    rows = [(d, " ".join(t.split()[:300]) if t and len(t) > 9000 else t) for d, t in rows]
    return rows + [(100 + i, " ".join(f"t{min(rng.randrange(30), rng.randrange(30))}" for _ in range(rng.randint(0, 60)))) for i in range(120)]


@pytest.mark.parametrize("order, shards", [(1, 3), (2, 1), (3, 4), (4, 5)])
def test_against_dictionaries(spark, order, shards):
    rows = corpus()
    known = [t for d, t in rows if not held(d)]
    want = Plain(known, order, 2, 0.75)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    parts = spark.createDataFrame([(t,) for t in known], "text string").repartition(3)
    model = lm.train(parts, order, shards=shards)
    assert model.tokens == want.n and model.words == want.v
    assert [sum(c) for c in model.counts] == [len(want.kept[k]) for k in range(1, order + 1)]
    got = Counter((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in lm.score(docs, model).collect())
    tokens = [(d, ["\n", *plain.words(plain.lower(t))]) for d, t in rows]
    assert got == Counter(
        (d, len(ws), sum(want.one[w] > 0 for w in ws),
         round(sum(math.log10((want.one[w] + 1) / (want.n + want.v + 1)) for w in ws), 6)) for d, ws in tokens
    )
    scores = {(r.doc_id, r.n_tokens): r.score for r in lm.score(docs, model).collect()}
    for (d, t), (_, ws) in zip(rows, tokens):
        assert scores[d, len(ws)] == pytest.approx(want.score(t), rel=0.01, abs=0.03)
    lm.forget(spark, model)
    assert not os.path.exists(lm._local(model.root))


def test_sums_to_one():
    want = Plain([t for _, t in corpus()], 3, 2, 0.75)
    words = [*want.one, None]
    for context in [(), ("t3",), ("t1", "t2"), ("\n",), ("nothing",), ("t29", "t0")]:
        assert sum(want.p(context, w) for w in words) == pytest.approx(1)


def test_better_than_words_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [r for r in lm.score_corpus(docs, registry._held_out).collect() if r.held_out]
    assert 80 < len(rows) < 220
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
    assert {r.held_out == held(r.doc_id) for r in rows} == {True}


def test_scores_know_what_was_seen_once(spark):
    rows = corpus()
    want = Plain([t for d, t in rows if not held(d)], 3, 1, 0.75)
    assert sum(c == 1 for c in want.grams[3].values()) > 100
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    scores = {(r.doc_id, r.n_tokens): r.score for r in lm.score_corpus(docs, registry._held_out).collect()}
    for d, t in rows:
        tokens = len(plain.words(t)) + 1
        assert scores[d, tokens] == pytest.approx(want.score(t), rel=0.01, abs=0.03)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert lm.score_corpus(docs, registry._held_out).count() == 0
    alone = spark.createDataFrame([(1, "a b"), (None, None)], "doc_id bigint, text string")
    model = lm.train(docs)
    got = {r.doc_id: (r.n_tokens, r.n_known, r.base_score, r.score) for r in lm.score(alone, model).collect()}
    assert got == {1: (3, 0, 0.0, 0.0), None: (1, 0, 0.0, 0.0)}


def test_quantised():
    logs = np.random.default_rng(1).normal(-4, 2, 10_000)
    code, book = lm.quantised(logs)
    assert len(set(code)) > 200 and np.abs(book[code] - logs).max() <= (logs.max() - logs.min()) / 256
    assert (lambda c, b: b[c])(*lm.quantised(logs[:200])).tolist() == logs[:200].tolist()
