"""Repeated passages against a look-up of every window of 50 words."""

import random
from collections import defaultdict

import numpy as np
import plain

from encore.llm import repeats


def shared_places(rows, size=50):
    """doc_id -> word positions inside some window of ``size`` words that another document has as well."""
    where = defaultdict(set)
    split = [(d, plain.words(plain.lower(t))) for d, t in rows if d is not None]
    for d, found in split:
        for i in range(len(found) - size + 1):
            where[tuple(found[i:i + size])].add(d)
    places = defaultdict(set)
    for d, found in split:
        for i in range(len(found) - size + 1):
            if len(where[tuple(found[i:i + size])]) > 1:
                places[d].update(range(i, i + size))
    return dict(places)


def covered(spans):
    places = defaultdict(set)
    for r in spans:
        assert r.n_words == r.end_word - r.start_word >= 50 and r.other_doc_id != r.doc_id
        places[r.doc_id].update(range(r.start_word, r.end_word))
    return dict(places)


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    spans = repeats.repeated_spans(docs).collect()
    want, got = shared_places(rows), covered(spans)
    assert got.keys() == want.keys()
    for d in want:
        assert got[d] <= want[d]
    missed = sum(len(want[d] - got[d]) for d in want)
    assert missed <= 0.005 * sum(map(len, want.values()))
    return docs, spans


def test_awkward_rows(spark):
    check(spark, [(r[0], r[1]) for r in plain.awkward()])
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert repeats.repeated_spans(docs).count() == 0


def test_given_rows(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    check(spark, rows)


def test_passages(spark):
    rng = random.Random(5)

    def some(n):
        return [f"v{rng.randrange(400)}" for _ in range(n)]

    common, rows = some(51), []
    for i in range(300):
        body = some(rng.randint(0, 200))
        if i % 3 == 0:
            at = rng.randint(0, len(body))
            body[at:at] = common
        if i % 10 == 1:
            body += rows[-1][1].split()[:70]
        rows.append((i, " ".join(body)))
    docs, spans = check(spark, rows)
    assert {r.doc_id for r in spans} >= set(range(0, 300, 3))
    left = {r.doc_id: r.text for r in repeats.without_repeats(docs, spark.createDataFrame(spans)).collect()}
    whole = " ".join(common)
    assert any(whole in t for t in left.values())
    assert len(left) == 300 and sum(whole in t for t in left.values()) < 100
    named = {r.doc_id for r in spans if r.later}
    assert all(left[d] == t for d, t in rows if d not in named)


def test_common_line_after_the_passage(spark):
    rng = random.Random(9)

    def some(n):
        return [f"v{rng.randrange(4000)}" for _ in range(n)]

    line, rows = some(25), []
    for i in range(0, 200, 2):
        own = some(32)
        rows += [(i + k, " ".join(some(40) + own + line + some(60))) for k in (0, 1)]
    check(spark, rows)


def test_anchors():
    rng = np.random.default_rng(0)
    grams = rng.integers(0, 50, 500).astype(np.uint64)
    for window in (1, 2, 7, 41):
        want = set()
        for i in range(len(grams) - window + 1):
            part = grams[i:i + window]
            want.update(int(i + j) for j in np.flatnonzero(part == part.min()))
        assert set(repeats.anchors(grams, window).tolist()) == want


def exactly(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    spans = repeats.repeated_spans(docs).collect()
    assert covered(spans) == shared_places(rows)
    return docs, spans


def test_only_the_first_of_all_is_not_later(spark):
    rng, number = random.Random(3), iter(range(1_000_000))

    def some(n):  # no word twice
        return [f"u{next(number)}" for _ in range(n)]

    passages = [some(50 + 2 * i) for i in range(6)]
    rows = [(i, " ".join(w for p in passages for w in some(rng.randint(5, 40)) + p)) for i in range(150)]
    docs, spans = exactly(spark, rows)
    assert {r.doc_id for r in spans if not r.later} == {0} and {r.doc_id for r in spans if r.later} == set(range(1, 150))
    assert {r.other_doc_id for r in spans if r.later} == {0}
    left = {r.doc_id: r.text for r in repeats.without_repeats(docs, spark.createDataFrame(spans)).collect()}
    assert [sum(" ".join(p) in t for t in left.values()) for p in passages] == [1] * 6


def test_passage_around_a_frequent_core(spark):
    for seed in range(4):
        rng, number = random.Random(seed), iter(range(1_000_000 * seed, 1_000_000 * (seed + 1)))

        def some(n):
            return [f"u{next(number)}" for _ in range(n)]

        before, core, after = some(10), some(30), some(10)
        middles = [before + core + after] * 2 + [core + after] * 60 + [before + core] * 60
        rng.shuffle(middles)
        rows = [(i, " ".join(some(45) + middle + some(45))) for i, middle in enumerate(middles)]
        _, spans = exactly(spark, rows)
        assert [r.n_words for r in spans] == [50, 50]


def test_passage_many_times_in_one_document(spark):
    number = iter(range(1_000_000))

    def some(n):
        return [f"u{next(number)}" for _ in range(n)]

    passage = some(51)
    often = [w for _ in range(600) for w in passage + some(3)]
    exactly(spark, [(5, " ".join(often)), (9, " ".join(some(30) + passage + some(30)))])


def test_common_words_and_least():
    assert repeats.common_words(b"a bc d ", b"a bc e ") == 2
    assert repeats.common_words(b"a bc ", b"a bcd ") == 1
    assert repeats.common_words(b"", b"a ") == 0 and repeats.common_words(b"a b ", b"a b c ") == 2
    rng = np.random.default_rng(1)
    grams = rng.integers(0, 9, 300).astype(np.uint64)
    for window in (1, 3, 41):
        want = [i + int(grams[i:i + window].argmin()) for i in range(len(grams) - window + 1)]
        assert repeats.least_at(grams, window).tolist() == want


def test_spans_end_where_the_match_ends(spark):
    rng, number = random.Random(8), iter(range(1_000_000))

    def some(n):
        return [f"u{next(number)}" for _ in range(n)]

    rows, want = [], set()
    for i in range(0, 80, 2):
        passage = some(rng.randint(50, 400))
        for k in (0, 1):
            ahead = some(rng.randint(0, 90))
            rows.append((i + k, " ".join(ahead + passage + some(rng.randint(0, 90)))))
            want.add((i + k, len(ahead), len(ahead) + len(passage), bool(k)))
    _, spans = exactly(spark, rows)
    assert {(r.doc_id, r.start_word, r.end_word, r.later) for r in spans} == want
    assert sum(r.compared for r in spans) >= 0.8 * len(spans)  # the others lie at borders only


def test_comparison_stands_without_the_groups(spark):
    """Neighbours' words alone, in one sorted partition: matches found, and no window beyond a match kept."""
    def row(doc, behind, ahead, pos=100):
        def side(words):
            return "".join(w + " " for w in words).encode()
        return side(ahead), side(reversed(behind)), doc, pos

    core = [f"c{i}" for i in range(30)]
    left, right = [f"l{i}" for i in range(20)], [f"r{i}" for i in range(20)]
    rows = sorted([
        row(1, left, core + right), row(2, left, core + right), row(3, ["x"] * 20, core + ["y"] * 20),
        row(4, [], ["zz"] * 50), row(0, [], ["aa"] * 50),
    ])
    ordered = spark.createDataFrame(rows, "ahead binary, behind binary, doc_id bigint, pos int").coalesce(1)
    got = repeats._shared_windows(ordered.sortWithinPartitions("ahead"), 50).collect()
    inner = [r for r in got if 0 < r.doc_id < 4]
    assert {(r.doc_id, r.pos) for r in inner if r.compared} == {(d, 100 - o) for d in (1, 2) for o in range(21)}
    assert {(r.doc_id, r.pos) for r in inner if not r.compared} == {(3, 80)}  # thirty words ahead are shared
    hashes = {d: {r.pos: r.hash for r in inner if r.doc_id == d} for d in (1, 2, 3)}
    assert hashes[1] == hashes[2] and hashes[3][80] != hashes[1][80]
