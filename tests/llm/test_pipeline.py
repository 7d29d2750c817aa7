"""Every stage of the pipeline, on its own input, against a plain version."""

from collections import Counter, defaultdict

import plain
import public_tokenizers
import pytest

import corpus_pipeline
from encore.llm import quality, tokens

SMALL = "/root/testdata/sf0.001"


def table(spark):
    given = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = spark.createDataFrame(
        [(None if r[0] is None else r[0] + 1_000_000, r[1], "xx", r[2], len(r[1] or "")) for r in plain.awkward()],
        "doc_id bigint, text string, lang string, source string, n_chars bigint",
    )
    return given.unionByName(odd).repartition(4)


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def quality_rules(docs):
    for d, t, lang, source, n in docs:
        verdict = quality.judge(t)
        if verdict[6]:
            yield d, verdict[-1], lang, source, len(verdict[-1])


def exact_dedup(docs):
    best = {}
    for r in docs:
        key = r[1] or ""
        if key not in best or (r[0] is not None and (best[key][0] is None or r[0] > best[key][0])):
            best[key] = r
    return best.values()


def ngram_jaccard(docs):
    named = plain.jaccard_groups([(r[0], r[1]) for r in docs])
    return [r for r, (d, _, c) in zip(docs, named) if d == c]


@pytest.mark.parametrize("number, twin", [(0, quality_rules), (1, exact_dedup), (2, ngram_jaccard)])
def test_filters(spark, number, twin):
    docs = table(spark)
    if number == 2:
        docs = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    docs = docs.cache()
    got = corpus_pipeline.STAGES[number][1](spark, docs, SMALL)
    assert got.columns == docs.columns
    if number == 1:  # of repeated rows any may stay
        assert Counter((r.doc_id, r.text or "") for r in got.collect()) == Counter(
            (r[0], r[1] or "") for r in twin([tuple(r) for r in docs.collect()]))
    else:
        assert rows(got) == Counter(twin([tuple(r) for r in docs.collect()]))
    assert corpus_pipeline.STAGES[number][1](spark, docs.limit(0), SMALL).count() == 0


def test_one_row_of_each_component(spark):
    def text(start, last=""):
        return " ".join(f"{start}{i}" for i in range(60)) + last

    near = [
        (None, text("a")), (1, text("a", " end")),  # a null one near a named one
        (None, text("b")),  # a null one near none
        (5, text("c")), (5, text("d")), (3, text("d", " end")),  # 5 twice, once near 3
        (6, text("e")), (6, text("f")), (7, text("f", " end")), (2, text("e", " end")),  # 6 names a component and goes in another
        (None, text("g")), (None, text("g", " end")),  # near copies without any name
        (8, text("h")), (8, text("h")), (None, None), (9, ""),
    ]
    docs = spark.createDataFrame(near, "doc_id bigint, text string").repartition(3)
    got = Counter((r.doc_id, (r.text or "").split(" ")[0]) for r in corpus_pipeline.ngram_jaccard(spark, docs, SMALL).collect())
    assert got == Counter([
        (1, "a0"), (None, "b0"), (5, "c0"), (3, "d0"), (2, "e0"), (6, "f0"), (None, "g0"), (8, "h0"), (None, ""), (9, ""),
    ])


def test_null_and_repeated_identifiers_stay_in(spark):
    docs = table(spark).cache()
    given = [tuple(r) for r in docs.collect()]
    got = [tuple(r) for r in corpus_pipeline.ngram_jaccard(spark, docs, SMALL).collect()]
    assert not Counter(got) - Counter(given)
    # rows by number, those of null identifier last, so that the smallest number of a component is the row that stays
    order = sorted(given, key=lambda r: (r[0] is None, r[0] or 0))
    named = plain.jaccard_groups([(i, r[1]) for i, r in enumerate(order)])
    assert Counter(r[0] for r in got) == Counter(order[i][0] for i, _, c in named if i == c)


def test_mix(spark):
    docs = table(spark).cache()
    got = corpus_pipeline.source_mix(spark, docs, SMALL)
    given, taken = rows(docs), rows(got)
    assert got.columns == docs.columns and all(taken[r] <= 3 * given[r] for r in taken)
    size, words = Counter(), Counter()
    largest = defaultdict(int)
    for r, n in given.items():
        size[r[3]] += n * len(plain.words(r[1]))
        largest[r[3]] = max(largest[r[3]], len(plain.words(r[1])))
    for r, n in taken.items():
        words[r[3]] += n * len(plain.words(r[1]))
    from test_rows import water

    goal = water(size, (5, 2, 1))
    assert all(abs(words[s] - goal[s]) <= largest[s] for s in size)
    assert corpus_pipeline.source_mix(spark, docs.limit(0), SMALL).count() == 0


def test_run(spark):
    out = corpus_pipeline.run(spark, SMALL).collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    left = {r[0]: r[1] for r in ngram_jaccard(list(exact_dedup(list(quality_rules(docs)))))}
    tool = tokens.encoder(public_tokenizers.path(corpus_pipeline.RANKS), public_tokenizers.PATTERN)
    assert out and {r.doc_id for r in out} <= left.keys()
    for r in out:
        assert list(r.ids) == tool.encode_ordinary(left[r.doc_id]) and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == plain.sha(left[r.doc_id])
