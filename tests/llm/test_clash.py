"""Other columns of the input, whatever their names, change nothing; neither do other names of the columns read."""

import plain
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from encore.llm import exact, jaccard, lm, mixing, pii, quality, registry, repeats, secrets, sharding, tokens

CLASHES = (
    "hash", "node", "n", "key", "size", "shard", "slot", "kept", "keep_id", "body", "head", "salt", "row", "rows", "first",
    "map", "pos", "start", "end", "other", "later", "island", "block", "cell", "copies", "target", "taken", "weight", "words",
    "spans", "found", "base", "owner", "repository", "held_out", "score", "ids", "decoded", "value", "component_id", "nth",
)
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
OPERATORS = {
    "repeats": lambda d, **c: repeats.repeated_spans(d, **c),
    "quality": lambda d, **c: quality.clean(d, **c),
    "sharding": lambda d, **c: sharding.shard_by_bytes(d, **c),
    "pii": lambda d, **c: pii.digests(pii.find_pii(d, **c)),
    "exact": lambda d, **c: exact.dedupe_exact(d, **c),
    "mixing": lambda d, **c: mixing.mix(d, **c),
    "secrets": lambda d, **c: secrets.digests(secrets.find_secrets(d, **({**c, "repository_col": "named"} if c else {}))),
    "jaccard": lambda d, **c: jaccard.jaccard_components(d, **c),
    "tokens": lambda d, **c: tokens.encode(d, RANKS, public_tokenizers.PATTERN, **c),
    "lm": lambda d, **c: lm.score_corpus(d, registry._held_out, **c),
}


def small(spark):
    rows = [(r[0], r[1] if r[1] is None else " ".join(r[1].split(" ")[:400]), r[2]) for r in plain.awkward()]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string").where("doc_id is not null").dropDuplicates(["doc_id"])


def bag(df):
    return sorted(repr(r) for r in df.collect())


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_other_columns(spark, name):
    docs = small(spark)
    wide = docs.select(*docs.columns, *[F.lit("x").alias(c) for c in CLASHES], F.lit(None).cast("int").alias("void"))
    want = bag(OPERATORS[name](docs))
    assert bag(OPERATORS[name](wide)) == want
    renamed = wide.drop("base", "value").select(
        F.col("doc_id").alias("named"), F.col("text").alias("contents"), *[c for c in wide.columns if c not in ("doc_id", "text", "base", "value")]
    )
    assert bag(OPERATORS[name](renamed, id_col="named", text_col="contents")) == want


@pytest.mark.parametrize("number", range(4))
def test_stages_keep_other_columns(spark, number):
    docs = small(spark).select("doc_id", "text", F.lit("en").alias("lang"), "source", F.length("text").alias("n_chars"))
    wide = docs.select("*", *[F.lit("x").alias(c) for c in CLASHES])
    stage = corpus_pipeline.STAGES[number][1]
    got = stage(spark, wide, "")
    assert got.columns == wide.columns
    assert bag(got.select(docs.columns)) == bag(stage(spark, docs, ""))
