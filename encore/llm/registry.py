"""The registered queries of this package and their check SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm import exact, jaccard, lm, mixing, packing, pii, quality, repair, repeats, secrets, sharding, tokens, trie
from encore.llm.common import conversations, documents
from encore.llm.oracles import ORACLE  # noqa: F401


def op1_sparse_suffix_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.repeated_spans(documents(spark, folder)).drop("compared")  # depends on the partitions' borders


def op2_line_first_cleaning(spark: SparkSession, folder: str) -> DataFrame:
    return quality.clean(documents(spark, folder)).drop("clean_text")


def op3_byte_balanced_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_by_bytes(documents(spark, folder)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_bootstrapped_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digests(pii.find_pii(documents(spark, folder)))


def op5_content_sort_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.dedupe_exact(documents(spark, folder), keep="largest")


def op6_hypergeometric_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(documents(spark, folder)).select(
        "doc_id", "size", "source_size", "target", "taken", F.array_join("shards", ",").alias("shards")
    )


def op7_secret_ownership(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digests(secrets.find_secrets(documents(spark, folder)))


def op8_jaccard_tiles(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_components(documents(spark, folder)).drop("node")


def op9_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    encoded = tokens.encode(
        documents(spark, folder), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )
    return tokens.digests(encoded)


def _held_out(doc_id):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def op10_elias_fano_lm(spark: SparkSession, folder: str) -> DataFrame:
    return lm.score_corpus(documents(spark, folder), _held_out)


def op11_rollup_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.conversation_trie(conversations(spark, folder), rebuild=True)


def op12_linear_grouping_pack(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(documents(spark, folder), public_tokenizers.path("word_bpe_49k.json"))


def op13_block_table_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = repair.readable(conversations(spark, folder))
    return repair.repair_report(repair.damaged(rows), rows)


QUERIES = {
    f.__name__: f for f in (
        op1_sparse_suffix_repeats, op2_line_first_cleaning, op3_byte_balanced_shards, op4_bootstrapped_pii,
        op5_content_sort_dedup, op6_hypergeometric_mix, op7_secret_ownership, op8_jaccard_tiles, op9_byte_bpe,
        op10_elias_fano_lm, op11_rollup_trie, op12_linear_grouping_pack,
        op13_block_table_repair,
    )
}
