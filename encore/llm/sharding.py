"""Contiguous shards of near equal bytes from global prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.llm.common import before, id_and_text, ranged

SHARDS = 16


def shard_by_bytes(
    docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot.

    Only identifier, size and checksum move: they are range partitioned by identifier, every partition gives its
    total, the totals' prefix sums place each partition, and a running sum inside the partition places each row.
    A row whose bytes start at ``b`` of ``total`` goes to shard ``b * shards div total``, so every shard is a
    contiguous run of identifiers and differs from its target by less than one document. ``slot`` counts the rows
    of a shard from 0. The law is ``bytes``; equal texts have no claim to one shard under it.

    Size is the text's UTF-8 bytes plus 1; a null text has none, so its size is 1 and its checksum 0, like an empty
    one. Null identifiers come first; rows with equal identifiers are ordered by checksum and size, and rows equal
    in all three are interchangeable. An empty table gives no rows. Other columns are not read.
    """
    slim = id_and_text(docs, id_col, text_col).select(
        "doc_id",
        (F.octet_length("text") + 1).cast("bigint").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
    )
    placed = ranged(slim, [F.col("doc_id").asc_nulls_first(), F.col("text_crc32"), F.col("size")])
    totals = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"), F.sum("size").alias("_bytes"))
    # one row per range partition, so the windows over them and the broadcast are bounded by the partition count
    totals = totals.withColumn("_total", F.sum("_bytes").over(Window.partitionBy(F.lit(0))))
    offsets = before(
        totals, "_part", {"_rows": "_rows_before", "_bytes": "_bytes_before"}, also=["_total"]
    )
    inside = Window.partitionBy("_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    located = (
        placed.withColumn("_inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(F.broadcast(offsets), "_part")
        .select(
            "doc_id", "size", "text_crc32",
            F.expr(f"cast((_bytes_before + _inner) * cast({shards} as decimal(10, 0)) div _total as int)").alias("shard"),
            (F.col("_rows_before") + F.col("_row")).alias("_place"),
            "_part",
        )
    )
    # a shard starts in the partition where its first row lies: at most shards + partitions small rows
    starts = located.groupBy("shard").agg(F.min("_place").alias("_first"))
    return located.join(F.broadcast(starts), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("_place") - F.col("_first")).alias("slot")
    )
