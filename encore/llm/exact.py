"""Exact deduplication by sorting the contents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from encore.session import cut_lineage, shuffle_partitions

PREFIX_BYTES = 32
PIECES_PER_PARTITION = 4
_PLACE = ["head", "hash", "salt"]


def _ordered(
    docs: DataFrame, id_col: str, text_col: str, normalise, partitions: int | None, carried: list
) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, body, head, hash, salt, carried) ranged by content; the hot hashes with their pieces."""
    spark = docs.sparkSession
    count = partitions or shuffle_partitions(spark)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    if normalise is not None:
        text = F.coalesce(normalise(text), F.lit(""))
    keyed = docs.select(
        F.col(id_col).alias("doc_id"), text.cast("binary").alias("body"), F.xxhash64(text).alias("hash"), *carried
    ).withColumn("head", F.substring("body", 1, PREFIX_BYTES))
    hashes = keyed.groupBy("hash").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    share = max(2, docs.count() // (PIECES_PER_PARTITION * count))
    # at most PIECES_PER_PARTITION * count hashes can have more rows than that
    hot = cut_lineage(hashes.where(F.col("rows") > share).select(
        "hash", F.ceil(F.col("rows") / F.lit(share)).cast("int").alias("pieces")
    ))
    salted = keyed.join(F.broadcast(hot), "hash", "left").withColumn(
        "salt", F.when(F.col("pieces").isNull(), F.lit(-1)).otherwise(F.expr("pmod(xxhash64(doc_id, 17), pieces)"))
    ).drop("pieces")
    return salted.repartitionByRange(count, *_PLACE), hot


def _first(keep: str) -> Column:
    if keep not in ("largest", "smallest"):
        raise ValueError("keep is 'largest' or 'smallest'")
    return F.col("doc_id").desc_nulls_last() if keep == "largest" else F.col("doc_id").asc_nulls_last()


def dedupe_exact(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise=None,
    keep: str = "largest",
    partitions: int | None = None,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if their bytes are, after ``normalise`` (a function on the text column; none by default). The
    rows are range partitioned by their content: the first bytes, then a 64-bit hash of the whole, then a salt; the
    splitters are sampled by Spark and stay small, whatever the texts' lengths. The external sort puts equal texts
    side by side and the window compares neighbours by their full text. ``keep`` names the row that stays, the one
    with the ``largest`` or ``smallest`` identifier.

    A text with more rows than a fraction of a partition (counted over all rows, by hash) is salted by identifier, so
    that no task gets a whole hot group; the sorted pieces of such texts, at most a few per partition in all, are put
    together by digest at the end. Only slim rows are written to the checkpoint folder between the two steps.

    A null text counts as empty. A null identifier loses against any other; of rows equal in text and identifier,
    exactly one can stay. An empty table gives no rows. Other columns are not read.
    """
    first = _first(keep)
    ordered, _ = _ordered(docs, id_col, text_col, normalise, partitions, [])
    same = Window.partitionBy(*_PLACE, "body")
    slim = ordered.select(
        "doc_id", "salt",
        F.row_number().over(same.orderBy(first)).alias("nth"),
        F.first("doc_id").over(same.orderBy(first)).alias("piece_keep"),
        F.count(F.lit(1)).over(same).alias("piece_rows"),
        F.sha2("body", 256).alias("text_sha256"),
    )
    slim = cut_lineage(slim)
    heads = slim.where("nth = 1 and salt >= 0")
    best = F.max("piece_keep") if keep == "largest" else F.min("piece_keep")
    merged = heads.groupBy("text_sha256").agg(best.alias("all_keep"), F.sum("piece_rows").alias("all_rows"))
    cold = slim.where("salt < 0").select(
        "doc_id", F.col("piece_keep").alias("keep_id"), F.col("piece_rows").alias("group_size"),
        (F.col("nth") == 1).alias("kept"), "text_sha256",
    )
    # one row per hot text, bounded like the hot hashes
    warm = slim.where("salt >= 0").join(F.broadcast(merged), "text_sha256").select(
        "doc_id", F.col("all_keep").alias("keep_id"), F.col("all_rows").alias("group_size"),
        ((F.col("nth") == 1) & F.col("doc_id").eqNullSafe(F.col("all_keep"))).alias("kept"), "text_sha256",
    )
    return cold.unionByName(warm)


def distinct_texts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest", partitions: int | None = None
) -> DataFrame:
    """The rows of ``docs`` that :func:`dedupe_exact` keeps, with all their columns.

    The rows travel with their texts through the same sort. Which piece of a hot text holds its row is found out
    before, from one row per hot text.
    """
    first = _first(keep)
    others = [c for c in docs.columns if c != text_col]
    carried = [F.struct(*[F.col(c) for c in others], F.col(text_col).isNull().alias("_void")).alias("row")]
    ordered, hot = _ordered(docs, id_col, text_col, None, partitions, carried)
    best = F.max("doc_id") if keep == "largest" else F.min("doc_id")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    holders = cut_lineage(
        docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("hash"))
        .join(F.broadcast(hot.select("hash")), "hash")
        .groupBy(F.sha2("text", 256).alias("digest")).agg(best.alias("holder"))
    )
    same = Window.partitionBy(*_PLACE, "body").orderBy(first)
    heads = ordered.withColumn("nth", F.row_number().over(same)).where("nth = 1").withColumn(
        "digest", F.when(F.col("salt") >= 0, F.sha2("body", 256))
    )
    # one row per hot text, bounded like the hot hashes
    kept = heads.join(F.broadcast(holders), "digest", "left").where(
        (F.col("salt") < 0) | F.col("doc_id").eqNullSafe(F.col("holder"))
    )
    back = {c: F.col("row")[c] for c in others}
    back[text_col] = F.when(~F.col("row")["_void"], F.col("body").cast("string"))
    return kept.select(*[back[c].alias(c) for c in docs.columns])
