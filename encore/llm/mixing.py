"""Mixing sources to target weights with a multivariate hypergeometric splitting tree over blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from encore.session import cut_lineage, shuffle_partitions

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
BLOCKS = 64  # blocks of a source
CELLS = 1024  # cells of a block
SHARDS = 16
BROADCAST_ROWS = 100_000


def draw_key(value: Column, seed: int, use: str) -> Column:
    """60 random bits that depend on the value, the seed and the use alone."""
    text = F.concat_ws(":", F.lit(use), F.lit(seed).cast("string"), F.coalesce(value.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``sources`` (source, source_size) with weight and target.

    Weights go round over the sources in code point order, null last. All sizes are shared out by weight; a target
    above ``max_repeat`` times its source stops there and the excess goes to the others by weight, until none is
    above. In the order of size / weight the capped sources come first, so prefix sums give the fixed point at once.
    """
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    nth = (F.row_number().over(by_name) - 1) % len(weights)
    weighted = sources.withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (nth + 1).cast("int"))
    ).withColumn("most", F.col("source_size") * F.lit(float(max_repeat)))
    everything = Window.partitionBy(F.lit(0))
    by_room = everything.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = by_room.rowsBetween(Window.unboundedPreceding, -1)
    prefix = weighted.select(
        "*",
        F.sum("source_size").over(everything).cast("double").alias("whole"),
        F.sum("weight").over(everything).alias("weights"),
        F.coalesce(F.sum("most").over(earlier), F.lit(0.0)).alias("used"),
        F.coalesce(F.sum("weight").over(earlier), F.lit(0.0)).alias("gone"),
    ).withColumn("level", (F.col("whole") - F.col("used")) / (F.col("weights") - F.col("gone")))
    judged = prefix.withColumn("capped", F.col("level") * F.col("weight") > F.col("most"))
    level = F.min(F.when(~F.col("capped"), F.struct("gone", "level"))).over(everything)["level"]
    return judged.withColumn("final", level).select(
        "source", "source_size", "weight",
        F.when(F.col("capped"), F.col("most")).otherwise(F.col("final") * F.col("weight")).alias("target"),
    )


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def _settle(rows: DataFrame, rest: DataFrame, path: Sequence[str], step: str) -> DataFrame:
    """Prefix sums of the groups ``step`` below ``path``: whole is true for those taken, rest is left to the cut one."""
    sums = rows.groupBy("source", *path, step).agg(F.sum("size").alias("words"))
    renamed = rest.select(F.col("source").alias("_source"), *[F.col(p).alias(f"_{p}") for p in path], "rest")
    same = _same("source", "_source")
    for p in path:
        same = same & (F.col(p) == F.col(f"_{p}"))
    inside = Window.partitionBy("source", *path).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
    return (
        sums.join(renamed, same)
        .withColumn("_left", F.col("rest") - F.coalesce(F.sum("words").over(inside), F.lit(0)))
        .select("source", *path, step, ((F.col("words") <= F.col("_left")) & (F.col("rest") > 0)).alias("whole"),
                F.greatest(F.col("_left"), F.lit(0.0)).alias("rest"))
    )


def split_tree(draws: DataFrame, shards: int = SHARDS, seed: int = 0) -> DataFrame:
    """Deal block draws (source, block, pass) out to ``shards``, as equal in number as can be.

    A node of the tree holds a range of shards and a quota of blocks of each source. Half of its shards get their
    part of its blocks, drawn without replacement over all sources at once, which makes the sources' quotas on either
    side multivariate hypergeometric and exact in sum. Blocks per source are fixed, so a node's size follows the
    number of sources, not of rows.
    """
    nodes = draws.withColumn("low", F.lit(0)).withColumn("high", F.lit(shards))
    depth = max(0, (shards - 1).bit_length())
    for level in range(depth):
        node = Window.partitionBy("low", "high")
        name = F.concat_ws("/", F.coalesce("source", F.lit("")), F.col("source").isNull().cast("string"), "block", "pass")
        drawn = nodes.select(
            "*",
            F.expr("low + (high - low) div 2").cast("int").alias("middle"),
            F.row_number().over(
                node.orderBy(draw_key(name, seed, f"split{level}"), F.col("source").asc_nulls_last(), "block", "pass")
            ).alias("nth"),
            F.count(F.lit(1)).over(node).alias("quota"),
        )
        # a node of one shard has its middle at its low end and stays as it is
        left = F.expr("nth <= quota * (middle - low) div (high - low)")
        nodes = drawn.select(
            "source", "block", "pass",
            F.when(left, F.col("low")).otherwise(F.col("middle")).alias("low"),
            F.when(left, F.col("middle")).otherwise(F.col("high")).alias("high"),
        )
    return nodes.select("source", "block", "pass", F.col("low").alias("shard"))


def _keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    """``docs`` with a struct ``_mix`` of identifier, source, size, key, block and cell."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = draw_key(F.col(id_col), seed, "place")
    return docs.withColumn("_mix", F.struct(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("size"),
        key.alias("key"), (key % BLOCKS).cast("int").alias("block"),
        (F.shiftright(key, 6) % CELLS).cast("int").alias("cell"),
    ))


def _plan(rows: DataFrame, weights, max_repeat: int, shards: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """What the mix takes: a row per block with its source's target and its shards, and a row per cell of cut blocks."""
    # one row per source from here on to the first join
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = targets(sums, weights, max_repeat).withColumn(
        "passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
        .cast("int")
    ).withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
    goals = cut_lineage(goals)
    blocks = cut_lineage(_settle(rows, goals, [], "block"))
    # at most one group of each source is cut: it is not whole and something is left for it
    cut_block = blocks.where("not whole and rest > 0").select("source", "block", "rest")
    in_block = rows.join(
        cut_block.select(F.col("source").alias("_s"), F.col("block").alias("_b")),
        _same("source", "_s") & (F.col("block") == F.col("_b")),
    ).drop("_s", "_b")
    cells = cut_lineage(_settle(in_block, cut_block, ["block"], "cell"))
    passes = goals.select("source", F.explode(F.sequence(F.lit(0), F.col("passes"))).alias("pass"))
    dealt = split_tree(
        passes.join(blocks.select(F.col("source").alias("_s"), "block"), _same("source", "_s")).drop("_s"), shards, seed
    )
    plans = dealt.groupBy("source", "block").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pass", "shard"))), lambda x: x["shard"]).alias("shards")
    )
    table = (
        blocks.select("source", "block", "whole")
        .join(goals.select(F.col("source").alias("_s"), "source_size", "target", "passes"), _same("source", "_s"))
        .drop("_s")
        .join(plans.select(F.col("source").alias("_s"), F.col("block").alias("_b"), "shards"),
              _same("source", "_s") & (F.col("block") == F.col("_b")))
        .select("source", "block", "whole", "source_size", "target", "passes", "shards")
    )
    return cut_lineage(table), cells


def _small(table: DataFrame) -> DataFrame:
    """Broadcast a table that follows the number of sources if it is small, else leave the join to Spark."""
    return F.broadcast(table) if table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else table


def _apply(keyed: DataFrame, table: DataFrame, cells: DataFrame) -> DataFrame:
    """Adds copies, source_size, target and shards to rows with ``_mix``."""
    names = [*keyed.columns, "_table"]
    in_block = F.col("_mix.source").eqNullSafe(F.col("_table.source")) & (F.col("_mix.block") == F.col("_table.block"))
    located = keyed.join(_small(table.select(F.struct("*").alias("_table"))), in_block)
    in_cell = (
        F.col("_mix.source").eqNullSafe(F.col("_cell.source")) & (F.col("_mix.block") == F.col("_cell.block"))
        & (F.col("_mix.cell") == F.col("_cell.cell"))
    )
    located = located.join(_small(cells.select(F.struct("*").alias("_cell"))), in_cell, "left")
    cut = F.coalesce(~F.col("_cell.whole") & (F.col("_cell.rest") > 0), F.lit(False))
    plain = located.where(~cut).withColumn(
        "_extra", F.col("_table.whole") | F.coalesce("_cell.whole", F.lit(False))
    )
    # only the documents of one cell per source are left to sort
    inside = Window.partitionBy("_mix.source", "_mix.block", "_mix.cell").orderBy(
        "_mix.key", F.col("_mix.doc_id").asc_nulls_first(), "_mix.size"
    )
    earlier = F.coalesce(F.sum("_mix.size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last = located.where(cut).withColumn("_extra", earlier + F.col("_mix.size") / 2 <= F.col("_cell.rest"))
    return plain.unionByName(last).withColumn("_copies", F.col("_table.passes") + F.col("_extra").cast("int")).select(
        *names, "_copies"
    )


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_repeat: int = MAX_REPEAT,
    shards: int = SHARDS,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, copies, taken, shards.

    Every source is cut into 64 blocks of 1,024 cells by random bits of the identifier. Its quota is a number of
    whole passes over all its blocks, and of one more pass the whole blocks that fit, then the cells of the next
    block that fit, then the documents of the next cell up to the nearest one. Prefix sums run over at most 64 blocks
    or 1,024 cells of a source and over the documents of one cell, so a source that holds most rows is summed before
    it moves. ``copies`` is what the mix takes, ``taken`` copies times size; ``shards`` has the output shard of each
    copy, dealt out by :func:`split_tree`. Reruns agree, as every draw depends on identifiers and the seed alone.

    Size is the number of words; a null text has none. A null source is a source of its own, last in order. A null
    identifier is drawn like an empty one; of rows equal in identifier and size any may be the one that is taken. An
    empty table gives no rows; where all sizes are zero nothing is taken. A source at ``max_repeat`` times its size
    gets no further pass, for its empty documents either. Other columns are not read.
    """
    keyed = _keyed(docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(source_col).alias("source")
    ), "doc_id", "text", "source", seed).select("_mix")
    keyed = cut_lineage(keyed)
    table, cells = _plan(keyed.select("_mix.*"), weights, max_repeat, shards, seed)
    return _apply(keyed, table, cells).select(
        "_mix.doc_id", "_mix.source", "_mix.size", "_table.source_size", "_table.target", F.col("_copies").alias("copies"),
        (F.col("_copies") * F.col("_mix.size")).cast("bigint").alias("taken"),
        F.slice("_table.shards", 1, F.col("_copies")).alias("shards"),
    )


def mixed_documents(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_repeat: int = MAX_REPEAT,
    shards: int = SHARDS,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The mix itself: each row of ``docs``, all columns, as often as :func:`mix` takes it, in shuffled shards.

    Every shard is a stretch of the output in an order drawn anew from the seed; large shards are spread over several
    tasks. Texts move once.
    """
    keyed = _keyed(docs, id_col, text_col, source_col, seed)
    table, cells = _plan(cut_lineage(keyed.select("_mix")).select("_mix.*"), weights, max_repeat, shards, seed)
    taken = _apply(keyed, table, cells).withColumn("_shard", F.explode(F.slice("_table.shards", 1, F.col("_copies"))))
    order = ["_shard", draw_key(F.concat_ws("/", F.col("_mix.key").cast("string"), "_shard"), seed, "order")]
    count = shuffle_partitions(docs.sparkSession)
    return taken.repartitionByRange(count, *order).sortWithinPartitions(*order).select(*docs.columns)
