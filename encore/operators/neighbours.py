"""Most similar users or concerts by the cosine of their interaction vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from encore.operators.ordering import global_position
from encore.session import cut_lineage, shuffle_partitions

HOT_DEGREE = 1_000
HOT_COLUMNS = 4_096
# classes and members compared at once, and the strengths of all members that one task passes over
LEFT_BLOCK, RIGHT_BLOCK, TASK_CELLS = 512, 1_024, 8_000_000


def interaction_matrix(interactions: DataFrame) -> DataFrame:
    """(user_id, concert_id, strength): the last interaction of a pair counts."""
    order = ["timestamp", *[c for c in ("event_id",) if c in interactions.columns]]
    return interactions.groupBy("user_id", "concert_id").agg(
        F.max_by("interaction_strength", F.struct(*order)).alias("strength")
    )


def matrix_statistics(matrix: DataFrame) -> DataFrame:
    users, items, n = F.col("total_users"), F.col("total_items"), F.col("total_interactions")
    return matrix.agg(
        F.count_distinct("user_id").alias("total_users"),
        F.count_distinct("concert_id").alias("total_items"),
        F.count(F.lit(1)).alias("total_interactions"),
    ).withColumns({
        "sparsity": F.coalesce(1 - n / F.nullif(users * items, F.lit(0)), F.lit(1.0)),
        "avg_interactions_per_user": F.coalesce(n / F.nullif(users, F.lit(0)), F.lit(0.0)),
    })


def cosine_neighbours(
    matrix: DataFrame,
    row: str,
    column: str,
    k: int = 10,
    min_similarity: float = 0.1,
    queries: DataFrame | None = None,
    hot_degree: int = HOT_DEGREE,
    hot_columns: int = HOT_COLUMNS,
) -> DataFrame:
    """(id1, id2, similarity, rank): the k most similar rows of each row (of each row in ``queries``).

    Rows meet through the columns they share, so only pairs with a common column are formed. The
    hot columns, which would pair a large part of all rows, are left out of that join. Their
    part is exact all the same: rows with equal strengths in the hot columns form one class. Between
    two classes the hot part of the cosine falls with the norm of the partner, so only the k + 1
    members of smallest norm of each class can be among the best partners that share no other column.
    Classes and members are compared block by block (:func:`_best_partners`); no pair is written but the k + 1 best.
    That holds while no strength is negative; where one is, all columns are joined.
    """
    cells = matrix.select(F.col(row).alias("r"), F.col(column).alias("c"), F.col("strength").alias("w")).filter("w <> 0")
    norms = cells.groupBy("r").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    # every later step reads these cells, so the interactions behind them are scanned once
    cells = cut_lineage(cells.join(norms, "r"))
    unit = cells.select("r", "c", (F.col("w") / F.col("norm")).alias("u"))
    # at most ``hot_columns`` rows reach the driver
    hot = [
        x["c"] for x in cells.filter("c IS NOT NULL").groupBy("c").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot_degree)
        .orderBy(F.desc("n"), "c").limit(hot_columns).collect()
    ]
    if hot and not cells.filter("w < 0").isEmpty():
        hot = []
    if hot:
        slots = cells.sparkSession.createDataFrame([(i, c) for i, c in enumerate(hot)], f"slot int, c {cells.schema['c'].dataType.simpleString()}")
        scored = _shared_columns(unit.join(slots, "c", "left_anti"), queries)
        scored = _with_hot_columns(scored, cells.join(slots, "c"), len(hot), k, queries)
    else:
        scored = _shared_columns(unit, queries)
    # rounded, so that the order does not hang on the summation order of doubles
    best = scored.withColumn("similarity", F.round("similarity", 9)).filter(F.col("similarity") >= min_similarity)
    order = Window.partitionBy("id1").orderBy(F.desc("similarity"), "id2")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _shared_columns(unit: DataFrame, queries: DataFrame | None) -> DataFrame:
    left = unit.select(F.col("r").alias("id1"), "c", F.col("u").alias("u1"))
    right = unit.select(F.col("r").alias("id2"), "c", F.col("u").alias("u2"))
    product = F.sum(F.col("u1") * F.col("u2")).alias("similarity")
    if queries is not None:
        asked = queries.select(F.col(queries.columns[0]).alias("id1")).distinct()
        left = left.join(asked, "id1", "left_semi")
        return left.join(right, "c").filter(F.col("id1") != F.col("id2")).groupBy("id1", "id2").agg(product)
    half = left.join(right, "c").filter(F.col("id1") < F.col("id2")).groupBy("id1", "id2").agg(product)
    there = F.struct("id1", "id2", "similarity")
    back = F.struct(F.col("id2").alias("id1"), F.col("id1").alias("id2"), "similarity")
    return half.select(F.inline(F.array(there, back)))


def _with_hot_columns(
    cold: DataFrame, cells: DataFrame, width: int, k: int, queries: DataFrame | None
) -> DataFrame:
    """Add the hot part to the pairs found, and the best partners that share hot columns only.

    ``cells`` are those of the hot columns, with their ``slot``; ``width`` is the number of slots.
    """
    strengths = F.array_sort(F.collect_list(F.struct("slot", "w")))
    profiles = cut_lineage(cells.groupBy("r").agg(strengths.alias("p"), F.first("norm").alias("norm")))
    classes = cut_lineage(profiles.select("p").distinct().withColumn("class", F.monotonically_increasing_id()))
    rows = profiles.join(classes, "p")

    def product(a: str, b: str) -> Column:
        """Of a list of strengths and a map of them."""
        held = F.col(b)
        return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x["w"] * F.coalesce(F.try_element_at(held, x["slot"]), F.lit(0.0)))

    one = profiles.select(F.col("r").alias("id1"), F.col("p").alias("p1"), F.col("norm").alias("n1"))
    two = profiles.select(F.col("r").alias("id2"), F.map_from_entries("p").alias("p2"), F.col("norm").alias("n2"))
    hot_part = F.coalesce(product("p1", "p2") / (F.col("n1") * F.col("n2")), F.lit(0.0))
    full = cold.join(one, "id1", "left").join(two, "id2", "left").select(
        "id1", "id2", (F.col("similarity") + hot_part).alias("similarity")
    )
    asked = rows.select(F.col("r").alias("id1"), F.col("norm").alias("n1"), "class")
    if queries is not None:
        asked = asked.join(queries.select(F.col(queries.columns[0]).alias("id1")).distinct(), "id1", "left_semi")
        classes = classes.join(asked.select("class").distinct(), "class", "left_semi")
    # rounded, so that equal rows are taken in the order of their ids
    by_norm = Window.partitionBy("class").orderBy(F.round("norm", 12), "r")
    members = rows.withColumn("place", F.row_number().over(by_norm)).filter(F.col("place") <= k + 1)
    partners = _best_partners(classes, members, width, k + 1)
    hot_only = asked.join(partners, "class").filter(F.col("id1") != F.col("id2")).select(
        "id1", "id2", (F.col("gain") / F.col("n1")).alias("similarity")
    )
    return full.unionByName(hot_only).groupBy("id1", "id2").agg(F.max("similarity").alias("similarity"))


def _blocks(vectors: DataFrame, key: str, size: int, suffix: str) -> DataFrame:
    """Up to ``size`` vectors (a number ``key``, norm, p) a row: their keys, norms, numbers of strengths, slots and strengths."""
    listed = vectors.select(F.floor(F.col(key) / size).alias(f"block{suffix}"), F.struct(key, "norm", "p").alias("v")).groupBy(
        f"block{suffix}"
    ).agg(F.collect_list("v").alias("v"))
    each = F.flatten(F.transform("v", lambda v: v["p"]))
    return listed.select(
        f"block{suffix}", F.transform("v", lambda v: v[key]).alias(f"key{suffix}"), F.transform("v", lambda v: v["norm"]).alias(f"norm{suffix}"),
        F.transform("v", lambda v: F.size(v["p"])).alias(f"held{suffix}"),
        F.transform(each, lambda x: x["slot"]).alias(f"slot{suffix}"), F.transform(each, lambda x: x["w"]).alias(f"w{suffix}"),
    )


def _best_partners(classes: DataFrame, members: DataFrame, width: int, most: int) -> DataFrame:
    """(class, id2, gain): the ``most`` members with the largest product with a class, divided by their own norm.

    Every block of classes passes over all blocks of members, as matrix products. A task keeps the best of its classes only
    and reads the blocks from the checkpoint folder, so neither pairs nor copies of the blocks are shuffled.
    """
    numbered = cut_lineage(global_position(members.select("r", "norm", "p"), [F.col("r").asc()], "number"))
    cells = numbered.agg(F.sum(F.size("p")).alias("n")).first()["n"] or 0
    left = cut_lineage(_blocks(classes.withColumn("norm", F.lit(1.0)), "class", LEFT_BLOCK, "1").repartition(
        shuffle_partitions(classes.sparkSession)))
    right = cut_lineage(_blocks(numbered, "number", RIGHT_BLOCK, "2").repartition(1 + cells // TASK_CELLS))
    found = left.hint("shuffle_replicate_nl").crossJoin(right).mapInArrow(
        _multiplied(width, most), "class bigint, number bigint, gain double"
    )
    best = Window.partitionBy("class").orderBy(F.desc("gain"), "number")
    return found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= most).join(
        numbered.select("number", F.col("r").alias("id2")), "number"
    ).select("class", "id2", "gain")


def _multiplied(width: int, most: int):
    """Arrow batches of (left block, right block) to the best members of every class, ties to the smaller number."""
    def run(batches):
        block = None
        for batch in batches:
            for i in range(batch.num_rows):
                def values(name, i=i, batch=batch):
                    return batch.column(name)[i].values.to_numpy(zero_copy_only=False)

                def dense(side):
                    held = values(f"held{side}")
                    out = np.zeros((len(held), width))
                    out[np.repeat(np.arange(len(held)), held), values(f"slot{side}")] = values(f"w{side}")
                    return out / values(f"norm{side}")[:, None]

                if batch.column("block1")[i].as_py() != block:
                    if block is not None:
                        yield table(keys, row, number, gain)
                    block, keys, left = batch.column("block1")[i].as_py(), values("key1").copy(), dense("1")
                    row, number, gain = np.zeros(0, "int64"), np.zeros(0, "int64"), np.zeros(0)
                    floor = np.zeros(len(keys))
                product = left @ dense("2").T
                at, column = np.nonzero(product >= np.maximum(floor - 1e-11, 1e-13)[:, None])
                row, number = np.concatenate((row, at)), np.concatenate((number, values("key2")[column]))
                # rounded, so that the order does not hang on the summation order of doubles
                gain = np.concatenate((gain, np.round(product[at, column], 12)))
                order = np.lexsort((number, -gain, row))
                row, number, gain = row[order], number[order], gain[order]
                place = np.arange(len(row)) - np.searchsorted(row, np.arange(len(keys)))[row]
                last = place == most - 1
                floor[row[last]] = gain[last]
                row, number, gain = (x[place < most] for x in (row, number, gain))
        if block is not None:
            yield table(keys, row, number, gain)

    def table(keys, row, number, gain):
        return pa.RecordBatch.from_arrays([pa.array(keys[row]), pa.array(number), pa.array(gain)], ["class", "number", "gain"])

    return run


def similar_users(matrix: DataFrame, k: int = 10, min_similarity: float = 0.1, queries: DataFrame | None = None) -> DataFrame:
    return cosine_neighbours(matrix, "user_id", "concert_id", k, min_similarity, queries)


def similar_concerts(matrix: DataFrame, k: int = 10, min_similarity: float = 0.1, queries: DataFrame | None = None) -> DataFrame:
    return cosine_neighbours(matrix, "concert_id", "user_id", k, min_similarity, queries)
