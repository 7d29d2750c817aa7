"""Global order without a one-partition window.

``Window.orderBy`` without a partition key moves the whole relation to one task. Here the rows are
range partitioned, sorted inside each partition and numbered locally; the partition sizes (one row
per partition) give the offsets. The numbered rows are checkpointed first, because the boundaries
of a range partitioning are sampled and must not be drawn again by a second read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from encore.session import cut_lineage, shuffle_partitions

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row number in its lower 33 bits


def _ranged(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    parts = shuffle_partitions(df.sparkSession)
    placed = (
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    return cut_lineage(placed).withColumn("_part", F.shiftright("_slot", _LOCAL_BITS))


def global_position(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """Add the 1-based position of each row in the total order ``order`` (end it with a unique key)."""
    placed = _ranged(df, order)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range partition, so this window and the broadcast are bounded by the partition count
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    local = F.col("_slot").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, (F.col("_offset") + local + 1).cast("bigint"))
        .drop("_part", "_slot", "_offset")
    )


def position_within(df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str = "position") -> DataFrame:
    """Add the 1-based position within the group, however large a group is.

    One global order with the group in front numbers all rows; each group's first position is then
    subtracted. ``_size`` holds the size of the group.
    """
    placed = global_position(df, [*[F.col(g).asc_nulls_first() for g in group], *order], "_place")
    sizes = placed.groupBy(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)]).agg(
        F.count(F.lit(1)).alias("_size"), (F.min("_place") - 1).alias("_before")
    )
    same = None
    for i, g in enumerate(group):
        one = F.col(g).eqNullSafe(F.col(f"_g{i}"))
        same = one if same is None else same & one
    return placed.join(sizes, same).withColumn(name, F.col("_place") - F.col("_before")).drop(
        "_place", "_before", *[f"_g{i}" for i in range(len(group))]
    )


def dense_rank_by(df: DataFrame, value: str, name: str = "rank", descending: bool = True) -> DataFrame:
    """Dense rank of ``value`` over the whole relation: rank the distinct values, then join them back."""
    key = F.col(value).desc() if descending else F.col(value).asc()
    ranks = global_position(df.select(value).distinct(), [key], name)
    return df.join(ranks, value)


def running_sums(
    df: DataFrame, order: Sequence[str], sums: Sequence[str], group: Sequence[str] = ()
) -> DataFrame:
    """Replace each column of ``sums`` by its running total in ``order`` within ``group``.

    Rows need unique (group, order) values. Works in two passes: running totals inside each range
    partition, then the totals of the earlier partitions of the same group as offsets.
    """
    placed = _ranged(df, [F.col(c) for c in [*group, *order]]).drop("_slot")
    inside = (
        Window.partitionBy("_part", *group)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    if group:
        earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("_part", *group).agg(*[F.sum(c).alias(c) for c in sums])
    offsets = totals.select(
        "_part", *group, *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_before_{c}") for c in sums]
    )
    out = placed.join(offsets, ["_part", *group])
    keep = [c for c in df.columns if c not in sums]
    return out.select(*keep, *[(F.sum(c).over(inside) + F.col(f"_before_{c}")).alias(c) for c in sums])


def earlier_totals(
    df: DataFrame, order: Sequence[str], group: Sequence[str], sums: Sequence[str], maxima: Sequence[str] = ()
) -> DataFrame:
    """Replace ``sums`` and ``maxima`` by their totals over the earlier rows of the group, the row itself not counted.

    Rows need unique (group, order) values. A sum without earlier rows is 0, a maximum null. As in :func:`running_sums` a
    hot group is spread over range partitions; one row per partition and group carries the earlier partitions' totals.
    """
    placed = _ranged(df, [F.col(c) for c in [*group, *order]]).drop("_slot")
    inside = Window.partitionBy("_part", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("_part", *group).agg(
        *[F.sum(c).alias(c) for c in sums], *[F.max(c).alias(c) for c in maxima]
    ).select(
        "_part", *group, *[F.sum(c).over(ahead).alias(f"_ahead_{c}") for c in sums],
        *[F.max(c).over(ahead).alias(f"_ahead_{c}") for c in maxima],
    )
    out = placed.join(totals, ["_part", *group])
    keep = [c for c in df.columns if c not in (*sums, *maxima)]
    zero = F.lit(0)
    return out.select(
        *keep,
        *[(F.coalesce(F.sum(c).over(inside), zero) + F.coalesce(f"_ahead_{c}", zero)).alias(c) for c in sums],
        *[F.greatest(F.max(c).over(inside), f"_ahead_{c}").alias(c) for c in maxima],
    )
