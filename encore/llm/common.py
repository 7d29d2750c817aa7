"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from encore.session import cut_lineage, ensure_checkpoint_dir, shuffle_partitions

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def conversations(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/conversations.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", null: str | None = "") -> DataFrame:
    """Only the identifier and the text, under fixed names, so that no other column of the input can clash."""
    text = F.col(text_col).cast("string")
    if null is not None:
        text = F.coalesce(text, F.lit(null))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))


def map_arrow(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    return df.mapInArrow(function, schema)


def flushed(rows: Iterator[tuple], schema, limit: int = 8 << 20, weigh: Callable[[tuple], int] | None = None):
    """Record batches of about ``limit`` bytes from tuples, so that no batch grows with a partition."""
    import pyarrow as pa

    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weigh(row) if weigh else 64
        if size >= limit:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def ranged(df: DataFrame, order: Sequence[Column], partitions: int | None = None) -> DataFrame:
    """Rows in the total order ``order``, written to the checkpoint folder with ``_part`` and ``_row`` (0-based).

    Range bounds are sampled, so they must not be drawn again by a second read of the same plan.
    """
    count = partitions or shuffle_partitions(df.sparkSession)
    placed = (
        df.repartitionByRange(count, *order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    return (
        cut_lineage(placed)
        .withColumn("_part", F.shiftright("_slot", 33))
        .withColumn("_row", F.col("_slot").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_slot")
    )


class Scratch:
    """Intermediate tables of one operator call, as compressed Parquet in the shared checkpoint folder.

    Writing a table and reading it back cuts its lineage, so a lost executor undoes nothing. Once the operator's
    result is written itself (:meth:`finished`), all of them go.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{ensure_checkpoint_dir(spark)}/scratch-{uuid.uuid4().hex}"
        self.count = 0

    def stored(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.folder}/{self.count}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def finished(self, result: DataFrame) -> DataFrame:
        kept = cut_lineage(result)
        delete_folder(self.spark, self.folder)
        return kept


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder of the shared store that this package has made."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def before(
    totals: DataFrame, order: str, columns: dict[str, str], group: Sequence[str] = (), also: Sequence[str] = ()
) -> DataFrame:
    """Sums of the earlier rows of ``totals``: ``columns`` maps a summed column to its result's name."""
    window = Window.partitionBy(*group).orderBy(order) if group else Window.orderBy(order)
    window = window.rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        *group, order, *also, *[F.coalesce(F.sum(c).over(window), F.lit(0)).alias(name) for c, name in columns.items()]
    )
