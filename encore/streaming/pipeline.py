"""Streaming jobs: sources, routing to tables, windows, quality. Kafka or files; the rest is the same."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from encore.operators.quality import RULES, quality_summary, rule_results
from encore.session import cut_lineage, ensure_checkpoint_dir
from encore.streaming.envelope import PROCESSORS, ROUTES, parse

TRIGGER_SECONDS = 5


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def file_stream(spark: SparkSession, folder: str, pattern: str = "*", files_per_trigger: int | None = None) -> DataFrame:
    """Lines of the files landed in a folder, each file once (the checkpoint remembers them)."""
    reader = spark.readStream.option("pathGlobFilter", pattern)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    lines = reader.text(folder)
    return lines.select("value", F.col("_metadata.file_path").alias("sequence"))


def kafka_stream(
    spark: SparkSession, servers: str, topic: str, records_per_trigger: int | None = None, start: str = "latest"
) -> DataFrame:
    """Records of a Kafka topic with key, position and arrival time; needs the Kafka package."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start}
    if records_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(records_per_trigger)
    raw = spark.readStream.format("kafka").options(**options).load()
    return raw.select(
        F.col("value").cast("string").alias("value"),
        F.col("key").cast("string").alias("partition_key"),
        F.concat_ws(":", "partition", "offset").alias("sequence"),
        F.col("timestamp").alias("arrived_at"),
    )


def deduplicated(parsed: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Delivery is at least once: one record per id within the delay; a record without id goes by its content."""
    content = F.concat_ws("\n", "source", "data_type", "ingestion_timestamp", "payload")
    named = F.concat(F.lit("id:"), F.col("record_id"))
    stamped = parsed.withColumn("ingested_at", F.try_to_timestamp(F.col("ingestion_timestamp"))).withColumn(
        "_once", F.coalesce(named, F.sha2(content, 256))
    )
    return stamped.withWatermark("ingested_at", delay).dropDuplicatesWithinWatermark(["_once"]).drop("_once")


def route_batch(folder: str) -> Callable[[DataFrame, int], None]:
    """Writer of one micro-batch: raw records, one table per type, dead letters and counts.

    Every row carries its batch id, and a repeated batch replaces its own partitions.
    """
    def write(df: DataFrame, name: str, batch_id: int) -> None:
        df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("batch_id").parquet(f"{folder}/{name}")

    def route(batch: DataFrame, batch_id: int) -> None:
        records = parse(batch).persist()
        try:
            good = records.filter(F.col("problem").isNull())
            write(records.filter(F.col("problem").isNotNull()), "dead_letters", batch_id)
            write(good.withColumn("day", F.to_date(F.try_to_timestamp("ingestion_timestamp"))), "raw", batch_id)
            for table, process in PROCESSORS.items():
                kinds = [k for k, t in ROUTES.items() if t == table]
                write(process(good.filter(F.col("data_type").isin(kinds))), f"processed/{table}", batch_id)
            outcome = F.when(F.col("problem").isNull(), F.col("data_type")).otherwise(F.lit("failed"))
            write(records.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("records")), "counts", batch_id)
        finally:
            records.unpersist()

    return route


def start_router(
    lines: DataFrame, folder: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Route a stream into tables, every few seconds or once over all that is there."""
    writer = lines.writeStream.foreachBatch(route_batch(folder)).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=f"{TRIGGER_SECONDS} seconds"
    )
    return writer.start()


def sales_windows(sales: DataFrame, when: str, key: str, length: str = "1 hour", slide: str | None = None,
                  delay: str = "10 minutes") -> DataFrame:
    """Tickets and revenue per key and event-time window; rows later than the delay are dropped.

    Counted with partial aggregation before the shuffle, so a hot key is one row per task.
    """
    kind = sales.schema[when].dataType
    window = F.window(when, length, slide) if slide else F.window(when, length)
    # a watermark needs a timestamp with a zone
    grouped = sales.withColumn(when, F.col(when).cast("timestamp")).withWatermark(when, delay).groupBy(window.alias("w"), F.col(key)).agg(
        F.count(F.lit(1)).alias("sales"), F.sum("quantity").alias("tickets"), F.sum("total_price").alias("revenue")
    )
    return grouped.select(
        F.col("w.start").cast(kind).alias("window_start"), F.col("w.end").cast(kind).alias("window_end"), key,
        "sales", "tickets", "revenue",
    )


def kept_windows(folder: str) -> Callable[[DataFrame, int], None]:
    """Batch writer of the windows a micro-batch has changed, with their totals so far; a repeated batch replaces itself."""
    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{folder}/windows")

    return keep


def run_windows(windows: DataFrame, folder: str) -> None:
    """Bring the window table in ``folder`` up to date with all that has arrived, and stop.

    ``windows`` comes from :func:`sales_windows`. The open windows' state lies in the checkpoint beside the table, so the
    next run goes on from it: two runs over the halves of a stream leave what one run over the whole does. Every change
    is written, so a window is in the table from its first sale on and need not be closed to be seen.
    """
    windows.writeStream.outputMode("update").foreachBatch(kept_windows(folder)).option(
        "checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()


def current_windows(spark: SparkSession, folder: str, until: str | None = None) -> DataFrame:
    """The window table: each window's newest totals, only of windows that end at ``until`` or before it if given."""
    rows = spark.read.parquet(f"{folder}/windows")
    totals = ["sales", "tickets", "revenue"]
    keys = [c for c in rows.columns if c not in (*totals, "batch_id")]
    if until is not None:
        rows = rows.filter(F.col("window_end") <= F.lit(until).cast(rows.schema["window_end"].dataType))
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*totals), "batch_id").alias("newest"))
    return newest.select(*keys, "newest.*")


def compact_windows(spark: SparkSession, folder: str) -> None:
    """Leave one row per window in the newest batch's partition; to be run between runs of the stream.

    The rows of earlier batches go last, so a reader in between finds the same newest totals.
    """
    stored = spark.read.parquet(f"{folder}/windows")
    batches = [r.batch_id for r in stored.select("batch_id").distinct().collect()]  # one number per micro-batch kept
    if len(batches) < 2:
        return
    newest = cut_lineage(current_windows(spark, folder))
    kept_windows(folder)(newest.select(*[c for c in stored.columns if c != "batch_id"]), max(batches))
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/windows")
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for batch_id in batches:
        if batch_id != max(batches):
            store.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/windows/batch_id={batch_id}"), True)


def late_rows(when: str, delay: str, folder: str) -> Callable[[DataFrame, int], None]:
    """Batch writer that counts rows behind the newest time seen in earlier batches minus the delay.

    Each batch leaves the newest time of all batches so far, so the next one reads a single row.
    """
    def count(batch: DataFrame, batch_id: int) -> None:
        seen = f"{folder}/newest"
        newest = batch.agg(F.max(when).alias("newest"))
        if batch_id > 0:
            before = batch.sparkSession.read.parquet(f"{seen}/batch_id={batch_id - 1}").select("newest").scalar()
            late = batch.filter(F.col(when) < before - F.expr(f"INTERVAL {delay}"))
            newest = newest.select(F.greatest("newest", before).alias("newest"))
        else:
            late = batch.limit(0)
        late.agg(F.count(F.lit(1)).alias("late")).withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{folder}/late")
        newest.write.mode("overwrite").parquet(f"{seen}/batch_id={batch_id}")

    return count


def quality_batch(folder: str, data_type: str, as_of: str) -> Callable[[DataFrame, int], None]:
    """Batch writer of the quality summary of each micro-batch."""
    def check(batch: DataFrame, batch_id: int) -> None:
        summary = quality_summary(rule_results(batch, RULES[data_type], data_type, as_of))
        summary.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(folder)

    return check


def run_available(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a stream once over all that is there, into a new folder, and read the result."""
    spark = stream.sparkSession
    folder = scratch_folder(spark, name)
    stream.writeStream.outputMode(mode).format("parquet").option("checkpointLocation", f"{folder}/checkpoint").option(
        "path", f"{folder}/out"
    ).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


def run_batches(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Run a batch writer once over all that is there."""
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(
        availableNow=True
    ).start().awaitTermination()
