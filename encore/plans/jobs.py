"""The file-to-table jobs: read raw records, clean, resolve duplicates, write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from encore.operators.dedupe import THRESHOLDS, deduplicate, duplicate_metrics
from encore.operators.normalize import good_share, normalize_artists, normalize_concerts, normalize_venues
from encore.schemas import RECORDS
from encore.session import cut_lineage


def _finish(cleaned: DataFrame, data_type: str, columns: list[str], key: str, output: str, duplicates_output: str) -> DataFrame:
    """Write the rows without duplicates, the duplicates if there are any, and return the metrics."""
    cleaned = cut_lineage(cleaned)
    kept, duplicates = deduplicate(cleaned, columns, key, THRESHOLDS[data_type])
    kept.write.mode("overwrite").parquet(output)
    if not duplicates.isEmpty():
        duplicates.write.mode("overwrite").json(duplicates_output)
    return good_share(cleaned, data_type).unionByName(duplicate_metrics(cleaned, duplicates, data_type))


def artist_job(spark: SparkSession, source: str, output: str, duplicates_output: str) -> DataFrame:
    schema = RECORDS["artists"].replace("genre array<string>", "genre string")
    cleaned = normalize_artists(spark.read.schema(schema).json(source))
    return _finish(cleaned, "artists", ["name_normalized"], "artist_id", output, duplicates_output)


def venue_job(spark: SparkSession, source: str, output: str, duplicates_output: str) -> DataFrame:
    cleaned = normalize_venues(spark.read.schema(RECORDS["venues"]).json(source))
    return _finish(cleaned, "venues", ["name_normalized", "city_normalized"], "venue_id", output, duplicates_output)


def concert_job(spark: SparkSession, source: str, output: str, as_of: str) -> DataFrame:
    cleaned = normalize_concerts(spark.read.schema(RECORDS["concerts"]).json(source), as_of)
    cleaned.write.mode("overwrite").parquet(output)
    return good_share(spark.read.parquet(output), "concerts")
