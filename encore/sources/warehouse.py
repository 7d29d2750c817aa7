"""Warehouse tables: definitions, bulk loads with quarantine, upserts, exports and status."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.functions.times import days_before
from encore.schemas import PARTITIONS, REQUIRED, TABLES
from encore.session import cut_lineage

MAX_ERROR_SHARE = 0.01
# fixed values: date and time forms of the files, tried in this order
TIME_FORMS = (
    "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ssX", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "yyyy-MM-dd",
)


def create_tables(spark: SparkSession, database: str, folder: str) -> None:
    """The seven tables, where they do not exist yet."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, columns in TABLES.items():
        # texts are cut to their width by the loader, so the table itself keeps plain strings
        listed = ", ".join(f"{c} {'string' if t.startswith('varchar') else t}" for c, t in columns.items())
        spread = f"PARTITIONED BY ({PARTITIONS[name]})" if name in PARTITIONS else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({listed}) USING parquet {spread} LOCATION '{folder}/{name}'")


def drop_tables(spark: SparkSession, database: str) -> None:
    for name in TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")


def drop_old_partitions(spark: SparkSession, table: str, column: str, as_of: str, days: int = 30) -> int:
    """Drop the dates of a snapshot table older than ``days``; the listing holds one row per date."""
    cutoff = days_before(as_of, days).isoformat()
    dates = [r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    old = [d for d in dates if d < cutoff]
    for date in old:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({column} = '{date}')")
    return len(old)


def drop_old_dates(spark: SparkSession, folder: str, column: str, as_of: str, days: int = 30) -> int:
    """Delete the ``column=date`` folders of a snapshot table older than ``days``; returns how many there were.

    For tables that no catalog lists. The listing holds one row per date, and readers of later dates are not touched.
    """
    cutoff = days_before(as_of, days).isoformat()
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    held = [(entry.getPath().getName().partition("="), entry.getPath()) for entry in files.listStatus(path)]
    old = [where for (name, _, date), where in held if name == column and date[:4].isdigit() and date < cutoff]
    for where in old:
        files.delete(where, True)
    return len(old)


def column_listing(spark: SparkSession, database: str, table: str) -> DataFrame:
    """(column_name, data_type, nullable, is_partition) of a table."""
    rows = [(c.name, c.dataType, c.nullable, c.isPartition) for c in spark.catalog.listColumns(f"{database}.{table}")]
    return spark.createDataFrame(rows, "column_name string, data_type string, nullable boolean, is_partition boolean")


def register_table(spark: SparkSession, database: str, table: str, schema: str, location: str,
                   properties: Mapping[str, str] | None = None) -> None:
    """An external Parquet table over a folder; repeated calls only renew its properties."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{table} ({schema}) USING parquet LOCATION '{location}'")
    if properties:
        listed = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {database}.{table} SET TBLPROPERTIES ({listed})")


def _text(column: Column, kind: T.DataType) -> Column:
    """Any value as the text a load file would hold: lists and maps as JSON, blanks as null."""
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        column = F.to_json(column)
    return F.nullif(F.trim(column.cast("string")), F.lit(""))


def _convert(text: Column, kind: str) -> Column:
    if kind.startswith("varchar"):
        return F.substring(text, 1, int(kind[8:-1]))
    if kind in ("timestamp", "date"):
        parsed = F.coalesce(*[F.try_to_timestamp(text, F.lit(form)) for form in TIME_FORMS])
        return parsed.cast("timestamp_ntz" if kind == "timestamp" else "date")
    return text.try_cast(kind)


def prepare_load(raw: DataFrame, table: str) -> DataFrame:
    """Columns of the table from raw rows, with ``_errors``: required values missing, others unreadable.

    Blank text counts as null, text is cut to the width of its column, dates are read in any of the
    known forms. Columns the input lacks are null, columns the table lacks are dropped. ``_raw`` holds the row as JSON
    where it has errors.
    """
    types = {f.name: f.dataType for f in raw.schema.fields}
    texts, values, errors = {}, {}, []
    for name, kind in TABLES[table].items():
        text, value = F.col(f"_text_{name}"), F.col(f"_value_{name}")
        texts[f"_text_{name}"] = _text(F.col(name), types[name]) if name in types else F.lit(None).cast("string")
        values[f"_value_{name}"] = _convert(text, kind)
        errors.append(F.when(text.isNotNull() & value.isNull(), F.lit(f"{name} unreadable")))
        if name in REQUIRED.get(table, ()):
            errors.append(F.when(text.isNull(), F.lit(f"{name} missing")))
    # step by step, so that no text is made and no value read twice
    read = raw.select(F.struct("*").alias("_row"), *[c.alias(n) for n, c in texts.items()]).withColumns(values).withColumn(
        "_errors", F.array_compact(F.array(*errors)))
    return read.select(
        *[F.col(f"_value_{n}").alias(n) for n in TABLES[table]], "_errors", F.when(F.size("_errors") > 0, F.to_json("_row")).alias("_raw"))


QUARANTINE = "table_name string, started timestamp_ntz, errors array<string>, raw_line string, load_id string"


def read_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """All quarantined rows; a quarantine that no load has put a row in yet is empty."""
    return spark.read.schema(QUARANTINE).parquet(folder)


def _rows_in(spark: SparkSession, folder: str) -> int:
    """Rows of a table's folder, from the footers of its files; 0 if there is none yet."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = files.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, "*.parquet"))
    return spark.read.parquet(folder).count() if found else 0


def bulk_load(raw: DataFrame, table: str, folder: str, quarantine: str, at: dt.datetime, mode: str = "append",
              max_errors: int | None = None, max_error_share: float = MAX_ERROR_SHARE) -> dict:
    """Load the good rows of ``raw``, quarantine the bad ones, and report the load.

    The report has table, rows_loaded, rows_rejected, rows_before, rows_after and seconds. The input is read and parsed
    once. Nothing is loaded if more than ``max_errors`` rows (if given) or more than ``max_error_share`` of them are
    bad. The quarantine keeps a folder per load, named by table and start, so that a repeated load replaces its rows.
    """
    began = time.monotonic()
    prepared = cut_lineage(prepare_load(raw, table))
    counts = prepared.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.size("_errors") > 0).alias("bad")).first()
    bad = prepared.filter(F.size("_errors") > 0).select(
        F.lit(table).alias("table_name"), F.lit(at).cast("timestamp_ntz").alias("started"), F.col("_errors").alias("errors"),
        F.col("_raw").alias("raw_line"), F.lit(f"{table}-{at:%Y%m%dT%H%M%S%f}").alias("load_id"),
    )
    bad.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load_id").parquet(quarantine)
    most = max_error_share * counts.rows if max_errors is None else max_errors
    if counts.bad > most:
        raise RuntimeError(f"{counts.bad} bad rows in the load of {table}, more than {most:g}")
    rows_before = _rows_in(raw.sparkSession, folder)
    good = prepared.filter(F.size("_errors") == 0).drop("_errors", "_raw")
    good.write.mode(mode).parquet(folder)
    return {
        "table": table, "rows_loaded": counts.rows - counts.bad, "rows_rejected": counts.bad, "rows_before": rows_before,
        "rows_after": _rows_in(raw.sparkSession, folder), "seconds": time.monotonic() - began,
    }


def column_statistics(df: DataFrame) -> DataFrame:
    """A row per column: column, position, rows, nulls, lowest and highest value as text; one pass over the table."""
    measured = df.agg(F.count(F.lit(1)).alias("_rows"), *[
        F.struct(
            F.lit(f.name).alias("column"), F.lit(i).alias("position"), F.count_if(F.col(f"`{f.name}`").isNull()).alias("nulls"),
            F.min(F.col(f"`{f.name}`")).cast("string").alias("lowest"), F.max(F.col(f"`{f.name}`")).cast("string").alias("highest"),
        ).alias(f"_{i}")
        for i, f in enumerate(df.schema.fields) if not isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType))
    ])
    each = F.array(*[c for c in measured.columns if c != "_rows"])
    return measured.select(F.col("_rows").alias("rows"), F.inline(each)).select(
        "column", "position", "rows", "nulls", "lowest", "highest"
    )


def load_csv(spark: SparkSession, path: str, table: str, columns: Sequence[str] | None = None, delimiter: str = ",",
             header: bool = True) -> DataFrame:
    """Raw rows of CSV files for a table, by header or by the given column list."""
    names = list(columns or TABLES[table])
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.read.schema(schema).option("sep", delimiter).option("header", header).option("enforceSchema", True).csv(path)


def read_manifest(spark: SparkSession, manifest: str, schema: str) -> DataFrame:
    """Rows of the JSON files a manifest lists."""
    entries = spark.read.schema("entries array<struct<url: string, mandatory: boolean>>").option("multiLine", True).json(manifest)
    # a manifest is a list of file names, like the file listing of any other read
    files = [r["url"] for r in entries.select(F.explode("entries.url").alias("url")).collect()]
    return spark.read.schema(schema).json(files)


def upsert(target: DataFrame, staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target without the keys that were staged, and all staged rows."""
    kept = target.join(staged.select(*keys).distinct(), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(staged.select(*target.columns))


def write_version(df: DataFrame, folder: str, version: str) -> str:
    """A new version of a table beside the old one, so that readers never see half of it."""
    path = f"{folder}/version={version}"
    df.write.mode("overwrite").parquet(path)
    return path


def recent_load_errors(quarantine: DataFrame, at: dt.datetime, minutes: int = 10, limit: int = 10) -> DataFrame:
    since = F.lit(at - dt.timedelta(minutes=minutes)).cast("timestamp_ntz")
    return quarantine.filter(F.col("started") >= since).orderBy(F.desc("started"), "raw_line").limit(limit)


def warehouse_status(tables: Mapping[str, DataFrame], stamps: Mapping[str, str]) -> DataFrame:
    """Rows per table, and for snapshot tables the newest calculation and its number of rows."""
    status = None
    for name, df in tables.items():
        if name in stamps:
            per_date = df.groupBy(F.col(stamps[name]).cast("date").alias("d")).agg(F.count(F.lit(1)).alias("n"))
            one = per_date.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"), F.max("d").alias("latest"), F.max_by("n", "d").alias("latest_rows")
            )
        else:
            one = df.agg(F.count(F.lit(1)).alias("total_rows")).select(
                "total_rows", F.lit(None).cast("date").alias("latest"), F.lit(None).cast("bigint").alias("latest_rows")
            )
        one = one.select(F.lit(name).alias("table_name"), "*")
        status = one if status is None else status.unionByName(one)
    return status


def archive(records: DataFrame, folder: str, when: str) -> None:
    """Raw records by source, type and day."""
    stamp = F.col(when)
    records.withColumns({
        "year": F.date_format(stamp, "yyyy"), "month": F.date_format(stamp, "MM"), "day": F.date_format(stamp, "dd"),
    }).write.mode("append").partitionBy("source", "data_type", "year", "month", "day").json(folder)


def flatten_lists(df: DataFrame) -> DataFrame:
    """Lists joined by pipes and maps as key:value pairs joined by pipes, for CSV files."""
    columns = []
    for field in df.schema.fields:
        col = F.col(field.name)
        if isinstance(field.dataType, T.ArrayType):
            col = F.array_join(col, "|")
        elif isinstance(field.dataType, T.MapType):
            col = F.array_join(F.transform(F.map_entries(col), lambda e: F.concat_ws(":", e["key"], e["value"])), "|")
        columns.append(col.alias(field.name))
    return df.select(*columns)


def export_csv(df: DataFrame, folder: str) -> None:
    flatten_lists(df).write.mode("overwrite").option("header", True).csv(folder)


def export_json(df: DataFrame, folder: str) -> None:
    df.write.mode("overwrite").json(folder)


def export_training_file(rows: DataFrame, folder: str) -> None:
    """Target first, no header."""
    rows.write.mode("overwrite").option("header", False).csv(folder)
