"""File scans: CSV, JSON, XML and mixed folders, pre-checks, per-file reports, incremental input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.operators.validate import mark, upload_report
from encore.schemas import RECORDS

# fixed values: formats, delimiters, wrapper fields and record tags, in the order they are tried
FORMATS = ("csv", "json", "xml")
DELIMITERS = (",", ";", "\t", "|")
WRAPPERS = ("data", "records", "items")
RECORD_TAGS = ("record", "item", "row", "entry", "artist", "venue", "concert", "ticket_sale")
CORRUPT = "_corrupt_record"


def _paths(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def check_files(spark: SparkSession, paths: str | Sequence[str], data_type: str, max_bytes: int | None = None) -> DataFrame:
    """(path, length, problem) per file, from the file listing; contents are not read. Any size is fine by default."""
    if data_type not in RECORDS:
        raise ValueError(f"unsupported data type {data_type}")
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(_paths(paths)).select("path", "length")
    ending = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    return listed.withColumn(
        "problem",
        F.when(F.col("length") > F.lit(max_bytes), "file too large").when(~ending.isin(*FORMATS), "unsupported format"),
    )


def number_rows(df: DataFrame, first: int) -> DataFrame:
    """Add ``_source_row``: the row number within the file, from ``first`` on.

    A task reads a stretch of a file from top to bottom, so the stretch's rows have consecutive ids. The stretches of
    a file (``_block``, where the input has it) come in order: the rows of the earlier ones are added up, one number
    per stretch.
    """
    block = F.col("_block") if "_block" in df.columns else F.lit(0)
    numbered = df.withColumn("_id", F.monotonically_increasing_id()).withColumn("_block", block)
    inside = Window.partitionBy("_file").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    starts = numbered.groupBy(F.col("_source_file").alias("_file"), F.col("_block").alias("_at")).agg(
        F.min("_id").alias("_start"), F.count(F.lit(1)).alias("_rows")
    ).select("_file", "_at", "_start", F.coalesce(F.sum("_rows").over(inside), F.lit(0)).alias("_before"))
    return numbered.join(
        starts, (F.col("_source_file") == F.col("_file")) & (F.col("_block") == F.col("_at"))
    ).withColumn("_source_row", F.col("_id") - F.col("_start") + F.col("_before") + first).drop(
        "_id", "_block", "_file", "_at", "_start", "_before"
    )


def _lines(spark: SparkSession, paths: str | Sequence[str], options: dict | None = None) -> DataFrame:
    """(value, path, _block, _id): the lines that are not blank, with the stretch of the file they lie in."""
    return spark.read.options(**(options or {})).text(_paths(paths)).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_block")
    ).withColumn("_id", F.monotonically_increasing_id()).filter(F.trim("value") != "")


def _heads(lines: DataFrame) -> DataFrame:
    """(path, head, lines): the first line that is not blank and the number of such lines, per file."""
    return lines.groupBy("path").agg(
        F.min_by("value", F.struct("_block", "_id")).alias("head"), F.count(F.lit(1)).alias("lines")
    )


def header_groups(
    spark: SparkSession, paths: str | Sequence[str], delimiter: str | None = None, options: dict | None = None
) -> list[tuple[str, str, list[str]]]:
    """(delimiter, header line, files) for every layout among CSV files.

    Each file's delimiter is the one that occurs most often in its first line. One pass finds all first lines; what
    comes back is the file listing, which the driver holds for any scan, in groups.
    """
    counts = [F.length("head") - F.length(F.translate("head", d, "")) for d in DELIMITERS]
    most = F.greatest(*counts)
    found = F.coalesce(*[F.when(n == most, F.lit(d)) for n, d in zip(counts, DELIMITERS)])
    heads = _heads(_lines(spark, paths, options)).withColumn("sep", F.lit(delimiter) if delimiter else found)
    rows = heads.groupBy("sep", "head").agg(F.sort_array(F.collect_list("path")).alias("files")).collect()
    return sorted((r.sep, r.head, list(r.files)) for r in rows)


def _read_layout(spark: SparkSession, sep: str, files: list[str], rows: bool) -> DataFrame:
    """Files of one delimiter and one header."""
    options = {"header": True, "sep": sep, "multiLine": True, "escape": '"'}
    names = spark.read.options(**options).csv(files[:1]).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
    raw = spark.read.options(
        **options, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, enforceSchema=True
    ).schema(schema).csv(files)
    raw = raw.select("*", F.col("_metadata.file_path").alias("_source_file"))
    if rows:
        raw = number_rows(raw, first=2)
    keep = [c for c in (CORRUPT, "_source_file", "_source_row") if c in raw.columns]
    cells = [F.nullif(F.trim(F.col(f"`{n}`")), F.lit("")).alias(n.strip()) for n in names if n.strip()]
    out = raw.select(*cells, *keep)
    return out.filter(F.coalesce(*[F.col(f"`{n.strip()}`") for n in names if n.strip()]).isNotNull())


def read_csv(
    spark: SparkSession, paths: str | Sequence[str], delimiter: str | None = None, rows: bool = False,
    options: dict | None = None,
) -> DataFrame:
    """All columns as trimmed text, blanks as null, blank rows dropped; malformed rows keep their text
    in ``_corrupt_record``. Each file is read by its own delimiter and header, and the files' columns meet by name.
    A quoted value may span lines, so one task reads one file."""
    out = None
    for sep, _, files in header_groups(spark, paths, delimiter, options):
        one = _read_layout(spark, sep, files, rows)
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    if out is None:
        empty = f"{CORRUPT} string, _source_file string" + (", _source_row bigint" if rows else "")
        return spark.createDataFrame([], empty)
    names = [c for c in out.columns if not c.startswith("_")]
    return out.select(*[F.col(f"`{n}`") for n in names], *[c for c in out.columns if c.startswith("_")])


def typed_records(csv: DataFrame, data_type: str, list_separator: str = ",") -> DataFrame:
    """CSV text as records of a type: lists split, maps from ``key:value`` pairs, numbers cast where they can be."""
    wanted = T.StructType.fromDDL(RECORDS[data_type])
    columns = []
    for field in wanted.fields:
        if field.name not in csv.columns:
            continue
        text = F.col(field.name)
        if isinstance(field.dataType, T.ArrayType):
            parts = F.split(text, f"[{list_separator}]")
            text = F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")
        elif isinstance(field.dataType, T.MapType):
            pairs = F.transform(F.split(text, "[|]"), lambda p: F.split(p, ":"))
            text = F.map_from_entries(F.transform(pairs, lambda p: F.struct(
                F.trim(F.get(p, F.lit(0))).alias("k"), F.get(p, F.lit(1)).try_cast("double").alias("v"))))
        columns.append(text.alias(field.name))
    return csv.select(*columns, *[c for c in csv.columns if c.startswith("_")])


def _line_files(spark: SparkSession, paths: str | Sequence[str], options: dict | None) -> DataFrame:
    """The files with one object per line: the first line is a whole object and others follow it."""
    heads = _heads(_lines(spark, paths, options))
    whole = F.trim("head").startswith("{") & F.get_json_object("head", "$").isNotNull()
    return heads.filter(whole & (F.col("lines") > 1)).select(F.col("path").alias("_line_file"))


def read_json(
    spark: SparkSession, paths: str | Sequence[str], schema: str, rows: bool = False, options: dict | None = None
) -> DataFrame:
    """Records of files that hold an array, an object with a data, records or items array, one object, or one object
    per line; each file is read by its own layout, and what cannot be read stays as a row with ``_corrupt_record``."""
    record = T.StructType.fromDDL(schema)
    wrapped = T.StructType([T.StructField(w, T.ArrayType(record)) for w in WRAPPERS if w not in record.fieldNames()])
    full = T.StructType([*record.fields, *wrapped.fields, T.StructField(CORRUPT, T.StringType())])
    by_line = _line_files(spark, paths, options)
    raw = spark.read.options(**(options or {})).schema(full).option("multiLine", True).option(
        "columnNameOfCorruptRecord", CORRUPT
    ).json(_paths(paths))
    raw = raw.select("*", F.col("_metadata.file_path").alias("_source_file")).join(
        by_line, F.col("_source_file") == F.col("_line_file"), "left_anti"
    )
    own = F.array(F.struct(*[F.col(f"`{n}`") for n in record.fieldNames()]))
    inside = F.coalesce(*[F.col(w) for w in wrapped.fieldNames()], own)
    out = raw.select("_source_file", CORRUPT, F.explode(inside).alias("r")).select("r.*", "_source_file", CORRUPT)

    single = T.StructType([*record.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json("value", single, {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"})
    lines = _lines(spark, paths, options).withColumnRenamed("path", "_source_file")
    if rows:
        out = number_rows(out, first=1)
        lines = number_rows(lines.drop("_id"), first=1)
    lines = lines.join(by_line, F.col("_source_file") == F.col("_line_file"), "left_semi")
    kept = [c for c in ("_source_file", "_source_row") if c in lines.columns]
    lines = lines.select(parsed.alias("r"), *kept).select("r.*", *kept)
    return out.unionByName(lines)


def record_tags(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(path, tag): the first known record tag in each file, else the tag below the root; read line by line.

    Lines are only counted, never sorted or moved: one pass finds the known tags. Files without any are read again, first
    for where their first two lines with a tag stand, then for these lines. The driver holds one row per file, or per
    stretch of a file without a known tag.
    """
    has = {t: F.col("value").contains(f"<{t}") & F.col("value").rlike(rf"<{t}([\s/>]|$)") for t in RECORD_TAGS}
    seen = _lines(spark, paths).groupBy("path").agg(
        F.max(F.col("value").rlike(_TAG)).alias("tagged"), *[F.max(c).alias(t) for t, c in has.items()]
    ).filter("tagged").collect()
    found = [(r["path"], next((t for t in RECORD_TAGS if r[t]), None)) for r in seen]
    other = sorted(path for path, tag in found if tag is None)
    out = [x for x in found if x[1] is not None] + (_tags_below_root(spark, other) if other else [])
    return spark.createDataFrame(out, "path string, tag string")


_TAG = r"<([A-Za-z_][\w.-]*)"


def _tags_below_root(spark: SparkSession, files: list[str]) -> list[tuple[str, str | None]]:
    """The second tag of the first line with one, else the first tag of the next such line."""
    lines = _lines(spark, files).filter(F.col("value").rlike(_TAG))

    def starts(some: DataFrame) -> dict[str, tuple[int, int]]:
        # the first line of every stretch, in numbers that a hash aggregation can hold
        rows = some.groupBy("path", "_block").agg(F.min("_id").alias("_id")).collect()
        return {p: min((r["_block"], r["_id"]) for r in rows if r["path"] == p) for p in {r["path"] for r in rows}}

    first = starts(lines)
    after = spark.createDataFrame([(p, *at) for p, at in first.items()], "path string, _first_block long, _first_id long")
    later = F.struct("_block", "_id") > F.struct("_first_block", "_first_id")
    second = starts(lines.join(F.broadcast(after), "path").filter(later))
    wanted = spark.createDataFrame(
        [(p, *at, n) for n, places in enumerate((first, second)) for p, at in places.items()], "path string, _block long, _id long, nth int")
    tags = {(r["path"], r["nth"]): r["tags"] for r in lines.join(F.broadcast(wanted), ["path", "_block", "_id"]).select(
        "path", "nth", F.slice(F.regexp_extract_all("value", F.lit(_TAG), F.lit(1)), 1, 2).alias("tags")).collect()}
    return [(p, tags[p, 0][1] if len(tags[p, 0]) > 1 else tags[p, 1][0] if (p, 1) in tags else None) for p in first]


def read_xml(spark: SparkSession, paths: str | Sequence[str], schema: str, tag: str | None = None, rows: bool = False) -> DataFrame:
    """Records of XML files; attributes count as fields. Without ``tag`` each file's own is found first."""
    if tag is None:
        groups: dict[str, list[str]] = {}
        # one short row per file, as in the file listing itself
        for found in record_tags(spark, paths).collect():
            if found["tag"]:
                groups.setdefault(found["tag"], []).append(found["path"])
    else:
        groups = {tag: _paths(paths)}
    record = T.StructType.fromDDL(schema)
    wanted = T.StructType([*record.fields, T.StructField(CORRUPT, T.StringType())])
    out = None
    for name, files in groups.items():
        one = spark.read.format("xml").option("rowTag", name).option("attributePrefix", "").option(
            "columnNameOfCorruptRecord", CORRUPT
        ).option("ignoreNamespace", True).schema(wanted).load(files)
        one = one.select("*", F.col("_metadata.file_path").alias("_source_file"))
        out = one if out is None else out.unionByName(one)
    if out is None:
        out = spark.createDataFrame([], wanted).withColumn("_source_file", F.lit(""))
    return number_rows(out, first=1) if rows else out


def read_mixed(spark: SparkSession, folder: str, schema: str, problems: bool = False) -> DataFrame:
    """All JSON, Parquet and CSV files below a folder, each by its own layout, columns matched by name.

    Rows that cannot be read are left out; with ``problems`` they are what is returned, as (path, text), and nothing
    is left out unseen but Parquet files that are none. Lists and maps are not looked for in CSV files.
    """
    record = T.StructType.fromDDL(schema)
    reader = {"recursiveFileLookup": "true"}
    nested = (T.ArrayType, T.MapType, T.StructType)
    json = read_json(spark, folder, schema, options={**reader, "pathGlobFilter": "*.json"})
    csv = read_csv(spark, folder, options={**reader, "pathGlobFilter": "*.csv"})
    if problems:
        parts = [part.filter(F.col(CORRUPT).isNotNull()).select(
            F.col("_source_file").alias("path"), F.col(CORRUPT).alias("text")) for part in (json, csv)]
        return parts[0].unionByName(parts[1])
    flat = [
        F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in record.fields
        if f.name in csv.columns and not isinstance(f.dataType, nested)
    ]
    parquet = spark.read.options(**reader, pathGlobFilter="*.parquet", ignoreCorruptFiles=True).schema(record).parquet(folder)
    out = json.filter(F.col(CORRUPT).isNull()).select(*record.fieldNames()).unionByName(parquet)
    if flat:
        out = out.unionByName(csv.filter(F.col(CORRUPT).isNull()).select(*flat), allowMissingColumns=True)
    return out


def read_records(spark: SparkSession, paths: str | Sequence[str], data_type: str, file_format: str, rows: bool = True) -> DataFrame:
    """Records of one type from one format, with ``_source_file`` and ``_source_row``."""
    if file_format == "csv":
        return typed_records(read_csv(spark, paths, rows=rows), data_type)
    if file_format == "json":
        return read_json(spark, paths, RECORDS[data_type], rows)
    if file_format == "xml":
        return read_xml(spark, paths, RECORDS[data_type], rows=rows)
    raise ValueError(f"unsupported format {file_format}")


def batch_report(records: DataFrame, data_type: str, as_of: str) -> DataFrame:
    """Counts per file of one scan over many files; a bad file shows up as failed and stops nothing."""
    marked = mark(records, data_type, as_of)
    if CORRUPT in marked.columns:
        broken = F.when(F.col(CORRUPT).isNotNull(), F.array(F.lit("unreadable record")))
        marked = marked.withColumn("errors", F.coalesce(broken, "errors"))
    name = F.substring_index("_source_file", "/", -1)
    return upload_report(marked.withColumn("file_name", name), by="file_name")


def crawl(spark: SparkSession, folder: str) -> DataFrame:
    """The Parquet files below a folder with their schemas merged, new columns included."""
    return spark.read.option("mergeSchema", True).parquet(folder)


def incremental(spark: SparkSession, folder: str, schema: str, target: str, checkpoint: str, file_format: str = "json") -> None:
    """Append the files not seen by an earlier call to ``target``; the checkpoint remembers them."""
    stream = spark.readStream.schema(schema).format(file_format).load(folder)
    stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(
        availableNow=True
    ).start().awaitTermination()
