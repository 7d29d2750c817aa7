"""Record validation: named violations per row, split into valid and invalid rows, counts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.functions.numbers import share
from encore.functions.times import as_date

# fixed values: allowed words
VENUE_TYPES = ("arena", "stadium", "theater", "club", "amphitheater", "hall", "other")
STATUSES = ("scheduled", "completed", "cancelled", "postponed")
TIERS = ("general", "premium", "vip", "early_bird", "student", "standing", "seated")
PAYMENTS = ("credit_card", "debit_card", "paypal", "apple_pay", "google_pay", "cash", "other")


class _Row:
    """Typed access to the columns of a table, with null for columns it lacks."""

    def __init__(self, df: DataFrame):
        self.types = {f.name: f.dataType for f in df.schema.fields}

    def text(self, name: str) -> Column:
        return F.col(name).cast("string") if name in self.types else F.lit(None).cast("string")

    def number(self, name: str, kind: str = "double") -> Column:
        if name not in self.types:
            return F.lit(None).cast(kind)
        return F.col(name).try_cast(kind)

    def unreadable(self, name: str, value: Column) -> Column:
        """There, but not of the wanted type."""
        return self.text(name).isNotNull() & value.isNull()

    def when(self, name: str) -> Column:
        if name not in self.types:
            return F.lit(None).cast("timestamp_ntz")
        if isinstance(self.types[name], T.StringType):
            return F.try_to_timestamp(F.col(name)).cast("timestamp_ntz")
        return F.col(name).cast("timestamp_ntz")


def _blank(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "")


def _longer(text: Column, size: int) -> Column:
    return F.length(text) > size


def artist_violations(df: DataFrame) -> dict[str, Column]:
    row = _Row(df)
    name, score = row.text("name"), row.number("popularity_score")
    day = row.text("formation_date")
    return {
        "artist_id missing": row.text("artist_id").isNull(),
        "name empty": _blank(name),
        "name too long": _longer(name, 200),
        "popularity_score not a number": row.unreadable("popularity_score", score),
        "popularity_score out of range": ~score.between(0, 100),
        "formation_date not a date": day.isNotNull() & F.try_to_date(day).isNull(),
    }


def venue_violations(df: DataFrame) -> dict[str, Column]:
    row = _Row(df)
    capacity = row.number("capacity", "int")
    kind = F.lower(row.text("venue_type"))
    country = row.text("country")
    return {
        "venue_id missing": row.text("venue_id").isNull(),
        "name empty": _blank(row.text("name")),
        "name too long": _longer(row.text("name"), 200),
        "city empty": _blank(row.text("city")),
        "city too long": _longer(row.text("city"), 100),
        "state too long": _longer(row.text("state"), 50),
        "country empty": _blank(country),
        "country length": ~F.length(country).between(2, 100),
        "capacity missing": capacity.isNull(),
        "capacity not positive": capacity <= 0,
        "capacity too large": capacity > 200000,
        "venue_type unknown": kind.isNull() | ~kind.isin(*VENUE_TYPES),
        "address too long": _longer(row.text("address"), 300),
        "postal_code too long": _longer(row.text("postal_code"), 20),
    }


def concert_violations(df: DataFrame, as_of: str) -> dict[str, Column]:
    row = _Row(df)
    year = as_date(as_of).year
    when = row.when("event_date")
    attendance, revenue = row.number("total_attendance", "int"), row.number("revenue")
    prices = F.map_values("ticket_prices") if "ticket_prices" in row.types else F.lit(None).cast("array<double>")
    status = F.lower(row.text("status"))
    return {
        "concert_id missing": row.text("concert_id").isNull(),
        "artist_id missing": row.text("artist_id").isNull(),
        "venue_id missing": row.text("venue_id").isNull(),
        "event_date missing": when.isNull(),
        "event_date too far in the past": F.year(when) < year - 50,
        "event_date too far in the future": F.year(when) > year + 5,
        "ticket price invalid": F.exists(prices, lambda p: p.isNull() | (p < 0)),
        "ticket price too high": F.exists(prices, lambda p: p > 10000),
        "total_attendance not a number": row.unreadable("total_attendance", attendance),
        "total_attendance negative": attendance < 0,
        "total_attendance too large": attendance > 500000,
        "revenue not a number": row.unreadable("revenue", revenue),
        "revenue negative": revenue < 0,
        "status unknown": ~status.isin(*STATUSES),
    }


def sale_violations(df: DataFrame, as_of: str) -> dict[str, Column]:
    row = _Row(df)
    quantity = row.number("quantity", "int")
    unit, total = row.number("unit_price"), row.number("total_price")
    when = row.when("purchase_timestamp")
    tier, payment = F.lower(row.text("ticket_tier")), F.lower(row.text("payment_method"))
    now = F.lit(dt.datetime.combine(as_date(as_of), dt.time())).cast("timestamp_ntz")
    return {
        "sale_id missing": row.text("sale_id").isNull(),
        "concert_id missing": row.text("concert_id").isNull(),
        "customer_id missing": row.text("customer_id").isNull(),
        "ticket_tier unknown": tier.isNull() | ~tier.isin(*TIERS),
        "quantity out of range": quantity.isNull() | ~quantity.between(1, 20),
        "unit_price out of range": unit.isNull() | (unit <= 0) | (unit > 10000),
        "total_price out of range": total.isNull() | (total <= 0) | (total > 10000),
        "total_price does not match": F.abs(total - quantity * unit) > 0.01,
        "purchase_timestamp missing": when.isNull(),
        "purchase_timestamp in the future": when > now,
        "payment_method unknown": (payment != "") & ~payment.isin(*PAYMENTS),
    }


def violations(df: DataFrame, data_type: str, as_of: str) -> dict[str, Column]:
    if data_type == "artists":
        return artist_violations(df)
    if data_type == "venues":
        return venue_violations(df)
    if data_type == "concerts":
        return concert_violations(df, as_of)
    if data_type == "ticket_sales":
        return sale_violations(df, as_of)
    raise ValueError(f"no validation for data type {data_type}")


def lift_location(df: DataFrame) -> DataFrame:
    """Flat place columns from a nested ``location``, where the flat ones are missing."""
    if "location" not in df.columns:
        return df
    inner = df.schema["location"].dataType
    if not isinstance(inner, T.StructType):
        return df
    return df.withColumns({n: F.col(f"location.{n}") for n in inner.fieldNames() if n not in df.columns})


def _cleaned(df: DataFrame, data_type: str) -> DataFrame:
    """The tidy values of valid rows: trimmed texts, lower case words, blanks dropped from lists."""
    def words(name: str) -> Column:
        return F.filter(F.transform(name, lambda x: F.lower(F.trim(x))), lambda x: x != "")

    changes: dict[str, Column] = {}
    types = {f.name: f.dataType for f in df.schema.fields}
    for name in ("name", "city", "country", "state", "address", "postal_code"):
        if data_type in ("artists", "venues") and isinstance(types.get(name), T.StringType):
            changes[name] = F.trim(name)
    for name in ("venue_type", "status", "ticket_tier", "payment_method"):
        if isinstance(types.get(name), T.StringType):
            changes[name] = F.lower(name)
    if isinstance(types.get("genre"), T.ArrayType):
        changes["genre"] = words("genre")
    if isinstance(types.get("members"), T.ArrayType):
        changes["members"] = F.filter(F.transform("members", lambda x: F.trim(x)), lambda x: x != "")
    if data_type == "artists" and "popularity_score" in types:
        changes["popularity_score"] = F.coalesce("popularity_score", F.lit(0).cast(types["popularity_score"]))
    if data_type == "concerts" and "status" in types:
        changes["status"] = F.coalesce(F.lower("status"), F.lit("scheduled"))
    return df.withColumns(changes) if changes else df


def mark(df: DataFrame, data_type: str, as_of: str) -> DataFrame:
    """Add ``errors``: the names of the violated rules in rule order."""
    df = lift_location(df)
    # lists put together instead of one list filtered by a function, which Spark would not compile
    none = F.array().cast("array<string>")
    named = [F.when(c, F.array(F.lit(n))).otherwise(none) for n, c in violations(df, data_type, as_of).items()]
    return df.withColumn("errors", F.concat(*named))


def split(df: DataFrame, data_type: str, as_of: str) -> tuple[DataFrame, DataFrame]:
    """Valid rows with tidy values, and invalid rows with their errors."""
    marked = mark(df, data_type, as_of)
    valid = marked.filter(F.size("errors") == 0).drop("errors")
    return _cleaned(valid, data_type), marked.filter(F.size("errors") > 0)


def _counts() -> list[Column]:
    bad = F.size("errors") > 0
    return [
        F.count(F.lit(1)).alias("records_processed"),
        F.count_if(~bad).alias("records_successful"),
        F.count_if(bad).alias("records_failed"),
    ]


def upload_report(marked: DataFrame, by: str | None = None) -> DataFrame:
    """Processed, successful and failed counts with the validation rate, per file if ``by`` names it."""
    counted = (marked.groupBy(by) if by else marked.groupBy()).agg(*_counts())
    return counted.withColumns({
        "validation_rate": F.coalesce(
            share(F.col("records_successful"), F.col("records_processed")), F.lit(0.0)
        ),
        "success": F.col("records_failed") == 0,
    })


def error_counts(marked: DataFrame) -> DataFrame:
    return marked.select(F.explode("errors").alias("error")).groupBy("error").agg(F.count(F.lit(1)).alias("rows"))


def report_types(tables: Mapping[str, DataFrame], as_of: str) -> DataFrame:
    """One upload report row per data type."""
    report = None
    for data_type, df in tables.items():
        one = upload_report(mark(df, data_type, as_of)).select(F.lit(data_type).alias("data_type"), "*")
        report = one if report is None else report.unionByName(one)
    return report
