"""Stream records: envelope, parsing of the accepted layouts, payload processing per type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: data types and the table each one belongs to
ROUTES = {
    "artists": "artists", "venues": "venues", "concerts": "concerts", "events": "concerts",
    "ticket_sales": "ticket_sales",
}
REQUIRED = ("source", "data_type", "ingestion_timestamp", "payload")
WIRE = (
    "timestamp string, data string, record_id string, source string, data_type string, ingestion_timestamp string, "
    "payload string"
)


def record_id(source: Column, data_type: Column, when: Column, payload: Column) -> Column:
    """Source, type and microsecond, and a digest of the payload, as many records can carry one stamp."""
    stamp = F.unix_micros(when.cast("timestamp")).cast("string")
    return F.concat_ws("_", source, data_type, stamp, F.substring(F.md5(payload.cast("binary")), 1, 16))


def partition_key(data_type: Column, payload: Column) -> Column:
    """Key that keeps the records of one entity together; sales go by their concert."""
    def of(prefix: str, *fields: str) -> Column:
        ids = [F.get_json_object(payload, f"$.{f}") for f in fields]
        return F.concat(F.lit(prefix), F.coalesce(*ids, F.lit("unknown")))

    return (
        F.when(data_type == "artists", of("artist_", "artist_id"))
        .when(data_type == "venues", of("venue_", "venue_id"))
        .when(data_type.isin("concerts", "events"), of("concert_", "concert_id", "event_id"))
        .when(data_type == "ticket_sales", of("ticket_", "concert_id"))
        .otherwise(F.concat(data_type, F.lit("_unknown")))
    )


def envelopes(rows: DataFrame, data_type: str, source: str, when: Column) -> DataFrame:
    """Rows as (key, value): the envelope JSON around each row, and its partition key."""
    payload = F.to_json(F.struct("*"))
    packed = rows.select(payload.alias("payload"), when.alias("stamp"))
    body = F.struct(
        record_id(F.lit(source), F.lit(data_type), F.col("stamp"), F.col("payload")).alias("record_id"),
        F.lit(source).alias("source"),
        F.lit(data_type).alias("data_type"),
        F.date_format("stamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ingestion_timestamp"),
    )
    # the payload stays the JSON object it is
    value = F.concat(
        F.regexp_replace(F.to_json(body), r"\}$", ""), F.lit(',"payload":'), F.col("payload"), F.lit("}")
    )
    return packed.select(partition_key(F.lit(data_type), F.col("payload")).alias("key"), value.alias("value"))


def parse(raw: DataFrame, value: str = "value") -> DataFrame:
    """Add the envelope fields and ``problem`` (null if the record is fine).

    Accepted layouts: the bare envelope, an envelope wrapped as {timestamp, data}, and a flat record
    that carries its own source, data_type and ingestion_timestamp beside its fields.
    """
    def opened(df: DataFrame, text: Column, prefix: str) -> DataFrame:
        # a generator computes the fields once per row; a later filter cannot copy the parsing into itself
        names = [f"{prefix}{field.split()[0]}" for field in WIRE.split(", ")]
        return df.select("*", F.inline(F.array(F.from_json(text, WIRE))).alias(*names))

    text = F.col(value).cast("string")
    outer = opened(raw, text, "_outer_").withColumn("_text", F.coalesce("_outer_data", text))
    inner = opened(outer, F.col("_text"), "_inner_")
    flat = F.col("_inner_payload").isNull() & F.col("_inner_data_type").isNotNull()
    out = inner.select(
        *raw.columns,
        *[F.col(f"_inner_{f}").alias(f) for f in ("record_id", "source", "data_type", "ingestion_timestamp")],
        F.when(flat, F.col("_text")).otherwise(F.col("_inner_payload")).alias("payload"),
    )
    missing = [F.when(F.col(f).isNull(), F.lit(f"missing {f}")) for f in REQUIRED]
    unreadable = F.when(F.coalesce(*[F.col(f) for f in REQUIRED]).isNull(), "not a record")
    unknown = F.when(~F.col("data_type").isin(*ROUTES), "unknown data type")
    return out.withColumn("problem", F.coalesce(unreadable, *missing, unknown))


def decode(raw: DataFrame, column: str = "data") -> DataFrame:
    """Text of base64 records as ``value``."""
    return raw.withColumn("value", F.decode(F.unbase64(column), "UTF-8"))


def _opened(records: DataFrame) -> DataFrame:
    """The payload as a map of texts, parsed once; nested values stay JSON text."""
    return records.select("*", F.explode(F.array(F.from_json("payload", "map<string,string>"))).alias("_p")).withColumn(
        "_place", F.from_json(F.col("_p")["location"], "map<string,string>")
    )


def _field(name: str, kind: str = "string", column: str = "_p") -> Column:
    value = F.col(column)[name]
    return value if kind == "string" else value.try_cast(kind)


def _list(name: str) -> Column:
    """A list field; a scalar becomes a list of one."""
    text = _field(name)
    return F.when(text.isNull(), F.array().cast("array<string>")).when(
        text.startswith("["), F.from_json(text, "array<string>")
    ).otherwise(F.array(text))


def _stamped(records: DataFrame, **columns: Column) -> DataFrame:
    return _opened(records).select(*[c.alias(n) for n, c in columns.items()], "source", "ingestion_timestamp")


def process_artists(records: DataFrame) -> DataFrame:
    return _stamped(
        records,
        artist_id=_field("artist_id"),
        name=F.trim(F.coalesce(_field("name"), F.lit(""))),
        genres=_list("genre"),
        popularity_score=F.coalesce(_field("popularity_score", "double"), F.lit(0.0)),
        formation_date=_field("formation_date"),
        members=_list("members"),
        spotify_id=_field("spotify_id"),
        followers=F.coalesce(_field("followers", "bigint"), F.lit(0).cast("bigint")),
    )


def process_venues(records: DataFrame) -> DataFrame:
    texts = [
        F.coalesce(_field(n, column="_place"), F.lit("")).alias(n)
        for n in ("address", "city", "state", "country", "postal_code")
    ]
    point = [_field(n, "double", "_place").alias(n) for n in ("latitude", "longitude")]
    return _stamped(
        records,
        venue_id=_field("venue_id"),
        name=F.trim(F.coalesce(_field("name"), F.lit(""))),
        location=F.struct(*texts, *point),
        capacity=F.nullif(_field("capacity", "int"), F.lit(0)),
        venue_type=F.coalesce(_field("venue_type"), F.lit("")),
        amenities=_list("amenities"),
        ticketmaster_id=_field("ticketmaster_id"),
    )


def process_concerts(records: DataFrame) -> DataFrame:
    no_prices = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<double>"))
    return _stamped(
        records,
        concert_id=F.coalesce(F.nullif(_field("concert_id"), F.lit("")), _field("event_id")),
        artist_id=_field("artist_id"),
        venue_id=_field("venue_id"),
        event_date=_field("event_date"),
        event_time=_field("event_time"),
        ticket_prices=F.coalesce(F.from_json(_field("ticket_prices"), "map<string,double>"), no_prices),
        total_attendance=_field("total_attendance", "int"),
        revenue=_field("revenue", "double"),
        status=F.coalesce(_field("status"), F.lit("scheduled")),
        genre=F.coalesce(_field("genre"), F.lit("")),
        description=F.coalesce(_field("description"), F.lit("")),
    )


def process_sales(records: DataFrame) -> DataFrame:
    return _stamped(
        records,
        sale_id=_field("sale_id"),
        concert_id=_field("concert_id"),
        price_tier=F.coalesce(_field("price_tier"), F.lit("")),
        quantity=F.coalesce(_field("quantity", "int"), F.lit(1)),
        unit_price=F.coalesce(_field("unit_price", "double"), F.lit(0.0)),
        total_price=F.coalesce(_field("total_price", "double"), F.lit(0.0)),
        purchase_timestamp=_field("purchase_timestamp"),
        customer_segment=F.coalesce(_field("customer_segment"), F.lit("")),
        payment_method=F.coalesce(_field("payment_method"), F.lit("")),
    )


PROCESSORS = {
    "artists": process_artists, "venues": process_venues, "concerts": process_concerts, "ticket_sales": process_sales,
}
