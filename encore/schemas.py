"""Record schemas: files and API payloads, warehouse tables, stream payloads."""

from __future__ import annotations

# fixed values: field names and types of the records
ARTIST = (
    "artist_id string, name string, genre array<string>, popularity_score double, formation_date string, "
    "members array<string>, spotify_id string"
)
LOCATION = (
    "struct<address: string, city: string, state: string, country: string, postal_code: string, latitude: double, "
    "longitude: double>"
)
VENUE = (
    f"venue_id string, name string, location {LOCATION}, city string, state string, country string, capacity int, "
    "venue_type string, address string, postal_code string, amenities array<string>, ticketmaster_id string"
)
CONCERT = (
    "concert_id string, artist_id string, venue_id string, event_date string, ticket_prices map<string,double>, "
    "total_attendance int, revenue double, status string"
)
SALE = (
    "sale_id string, concert_id string, customer_id string, ticket_tier string, quantity int, unit_price double, "
    "total_price double, purchase_timestamp string, payment_method string"
)
RECORDS = {"artists": ARTIST, "venues": VENUE, "concerts": CONCERT, "ticket_sales": SALE}

# fixed values: warehouse columns, types and text widths
TABLES: dict[str, dict[str, str]] = {
    "artists": {
        "artist_id": "varchar(50)", "name": "varchar(200)", "genre": "varchar(500)", "popularity_score": "decimal(5,2)",
        "formation_date": "date", "members": "varchar(1000)", "spotify_id": "varchar(50)",
        "created_at": "timestamp", "updated_at": "timestamp",
    },
    "venues": {
        "venue_id": "varchar(50)", "name": "varchar(200)", "address": "varchar(500)", "city": "varchar(100)",
        "state": "varchar(50)", "country": "varchar(50)", "postal_code": "varchar(20)", "latitude": "decimal(10,8)",
        "longitude": "decimal(11,8)", "capacity": "int", "venue_type": "varchar(50)", "amenities": "varchar(1000)",
        "ticketmaster_id": "varchar(50)", "created_at": "timestamp", "updated_at": "timestamp",
    },
    "concerts": {
        "concert_id": "varchar(50)", "artist_id": "varchar(50)", "venue_id": "varchar(50)", "event_date": "timestamp",
        "ticket_prices": "varchar(2000)", "total_attendance": "int", "revenue": "decimal(12,2)", "status": "varchar(20)",
        "created_at": "timestamp", "updated_at": "timestamp",
    },
    "ticket_sales": {
        "sale_id": "varchar(50)", "concert_id": "varchar(50)", "price_tier": "varchar(50)", "quantity": "int",
        "unit_price": "decimal(8,2)", "total_amount": "decimal(10,2)", "purchase_timestamp": "timestamp",
        "customer_segment": "varchar(50)", "created_at": "timestamp", "updated_at": "timestamp",
    },
    "venue_popularity": {
        "venue_id": "varchar(50)", "popularity_rank": "int", "avg_attendance_rate": "decimal(5,2)",
        "revenue_per_event": "decimal(12,2)", "booking_frequency": "decimal(8,2)", "total_events": "int",
        "calculated_at": "date",
    },
    "artist_performance": {
        "artist_id": "varchar(50)", "total_concerts": "int", "avg_ticket_sales": "decimal(10,2)",
        "revenue_generated": "decimal(15,2)", "fan_engagement_score": "decimal(5,2)", "growth_trend": "varchar(20)",
        "calculated_at": "date",
    },
    "daily_sales_summary": {
        "summary_date": "date", "artist_id": "varchar(50)", "venue_id": "varchar(50)", "concert_id": "varchar(50)",
        "total_tickets_sold": "int", "total_revenue": "decimal(12,2)", "avg_ticket_price": "decimal(8,2)",
        "unique_customers": "int", "created_at": "timestamp",
    },
}
# the snapshots are replaced and pruned by date
PARTITIONS = {
    "venue_popularity": "calculated_at", "artist_performance": "calculated_at", "daily_sales_summary": "summary_date",
}
# columns that may not be missing in a bulk load
REQUIRED = {
    "artists": ("artist_id", "name"),
    "venues": ("venue_id", "name", "city", "capacity", "venue_type"),
    "concerts": ("concert_id", "artist_id", "venue_id", "event_date"),
    "ticket_sales": ("sale_id", "concert_id", "price_tier", "quantity", "unit_price", "total_amount", "purchase_timestamp"),
}
