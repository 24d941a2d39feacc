"""Explicit schemas of every table, as Spark DDL; nothing is inferred at read time."""

RAW_POSTS = "content STRING, tweetlinkid STRING, created_at DATE"

RAW_HISTORICAL = (
    "Date DATE, Time STRING, City STRING, Location STRING, Latitude DOUBLE, Longitude DOUBLE, "
    "High_Accuracy DOUBLE, Direction STRING, Type STRING, Lanes_Blocked INT, Involved STRING, "
    "Tweet STRING, Source STRING"
)

PARSED_COLUMNS = [
    "event_id", "date", "time", "event_timestamp", "location", "direction", "type",
    "lanes_blocked", "involved", "post", "link",
]

EVENT_COLUMNS = [
    "event_id", "date", "time", "event_timestamp", "location_id", "city", "location",
    "latitude", "longitude", "accuracy", "direction", "type", "lanes_blocked", "involved",
    "post", "link",
]

VEHICLE_COLUMNS = [
    "event_id", "vehicle_type", "vehicle_count", "vehicle_group", "suggested_from", "is_verified",
]

RESOLVED_LOCATIONS = (
    "city STRING, location STRING, latitude DOUBLE, longitude DOUBLE, accuracy DOUBLE"
)

# Warehouse tables: name -> (DDL, key columns).
TABLES = {
    "dim_locations": (
        "location_id STRING, city STRING, location STRING, latitude DOUBLE, longitude DOUBLE, "
        "accuracy DOUBLE",
        ["location_id"],
    ),
    "dim_direction": ("short_name STRING, full_name STRING", ["short_name"]),
    "dim_vehicles": (
        "vehicle_type STRING, vehicle_group STRING, suggested_from STRING, is_verified BOOLEAN",
        ["vehicle_type"],
    ),
    "fact_events": (
        "event_id STRING, event_timestamp TIMESTAMP_NTZ, location_id STRING, event_type STRING, "
        "event_type_details STRING, direction_id STRING, lanes_blocked INT, post STRING, "
        "link STRING",
        ["event_id"],
    ),
    "fact_event_vehicles": (
        "fev_id STRING, event_id STRING, vehicle_type STRING, vehicle_count INT",
        ["fev_id"],
    ),
}

# Tables kept in folders by event date; the folder column is not part of the table.
DATED_TABLES = ("fact_events", "fact_event_vehicles")
EVENT_DATE = "event_date"

# (child table, child column, parent table, parent column)
FOREIGN_KEYS = [
    ("fact_events", "location_id", "dim_locations", "location_id"),
    ("fact_events", "direction_id", "dim_direction", "short_name"),
    ("fact_event_vehicles", "event_id", "fact_events", "event_id"),
    ("fact_event_vehicles", "vehicle_type", "dim_vehicles", "vehicle_type"),
]
