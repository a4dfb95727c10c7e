"""Column lists and Spark schemas of the tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Names and order of the cycle columns, with their Spark types.
CYCLE_FIELDS = [
    ("asset_guid", "string"),
    ("cycle_number", "int"),
    ("cycle_status", "string"),
    ("current_process_date", "timestamp_ntz"),
    ("current_area", "string"),
    ("current_asset_longitude", "double"),
    ("current_asset_latitude", "double"),
    ("site_guid", "string"),
    ("current_segment", "string"),
    ("previous_work_state_id", "int"),
    ("current_work_state_id", "int"),
    ("loader_asset_guid", "string"),
    ("loader_latitude", "double"),
    ("loader_longitude", "double"),
    ("load_region_guid", "string"),
    ("is_within_load_region", "boolean"),
    ("asset_load_region_distance", "double"),
    ("previous_loader_distance", "double"),
    ("current_loader_distance", "double"),
    ("idle_in_dump_region_guid", "string"),
    ("tmp_idle_near_loader", "string"),
    ("dump_region_guid", "string"),
    ("outlier_type_id", "int"),
    ("all_assets_in_same_dump_area", "boolean"),
    ("outlier_date_utc", "timestamp_ntz"),
    ("outlier_loader_guid", "string"),
    ("outlier_loader_latitude", "double"),
    ("outlier_loader_longitude", "double"),
    ("outlier_dump_region_guid", "string"),
    ("is_outlier", "boolean"),
    ("outlier_position_latitude", "double"),
    ("outlier_position_longitude", "double"),
    ("load_start_utc", "timestamp_ntz"),
    ("load_end_utc", "timestamp_ntz"),
    ("dump_start_utc", "timestamp_ntz"),
    ("dump_end_utc", "timestamp_ntz"),
    ("load_travel_seconds", "double"),
    ("empty_travel_seconds", "double"),
    ("dump_seconds", "double"),
    ("load_seconds", "double"),
    ("total_cycle_seconds", "double"),
    ("outlier_seconds", "double"),
    ("cycle_start_utc", "timestamp_ntz"),
    ("cycle_end_utc", "timestamp_ntz"),
]
CYCLE_COLS = [name for name, _ in CYCLE_FIELDS]
CYCLE_TIMES = [name for name, kind in CYCLE_FIELDS if kind == "timestamp_ntz"]

# The stored cycle table adds a surrogate key and two audit times.
CYCLE_TABLE_COLS = ["asset_cycle_vlx_id", *CYCLE_COLS, "created_date", "updated_date"]
CYCLE_KEY = ["site_guid", "asset_guid", "cycle_number"]

# Columns of the progress table.
PROCESS_INFO_COLS = [
    "tx_process_info_id",
    "process_name",
    "process_date",
    "created_date",
    "updated_date",
    "asset_guid",
    "site_guid",
]

TELEMETRY_RAW = T.StructType([
    T.StructField("shard", T.StringType()),
    T.StructField("sequence_number", T.StringType()),  # decimal digits, as many as a shard has
    T.StructField("sub_sequence_number", T.LongType()),
    T.StructField("partition_key", T.StringType()),
    T.StructField("data", T.StringType()),
])

TELEMETRY = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("asset_guid", T.StringType()),
    T.StructField("site_guid", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("work_state_id", T.IntegerType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("latitude", T.DoubleType()),
])

# What the cycle engine reads for each telemetry row, times in microseconds.
MOMENT_COLS = [
    "seq",
    "asset_guid",
    "site_guid",
    "at_us",
    "work_state_id",
    "longitude",
    "latitude",
    "loader_guid",
    "loader_latitude",
    "loader_longitude",
    "loader_distance",
    "load_region_guid",
    "in_load_region",
    "load_region_distance",
    "dump_region_guid",
    "colocated",
    "bad_position",
]

# What the cycle engine writes: one row per changed or lost record.
CHANGE_COLS = ["seq", "action", "rule", *CYCLE_COLS]


def change_wire(seq: str) -> str:
    """Those columns for sequence numbers of a type, times in microseconds."""
    return f"seq {seq}, action string, rule string, " + ", ".join(
        f"{name} {'bigint' if kind == 'timestamp_ntz' else kind}"
        for name, kind in CYCLE_FIELDS
    )
