"""One DuckDB statement per registered query."""

from __future__ import annotations

from haulwright.config import DEFAULT
from oracles.derived import metres, with_ctes
from oracles.engine import columns, over_log, over_logs

_FINAL = "cycle_status IN ('COMPLETE', 'INVALID', 'OUTLIER')"

# Payloads: kind of JSON, then one row per object.
_ITEMS = """
    (SELECT shard, sequence_number, sub_sequence_number, item_no, item FROM (
        SELECT shard, sequence_number, sub_sequence_number, CAST(0 AS BIGINT) AS item_no, CAST(data AS JSON) AS item
        FROM (SELECT * FROM raw WHERE data <> '' AND json_valid(data)) WHERE json_type(data) = 'OBJECT'
        UNION ALL
        SELECT shard, sequence_number, sub_sequence_number,
            unnest(generate_series(0, CAST(json_array_length(data) AS BIGINT) - 1)), unnest(CAST(CAST(data AS JSON) AS JSON[]))
        FROM (SELECT * FROM raw WHERE data <> '' AND json_valid(data)) WHERE json_type(data) = 'ARRAY'))"""
_RECORDS = f"(SELECT * FROM {_ITEMS} WHERE json_type(item) = 'OBJECT' AND len(json_keys(item)) > 0)"

_NUMBER = r"'^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$'"


def _decimal(name: str) -> str:
    return (
        f"CASE WHEN json_type(item, '$.{name}') IN ('VARCHAR') AND NOT regexp_matches(trim(item ->> '{name}'), {_NUMBER})"
        f" THEN NULL ELSE round(try_cast(item ->> '{name}' AS DOUBLE), 6) END"
    )


_TYPED = f"""
    SELECT shard, sequence_number, sub_sequence_number, item_no, item ->> 'asset_guid' AS asset_guid,
        nullif(item ->> 'site_guid', '') AS site_guid,
        CASE WHEN item ->> 'timestamp' LIKE '%+05:00' THEN try_cast(replace(item ->> 'timestamp', '+05:00', '') AS TIMESTAMP) - INTERVAL 5 HOUR
            ELSE try_cast(replace(item ->> 'timestamp', 'Z', '') AS TIMESTAMP) END AS "timestamp",
        CASE WHEN json_type(item, '$.work_state_id') = 'VARCHAR' THEN
                CASE WHEN regexp_matches(trim(item ->> 'work_state_id'), '^[+-]?\\d+$') THEN CAST(trim(item ->> 'work_state_id') AS INTEGER) END
            ELSE CAST(trunc(try_cast(item ->> 'work_state_id' AS DOUBLE)) AS INTEGER) END AS work_state_id,
        {_decimal('longitude')} AS longitude, {_decimal('latitude')} AS latitude,
        json_exists(item, '$.asset_guid') AND json_exists(item, '$.site_guid') AS complete
    FROM {_RECORDS}"""

_LOST_FIELD = ('NOT complete OR "timestamp" IS NULL OR work_state_id IS NULL'
               " OR longitude IS NULL OR latitude IS NULL")
_FROM_PAYLOADS = f"""
        SELECT sequence_number * 1048576 + sub_sequence_number * 1024 + item_no AS seq, asset_guid, site_guid,
            "timestamp", work_state_id, longitude, latitude FROM ({_TYPED}) WHERE NOT ({_LOST_FIELD})"""

_STOPS = """
    SELECT asset_guid, site_guid, "timestamp" AS stop_start, stop_end,
        (epoch_us(stop_end) - epoch_us("timestamp")) / 1e6 AS idle_seconds {extra}
    FROM (SELECT *, lead("timestamp") OVER (PARTITION BY asset_guid ORDER BY "timestamp", seq) AS stop_end
        FROM (SELECT *, lag(work_state_id) OVER (PARTITION BY asset_guid ORDER BY "timestamp", seq) AS before
            FROM {rows}) WHERE before IS NULL OR (before = 2) <> (work_state_id = 2))
    WHERE work_state_id = 2"""

_DURATIONS = ["load_seconds", "load_travel_seconds", "dump_seconds", "empty_travel_seconds",
              "total_cycle_seconds", "outlier_seconds"]
_KPIS = ", ".join(
    f"round(avg({n}), 4) AS avg_{n}, quantile_disc({n}, 0.5) AS median_{n}" for n in _DURATIONS
)
_WHOLE = ("load_seconds IS NOT NULL AND load_travel_seconds IS NOT NULL"
          " AND dump_seconds IS NOT NULL AND empty_travel_seconds IS NOT NULL")


def _elapsed(name: str) -> str:
    return (
        f"CASE WHEN {name} >= 0 THEN printf('%02d:%02d:%08.5f', CAST(floor({name} / 3600) AS BIGINT),"
        f" CAST(floor(({name} % 3600) / 60) AS BIGINT), {name} % 60) END"
    )


_LATEST = f"""(SELECT * FROM progress WHERE process_name = '{DEFAULT.cycle_process}'
    QUALIFY row_number() OVER (PARTITION BY asset_guid ORDER BY process_date DESC, tx_process_info_id DESC) = 1)"""
_SHOWN_NEAR = "SELECT seq, asset_guid, loader_guid, round(loader_distance, 3) AS loader_distance FROM"
_CURRENT = """(SELECT * FROM log QUALIFY row_number() OVER (
    PARTITION BY site_guid, asset_guid, cycle_number ORDER BY current_process_date DESC, seq DESC) = 1)"""

_RUNS = {"realtime": ("placed", False), "reprocess": ("placed_asof", False), "repaired": ("placed", True)}

ORACLES: dict[str, str] = {
    "telemetry_decode": with_ctes(["raw"], f"""
        SELECT shard, sequence_number, sub_sequence_number, item_no, item ->> 'asset_guid' AS asset_guid,
            item ->> 'timestamp' AS timestamp_text, item ->> 'site_guid' AS site_guid FROM {_RECORDS}"""),
    "telemetry_rejects": with_ctes(["raw"], f"""
        SELECT reason, count(*) AS n, CASE WHEN reason IN ('broken_json', 'scalar', 'X7') THEN 'error' ELSE 'skipped' END AS outcome
        FROM (SELECT CASE WHEN data = '' THEN 'empty' WHEN NOT json_valid(data) THEN 'broken_json'
                WHEN json_type(data) = 'NULL' THEN 'null'
                WHEN json_type(data) = 'OBJECT' AND len(json_keys(data)) = 0 THEN 'empty_object'
                WHEN json_type(data) = 'ARRAY' AND json_array_length(data) = 0 THEN 'empty_array'
                WHEN json_type(data) NOT IN ('OBJECT', 'ARRAY') THEN 'scalar' END AS reason FROM raw
            UNION ALL SELECT 'not_an_object' FROM {_ITEMS}
                WHERE (json_type(item) <> 'OBJECT' OR len(json_keys(item)) = 0) AND item_no > 0
            UNION ALL SELECT 'X7' FROM ({_TYPED}) WHERE {_LOST_FIELD})
        WHERE reason IS NOT NULL GROUP BY reason"""),
    "telemetry_typed": with_ctes(["raw"], f"""
        SELECT * EXCLUDE (complete), CASE WHEN {_LOST_FIELD} THEN 'X7' END AS reject FROM ({_TYPED})"""),
    "shard_high_water": with_ctes(["raw"], """
        SELECT shard, best.a AS sequence_number, best.b AS sub_sequence_number FROM (
            SELECT shard, max({'a': sequence_number, 'b': sub_sequence_number}) AS best FROM raw
            WHERE data <> '' AND json_valid(data) AND ((json_type(data) = 'OBJECT' AND len(json_keys(data)) > 0)
                OR (json_type(data) = 'ARRAY' AND json_array_length(data) > 0)) GROUP BY shard)"""),
    "table_read": with_ctes(["progress"], f"""
        SELECT tx_process_info_id, asset_guid, process_date FROM progress
        WHERE process_name = '{DEFAULT.cycle_process}' AND site_guid = 'S1'
        ORDER BY process_date DESC, tx_process_info_id LIMIT 20"""),
    "sql_read": with_ctes(["progress"], f"""
        SELECT site_guid, count(*) AS n_assets, max(process_date) AS last_date FROM progress
        WHERE process_name = '{DEFAULT.cycle_process}' GROUP BY site_guid"""),
    "site_regions": with_ctes(["regions"], "SELECT * FROM regions"),
    "region_audit": with_ctes(["shapes"], """
        SELECT site_guid, region_guid, region_type, parse_error,
            CASE WHEN parse_error IS NULL THEN n_points END AS n_points,
            CASE WHEN parse_error IS NULL THEN min_lon END AS min_lon,
            CASE WHEN parse_error IS NULL THEN max_lon END AS max_lon,
            CASE WHEN parse_error IS NULL THEN min_lat END AS min_lat,
            CASE WHEN parse_error IS NULL THEN max_lat END AS max_lat FROM shapes"""),
    "truck_telemetry": with_ctes(["trucks"], """
        SELECT seq, asset_guid, site_guid, "timestamp", work_state_id FROM trucks"""),
    "fresh_telemetry": with_ctes(["telemetry", "progress"], f"""
        SELECT seq, asset_guid, "timestamp" FROM telemetry t WHERE NOT EXISTS (
            SELECT 1 FROM {_LATEST} p WHERE p.asset_guid = t.asset_guid AND t."timestamp" <= p.process_date)"""),
    "coordinate_audit": with_ctes(["checked"], """
        SELECT site_guid, count(*) AS n_rows, count(*) FILTER (WHERE bad_position) AS n_bad,
            round(min(latitude), 6) AS min_latitude, round(max(latitude), 6) AS max_latitude
        FROM checked GROUP BY site_guid"""),
    "resolved_site": with_ctes(["resolved"], "SELECT seq, asset_guid, site_guid FROM resolved"),
    "asset_latest_site": with_ctes(["latest_site"], "SELECT asset_guid, site_guid FROM latest_site"),
    "loaders_current": with_ctes(["loaders"], """
        SELECT asset_guid, site_guid, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude FROM loaders"""),
    "loaders_asof": with_ctes(["validity"], """
        SELECT asset_guid, site_guid, valid_from, valid_to, round(latitude, 6) AS latitude,
            round(longitude, 6) AS longitude FROM validity"""),
    "nearest_loader": with_ctes(["near"], f"{_SHOWN_NEAR} near"),
    "nearest_loader_asof": with_ctes(["near_asof"], f"{_SHOWN_NEAR} near_asof"),
    "nearest_load_region": with_ctes(["located"], """
        SELECT seq, load_region_guid, in_load_region, round(load_region_distance, 3) AS load_region_distance
        FROM located WHERE load_region_guid IS NOT NULL"""),
    "dump_region_hit": with_ctes(["located"], "SELECT seq, asset_guid, dump_region_guid FROM located"),
    "colocation": with_ctes(["placed"], """
        SELECT seq, loader_guid, dump_region_guid, colocated FROM placed
        WHERE loader_guid IS NOT NULL AND dump_region_guid IS NOT NULL"""),
    "area_static": with_ctes(["placed"], "SELECT seq, asset_guid, area FROM placed"),
    "asset_regions_latest": with_ctes(["assets", "region_master"], """
        SELECT asset_guid, client_guid, site_guid, region_guid, region_points, fence_area FROM (
            SELECT a.guid AS asset_guid, a.client_guid, s.guid AS site_guid, r.guid AS region_guid,
                r.points AS region_points, r.fence_area,
                row_number() OVER (PARTITION BY a.guid, a.client_guid, s.guid, r.guid ORDER BY r.created_date DESC) AS rn
            FROM assets a JOIN (SELECT 'S' || r_regionkey AS guid FROM region) s ON a.site_guid = s.guid
            JOIN region_master r ON r.site_guid = s.guid
            WHERE r.points IS NOT NULL AND NOT r.is_deleted) WHERE rn = 1"""),
    "latest_process_info": with_ctes(["progress"], f"""
        SELECT tx_process_info_id, process_name, process_date, asset_guid, site_guid FROM {_LATEST}"""),
    "cycle_change_log": over_log(f"SELECT seq, action, rule, {columns()} FROM log"),
    "cycles_final": over_log(f"SELECT {columns()} FROM log WHERE {_FINAL}"),
    "cycles_final_reprocess": over_log(f"SELECT {columns()} FROM log WHERE {_FINAL}", "placed_asof"),
    "cycles_final_repaired": over_log(f"SELECT {columns()} FROM log WHERE {_FINAL}", repaired=True),
    "cycles_current": over_log(f"SELECT {columns()} FROM {_CURRENT}"),
    "cycles_current_merged": over_log(f"SELECT {columns()} FROM {_CURRENT}"),
    "cycles_from_payloads": over_log(f"SELECT {columns()} FROM log WHERE {_FINAL}", telemetry=_FROM_PAYLOADS),
    "cycle_rejects_from_payloads": over_log(f"""
        SELECT asset_guid, site_guid, "timestamp", reject FROM lost
        UNION ALL SELECT asset_guid, site_guid, "timestamp", 'X7' FROM ({_TYPED}) WHERE {_LOST_FIELD}""",
        also=["raw"], telemetry=_FROM_PAYLOADS),
    "rule_coverage": over_logs(" UNION ALL ".join(
        f"SELECT '{run}' AS run, rule, action, count(*) AS n FROM (SELECT rule, action FROM log_{run}"
        f" UNION ALL SELECT reject, 'reject' FROM lost_{run}) GROUP BY ALL" for run in _RUNS), _RUNS),
    "cycle_rejects": over_log("SELECT * FROM lost"),
    "cycle_rejects_reprocess": over_log("SELECT * FROM lost", "placed_asof"),
    "process_info": over_log(f"""
        SELECT coalesce(p.process_name, '{DEFAULT.cycle_process}') AS process_name,
            greatest(c.process_date, p.process_date) AS process_date,
            TIMESTAMP '2024-01-01 00:00:00' + CASE WHEN p.asset_guid IS NULL THEN INTERVAL 152 DAY ELSE INTERVAL 0 DAY END AS created_date,
            CASE WHEN p.asset_guid IS NOT NULL AND c.asset_guid IS NOT NULL THEN TIMESTAMP '2024-06-01 00:00:00' END AS updated_date,
            coalesce(p.asset_guid, c.asset_guid) AS asset_guid, coalesce(p.site_guid, c.site_guid) AS site_guid
        FROM {_LATEST} p FULL JOIN (SELECT asset_guid, make_timestamp(max(current_process_date)) AS process_date,
            arg_min(site_guid, current_process_date) AS site_guid FROM log GROUP BY asset_guid) c USING (asset_guid)""", also=["progress"]),
    "next_cycle_number": over_log(f"""
        SELECT p.asset_guid, p.process_date AS asked_at, CAST(max(c.cycle_number) + 1 AS INTEGER) AS next_cycle_number
        FROM {_LATEST} p LEFT JOIN (SELECT * FROM log WHERE {_FINAL}) c
            ON c.asset_guid = p.asset_guid AND make_timestamp(c.cycle_end_utc) <= p.process_date
        GROUP BY p.asset_guid, p.process_date""", also=["progress"]),
    "open_cycle": over_log(f"""
        SELECT asset_guid, site_guid, cycle_number, current_segment, make_timestamp(current_process_date) AS current_process_date
        FROM {_CURRENT} WHERE cycle_status = 'INPROGRESS'
        QUALIFY row_number() OVER (PARTITION BY asset_guid, site_guid ORDER BY cycle_number DESC) = 1"""),
    "duration_report": over_log(f"""
        SELECT asset_guid, cycle_number, cycle_status, {_elapsed('total_cycle_seconds')} AS total_text,
            {_elapsed('outlier_seconds')} AS outlier_text FROM log WHERE {_FINAL}"""),
    "idle_stops": with_ctes(["trucks"], _STOPS.format(rows="trucks", extra="")),
    "stop_class": with_ctes(["placed"], f"""
        SELECT *, CASE WHEN idle_seconds IS NULL THEN 'unfinished' WHEN idle_seconds > 1800 THEN 'long'
            WHEN area <> 'TRAVEL' AND idle_seconds > 1200 THEN 'outlier'
            WHEN area = 'TRAVEL' AND idle_seconds > 600 THEN 'outlier'
            WHEN area = 'LOAD' AND idle_seconds > 20 THEN 'load' WHEN area = 'DUMP' AND idle_seconds > 15 THEN 'dump'
            WHEN area = 'OVERLAP' AND idle_seconds >= 30 THEN 'together'
            WHEN area = 'TRAVEL' AND idle_seconds > 45 THEN 'seen_from_travel' ELSE 'brief' END AS stop_class
        FROM ({_STOPS.format(rows="placed", extra=", area")})"""),
    "state_transitions": with_ctes(["placed"], """
        SELECT site_guid, area, before AS previous_state, work_state_id, count(*) AS n
        FROM (SELECT *, lag(work_state_id) OVER (PARTITION BY asset_guid ORDER BY "timestamp", seq) AS before FROM placed)
        WHERE before IS NOT NULL GROUP BY ALL"""),
    "loader_movement": with_ctes(["validity"], f"""
        SELECT asset_guid, site_guid, valid_from, round(moved, 3) AS moved_m, moved > 10 AS has_moved FROM (
            SELECT *, {metres('lat0', 'lon0', 'latitude', 'longitude')} AS moved FROM (
                SELECT *, lag(latitude) OVER w AS lat0, lag(longitude) OVER w AS lon0 FROM validity
                WINDOW w AS (PARTITION BY asset_guid ORDER BY valid_from)) WHERE lat0 IS NOT NULL)"""),
    "cycle_status_check": over_log(f"""
        SELECT cycle_status, has_all_durations, status_fits, count(*) AS n_cycles FROM (
            SELECT cycle_status, {_WHOLE} AS has_all_durations,
                CASE cycle_status WHEN 'COMPLETE' THEN {_WHOLE} AND total_cycle_seconds
                    = load_seconds + load_travel_seconds + dump_seconds + empty_travel_seconds
                WHEN 'INVALID' THEN NOT ({_WHOLE}) ELSE total_cycle_seconds IS NULL END AS status_fits
            FROM log WHERE {_FINAL}) GROUP BY ALL"""),
    "cycle_kpis": over_log(f"""
        SELECT cycle_status, site_guid, loader_asset_guid, dump_region_guid, count(*) AS n_cycles, {_KPIS}
        FROM log WHERE {_FINAL} GROUP BY ALL"""),
}
