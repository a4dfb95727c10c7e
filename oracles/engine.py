"""The haul-cycle rules as a recursive DuckDB query, one step per telemetry row.

The rule is chosen by one CASE over (state, row); each rule then lists the
columns it sets. Written from the rule tables, apart from the Spark engine.
"""

from __future__ import annotations

import re

from haulwright.config import DEFAULT
from haulwright.schemas import CYCLE_FIELDS, CYCLE_TIMES
from oracles.derived import metres, with_ctes

_SQL_TYPE = {"string": "VARCHAR", "int": "INTEGER", "double": "DOUBLE",
             "boolean": "BOOLEAN", "timestamp_ntz": "BIGINT"}
# The pending loader note is kept as its fields.
_NOTE = [("note_guid", "VARCHAR"), ("note_lat", "DOUBLE"), ("note_lon", "DOUBLE"),
         ("note_region", "VARCHAR"), ("note_inside", "BOOLEAN"), ("note_distance", "DOUBLE")]
_FIELDS = [(n, _SQL_TYPE[k]) for n, k in CYCLE_FIELDS if n != "tmp_idle_near_loader"] + _NOTE

_KEEP = dict(
    current_process_date="tick", current_area="area", current_asset_longitude="longitude",
    current_asset_latitude="latitude", previous_work_state_id="s.current_work_state_id",
    current_work_state_id="work_state_id",
)
_BLANK = dict(
    asset_guid="asset_guid", site_guid="site_guid", cycle_status="'INPROGRESS'",
    current_process_date="tick", current_area="area", current_asset_longitude="longitude",
    current_asset_latitude="latitude", current_work_state_id="work_state_id",
    is_within_load_region="false", all_assets_in_same_dump_area="false", is_outlier="false",
)
PD = "s.current_process_date"
_LOADER = dict(loader_asset_guid="loader_guid", loader_latitude="loader_latitude",
               loader_longitude="loader_longitude")
_REGION = dict(load_region_guid="load_region_guid",
               is_within_load_region="load_region_guid IS NOT NULL AND in_load_region",
               asset_load_region_distance="load_region_distance")
_DIST = dict(previous_loader_distance="s.current_loader_distance",
             current_loader_distance="loader_distance")
_NO_NOTE = {n: "NULL" for n, _ in _NOTE}
_CLEAR = dict(idle_in_dump_region_guid="NULL", **_NO_NOTE)
_TRAVEL = dict(load_travel_seconds=f"({PD} - s.load_end_utc) / 1e6")
_EMPTY = f"(({PD} - s.dump_end_utc) / 1e6)"
_WHOLE = (f"(s.load_seconds IS NOT NULL AND s.load_travel_seconds IS NOT NULL"
          f" AND s.dump_seconds IS NOT NULL AND {_EMPTY} IS NOT NULL)")
_BACK = dict(
    cycle_status=f"CASE WHEN {_WHOLE} THEN 'COMPLETE' ELSE 'INVALID' END",
    empty_travel_seconds=_EMPTY, cycle_end_utc=PD,
    total_cycle_seconds=f"CASE WHEN {_WHOLE} THEN s.load_seconds + s.load_travel_seconds + s.dump_seconds + {_EMPTY} END",
    **_CLEAR,
)
_SPOT = dict(outlier_date_utc=PD, outlier_position_latitude="s.current_asset_latitude",
             outlier_position_longitude="s.current_asset_longitude")
_OUT_LOADER = dict(outlier_loader_guid="loader_guid", outlier_loader_latitude="loader_latitude",
                   outlier_loader_longitude="loader_longitude")


def _outlier(kind: int, **more: str) -> dict:
    return dict(is_outlier="true", outlier_type_id=str(kind), outlier_seconds="idle", **_SPOT, **more)


def _grow_or(kind: int, always: dict, **more: str) -> dict:
    """Add to a running outlier, or mark a new one."""
    running = "(s.is_outlier AND s.outlier_seconds <> 0)"
    marks = {
        name: f"CASE WHEN {running} THEN s.{name} ELSE {expr} END"
        for name, expr in _outlier(kind, **more).items()
    }
    marks["outlier_seconds"] = f"CASE WHEN {running} THEN s.outlier_seconds + idle ELSE idle END"
    return {**marks, **always}


_CLOSE_OUT = dict(cycle_status="'OUTLIER'", cycle_end_utc="tick")
_LOADER_OUT = {**_CLOSE_OUT, **_grow_or(3, _CLEAR, **_OUT_LOADER)}
_DUMPED = dict(current_segment="'EMPTY_TRAVEL'", idle_in_dump_region_guid="NULL", dump_end_utc="tick")

UPDATES = {
    "S1": dict(outlier_type_id="1", all_assets_in_same_dump_area="true",
               outlier_dump_region_guid="dump_region_guid", **_SPOT, **_OUT_LOADER),
    "S3": dict(cycle_status="'OUTLIER'", cycle_end_utc=PD),
    "L3": _outlier(3, **_OUT_LOADER),
    "L5": dict(current_segment="'LOAD_TIME'", load_start_utc=PD, **_LOADER, **_DIST, **_REGION),
    "L6": dict(cycle_status="'INVALID'", cycle_end_utc=PD, **_TRAVEL, **_DIST, **_CLEAR),
    "L7": {**_BACK, **_DIST},
    "L8": dict(dump_region_guid="s.idle_in_dump_region_guid", dump_end_utc="tick",
               dump_seconds="idle", cycle_end_utc="tick", **_CLEAR),
    "L9": dict(note_guid="loader_guid", note_lat="loader_latitude", note_lon="loader_longitude",
               note_region="load_region_guid", note_inside="in_load_region",
               note_distance="load_region_distance"),
    "L10": _LOADER_OUT,
    "L12": dict(
        current_segment="'EMPTY_TRAVEL'", dump_region_guid="s.idle_in_dump_region_guid",
        cycle_status="CASE WHEN s.load_seconds + s.load_travel_seconds IS NULL THEN 'INVALID' ELSE 'COMPLETE' END",
        dump_seconds="900.0", empty_travel_seconds="900.0",
        total_cycle_seconds="s.load_seconds + s.load_travel_seconds + 900.0 + 900.0",
        dump_end_utc="s.dump_start_utc + 900000000", cycle_end_utc="s.dump_start_utc + 1800000000", **_CLEAR),
    "L11": dict(current_segment="'EMPTY_TRAVEL'", dump_region_guid="s.idle_in_dump_region_guid",
                dump_seconds="(tick - s.dump_start_utc) / 1e6", dump_end_utc="tick",
                idle_in_dump_region_guid="NULL"),
    "L13": _LOADER_OUT,
    "L14": dict(current_segment="'LOAD_TRAVEL'", load_start_utc=PD, load_end_utc="tick",
                load_seconds="idle", **_LOADER, **_DIST, **_REGION),
    "L15": {**_BACK, **_DIST},
    "L16": dict(dump_region_guid="s.idle_in_dump_region_guid", dump_start_utc=PD,
                dump_seconds="idle", **_DUMPED, **_TRAVEL),
    "L17": dict(load_seconds="coalesce(s.load_seconds, 0) + idle", load_end_utc="tick", **_DIST),
    "L18": {}, "L20": {}, "L22": {},
    "L21": dict(current_segment="'LOAD_TRAVEL'", load_end_utc="tick",
                load_seconds="(tick - s.load_start_utc) / 1e6", **_DIST),
    "U3": _outlier(2, outlier_dump_region_guid="dump_region_guid"),
    "U5": dict(current_segment="'DUMP_TIME'", dump_region_guid="dump_region_guid",
               dump_start_utc=PD, **_TRAVEL),
    "U6": dict(current_segment="'DUMP_TIME'", dump_region_guid="dump_region_guid", dump_start_utc=PD),
    "U7": dict(idle_in_dump_region_guid="dump_region_guid"),
    "U8": {**_CLOSE_OUT, **_grow_or(2, {}, outlier_dump_region_guid="dump_region_guid",
           **{n: "NULL" for n in _CLEAR})},
    "U9": dict(dump_region_guid="dump_region_guid", dump_start_utc=PD, dump_seconds="idle",
               **_DUMPED, **_TRAVEL),
    "U10": dict(dump_seconds="coalesce(s.dump_seconds, 0) + idle", **_DUMPED),
    "U11": dict(
        dump_region_guid="dump_region_guid",
        dump_start_utc=f"CASE WHEN s.dump_region_guid IS NULL THEN {PD} ELSE s.dump_start_utc END",
        dump_seconds="CASE WHEN s.dump_region_guid IS NULL THEN idle ELSE coalesce(s.dump_seconds, 0) + idle END",
        **_DUMPED),
    "U12": dict(dump_region_guid="dump_region_guid", dump_start_utc=PD, dump_seconds="idle", **_DUMPED),
    "U13": dict(dump_seconds="(tick - s.dump_start_utc) / 1e6", **_DUMPED),
    "U14": dict(idle_in_dump_region_guid="NULL"),
    "T2": _outlier(4), "T12": _outlier(4),
    "T3": dict(outlier_seconds="s.outlier_seconds + idle"),
    "T4": {}, "T8": {}, "T13": {},
    "T5": _CLOSE_OUT,
    "T6": _BACK, "T7": _BACK,
    "T9": dict(dump_region_guid="s.idle_in_dump_region_guid", dump_start_utc=PD,
               dump_seconds="idle", **_DUMPED, **_TRAVEL),
    "T10": dict(dump_seconds="(tick - s.dump_start_utc) / 1e6 + coalesce(s.dump_seconds, 0)", **_DUMPED),
    "T11": dict(idle_in_dump_region_guid="NULL"),
}

_AT_LOADER = dict(current_segment="'LOAD_TIME'", load_start_utc=PD, cycle_start_utc=PD,
                  current_loader_distance="loader_distance", **_LOADER, **_REGION)
_BEFORE = dict(previous_work_state_id="s.current_work_state_id")
_OUT_NEXT = {**_AT_LOADER, **_BEFORE, "current_segment": "'LOAD_TRAVEL'",
             "previous_loader_distance": "s.current_loader_distance",
             "load_start_utc": "tick - 20000000", "load_end_utc": "tick", "load_seconds": "20.0",
             "cycle_start_utc": "tick"}
INSERTS = {
    "S3": dict(cycle_start_utc=PD),
    "L6": _AT_LOADER, "L7": _AT_LOADER, "L8": _AT_LOADER,
    "L10": _OUT_NEXT, "L13": _OUT_NEXT,
    "L12": dict(cycle_start_utc="s.dump_start_utc + 1800000000", **_BEFORE),
    "L15": {**_AT_LOADER, **_BEFORE, "current_segment": "'LOAD_TRAVEL'",
            "previous_loader_distance": "s.current_loader_distance",
            "load_end_utc": "tick", "load_seconds": "idle"},
    "U8": dict(cycle_start_utc="tick", current_loader_distance="loader_distance", **_BEFORE),
    "T5": dict(cycle_start_utc="tick"),
    "T6": dict(current_segment="'LOAD_TRAVEL'", load_start_utc=PD, load_end_utc="tick",
               load_seconds="idle", loader_asset_guid="s.note_guid", loader_latitude="s.note_lat",
               loader_longitude="s.note_lon", load_region_guid="s.note_region",
               is_within_load_region="s.note_inside", asset_load_region_distance="s.note_distance",
               cycle_start_utc=PD, **_BEFORE),
    "T7": dict(cycle_start_utc=PD, **_BEFORE),
}

_SAME_LOADER = (
    "s.loader_latitude <> 0 AND s.loader_longitude <> 0 AND s.loader_asset_guid = loader_guid"
    " AND s.current_area = 'LOAD' AND "
    + metres("s.loader_latitude", "s.loader_longitude", "loader_latitude", "loader_longitude")
    + " <= 10"
)
_LOST = "load_region_guid IS NULL"
_RULE = f"""CASE
    WHEN bad_position THEN 'X6'
    WHEN s.cycle_number IS NULL THEN CASE WHEN overlap THEN 'X1' ELSE 'D1' END
    WHEN tick <= s.changed_at THEN NULL
    WHEN together OR s.all_assets_in_same_dump_area THEN
        CASE WHEN s.all_assets_in_same_dump_area THEN CASE WHEN together THEN NULL ELSE 'S3' END
            WHEN s.current_work_state_id = 2 AND work_state_id IN (2, 3) AND idle >= 30 THEN 'S1' END
    WHEN area = 'LOAD' THEN CASE pair
        WHEN 'II' THEN CASE WHEN idle <= 20 THEN NULL
            WHEN s.current_segment = 'LOAD_TIME' THEN
                CASE WHEN NOT s.is_outlier AND idle > 1200 THEN 'L3' END
            WHEN s.current_segment IS NULL THEN 'L5'
            WHEN {_LOST} THEN 'X3'
            WHEN s.current_segment = 'LOAD_TRAVEL' THEN 'L6'
            WHEN s.current_segment = 'EMPTY_TRAVEL' THEN 'L7' ELSE 'L8' END
        WHEN 'WI' THEN CASE WHEN {_LOST} THEN 'X2' ELSE 'L9' END
        WHEN 'IW' THEN CASE
            WHEN s.is_outlier THEN CASE WHEN {_LOST} THEN 'X3' ELSE 'L10' END
            WHEN s.current_segment = 'DUMP_TIME' THEN
                CASE WHEN (tick - s.dump_start_utc) / 1e6 <= 1800 THEN 'L11' ELSE 'X4' END
            WHEN idle > 1200 THEN CASE WHEN {_LOST} THEN 'X3' ELSE 'L13' END
            WHEN idle > 20 AND s.current_segment IS NULL THEN 'L14'
            WHEN idle > 20 AND s.current_segment = 'EMPTY_TRAVEL' THEN CASE WHEN {_LOST} THEN 'X3' ELSE 'L15' END
            WHEN idle > 20 AND s.current_segment = 'LOAD_TRAVEL' THEN
                CASE WHEN s.current_area = 'DUMP' THEN 'L16' WHEN {_SAME_LOADER} THEN 'L17' ELSE 'L18' END
            WHEN s.current_segment IS NULL THEN 'L20'
            WHEN s.current_segment = 'LOAD_TIME' AND s.load_start_utc IS NOT NULL THEN 'L21'
            ELSE 'L22' END END
    WHEN area = 'DUMP' THEN CASE pair
        WHEN 'II' THEN CASE WHEN idle <= 15 OR s.is_outlier THEN NULL
            WHEN idle > 1200 THEN 'U3' WHEN s.current_segment = 'DUMP_TIME' THEN NULL
            WHEN s.current_segment = 'LOAD_TRAVEL' THEN 'U5' ELSE 'U6' END
        WHEN 'WI' THEN 'U7'
        WHEN 'IW' THEN CASE WHEN s.is_outlier OR idle > 1200 THEN 'U8'
            WHEN idle > 15 THEN CASE
                WHEN s.current_segment = 'LOAD_TRAVEL' THEN 'U9'
                WHEN s.current_segment = 'EMPTY_TRAVEL' THEN
                    CASE WHEN s.dump_region_guid = dump_region_guid THEN 'U10' ELSE 'U11' END
                ELSE 'U12' END
            WHEN s.current_segment = 'DUMP_TIME' THEN 'U13' ELSE 'U14' END END
    ELSE CASE pair
        WHEN 'II' THEN CASE WHEN idle <= 600 THEN NULL WHEN s.is_outlier THEN 'T3' ELSE 'T2' END
        WHEN 'WI' THEN 'T4'
        WHEN 'IW' THEN CASE WHEN s.is_outlier THEN 'T5'
            WHEN s.current_segment = 'EMPTY_TRAVEL' AND s.current_area IN ('LOAD', 'TRAVEL') THEN
                CASE WHEN idle <= 45 THEN 'T8' WHEN s.current_area = 'TRAVEL' THEN 'T7'
                    WHEN s.note_guid IS NULL THEN 'X5' ELSE 'T6' END
            WHEN s.current_segment IN ('LOAD_TRAVEL', 'DUMP_TIME') AND s.current_area = 'DUMP' THEN
                CASE WHEN idle <= 45 THEN 'T11' WHEN s.current_segment = 'LOAD_TRAVEL' THEN 'T9' ELSE 'T10' END
            WHEN idle > 600 THEN 'T12' ELSE 'T13' END END END"""


def _struct(columns: dict[str, str]) -> str:
    return "struct_pack(" + ", ".join(
        f"{n} := CAST({columns[n]} AS {t})" for n, t in [*_FIELDS, ("changed_at", "BIGINT")]
    ) + ")"


def _by_rule(name: str, table: dict[str, dict], default: str) -> str:
    by_expr: dict[str, list[str]] = {}
    for rule, columns in table.items():
        if name in columns:
            by_expr.setdefault(columns[name], []).append(rule)
    if not by_expr:
        return default
    whens = " ".join(
        f"WHEN rule IN ({', '.join(repr(r) for r in rules)}) THEN {expr}"
        for expr, rules in by_expr.items()
    )
    return f"CASE {whens} ELSE {default} END"


# What the repaired rules do instead of losing a record.
_REPAIRS = [
    ("CASE WHEN overlap THEN 'X1' ELSE 'D1' END", "'D1'"),
    (_LOST, "false"),
    ("'X4'", "'L12'"),
    ("WHEN s.note_guid IS NULL THEN 'X5'", ""),
]


# Realtime drops what is not later than the newest stored progress of the truck.
_FRESH = f"""NOT EXISTS (SELECT 1 FROM progress p WHERE p.asset_guid = t.asset_guid
        AND p.process_name = '{DEFAULT.cycle_process}' AND t."timestamp" <= p.process_date)"""


def _recursion(placed: str, repaired: bool = False, also: str = "true") -> str:
    """CTE `steps_taken`: after each row the open state, the updated record, the rule."""
    fresh = also if placed.endswith("asof") else f"{_FRESH} AND {also}"
    names = [n for n, _ in _FIELDS]
    empty = _struct({n: "NULL" for n in [*names, "changed_at"]})
    update = {n: _by_rule(n, UPDATES, _KEEP.get(n, f"s.{n}")) for n in names}
    first = {n: _BLANK.get(n, "NULL") for n in names} | {"cycle_number": "1", "cycle_start_utc": "tick"}
    insert = {n: _by_rule(n, INSERTS, _BLANK.get(n, "NULL")) for n in names}
    insert["cycle_number"] = "s.cycle_number + 1"
    for columns in (update, first, insert):
        columns["changed_at"] = "tick"
    choice = _RULE
    for lost, handled in _REPAIRS if repaired else []:
        assert lost in choice
        choice = choice.replace(lost, handled)
    inserting = ", ".join(repr(r) for r in INSERTS)
    return f"""
rows_in_order AS MATERIALIZED (
    SELECT *, epoch_us("timestamp") AS tick,
        row_number() OVER (PARTITION BY asset_guid ORDER BY "timestamp", seq) AS rn FROM {placed} t
    WHERE {fresh}),
steps_taken AS (
    SELECT asset_guid, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS seq, CAST(NULL AS VARCHAR) AS site_guid,
        CAST(NULL AS BIGINT) AS tick, CAST(NULL AS VARCHAR) AS rule, {empty} AS s, {empty} AS u
    FROM (SELECT DISTINCT asset_guid FROM rows_in_order)
    UNION ALL
    SELECT asset_guid, rn, seq, site_guid, tick, rule,
        CASE WHEN rule IN ({inserting}) THEN {_struct(insert)}
            WHEN rule IS NULL OR rule[1] = 'X' THEN s ELSE u END AS s, u
    FROM (
        SELECT *, CASE WHEN rule IS NULL OR rule[1] = 'X' THEN {empty}
            WHEN rule = 'D1' THEN {_struct(first)} ELSE {_struct(update)} END AS u
        FROM (SELECT *, {choice} AS rule FROM (
            SELECT *, (tick - s.current_process_date) / 1e6 AS idle,
                CASE WHEN s.current_work_state_id = 2 THEN 'I' WHEN s.current_work_state_id = 3 THEN 'W' ELSE '?' END
                    || CASE WHEN work_state_id = 2 THEN 'I' WHEN work_state_id = 3 THEN 'W' ELSE '?' END AS pair,
                overlap AND NOT loaded AND colocated AS together,
                CASE WHEN overlap THEN CASE WHEN loaded THEN 'DUMP' ELSE 'LOAD' END
                    WHEN loader_guid IS NOT NULL THEN 'LOAD' WHEN dump_region_guid IS NOT NULL THEN 'DUMP'
                    ELSE 'TRAVEL' END AS area
            FROM (SELECT c.* EXCLUDE (area), r.s,
                    c.loader_guid IS NOT NULL AND c.dump_region_guid IS NOT NULL AS overlap,
                    coalesce(r.s.current_segment IN ('LOAD_TIME', 'LOAD_TRAVEL'), false) AS loaded
                FROM steps_taken r JOIN rows_in_order c ON c.asset_guid = r.asset_guid AND c.rn = r.rn + 1)
        )))),
log AS MATERIALIZED (
    SELECT seq, CASE WHEN rule = 'D1' THEN 'init' ELSE 'update' END AS action, rule, unnest(u)
    FROM steps_taken WHERE rule IS NOT NULL AND rule[1] <> 'X'
    UNION ALL
    SELECT seq, 'insert', rule, unnest(s) FROM steps_taken WHERE rule IN ({inserting})),
lost AS MATERIALIZED (
    SELECT seq, asset_guid, site_guid, make_timestamp(tick) AS "timestamp", rule AS reject
    FROM steps_taken WHERE rule[1] = 'X')"""


ROUNDED = ["asset_load_region_distance", "previous_loader_distance", "current_loader_distance"]
PLACES = [n for n, k in CYCLE_FIELDS if k == "double" and n.endswith(("latitude", "longitude"))]


def columns() -> str:
    """The cycle columns as the registered queries show them."""
    shown = []
    for name, _ in CYCLE_FIELDS:
        if name in CYCLE_TIMES:
            shown.append(f"make_timestamp({name}) AS {name}")
        elif name in ROUNDED:
            shown.append(f"round({name}, 3) AS {name}")
        elif name in PLACES:
            shown.append(f"round({name}, 6) AS {name}")
        elif name == "tmp_idle_near_loader":
            shown.append("note_guid AS pending_loader_guid")
        else:
            shown.append(name)
    return ", ".join(shown)


def over_log(
    body: str, placed: str = "placed", also: list[str] = [], repaired: bool = False, telemetry: str | None = None
) -> str:
    """Over the log of one run; `telemetry` takes the place of the derived one (`sent`)."""
    return with_ctes(
        [placed, "progress", *also], body, recursive=_recursion(placed, repaired).strip(), telemetry=telemetry
    )


def over_logs(body: str, runs: dict[str, tuple[str, bool]]) -> str:
    """Over several logs, `log_<run>` and `lost_<run>` of each run (placed rows, repaired)."""
    steps = []
    for run, (placed, repaired) in runs.items():
        text = _recursion(placed, repaired).strip()
        steps.append(re.sub(r"\b(rows_in_order|steps_taken|log|lost)\b", rf"\1_{run}", text))
    return with_ctes([*{p for p, _ in runs.values()}, "progress"], body, recursive=",\n".join(steps))
