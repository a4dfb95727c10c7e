"""Haul-truck inputs derived from the given tables.

The given tables hold no positions, so each query derives its inputs from them:
`events` become telemetry, `customer` the assets, `supplier` the loaders,
`nation` the regions. Every input grows with its table.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulwright.config import DEFAULT, CycleConfig
from haulwright.operators.timeline import running_totals

# Seconds from the start of a round to each of its twelve phases.
PHASE_ENDS = [60, 70, 100, 160, 310, 460, 610, 620, 640, 650, 800, 950]
ROUND_SECONDS = 950

# Courses of some trucks as (second, place, work state), for what rounds seldom or never show.
_LOADED = [(0, "loader", 3), (10, "loader", 2), (40, "loader", 2), (100, "loader", 3)]
_TO_DUMP = [*_LOADED, (400, "road", 3), (700, "dump", 2)]
_DUMPED = [*_TO_DUMP, (720, "dump", 2), (730, "dump", 3)]
COURSES = [
    [*_TO_DUMP, (720, "dump", 2), (2600, "loader", 3), (2700, "loader", 2)],  # dumped, then unseen until working at a loader
    [*_LOADED, (110, "loader", 2), (140, "loader", 3)],  # topped up
    [*_LOADED, (110, "other loader", 2), (160, "other loader", 3)],  # stopped at another loader
    [*_DUMPED, (740, "dump", 2), (770, "dump", 3)],  # dumped on
    [*_LOADED[:3], (1241, "loader", 2), (2600, "loader", 2)],  # loading for very long
    [*_TO_DUMP, (760, "loader", 3)],  # dumped unseen
    [(0, "loader", 2), (10, "loader", 3)],  # short stop before any loading
    [*_LOADED, (200, "loader", 2), (210, "loader", 3)],  # short stop when loaded
    [*_LOADED, (300, "road", 2), (950, "road", 2), (1600, "road", 2), (1700, "road", 3)],  # very long stop on the road
    [*_DUMPED, (800, "other dump", 2), (840, "other dump", 3)],  # a second dump
    [(0, "loader", 3), (10, "loader", 5), (20, "dump", 7), (30, "road", 5), (40, "road", 2), (30, "loader", 2)],  # other states, late
    [(0, "overlap", 3), (20, "road", 3), (30, "overlap", 2), (80, "overlap", 2), (200, "road", 3)],  # begins at a loader in a dump
]

# The given tables, so that reading them needs no look at the files first.
_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
}


def _site(key: str) -> str:
    return f"concat('S', cast(({key}) % 5 as string))"


def _after_epoch(seconds: str) -> str:
    return f"cast(timestamp_seconds(1704067200 + ({seconds})) as timestamp_ntz)"


def _degrees_text(millionths: str) -> str:
    """Fixed-point text of a coordinate given in millionths of a degree."""
    size = f"abs({millionths})"
    return (
        f"concat(if(({millionths}) < 0, '-', ''), cast({size} div 1000000 as string), "
        f"'.', lpad(cast({size} % 1000000 as string), 6, '0'))"
    )


class DerivedInputs:
    """The inputs of the haul-cycle jobs, read from one folder of given tables."""

    def __init__(self, spark: SparkSession, folder: str, cfg: CycleConfig = DEFAULT) -> None:
        self.spark = spark
        self.folder = folder
        self.cfg = cfg
        self.table = cache(self._table)

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.schema(_SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    # --- telemetry ------------------------------------------------------------

    def _placed_events(self) -> DataFrame:
        """Events with their phase in the haul round, place, state and time."""
        extra = F.expr(
            "event_id % 5"
            " + CASE WHEN value > 110 THEN if(event_id % 2 = 0, 1300, 700) ELSE 0 END"
            " + if(event_type = 'error', 40, 0)"
        )
        ordered = running_totals(
            self.table("events").select("event_id", "ts", "user_id", "event_type", "value"),
            ["user_id"],
            # Wide enough to hold many of a user's events, so that there are far fewer of them than events.
            F.expr("date_trunc('week', ts)"),
            ["ts", "event_id"],
            {"nth": F.lit(1), "extra_seconds": extra},
        )
        ends = ", ".join(map(str, PHASE_ENDS))
        return (
            ordered.selectExpr("*", "nth - 1 + user_id % 12 AS step")
            .selectExpr("*", "cast(step % 12 as int) AS phase")
            .selectExpr(
                "event_id",
                "user_id",
                "event_type",
                """CASE WHEN event_type = 'signup' AND event_id % 3 = 0 THEN 'road'
                    WHEN event_type = 'error' AND event_id % 3 = 0 AND phase = 8 THEN 'overlap'
                    WHEN event_type = 'error' AND event_id % 3 = 1 AND phase IN (10, 11) THEN 'overlap'
                    WHEN event_type = 'error' AND event_id % 3 = 2 AND phase = 9 THEN 'overlap'
                    WHEN phase <= 3 THEN 'loader'
                    WHEN phase BETWEEN 6 AND 9 THEN 'dump'
                    ELSE 'road' END AS place""",
                """CASE WHEN event_type = 'purchase' AND event_id % 5 = 0 AND phase IN (2, 8) THEN 3
                    WHEN event_type = 'error' AND event_id % 3 = 2 AND phase = 9 THEN 2
                    WHEN phase IN (1, 2, 7, 8) THEN 2
                    ELSE 3 END AS work_state_id""",
                _after_epoch(
                    f"step div 12 * {ROUND_SECONDS} + get(array({ends}), phase) + extra_seconds"
                )
                + " AS timestamp",
            )
        )

    def _courses(self) -> DataFrame:
        """Rows of the trucks that follow a course."""
        lists = ", ".join(
            f"array({', '.join(f'struct({at} AS second, {place!r} AS place, {state} AS work_state_id)' for at, place, state in course)})"
            for course in COURSES
        )
        return (
            self.table("customer")
            .where("c_custkey % 20 = 3")
            .selectExpr("c_custkey AS user_id", f"posexplode(get(array({lists}), cast(c_custkey div 20 % {len(COURSES)} as int))) AS (nth, step)")
            .selectExpr(
                "2000000014 + user_id * 100 + nth AS event_id", "user_id", "'' AS event_type", "step.place", "step.work_state_id",
                _after_epoch("user_id % 3 * 600 + step.second") + " AS timestamp",
            )
        )

    def telemetry(self) -> DataFrame:
        """Decoded telemetry with the payload's site, which may be missing."""
        base = "(-23e0 + (user_id % 5) * 5e-1)"
        return self._placed_events().unionByName(self._courses()).selectExpr(
            "event_id AS seq",
            "concat('A', cast(user_id as string)) AS asset_guid",
            f"CASE WHEN event_id % 17 <> 0 THEN {_site('user_id')} END AS site_guid",
            "timestamp",
            "work_state_id",
            "CASE WHEN place = 'overlap' THEN 13301e-2"
            " ELSE 133e0 + ((user_id div 5 + if(place like 'other%', 1, 0)) % 2) * 1e-2 END AS longitude",
            f"""CASE WHEN event_type = 'click' AND event_id % 97 = 0 THEN 95e0
                WHEN place like '%loader' THEN {base} + 1e-4
                WHEN place like '%dump' THEN {base} + 1e-1
                WHEN place = 'overlap' THEN {base} + 1016e-4
                ELSE {base} + 5e-2 END AS latitude""",
        )

    def rows_per_asset(self) -> DataFrame:
        """At least the number of telemetry rows of each asset."""
        asset = "concat('A', cast({} as string)) AS asset_guid"
        counted = self.table("events").selectExpr(asset.format("user_id"), "1 AS n")
        most = max(map(len, COURSES))
        courses = self.table("customer").where("c_custkey % 20 = 3").selectExpr(asset.format("c_custkey"), f"{most} AS n")
        return counted.unionByName(courses).groupBy("asset_guid").agg(F.sum("n").alias("n"))

    def telemetry_raw(self) -> DataFrame:
        """Telemetry as JSON payloads, some of them broken in each known way."""

        return (
            self.telemetry()
            .selectExpr(
                "*",
                "seq % 50 AS kind",
                "date_format(timestamp, \"yyyy-MM-dd'T'HH:mm:ss\") AS stamp",
            )
            .selectExpr(
                "*",
                """CASE kind WHEN 12 THEN '' ELSE concat('"asset_guid": "', asset_guid, '", ') END AS asset_text""",
                """CASE kind WHEN 10 THEN concat(stamp, '+05:00') WHEN 11 THEN 'yesterday'
                    ELSE concat(stamp, 'Z') END AS time_text""",
                """CASE kind WHEN 8 THEN '"3.0"' WHEN 9 THEN '3.7' WHEN 13 THEN '" 2 "'
                    ELSE cast(work_state_id as string) END AS state_text""",
                """coalesce(concat('"', site_guid, '"'), 'null') AS site_text""",
            )
            .selectExpr(
                "*",
                """concat('{', asset_text, '"site_guid": ', site_text, ', "timestamp": "', time_text,
                    '", "work_state_id": ', state_text, ', "longitude": ', cast(longitude as string),
                    ', "latitude": ', cast(latitude as string), '}') AS plain""",
            )
            .selectExpr(
                "concat('shard-', cast(cast(substring(asset_guid, 2) as bigint) % 4 as string)) AS shard",
                "seq div 2 AS sequence_number",
                "seq % 2 AS sub_sequence_number",
                "asset_guid AS partition_key",
                # An array holds the payload and something that is no telemetry.
                """CASE WHEN kind = 0 THEN '' WHEN kind = 1 THEN 'null' WHEN kind = 2 THEN '{}'
                    WHEN kind = 3 THEN '[]' WHEN kind = 4 THEN '{"asset_guid": "A' WHEN kind = 7 THEN '12'
                    ELSE concat(if(kind IN (5, 6), '[', ''), plain,
                        CASE kind WHEN 5 THEN ', {"note": 1}]' WHEN 6 THEN ', 7, {}]' ELSE '' END) END AS data""",
            )
        )

    # --- assets and loaders ---------------------------------------------------

    def assets(self) -> DataFrame:
        people = self.table("customer").selectExpr(
            "concat('A', cast(c_custkey as string)) AS guid",
            f"{_site('c_custkey')} AS site_guid",
            "concat('C', cast(c_custkey % 3 as string)) AS client_guid",
            f"if(c_custkey % 10 <> 9, '{self.cfg.truck_type}', 'dozer') AS asset_type_guid",
        )
        loaders = self._loader_spots().selectExpr(
            "asset_guid AS guid",
            "site_guid",
            "'C0' AS client_guid",
            f"'{self.cfg.loader_type}' AS asset_type_guid",
        )
        return people.unionByName(loaders)

    def _loader_spots(self) -> DataFrame:
        """Loaders by site and slot, and one per site inside its second dump."""
        working = self.table("supplier").selectExpr(
            "concat('L', cast(s_suppkey as string)) AS asset_guid",
            f"{_site('s_suppkey')} AS site_guid",
            "s_suppkey AS number",
            "-23e0 + (s_suppkey % 5) * 5e-1 AS latitude",
            "133e0 + (s_suppkey div 5) * 1e-2 AS longitude",
        )
        parked = self.table("region").selectExpr(
            "concat('P', cast(r_regionkey as string)) AS asset_guid",
            f"{_site('r_regionkey')} AS site_guid",
            "cast(r_regionkey as bigint) + 1000000 AS number",
            "-23e0 + (r_regionkey % 5) * 5e-1 + 1015e-4 AS latitude",
            "13301e-2 AS longitude",
        )
        return working.unionByName(parked)

    def process_info(self) -> DataFrame:
        """Progress rows of both jobs; the idle job's rows carry loader positions."""
        loaders = self._loader_spots().selectExpr(
            "number * 10 AS tx_process_info_id",
            f"'{self.cfg.idle_process}' AS process_name",
            f"{_after_epoch('number % 60')} AS process_date",
            "asset_guid",
            "site_guid",
            f"'{self.cfg.loader_type}' AS asset_type_guid",
            "CASE WHEN number % 13 <> 12 THEN latitude END AS current_latitude",
            "longitude AS current_longitude",
        )
        trucks = (
            self.table("customer")
            .where("c_custkey % 4 <> 3")
            .selectExpr("c_custkey", "explode(sequence(0, cast(c_custkey % 2 as int))) AS version")
            .selectExpr(
                "c_custkey * 10 + version + 100000000 AS tx_process_info_id",
                f"'{self.cfg.cycle_process}' AS process_name",
                f"{_after_epoch('c_custkey % 7 * 600 + version * 60')} AS process_date",
                "concat('A', cast(c_custkey as string)) AS asset_guid",
                f"{_site('c_custkey')} AS site_guid",
                f"'{self.cfg.truck_type}' AS asset_type_guid",
                "cast(null as double) AS current_latitude",
                "cast(null as double) AS current_longitude",
            )
        )
        return loaders.unionByName(trucks)

    def loader_idle(self) -> DataFrame:
        """Three stops per loader, an hour and some metres apart."""
        return (
            self._loader_spots()
            .selectExpr("*", "explode(sequence(0, 2)) AS nth")
            .selectExpr(
                "asset_guid",
                f"{_after_epoch('nth * 3600')} AS start_state_utc",
                f"CASE WHEN nth < 2 THEN {_after_epoch('nth * 3600 + 1800')} END AS end_state_utc",
                "CASE WHEN NOT (number % 11 = 10 AND nth = 1) THEN latitude + nth * 5e-5 END"
                " AS end_location_latitude",
                "longitude AS end_location_longitude",
            )
        )

    # --- regions --------------------------------------------------------------

    def _region_rings(self) -> DataFrame:
        corners = [(-2000, -2000), (2000, -2000), (2000, 2000), (-2000, 2000), (-2000, -2000)]
        ring = ", ".join(
            f"concat({_degrees_text(f'lon + ({dx})')}, ' ', {_degrees_text(f'lat + ({dy})')})"
            for dx, dy in corners
        )
        return (
            self.table("nation")
            .selectExpr(
                "cast(n_nationkey as bigint) AS number",
                "cast(n_regionkey as bigint) AS place",
                "n_name AS region_name",
                """cast(-23000000 + n_regionkey * 500000 + CASE WHEN n_nationkey % 2 = 0 THEN 100000
                    WHEN n_nationkey div 10 = 1 THEN 3000 ELSE 0 END as bigint) AS lat""",
                "cast(133000000 + n_nationkey div 10 * 10000 as bigint) AS lon",
            )
            .selectExpr(
                "number",
                "place",
                "concat('R', cast(number as string)) AS region_guid",
                f"{_site('place')} AS site_guid",
                "region_name",
                """CASE WHEN number % 2 = 0 THEN if(number % 3 = 0, 'DUMP', 'dump')
                    ELSE if(number % 3 = 0, 'Load', 'load') END AS region_type""",
                f"concat_ws(', ', {ring}) AS points",
            )
        )

    def region_store(self) -> DataFrame:
        """Regions of each site as JSON values of a key-value store."""
        good = self._region_rings().selectExpr(
            "site_guid",
            "region_guid",
            """concat('{"region_guid": "', region_guid, '", "region_name": "', region_name,
                '", "region_type": "', region_type, '", "points": "', points, '"}') AS payload""",
        )
        odd = [
            ("B", "Dump", "133 -23, x y"),
            ("T", "Load", "133 -23, 134 -23"),
            ("M", "dump", "133  -23, 134 -23, 134 -22"),
            ("O", "load", " , ,"),
            ("E", "dump", ""),
            ("X", "fuel", "133 -23, 134 -23, 134 -22"),
        ]
        rows = [
            f"""struct(concat('{letter}', n) AS region_guid, concat('{{"region_guid": "{letter}', n,
                '", "region_name": "odd", "region_type": "{kind}", "points": "{points}"}}') AS payload)"""
            for letter, kind, points in odd
        ]
        rows.append("""struct(concat('J', n) AS region_guid, concat('{"region_guid": "J', n) AS payload)""")
        rows.append("struct(concat('N', n) AS region_guid, '[1]' AS payload)")
        broken = (
            self.table("region")
            .selectExpr("cast(r_regionkey as string) AS n", f"{_site('r_regionkey')} AS site_guid")
            .selectExpr("site_guid", f"inline(array({', '.join(rows)}))")
        )
        return good.unionByName(broken)

    def region_sites(self) -> DataFrame:
        """Region attributes used to find the site of an asset."""
        return self._region_rings().selectExpr(
            "region_guid",
            "CASE WHEN number % 11 <> 5 THEN site_guid END AS site_guid",
            """CASE WHEN number % 7 <> 0 THEN concat('2023-', lpad(cast(number % 12 + 1 as string), 2, '0'),
                '-01T00:00:00') END AS created_date""",
        )

    def asset_regions(self) -> DataFrame:
        """Which regions an asset belongs to: its own site's, for some also the next's."""
        members = (
            self.table("customer")
            .where("c_custkey % 3 = 0")
            .selectExpr(
                "concat('A', cast(c_custkey as string)) AS asset_guid",
                """explode(if(c_custkey % 6 = 0, array(c_custkey % 5, (c_custkey + 1) % 5),
                    array(c_custkey % 5))) AS place""",
            )
        )
        return members.join(self._region_rings(), "place").select("asset_guid", "region_guid")

    def region_master(self) -> DataFrame:
        """Region definitions in two versions, some deleted or without points."""
        return (
            self._region_rings()
            .selectExpr("*", "explode(array(0, 1)) AS version")
            .selectExpr(
                "region_guid AS guid",
                "site_guid",
                "CASE WHEN NOT (number % 8 = 7 AND version = 1) THEN points END AS points",
                "1000e0 - number * 105e-1 + version AS fence_area",
                "number % 9 = 0 AS is_deleted",
                f"{_after_epoch('number * 60 + version * 3600')} AS created_date",
            )
        )

    def ref_site(self) -> DataFrame:
        return self.table("region").selectExpr(f"{_site('r_regionkey')} AS guid")
