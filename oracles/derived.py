"""The derived inputs once more, as DuckDB common table expressions."""

from __future__ import annotations

from haulwright.config import DEFAULT
from haulwright.sources.derived import COURSES, PHASE_ENDS, ROUND_SECONDS


def _site(key: str) -> str:
    return f"'S' || CAST(({key}) % 5 AS VARCHAR)"


def _at(seconds: str) -> str:
    return f"make_timestamp(1704067200000000 + CAST({seconds} AS BIGINT) * 1000000)"


def _deg(millionths: str) -> str:
    size = f"abs({millionths})"
    return (
        f"(CASE WHEN ({millionths}) < 0 THEN '-' ELSE '' END || CAST({size} // 1000000 AS VARCHAR)"
        f" || '.' || lpad(CAST({size} % 1000000 AS VARCHAR), 6, '0'))"
    )


def _payload(asset: bool = True, at: str = "stamp || 'Z'", state: str = "CAST(work_state_id AS VARCHAR)") -> str:
    return (
        "('{' || "
        + ("'\"asset_guid\": \"' || asset_guid || '\", ' || " if asset else "")
        + "'\"site_guid\": ' || coalesce('\"' || site_guid || '\"', 'null') || "
        f"', \"timestamp\": \"' || {at} || '\", \"work_state_id\": ' || {state} || "
        "', \"longitude\": ' || CAST(longitude AS VARCHAR) || "
        "', \"latitude\": ' || CAST(latitude AS VARCHAR) || '}')"
    )


def _ring() -> str:
    corners = [(-2000, -2000), (2000, -2000), (2000, 2000), (-2000, 2000), (-2000, -2000)]
    return " || ', ' || ".join(
        f"{_deg(f'lon + ({dx})')} || ' ' || {_deg(f'lat + ({dy})')}" for dx, dy in corners
    )


def _odd() -> str:
    odd = [
        ("B", "Dump", "133 -23, x y"),
        ("T", "Load", "133 -23, 134 -23"),
        ("M", "dump", "133  -23, 134 -23, 134 -22"),
        ("O", "load", " , ,"),
        ("E", "dump", ""),
        ("X", "fuel", "133 -23, 134 -23, 134 -22"),
    ]
    selects = [
        f"""SELECT {_site('r_regionkey')} AS site_guid, '{letter}' || r_regionkey AS region_guid,
            '{{"region_guid": "{letter}' || r_regionkey || '", "region_name": "odd", "region_type": "{kind}", "points": "{points}"}}' AS payload FROM region"""
        for letter, kind, points in odd
    ]
    selects.append(
        f"""SELECT {_site('r_regionkey')}, 'J' || r_regionkey, '{{"region_guid": "J' || r_regionkey FROM region"""
    )
    selects.append(f"SELECT {_site('r_regionkey')}, 'N' || r_regionkey, '[1]' FROM region")
    return " UNION ALL ".join(selects)


_ENDS = ", ".join(map(str, PHASE_ENDS))
_COURSES = ", ".join(
    f"({k}, {nth}, {second}, {place!r}, {state})" for k, course in enumerate(COURSES) for nth, (second, place, state) in enumerate(course)
)
_BASE = "(-23e0 + (user_id % 5) * 5e-1)"

# name -> (names it reads, text)
CTES: dict[str, tuple[list[str], str]] = {
    "steps": ([], """
        SELECT event_id, user_id, event_type,
            row_number() OVER w - 1 + user_id % 12 AS step,
            CAST(sum(event_id % 5
                + CASE WHEN value > 110 THEN CASE WHEN event_id % 2 = 0 THEN 1300 ELSE 700 END ELSE 0 END
                + CASE WHEN event_type = 'error' THEN 40 ELSE 0 END) OVER w AS BIGINT) AS extra_seconds
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"""),
    "spots": (["steps"], f"""
        SELECT event_id, user_id, event_type, step, step % 12 AS phase,
            CASE WHEN event_type = 'signup' AND event_id % 3 = 0 THEN 'road'
                WHEN event_type = 'error' AND event_id % 3 = 0 AND step % 12 = 8 THEN 'overlap'
                WHEN event_type = 'error' AND event_id % 3 = 1 AND step % 12 IN (10, 11) THEN 'overlap'
                WHEN event_type = 'error' AND event_id % 3 = 2 AND step % 12 = 9 THEN 'overlap'
                WHEN step % 12 <= 3 THEN 'loader'
                WHEN step % 12 BETWEEN 6 AND 9 THEN 'dump' ELSE 'road' END AS place,
            CASE WHEN event_type = 'purchase' AND event_id % 5 = 0 AND step % 12 IN (2, 8) THEN 3
                WHEN event_type = 'error' AND event_id % 3 = 2 AND step % 12 = 9 THEN 2
                WHEN step % 12 IN (1, 2, 7, 8) THEN 2 ELSE 3 END AS work_state_id,
            {_at(f'step // 12 * {ROUND_SECONDS} + [{_ENDS}][step % 12 + 1] + extra_seconds')} AS tick
        FROM steps"""),
    "on_course": ([], f"""
        SELECT CAST(2000000014 + c_custkey * 100 + nth AS BIGINT) AS event_id, c_custkey AS user_id, '' AS event_type,
            place, work_state_id, {_at('c_custkey % 3 * 600 + second')} AS tick
        FROM customer JOIN (VALUES {_COURSES}) v(course, nth, second, place, work_state_id)
            ON course = c_custkey // 20 % {len(COURSES)}
        WHERE c_custkey % 20 = 3"""),
    "telemetry": (["spots", "on_course"], f"""
        SELECT event_id AS seq, 'A' || CAST(user_id AS VARCHAR) AS asset_guid,
            CASE WHEN event_id % 17 <> 0 THEN {_site('user_id')} END AS site_guid,
            tick AS "timestamp", work_state_id,
            CASE WHEN place = 'overlap' THEN 13301e-2
                ELSE 133e0 + ((user_id // 5 + CASE WHEN place LIKE 'other%' THEN 1 ELSE 0 END) % 2) * 1e-2 END AS longitude,
            CASE WHEN event_type = 'click' AND event_id % 97 = 0 THEN 95e0
                WHEN place LIKE '%loader' THEN {_BASE} + 1e-4 WHEN place LIKE '%dump' THEN {_BASE} + 1e-1
                WHEN place = 'overlap' THEN {_BASE} + 1016e-4 ELSE {_BASE} + 5e-2 END AS latitude
        FROM (SELECT event_id, user_id, event_type, place, work_state_id, tick FROM spots
            UNION ALL SELECT event_id, user_id, event_type, place, work_state_id, tick FROM on_course)"""),
    "raw": (["telemetry"], f"""
        SELECT 'shard-' || CAST(CAST(substr(asset_guid, 2) AS BIGINT) % 4 AS VARCHAR) AS shard,
            seq // 2 AS sequence_number, seq % 2 AS sub_sequence_number,
            CASE seq % 50 WHEN 0 THEN '' WHEN 1 THEN 'null' WHEN 2 THEN '{{}}' WHEN 3 THEN '[]'
                WHEN 4 THEN '{{"asset_guid": "A'
                WHEN 5 THEN '[' || {_payload()} || ', {{"note": 1}}]'
                WHEN 6 THEN '[' || {_payload()} || ', 7, {{}}]'
                WHEN 7 THEN '12'
                WHEN 8 THEN {_payload(state="'" + '"3.0"' + "'")}
                WHEN 9 THEN {_payload(state="'3.7'")}
                WHEN 10 THEN {_payload(at="stamp || '+05:00'")}
                WHEN 11 THEN {_payload(at="'yesterday'")}
                WHEN 12 THEN {_payload(asset=False)}
                WHEN 13 THEN {_payload(state="'" + '" 2 "' + "'")}
                ELSE {_payload()} END AS data
        FROM (SELECT *, strftime("timestamp", '%Y-%m-%dT%H:%M:%S') AS stamp FROM telemetry)"""),
    "loader_spots": ([], f"""
        SELECT 'L' || CAST(s_suppkey AS VARCHAR) AS asset_guid, {_site('s_suppkey')} AS site_guid,
            s_suppkey AS number, -23e0 + (s_suppkey % 5) * 5e-1 AS latitude,
            133e0 + (s_suppkey // 5) * 1e-2 AS longitude FROM supplier
        UNION ALL
        SELECT 'P' || CAST(r_regionkey AS VARCHAR), {_site('r_regionkey')}, r_regionkey + 1000000,
            -23e0 + (r_regionkey % 5) * 5e-1 + 1015e-4, 13301e-2 FROM region"""),
    "assets": (["loader_spots"], f"""
        SELECT 'A' || CAST(c_custkey AS VARCHAR) AS guid, {_site('c_custkey')} AS site_guid,
            'C' || CAST(c_custkey % 3 AS VARCHAR) AS client_guid,
            CASE WHEN c_custkey % 10 <> 9 THEN '{DEFAULT.truck_type}' ELSE 'dozer' END AS asset_type_guid
        FROM customer
        UNION ALL SELECT asset_guid, site_guid, 'C0', '{DEFAULT.loader_type}' FROM loader_spots"""),
    "progress": (["loader_spots"], f"""
        SELECT number * 10 AS tx_process_info_id, '{DEFAULT.idle_process}' AS process_name,
            {_at('number % 60')} AS process_date, asset_guid, site_guid,
            '{DEFAULT.loader_type}' AS asset_type_guid,
            CASE WHEN number % 13 <> 12 THEN latitude END AS current_latitude,
            longitude AS current_longitude FROM loader_spots
        UNION ALL
        SELECT c_custkey * 10 + version + 100000000, '{DEFAULT.cycle_process}',
            {_at('c_custkey % 7 * 600 + version * 60')},
            'A' || CAST(c_custkey AS VARCHAR), {_site('c_custkey')}, '{DEFAULT.truck_type}', NULL, NULL
        FROM customer, (VALUES (0), (1)) v(version)
        WHERE c_custkey % 4 <> 3 AND version <= c_custkey % 2"""),
    "loader_idle": (["loader_spots"], f"""
        SELECT asset_guid, {_at('nth * 3600')} AS start_state_utc,
            CASE WHEN nth < 2 THEN {_at('nth * 3600 + 1800')} END AS end_state_utc,
            CASE WHEN NOT (number % 11 = 10 AND nth = 1) THEN latitude + nth * 5e-5 END AS end_location_latitude,
            longitude AS end_location_longitude
        FROM loader_spots, (VALUES (0), (1), (2)) v(nth)"""),
    "rings": ([], f"""
        SELECT number, place, 'R' || CAST(number AS VARCHAR) AS region_guid, {_site('place')} AS site_guid,
            n_name AS region_name,
            CASE WHEN number % 2 = 0 THEN CASE WHEN number % 3 = 0 THEN 'DUMP' ELSE 'dump' END
                ELSE CASE WHEN number % 3 = 0 THEN 'Load' ELSE 'load' END END AS region_type,
            {_ring()} AS points
        FROM (SELECT n_nationkey AS number, n_regionkey AS place, n_name,
            -23000000 + n_regionkey * 500000 + CASE WHEN n_nationkey % 2 = 0 THEN 100000
                WHEN n_nationkey // 10 = 1 THEN 3000 ELSE 0 END AS lat,
            133000000 + n_nationkey // 10 * 10000 AS lon FROM nation)"""),
    "store": (["rings"], f"""
        SELECT site_guid, region_guid, '{{"region_guid": "' || region_guid || '", "region_name": "'
            || region_name || '", "region_type": "' || region_type || '", "points": "' || points || '"}}' AS payload
        FROM rings UNION ALL {_odd()}"""),
    "region_sites": (["rings"], """
        SELECT region_guid, CASE WHEN number % 11 <> 5 THEN site_guid END AS site_guid,
            CASE WHEN number % 7 <> 0 THEN '2023-' || lpad(CAST(number % 12 + 1 AS VARCHAR), 2, '0')
                || '-01T00:00:00' END AS created_date FROM rings"""),
    "asset_regions": (["rings"], """
        SELECT 'A' || CAST(c_custkey AS VARCHAR) AS asset_guid, region_guid
        FROM customer JOIN rings ON place = c_custkey % 5
            OR (c_custkey % 6 = 0 AND place = (c_custkey + 1) % 5)
        WHERE c_custkey % 3 = 0"""),
    "region_master": (["rings"], f"""
        SELECT region_guid AS guid, site_guid,
            CASE WHEN NOT (number % 8 = 7 AND version = 1) THEN points END AS points,
            1000e0 - number * 105e-1 + version AS fence_area, number % 9 = 0 AS is_deleted,
            {_at('number * 60 + version * 3600')} AS created_date
        FROM rings, (VALUES (0), (1)) v(version)"""),
    "regions": (["store"], """
        SELECT site_guid, payload ->> 'region_guid' AS region_guid, payload ->> 'region_name' AS region_name,
            lower(payload ->> 'region_type') AS region_type, payload ->> 'points' AS points
        FROM store WHERE json_valid(payload) AND json_type(payload) = 'OBJECT'
            AND lower(payload ->> 'region_type') IN ('load', 'dump')
            AND coalesce(payload ->> 'points', '') <> '' AND coalesce(payload ->> 'region_guid', '') <> ''"""),
    "latest_site": (["asset_regions", "region_sites"], """
        SELECT asset_guid, arg_max(site_guid, {'d': coalesce(created_date, ''), 'g': region_guid}) AS site_guid
        FROM asset_regions JOIN region_sites USING (region_guid) WHERE site_guid <> '' GROUP BY asset_guid"""),
    "resolved": (["telemetry", "latest_site", "assets"], """
        SELECT t.* REPLACE (coalesce(t.site_guid, l.site_guid, a.site_guid) AS site_guid)
        FROM telemetry t LEFT JOIN latest_site l ON l.asset_guid = t.asset_guid
        LEFT JOIN assets a ON a.guid = t.asset_guid
        WHERE coalesce(t.site_guid, l.site_guid, a.site_guid) IS NOT NULL"""),
    "trucks": (["resolved", "assets"], f"""
        SELECT r.* FROM resolved r WHERE EXISTS (SELECT 1 FROM assets a WHERE a.guid = r.asset_guid
            AND a.site_guid = r.site_guid AND a.asset_type_guid = '{DEFAULT.truck_type}')"""),
    "loaders": (["progress"], f"""
        SELECT asset_guid, site_guid, current_latitude AS latitude, current_longitude AS longitude
        FROM progress WHERE process_name = '{DEFAULT.idle_process}' AND asset_type_guid = '{DEFAULT.loader_type}'
            AND current_latitude IS NOT NULL AND current_longitude IS NOT NULL"""),
    "validity": (["loader_idle", "assets"], f"""
        SELECT asset_guid, site_guid, valid_from,
            lead(valid_from) OVER (PARTITION BY asset_guid ORDER BY valid_from) AS valid_to, latitude, longitude
        FROM (SELECT i.asset_guid, a.site_guid, coalesce(end_state_utc, start_state_utc) AS valid_from,
            end_location_latitude AS latitude, end_location_longitude AS longitude
            FROM loader_idle i JOIN assets a ON a.guid = i.asset_guid AND a.asset_type_guid = '{DEFAULT.loader_type}'
            WHERE end_location_latitude IS NOT NULL AND end_location_longitude IS NOT NULL)"""),
    "checked": (["trucks", "loaders"], """
        SELECT t.*, NOT (latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180)
            AND site_guid IN (SELECT site_guid FROM loaders) AS bad_position FROM trucks t"""),
    "checked_asof": (["trucks", "validity"], """
        SELECT t.*, NOT (latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180)
            AND EXISTS (SELECT 1 FROM validity v WHERE v.site_guid = t.site_guid
                AND v.valid_from <= date_trunc('second', t."timestamp")) AS bad_position FROM trucks t"""),
    "pieces": (["regions"], r"""
        SELECT site_guid, region_guid, region_type, nth, pair, string_split(pair, ' ') AS parts
        FROM (SELECT site_guid, region_guid, region_type,
            unnest(generate_series(1, len(string_split(points, ',')))) AS nth,
            regexp_replace(unnest(string_split(points, ',')), '^\s+|\s+$', '', 'g') AS pair FROM regions)"""),
    "judged": (["pieces"], r"""
        SELECT *, CASE WHEN pair = '' THEN NULL WHEN len(parts) <> 2 THEN 'malformed'
            WHEN try_cast(parts[1] AS DOUBLE) IS NULL OR try_cast(parts[2] AS DOUBLE) IS NULL THEN 'non_numeric' END AS bad
        FROM pieces"""),
    "shapes": (["judged"], """
        SELECT site_guid, region_guid, region_type, n_points,
            CASE WHEN n_points = 0 AND blank THEN 'no_points' WHEN first_bad IS NOT NULL THEN first_bad
                WHEN n_points = 0 THEN 'no_points' WHEN n_points < 3 THEN 'too_few_points' END AS parse_error,
            min_lon, max_lon, min_lat, max_lat
        FROM (SELECT site_guid, region_guid, region_type, count(*) FILTER (WHERE pair <> '') AS n_points,
            bool_and(pair = '') AS blank, arg_min(bad, nth) FILTER (WHERE bad IS NOT NULL) AS first_bad,
            min(try_cast(parts[1] AS DOUBLE)) AS min_lon, max(try_cast(parts[1] AS DOUBLE)) AS max_lon,
            min(try_cast(parts[2] AS DOUBLE)) AS min_lat, max(try_cast(parts[2] AS DOUBLE)) AS max_lat
            FROM judged GROUP BY ALL)"""),
    "edges": (["judged", "shapes"], """
        SELECT site_guid, region_guid, region_type, x AS x1, y AS y1,
            coalesce(lead(x) OVER w, first_value(x) OVER w) AS x2,
            coalesce(lead(y) OVER w, first_value(y) OVER w) AS y2
        FROM (SELECT j.site_guid, j.region_guid, j.region_type, nth, CAST(parts[1] AS DOUBLE) AS x,
            CAST(parts[2] AS DOUBLE) AS y FROM judged j JOIN shapes s USING (region_guid, site_guid)
            WHERE s.parse_error IS NULL AND pair <> '')
        WINDOW w AS (PARTITION BY site_guid, region_guid ORDER BY nth)"""),
}

_METRES = (
    "(6371000.0 * (2 * atan2(sqrt({a}), sqrt(1 - {a}))))"
)


def metres(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (
        f"(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * pow(sin(radians({lon2} - {lon1}) / 2), 2))"
    )
    return _METRES.format(a=a)


def _in_ring(lon: str, lat: str) -> str:
    return f"""(sum(CASE WHEN (e.y1 > {lat}) <> (e.y2 > {lat})
            AND {lon} < (e.x2 - e.x1) * ({lat} - e.y1) / nullif(e.y2 - e.y1, 0) + e.x1 THEN 1 ELSE 0 END) % 2 = 1
        OR bool_or((e.x2 - e.x1) * ({lat} - e.y1) - (e.y2 - e.y1) * ({lon} - e.x1) = 0
            AND {lon} BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2)
            AND {lat} BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2)))"""


_T = (
    "greatest(0, least(1, coalesce(((t.longitude - e.x1) * (e.x2 - e.x1) + (t.latitude - e.y1) * (e.y2 - e.y1))"
    " / nullif(pow(e.x2 - e.x1, 2) + pow(e.y2 - e.y1, 2), 0), 0)))"
)
_TO_EDGE = (
    f"sqrt(pow(t.longitude - (e.x1 + {_T} * (e.x2 - e.x1)), 2)"
    f" + pow(t.latitude - (e.y1 + {_T} * (e.y2 - e.y1)), 2))"
)


def _near(rows: str, loaders: str, extra: str = "true") -> str:
    """Rows with the nearest loader within 30 m."""
    return f"""
        SELECT t.*, n.guid AS loader_guid, n.latitude AS loader_latitude, n.longitude AS loader_longitude,
            n.distance AS loader_distance
        FROM {rows} t LEFT JOIN (
            SELECT seq, best.guid AS guid, best.latitude AS latitude, best.longitude AS longitude,
                best.distance AS distance
            FROM (SELECT seq, arg_min({{'guid': guid, 'latitude': latitude, 'longitude': longitude,
                    'distance': distance}}, {{'distance': distance, 'guid': guid}}) AS best
                FROM (SELECT t.seq, p.asset_guid AS guid, p.latitude, p.longitude,
                        {metres('t.latitude', 't.longitude', 'p.latitude', 'p.longitude')} AS distance
                    FROM {rows} t JOIN {loaders} p ON p.site_guid = t.site_guid
                        AND abs(p.latitude - t.latitude) < 0.001 AND {extra}
                    WHERE NOT t.bad_position)
                WHERE distance <= 30 GROUP BY seq)) n ON n.seq = t.seq"""


def _located(near: str) -> str:
    return f"""
        SELECT t.*, l.region_guid AS load_region_guid, coalesce(l.inside, false) AS in_load_region,
            CASE WHEN l.inside THEN 0 ELSE l.metres END AS load_region_distance,
            d.region_guid AS dump_region_guid
        FROM {near} t
        LEFT JOIN (SELECT seq, b.region_guid AS region_guid, b.inside AS inside, b.metres AS metres FROM (
            SELECT seq, arg_min({{'region_guid': region_guid, 'inside': inside, 'metres': metres}},
                {{'o': NOT inside, 'm': CASE WHEN inside THEN 0 ELSE metres END, 'g': region_guid}}) AS b
            FROM (SELECT t.seq, e.region_guid, {_in_ring('t.longitude', 't.latitude')} AS inside,
                    min({_TO_EDGE}) * 111320 AS metres
                FROM {near} t JOIN edges e ON e.site_guid = t.site_guid AND e.region_type = 'load'
                WHERE t.loader_guid IS NOT NULL AND t.latitude <> t.longitude
                GROUP BY t.seq, e.region_guid) GROUP BY seq)) l ON l.seq = t.seq
        LEFT JOIN (SELECT seq, min(region_guid) AS region_guid
            FROM (SELECT t.seq, e.region_guid, {_in_ring('t.longitude', 't.latitude')} AS inside
                FROM {near} t JOIN edges e ON e.site_guid = t.site_guid AND e.region_type = 'dump'
                WHERE t.latitude <> t.longitude GROUP BY t.seq, e.region_guid)
            WHERE inside GROUP BY seq) d ON d.seq = t.seq"""


def _placed(located: str) -> str:
    return f"""
        SELECT t.*, coalesce(c.colocated, false) AS colocated,
            CASE WHEN loader_guid IS NOT NULL AND dump_region_guid IS NOT NULL THEN 'OVERLAP'
                WHEN loader_guid IS NOT NULL THEN 'LOAD' WHEN dump_region_guid IS NOT NULL THEN 'DUMP'
                ELSE 'TRAVEL' END AS area
        FROM {located} t LEFT JOIN (
            SELECT t.seq, {_in_ring('t.loader_longitude', 't.loader_latitude')} AS colocated
            FROM {located} t JOIN edges e ON e.site_guid = t.site_guid AND e.region_guid = t.dump_region_guid
            WHERE t.loader_guid IS NOT NULL GROUP BY t.seq) c ON c.seq = t.seq"""


CTES["near"] = (["checked", "loaders"], _near("checked", "loaders"))
CTES["located"] = (["near", "edges"], _located("near"))
CTES["placed"] = (["located", "edges"], _placed("located"))
_HELD = (
    "p.valid_from <= date_trunc('second', t.\"timestamp\")"
    " AND (p.valid_to IS NULL OR date_trunc('second', t.\"timestamp\") < p.valid_to)"
)
CTES["near_asof"] = (["checked_asof", "validity"], _near("checked_asof", "validity", _HELD))
CTES["located_asof"] = (["near_asof", "edges"], _located("near_asof"))
CTES["placed_asof"] = (["located_asof", "edges"], _placed("located_asof"))


def with_ctes(needs: list[str], body: str, recursive: str = "", telemetry: str | None = None) -> str:
    """The statement with every table it reads, directly or not, in front.

    With `telemetry`, that text over the raw payloads stands for the telemetry
    table, and the derived one, from which payloads are made, is called `sent`.
    """
    ctes = dict(CTES)
    if telemetry is not None:
        ctes["sent"] = CTES["telemetry"]
        ctes["raw"] = (["sent"], CTES["raw"][1].replace("FROM telemetry", "FROM sent"))
        ctes["telemetry"] = (["raw"], telemetry)
    done: list[str] = []

    def add(name: str) -> None:
        if name in done:
            return
        for other in ctes[name][0]:
            add(other)
        done.append(name)

    for name in needs:
        add(name)
    texts = [f"{name} AS MATERIALIZED ({ctes[name][1].strip()})" for name in done]
    if recursive:
        texts.append(recursive)
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(texts) + "\n" + body
