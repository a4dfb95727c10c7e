"""Grid lookups against brute force, at all latitudes and around the date line."""

import math
import random

import pytest

from haulwright.config import DEFAULT
from haulwright.operators import places
from haulwright.sources.regions import region_audit, region_shapes, shapes_of


def metres(lat1, lon1, lat2, lon2):
    a = (
        math.sin(math.radians(lat2 - lat1) / 2) ** 2
        + math.cos(math.radians(lat1))
        * math.cos(math.radians(lat2))
        * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    )
    return 6371000.0 * 2 * math.atan2(math.sqrt(a), math.sqrt(1 - a))


def test_haversine_between_two_cities():
    assert 554_000 < metres(37.7749, -122.4194, 34.0522, -118.2437) < 564_000


def _scatter(seed):
    """Loaders everywhere and trucks within some tens of metres of them."""
    rng = random.Random(seed)
    loaders, trucks = [], []
    anchors = [(-23.0, 133.0), (0.0, 0.00001), (60.0, 179.99995), (-75.0, -180.0),
               (89.9995, 10.0), (89.99999, -120.0), (-90.0, 0.0), (45.0, 180.0)]
    for n, (lat, lon) in enumerate(anchors):
        for k in range(6):
            dlat = rng.uniform(-0.0003, 0.0003)
            dlon = rng.uniform(-0.0003, 0.0003) / max(math.cos(math.radians(lat)), 1e-3)
            at = (max(-90.0, min(90.0, lat + dlat)), (lon + dlon + 180.0) % 360.0 - 180.0)
            loaders.append((f"L{n}{k}", "S", *at))
        for k in range(60):
            dlat = rng.uniform(-0.0006, 0.0006)
            dlon = rng.uniform(-0.0006, 0.0006) / max(math.cos(math.radians(lat)), 1e-3)
            at = (max(-90.0, min(90.0, lat + dlat)), (lon + dlon + 180.0) % 360.0 - 180.0)
            trucks.append((n * 1000 + k, "S", *at, False))
    trucks.append((99999, "other", -23.0, 133.0, False))
    return loaders, trucks


@pytest.mark.parametrize("seed", [1, 2])
def test_nearest_loader_is_the_brute_force_one(spark, seed):
    loaders, trucks = _scatter(seed)
    left = spark.createDataFrame(
        trucks, "seq bigint, site_guid string, latitude double, longitude double, bad_position boolean"
    )
    right = spark.createDataFrame(
        loaders, "asset_guid string, site_guid string, latitude double, longitude double"
    )
    found = places.with_nearest_loader(left, places.loader_cells(right), DEFAULT)
    got = {r.seq: r.guid for r in found.selectExpr("seq", "loader.guid AS guid").collect()}
    assert len(got) == len(trucks)
    hits = 0
    for seq, site, lat, lon, _ in trucks:
        near = [(metres(lat, lon, b, c), a) for a, s, b, c in loaders if s == site]
        near = [x for x in near if x[0] <= 30.0]
        want = min(near)[1] if near else None
        hits += want is not None
        assert got[seq] == want
    assert hits > 50


def _contains(ring, x, y):
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        cross = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
        if cross == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
            return True
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            odd = not odd
    return odd


def _gap(ring, x, y):
    best = math.inf
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        dx, dy = x2 - x1, y2 - y1
        t = max(0.0, min(1.0, ((x - x1) * dx + (y - y1) * dy) / (dx * dx + dy * dy)))
        best = min(best, math.hypot(x - (x1 + t * dx), y - (y1 + t * dy)))
    return best


def _rings(seed):
    """Stars and triangles of all sizes, some overlapping, two copies of one."""
    rng = random.Random(seed)
    rings = {}
    for n in range(40):
        size = rng.choice([0.001, 0.004, 0.05, 1.0])
        cx, cy = 133.0 + rng.uniform(-0.05, 0.05), -23.0 + rng.uniform(-0.05, 0.05)
        corners = rng.randint(3, 9)
        ring = []
        for k in range(corners):
            angle = 2 * math.pi * k / corners
            far = size * rng.uniform(0.4, 1.0)
            ring.append((round(cx + far * math.cos(angle), 6), round(cy + far * math.sin(angle), 6)))
        rings[f"R{n:02d}"] = ring
    rings["R98"] = rings["R05"]
    rings["R99"] = [(120.0, -40.0), (150.0, -40.0), (150.0, -10.0), (120.0, -10.0)]
    return rings


def _region_frame(spark, rings, kind):
    rows = [
        ("S", guid, None, kind, ", ".join(f"{x} {y}" for x, y in ring)) for guid, ring in rings.items()
    ]
    return spark.createDataFrame(
        rows, "site_guid string, region_guid string, region_name string, region_type string, points string"
    )


def _points(seed, n=300):
    rng = random.Random(seed)
    return [
        (k, "S", -23.0 + rng.uniform(-0.08, 0.08), 133.0 + rng.uniform(-0.08, 0.08), False)
        for k in range(n)
    ]


SCHEMA = "seq bigint, site_guid string, latitude double, longitude double, bad_position boolean"


def test_dump_region_is_the_first_one_around(spark):
    rings, points = _rings(3), _points(4)
    corner = rings["R07"][0]
    points.append((1000, "S", corner[1], corner[0], False))
    points.append((1001, "S", -23.0, -23.0, False))
    points.append((1002, "S", -30.0, 145.0, False))
    shapes = shapes_of(region_shapes(_region_frame(spark, rings, "dump")), "dump")
    cells = places.region_cells(shapes)
    assert not cells.where("NOT fine").isEmpty()
    found = places.with_dump_region(spark.createDataFrame(points, SCHEMA), cells)
    got = {r[0]: r[1] for r in found.selectExpr("seq", "dump_region.region_guid").collect()}
    for seq, _, lat, lon, _ in points:
        around = [g for g, ring in rings.items() if _contains(ring, lon, lat)]
        assert got[seq] == (min(around) if around and lat != lon else None), seq
    assert got[1000] is not None and got[1001] is None and got[1002] == "R99"


def test_load_region_is_around_or_nearest(spark):
    small = {g: r for g, r in _rings(5).items() if g != "R99"}
    rng = random.Random(6)
    loaders = [
        (f"L{k}", "S", -23.0 + rng.uniform(-0.08, 0.08), 133.0 + rng.uniform(-0.08, 0.08))
        for k in range(60)
    ]
    points = [
        (k, "S", lat + rng.uniform(-0.0002, 0.0002), lon + rng.uniform(-0.0002, 0.0002), False)
        for k, (_, _, lat, lon) in enumerate(loaders)
    ]
    cells = places.loader_cells(
        spark.createDataFrame(
            loaders, "asset_guid string, site_guid string, latitude double, longitude double"
        )
    )
    shapes = shapes_of(region_shapes(_region_frame(spark, small, "load")), "load")
    rows = places.with_nearest_loader(
        spark.createDataFrame(points, SCHEMA), places.with_load_regions(cells, shapes)
    )
    found = places.with_load_region(rows).where("loader IS NOT NULL").selectExpr(
        "seq", "load_region.guid AS guid", "load_region.outside AS outside",
        "load_region.distance AS distance", "latitude", "longitude",
    ).collect()
    assert len(found) > 30
    for r in found:
        around = [g for g, ring in small.items() if _contains(ring, r.longitude, r.latitude)]
        if around:
            assert (r.guid, r.outside, r.distance) == (min(around), False, 0.0)
        else:
            gap, guid = min((_gap(ring, r.longitude, r.latitude), g) for g, ring in small.items())
            assert (r.guid, r.outside) == (guid, True)
            assert r.distance == pytest.approx(gap * 111320.0, abs=1e-6)


def test_region_texts(spark):
    texts = {
        "good": "-122.4 37.7, -122.3 37.7, -122.35 37.8",
        "spaced": " 1 2 ,\t3 4,, 5 6 ",
        "word": "invalid-format",
        "letters": "1 2, x y, 3",
        "order": "3, x y",
        "two": "1 2, 3 4",
        "none": " , ,",
        "double space": "1  2, 3 4, 5 6",
        "java suffix": "1d 2f, 3 4, 5 6",
        "blank": "  ",
    }
    rows = [("S", g, None, "load", p) for g, p in texts.items()] + [("S", "null", None, "load", None)]
    frame = spark.createDataFrame(
        rows, "site_guid string, region_guid string, region_name string, region_type string, points string"
    )
    got = {r.region_guid: r.parse_error for r in region_audit(frame).collect()}
    assert got == {
        "good": None, "spaced": None, "word": "malformed", "letters": "non_numeric",
        "order": "malformed", "two": "too_few_points", "none": "no_points",
        "double space": "malformed", "java suffix": "non_numeric", "blank": "null_or_empty",
        "null": "null_or_empty",
    }
