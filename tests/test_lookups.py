"""Clipped rings, the region tree and spans of validity against brute force, and how much they hold and touch."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from haulwright.functions.geo import BoxGrid
from haulwright.operators import places
from tests.test_places import SCHEMA, _contains, _gap, _region_frame, _rings
from haulwright.sources.regions import region_shapes, shapes_of


def odd_rings(seed):
    """Rings with level and upright edges, on borders of cells, with repeated corners and spikes, thin and large ones."""
    r = random.Random(seed)
    rings = dict(_rings(seed))
    rings["A0"] = [(133.0, -23.0), (133.01, -23.0), (133.01, -22.99), (133.0, -22.99)]  # corners of fine cells
    rings["A1"] = [(133.0, -23.5), (134.0, -23.5), (134.0, -22.5), (133.0, -22.5)]  # corners of coarse ones
    rings["A2"] = [(133.001, -23.001), (133.001, -23.001), (133.04, -23.0010000001), (133.02, -22.98), (133.02, -22.98)]
    rings["A3"] = [(132.95, -23.0), (133.05, -23.0), (132.97, -23.0), (133.0, -22.95)]  # runs back over itself
    rings["A4"] = [(132.9, -23.01), (133.1, -23.0100001), (133.1, -23.01000005)]  # a sliver
    comb = []
    for k in range(150):
        comb += [(132.9 + k * 0.001, -23.05), (132.9 + k * 0.001 + 0.0005, r.choice([-22.95, -23.0, -23.049]))]
    rings["A5"] = [*comb, (133.1, -23.05), (133.1, -23.06), (132.9, -23.06)]
    rings["A6"] = [(130.0 + r.uniform(0, 6) if k % 2 else 133.0, -26.0 + 6 * k / 399) for k in range(400)]  # wide and jagged
    return rings


def hard_points(rings, seed):
    r = random.Random(seed)
    points = []
    for ring in rings.values():
        for (x1, y1), (x2, y2) in list(zip(ring, ring[1:] + ring[:1]))[:12]:
            t = r.random()
            points += [(y1, x1), ((y1 + y2) / 2, (x1 + x2) / 2), (y1 + t * (y2 - y1), x1 + t * (x2 - x1)), (y1, x1 + r.uniform(-0.01, 0.01))]
    for _ in range(400):
        points.append((round(-23 + r.uniform(-0.07, 0.07), r.choice([2, 3, 9])), round(133 + r.uniform(-0.12, 0.12), r.choice([2, 3, 9]))))
    for _ in range(100):
        points.append((-23 + r.uniform(-4, 4), 133 + r.uniform(-4, 4)))
    return [(k, "S", lat, lon, False) for k, (lat, lon) in enumerate(points)]


@pytest.mark.parametrize("grid", [BoxGrid(), BoxGrid(most=16, most_edges=2, ratio=20), BoxGrid(most=10**9)])
def test_clipped_rings_hold_what_whole_ones_do(spark, grid):
    rings = odd_rings(3)
    if grid.most > 10**6:  # all in fine cells
        rings = {g: ring for g, ring in rings.items() if max(x for x, _ in ring) - min(x for x, _ in ring) < 3}
    points = hard_points(rings, 4)
    shapes = shapes_of(region_shapes(_region_frame(spark, rings, "dump")), "dump")
    kinds = grid.kinds(shapes)
    assert ("dense" in kinds) == (grid.most < 10**6) and "fine" in kinds
    cells, steps = places.region_cells(shapes, grid, kinds).persist(), places.cell_steps(kinds)
    spots = spark.createDataFrame(points, SCHEMA)
    found = places.with_dump_region(places.with_dumps(spots, cells, grid, steps), cells, grid, steps)
    copies = {g: min(h for h in rings if rings[h] == rings[g]) for g in rings}
    got = {r.seq: (r.first, set(r.dumps)) for r in found.selectExpr("seq", "dump_region.region_guid AS first", "dumps").collect()}
    hits = 0
    for seq, _, lat, lon, _ in points:
        around = {copies[g] for g, ring in rings.items() if _contains(ring, lon, lat)} if lat != lon else set()
        assert got[seq] == (min(around, default=None), around), (seq, lat, lon)
        hits += len(around)
    assert hits > 1000


def test_a_ring_of_many_points_costs_each_edge_about_once(spark):
    n = 100_000
    ring = [
        (133 + (1 + 0.1 * math.sin(50 * a)) * 1.3 * math.cos(a), -23 + (1 + 0.1 * math.cos(40 * a)) * 1.3 * math.sin(a))
        for a in (2 * math.pi * k / n for k in range(n))
    ]
    shapes = shapes_of(region_shapes(_region_frame(spark, {"R": ring}, "dump")), "dump")
    clipped = BoxGrid().clipped(shapes).persist()
    sums = clipped.agg(F.sum(F.size("near")), F.max(F.size("near")), F.max(F.size("ys"))).first()
    assert n <= sums[0] < 1.1 * n and sums[1] < 2_000 and sums[2] <= 8
    r = random.Random(1)
    points = [(k, "S", -23 + r.uniform(-1.6, 1.6), 133 + r.uniform(-1.6, 1.6), False) for k in range(60)]
    points += [(100 + k, "S", y, x, False) for k, (x, y) in enumerate(ring[::5_000])]
    found = places.with_dump_region(spark.createDataFrame(points, SCHEMA), places.region_cells(shapes))
    for row in found.selectExpr("longitude AS x", "latitude AS y", "dump_region.region_guid AS hit").collect():
        assert (row.hit == "R") == _contains(ring, row.x, row.y)


def test_regions_touched_do_not_grow_with_the_site(spark):
    r = random.Random(2)
    side = 316  # about 100,000 regions, some hundred metres apart, and a crowd far away
    grid = spark.range(side * side).selectExpr(
        "'S' AS site_guid", "concat('R', lpad(id, 6, '0')) AS region_guid",
        f"130D + (id % {side}) * 0.004 AS x", f"-25D + (id div {side}) * 0.004 AS y",
    )
    crowd = spark.range(2_000).selectExpr("'S' AS site_guid", "concat('T', lpad(id, 6, '0')) AS region_guid", "135D + id * 1e-7 AS x", "-21D + id * 1e-7 AS y")
    shapes = grid.unionByName(crowd).selectExpr(
        "site_guid", "region_guid",
        "array(struct(x AS x1, y AS y1, x + 0.001 AS x2, y AS y2), struct(x + 0.001 AS x1, y AS y1, x AS x2, y + 0.001 AS y2), struct(x AS x1, y + 0.001 AS y1, x AS x2, y AS y2)) AS edges",
        "x AS min_lon", "x + 0.001 AS max_lon", "y AS min_lat", "y + 0.001 AS max_lat",
    ).persist()
    spots = [(f"L{k}", "S", -25 + r.uniform(-0.2, 1.4), 130 + r.uniform(-0.2, 1.4)) for k in range(150)]
    spots += [("F1", "S", 40.0, -100.0), ("F2", "S", -24.0, 132.0)]
    cells = places.loader_cells(spark.createDataFrame(spots, "asset_guid string, site_guid string, latitude double, longitude double")).persist()
    found = places.regions_in_reach(cells, shapes).persist()
    near = found.join(cells.where("abs(cell_lon) < 131.3 AND cell_lon > 130 AND cell_lat > -25 AND cell_lat < -23.8"), ["site_guid", "cell"], "left_semi")
    assert near.agg(F.max("n_touched")).first()[0] < 40 and near.count() > 300
    assert found.count() == cells.count()
    assert places.tree_depth(shapes) > 0 and places.tree_depth(shapes.limit(50)) == 0
    some = shapes.where("hash(region_guid) % 3000 = 0").persist()
    shown = lambda f: {(x.cell, tuple(sorted(x.load_regions))) for x in f.collect()}
    assert shown(places.regions_in_reach(cells, some, 0)) == shown(places.regions_in_reach(cells, some))
    # The nearest region of each cell's centre is among its candidates.
    boxes = {row.region_guid: (row.min_lon, row.min_lat) for row in shapes.select("region_guid", "min_lon", "min_lat").collect()}
    centres = {row.cell: (row.cell_lon, row.cell_lat) for row in cells.select("cell", "cell_lon", "cell_lat").collect()}
    for row in r.sample(found.select("cell", "load_regions").collect(), 12):
        x, y = centres[row.cell]
        near_box = min((abs(x - a) + abs(y - b), g) for g, (a, b) in boxes.items())[0]
        some = [g for g, (a, b) in boxes.items() if abs(x - a) <= 2 * near_box + 0.01 and abs(y - b) <= 2 * near_box + 0.01]
        gap = lambda g: _gap([boxes[g], (boxes[g][0] + 0.001, boxes[g][1]), (boxes[g][0], boxes[g][1] + 0.001)], x, y)
        assert min(some, key=gap) in row.load_regions or min(map(gap, row.load_regions)) <= min(map(gap, some))


def test_spans_cover_each_day_once_and_are_few(spark):
    r = random.Random(7)
    day = dt.datetime(1960, 1, 1)
    rows = []
    for k in range(200):
        begin = day + dt.timedelta(days=r.randint(0, 30_000), hours=r.randint(0, 23))
        rows.append((k, begin, begin + dt.timedelta(days=r.choice([0, 1, 2, 7, 3653, 9000]), hours=r.randint(0, 23))))
    rows.append((900, dt.datetime(2020, 1, 1), None))
    frame = spark.createDataFrame(rows, "k int, valid_from timestamp_ntz, valid_to timestamp_ntz")
    spans = {}
    for s in places.validity_spans(frame).select("k", "level", "span").collect():
        spans.setdefault(s.k, []).append((s.span << s.level, 1 << s.level))
    for k, begin, end in rows:
        assert len(spans[k]) <= 80
        if end is None:
            continue
        covered = sorted(d for first, n in spans[k] for d in range(first, first + n))
        low, high = ((t.date() - dt.date(1970, 1, 1)).days for t in (begin, end))
        assert covered == list(range(low, high + 1)) and len(spans[k]) <= 40
    assert max(map(len, spans.values())) > 10


def test_loader_asof_is_the_brute_force_one(spark):
    r = random.Random(8)
    start = dt.datetime(2015, 1, 1)
    held, moves = [], {}
    for n in range(12):
        at = start + dt.timedelta(days=r.randint(0, 30))
        for _ in range(r.randint(1, 8)):
            end = at + dt.timedelta(seconds=r.choice([3600, 86_400, 90_000_000, 200_000_000]))
            spot = (-23.0 + r.randint(0, 3) * 1e-4, 133.0 + r.randint(0, 3) * 1e-4)
            moves.setdefault(f"L{n}", []).append((at, end, spot))
            at = end
        last = moves[f"L{n}"][-1]
        moves[f"L{n}"][-1] = (last[0], None, last[2])
        held += [(f"L{n}", "S", a, b, *spot) for a, b, spot in moves[f"L{n}"]]
    validity = spark.createDataFrame(held, "asset_guid string, site_guid string, valid_from timestamp_ntz, valid_to timestamp_ntz, latitude double, longitude double")
    asks = []
    for k in range(300):
        when = r.choice([m[0] for ms in moves.values() for m in ms]) + dt.timedelta(seconds=r.choice([-1, 0, 1, 86_399, 86_400, 40_000_000]))
        asks.append((k, "S", -23.0 + r.uniform(-2e-4, 5e-4), 133.0 + r.uniform(-2e-4, 5e-4), False, when))
    rows = spark.createDataFrame(asks, SCHEMA + ", timestamp timestamp_ntz")
    cells = places.loader_cells_asof(validity, places.asked_days(rows))
    got = {x.seq: x.guid for x in places.with_nearest_loader_asof(rows, cells).selectExpr("seq", "loader.guid AS guid").collect()}
    from tests.test_places import metres

    hits = 0
    for k, _, lat, lon, _, when in asks:
        near = [(metres(lat, lon, *spot), g) for g, ms in moves.items() for a, b, spot in ms if a <= when and (b is None or when < b)]
        near = [x for x in near if x[0] <= 30.0]
        assert got[k] == (min(near)[1] if near else None), k
        hits += bool(near)
    assert hits > 100


def test_few_regions_are_picked_without_a_shuffle_of_cells(spark):
    rings = dict(list(_rings(3).items())[:40])
    shapes = shapes_of(region_shapes(_region_frame(spark, rings, "load")), "load").persist()
    assert places.tree_depth(shapes) == 0
    r = random.Random(4)
    loaders = [(f"L{k:02d}", site, -23.0 + r.uniform(-0.3, 0.3), 133.0 + r.uniform(-0.3, 0.3)) for k in range(60) for site in ("S", "none")]
    cells = places.loader_cells(spark.createDataFrame(loaders, "asset_guid string, site_guid string, latitude double, longitude double")).persist()
    cells.count()
    picked = places.with_load_regions(cells, shapes, 0)
    shown = lambda rows: {(x.site_guid, x.cell): sorted(v.region_guid for v in x.load_regions or []) for x in rows.collect()}
    few = shown(picked)
    assert few == shown(places.with_load_regions(cells, shapes)) and any(few.values())
    plan = picked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and "Generate" not in plan.split("InMemoryRelation")[0]  # cells were multiplied by regions and grouped again before


def test_only_asked_cells_and_days_are_filed_asof(spark, monkeypatch):
    start = dt.datetime(2024, 1, 1)
    held = [(f"L{n}", "S", start, None, -23.0, 133.0 + n * 1e-2) for n in range(200)]
    validity = spark.createDataFrame(held, "asset_guid string, site_guid string, valid_from timestamp_ntz, valid_to timestamp_ntz, latitude double, longitude double")
    rows = spark.createDataFrame([(0, "S", -23.0, 133.0, False, start), (1, "S", -23.0, 133.01, False, start + dt.timedelta(days=1))], SCHEMA + ", timestamp timestamp_ntz")
    filed, spans = [], places.validity_spans
    monkeypatch.setattr(places, "validity_spans", lambda v: filed.append(spans(v)) or filed[-1])
    cells = places.loader_cells_asof(validity, places.asked_days(rows))
    got = places.with_nearest_loader_asof(rows, cells).selectExpr("seq", "loader.guid AS guid").collect()
    assert {x.seq: x.guid for x in got} == {0: "L0", 1: "L1"}
    assert filed[0].count() <= 4  # two loaders, one day each; all cells of all loaders to the calendar's end before


def test_colocation_is_the_loader_in_the_row_s_region(spark):
    rings = {g: ring for g, ring in _rings(9).items() if g != "R99"}
    r = random.Random(10)
    loaders = [(f"L{k:02d}", "S", -23.0 + r.uniform(-0.05, 0.05), 133.0 + r.uniform(-0.05, 0.05)) for k in range(200)]
    rows = [(k, "S", lat + r.uniform(-2e-4, 2e-4), lon + r.uniform(-2e-4, 2e-4), False) for k, (_, _, lat, lon) in enumerate(loaders)]
    shapes = shapes_of(region_shapes(_region_frame(spark, rings, "dump")), "dump")
    dumps = places.region_cells(shapes)
    cells = places.loader_cells(spark.createDataFrame(loaders, "asset_guid string, site_guid string, latitude double, longitude double"), dump_cells=dumps)
    found = places.with_dump_region(places.with_nearest_loader(spark.createDataFrame(rows, SCHEMA), cells), dumps)
    where = {g: (lon, lat) for g, _, lat, lon in loaders}
    seen = {True: 0, False: 0}
    for x in places.with_colocation(found).selectExpr("loader.guid AS guid", "dump_region.region_guid AS region", "colocated").collect():
        want = x.guid is not None and x.region is not None and _contains(rings[x.region], *where[x.guid])
        assert x.colocated == want
        seen[want] += x.guid is not None and x.region is not None
    assert seen[True] > 20
