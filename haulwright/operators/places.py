"""Where a truck is: nearest loader, load region, dump region, area.

Loaders and regions are filed under grid cells once, as dimension work; a
telemetry row then meets the few entries of its own cell. The joins are left
equi-joins with telemetry on the streamed side and at most one row per key on
the other, so no pairs are emitted, nothing is grouped back, and telemetry is
not shuffled while the cell tables are small enough to broadcast. No broadcast
is forced: Spark takes it below its size threshold, at run time too, and splits
skewed partitions of a shuffle join beyond it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulwright.config import DEFAULT, CycleConfig
from haulwright.functions.geo import (
    BOX,
    BoxGrid,
    NearGrid,
    degrees_to_box,
    degrees_to_ring,
    has_place,
    haversine_m,
    inside,
    inside_clipped,
)
from haulwright.operators.timeline import neighbour
from haulwright.session import spread

_CENTRE = ["cell_lat", "cell_lon", "cell_half"]
_CELL = ["cell", *_CENTRE]


# --- loaders --------------------------------------------------------------------


def loaders_current(process_info: DataFrame, cfg: CycleConfig = DEFAULT) -> DataFrame:
    """Present loader positions, as the idle job last wrote them."""
    return process_info.where(
        (F.col("process_name") == cfg.idle_process)
        & (F.col("asset_type_guid") == cfg.loader_type)
        & F.col("current_latitude").isNotNull()
        & F.col("current_longitude").isNotNull()
    ).select(
        "asset_guid",
        "site_guid",
        F.col("current_latitude").alias("latitude"),
        F.col("current_longitude").alias("longitude"),
    )


def loader_validity(
    idle: DataFrame, assets: DataFrame, cfg: CycleConfig = DEFAULT, merge: bool = False
) -> DataFrame:
    """When each loader position holds: from its stop until the next one.

    With `merge`, further stops at the same spot prolong the first of them.
    """
    stopped = F.coalesce("end_state_utc", "start_state_utc")
    at = F.struct("start_state_utc", "latitude", "longitude")
    stops = (
        idle.where("end_location_latitude IS NOT NULL AND end_location_longitude IS NOT NULL")
        .withColumnRenamed("end_location_latitude", "latitude")
        .withColumnRenamed("end_location_longitude", "longitude")
        .groupBy("asset_guid", stopped.alias("valid_from"))
        .agg(F.max(at).alias("at"))
        .select("asset_guid", "valid_from", "at.latitude", "at.longitude")
    )
    loaders = assets.where(F.col("asset_type_guid") == cfg.loader_type).select(
        F.col("guid").alias("asset_guid"), "site_guid"
    )
    month = F.date_trunc("month", "valid_from")
    if merge:
        spot = ["latitude", "longitude"]
        stops = neighbour(stops, ["asset_guid"], month, ["valid_from"], spot, "before").where(
            "NOT struct(latitude, longitude) <=> before"
        )
    following = neighbour(
        stops,
        ["asset_guid"],
        month,
        ["valid_from"],
        ["valid_from"],
        "following",
        ahead=True,
    )
    return following.join(loaders, "asset_guid").select(
        "asset_guid",
        "site_guid",
        "valid_from",
        F.col("following.valid_from").alias("valid_to"),
        "latitude",
        "longitude",
    )


def _nearest(loaders: str, cfg: CycleConfig) -> Column:
    """The loader with the smallest (distance, guid) within the radius."""
    metres = haversine_m("latitude", "longitude", "p.latitude", "p.longitude", cfg.earth_radius_m)
    measured = (
        f"transform({loaders}, p -> struct({metres} AS distance, p.asset_guid AS guid,"
        " p.latitude AS latitude, p.longitude AS longitude, p.dumps AS dumps))"
    )
    return F.expr(f"array_min(filter({measured}, c -> c.distance <= {cfg.loader_radius_m}D))")


def _spots(loaders: DataFrame, dump_cells: DataFrame | None, steps: tuple[str, ...]) -> DataFrame:
    """Loaders with `dumps`, the dump regions around them."""
    if dump_cells is None:
        return loaders.withColumn("dumps", F.expr("cast(array() AS array<string>)"))
    return with_dumps(loaders, dump_cells, steps=steps)


def loader_cells(
    loaders: DataFrame, cfg: CycleConfig = DEFAULT, dump_cells: DataFrame | None = None, steps: tuple[str, ...] = ("fine", "coarse")
) -> DataFrame:
    """Loaders by (site, cell): all that can be in reach of a point in the cell.

    Of loaders at exactly one spot only the first guid can be the nearest, so
    the list of a cell holds distinct spots within some 60 m of each other.
    With `dump_cells` a loader knows the dump regions it stands in.
    """
    grid = NearGrid.of(cfg)
    spots = loaders.groupBy("site_guid", "latitude", "longitude").agg(
        F.min("asset_guid").alias("asset_guid")
    )
    return (
        grid.with_cells_in_reach(_spots(spots, dump_cells, steps))
        .groupBy("site_guid", *_CELL)
        .agg(F.collect_list(F.struct("asset_guid", "latitude", "longitude", "dumps")).alias("loaders"))
    )


#: Lengths of the spans that validity is cut into: 1, 2, 4 ... days.
_LEVELS = 16


def _day(moment: str) -> str:
    return f"datediff(to_date({moment}), date'1970-01-01')"


def validity_spans(validity: DataFrame) -> DataFrame:
    """Rows with valid_from and valid_to by aligned spans of 2^level days that cover their days.

    A row gets at most two spans of each length but the longest, so some tens for many years.
    An open validity ends with the calendar. With columns `from_day` and `to_day`, days outside them are left out.
    """
    first, last = _day("valid_from"), _day("coalesce(valid_to, timestamp_ntz'9999-12-31 00:00:00')")
    if "from_day" in validity.columns:
        first, last = f"greatest({first}, {_day('from_day')})", f"least({last}, {_day('to_day')})"
    # In units of 2^level days: what is left to cover begins at the first whole unit and ends with the last.
    begin, end = "-shiftright(-first_day, level)", "shiftright(last_day + 1, level)"
    spans = (
        f"if(level = {_LEVELS}, if(begin < end, sequence(begin, end - 1), cast(array() AS array<int>)),"
        " filter(array(if(begin < end AND begin % 2 <> 0, begin, null),"
        " if(begin + abs(begin % 2) < end AND end % 2 <> 0, end - 1, null)), s -> s IS NOT NULL))"
    )
    return (
        validity.selectExpr("*", f"{first} AS first_day", f"{last} AS last_day")
        .selectExpr("*", f"explode(sequence(0, {_LEVELS})) AS level")
        .selectExpr("*", f"{begin} AS begin", f"{end} AS end")
        .selectExpr("*", f"explode({spans}) AS span")
        .drop("first_day", "last_day", "begin", "end")
    )


def asked_days(rows: DataFrame, cfg: CycleConfig = DEFAULT) -> DataFrame:
    """Each site, cell and day that rows with a usable position lie in."""
    placed = NearGrid.of(cfg).with_cell(rows, "NOT bad_position").where("cell IS NOT NULL AND timestamp IS NOT NULL")
    return placed.selectExpr("site_guid", "cell", "to_date(timestamp) AS day").distinct()


def loader_cells_asof(
    validity: DataFrame,
    asked: DataFrame,
    cfg: CycleConfig = DEFAULT,
    dump_cells: DataFrame | None = None,
    steps: tuple[str, ...] = ("fine", "coarse"),
) -> DataFrame:
    """As `loader_cells`, for the days `asked` (site_guid, cell, day): the positions that hold at some time of them.

    A position is filed under the few spans of days that make up its validity, and a day asks
    for the one span of each length around it, so neither years nor rows of a day are multiplied.
    Cells nobody asks for, and days before or after the asked ones of a cell, are left out before that.
    """
    grid = NearGrid.of(cfg)
    # With the days as a list both readers of `asked` meet the same rows, so that it is worked out once.
    reach = asked.groupBy("site_guid", "cell").agg(F.collect_list("day").alias("days")).selectExpr(
        "site_guid", "cell", "array_min(days) AS from_day", "array_max(days) AS to_day"
    )
    # A position has many cells, so positions are dealt out by number and not by their few bytes.
    spots = _spots(spread(validity, "asset_guid", "valid_from"), dump_cells, steps)
    held = (
        validity_spans(grid.with_cells_in_reach(spots).join(reach, ["site_guid", "cell"]))
        .groupBy("site_guid", *_CELL, "level", "span")
        .agg(F.collect_list(F.struct("asset_guid", "latitude", "longitude", "dumps", "valid_from", "valid_to")).alias("loaders"))
    )
    days = asked.selectExpr("*", f"explode(sequence(0, {_LEVELS})) AS level").selectExpr(
        "*", f"shiftright({_day('day')}, level) AS span"
    )
    return (
        days.join(held, ["site_guid", "cell", "level", "span"])
        .groupBy("site_guid", *_CELL, "day")
        .agg(F.flatten(F.collect_list("loaders")).alias("loaders"))
    )


def with_nearest_loader(
    telemetry: DataFrame, cells: DataFrame, cfg: CycleConfig = DEFAULT
) -> DataFrame:
    """Add `loader`, the nearest one within the radius, and what else the cell holds."""
    rows = NearGrid.of(cfg).with_cell(telemetry, "NOT bad_position")
    found = rows.join(cells.drop(*_CENTRE), ["site_guid", "cell"], "left")
    return found.withColumn("loader", _nearest("loaders", cfg)).drop("loaders", "cell")


def with_nearest_loader_asof(
    telemetry: DataFrame, cells: DataFrame, cfg: CycleConfig = DEFAULT
) -> DataFrame:
    """As `with_nearest_loader`, with the positions that held at the row's second."""
    rows = NearGrid.of(cfg).with_cell(telemetry, "NOT bad_position").selectExpr(
        "*",
        "to_date(timestamp) AS day",
        "cast(date_trunc('second', timestamp) AS timestamp_ntz) AS second",
    )
    holds = (
        "filter(loaders, p -> p.valid_from <= second"
        " AND (p.valid_to IS NULL OR second < p.valid_to))"
    )
    return (
        rows.join(cells.drop(*_CENTRE), ["site_guid", "cell", "day"], "left")
        .withColumn("loader", _nearest(holds, cfg))
        .drop("loaders", "cell", "day", "second")
    )


# --- load regions ---------------------------------------------------------------


#: Sides in degrees of the nested cells, 16 x 16 in the one before, that load regions are filed under.
_NESTED = tuple(360.0 / 256 / 16**level for level in range(3))
_PATH = [f"k{level}" for level in range(len(_NESTED))]


#: Regions of a site, and edges of them, up to which its cells are measured against all of them, without a tree.
FEW_REGIONS = 64
FEW_EDGES = 1 << 16


def tree_depth(shapes: DataFrame) -> int:
    """Levels of nested cells that are worth while for the site with the most regions or edges."""
    sites = shapes.groupBy("site_guid").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("edges")).alias("n_edges"))
    most, edges = sites.agg(F.max("n"), F.max("n_edges")).first()
    return 0 if (most or 0) <= FEW_REGIONS and (edges or 0) <= FEW_EDGES else len(_PATH)


def region_tree(shapes: DataFrame, depth: int = len(_PATH)) -> list[DataFrame]:
    """Nodes of each level by site and path: their children with the box around all that is in them and a corner.

    A region is filed once, by its first corner; boxes of cells hold whole regions and may
    overlap. The last level's children are the regions themselves.
    """
    path = _PATH[:depth]
    step = lambda v, size: f"floor(({v}) / {size!r}D)"
    filed = shapes.selectExpr("site_guid", "region_guid", *BOX, "get(edges, 0).x1 AS x", "get(edges, 0).y1 AS y").selectExpr(
        "*", *(f"{step('y + 90', s)} * {1 << 26}L + {step('x + 180', s)} AS {k}" for k, s in zip(_PATH, _NESTED))
    )
    low, high = [c for c in BOX if c.startswith("min")], [c for c in BOX if c.startswith("max")]
    levels = []
    for level in range(depth + 1):
        above, own = path[:level], [*path, "region_guid"][level]
        nodes = filed.groupBy("site_guid", *above, own).agg(
            *(F.min(c).alias(c) for c in low), *(F.max(c).alias(c) for c in high), F.min(F.struct("x", "y")).alias("corner")
        )
        child = F.struct(F.col(own).alias("own"), F.struct(*BOX).alias("box"), "corner")
        levels.append(nodes.groupBy("site_guid", *above).agg(F.collect_list(child).alias("children")))
    return levels


def regions_in_reach(cells: DataFrame, shapes: DataFrame, depth: int = len(_PATH)) -> DataFrame:
    """site_guid, cell, load_regions (guids that can be nearest to a point of the cell) and n_touched, regions measured for it.

    Seen from the centre, what a box holds is no nearer than the box, and the region of a known
    corner no farther than that; from other points of the cell, that shifts by at most the half
    diagonal. So level by level only children whose box lies within the nearest corner plus a
    whole diagonal are followed, and of the regions found so only such can win.
    """
    corner = "hypot(c.corner.x - cell_lon, c.corner.y - cell_lat)"
    measured = (
        f"transform(children, c -> struct({degrees_to_box('c.box', 'cell_lon', 'cell_lat')} AS low,"
        f" {corner} AS high, c.own AS own))"
    )
    rows = cells.select("site_guid", *_CELL).distinct().withColumn("best", F.lit(float("inf")))
    for at, level in enumerate(region_tree(shapes, depth)):
        above = _PATH[:at]
        met = rows.join(level, ["site_guid", *above]).selectExpr("site_guid", *_CELL, *above, "best", f"{measured} AS children")
        found = met.groupBy("site_guid", *_CELL).agg(
            F.min(F.least("best", F.expr("array_min(transform(children, c -> c.high))"))).alias("best"),
            F.flatten(
                F.collect_list(F.transform("children", lambda c: F.struct(c["low"], F.struct(*above, c["own"].alias("own")).alias("at"))))
            ).alias("children"),
        ).withColumn("near", F.expr("filter(children, c -> c.low <= best + cell_half * 2)"))
        if at < depth:
            rows = found.selectExpr("site_guid", *_CELL, "best", "explode(near.at) AS at").select(
                "site_guid", *_CELL, "best", *(F.col(f"at.{k}") for k in above), F.col("at.own").alias(_PATH[at])
            )
    return found.selectExpr("site_guid", "cell", "near.at.own AS load_regions", "size(children) AS n_touched")


def with_load_regions(cells: DataFrame, shapes: DataFrame, depth: int = len(_PATH)) -> DataFrame:
    """Add to each loader cell the load regions that can be nearest to a point in it, with their edges.

    Which of them is nearest is measured for each row.
    """
    if not depth:
        return _with_few_regions(cells, shapes)
    held = regions_in_reach(cells, shapes, depth).select("site_guid", "cell", F.explode("load_regions").alias("region_guid"))
    kept = (
        held.join(shapes.select("site_guid", "region_guid", "edges"), ["site_guid", "region_guid"])
        .groupBy("site_guid", "cell")
        .agg(F.collect_list(F.struct("region_guid", "edges")).alias("load_regions"))
    )
    return cells.join(kept, ["site_guid", "cell"], "left")


def _with_few_regions(cells: DataFrame, shapes: DataFrame) -> DataFrame:
    """The same where a site has few regions: a cell picks from the site's list, so cells are neither multiplied nor shuffled."""
    child = F.struct("region_guid", "edges", F.struct(*BOX).alias("box"), F.expr("get(edges, 0)").alias("corner"))
    sites = shapes.groupBy("site_guid").agg(F.collect_list(child).alias("children"))
    measured = (
        f"transform(children, c -> struct({degrees_to_box('c.box', 'cell_lon', 'cell_lat')} AS low,"
        " hypot(c.corner.x1 - cell_lon, c.corner.y1 - cell_lat) AS high, struct(c.region_guid, c.edges) AS region))"
    )
    kept = (
        "get(transform(array(array_min(transform(children, c -> c.high))),"
        " best -> transform(filter(children, c -> c.low <= best + cell_half * 2), c -> c.region)), 0)"
    )
    return (
        cells.join(sites, "site_guid", "left")
        .withColumn("children", F.expr(measured))
        .withColumn("load_regions", F.expr(kept))
        .drop("children")
    )


def with_load_region(telemetry: DataFrame, cfg: CycleConfig = DEFAULT) -> DataFrame:
    """Add `load_region` for rows near a loader: the one around, else the nearest."""
    within = inside("r.edges", "longitude", "latitude")
    metres = f"{degrees_to_ring('r.edges', 'longitude', 'latitude')} * {cfg.metres_per_degree}D"
    # A region around the point wins over any other, then the distance decides.
    measured = (
        f"transform(transform(load_regions, r -> struct({within} AS within, r AS r)), m ->"
        f" struct(NOT m.within AS outside,"
        f" if(m.within, 0D, {metres.replace('r.edges', 'm.r.edges')}) AS distance,"
        " m.r.region_guid AS guid))"
    )
    asked = f"loader IS NOT NULL AND {has_place('latitude', 'longitude')}"
    nearest = F.expr(f"if({asked}, array_min({measured}), null)")
    return telemetry.withColumn("load_region", nearest).drop("load_regions")


# --- dump regions ---------------------------------------------------------------


_KINDS = ("fine", "coarse", "dense")


def cell_steps(kinds: tuple[str, ...]) -> tuple[str, ...]:
    """Sizes of cells that hold regions of such kinds (`BoxGrid.kinds`); regions cut small are in both."""
    fine = "fine" in kinds or "dense" in kinds or not kinds
    return ("fine",) * fine + ("coarse",) * ("coarse" in kinds or "dense" in kinds)


def region_cells(shapes: DataFrame, grid: BoxGrid = BoxGrid(), kinds: tuple[str, ...] = _KINDS) -> DataFrame:
    """Regions by (site, step, cell): all that meet the cell, clipped to it, in guid order."""
    return (
        grid.clipped(shapes, kinds)
        .groupBy("site_guid", "fine", "region_cell")
        .agg(F.sort_array(F.collect_list(F.struct("region_guid", "near", "ys", "odd"))).alias("regions"))
    )


def _around(points: DataFrame, cells: DataFrame, grid: BoxGrid, steps: tuple[str, ...]) -> DataFrame:
    """Add `<step>_hits`, the guids of the regions around each point, by their cells of each size."""
    placed = has_place("latitude", "longitude")
    around = f"filter(regions, r -> {inside_clipped('r', 'longitude', 'latitude')})"
    rows = points
    for step in steps:
        fine = step == "fine"
        level = cells.where("fine" if fine else "NOT fine").select("site_guid", "region_cell", "regions")
        rows = (
            rows.selectExpr("*", f"if({placed}, {grid.key('latitude', 'longitude', fine)}, null) AS region_cell")
            .join(level, ["site_guid", "region_cell"], "left")
            .withColumn(f"{step}_hits", F.expr(f"transform({around}, r -> r.region_guid)"))
            .drop("region_cell", "regions")
        )
    return rows


_STEPS = ("fine", "coarse")


def with_dump_region(
    telemetry: DataFrame,
    cells: DataFrame,
    grid: BoxGrid = BoxGrid(),
    steps: tuple[str, ...] = _STEPS,
) -> DataFrame:
    """Add `dump_region`, the first region around the row.

    `steps` may leave out a cell size known to hold no region.
    """
    hits = [f"get({step}_hits, 0)" for step in steps]
    first = F.expr(f"least({', '.join(hits)})" if len(hits) > 1 else hits[0])
    found = _around(telemetry, cells, grid, steps).withColumn("dump_region", F.struct(first.alias("region_guid")))
    named = F.when(F.col("dump_region.region_guid").isNotNull(), F.col("dump_region"))
    return found.withColumn("dump_region", named).drop(*(f"{step}_hits" for step in steps))


def with_dumps(spots: DataFrame, cells: DataFrame, grid: BoxGrid = BoxGrid(), steps: tuple[str, ...] = _STEPS) -> DataFrame:
    """Add `dumps`, the guids of all dump regions around a loader's spot."""
    lists = ", ".join(f"coalesce({step}_hits, array())" for step in steps)
    found = _around(spots, cells, grid, steps).withColumn("dumps", F.expr(f"array_distinct(concat({lists}))"))
    return found.drop(*(f"{step}_hits" for step in steps))


# --- area ------------------------------------------------------------------------


def with_colocation(telemetry: DataFrame) -> DataFrame:
    """Add `colocated`: the row's loader stands in the row's dump region (one of its `dumps`)."""
    both = "loader IS NOT NULL AND dump_region IS NOT NULL"
    return telemetry.withColumn(
        "colocated", F.expr(f"if({both}, array_contains(loader.dumps, dump_region.region_guid), false)")
    )


# Area as far as it follows from the place; at a loader in a dump region it also
# depends on the cycle and is left to the engine.
AREA_STATIC = """CASE WHEN loader_guid IS NOT NULL AND dump_region_guid IS NOT NULL THEN 'OVERLAP'
    WHEN loader_guid IS NOT NULL THEN 'LOAD'
    WHEN dump_region_guid IS NOT NULL THEN 'DUMP' ELSE 'TRAVEL' END"""


def as_moments(placed: DataFrame) -> DataFrame:
    """The columns the cycle engine reads."""
    return placed.selectExpr(
        "seq",
        "asset_guid",
        "site_guid",
        "unix_micros(cast(timestamp AS timestamp)) AS at_us",
        "work_state_id",
        "longitude",
        "latitude",
        "loader.guid AS loader_guid",
        "loader.latitude AS loader_latitude",
        "loader.longitude AS loader_longitude",
        "loader.distance AS loader_distance",
        "load_region.guid AS load_region_guid",
        "coalesce(NOT load_region.outside, false) AS in_load_region",
        "load_region.distance AS load_region_distance",
        "dump_region.region_guid AS dump_region_guid",
        "colocated",
        "bad_position",
    )
