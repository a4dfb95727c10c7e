"""Distances, rings and grid cells.

Functions of one row give SQL text for use in expressions, `with_*` add columns.

A ring is kept as its edges, `array<struct<x1,y1,x2,y2>>` with x = longitude and
y = latitude, closed even if the text left the last edge out.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import pi

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulwright.config import CycleConfig

_ROW_KEY = 1 << 26
BOX = ["min_lon", "max_lon", "min_lat", "max_lat"]
NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"


def haversine_m(lat1: str, lon1: str, lat2: str, lon2: str, radius_m: float) -> str:
    half_lat = f"sin(radians({lat2} - {lat1}) / 2)"
    half_lon = f"sin(radians({lon2} - {lon1}) / 2)"
    a = (
        f"({half_lat} * {half_lat}"
        f" + cos(radians({lat1})) * cos(radians({lat2})) * {half_lon} * {half_lon})"
    )
    return f"({radius_m!r}D * (2 * atan2(sqrt({a}), sqrt(1 - {a}))))"


def position_ok(lat: str, lon: str) -> str:
    return f"coalesce({lat} BETWEEN -90 AND 90 AND {lon} BETWEEN -180 AND 180, false)"


def has_place(lat: str, lon: str) -> str:
    """Region tests skip points without position and points with lat = lon."""
    return f"({lat} IS NOT NULL AND {lon} IS NOT NULL AND {lat} <> {lon})"


# --- rings --------------------------------------------------------------------


def with_ring(regions: DataFrame) -> DataFrame:
    """Parse `points`: add `parse_error` (null if usable), `n_points`, `ring`, its box.

    The first bad pair gives the reason; blank pairs are passed over. A region stays one row.
    """
    columns = regions.columns
    parsed = f"""transform(pieces, parts -> struct(
        CASE WHEN size(parts) <> 2 THEN 'malformed'
            WHEN NOT forall(parts, v -> v RLIKE r'{NUMBER}') THEN 'non_numeric' END AS bad,
        try_cast(get(parts, 0) AS double) AS lon, try_cast(get(parts, 1) AS double) AS lat))"""
    return (
        regions.selectExpr("*", r"transform(split(points, ','), p -> regexp_replace(p, r'^\s+|\s+$', '')) AS pairs")
        .selectExpr(*columns, "transform(filter(pairs, p -> p <> ''), p -> split(p, ' ', -1)) AS pieces")
        .selectExpr(*columns, f"{parsed} AS parsed")
        .selectExpr(
            *columns,
            r"""CASE WHEN points IS NULL OR points RLIKE r'^\s*$' THEN 'null_or_empty'
                WHEN exists(parsed, p -> p.bad IS NOT NULL) THEN get(filter(parsed, p -> p.bad IS NOT NULL), 0).bad
                WHEN size(parsed) = 0 THEN 'no_points'
                WHEN size(parsed) < 3 THEN 'too_few_points' END AS parse_error""",
            "coalesce(size(parsed), 0) AS n_points",
            "transform(parsed, (p, nth) -> struct(nth, p.lon, p.lat)) AS ring",
            *(f"array_{side}(transform(parsed, p -> p.{v})) AS {side}_{v}" for v in ("lon", "lat") for side in ("min", "max")),
        )
    )


def ring_edges(ring: str) -> str:
    """Edges of the ring column, the last one back to the first point."""
    following = "get(g, pmod(i + 1, size(g)))"
    # As a variable, the ring is worked out once and not for each of its points.
    return (
        f"element_at(transform(array({ring}), g -> transform(g, (p, i) -> struct(p.lon AS x1, p.lat AS y1,"
        f" {following}.lon AS x2, {following}.lat AS y2))), 1)"
    )


def _on_edge(lon: str, lat: str) -> str:
    return (
        f"(e.x2 - e.x1) * ({lat} - e.y1) - (e.y2 - e.y1) * ({lon} - e.x1) = 0"
        f" AND {lon} BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2)"
        f" AND {lat} BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2)"
    )


def _crossed(lon: str, lat: str) -> str:
    return (
        f"((e.y1 > {lat}) <> (e.y2 > {lat}) AND coalesce("
        f"{lon} < (e.x2 - e.x1) * ({lat} - e.y1) / nullif(e.y2 - e.y1, 0D) + e.x1, false))"
    )


def inside(edges: str, lon: str, lat: str) -> str:
    """Point in polygon, the boundary counting as inside."""
    return (
        f"(exists({edges}, e -> {_on_edge(lon, lat)})"
        f" OR aggregate({edges}, false, (odd, e) -> odd <> {_crossed(lon, lat)}))"
    )


def inside_clipped(region: str, lon: str, lat: str) -> str:
    """The same for a point of a cell and a ring clipped to it (`BoxGrid.clipped`)."""
    return (
        f"(exists({region}.near, e -> {_on_edge(lon, lat)})"
        f" OR aggregate({region}.near, {region}.odd <> {_odd(f'filter({region}.ys, y -> y <= {lat})')},"
        f" (odd, e) -> odd <> {_crossed(lon, lat)}))"
    )


def _odd(array: str) -> str:
    return f"(size({array}) % 2 = 1)"


def degrees_to_ring(edges: str, lon: str, lat: str) -> str:
    """Planar distance in degrees from a point outside to the ring."""
    dx, dy = "(e.x2 - e.x1)", "(e.y2 - e.y1)"
    off_x, off_y = f"({lon} - e.x1)", f"({lat} - e.y1)"
    length = f"({dx} * {dx} + {dy} * {dy})"
    along = f"if({length} > 0, ({off_x} * {dx} + {off_y} * {dy}) / {length}, 0D)"
    t = f"greatest(0D, least(1D, {along}))"
    return (
        f"array_min(transform({edges}, e -> hypot({off_x} - {t} * {dx}, {off_y} - {t} * {dy})))"
    )


def degrees_to_box(box: str, lon: str, lat: str) -> str:
    """Planar distance in degrees from a point to a box; 0 inside."""
    return (
        f"hypot(greatest({box}.min_lon - {lon}, {lon} - {box}.max_lon, 0D),"
        f" greatest({box}.min_lat - {lat}, {lat} - {box}.max_lat, 0D))"
    )


# --- grids --------------------------------------------------------------------


@dataclass(frozen=True)
class NearGrid:
    """Cells a bit larger than a radius, equally wide in metres at every latitude.

    Rows are bands of latitude; each row is divided into as many columns as keep
    a column wider than the radius, so columns run around the globe and wrap.
    """

    radius_m: float
    earth_radius_m: float

    @staticmethod
    def of(cfg: CycleConfig) -> "NearGrid":
        return NearGrid(max(cfg.loader_radius_m, 1.0), cfg.earth_radius_m)

    @property
    def reach_deg(self) -> float:
        return self.radius_m / (self.earth_radius_m * pi / 180.0) * (1 + 1e-6) + 1e-9

    @property
    def step_deg(self) -> float:
        return self.reach_deg * 1.05

    def _row(self, lat: str) -> str:
        return f"floor(({lat} + 90) / {self.step_deg!r}D)"

    def _columns(self) -> str:
        low = f"(grid_row * {self.step_deg!r}D - 90)"
        steepest = f"least(greatest(abs({low}), abs({low} + {self.step_deg!r}D)), 90D)"
        return f"greatest(floor(cos(radians({steepest})) * {360.0 / self.step_deg!r}D), 1L)"

    def with_cell(self, points: DataFrame, usable: str) -> DataFrame:
        """Add `cell`, the key of the cell around each usable point."""
        column = "least(floor((longitude + 180) / 360 * grid_columns), grid_columns - 1)"
        return (
            points.selectExpr("*", f"if({usable}, {self._row('latitude')}, null) AS grid_row")
            .selectExpr("*", f"{self._columns()} AS grid_columns")
            .selectExpr("*", f"grid_row * {_ROW_KEY}L + {column} AS cell")
            .drop("grid_row", "grid_columns")
        )

    def with_cells_in_reach(self, points: DataFrame) -> DataFrame:
        """One row per point and cell that holds a spot within the radius of it.

        Adds `cell` and its centre as `cell_lat`, `cell_lon`, `cell_half` (half
        diagonal in degrees).
        """
        reach = f"{self.reach_deg!r}D"
        ratio = f"sin(radians({reach})) / cos(radians(latitude))"
        rows = f"sequence({self._row(f'latitude - {reach}')}, {self._row(f'latitude + {reach}')})"
        step = f"{self.step_deg!r}D"
        return (
            # Near a pole a circle may span all longitudes.
            points.selectExpr(
                "*",
                f"if({ratio} < 1, degrees(asin({ratio})) * 1.000001D + 1e-9D, 180D) AS grid_half",
                f"explode({rows}) AS grid_row",
            )
            .selectExpr("*", f"{self._columns()} AS grid_columns")
            .selectExpr("*", "360D / grid_columns AS grid_width")
            .selectExpr(
                "*",
                "floor((longitude - grid_half + 180) / grid_width) AS grid_first",
                "floor((longitude + grid_half + 180) / grid_width) AS grid_last",
            )
            .selectExpr(
                "*",
                "explode(sequence(grid_first, least(grid_last, grid_first + grid_columns - 1)))"
                " AS grid_turn",
            )
            .selectExpr("*", "pmod(grid_turn, grid_columns) AS grid_column")
            .selectExpr(
                "*",
                f"grid_row * {_ROW_KEY}L + grid_column AS cell",
                f"(grid_row + 0.5D) * {step} - 90 AS cell_lat",
                "(grid_column + 0.5D) * grid_width - 180 AS cell_lon",
                f"sqrt(grid_width * grid_width + {step} * {step}) / 2 * 1.000001D + 1e-9D AS cell_half",
            )
            .drop(
                "grid_half", "grid_row", "grid_columns", "grid_width",
                "grid_first", "grid_last", "grid_turn", "grid_column",
            )
        )


#: Degrees by which cells are widened when edges are dealt to them, far more than doubles are off.
_SLACK = "1e-7D"
_PART = ["site_guid", "region_guid", "part"]


@dataclass(frozen=True)
class BoxGrid:
    """Square cells in degrees for looking up regions, `ratio` x `ratio` fine ones in a coarse one.

    A region whose box would cover more than `most` fine cells is filed under coarse cells, which
    number at most 361 x 721; where more than `most_edges` of its edges meet one of these, that
    one is cut into fine cells. A cell lists the edges that meet it and nothing else of a ring.
    """

    coarse_deg: float = 0.5
    ratio: int = 100
    most: int = 4096
    most_edges: int = 64

    @property
    def fine_deg(self) -> float:
        return self.coarse_deg / self.ratio

    def _index(self, value: str, fine: bool) -> str:
        """Row or column of a latitude + 90 or longitude + 180; a fine one lies in its coarse one."""
        coarse = f"floor(({value}) / {self.coarse_deg!r}D)"
        if not fine:
            return coarse
        within = f"floor((({value}) - {coarse} * {self.coarse_deg!r}D) / {self.fine_deg!r}D)"
        return f"({coarse} * {self.ratio}L + least(greatest({within}, 0L), {self.ratio - 1}L))"

    def key(self, lat: str, lon: str, fine: bool) -> str:
        return f"({self._index(f'{lat} + 90', fine)} * {_ROW_KEY}L + {self._index(f'{lon} + 180', fine)})"

    def _clip(self, parts: DataFrame, fine: bool) -> DataFrame:
        """Parts of rings (edges, ys, odd; rows and columns from south, west to north, east) by cell.

        What a ray from a point to the east crosses is, edge by edge: those that meet the cell
        (`near`) have to be tested. Those that don't, in the cell's rows, lie wholly to the west
        or to the east. Eastern ones are crossed as their ends lie above and below the point,
        which is known at the cell's southern side (`odd`) and changes only at ends of eastern
        edges within its rows; an end of two such edges changes nothing (`ys` holds the others).
        """
        step = repr(self.fine_deg if fine else self.coarse_deg) + "D"
        low_y, high_y = "least(e.y1, e.y2)", "greatest(e.y1, e.y2)"
        south, north = f"(grid_row * {step} - 90 - {_SLACK})", f"((grid_row + 1) * {step} - 90 + {_SLACK})"
        slope = "(e.x2 - e.x1) / (e.y2 - e.y1)"

        def at(y: str, otherwise: str) -> str:
            """Longitude of an edge at a latitude; edges that are nearly level count as a whole."""
            steep = f"least(greatest(e.x1 + ({y} - e.y1) * {slope}, least(e.x1, e.x2)), greatest(e.x1, e.x2))"
            return f"if({high_y} - {low_y} < 1e-4D, {otherwise}, {steep})"

        column = lambda x: f"floor(({x} + 180) / {step})"
        met = (
            parts.selectExpr(*_PART, "south", "north", "explode(edges) AS e")
            .selectExpr(
                *_PART, "e",
                f"greatest(floor(({low_y} - 2e-7D + 90) / {step}), south) AS first_row",
                f"least(floor(({high_y} + 2e-7D + 90) / {step}), north) AS last_row",
            )
            .where("first_row <= last_row")
            .selectExpr(*_PART, "e", "explode(sequence(first_row, last_row)) AS grid_row")
            .where(f"{high_y} >= {south} AND {low_y} <= {north}")
            .selectExpr(
                *_PART, "grid_row", "e",
                f"{at(f'greatest({low_y}, {south})', 'e.x1')} AS xa", f"{at(f'least({high_y}, {north})', 'e.x2')} AS xb",
            )
            .selectExpr(
                *_PART, "grid_row",
                f"struct(e.x1, e.y1, e.x2, e.y2, {column(f'least(xa, xb) - {_SLACK}')} AS first,"
                f" {column(f'greatest(xa, xb) + {_SLACK}')} AS last, (e.y1 > {south}) <> (e.y2 > {south}) AS crosses) AS edge",
            )
        )
        marks = parts.selectExpr(*_PART, "explode(sequence(south, north)) AS grid_row", "ys", "odd", "west", "east")
        rows = met.unionByName(marks, allowMissingColumns=True).groupBy(*_PART, "grid_row").agg(
            F.collect_list("edge").alias("edges"),
            *(F.max(c).alias(c) for c in ("ys", "odd", "west", "east")),
        )
        cells = rows.selectExpr("*", "explode(sequence(west, east)) AS grid_column").selectExpr(
            *_PART, "ys", "odd", f"{south} AS low", f"{north} AS high",
            f"grid_row * {_ROW_KEY}L + grid_column AS region_cell", "grid_row", "grid_column",
            "filter(edges, e -> e.first <= grid_column AND grid_column <= e.last) AS met",
            "filter(edges, e -> e.first > grid_column) AS eastern",
        )
        ends = "flatten(transform(eastern, e -> filter(array(e.y1, e.y2), y -> y > low AND y <= high)))"
        # Of equal values in order, pairs go.
        single = (
            f"aggregate(sort_array(concat(filter(ys, y -> y > low AND y <= high), {ends})), cast(array() AS array<double>),"
            " (a, y) -> if(get(a, size(a) - 1) = y, slice(a, 1, size(a) - 1), concat(a, array(y))))"
        )
        below = _odd("filter(ys, y -> y <= low)")
        crossed = _odd("filter(eastern, e -> e.crosses)")
        return cells.selectExpr(
            "site_guid", "region_guid", "region_cell", "grid_row", "grid_column",
            "transform(met, e -> struct(e.x1, e.y1, e.x2, e.y2)) AS near", f"{single} AS ys",
            f"odd <> {below} <> {crossed} AS odd",
        ).where("size(near) > 0 OR size(ys) > 0 OR odd")

    def sized(self, shapes: DataFrame) -> DataFrame:
        """Regions with their size: `fine` (filed under fine cells) and `dense` (coarse cells may have to be cut).

        Points outside the valid range meet no region, so boxes are cut to it.
        """
        tall = f"(floor((max_lat - min_lat) / {self.fine_deg!r}D) + 2)"
        wide = f"(floor((max_lon - min_lon) / {self.fine_deg!r}D) + 2)"
        return shapes.selectExpr(
            "*", f"{tall} * {wide} <= {self.most} AS fine",
            "greatest(min_lat, -90D) + 90 AS b", "least(max_lat, 90D) + 90 AS t",
            "greatest(min_lon, -180D) + 180 AS l", "least(max_lon, 180D) + 180 AS r",
        ).where("b <= t AND l <= r").selectExpr("*", f"NOT fine AND size(edges) > {self.most_edges} AS dense")

    def kinds(self, shapes: DataFrame) -> tuple[str, ...]:
        """Which of fine, coarse and dense there are, found in one pass over the regions."""
        seen = self.sized(shapes).agg(
            F.bool_or("fine").alias("fine"), F.bool_or(~F.col("fine")).alias("coarse"), F.bool_or("dense").alias("dense")
        ).first()
        return tuple(k for k in ("fine", "coarse", "dense") if seen[k])

    def clipped(self, shapes: DataFrame, kinds: tuple[str, ...] = ("fine", "coarse", "dense")) -> DataFrame:
        """site_guid, region_guid, fine, region_cell, near, ys and odd of all cells that a ring meets or holds.

        `kinds` may leave out what the regions are known not to be.
        """
        sized = self.sized(shapes)

        def parts(fine: bool, which: str) -> DataFrame:
            bounds = {"south": "b", "north": "t", "west": "l", "east": "r"}
            return sized.where(which).selectExpr(
                "site_guid", "region_guid", "0L AS part", "edges", "cast(array() AS array<double>) AS ys", "false AS odd",
                *(f"{self._index(c, fine)} AS {name}" for name, c in bounds.items()),
            )

        fine, found = [], []
        if "fine" in kinds:
            fine.append(parts(True, "fine"))
        if "coarse" in kinds:
            found.append(self._clip(parts(False, "NOT fine AND NOT dense"), fine=False).withColumn("fine", F.lit(False)))
        if "dense" in kinds:
            coarse = self._clip(parts(False, "dense"), fine=False)
            many, last = f"size(near) > {self.most_edges}", self.ratio - 1
            found.append(coarse.where(f"NOT {many}").withColumn("fine", F.lit(False)))
            fine.append(
                coarse.where(many).selectExpr(
                    "site_guid", "region_guid", "region_cell AS part", "near AS edges", "ys", "odd",
                    f"grid_row * {self.ratio}L AS south", f"grid_row * {self.ratio}L + {last} AS north",
                    f"grid_column * {self.ratio}L AS west", f"grid_column * {self.ratio}L + {last} AS east",
                )
            )
        if fine or not found:
            every = fine[0].unionByName(fine[1]) if len(fine) > 1 else fine[0] if fine else parts(True, "false")
            found.append(self._clip(every, fine=True).withColumn("fine", F.lit(True)))
        out = found[0]
        for more in found[1:]:
            out = out.unionByName(more)
        return out.select("site_guid", "region_guid", "fine", "region_cell", "near", "ys", "odd")
