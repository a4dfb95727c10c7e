"""Telemetry to placed telemetry: who, where, near what."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulwright.config import DEFAULT, CycleConfig
from haulwright.functions.geo import BoxGrid
from haulwright.operators import places, quality
from haulwright.sources.derived import DerivedInputs
from haulwright.sources.regions import (
    asset_latest_site,
    region_shapes,
    shapes_of,
    site_regions,
)

# What decides where a row of telemetry is looked up.
_PLACED = ("asset_guid", "site_guid", "timestamp", "latitude", "longitude")


@dataclass
class Dimensions:
    """The tables telemetry is joined with; none of them is telemetry-sized."""

    assets: DataFrame
    latest_site: DataFrame
    regions: DataFrame
    process_info: DataFrame
    loader_idle: DataFrame

    @staticmethod
    def derived(inputs: DerivedInputs) -> "Dimensions":
        return Dimensions(
            assets=inputs.assets(),
            latest_site=asset_latest_site(inputs.asset_regions(), inputs.region_sites()),
            regions=site_regions(inputs.region_store()),
            process_info=inputs.process_info(),
            loader_idle=inputs.loader_idle(),
        )


@dataclass
class PlaceIndex:
    """The dimensions arranged for lookup by telemetry rows: one row per key.

    The tables are persisted, as every batch of telemetry meets them again; lost
    blocks are worked out anew. Call `release` when done. With `keep=False` they
    are not, so that each micro-batch of a stream reads its dimensions afresh.
    """

    fallback: DataFrame
    trucks: DataFrame
    loader_cells: DataFrame
    dump_cells: DataFrame
    dump_steps: tuple[str, ...]
    made_from: list[DataFrame]

    @staticmethod
    def build(
        dims: Dimensions,
        cfg: CycleConfig = DEFAULT,
        telemetry: DataFrame | None = None,
        keep: bool = True,
    ) -> "PlaceIndex":
        """`telemetry` is needed to reprocess: loaders are looked up for the cells and days it has."""
        realtime = cfg.service == "realtime"
        shapes = region_shapes(dims.regions)
        if keep:
            shapes.persist()
        dumps, loads = shapes_of(shapes, "dump"), shapes_of(shapes, "load")
        # Two looks at the regions, which are few, spare what only wide or many of them need.
        kinds, depth = BoxGrid().kinds(dumps), places.tree_depth(loads)
        steps = places.cell_steps(kinds)
        dump_cells = places.region_cells(dumps, kinds=kinds)
        fallback = quality.fallback_sites(dims.latest_site, dims.assets)
        if realtime:
            loaders = places.loaders_current(dims.process_info, cfg)
        else:
            loaders = places.loader_validity(dims.loader_idle, dims.assets, cfg, merge=True)
        trucks = quality.trucks(dims.assets, cfg).join(quality.loader_sites(loaders), "site_guid", "left")
        if keep:
            dump_cells.persist()
        if realtime:
            cells = places.loader_cells(loaders, cfg, dump_cells, steps)
        else:
            resolved = quality.resolve_site(telemetry.select(*_PLACED), fallback)
            rows = quality.checked(resolved.join(trucks, ["asset_guid", "site_guid"]))
            cells = places.loader_cells_asof(loaders, places.asked_days(rows, cfg), cfg, dump_cells, steps)
        made_from = [shapes, cells.persist()] if keep else []
        index = PlaceIndex(
            fallback=fallback,
            trucks=trucks,
            loader_cells=places.with_load_regions(cells, loads, depth),
            dump_cells=dump_cells,
            dump_steps=steps,
            made_from=made_from,
        )
        if keep:
            for table in index.tables():
                table.persist()
        return index

    def tables(self) -> list[DataFrame]:
        return [self.fallback, self.trucks, self.loader_cells, self.dump_cells]

    def release(self) -> None:
        for table in self.tables() + self.made_from:
            table.unpersist()


def index_for(telemetry: DataFrame, dims: Dimensions, cfg: CycleConfig = DEFAULT) -> PlaceIndex:
    return PlaceIndex.build(dims, cfg, telemetry)


def truck_rows(telemetry: DataFrame, index: PlaceIndex) -> DataFrame:
    """Telemetry of haul trucks with its site, bad positions marked."""
    resolved = quality.resolve_site(telemetry, index.fallback)
    return quality.checked(resolved.join(index.trucks, ["asset_guid", "site_guid"]))


def near_loader(rows: DataFrame, index: PlaceIndex, cfg: CycleConfig = DEFAULT) -> DataFrame:
    """Truck rows with their nearest loader."""
    if cfg.service == "realtime":
        return places.with_nearest_loader(rows, index.loader_cells, cfg)
    return places.with_nearest_loader_asof(rows, index.loader_cells, cfg)


def place(rows: DataFrame, index: PlaceIndex, cfg: CycleConfig = DEFAULT) -> DataFrame:
    """Truck rows with loader, load region, dump region and colocation."""
    rows = places.with_load_region(near_loader(rows, index, cfg), cfg)
    rows = places.with_dump_region(rows, index.dump_cells, steps=index.dump_steps)
    return places.with_colocation(rows)


def placed(telemetry: DataFrame, index: PlaceIndex, cfg: CycleConfig = DEFAULT) -> DataFrame:
    return place(truck_rows(telemetry, index), index, cfg)


def moments(telemetry: DataFrame, index: PlaceIndex, cfg: CycleConfig = DEFAULT) -> DataFrame:
    return places.as_moments(placed(telemetry, index, cfg))
