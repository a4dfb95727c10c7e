"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulwright.config import DEFAULT, CycleConfig
from haulwright.functions.timing import elapsed_text
from haulwright.functions.geo import BoxGrid
from haulwright.operators import history, kpis, places, quality, stops
from haulwright.plans import cycles
from haulwright.plans.enrich import (
    Dimensions,
    PlaceIndex,
    index_for,
    near_loader,
    place,
    placed,
    truck_rows,
)
from haulwright.schemas import CYCLE_COLS, CYCLE_FIELDS
from haulwright.session import LAST_KEY_COUNTS, use_checkpoint_dir
from haulwright.sources import regions, tables, telemetry
from haulwright.sources.derived import DerivedInputs

Query = Callable[[SparkSession, str], DataFrame]

REPROCESS = replace(DEFAULT, service="reprocess")
REPAIRED = replace(DEFAULT, mode="repaired")
#: Where the derived telemetry is cut into two runs.
HALFWAY = "2024-01-01 01:50:00"


def _inputs(spark: SparkSession, folder: str) -> tuple[DerivedInputs, Dimensions]:
    inputs = DerivedInputs(spark, folder)
    return inputs, Dimensions.derived(inputs)


def _resolved(inputs: DerivedInputs, dims: Dimensions) -> DataFrame:
    fallback = quality.fallback_sites(dims.latest_site, dims.assets)
    return quality.resolve_site(inputs.telemetry(), fallback)


def _trucks(inputs: DerivedInputs, dims: Dimensions) -> DataFrame:
    return quality.truck_telemetry(_resolved(inputs, dims), dims.assets, DEFAULT)


def _placed(spark: SparkSession, folder: str, cfg: CycleConfig = DEFAULT) -> DataFrame:
    inputs, dims = _inputs(spark, folder)
    rows = inputs.telemetry()
    return placed(rows, index_for(rows, dims, cfg), cfg)


def _truck_rows(
    spark: SparkSession, folder: str, cfg: CycleConfig = DEFAULT
) -> tuple[DataFrame, PlaceIndex]:
    inputs, dims = _inputs(spark, folder)
    rows = inputs.telemetry()
    index = index_for(rows, dims, cfg)
    return truck_rows(rows, index), index


def _with_area(rows: DataFrame, index: PlaceIndex) -> DataFrame:
    """Truck rows with their static area; places are looked up once per row."""
    found = place(rows, index).selectExpr(
        *rows.columns, "loader.guid AS loader_guid", "dump_region.region_guid AS dump_region_guid"
    )
    return found.withColumn("area", F.expr(places.AREA_STATIC)).select(*rows.columns, "area")


def _log(
    spark: SparkSession, folder: str, cfg: CycleConfig = DEFAULT, closed_only: bool = False
) -> DataFrame:
    inputs, dims = _inputs(spark, folder)
    return cycles.changes(
        inputs.telemetry(), dims, cfg, closed_only=closed_only, counts=inputs.rows_per_asset(),
        stored_progress=dims.process_info,
    )


def _finished(spark: SparkSession, folder: str, cfg: CycleConfig = DEFAULT) -> DataFrame:
    return cycles.final_cycles(_log(spark, folder, cfg, closed_only=True))


def _shown(rows: DataFrame) -> DataFrame:
    """Cycle columns with distances to the millimetre, places to six decimals."""
    columns = []
    for name, kind in CYCLE_FIELDS:
        if kind == "double" and name.endswith("distance"):
            columns.append(f"round({name}, 3) AS {name}")
        elif kind == "double" and name.endswith(("latitude", "longitude")):
            columns.append(f"round({name}, 6) AS {name}")
        elif name == "tmp_idle_near_loader":
            columns.append(
                "get_json_object(tmp_idle_near_loader, '$.loader_asset_guid') AS pending_loader_guid"
            )
        else:
            columns.append(name)
    extra = [c for c in rows.columns if c not in CYCLE_COLS]
    return rows.selectExpr(*extra, *columns)


# --- sources ----------------------------------------------------------------------


def telemetry_decode(spark, folder):
    raw = DerivedInputs(spark, folder).telemetry_raw()
    return telemetry.decode(raw).selectExpr(
        "shard", "sequence_number", "sub_sequence_number", "item_no",
        "try_variant_get(item, '$.asset_guid', 'string') AS asset_guid",
        "try_variant_get(item, '$.timestamp', 'string') AS timestamp_text",
        "try_variant_get(item, '$.site_guid', 'string') AS site_guid",
    )


def telemetry_rejects(spark, folder):
    return telemetry.payload_rejects(DerivedInputs(spark, folder).telemetry_raw())


def telemetry_typed(spark, folder):
    rows = telemetry.typed(DerivedInputs(spark, folder).telemetry_raw())
    return rows.withColumns(
        {"longitude": F.round("longitude", 6), "latitude": F.round("latitude", 6)}
    )


def shard_high_water(spark, folder):
    return telemetry.shard_high_water(DerivedInputs(spark, folder).telemetry_raw())


def table_read(spark, folder):
    return tables.table_read(
        DerivedInputs(spark, folder).process_info(),
        columns=["tx_process_info_id", "asset_guid", "process_date"],
        where=f"process_name = '{DEFAULT.cycle_process}' AND site_guid = 'S1'",
        order_by=[F.col("process_date").desc(), "tx_process_info_id"],
        limit=20,
    )


def sql_read(spark, folder):
    return tables.sql_read(
        spark,
        """SELECT site_guid, count(*) AS n_assets, max(process_date) AS last_date
           FROM {progress} WHERE process_name = :process GROUP BY site_guid""",
        {"process": DEFAULT.cycle_process},
        progress=DerivedInputs(spark, folder).process_info(),
    )


def site_regions(spark, folder):
    return regions.site_regions(DerivedInputs(spark, folder).region_store())


def region_audit(spark, folder):
    return regions.region_audit(site_regions(spark, folder))


# --- filters ------------------------------------------------------------------------


def truck_telemetry(spark, folder):
    rows = _trucks(*_inputs(spark, folder))
    return rows.select("seq", "asset_guid", "site_guid", "timestamp", "work_state_id")


def fresh_telemetry(spark, folder):
    inputs, dims = _inputs(spark, folder)
    rows = quality.fresh_telemetry(inputs.telemetry(), dims.process_info, DEFAULT)
    return rows.select("seq", "asset_guid", "timestamp")


def coordinate_audit(spark, folder):
    inputs, dims = _inputs(spark, folder)
    loaders = places.loaders_current(dims.process_info)
    return quality.coordinate_audit(_trucks(inputs, dims), loaders).withColumns(
        {"min_latitude": F.round("min_latitude", 6), "max_latitude": F.round("max_latitude", 6)}
    )


# --- joins --------------------------------------------------------------------------


def resolved_site(spark, folder):
    return _resolved(*_inputs(spark, folder)).select("seq", "asset_guid", "site_guid")


def asset_latest_site(spark, folder):
    return _inputs(spark, folder)[1].latest_site


def loaders_current(spark, folder):
    rows = places.loaders_current(DerivedInputs(spark, folder).process_info())
    return rows.withColumn("latitude", F.round("latitude", 6)).withColumn(
        "longitude", F.round("longitude", 6)
    )


def loaders_asof(spark, folder):
    inputs = DerivedInputs(spark, folder)
    rows = places.loader_validity(inputs.loader_idle(), inputs.assets())
    return rows.withColumn("latitude", F.round("latitude", 6)).withColumn(
        "longitude", F.round("longitude", 6)
    )


def _nearest(rows: DataFrame) -> DataFrame:
    return rows.selectExpr(
        "seq", "asset_guid", "loader.guid AS loader_guid", "round(loader.distance, 3) AS loader_distance"
    )


def nearest_loader(spark, folder):
    inputs, dims = _inputs(spark, folder)
    loaders = places.loaders_current(dims.process_info)
    rows = quality.with_position_check(_trucks(inputs, dims), loaders)
    return _nearest(places.with_nearest_loader(rows, places.loader_cells(loaders)))


def nearest_loader_asof(spark, folder):
    rows, index = _truck_rows(spark, folder, REPROCESS)
    return _nearest(near_loader(rows, index, REPROCESS))


def nearest_load_region(spark, folder):
    return _placed(spark, folder).where("load_region IS NOT NULL").selectExpr(
        "seq", "load_region.guid AS load_region_guid", "NOT load_region.outside AS in_load_region",
        "round(load_region.distance, 3) AS load_region_distance",
    )


def dump_region_hit(spark, folder):
    inputs, dims = _inputs(spark, folder)
    shapes = regions.shapes_of(regions.region_shapes(dims.regions), "dump")
    kinds = BoxGrid().kinds(shapes)
    cells = places.region_cells(shapes, kinds=kinds)
    return places.with_dump_region(_trucks(inputs, dims), cells, steps=places.cell_steps(kinds)).selectExpr(
        "seq", "asset_guid", "dump_region.region_guid AS dump_region_guid"
    )


def colocation(spark, folder):
    return _placed(spark, folder).where("loader IS NOT NULL AND dump_region IS NOT NULL").selectExpr(
        "seq", "loader.guid AS loader_guid", "dump_region.region_guid AS dump_region_guid", "colocated"
    )


def area_static(spark, folder):
    return _with_area(*_truck_rows(spark, folder)).select("seq", "asset_guid", "area")


def asset_regions_latest(spark, folder):
    inputs = DerivedInputs(spark, folder)
    return regions.asset_regions_latest(
        inputs.assets(), inputs.ref_site(), inputs.region_master()
    )


def latest_process_info(spark, folder):
    inputs = DerivedInputs(spark, folder)
    return quality.latest_process_info(inputs.process_info(), DEFAULT.cycle_process)


# --- cycles --------------------------------------------------------------------------


def cycle_change_log(spark, folder):
    return _shown(_log(spark, folder).where("action <> 'reject'"))


def cycles_final(spark, folder):
    return _shown(_finished(spark, folder))


def cycles_current(spark, folder):
    return _shown(cycles.current_cycles(_log(spark, folder)))


def cycles_current_merged(spark, folder):
    """The current table after two runs, the second of which goes on from the first's tables."""
    inputs, dims = _inputs(spark, folder)
    # Both runs read the same telemetry and look places up in the same tables, which are made once.
    rows, now = _stored(inputs.telemetry()), "2024-06-01 00:00:00"
    index = index_for(rows, dims)
    early = F.col("timestamp") < F.lit(HALFWAY).cast("timestamp_ntz")
    first = cycles.changes(
        rows.where(early), dims, counts=inputs.rows_per_asset(), stored_progress=dims.process_info, index=index
    )
    empty = spark.createDataFrame([], cycles.CYCLE_TABLE)
    table = _stored(cycles.merge_cycles(empty, first, now))
    progress = _stored(cycles.merge_progress(_progress_table(inputs), first, now))
    second = cycles.changes(
        rows.where(~early), dims, counts=inputs.rows_per_asset(),
        stored_cycles=table, stored_progress=progress, index=index,
    )
    return _shown(cycles.merge_cycles(table, second, now).select(*CYCLE_COLS))


def cycles_from_payloads(spark, folder):
    """Finished cycles from raw payloads on."""
    inputs, dims = _inputs(spark, folder)
    log = cycles.changes(
        telemetry.telemetry(inputs.telemetry_raw()), dims, closed_only=True,
        counts=inputs.rows_per_asset(), stored_progress=dims.process_info,
    )
    return _shown(cycles.final_cycles(log))


def cycle_rejects_from_payloads(spark, folder):
    """Every record lost on the way from raw payloads: those that fail on a field, and those that rules lose."""
    inputs, dims = _inputs(spark, folder)
    raw = inputs.telemetry_raw()
    log = cycles.changes(
        telemetry.telemetry(raw), dims, counts=inputs.rows_per_asset(), stored_progress=dims.process_info
    )
    return cycles.rejects(log, raw).drop("seq")


def rule_coverage(spark, folder):
    """How often each rule of the engine applied, by service and mode."""
    runs = {"realtime": DEFAULT, "reprocess": REPROCESS, "repaired": REPAIRED}
    logs = [_log(spark, folder, cfg).select(F.lit(name).alias("run"), "rule", "action") for name, cfg in runs.items()]
    every = logs[0].unionByName(logs[1]).unionByName(logs[2])
    return every.groupBy("run", "rule", "action").agg(F.count(F.lit(1)).alias("n"))


def cycle_rejects_reprocess(spark, folder):
    return cycles.rejects(_log(spark, folder, REPROCESS))


def cycles_final_reprocess(spark, folder):
    return _shown(_finished(spark, folder, REPROCESS))


def cycles_final_repaired(spark, folder):
    return _shown(_finished(spark, folder, REPAIRED))


def cycle_rejects(spark, folder):
    return cycles.rejects(_log(spark, folder))


def process_info(spark, folder):
    inputs = DerivedInputs(spark, folder)
    log = _log(spark, folder)
    merged = cycles.merge_progress(_progress_table(inputs), log, "2024-06-01 00:00:00")
    return merged.drop("tx_process_info_id")


def _progress_table(inputs: DerivedInputs) -> DataFrame:
    moment = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    latest = quality.latest_process_info(inputs.process_info(), DEFAULT.cycle_process)
    return latest.withColumns({"created_date": moment, "updated_date": F.lit(None).cast("timestamp_ntz")})


def _stored(rows: DataFrame) -> DataFrame:
    """A table between two runs, in the checkpoint folder."""
    use_checkpoint_dir(rows.sparkSession)
    return rows.checkpoint(eager=True)


def open_cycle(spark, folder):
    rows = history.open_cycle(cycles.current_cycles(_log(spark, folder)))
    return rows.select(
        "asset_guid", "site_guid", "cycle_number", "current_segment", "current_process_date"
    )


def next_cycle_number(spark, folder):
    probes = quality.latest_process_info(
        DerivedInputs(spark, folder).process_info(), DEFAULT.cycle_process
    ).select("asset_guid", F.col("process_date").alias("at"))
    return history.next_cycle_number(_finished(spark, folder), probes)


def duration_report(spark, folder):
    rows = _finished(spark, folder)
    return rows.select(
        "asset_guid", "cycle_number", "cycle_status",
        elapsed_text(F.col("total_cycle_seconds")).alias("total_text"),
        elapsed_text(F.col("outlier_seconds")).alias("outlier_text"),
    )


# --- stops and reports -----------------------------------------------------------------


def idle_stops(spark, folder):
    return stops.idle_stops(_trucks(*_inputs(spark, folder)))


def stop_class(spark, folder):
    # Stops are found first, so that only their first rows are looked up.
    rows, index = _truck_rows(spark, folder)
    found = stops.idle_stops(rows, keep=("longitude", "latitude", "bad_position"))
    return stops.stop_class(_with_area(found, index)).drop(
        "longitude", "latitude", "bad_position"
    )


def state_transitions(spark, folder):
    rows, index = _truck_rows(spark, folder)
    return stops.state_transitions(_with_area(stops.with_previous_state(rows), index))


def loader_movement(spark, folder):
    inputs = DerivedInputs(spark, folder)
    rows = stops.loader_movement(places.loader_validity(inputs.loader_idle(), inputs.assets()))
    return rows.withColumn("moved_m", F.round("moved_m", 3))


def cycle_status_check(spark, folder):
    return kpis.cycle_status_check(_finished(spark, folder))


def cycle_kpis(spark, folder):
    rows = kpis.cycle_kpis(_finished(spark, folder))
    averages = [c for c in rows.columns if c.startswith("avg_")]
    return rows.withColumns({c: F.round(c, 4) for c in averages})


def _in_utc(query: Query) -> Query:
    """Times are UTC throughout, so the session has to be; JSON keys may occur twice."""

    @wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        spark.conf.set(*LAST_KEY_COUNTS)
        return query(spark, folder)

    return run


QUERIES: dict[str, Query] = {
    f.__name__: _in_utc(f)
    for f in (
        telemetry_decode, telemetry_rejects, telemetry_typed, shard_high_water, table_read,
        sql_read, site_regions, region_audit, truck_telemetry, fresh_telemetry,
        coordinate_audit, resolved_site, asset_latest_site, loaders_current, loaders_asof,
        nearest_loader, nearest_loader_asof, nearest_load_region, dump_region_hit, colocation,
        area_static, asset_regions_latest, latest_process_info, cycle_change_log, cycles_final,
        cycles_current, cycles_current_merged, cycles_from_payloads, cycle_rejects_from_payloads, rule_coverage,
        cycle_rejects_reprocess, cycles_final_reprocess, cycles_final_repaired, cycle_rejects,
        process_info, open_cycle, next_cycle_number, duration_report, idle_stops, stop_class,
        state_transitions, loader_movement, cycle_status_check, cycle_kpis,
    )
}
