"""Stops and work-state changes, read off the telemetry with windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulwright.config import DEFAULT, IDLE, CycleConfig
from haulwright.functions.geo import haversine_m
from haulwright.functions.timing import seconds_between
from haulwright.operators.timeline import neighbour

_ORDER = ["timestamp", "seq"]


def with_previous_state(rows: DataFrame, cfg: CycleConfig = DEFAULT) -> DataFrame:
    """Add `previous_state`, the work state of the asset's row before."""
    cell = F.date_trunc(cfg.time_cell, "timestamp")
    return (
        neighbour(rows, ["asset_guid"], cell, _ORDER, ["work_state_id"], "before")
        .withColumn("previous_state", F.col("before.work_state_id"))
        .drop("before")
    )


def idle_stops(rows: DataFrame, cfg: CycleConfig = DEFAULT, keep: tuple[str, ...] = ()) -> DataFrame:
    """Runs of idle rows per asset: from the first one to the next row not idle.

    Only rows at which the state turns are needed; the end of a stop is the turn
    after it. `keep` are columns of the first row to carry along.
    """
    turns = with_previous_state(rows, cfg).where(
        "previous_state IS NULL OR (previous_state = 2) <> (work_state_id = 2)"
    )
    cell = F.date_trunc(cfg.time_cell, "timestamp")
    stops = neighbour(
        turns, ["asset_guid"], cell, _ORDER, ["timestamp"], "after", ahead=True
    ).where(F.col("work_state_id") == IDLE)
    end = F.col("after.timestamp")
    return stops.select(
        "asset_guid",
        "site_guid",
        F.col("timestamp").alias("stop_start"),
        end.alias("stop_end"),
        seconds_between(F.col("timestamp"), end).alias("idle_seconds"),
        *keep,
    )


def stop_class(stops: DataFrame, cfg: CycleConfig = DEFAULT) -> DataFrame:
    """What a stop means by its area and length."""
    rule = f"""CASE
        WHEN idle_seconds IS NULL THEN 'unfinished'
        WHEN idle_seconds > {cfg.dump_abandoned_s}D THEN 'long'
        WHEN area <> 'TRAVEL' AND idle_seconds > {cfg.fence_outlier_s}D THEN 'outlier'
        WHEN area = 'TRAVEL' AND idle_seconds > {cfg.travel_outlier_s}D THEN 'outlier'
        WHEN area = 'LOAD' AND idle_seconds > {cfg.load_idle_s}D THEN 'load'
        WHEN area = 'DUMP' AND idle_seconds > {cfg.dump_idle_s}D THEN 'dump'
        WHEN area = 'OVERLAP' AND idle_seconds >= {cfg.together_idle_s}D THEN 'together'
        WHEN area = 'TRAVEL' AND idle_seconds > {cfg.load_seen_from_travel_s}D THEN 'seen_from_travel'
        ELSE 'brief' END"""
    return stops.withColumn("stop_class", F.expr(rule))


def state_transitions(rows: DataFrame) -> DataFrame:
    """How often each pair of successive work states occurs, by site and area.

    `rows` carry `previous_state` (`with_previous_state`) and `area`.
    """
    return (
        rows.where("previous_state IS NOT NULL")
        .groupBy("site_guid", "area", "previous_state", "work_state_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def loader_movement(positions: DataFrame, cfg: CycleConfig = DEFAULT) -> DataFrame:
    """Moves between successive positions of a loader, and whether they count."""
    moved = neighbour(
        positions,
        ["asset_guid"],
        F.date_trunc("month", "valid_from"),
        ["valid_from"],
        ["latitude", "longitude"],
        "before",
    ).where("before IS NOT NULL")
    metres = haversine_m(
        "before.latitude", "before.longitude", "latitude", "longitude", cfg.earth_radius_m
    )
    return moved.selectExpr(
        "asset_guid", "site_guid", "valid_from", f"{metres} AS moved_m"
    ).withColumn("has_moved", F.col("moved_m") > cfg.loader_moved_m)
