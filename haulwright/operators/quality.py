"""Filters and audits on telemetry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulwright.config import CycleConfig
from haulwright.functions.geo import position_ok


def fallback_sites(latest_site: DataFrame, assets: DataFrame) -> DataFrame:
    """Site of each asset for payloads without one: its newest region's, else its own."""
    by_asset = assets.groupBy(F.col("guid").alias("asset_guid")).agg(
        F.min("site_guid").alias("home_site")
    )
    by_region = latest_site.select("asset_guid", F.col("site_guid").alias("region_site"))
    return (
        by_asset.join(by_region, "asset_guid", "full")
        .withColumn("fallback_site", F.coalesce("region_site", "home_site"))
        .where("fallback_site IS NOT NULL")
        .select("asset_guid", "fallback_site")
    )


def resolve_site(telemetry: DataFrame, fallback: DataFrame) -> DataFrame:
    """Payload site, else the fallback; a row without either is dropped."""
    given = F.nullif(F.col("site_guid"), F.lit(""))
    return (
        telemetry.join(fallback, "asset_guid", "left")
        .withColumn("site_guid", F.coalesce(given, "fallback_site"))
        .where("site_guid IS NOT NULL")
        .drop("fallback_site")
    )


def trucks(assets: DataFrame, cfg: CycleConfig) -> DataFrame:
    """Haul trucks with their site."""
    return (
        assets.where(F.col("asset_type_guid") == cfg.truck_type)
        .select(F.col("guid").alias("asset_guid"), "site_guid")
        .distinct()
    )


def truck_telemetry(telemetry: DataFrame, assets: DataFrame, cfg: CycleConfig) -> DataFrame:
    """Rows of assets listed as haul trucks at the row's site."""
    return telemetry.join(trucks(assets, cfg), ["asset_guid", "site_guid"], "left_semi")


def latest_process_info(process_info: DataFrame, process_name: str) -> DataFrame:
    """Newest progress row of each asset for one process."""
    newest = F.struct("process_date", "tx_process_info_id")
    columns = [
        "tx_process_info_id", "process_name", "process_date", "asset_guid", "site_guid",
    ]
    return (
        process_info.where(F.col("process_name") == process_name)
        .groupBy("asset_guid")
        .agg(F.max_by(F.struct(*columns), newest).alias("row"))
        .select("row.*")
    )


def fresh_telemetry(telemetry: DataFrame, process_info: DataFrame, cfg: CycleConfig) -> DataFrame:
    """Rows later than the progress already made for their asset."""
    reached = latest_process_info(process_info, cfg.cycle_process).select(
        "asset_guid", F.col("process_date").alias("reached")
    )
    return (
        telemetry.join(reached, "asset_guid", "left")
        .where("reached IS NULL OR timestamp > reached")
        .drop("reached")
    )


def loader_sites(loaders: DataFrame) -> DataFrame:
    """Sites with loaders, and since when if the loaders' places have a beginning."""
    if "valid_from" not in loaders.columns:
        return loaders.select("site_guid").distinct().withColumn(
            "loaders_since", F.lit("0001-01-01 00:00:00").cast("timestamp_ntz")
        )
    return loaders.groupBy("site_guid").agg(F.min("valid_from").alias("loaders_since"))


def with_position_check(telemetry: DataFrame, loaders: DataFrame) -> DataFrame:
    """Add `bad_position`; positions are only checked at sites that have loaders."""
    return checked(telemetry.join(loader_sites(loaders), "site_guid", "left"))


def checked(rows: DataFrame) -> DataFrame:
    seen = "coalesce(date_trunc('second', timestamp) >= loaders_since, false)"
    bad = f"NOT {position_ok('latitude', 'longitude')} AND {seen}"
    return rows.withColumn("bad_position", F.expr(bad)).drop("loaders_since")


def coordinate_audit(telemetry: DataFrame, loaders: DataFrame) -> DataFrame:
    """Good and bad positions per site."""
    return (
        with_position_check(telemetry, loaders)
        .groupBy("site_guid")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if("bad_position").alias("n_bad"),
            F.min("latitude").alias("min_latitude"),
            F.max("latitude").alias("max_latitude"),
        )
    )
