"""Regions from their JSON store and from the definition table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulwright.functions.geo import BOX, ring_edges, with_ring

_REGION_JSON = "region_guid string, region_name string, region_type string, points string"


def site_regions(store: DataFrame) -> DataFrame:
    """Load and dump regions of all sites; unusable values are left out."""
    value = F.from_json("payload", _REGION_JSON)
    return (
        store.where(F.schema_of_variant(F.try_parse_json("payload")).startswith("OBJECT"))
        .select("site_guid", value.alias("v"))
        .select(
            "site_guid",
            "v.region_guid",
            "v.region_name",
            F.lower("v.region_type").alias("region_type"),
            "v.points",
        )
        .where("region_type IN ('load', 'dump') AND points <> '' AND region_guid <> ''")
    )


def region_audit(regions: DataFrame) -> DataFrame:
    """Why each region's points form no ring, and its box if they do."""
    ok = F.col("parse_error").isNull()
    return with_ring(regions).select(
        "site_guid",
        "region_guid",
        "region_type",
        "parse_error",
        *(F.when(ok, F.col(name)).alias(name) for name in ["n_points", *BOX]),
    )


def region_shapes(regions: DataFrame) -> DataFrame:
    """Usable rings, parsed once.

    Copies of a ring within a site answer every question like the first of
    them, so only the one with the lowest guid is kept per type.
    """
    distinct = regions.groupBy("site_guid", "region_type", "points").agg(
        F.min("region_guid").alias("region_guid")
    )
    return (
        with_ring(distinct)
        .where("parse_error IS NULL")
        .select("site_guid", "region_type", "region_guid", F.expr(ring_edges("ring")).alias("edges"), *BOX)
    )


def shapes_of(shapes: DataFrame, region_type: str) -> DataFrame:
    return shapes.where(F.col("region_type") == region_type).drop("region_type")


def asset_latest_site(asset_regions: DataFrame, region_sites: DataFrame) -> DataFrame:
    """Site of an asset's newest region; creation dates compare as text."""
    newest = F.struct(F.coalesce("created_date", F.lit("")), F.col("region_guid"))
    return (
        asset_regions.join(region_sites.where("site_guid <> ''"), "region_guid")
        .groupBy("asset_guid")
        .agg(F.max_by("site_guid", newest).alias("site_guid"))
    )


def asset_regions_latest(
    assets: DataFrame, ref_site: DataFrame, regions: DataFrame, asset_guid: str | None = None
) -> DataFrame:
    """Newest usable definition of each region of an asset's site, smallest fence area first.

    Usually asked for one asset (`asset_guid`); without it, for all of them.

    The newest version does not depend on the asset, so versions are reduced
    per region first and assets meet one row per region.
    """
    latest = (
        regions.where("points IS NOT NULL AND NOT is_deleted")
        .groupBy("site_guid", F.col("guid").alias("region_guid"))
        .agg(F.max_by(F.struct("points", "fence_area"), "created_date").alias("newest"))
        .selectExpr(
            "site_guid", "region_guid", "newest.points AS region_points", "newest.fence_area"
        )
    )
    if asset_guid is not None:
        assets = assets.where(F.col("guid") == asset_guid)
    return (
        assets.withColumnRenamed("guid", "asset_guid")
        .join(ref_site.withColumnRenamed("guid", "site_guid"), "site_guid", "left_semi")
        .join(latest, "site_guid")
        .select("asset_guid", "client_guid", "site_guid", "region_guid", "region_points", "fence_area")
        .orderBy("fence_area", "asset_guid", "region_guid")
    )
