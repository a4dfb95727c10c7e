"""Reports on finished cycles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_DURATIONS = [
    "load_seconds",
    "load_travel_seconds",
    "dump_seconds",
    "empty_travel_seconds",
    "total_cycle_seconds",
    "outlier_seconds",
]


def cycle_kpis(finished: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """Count, mean and median of each duration by status, site, loader, dump region.

    Medians are approximate: their rank is off by at most a share of 1 / accuracy,
    so they are exact in groups of fewer cycles than that.
    """
    figures = [F.count(F.lit(1)).alias("n_cycles")]
    for name in _DURATIONS:
        figures.append(F.avg(name).alias(f"avg_{name}"))
        figures.append(F.percentile_approx(name, 0.5, accuracy).alias(f"median_{name}"))
    return finished.groupBy(
        "cycle_status", "site_guid", "loader_asset_guid", "dump_region_guid"
    ).agg(*figures)


def cycle_status_check(finished: DataFrame) -> DataFrame:
    """Cycles by status and whether the status and total fit the durations."""
    whole = (
        "load_seconds IS NOT NULL AND load_travel_seconds IS NOT NULL"
        " AND dump_seconds IS NOT NULL AND empty_travel_seconds IS NOT NULL"
    )
    total = "load_seconds + load_travel_seconds + dump_seconds + empty_travel_seconds"
    return (
        finished.withColumn("has_all_durations", F.expr(whole))
        .withColumn(
            "status_fits",
            F.expr(
                "CASE cycle_status WHEN 'COMPLETE' THEN has_all_durations"
                f" AND total_cycle_seconds = {total}"
                " WHEN 'INVALID' THEN NOT has_all_durations ELSE total_cycle_seconds IS NULL END"
            ),
        )
        .groupBy("cycle_status", "has_all_durations", "status_fits")
        .agg(F.count(F.lit(1)).alias("n_cycles"))
    )
