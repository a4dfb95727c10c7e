"""The whole job: telemetry to cycle changes and the three output tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulwright.config import DEFAULT, FINAL_STATUSES, CycleConfig
from haulwright.engine.batch import cycle_changes
from haulwright.operators.history import latest_changes, open_cycle
from haulwright.operators.quality import latest_process_info
from haulwright.plans.enrich import Dimensions, PlaceIndex, index_for, moments
from haulwright.sources.telemetry import rejected
from haulwright.schemas import CYCLE_COLS, CYCLE_FIELDS, CYCLE_KEY, CYCLE_TABLE_COLS, CYCLE_TIMES, PROCESS_INFO_COLS

# Spark types of the stored cycle table.
CYCLE_TABLE = ", ".join(
    ["asset_cycle_vlx_id bigint"]
    + [f"{name} {kind}" for name, kind in CYCLE_FIELDS]
    + ["created_date timestamp_ntz", "updated_date timestamp_ntz"]
)


def changes(
    telemetry: DataFrame,
    dims: Dimensions,
    cfg: CycleConfig = DEFAULT,
    closed_only: bool = False,
    counts: DataFrame | None = None,
    stored_cycles: DataFrame | None = None,
    stored_progress: DataFrame | None = None,
    index: PlaceIndex | None = None,
) -> DataFrame:
    """Cycle changes of a batch of telemetry.

    Trucks go on from the open cycles of `stored_cycles` (the current table) and,
    in realtime, drop records not later than their `stored_progress`. Without
    these tables every truck starts at its first record. Several batches may share
    an `index` of the dimensions, which in reprocess has to be built for the rows of all.
    """
    rows = moments(telemetry, index or index_for(telemetry, dims, cfg), cfg)
    if counts is None:
        counts = telemetry.groupBy("asset_guid").agg(F.count(F.lit(1)).alias("n"))
    seeds = start_states(stored_cycles, stored_progress, cfg)
    return cycle_changes(rows, cfg, closed_only=closed_only, counts=counts, seeds=seeds)


def start_states(
    cycles: DataFrame | None, progress_table: DataFrame | None, cfg: CycleConfig = DEFAULT
) -> DataFrame | None:
    """asset_guid and carry: the engine's state text of each truck with something stored."""
    parts = []
    if cycles is not None:
        record = F.struct(
            *(
                F.unix_micros(F.col(name).cast("timestamp")).alias(name)
                if name in CYCLE_TIMES
                else F.col(name)
                for name in CYCLE_COLS
            )
        )
        # One entry for each site a truck has worked at.
        entry = F.struct("site_guid", record.alias("record"))
        parts.append(
            open_cycle(cycles.select(*CYCLE_COLS))
            .groupBy("asset_guid")
            .agg(F.map_from_entries(F.collect_list(entry)).alias("open"))
        )
    if progress_table is not None and cfg.service == "realtime":
        newest = latest_process_info(progress_table, cfg.cycle_process)
        date = F.unix_micros(F.col("process_date").cast("timestamp")).alias("changed_at")
        parts.append(newest.select("asset_guid", date))
    if not parts:
        return None
    states = parts[0] if len(parts) == 1 else parts[0].join(parts[1], "asset_guid", "full")
    none = {"open": F.create_map(), "changed_at": F.lit(None).cast("bigint")}
    held = F.struct(
        *(
            (F.coalesce(F.col(c), F.from_json(F.lit("{}"), states.schema[c].dataType)) if c == "open" else F.col(c)).alias(c)
            if c in states.columns
            else none[c].alias(c)
            for c in ("changed_at", "open")
        )
    )
    return states.select("asset_guid", F.to_json(held, {"ignoreNullFields": "false"}).alias("carry"))


def final_cycles(log: DataFrame) -> DataFrame:
    """Every record that closes a cycle."""
    return log.where(F.col("cycle_status").isin(*FINAL_STATUSES)).select(*CYCLE_COLS)


def current_cycles(log: DataFrame) -> DataFrame:
    """Last version of every cycle; closed ones stay."""
    return latest_changes(log).select(*CYCLE_COLS)


def rejects(log: DataFrame, raw: DataFrame | None = None) -> DataFrame:
    """Records the rules lost, with their code; with the raw payloads also those lost before (X7)."""
    lost = log.where("action = 'reject'").select(
        "seq",
        "asset_guid",
        "site_guid",
        F.col("current_process_date").alias("timestamp"),
        F.col("rule").alias("reject"),
    )
    return lost if raw is None else lost.unionByName(rejected(raw))


def progress(log: DataFrame, cfg: CycleConfig = DEFAULT) -> DataFrame:
    """Time of the last change of each asset, with the site it first appeared at."""
    at = F.struct("current_process_date", "seq")
    return (
        log.where("action <> 'reject'")
        .groupBy("asset_guid")
        .agg(
            F.max("current_process_date").alias("process_date"),
            F.min_by("site_guid", at).alias("site_guid"),
        )
        .withColumn("process_name", F.lit(cfg.cycle_process))
    )


def merge_progress(
    stored: DataFrame, log: DataFrame, now: str, cfg: CycleConfig = DEFAULT
) -> DataFrame:
    """Progress table after a batch: new assets inserted, known ones moved on.

    A known row keeps its key, site and creation time.
    """
    fresh = progress(log, cfg).select(
        "asset_guid",
        "process_name",
        F.col("process_date").alias("new_date"),
        F.col("site_guid").alias("new_site"),
    )
    moment = F.lit(now).cast("timestamp_ntz")
    known, changed = F.col("stored"), F.col("new_date").isNotNull()
    merged = stored.select(*PROCESS_INFO_COLS, F.lit(True).alias("stored")).join(
        fresh, ["asset_guid", "process_name"], "full"
    )
    return merged.select(
        F.coalesce("tx_process_info_id", F.xxhash64("asset_guid", "process_name")).alias(
            "tx_process_info_id"
        ),
        "process_name",
        F.greatest("new_date", "process_date").alias("process_date"),
        F.coalesce("created_date", moment).alias("created_date"),
        F.when(known & changed, moment).otherwise(F.col("updated_date")).alias("updated_date"),
        "asset_guid",
        F.coalesce("site_guid", "new_site").alias("site_guid"),
    )


def merge_cycles(stored: DataFrame, log: DataFrame, now: str) -> DataFrame:
    """Current cycle table after a batch: upsert on (site, asset, cycle number)."""
    moment = F.lit(now).cast("timestamp_ntz")
    kept = stored.select(
        *CYCLE_KEY,
        F.struct(*CYCLE_TABLE_COLS).alias("old"),
    )
    fresh = current_cycles(log).select(*CYCLE_KEY, F.struct(*CYCLE_COLS).alias("new"))
    merged = kept.join(fresh, CYCLE_KEY, "full")
    changed = F.col("new").isNotNull()
    values = [
        F.when(changed, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c)
        for c in CYCLE_COLS
    ]
    return merged.select(
        F.coalesce("old.asset_cycle_vlx_id", F.xxhash64(*CYCLE_KEY)).alias("asset_cycle_vlx_id"),
        *values,
        F.coalesce("old.created_date", moment).alias("created_date"),
        F.when(changed, moment).otherwise(F.col("old.updated_date")).alias("updated_date"),
    ).select(*CYCLE_TABLE_COLS)
