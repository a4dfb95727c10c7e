"""Questions to stored cycles and progress."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulwright.config import OPEN
from haulwright.operators.timeline import running_totals
from haulwright.schemas import CYCLE_KEY


def open_cycle(cycles: DataFrame) -> DataFrame:
    """The open cycle with the highest number of each asset and site."""
    columns = [c for c in cycles.columns if c not in ("asset_guid", "site_guid")]
    return (
        cycles.where(F.col("cycle_status") == OPEN)
        .groupBy("asset_guid", "site_guid")
        .agg(F.max_by(F.struct(*columns), "cycle_number").alias("row"))
        .select("asset_guid", "site_guid", "row.*")
    )


def next_cycle_number(finished: DataFrame, probes: DataFrame) -> DataFrame:
    """Number after the highest cycle ended by each probe's time; null if none.

    `probes` has asset_guid and at. Cycles and probes are laid on one time line
    per asset, and a running maximum answers every probe at once.
    """
    ends = finished.where("cycle_end_utc IS NOT NULL").select(
        "asset_guid", F.col("cycle_end_utc").alias("at"), F.lit(0).alias("kind"), "cycle_number"
    )
    asked = probes.select(
        "asset_guid", "at", F.lit(1).alias("kind"), F.lit(None).cast("int").alias("cycle_number")
    )
    answered = running_totals(
        ends.unionByName(asked),
        ["asset_guid"],
        F.date_trunc("day", "at"),
        ["at", "kind", "cycle_number"],
        {"highest": F.col("cycle_number")},
        fold=F.max,
    )
    return answered.where("kind = 1").select(
        "asset_guid", F.col("at").alias("asked_at"), (F.col("highest") + 1).alias("next_cycle_number")
    )


def latest_changes(changes: DataFrame) -> DataFrame:
    """The last version of each cycle in a change log: the current table.

    A key holds the changes of one cycle only, so no key is large.
    """
    columns = [c for c in changes.columns if c not in CYCLE_KEY]
    newest = F.struct("current_process_date", "seq")
    return (
        changes.where("action <> 'reject'")
        .groupBy(*CYCLE_KEY)
        .agg(F.max_by(F.struct(*columns), newest).alias("row"))
        .select(*CYCLE_KEY, "row.*")
    )
