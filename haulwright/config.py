"""Settings shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass, fields


# Thresholds of the haul-cycle rules.
@dataclass(frozen=True)
class CycleConfig:
    loader_radius_m: float = 30.0
    loader_moved_m: float = 10.0
    together_idle_s: float = 30.0
    load_idle_s: float = 20.0
    dump_idle_s: float = 15.0
    travel_outlier_s: float = 600.0
    fence_outlier_s: float = 1200.0
    load_seen_from_travel_s: float = 45.0
    dump_seen_from_travel_s: float = 45.0
    dump_abandoned_s: float = 1800.0
    synthetic_load_s: float = 20.0
    synthetic_dump_s: float = 900.0
    synthetic_empty_s: float = 900.0
    metres_per_degree: float = 111320.0
    earth_radius_m: float = 6371000.0

    # Names that differ between installations.
    truck_type: str = "haul-truck"
    loader_type: str = "loader"
    cycle_process: str = "cycles"
    idle_process: str = "idle-states"

    # "realtime" drops late records and keeps progress; "reprocess" does neither.
    service: str = "realtime"
    # "reference" loses the records that the original rules cannot handle and
    # reports them as rejects; "repaired" handles them.
    mode: str = "reference"

    # An asset with more rows than this is folded in several time slices.
    max_rows_per_slice: int = 2_000_000
    # Rounds after which trucks whose slices haven't settled are folded as a whole.
    settle_rounds: int = 4
    # Width of the time cells used to cut ordered work on one asset.
    time_cell: str = "hour"

    def __post_init__(self) -> None:
        for f in fields(self):
            if not f.name.endswith(("_s", "_m")):
                continue
            value = getattr(self, f.name)
            if isinstance(value, bool) or not isinstance(value, (int, float)):
                raise TypeError(f"{f.name} must be a number")
            if not value >= 0:
                raise ValueError(f"{f.name} must not be negative")
        if self.service not in ("realtime", "reprocess"):
            raise ValueError(f"unknown service {self.service!r}")
        if self.mode not in ("reference", "repaired"):
            raise ValueError(f"unknown mode {self.mode!r}")


DEFAULT = CycleConfig()

# Work states, cycle statuses, segments, areas.
IDLE = 2
WORKING = 3
OPEN = "INPROGRESS"
COMPLETE = "COMPLETE"
INVALID = "INVALID"
OUTLIER = "OUTLIER"
FINAL_STATUSES = (COMPLETE, INVALID, OUTLIER)
LOAD_TIME = "LOAD_TIME"
LOAD_TRAVEL = "LOAD_TRAVEL"
DUMP_TIME = "DUMP_TIME"
EMPTY_TRAVEL = "EMPTY_TRAVEL"
AREA_LOAD = "LOAD"
AREA_DUMP = "DUMP"
AREA_TRAVEL = "TRAVEL"
