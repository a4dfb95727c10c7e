"""Cycle records as plain dictionaries, and the ways a step may change them."""

from __future__ import annotations

from collections import namedtuple

from haulwright.config import LOAD_TIME, OPEN
from haulwright.schemas import CYCLE_COLS, MOMENT_COLS

Sighting = namedtuple("Sighting", MOMENT_COLS)

# rule: which rule applied; update: new version of the open cycle; insert: the
# cycle that follows it. Both are None when the record changes nothing.
Outcome = namedtuple("Outcome", ("rule", "update", "insert"))

_BLANK = dict.fromkeys(CYCLE_COLS)
_BLANK.update(
    cycle_status=OPEN,
    is_within_load_region=False,
    all_assets_in_same_dump_area=False,
    is_outlier=False,
)


class LostRecord(Exception):
    """A record the original rules cannot handle; the state stays as it was."""

    def __init__(self, code: str) -> None:
        super().__init__(code)
        self.code = code


def seconds(start_us: int | None, end_us: int | None) -> float | None:
    if start_us is None or end_us is None:
        return None
    return (end_us - start_us) / 1e6


def fresh(number: int, at: Sighting, area: str, start_us: int, **values) -> dict:
    """A new open cycle in which nothing is known yet but place and time."""
    record = _BLANK.copy()
    record.update(
        asset_guid=at.asset_guid,
        site_guid=at.site_guid,
        cycle_number=number,
        current_process_date=at.at_us,
        current_area=area,
        current_asset_longitude=at.longitude,
        current_asset_latitude=at.latitude,
        current_work_state_id=at.work_state_id,
        cycle_start_utc=start_us,
    )
    record.update(values)
    return record


class Step:
    """One telemetry record meeting the open cycle of its truck."""

    __slots__ = ("last", "at", "area", "together", "cfg", "repaired", "idle", "pair")

    def __init__(self, last, at, area, together, cfg):
        self.last = last
        self.at = at
        self.area = area
        self.together = together
        self.cfg = cfg
        self.repaired = cfg.mode == "repaired"
        self.idle = (at.at_us - last["current_process_date"]) / 1e6
        self.pair = (last["current_work_state_id"], at.work_state_id)

    def keep(self, **values) -> dict:
        """The open cycle carried to this record, with some columns replaced."""
        last, at = self.last, self.at
        record = last.copy()
        record["current_process_date"] = at.at_us
        record["current_area"] = self.area
        record["current_asset_longitude"] = at.longitude
        record["current_asset_latitude"] = at.latitude
        record["previous_work_state_id"] = last["current_work_state_id"]
        record["current_work_state_id"] = at.work_state_id
        record.update(values)
        return record

    def next_without_loader(self, start_us: int, **values) -> dict:
        return fresh(self.last["cycle_number"] + 1, self.at, self.area, start_us, **values)

    def next_at_loader(self, **values) -> dict:
        """The following cycle, opened at the loader when the stop began."""
        since = self.last["current_process_date"]
        opened = dict(
            current_segment=LOAD_TIME,
            current_loader_distance=self.at.loader_distance,
            load_start_utc=since,
            **self.loader(),
            **self.load_region("X3"),
        )
        opened.update(values)
        start = opened.pop("cycle_start_utc", since)
        return self.next_without_loader(start, **opened)

    def loader(self) -> dict:
        at = self.at
        return dict(
            loader_asset_guid=at.loader_guid,
            loader_latitude=at.loader_latitude,
            loader_longitude=at.loader_longitude,
        )

    def load_region(self, lost_code: str | None = None) -> dict:
        """Load-region columns; without a region they are blank, or lost."""
        at = self.at
        if at.load_region_guid is None:
            if lost_code and not self.repaired:
                raise LostRecord(lost_code)
            return dict(
                load_region_guid=None,
                is_within_load_region=False,
                asset_load_region_distance=None,
            )
        return dict(
            load_region_guid=at.load_region_guid,
            is_within_load_region=at.in_load_region,
            asset_load_region_distance=at.load_region_distance,
        )

    def loader_distances(self) -> dict:
        return dict(
            previous_loader_distance=self.last["current_loader_distance"],
            current_loader_distance=self.at.loader_distance,
        )

    def outlier_here(self, kind: int, span: float, **values) -> dict:
        return dict(
            is_outlier=True,
            outlier_type_id=kind,
            outlier_seconds=span,
            **self.outlier_place(),
            **values,
        )

    def outlier_place(self) -> dict:
        last = self.last
        return dict(
            outlier_date_utc=last["current_process_date"],
            outlier_position_latitude=last["current_asset_latitude"],
            outlier_position_longitude=last["current_asset_longitude"],
        )

    def outlier_loader(self) -> dict:
        at = self.at
        return dict(
            outlier_loader_guid=at.loader_guid,
            outlier_loader_latitude=at.loader_latitude,
            outlier_loader_longitude=at.loader_longitude,
        )


NOTHING_PENDING = dict(idle_in_dump_region_guid=None, tmp_idle_near_loader=None)
