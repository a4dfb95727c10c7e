"""Folds the telemetry of one truck, record by record, into cycle changes."""

from __future__ import annotations

import json

from haulwright.config import (
    AREA_DUMP,
    AREA_LOAD,
    AREA_TRAVEL,
    LOAD_TIME,
    LOAD_TRAVEL,
    CycleConfig,
)
from haulwright.engine.rules import RULES
from haulwright.engine.state import LostRecord, Sighting, Step, fresh


class CycleMachine:
    """State of one truck: its open cycle at each site and its last change.

    `feed` returns the changes of one record as (action, rule, record) with the
    actions init, update, insert and reject. `dump` and `load` move the state
    through a state store or from one time slice to the next.
    """

    def __init__(self, cfg: CycleConfig, rules=None) -> None:
        self.cfg = cfg
        self.rules = rules or RULES
        self.drops_late = cfg.service == "realtime"
        self.clear()

    def clear(self) -> None:
        self.changed_at: int | None = None
        self.open: dict[str, dict] = {}

    def load(self, text: str | None, numbers: str | None = None) -> None:
        """Take up a dumped state; `numbers` are the cycles counted so far."""
        self.clear()
        if text:
            held = json.loads(text)
            self.changed_at = held["changed_at"]
            self.open = held["open"]
        if numbers:
            for site, number in json.loads(numbers).items():
                if site in self.open:
                    self.open[site]["cycle_number"] += int(number)

    def dump(self) -> str:
        return json.dumps({"changed_at": self.changed_at, "open": self.open}, sort_keys=True)

    def dump_uncounted(self) -> tuple[str, str]:
        """State with cycle numbers set to 0, and the numbers apart."""
        numbers = {site: rec["cycle_number"] for site, rec in self.open.items()}
        held = {site: {**rec, "cycle_number": 0} for site, rec in self.open.items()}
        state = json.dumps({"changed_at": self.changed_at, "open": held}, sort_keys=True)
        return state, json.dumps(numbers, sort_keys=True)

    def feed(self, at: Sighting) -> list[tuple]:
        if at.at_us is None:
            return [("reject", "X7", None)]
        if self.drops_late and self.changed_at is not None and at.at_us <= self.changed_at:
            return []
        if at.bad_position:
            return [("reject", "X6", None)]
        last = self.open.get(at.site_guid)
        try:
            area, together = self._area(at, last)
            if last is None:
                changes = [("init", "D1", fresh(1, at, area, at.at_us))]
            else:
                changes = self._follow(Step(last, at, area, together, self.cfg))
        except LostRecord as lost:
            return [("reject", lost.code, None)]
        if changes:
            self.changed_at = at.at_us
            self.open[at.site_guid] = changes[-1][2]
        return changes

    def _area(self, at: Sighting, last: dict | None) -> tuple[str, bool]:
        near, dump = at.loader_guid is not None, at.dump_region_guid is not None
        if near and dump:
            if last is None and self.cfg.mode == "reference":
                raise LostRecord("X1")
            if last and last["current_segment"] in (LOAD_TIME, LOAD_TRAVEL):
                return AREA_DUMP, False
            return AREA_LOAD, bool(at.colocated)
        if near:
            return AREA_LOAD, False
        return (AREA_DUMP if dump else AREA_TRAVEL), False

    def _follow(self, step: Step) -> list[tuple]:
        if step.together or step.last["all_assets_in_same_dump_area"]:
            rule, update, insert = self.rules["TOGETHER"](step)
        else:
            rule, update, insert = self.rules[step.area](step)
        changes = []
        if update is not None:
            changes.append(("update", rule, update))
        if insert is not None:
            changes.append(("insert", rule, insert))
        return changes
