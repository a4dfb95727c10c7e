"""The haul-cycle rules, one function per area.

Each function takes a `Step` and returns an `Outcome`. Rule names follow the
a dump area, T travelling.
"""

from __future__ import annotations

import json
import math

from haulwright.config import (
    AREA_DUMP,
    AREA_LOAD,
    AREA_TRAVEL,
    COMPLETE,
    DUMP_TIME,
    EMPTY_TRAVEL,
    IDLE,
    INVALID,
    LOAD_TIME,
    LOAD_TRAVEL,
    OUTLIER,
    WORKING,
)
from haulwright.engine.state import (
    NOTHING_PENDING,
    LostRecord,
    Outcome,
    Step,
    seconds,
)

STAYS_IDLE = (IDLE, IDLE)
STOPS = (WORKING, IDLE)
STARTS = (IDLE, WORKING)
STAYS_WORKING = (WORKING, WORKING)


def _quiet(rule: str) -> Outcome:
    return Outcome(rule, None, None)


def _metres(lat1, lon1, lat2, lon2, radius) -> float:
    half_lat = math.sin(math.radians(lat2 - lat1) / 2)
    half_lon = math.sin(math.radians(lon2 - lon1) / 2)
    a = half_lat**2 + math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * half_lon**2
    return radius * (2 * math.atan2(math.sqrt(a), math.sqrt(1 - a)))


def _grown(step: Step, column: str) -> float:
    return (step.last[column] or 0) + step.idle


def _travel_since_load(step: Step) -> float | None:
    return seconds(step.last["load_end_utc"], step.last["current_process_date"])


def _finished(step: Step, empty: float | None) -> dict:
    """Status, total and end of a cycle whose truck is back from dumping."""
    last = step.last
    parts = (last["load_seconds"], last["load_travel_seconds"], last["dump_seconds"], empty)
    whole = None not in parts
    return dict(
        cycle_status=COMPLETE if whole else INVALID,
        empty_travel_seconds=empty,
        total_cycle_seconds=sum(parts) if whole else None,
        cycle_end_utc=last["current_process_date"],
        **NOTHING_PENDING,
    )


def _back_from_dump(step: Step) -> dict:
    empty = seconds(step.last["dump_end_utc"], step.last["current_process_date"])
    return step.keep(**_finished(step, empty), **step.loader_distances())


# --- S: truck and loader in the same dump area -------------------------------


def together(step: Step) -> Outcome:
    last, at = step.last, step.at
    flagged = last["all_assets_in_same_dump_area"]
    if flagged and step.together:
        return _quiet("S2")
    if flagged:
        since = last["current_process_date"]
        closed = step.keep(
            cycle_status=OUTLIER, cycle_end_utc=since, all_assets_in_same_dump_area=True
        )
        return Outcome("S3", closed, step.next_without_loader(since))
    waited = step.idle if step.pair in (STAYS_IDLE, STARTS) else 0
    if step.together and waited >= step.cfg.together_idle_s:
        return Outcome(
            "S1",
            step.keep(
                outlier_type_id=1,
                all_assets_in_same_dump_area=True,
                outlier_dump_region_guid=at.dump_region_guid,
                **step.outlier_place(),
                **step.outlier_loader(),
            ),
            None,
        )
    return _quiet("S4")


# --- L: at a loader -----------------------------------------------------------


def loading(step: Step) -> Outcome:
    if step.pair == STAYS_IDLE:
        return _waiting_at_loader(step)
    if step.pair == STOPS:
        return _stopping_at_loader(step)
    if step.pair == STARTS:
        return _leaving_loader(step)
    return _quiet("L1" if step.pair == STAYS_WORKING else "L23")


def _waiting_at_loader(step: Step) -> Outcome:
    last, at, cfg = step.last, step.at, step.cfg
    segment = last["current_segment"]
    if step.idle <= cfg.load_idle_s:
        return _quiet("L2")
    if segment == LOAD_TIME:
        if last["is_outlier"] or step.idle <= cfg.fence_outlier_s:
            return _quiet("L4")
        marked = step.keep(**step.outlier_here(3, step.idle, **step.outlier_loader()))
        return Outcome("L3", marked, None)
    if segment is None:
        begun = step.keep(
            current_segment=LOAD_TIME,
            load_start_utc=last["current_process_date"],
            **step.loader(),
            **step.loader_distances(),
            **step.load_region(),
        )
        return Outcome("L5", begun, None)
    if segment == LOAD_TRAVEL:
        closed = step.keep(
            cycle_status=INVALID,
            load_travel_seconds=_travel_since_load(step),
            cycle_end_utc=last["current_process_date"],
            **step.loader_distances(),
            **NOTHING_PENDING,
        )
        return Outcome("L6", closed, step.next_at_loader())
    if segment == EMPTY_TRAVEL:
        return Outcome("L7", _back_from_dump(step), step.next_at_loader())
    left_open = step.keep(
        dump_region_guid=last["idle_in_dump_region_guid"],
        dump_end_utc=at.at_us,
        dump_seconds=step.idle,
        cycle_end_utc=at.at_us,
        **NOTHING_PENDING,
    )
    return Outcome("L8", left_open, step.next_at_loader())


def _stopping_at_loader(step: Step) -> Outcome:
    note = {**step.loader(), **step.load_region("X2")}
    return Outcome("L9", step.keep(tmp_idle_near_loader=json.dumps(note)), None)


def _leaving_loader(step: Step) -> Outcome:
    last, at, cfg = step.last, step.at, step.cfg
    segment = last["current_segment"]
    if last["is_outlier"]:
        return _outlier_at_loader("L10", step)
    if segment == DUMP_TIME:
        return _dump_ended_unseen(step)
    if step.idle > cfg.fence_outlier_s:
        return _outlier_at_loader("L13", step)
    if step.idle > cfg.load_idle_s:
        if segment is None:
            loaded = step.keep(
                current_segment=LOAD_TRAVEL,
                load_start_utc=last["current_process_date"],
                load_end_utc=at.at_us,
                load_seconds=step.idle,
                **step.loader(),
                **step.loader_distances(),
                **step.load_region(),
            )
            return Outcome("L14", loaded, None)
        if segment == EMPTY_TRAVEL:
            following = step.next_at_loader(
                current_segment=LOAD_TRAVEL,
                previous_work_state_id=last["current_work_state_id"],
                previous_loader_distance=last["current_loader_distance"],
                load_end_utc=at.at_us,
                load_seconds=step.idle,
            )
            return Outcome("L15", _back_from_dump(step), following)
        if segment == LOAD_TRAVEL:
            return _loaded_truck_stopped(step)
    if segment is None:
        return Outcome("L20", step.keep(), None)
    if segment == LOAD_TIME and last["load_start_utc"] is not None:
        loaded = step.keep(
            current_segment=LOAD_TRAVEL,
            load_end_utc=at.at_us,
            load_seconds=seconds(last["load_start_utc"], at.at_us),
            **step.loader_distances(),
        )
        return Outcome("L21", loaded, None)
    return Outcome("L22", step.keep(), None)


def _loaded_truck_stopped(step: Step) -> Outcome:
    last, at, cfg = step.last, step.at, step.cfg
    if last["current_area"] == AREA_DUMP:
        dumped = step.keep(
            current_segment=EMPTY_TRAVEL,
            idle_in_dump_region_guid=None,
            dump_region_guid=last["idle_in_dump_region_guid"],
            dump_start_utc=last["current_process_date"],
            dump_end_utc=at.at_us,
            dump_seconds=step.idle,
            load_travel_seconds=_travel_since_load(step),
        )
        return Outcome("L16", dumped, None)
    lat, lon = last["loader_latitude"], last["loader_longitude"]
    same = (
        lat
        and lon
        and last["loader_asset_guid"] == at.loader_guid
        and last["current_area"] == AREA_LOAD
        and _metres(lat, lon, at.loader_latitude, at.loader_longitude, cfg.earth_radius_m)
        <= cfg.loader_moved_m
    )
    if not same:
        return Outcome("L18", step.keep(), None)
    topped_up = step.keep(
        load_seconds=_grown(step, "load_seconds"),
        load_end_utc=at.at_us,
        **step.loader_distances(),
    )
    return Outcome("L17", topped_up, None)


def _outlier_at_loader(rule: str, step: Step) -> Outcome:
    last, at, cfg = step.last, step.at, step.cfg
    if last["is_outlier"] and last["outlier_seconds"]:
        marks = dict(outlier_seconds=_grown(step, "outlier_seconds"))
    else:
        marks = step.outlier_here(3, step.idle, **step.outlier_loader())
    closed = step.keep(
        cycle_status=OUTLIER, cycle_end_utc=at.at_us, **NOTHING_PENDING, **marks
    )
    following = step.next_at_loader(
        current_segment=LOAD_TRAVEL,
        previous_work_state_id=last["current_work_state_id"],
        previous_loader_distance=last["current_loader_distance"],
        load_start_utc=at.at_us - int(cfg.synthetic_load_s * 1e6),
        load_end_utc=at.at_us,
        load_seconds=cfg.synthetic_load_s,
        cycle_start_utc=at.at_us,
    )
    return Outcome(rule, closed, following)


def _dump_ended_unseen(step: Step) -> Outcome:
    last, at, cfg = step.last, step.at, step.cfg
    since_dump = seconds(last["dump_start_utc"], at.at_us)
    if since_dump <= cfg.dump_abandoned_s:
        dumped = step.keep(
            current_segment=EMPTY_TRAVEL,
            dump_region_guid=last["idle_in_dump_region_guid"],
            dump_seconds=since_dump,
            dump_end_utc=at.at_us,
            idle_in_dump_region_guid=None,
        )
        return Outcome("L11", dumped, None)
    if not step.repaired:
        raise LostRecord("X4")
    parts = (
        last["load_seconds"],
        last["load_travel_seconds"],
        cfg.synthetic_dump_s,
        cfg.synthetic_empty_s,
    )
    whole = None not in parts
    dump_end = last["dump_start_utc"] + int(cfg.synthetic_dump_s * 1e6)
    cycle_end = dump_end + int(cfg.synthetic_empty_s * 1e6)
    closed = step.keep(
        current_segment=EMPTY_TRAVEL,
        cycle_status=COMPLETE if whole else INVALID,
        dump_region_guid=last["idle_in_dump_region_guid"],
        dump_seconds=cfg.synthetic_dump_s,
        empty_travel_seconds=cfg.synthetic_empty_s,
        total_cycle_seconds=sum(parts) if whole else None,
        dump_end_utc=dump_end,
        cycle_end_utc=cycle_end,
        **NOTHING_PENDING,
    )
    following = step.next_without_loader(
        cycle_end, previous_work_state_id=last["current_work_state_id"]
    )
    return Outcome("L12", closed, following)


# --- U: in a dump area --------------------------------------------------------


def dumping(step: Step) -> Outcome:
    if step.pair == STAYS_IDLE:
        return _waiting_in_dump(step)
    if step.pair == STOPS:
        noted = step.keep(idle_in_dump_region_guid=step.at.dump_region_guid)
        return Outcome("U7", noted, None)
    if step.pair == STARTS:
        return _leaving_dump(step)
    return _quiet("U1" if step.pair == STAYS_WORKING else "U15")


def _waiting_in_dump(step: Step) -> Outcome:
    last, at, cfg = step.last, step.at, step.cfg
    segment = last["current_segment"]
    if step.idle <= cfg.dump_idle_s:
        return _quiet("U1")
    if last["is_outlier"]:
        return _quiet("U2")
    if step.idle > cfg.fence_outlier_s:
        marks = step.outlier_here(2, step.idle, outlier_dump_region_guid=at.dump_region_guid)
        return Outcome("U3", step.keep(**marks), None)
    if segment == DUMP_TIME:
        return _quiet("U4")
    begun = step.keep(
        current_segment=DUMP_TIME,
        dump_region_guid=at.dump_region_guid,
        dump_start_utc=last["current_process_date"],
    )
    if segment == LOAD_TRAVEL:
        begun["load_travel_seconds"] = _travel_since_load(step)
        return Outcome("U5", begun, None)
    return Outcome("U6", begun, None)


def _leaving_dump(step: Step) -> Outcome:
    last, at, cfg = step.last, step.at, step.cfg
    segment = last["current_segment"]
    if last["is_outlier"] or step.idle > cfg.fence_outlier_s:
        return _outlier_in_dump(step)
    if step.idle > cfg.dump_idle_s:
        return _dumped_between_records(step)
    if segment == DUMP_TIME:
        dumped = step.keep(
            current_segment=EMPTY_TRAVEL,
            dump_end_utc=at.at_us,
            dump_seconds=seconds(last["dump_start_utc"], at.at_us),
            idle_in_dump_region_guid=None,
        )
        return Outcome("U13", dumped, None)
    return Outcome("U14", step.keep(idle_in_dump_region_guid=None), None)


def _dumped_between_records(step: Step) -> Outcome:
    last, at = step.last, step.at
    segment = last["current_segment"]
    dumped = step.keep(
        current_segment=EMPTY_TRAVEL, idle_in_dump_region_guid=None, dump_end_utc=at.at_us
    )
    before = last["dump_region_guid"]
    if segment == EMPTY_TRAVEL and before:
        # The truck dumps again: the first start stays, the time adds up.
        dumped["dump_seconds"] = _grown(step, "dump_seconds")
        if before == at.dump_region_guid:
            return Outcome("U10", dumped, None)
        dumped["dump_region_guid"] = at.dump_region_guid
        return Outcome("U11", dumped, None)
    dumped["dump_region_guid"] = at.dump_region_guid
    dumped["dump_start_utc"] = last["current_process_date"]
    dumped["dump_seconds"] = step.idle
    if segment == EMPTY_TRAVEL:
        return Outcome("U11", dumped, None)
    if segment == LOAD_TRAVEL:
        dumped["load_travel_seconds"] = _travel_since_load(step)
        return Outcome("U9", dumped, None)
    return Outcome("U12", dumped, None)


def _outlier_in_dump(step: Step) -> Outcome:
    last, at = step.last, step.at
    if last["is_outlier"] and last["outlier_seconds"]:
        marks = dict(outlier_seconds=_grown(step, "outlier_seconds"))
    else:
        marks = step.outlier_here(2, step.idle, outlier_dump_region_guid=at.dump_region_guid)
        marks.update(NOTHING_PENDING)
    closed = step.keep(cycle_status=OUTLIER, cycle_end_utc=at.at_us, **marks)
    following = step.next_without_loader(
        at.at_us,
        previous_work_state_id=last["current_work_state_id"],
        current_loader_distance=at.loader_distance,
    )
    return Outcome("U8", closed, following)


# --- T: travelling ------------------------------------------------------------


def travelling(step: Step) -> Outcome:
    if step.pair == STAYS_IDLE:
        if step.idle <= step.cfg.travel_outlier_s:
            return _quiet("T1")
        return _outlier_on_road(step, first="T2", again="T3")
    if step.pair == STOPS:
        return Outcome("T4", step.keep(), None)
    if step.pair == STARTS:
        return _moving_on(step)
    return _quiet("T1" if step.pair == STAYS_WORKING else "T14")


def _outlier_on_road(step: Step, first: str, again: str) -> Outcome:
    if step.last["is_outlier"]:
        more = _grown(step, "outlier_seconds")
        return Outcome(again, step.keep(outlier_seconds=more), None)
    return Outcome(first, step.keep(**step.outlier_here(4, step.idle)), None)


def _moving_on(step: Step) -> Outcome:
    last, at, cfg = step.last, step.at, step.cfg
    segment, area = last["current_segment"], last["current_area"]
    if last["is_outlier"]:
        closed = step.keep(cycle_status=OUTLIER, cycle_end_utc=at.at_us)
        return Outcome("T5", closed, step.next_without_loader(at.at_us))
    if segment == EMPTY_TRAVEL and area in (AREA_LOAD, AREA_TRAVEL):
        if step.idle <= cfg.load_seen_from_travel_s:
            return Outcome("T8", step.keep(), None)
        return _cycle_ended_unseen(step)
    if segment in (LOAD_TRAVEL, DUMP_TIME) and area == AREA_DUMP:
        if step.idle <= cfg.dump_seen_from_travel_s:
            return Outcome("T11", step.keep(idle_in_dump_region_guid=None), None)
        return _dump_ended_on_road(step)
    if step.idle > cfg.travel_outlier_s:
        return _outlier_on_road(step, first="T12", again="T12")
    return Outcome("T13", step.keep(), None)


def _cycle_ended_unseen(step: Step) -> Outcome:
    last, at = step.last, step.at
    since = last["current_process_date"]
    empty = seconds(last["dump_end_utc"], since)
    closed = step.keep(**_finished(step, empty))
    before = last["current_work_state_id"]
    if last["current_area"] == AREA_TRAVEL:
        following = step.next_without_loader(since, previous_work_state_id=before)
        return Outcome("T7", closed, following)
    note = last["tmp_idle_near_loader"]
    if note is None and not step.repaired:
        raise LostRecord("X5")
    following = step.next_without_loader(
        since,
        previous_work_state_id=before,
        current_segment=LOAD_TRAVEL,
        load_start_utc=since,
        load_end_utc=at.at_us,
        load_seconds=step.idle,
        **(json.loads(note) if note else {}),
    )
    return Outcome("T6", closed, following)


def _dump_ended_on_road(step: Step) -> Outcome:
    last, at = step.last, step.at
    dumped = step.keep(
        current_segment=EMPTY_TRAVEL, dump_end_utc=at.at_us, idle_in_dump_region_guid=None
    )
    if last["current_segment"] == LOAD_TRAVEL:
        dumped["dump_region_guid"] = last["idle_in_dump_region_guid"]
        dumped["dump_start_utc"] = last["current_process_date"]
        dumped["dump_seconds"] = step.idle
        dumped["load_travel_seconds"] = _travel_since_load(step)
        return Outcome("T9", dumped, None)
    since_dump = seconds(last["dump_start_utc"], at.at_us)
    dumped["dump_seconds"] = since_dump + (last["dump_seconds"] or 0)
    return Outcome("T10", dumped, None)


# Area -> rule function; pass a changed copy to the engine to extend the rules.
RULES = {AREA_LOAD: loading, AREA_DUMP: dumping, AREA_TRAVEL: travelling, "TOGETHER": together}
