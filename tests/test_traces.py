"""Golden traces of the rules: one truck, times in seconds."""

import json

import pytest

from haulwright.config import CycleConfig
from haulwright.engine.machine import CycleMachine
from haulwright.engine.state import Sighting

W, I = 3, 2


def sight(t, place, state, **changes):
    near = place in ("loader", "overlap")
    dump = place in ("dump", "overlap")
    values = dict(
        seq=t, asset_guid="A", site_guid="S", at_us=t * 10**6, work_state_id=state,
        longitude=133.0, latitude=-23.0,
        loader_guid="P" if near else None,
        loader_latitude=-23.0 if near else None,
        loader_longitude=133.0 if near else None,
        loader_distance=11.0 if near else None,
        load_region_guid="Q" if near else None,
        in_load_region=near,
        load_region_distance=0.0 if near else None,
        dump_region_guid="D" if dump else None,
        colocated=place == "overlap",
        bad_position=False,
    )
    values.update(changes)
    return Sighting(**values)


def run(rows, mode="reference", **changes):
    machine = CycleMachine(CycleConfig(mode=mode))
    log = []
    for t, place, state in rows:
        changed = machine.feed(sight(t, place, state, **changes))
        log.append((changed[0][1] if changed else None, changed))
    rules = [rule for rule, _ in log]
    cycles = {}
    for _, changed in log:
        for action, _, record in changed:
            if record:
                cycles[record["cycle_number"]] = record
    return rules, cycles, machine


def want(record, **values):
    got = {k: record[k] for k in values}
    for key, value in values.items():
        if (key.endswith(("_utc", "_date"))) and value is not None:
            values[key] = value * 10**6
    assert got == values


G1 = [
    (0, "loader", W), (10, "loader", I), (40, "loader", I), (100, "loader", W),
    (400, "road", W), (700, "dump", I), (720, "dump", I), (730, "dump", W),
    (1300, "loader", I), (1330, "loader", I),
]


def upto(t):
    return [row for row in G1 if row[0] <= t]


def test_g1_complete_cycle():
    rules, cycles, _ = run(G1)
    assert rules == ["D1", "L9", "L5", "L21", None, "U7", "U5", "U13", "L9", "L7"]
    want(cycles[1], cycle_status="COMPLETE", load_seconds=90.0, load_travel_seconds=600.0,
         dump_seconds=30.0, empty_travel_seconds=570.0, total_cycle_seconds=1290.0,
         cycle_end_utc=1300, load_start_utc=10, load_end_utc=100, dump_start_utc=700,
         dump_end_utc=730, dump_region_guid="D", loader_asset_guid="P", load_region_guid="Q")
    want(cycles[2], cycle_status="INPROGRESS", current_segment="LOAD_TIME",
         load_start_utc=1300, cycle_start_utc=1300)


def test_g2_dump_start_overwritten():
    rules, cycles, _ = run(upto(720) + [(760, "dump", W)])
    assert rules[-1] == "U12"
    want(cycles[1], current_segment="EMPTY_TRAVEL", dump_start_utc=720, dump_end_utc=760,
         dump_seconds=40.0)


def test_g3_abnormal_return():
    rules, cycles, _ = run(upto(100) + [(600, "loader", I), (630, "loader", I)])
    assert rules[-2:] == ["L9", "L6"]
    want(cycles[1], cycle_status="INVALID", load_travel_seconds=500.0, cycle_end_utc=600)
    want(cycles[2], current_segment="LOAD_TIME", load_start_utc=600)


def test_g4_travel_outlier():
    rows = [(300, "road", I), (950, "road", I), (1600, "road", I), (1700, "road", W)]
    rules, cycles, _ = run(upto(100) + rows)
    assert rules[-4:] == ["T4", "T2", "T3", "T5"]
    want(cycles[1], cycle_status="OUTLIER", outlier_type_id=4, outlier_date_utc=300,
         outlier_seconds=1300.0, cycle_end_utc=1700, is_outlier=True)
    want(cycles[2], current_segment=None, cycle_start_utc=1700)


def test_g5_implied_load():
    rules, cycles, _ = run([(0, "loader", W), (10, "loader", I), (100, "loader", W)])
    assert rules == ["D1", "L9", "L14"]
    want(cycles[1], current_segment="LOAD_TRAVEL", load_start_utc=10, load_end_utc=100,
         load_seconds=90.0)


def test_g6_loader_outlier():
    rules, cycles, _ = run([(0, "loader", W), (10, "loader", I), (1300, "loader", W)])
    assert rules == ["D1", "L9", "L13"]
    want(cycles[1], cycle_status="OUTLIER", outlier_type_id=3, outlier_seconds=1290.0,
         outlier_date_utc=10, cycle_end_utc=1300, tmp_idle_near_loader=None)
    want(cycles[2], current_segment="LOAD_TRAVEL", load_start_utc=1280, load_end_utc=1300,
         load_seconds=20.0, cycle_start_utc=1300)


def test_g7_closed_from_travel():
    rules, cycles, _ = run(upto(1300) + [(1350, "road", W)])
    assert rules[-1] == "T6"
    want(cycles[1], cycle_status="COMPLETE", empty_travel_seconds=570.0,
         total_cycle_seconds=1290.0, cycle_end_utc=1300)
    want(cycles[2], current_segment="LOAD_TRAVEL", load_start_utc=1300, load_end_utc=1350,
         load_seconds=50.0, loader_asset_guid="P", load_region_guid="Q",
         current_loader_distance=None)


def test_g8_together_in_dump():
    rows = [(0, "road", W), (10, "dump", I), (50, "overlap", I), (100, "overlap", I), (200, "road", W)]
    rules, cycles, machine = run(rows[:3])
    assert rules == ["D1", "U7", "S1"]
    want(cycles[1], all_assets_in_same_dump_area=True, outlier_type_id=1, outlier_date_utc=10,
         is_outlier=False)
    rules, cycles, _ = run(rows)
    assert rules == ["D1", "U7", "S1", None, "S3"]
    want(cycles[1], cycle_status="OUTLIER", cycle_end_utc=50)
    want(cycles[2], current_segment=None, cycle_start_utc=50)


def test_g9_stop_inside_overlap_unseen():
    rules, cycles, _ = run([(0, "road", W), (10, "overlap", I), (60, "overlap", I)])
    assert rules == ["D1", None, None]
    want(cycles[1], current_work_state_id=W, current_process_date=0,
         all_assets_in_same_dump_area=False)


def test_g10_continued_load():
    rules, cycles, _ = run(upto(100) + [(110, "loader", I), (140, "loader", W)])
    assert rules[-2:] == ["L9", "L17"]
    want(cycles[1], load_seconds=120.0, load_end_utc=140, current_segment="LOAD_TRAVEL")


def test_g11_continued_dump():
    rules, cycles, _ = run(upto(730) + [(740, "dump", I), (770, "dump", W)])
    assert rules[-2:] == ["U7", "U10"]
    want(cycles[1], dump_seconds=60.0, dump_end_utc=770)


def test_g12_dump_outlier():
    rules, cycles, _ = run(upto(700) + [(1950, "dump", I), (2000, "dump", W)])
    assert rules[-2:] == ["U3", "U8"]
    want(cycles[1], cycle_status="OUTLIER", outlier_type_id=2, outlier_seconds=1300.0,
         cycle_end_utc=2000)
    want(cycles[2], current_segment=None, cycle_start_utc=2000)


def test_g13_implied_dump():
    rules, cycles, _ = run(upto(700) + [(760, "dump", W)])
    assert rules[-1] == "U9"
    want(cycles[1], current_segment="EMPTY_TRAVEL", dump_start_utc=700, dump_end_utc=760,
         dump_seconds=60.0, load_travel_seconds=600.0)


def test_g14_left_dump_unseen():
    rules, cycles, _ = run(upto(700) + [(750, "road", W)])
    assert rules[-1] == "T9"
    want(cycles[1], current_segment="EMPTY_TRAVEL", dump_start_utc=700, dump_end_utc=750,
         dump_seconds=50.0, load_travel_seconds=600.0, dump_region_guid="D")


def test_g15_open_cycle_left_behind():
    rules, cycles, _ = run(upto(720) + [(760, "loader", I)])
    assert rules[-1] == "L8"
    want(cycles[1], cycle_status="INPROGRESS", dump_end_utc=760, cycle_end_utc=760,
         dump_seconds=40.0)
    want(cycles[2], current_segment="LOAD_TIME", load_start_utc=720)


def test_g16_lost_record():
    rows = upto(720) + [(2600, "loader", W)]
    rules, cycles, machine = run(rows)
    assert rules[-1] == "X4" and list(cycles) == [1]
    assert machine.open["S"]["current_process_date"] == 720 * 10**6
    rules, cycles, _ = run(rows, mode="repaired")
    assert rules[-1] == "L12"
    want(cycles[1], cycle_status="COMPLETE", dump_seconds=900.0, empty_travel_seconds=900.0,
         dump_end_utc=1600, cycle_end_utc=2500, total_cycle_seconds=2490.0)
    want(cycles[2], current_segment=None, cycle_start_utc=2500)


def test_g17_first_record_in_overlap():
    rules, cycles, machine = run([(0, "overlap", W)])
    assert rules == ["X1"] and not machine.open
    rules, cycles, _ = run([(0, "overlap", W)], mode="repaired")
    want(cycles[1], current_area="LOAD")


def test_g18_stale():
    rules, _, _ = run(upto(400) + [(100, "loader", W), (200, "road", W)])
    assert rules[-2:] == [None, None]
    late = CycleMachine(CycleConfig())
    for row in upto(400):
        late.feed(sight(*row))
    assert late.feed(sight(100, "loader", I)) == []
    assert late.feed(sight(200, "road", I))[0][1] == "T4"


def test_g19_threshold_edge():
    rules, cycles, _ = run([(0, "loader", W), (10, "loader", I), (30, "loader", I), (31, "loader", I)])
    assert rules == ["D1", "L9", None, "L5"]
    want(cycles[1], load_start_utc=10)


def test_g20_unknown_first_state():
    rules, cycles, _ = run([(0, "road", 1), (10, "road", I), (900, "road", W)])
    assert rules == ["D1", None, None]
    want(cycles[1], current_work_state_id=1, current_process_date=0)


def test_g21_no_load_region():
    rows = [(0, "loader", W), (10, "loader", I), (50, "loader", W)]
    blank = dict(load_region_guid=None, in_load_region=False, load_region_distance=None)
    rules, cycles, _ = run(rows, **blank)
    assert rules == ["D1", "X2", None]
    want(cycles[1], current_segment=None)
    rules, cycles, _ = run(rows, mode="repaired", **blank)
    assert rules == ["D1", "L9", "L14"]
    want(cycles[1], current_segment="LOAD_TRAVEL", load_start_utc=10, load_end_utc=50,
         load_seconds=40.0)


def test_state_survives_dump_and_load():
    for cut in range(1, len(G1)):
        first, second = CycleMachine(CycleConfig()), CycleMachine(CycleConfig())
        for row in G1[:cut]:
            first.feed(sight(*row))
        second.load(first.dump())
        for row in G1[cut:]:
            assert first.feed(sight(*row)) == second.feed(sight(*row))
        state, numbers = first.dump_uncounted()
        second.load(state, numbers)
        assert second.dump() == first.dump()
        assert json.loads(numbers) == {"S": 2}


@pytest.mark.parametrize("field", ["loader_radius_m", "load_idle_s"])
def test_thresholds_are_checked(field):
    with pytest.raises(ValueError):
        CycleConfig(**{field: -1.0})
    with pytest.raises(TypeError):
        CycleConfig(**{field: "near"})


# Rules that no trace above reaches.


def feed(machine, t, place, state, **changes):
    changed = machine.feed(sight(t, place, state, **changes))
    return (changed[0][1] if changed else None), (changed[-1][2] if changed else None)


def test_short_stop_before_any_segment():
    rules, cycles, _ = run([(0, "loader", I), (10, "loader", W)])
    assert rules == ["D1", "L20"]
    want(cycles[1], current_segment=None, current_process_date=10, load_start_utc=None)


def test_short_stop_on_a_loaded_trip():
    rules, cycles, _ = run(upto(100) + [(200, "loader", I), (210, "loader", W)])
    assert rules[-2:] == ["L9", "L22"]
    want(cycles[1], current_segment="LOAD_TRAVEL", load_end_utc=100, current_process_date=210)


def test_loading_that_becomes_an_outlier():
    rules, cycles, _ = run(upto(40) + [(1241, "loader", I), (2600, "loader", I)])
    assert rules[-2:] == ["L3", None]
    want(cycles[1], is_outlier=True, outlier_type_id=3, outlier_seconds=1201.0, outlier_date_utc=40,
         outlier_loader_guid="P", cycle_status="INPROGRESS")


def test_dump_seen_when_back_at_the_loader():
    rules, cycles, _ = run(upto(700) + [(760, "loader", W)])
    assert rules[-2:] == ["U7", "L16"]
    want(cycles[1], current_segment="EMPTY_TRAVEL", dump_start_utc=700, dump_end_utc=760, dump_seconds=60.0,
         load_travel_seconds=600.0, dump_region_guid="D", idle_in_dump_region_guid=None)


@pytest.mark.parametrize("place", ["loader", "dump", "road"])
def test_other_work_states_change_nothing(place):
    rules, _, machine = run([(0, place, W), (10, place, 5), (20, place, 7)])
    assert rules == ["D1", None, None]
    assert machine.changed_at == 0
    assert run([(0, place, 5), (10, place, I), (99, place, W)])[0] == ["D1", None, None]


def test_second_dump_in_another_region():
    rules, _, machine = run(upto(730))
    assert rules[-1] == "U13"
    assert feed(machine, 800, "dump", I, dump_region_guid="E")[0] == "U7"
    rule, record = feed(machine, 840, "dump", W, dump_region_guid="E")
    assert rule == "U11"
    want(record, dump_region_guid="E", dump_start_utc=700, dump_end_utc=840, dump_seconds=70.0)


def test_next_cycle_without_load_region_is_lost():
    rules, _, machine = run(upto(1300))
    assert feed(machine, 1330, "loader", I, load_region_guid=None)[0] == "X3"
    repaired = CycleMachine(CycleConfig(mode="repaired"))
    for row in upto(1300):
        repaired.feed(sight(*row))
    rule, record = feed(repaired, 1330, "loader", I, load_region_guid=None)
    assert rule == "L7"
    want(record, load_region_guid=None, is_within_load_region=False, cycle_number=2)


def test_loading_seen_from_travel_without_a_note_is_lost():
    for mode, rule in (("reference", "X5"), ("repaired", "T6")):
        _, _, machine = run(upto(1300), mode=mode)
        machine.open["S"]["tmp_idle_near_loader"] = None
        got, record = feed(machine, 1400, "road", W)
        assert got == rule
        if rule == "T6":
            want(record, current_segment="LOAD_TRAVEL", loader_asset_guid=None, load_seconds=100.0)


def test_idle_travel_ends_a_cycle_or_not():
    rules, cycles, _ = run(upto(730) + [(900, "road", I), (1000, "road", W)])
    assert rules[-2:] == ["T4", "T7"]
    want(cycles[1], cycle_status="COMPLETE", empty_travel_seconds=170.0, cycle_end_utc=900)
    want(cycles[2], current_segment=None, cycle_start_utc=900)
    rules, cycles, _ = run(upto(730) + [(900, "road", I), (930, "road", W)])
    assert rules[-1] == "T8"
    want(cycles[1], cycle_status="INPROGRESS", current_segment="EMPTY_TRAVEL", current_process_date=930)


def test_a_record_without_time_is_rejected():
    machine = CycleMachine(CycleConfig())
    assert machine.feed(sight(0, "road", W)._replace(at_us=None)) == [("reject", "X7", None)]


def test_two_sites_have_cycles_of_their_own():
    _, _, machine = run(upto(100))
    assert feed(machine, 150, "road", W, site_guid="S2")[0] == "D1"
    assert feed(machine, 140, "road", I)[0] is None  # late for the truck, whatever the site
    assert feed(machine, 160, "road", I)[0] == "T4"
    assert {site: r["cycle_number"] for site, r in machine.open.items()} == {"S": 1, "S2": 1}
