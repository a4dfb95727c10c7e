"""The engine over derived telemetry: slices, repeated runs, properties."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from haulwright.config import DEFAULT
from haulwright.engine.batch import cycle_changes
from haulwright.plans import cycles
from haulwright.plans.enrich import Dimensions, PlaceIndex, moments
from haulwright.schemas import CHANGE_COLS, CYCLE_COLS, CYCLE_TABLE_COLS, PROCESS_INFO_COLS
from haulwright.sources.derived import DerivedInputs


@pytest.fixture(scope="module")
def rows(spark, folder):
    inputs = DerivedInputs(spark, folder)
    index = PlaceIndex.build(Dimensions.derived(inputs))
    return moments(inputs.telemetry(), index).persist()


@pytest.fixture(scope="module")
def log(rows):
    return cycle_changes(rows).persist()


def sorted_rows(df):
    return sorted(map(repr, df.select(*CHANGE_COLS).collect()))


@pytest.mark.parametrize("mode", ["reference", "repaired"])
@pytest.mark.parametrize("most, cell", [(10, "minute"), (25, "hour")])
def test_slices_give_the_sequential_run(rows, mode, most, cell):
    cfg = replace(DEFAULT, mode=mode)
    cut = replace(cfg, max_rows_per_slice=most, time_cell=cell)
    assert sorted_rows(cycle_changes(rows, cut)) == sorted_rows(cycle_changes(rows, cfg))


@pytest.mark.parametrize("seq", ["cast(seq + (1L << 61) as bigint)", "concat(repeat('7', 40), lpad(seq, 20, '0'))"])
def test_slices_keep_large_numbers_whole(rows, seq):
    large = rows.selectExpr(f"{seq} AS seq", *[c for c in rows.columns if c != "seq"])
    large = large.withColumn("at_us", F.col("at_us") + F.lit(1 << 61))
    cut = replace(DEFAULT, max_rows_per_slice=10)
    names = ["seq", "action", "rule", "asset_guid", "cycle_number", "current_segment"]
    wire = lambda cfg: sorted(map(repr, cycle_changes(large, cfg).select(*names).collect()))
    got = wire(cut)
    assert got == wire(DEFAULT) and got
    seqs = {r[0] for r in large.select("seq").collect()}
    assert {r[0] for r in cycle_changes(large, cut).select("seq").collect()} <= seqs


@pytest.mark.parametrize("most", [DEFAULT.max_rows_per_slice, 10])
def test_two_runs_are_one_run(spark, folder, most):
    cfg = replace(DEFAULT, max_rows_per_slice=most)
    inputs = DerivedInputs(spark, folder)
    dims, telemetry = Dimensions.derived(inputs), inputs.telemetry().persist()
    stored = dims.process_info
    whole = cycles.changes(telemetry, dims, cfg, stored_progress=stored)
    cut = telemetry.agg(F.percentile_approx(F.unix_micros(F.col("timestamp").cast("timestamp")), 0.4)).first()[0]
    early = F.unix_micros(F.col("timestamp").cast("timestamp")) < cut
    now = "2024-06-01 00:00:00"
    first = cycles.changes(telemetry.where(early), dims, cfg, stored_progress=stored).persist()
    table = cycles.merge_cycles(spark.createDataFrame([], cycles.CYCLE_TABLE), first, now).persist()
    base = stored.withColumns({c: F.lit(None).cast("timestamp_ntz") for c in ("created_date", "updated_date")})
    progress = cycles.merge_progress(base.where(f"process_name = '{DEFAULT.cycle_process}'"), first, now).persist()
    second = cycles.changes(telemetry.where(~early), dims, cfg, stored_cycles=table, stored_progress=progress)
    assert first.count() and second.count()
    assert sorted_rows(first.unionByName(second)) == sorted_rows(whole)
    late = cycles.changes(telemetry, dims, cfg, stored_cycles=table, stored_progress=progress)
    assert sorted_rows(late) == sorted_rows(second)


@pytest.mark.parametrize("rounds", [0, 1])
def test_trucks_that_do_not_settle_are_run_as_a_whole(rows, rounds):
    cut = replace(DEFAULT, max_rows_per_slice=10, settle_rounds=rounds)
    assert sorted_rows(cycle_changes(rows, cut)) == sorted_rows(cycle_changes(rows))


def test_every_status_appears(log):
    statuses = {r[0] for r in log.select("cycle_status").distinct().collect()}
    assert {"INPROGRESS", "COMPLETE", "INVALID", "OUTLIER"} <= statuses


def test_closed_only_keeps_all_closed_cycles(rows, log):
    closed = cycles.final_cycles(cycle_changes(rows, closed_only=True))
    want = cycles.final_cycles(log)
    assert sorted(map(repr, closed.collect())) == sorted(map(repr, want.collect()))
    assert closed.columns == CYCLE_COLS


def test_cycle_numbers_are_contiguous_and_unique(log):
    current = cycles.current_cycles(log)
    bad = (
        current.groupBy("asset_guid", "site_guid")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("cycle_number").alias("low"),
            F.max("cycle_number").alias("high"),
            F.count_distinct("cycle_number").alias("d"),
        )
        .where("low <> 1 OR high <> n OR d <> n")
    )
    assert bad.isEmpty()


def test_complete_cycles_add_up(log):
    parts = "load_seconds + load_travel_seconds + dump_seconds + empty_travel_seconds"
    done = cycles.final_cycles(log).where("cycle_status = 'COMPLETE'")
    assert done.count() > 0
    assert done.where(f"total_cycle_seconds IS NULL OR total_cycle_seconds <> {parts}").isEmpty()


def test_own_rules_can_replace_an_area(rows):
    from haulwright.engine.rules import RULES
    from haulwright.engine.state import Outcome

    def quiet(step):
        return Outcome("T0", None, None)

    log = cycle_changes(rows, rules={**RULES, "TRAVEL": quiet})
    assert log.where("rule LIKE 'T%'").isEmpty()
    assert not log.where("rule LIKE 'L%'").isEmpty()


def test_merging_in_two_batches_gives_the_current_table(spark, log):
    cut = log.agg(F.percentile_approx("current_process_date", 0.5)).first()[0]
    first = log.where(F.col("current_process_date") <= cut)
    second = log.where(F.col("current_process_date") > cut)
    schema = ", ".join(
        ["asset_cycle_vlx_id bigint"]
        + [f"{f.name} {f.dataType.simpleString()}" for f in log.select(*CYCLE_COLS).schema]
        + ["created_date timestamp_ntz", "updated_date timestamp_ntz"]
    )
    empty = spark.createDataFrame([], schema)
    once = cycles.merge_cycles(empty, first, "2024-06-01 00:00:00")
    twice = cycles.merge_cycles(once, second, "2024-06-02 00:00:00").persist()
    assert twice.columns == CYCLE_TABLE_COLS
    got = sorted(map(repr, twice.select(*CYCLE_COLS).collect()))
    assert got == sorted(map(repr, cycles.current_cycles(log).collect()))
    assert twice.where("created_date > updated_date").isEmpty()
    assert twice.count() == twice.select("asset_cycle_vlx_id").distinct().count()


def test_progress_moves_on_and_keeps_its_creation(spark, log):
    empty = spark.createDataFrame(
        [],
        "tx_process_info_id bigint, process_name string, process_date timestamp_ntz, "
        "created_date timestamp_ntz, updated_date timestamp_ntz, asset_guid string, site_guid string",
    )
    once = cycles.merge_progress(empty, log, "2024-06-01 00:00:00")
    assert once.columns == PROCESS_INFO_COLS
    twice = cycles.merge_progress(once, log, "2024-06-02 00:00:00").persist()
    assert twice.where("updated_date IS NULL OR created_date >= updated_date").isEmpty()
    assert twice.count() == log.where("action <> 'reject'").select("asset_guid").distinct().count()
