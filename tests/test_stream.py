"""Stream and batch agree, over several micro-batches, restarts, and starts from stored tables."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from haulwright.config import DEFAULT
from haulwright.engine.batch import cycle_changes
from haulwright.plans import cycles
from haulwright.plans.enrich import Dimensions, PlaceIndex, moments
from haulwright.schemas import CHANGE_COLS, CYCLE_COLS, CYCLE_FIELDS, PROCESS_INFO_COLS, TELEMETRY
from haulwright.sources.derived import DerivedInputs
from haulwright.streaming.cycles import (
    STATE_STORE,
    cycle_change_stream,
    stored_current,
    table_sink,
)
from haulwright.streaming.ordering import in_order
from haulwright.streaming.tables import cycle_table, progress_table


@pytest.fixture(scope="module")
def inputs(spark, folder):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    return DerivedInputs(spark, folder)


@pytest.fixture(scope="module")
def rows(inputs):
    return inputs.telemetry().select(*[f.name for f in TELEMETRY]).persist()


@pytest.fixture(scope="module")
def index(inputs):
    return PlaceIndex.build(Dimensions.derived(inputs))


@pytest.fixture(scope="module")
def pieces(rows):
    """Telemetry in three parts, each later in time than the one before."""
    bounds = rows.agg(F.percentile_approx("timestamp", [0.3, 0.7])).first()[0]
    early = rows.where(F.col("timestamp") <= bounds[0])
    middle = rows.where((F.col("timestamp") > bounds[0]) & (F.col("timestamp") <= bounds[1]))
    late = rows.where(F.col("timestamp") > bounds[1])
    return [early, middle, late]


def shown(df, *columns):
    return sorted(map(repr, df.select(*columns).collect() if columns else df.collect()))


def run_once(spark, root, index, seeds=None, sink=None, **options):
    stream = spark.readStream.schema(TELEMETRY).parquet(f"{root}/in/*")
    changed = cycle_change_stream(moments(stream, index), seeds=seeds, **options)
    query = (
        changed.writeStream.foreachBatch(sink or table_sink(f"{root}/out"))
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def test_stream_equals_batch_across_restarts(spark, rows, index, pieces, tmp_path):
    root = str(tmp_path)
    for number, piece in enumerate(pieces):
        piece.coalesce(1).write.parquet(f"{root}/in/{number}")
        run_once(spark, root, index, in_memory=3)  # nearly all rows go by way of the state store
    want = cycle_changes(moments(rows, index)).persist()
    got = spark.read.parquet(f"{root}/out/changes").select(*CHANGE_COLS).persist()
    assert got.count() == want.count()
    assert shown(got) == shown(want)

    final = spark.read.parquet(f"{root}/out/final").drop("batch_id")
    assert shown(final) == shown(cycles.final_cycles(want))
    current = stored_current(spark.read.parquet(f"{root}/out/changes"))
    assert shown(current) == shown(cycles.current_cycles(want))


@pytest.mark.parametrize("service", ["realtime", "reprocess"])
def test_stream_goes_on_from_a_batch_run(spark, inputs, rows, index, pieces, tmp_path, service):
    """History in batch, then a stream from its tables with a restart between: the tables of one run."""
    root, cfg = str(tmp_path), replace(DEFAULT, service=service)
    dims = Dimensions.derived(inputs)
    # Places as the stream sees them, so that one run over everything can be compared with.
    first = cycle_changes(moments(pieces[0], index), cfg).persist()
    table = cycle_table(spark, f"{root}/cycles", buckets=4, most_deltas=1)
    moved = progress_table(spark, f"{root}/moved", buckets=4, most_deltas=1)
    empty = spark.createDataFrame([], cycles.CYCLE_TABLE)
    table.start(cycles.merge_cycles(empty, first, "2024-06-01 00:00:00"))
    none = dims.process_info.where("false").withColumns({c: F.lit(None).cast("timestamp_ntz") for c in ("created_date", "updated_date")})
    moved.start(cycles.merge_progress(none, first, "2024-06-01 00:00:00", cfg))
    assert table.read().where("cycle_status = 'INPROGRESS'").count() > 0

    for number, piece in enumerate(pieces[1:], 2):
        piece.coalesce(1).write.parquet(f"{root}/in/{number}")
        seeds = cycles.start_states(table.read(), moved.read())
        sink = table_sink(f"{root}/out", current=table, moved=moved, now=lambda n=number: f"2024-06-0{n} 00:00:00")
        run_once(spark, root, index, seeds, sink)

    late = cycle_changes(moments(pieces[1].unionByName(pieces[2]), index), DEFAULT, seeds=cycles.start_states(
        cycles.merge_cycles(empty, first, "2024-06-01 00:00:00"), cycles.merge_progress(none, first, "2024-06-01 00:00:00", cfg)))
    want = first.unionByName(late).persist()
    if service == "realtime":
        assert shown(want, *CHANGE_COLS) == shown(cycle_changes(moments(rows, index)), *CHANGE_COLS)
    assert shown(table.read(), *CYCLE_COLS) == shown(cycles.current_cycles(want), *CYCLE_COLS)
    once = cycles.merge_progress(none, want, "2024-06-01 00:00:00")
    kept = [c for c in PROCESS_INFO_COLS if c not in ("updated_date", "created_date")]
    assert shown(moved.read(), *kept) == shown(once, *kept)
    times = table.read().select("created_date", "updated_date").distinct().collect()
    assert {str(t[0])[:10] for t in times} <= {"2024-06-01", "2024-06-02", "2024-06-03"} and len(times) > 3
    assert all(t[0] <= t[1] for t in times)


def test_a_repeated_micro_batch_replaces_its_files(spark, tmp_path):
    columns = {name: F.lit(None).cast(kind) for name, kind in CYCLE_FIELDS}
    one = spark.range(3).select(
        F.col("id").alias("seq"), F.lit("update").alias("action"), F.lit("T4").alias("rule")
    ).withColumns(columns).withColumn("cycle_status", F.lit("COMPLETE"))
    write = table_sink(str(tmp_path))
    write(one, 7)
    write(one, 7)
    assert spark.read.parquet(f"{tmp_path}/final").count() == 3


class Held:
    """A map state in memory that counts its entries."""

    def __init__(self):
        self.entries, self.most = {}, 0

    def getValue(self, key):
        return self.entries.get(key)

    def updateValue(self, key, value):
        self.entries[key] = value
        self.most = max(self.most, len(self.entries))

    def removeKey(self, key):
        del self.entries[key]


@pytest.mark.parametrize("n, most, block, fan_in", [(0, 5, 2, 2), (5, 5, 2, 2), (6, 5, 2, 2), (1000, 10, 3, 2), (1000, 7, 100, 4), (5000, 50, 10, 32)])
def test_rows_come_in_order_by_way_of_the_state(n, most, block, fan_in):
    r = random.Random(n)
    rows = [(r.randint(0, n // 3 + 1), f"t{i}", None if i % 7 else 0.1 + i, i) for i in range(n)]
    r.shuffle(rows)
    state = Held()
    key = lambda row: (row[0], row[3])
    taken = in_order(iter(rows), state, key, most, block, fan_in)
    assert list(taken) == sorted(rows, key=key)
    assert not state.entries and (state.most > 0) == (n > most)


def versions(spark, folder, n, seed, **options):
    """A table after n upserts of random rows, and the rows that it must hold."""
    table = progress_table(spark, folder, **options)
    r, want, rewritten = random.Random(seed), {}, []
    schema = table.columns
    for batch in range(n):
        rows = []
        for a in r.sample(range(40), r.randint(1, 12)):
            day = f"2024-01-{batch + 1:02d} 00:00:00"
            old = want.get(a)
            want[a] = (
                old[0] if old else 1000 * batch + a, "cycles", max(old[2], f"2024-02-{a % 9 + 1:02d}") if old else f"2024-02-{a % 9 + 1:02d}",
                old[3] if old else day[:10], day[:10] if old else None, f"A{a}", old[6] if old else f"S{batch}",
            )
            rows.append((1000 * batch + a, "cycles", f"2024-02-{a % 9 + 1:02d}", day, day, f"A{a}", f"S{batch}"))
        text = ", ".join(f"{f.name} {'string' if 'timestamp' in f.dataType.simpleString() else f.dataType.simpleString()}" for f in schema)
        frame = spark.createDataFrame(rows, text).select(*(F.col(f.name).cast(f.dataType) for f in schema))
        rewritten.append(table.upsert(frame, batch))
        before = table.version()
        assert table.upsert(frame.limit(0), batch) == [] and table.upsert(frame, batch) == [] and table.version() == before
    return table, want, rewritten


def dates(rows):
    return sorted(tuple(str(v)[:10] if v is not None and not isinstance(v, int) else v for v in row) for row in rows)


def test_upserts_rewrite_only_buckets_that_are_full(spark, tmp_path):
    table, want, rewritten = versions(spark, str(tmp_path), 9, 1, buckets=5, most_deltas=2)
    assert dates(table.read().collect()) == dates(want.values())
    assert rewritten[0] == rewritten[1] == [] and any(rewritten) and all(len(b) < 5 for b in rewritten[2:4])
    again = progress_table(spark, str(tmp_path), buckets=64)  # as after a restart
    assert again.buckets == 5 and dates(again.read().collect()) == dates(want.values())
    gone = again.vacuum(keep=1)
    assert gone and again.vacuum(keep=1) == [] and dates(again.read().collect()) == dates(want.values())


def test_a_micro_batch_that_failed_before_its_version_is_written_again(spark, tmp_path, monkeypatch):
    table, want, _ = versions(spark, str(tmp_path), 3, 2, buckets=3, most_deltas=1)
    half = table.read().limit(4).persist()
    half.count()
    before = dates(table.read().collect())

    def fail(version):
        raise RuntimeError("lost the driver")

    monkeypatch.setattr(table, "_publish", fail)
    with pytest.raises(RuntimeError):
        table.upsert(half, 3)
    assert dates(table.read().collect()) == before
    monkeypatch.undo()
    table.upsert(half.limit(2), 3)
    assert table.read().count() == len(want) and table.version()["batch"] == 3
    table.start(half)  # a table that exists isn't begun anew
    assert table.version()["batch"] == 3
