"""Batch run of the cycle engine: one shuffle by truck, rows streamed in order.

Rows are hash-partitioned by (asset, slice) and sorted inside each partition, so
a task walks its trucks one after the other and holds one Arrow batch and one
state at a time, however long a truck's history is.

A truck is sequential by nature. One with more than `max_rows_per_slice` rows
would still make one long task, so its history is cut into time slices which run
in parallel: every slice first runs from a guessed start, then again from the
end state of the slice before it, until no start changes any more. Opening a
cycle overwrites almost the whole state, so the guesses settle after about two
rounds; each round reruns only the slices whose start has changed. At the fixed
point the slices give exactly the rows of one sequential run. Trucks that don't
reach it in a few rounds are run sequentially.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import repeat

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulwright.config import DEFAULT, FINAL_STATUSES, CycleConfig
from haulwright.engine.machine import CycleMachine
from haulwright.engine.state import Sighting
from haulwright.session import ship_package, spread, use_checkpoint_dir
from haulwright.schemas import (
    CHANGE_COLS,
    CYCLE_COLS,
    CYCLE_FIELDS,
    CYCLE_TIMES,
    MOMENT_COLS,
    change_wire,
)

_SLICE = ["asset_guid", "slice"]
_WIRE_COLS = [*MOMENT_COLS, "slice", "carry", "carry_numbers"]
_ENDS_WIRE = "asset_guid string, slice int, state string, numbers string"
_ARROW_TYPES = {
    "string": pa.string(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "timestamp_ntz": pa.int64(),
}
CHANGE_FIELDS = [("action", "string"), ("rule", "string"), *CYCLE_FIELDS]


def change_arrow(seq: str) -> pa.Schema:
    """Arrow columns of a change, for sequence numbers of a type (bigint or string)."""
    kind = pa.string() if seq == "string" else pa.int64()
    return pa.schema([("seq", kind), *((name, _ARROW_TYPES[k]) for name, k in CHANGE_FIELDS)])


_ENDS_ARROW = pa.schema(
    [("asset_guid", pa.string()), ("slice", pa.int32()),
     ("state", pa.string()), ("numbers", pa.string())]
)
_FLUSH_ROWS = 8192


def _values(column: pa.Array) -> Iterable:
    """Python values of an Arrow column, None where missing."""
    if column.null_count == len(column):
        return repeat(None, len(column))
    if column.null_count and pa.types.is_integer(column.type):
        return column.to_pylist()  # NumPy would turn whole numbers into floats
    values = column.to_numpy(zero_copy_only=False)
    if column.null_count and values.dtype != object:
        missing = column.is_null().to_numpy(zero_copy_only=False)
        values = values.astype(object)
        values[missing] = None
    return values.tolist()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(_values(batch.column(name)) for name in _WIRE_COLS))


def change_row(at: Sighting, action: str, rule: str, record: dict | None) -> tuple:
    if record is None:
        record = dict.fromkeys(CYCLE_COLS)
        record.update(
            asset_guid=at.asset_guid, site_guid=at.site_guid, current_process_date=at.at_us
        )
    return (at.seq, action, rule, *map(record.__getitem__, CYCLE_COLS))


def _to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(col, type=f.type) for col, f in zip(zip(*rows), schema)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _fold_changes(cfg: CycleConfig, rules, closed_only: bool, seq: str):
    """Task body: sorted telemetry in, cycle changes out."""
    schema = change_arrow(seq)

    def fold(batches):
        machine, current, out = CycleMachine(cfg, rules), None, []
        width = len(MOMENT_COLS)
        for row in _rows(batches):
            at = Sighting._make(row[:width])
            slice_no, carry, numbers = row[width:]
            if (at.asset_guid, slice_no) != current:
                current = (at.asset_guid, slice_no)
                machine.clear()
            if carry is not None:
                machine.load(carry, numbers)
                continue
            for action, rule, record in machine.feed(at):
                if closed_only and (
                    record is None or record["cycle_status"] not in FINAL_STATUSES
                ):
                    continue
                out.append(change_row(at, action, rule, record))
            if len(out) >= _FLUSH_ROWS:
                yield _to_batch(out, schema)
                out = []
        if out:
            yield _to_batch(out, schema)

    return fold


def _fold_ends(cfg: CycleConfig, rules):
    """Task body: sorted telemetry in, the end state of each slice out."""

    def fold(batches):
        machine, current, out = CycleMachine(cfg, rules), None, []
        width = len(MOMENT_COLS)
        for row in _rows(batches):
            at = Sighting._make(row[:width])
            slice_no, carry, numbers = row[width:]
            if (at.asset_guid, slice_no) != current:
                if current is not None:
                    out.append((*current, *machine.dump_uncounted()))
                    if len(out) >= _FLUSH_ROWS:
                        yield _to_batch(out, _ENDS_ARROW)
                        out = []
                current = (at.asset_guid, slice_no)
                machine.clear()
            if carry is not None:
                machine.load(carry, numbers)
            else:
                machine.feed(at)
        if current is not None:
            out.append((*current, *machine.dump_uncounted()))
        if out:
            yield _to_batch(out, _ENDS_ARROW)

    return fold


def _in_order(moments: DataFrame, starts: DataFrame | None, count: int) -> DataFrame:
    """Rows of each slice together and by time, the carried state in front."""
    rows = moments
    if starts is not None:
        rows = rows.unionByName(starts, allowMissingColumns=True)
    for name in ("carry", "carry_numbers"):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast("string"))
    return spread(rows.select(*_WIRE_COLS), *_SLICE, count=count).sortWithinPartitions(
        *_SLICE, F.col("at_us").asc_nulls_first(), "seq"
    )


def _cuts(moments: DataFrame, cfg: CycleConfig) -> DataFrame:
    """First time cell of each further slice of the trucks with many rows.

    The window runs over one row per truck and time cell, so its size follows
    the length of the history and not the number of rows.
    """
    by_time = Window.partitionBy("asset_guid").orderBy("cell")
    return (
        moments.groupBy("asset_guid", _cell(cfg).alias("cell"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("before", F.sum("n").over(by_time) - F.col("n"))
        .withColumn("part", (F.col("before") / cfg.max_rows_per_slice).cast("int"))
        .groupBy("asset_guid", "part")
        .agg(F.min("cell").alias("first_cell"))
        .where("part > 0")
        .groupBy("asset_guid")
        .agg(F.sort_array(F.collect_list("first_cell")).alias("cuts"))
    )


def _cell(cfg: CycleConfig) -> Column:
    return F.date_trunc(cfg.time_cell, F.timestamp_micros("at_us"))


def _starts(ends: DataFrame) -> DataFrame:
    """Start of each slice but a truck's first: what the slice before it left."""
    by_slice = Window.partitionBy("asset_guid").orderBy("slice")
    return ends.select(
        *_SLICE, F.lag("state").over(by_slice).alias("carry")
    ).where("carry IS NOT NULL")


def _counted(ends: DataFrame) -> DataFrame:
    """Cycles counted per site before each slice, as a JSON object."""
    so_far = (
        Window.partitionBy("asset_guid", "site")
        .orderBy("slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    every = ends.select(*_SLICE)
    per_site = ends.select(
        *_SLICE,
        F.explode(F.from_json("numbers", "map<string,int>")).alias("site", "n"),
    )
    sites = per_site.select("asset_guid", "site").distinct()
    return (
        every.join(sites, "asset_guid")
        .join(per_site, [*_SLICE, "site"], "left")
        .withColumn("total", F.sum("n").over(so_far))
        .groupBy(*_SLICE)
        .agg(
            F.to_json(
                F.map_from_entries(
                    F.collect_list(F.struct("site", F.coalesce("total", F.lit(0))))
                )
            ).alias("carry_numbers")
        )
    )


def to_changes(wire: DataFrame) -> DataFrame:
    """Engine output with its microseconds turned into timestamps."""
    return wire.selectExpr(
        *(
            f"cast(timestamp_micros({name}) AS timestamp_ntz) AS {name}"
            if name in CYCLE_TIMES
            else name
            for name in CHANGE_COLS
        )
    )


def _kept(df: DataFrame) -> DataFrame:
    """Cut the lineage in the checkpoint folder the session names."""
    use_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _settle(
    sliced: DataFrame, cfg: CycleConfig, rules, first: DataFrame | None, count: int
) -> tuple[DataFrame, DataFrame]:
    """Carried state of every further slice of the sliced trucks, and trucks that don't settle.

    `first` holds what their first slices start from, if something is stored.
    A truck whose starts still change after a few rounds is folded as a whole
    instead, row after row in one task, which takes time but no memory.
    """
    fold = _fold_ends(cfg, rules)
    ends = _kept(_in_order(sliced, first, count).mapInArrow(fold, _ENDS_WIRE))
    starts = _kept(_starts(ends))
    stale, n_stale = starts, starts.count()
    for _ in range(cfg.settle_rounds):
        if not n_stale:
            break
        again = stale.select(*_SLICE)
        redone = _in_order(
            sliced.join(again, _SLICE, "left_semi"), stale, count
        ).mapInArrow(fold, _ENDS_WIRE)
        ends = _kept(ends.join(again, _SLICE, "left_anti").unionByName(redone))
        settled = starts.withColumnRenamed("carry", "used")
        starts = _kept(_starts(ends))
        stale = _kept(
            starts.join(settled, _SLICE, "left")
            .where(~F.col("carry").eqNullSafe(F.col("used")))
            .drop("used")
        )
        n_stale = stale.count()
    restless = _kept(stale.select("asset_guid").distinct())
    settled = starts.join(_counted(ends), _SLICE, "left").join(restless, "asset_guid", "left_anti")
    return settled, restless


def rows_per_asset(telemetry: DataFrame) -> DataFrame:
    return telemetry.groupBy("asset_guid").agg(F.count(F.lit(1)).alias("n"))


def _sliced(
    moments: DataFrame, counts: DataFrame, cfg: CycleConfig, rules, seeds: DataFrame | None
) -> tuple[DataFrame, DataFrame | None, int]:
    """Rows with their `slice`, the state to start slices with, and the number of rows.

    Trucks with many rows are set apart and kept in the checkpoint folder, as
    they are read again in each round; all others pass by untouched.
    """
    most, count = counts.agg(F.max("n"), F.sum("n")).first()
    count = count or 0
    first = None if seeds is None else seeds.withColumn("slice", F.lit(0))
    if (most or 0) <= cfg.max_rows_per_slice:
        return moments.withColumn("slice", F.lit(0)), first, count
    few = _kept(counts.where(F.col("n") > cfg.max_rows_per_slice).select("asset_guid"))
    cuts = _kept(_cuts(moments.join(few, "asset_guid", "left_semi"), cfg))
    later = F.filter("cuts", lambda c: c <= _cell(cfg))
    many = _kept(
        moments.join(few, "asset_guid", "left_semi")
        .join(cuts, "asset_guid", "left")
        .withColumn("slice", F.when(F.col("cuts").isNull(), 0).otherwise(F.size(later)))
        .drop("cuts")
    )
    others = moments.join(few, "asset_guid", "left_anti").withColumn("slice", F.lit(0))
    few_first = None if first is None else first.join(few, "asset_guid", "left_semi")
    starts, restless = _settle(many, cfg, rules, few_first, count)
    whole = restless.withColumn("whole", F.lit(0))
    many = many.join(whole, "asset_guid", "left").withColumn("slice", F.coalesce("whole", "slice")).drop("whole")
    if first is not None:
        starts = starts.unionByName(first, allowMissingColumns=True)
    return others.unionByName(many), starts, count


def cycle_changes(
    moments: DataFrame,
    cfg: CycleConfig = DEFAULT,
    rules=None,
    closed_only: bool = False,
    counts: DataFrame | None = None,
    seeds: DataFrame | None = None,
) -> DataFrame:
    """Every cycle change caused by the enriched telemetry, and the lost records.

    `closed_only` leaves the rows that do not finish a cycle inside the task.
    `counts` gives rows per asset (asset_guid, n) or an upper bound of them, to
    find the trucks to slice without working out `moments` for it.
    `seeds` (asset_guid, carry) are the states that trucks start from.
    """
    ship_package(moments.sparkSession)
    if counts is None:
        counts = rows_per_asset(moments)
    rows, starts, count = _sliced(moments, counts, cfg, rules, seeds)
    seq = moments.schema["seq"].dataType.simpleString()
    changes = _in_order(rows, starts, count).mapInArrow(
        _fold_changes(cfg, rules, closed_only, seq), change_wire(seq)
    )
    return to_changes(changes)
