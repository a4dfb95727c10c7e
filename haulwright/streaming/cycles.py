"""The same job on a stream of telemetry.

State is keyed by asset: the time of the last change, and the open cycle of each site as an
entry of its own, so that a micro-batch reads and writes only the sites it has rows of. It lives
in the state store across restarts. A stream begins from nothing or from the tables of an
earlier run (`plans.cycles.start_states`). The late-data rule compares with the time of the last
change of the asset, so no watermark is involved. A micro-batch brings the rows of an asset in
any order; they are sorted by (time, seq) first, in bounded memory (`ordering`).
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from haulwright.config import DEFAULT, FINAL_STATUSES, CycleConfig
from haulwright.engine.batch import change_arrow, change_row, to_changes
from haulwright.engine.machine import CycleMachine
from haulwright.engine.state import Sighting
from haulwright.operators.history import latest_changes
from haulwright.plans.cycles import progress
from haulwright.session import ship_package
from haulwright.schemas import CHANGE_COLS, CYCLE_COLS, MOMENT_COLS, change_wire
from haulwright.streaming.ordering import IN_MEMORY, in_order
from haulwright.streaming.tables import VersionedTable, cycle_rows, progress_rows

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_TEXT = T.StructType([T.StructField("text", T.StringType())])
_MOMENT = T.StructType([T.StructField("changed_at", T.LongType())])
_SITE = T.StructType([T.StructField("site", T.StringType())])
_BLOCK = T.StructType([T.StructField("run", T.IntegerType()), T.StructField("block", T.IntegerType())])
_AT, _SEQ = MOMENT_COLS.index("at_us"), MOMENT_COLS.index("seq")


class HeldSites:
    """Open cycles by site, read from a map state when asked for; `store` writes those set since."""

    def __init__(self, state) -> None:
        self.state = state
        self.held: dict[str | None, dict | None] = {}
        self.touched: set[str | None] = set()

    def get(self, site: str | None) -> dict | None:
        if site not in self.held:
            found = self.state.getValue((json.dumps(site),))
            self.held[site] = json.loads(found[0]) if found is not None else None
        return self.held[site]

    def __setitem__(self, site: str | None, record: dict) -> None:
        self.held[site] = record
        self.touched.add(site)

    def store(self) -> None:
        for site in self.touched:
            self.state.updateValue((json.dumps(site),), (json.dumps(self.held[site]),))
        self.touched.clear()


# Nullable pandas types keep whole numbers whole where values are missing.
_PANDAS = {"int64": "Int64", "int32": "Int32", "bool": "boolean", "double": "Float64"}
_WHOLE = {"at_us", "work_state_id"}
#: Changes handed on at a time.
_FLUSH_ROWS = 5_000


def plain_rows(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """Rows as the engine expects them: None for missing, no NumPy types, whole numbers whole."""
    for frame in frames:
        columns = []
        for name in MOMENT_COLS:
            values = frame[name].astype(object)
            values = [None if v is None or v is pd.NA or v != v else v for v in values]
            if name in _WHOLE:
                values = [None if v is None else int(v) for v in values]
            columns.append([v.item() if hasattr(v, "item") else v for v in values])
        yield from zip(*columns)


class CycleProcessor(StatefulProcessor):
    """Rows come and changes go in frames of bounded size, whatever a micro-batch holds of an asset."""

    def __init__(self, cfg: CycleConfig, rules=None, seq: str = "bigint", in_memory: int = IN_MEMORY) -> None:
        self.cfg = cfg
        self.rules = rules
        self.schema = change_arrow(seq)
        self.in_memory = in_memory

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.changed = handle.getValueState("changed", _MOMENT)
        self.sites = handle.getMapState("sites", _SITE, _TEXT)
        self.waiting = handle.getMapState("waiting", _BLOCK, _TEXT)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        for carry in initialState["carry"]:
            held = json.loads(carry)
            if held["changed_at"] is not None:
                self.changed.update((held["changed_at"],))
            for site, record in held["open"].items():
                self.sites.updateValue((json.dumps(site),), (json.dumps(record),))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        machine = CycleMachine(self.cfg, self.rules)
        machine.open = HeldSites(self.sites)
        before = self.changed.get()[0] if self.changed.exists() else None
        machine.changed_at = before
        by_time = lambda row: (row[_AT] is not None, row[_AT] or 0, row[_SEQ])
        out: list[tuple] = []
        for row in in_order(plain_rows(rows), self.waiting, by_time, self.in_memory):
            at = Sighting._make(row)
            out.extend(change_row(at, *change) for change in machine.feed(at))
            if len(out) >= _FLUSH_ROWS:
                yield self._frame(out)
                out = []
        machine.open.store()
        if machine.changed_at != before:
            self.changed.update((machine.changed_at,))
        if out:
            yield self._frame(out)

    def _frame(self, out: list[tuple]) -> pd.DataFrame:
        columns = dict(zip(CHANGE_COLS, zip(*out)))
        return pd.DataFrame({f.name: pd.Series(columns[f.name], dtype=_PANDAS.get(str(f.type), object)) for f in self.schema})

    def close(self) -> None:
        pass


def cycle_change_stream(
    moments: DataFrame, cfg: CycleConfig = DEFAULT, rules=None, seeds: DataFrame | None = None, in_memory: int = IN_MEMORY
) -> DataFrame:
    """Cycle changes of a stream of placed telemetry (`plans.enrich.moments`).

    `seeds` (asset_guid, carry) are the states that trucks start from; they count when the stream
    first runs, and no more once it has a checkpoint. Up to `in_memory` rows that an asset has
    in a micro-batch are sorted in memory, more by way of the state store.
    The session needs the RocksDB state store (`STATE_STORE`).
    """
    ship_package(moments.sparkSession)
    seq = moments.schema["seq"].dataType.simpleString()
    initial = None if seeds is None else seeds.select("asset_guid", "carry").groupBy("asset_guid")
    changed = (
        moments.select(*MOMENT_COLS)
        .groupBy("asset_guid")
        .transformWithStateInPandas(
            statefulProcessor=CycleProcessor(cfg, rules, seq, in_memory),
            outputStructType=change_wire(seq),
            outputMode="Append",
            timeMode="None",
            initialState=initial,
        )
    )
    return to_changes(changed)


def table_sink(
    folder: str,
    cfg: CycleConfig = DEFAULT,
    current: VersionedTable | None = None,
    moved: VersionedTable | None = None,
    now: Callable[[], str] = lambda: datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f"),
) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that stores each micro-batch under its own number.

    A micro-batch that is repeated after a failure replaces its own files, so
    nothing is written twice. `current` and `moved` are the current cycle table and, in
    realtime, the progress table, which it upserts (`tables.cycle_table`, `tables.progress_table`).
    """

    def store(name: str, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{folder}/{name}/batch_id={batch_id}")

    def write(log: DataFrame, batch_id: int) -> None:
        log.persist()
        try:
            store("changes", log, batch_id)
            closed = log.where(F.col("cycle_status").isin(*FINAL_STATUSES))
            store("final", closed.select(*CYCLE_COLS), batch_id)
            if cfg.service == "realtime":
                store("progress", progress(log, cfg), batch_id)
            moment = now()
            if current is not None:
                current.upsert(cycle_rows(log, moment), batch_id)
            if moved is not None and cfg.service == "realtime":
                moved.upsert(progress_rows(log, moment, cfg), batch_id)
        finally:
            log.unpersist()

    return write


def stored_current(changes: DataFrame) -> DataFrame:
    """The current table from the stored changes of all micro-batches."""
    return latest_changes(changes).select(*CYCLE_COLS)
