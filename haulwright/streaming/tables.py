"""Tables on files that micro-batches upsert: a snapshot and deltas for each bucket of keys.

A micro-batch writes its rows as one delta for each bucket that it touches. A bucket with
`most_deltas` of them is written anew as a snapshot, and no other bucket is. What makes up
each bucket is listed in a version file, written last and moved into place at once, so that
readers see the table before or after a micro-batch. A micro-batch that is already part of a
version changes nothing; one that failed before its version was in place overwrites its own
files. One writer at a time, as a stream is.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulwright.config import DEFAULT, CycleConfig
from haulwright.plans.cycles import CYCLE_TABLE, current_cycles, progress
from haulwright.schemas import CYCLE_COLS, CYCLE_KEY, CYCLE_TABLE_COLS, PROCESS_INFO_COLS

# Spark types of the progress table.
PROGRESS_TABLE = (
    "tx_process_info_id bigint, process_name string, process_date timestamp_ntz, created_date timestamp_ntz, "
    "updated_date timestamp_ntz, asset_guid string, site_guid string"
)
_VERSION, _SNAPSHOT, _BUCKET = "_version", "_snapshot", "_bucket"


@dataclass(frozen=True)
class Merge:
    """How versions of a row become one: the latest counts but for these columns."""

    key: tuple[str, ...]
    first: tuple[str, ...] = ()  # the earliest version counts
    largest: tuple[str, ...] = ()
    #: Column that tells when a row was changed, and whether inserting counts as a change.
    updated: str = "updated_date"
    set_on_insert: bool = True


class VersionedTable:
    def __init__(self, spark: SparkSession, folder: str, schema: str, merge: Merge, buckets: int = 32, most_deltas: int = 8) -> None:
        """`buckets` of a table that exists already is as it was made."""
        self.spark, self.folder, self.merge, self.most_deltas = spark, folder, merge, most_deltas
        self.columns = T._parse_datatype_string(schema)
        marks = [T.StructField(_VERSION, T.LongType()), T.StructField(_SNAPSHOT, T.BooleanType())]
        self.stored = T.StructType([*self.columns.fields, *marks])
        self.buckets = (self.version() or {"buckets": buckets})["buckets"]

    # Version files, by Hadoop's file system, as the folder may be anywhere that Spark can write.

    def _path(self, *parts: object):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.folder, *map(str, parts)]))

    def _files(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[str]:
        """Names of the version files, oldest first."""
        found = self._files().globStatus(self._path("versions", "*.json"))
        return sorted(f.getPath().getName() for f in found) if found is not None else []

    def version(self, name: str | None = None) -> dict | None:
        """A version (default: the latest): its batch, and the snapshot and deltas of each bucket."""
        name = name or max(self.versions(), default=None)
        if name is None:
            return None
        with_text = self._files().open(self._path("versions", name))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(with_text, "UTF-8"))
        finally:
            with_text.close()

    def _publish(self, version: dict) -> None:
        name = f"{version['batch'] + 1:020d}.json"
        files, tmp, final = self._files(), self._path("versions", f"_{name}"), self._path("versions", name)
        out = files.create(tmp, True)
        out.write(bytearray(json.dumps(version).encode()))
        out.close()
        if not files.rename(tmp, final):
            raise RuntimeError(f"{final.toString()} can't be put in place")

    # Reading

    def _rows(self, version: dict, buckets: list[str], deltas: bool = True) -> DataFrame:
        paths = []
        for b in buckets:
            held = version["parts"][b]
            snapshot = [] if held["snapshot"] is None else [f"snapshot-{held['snapshot']}"]
            paths += [f"{self.folder}/{p}/{_BUCKET}={b}" for p in [*snapshot, *(f"delta-{d}" for d in held["deltas"] * deltas)]]
        if not paths:
            return self.spark.createDataFrame([], self.stored)
        return self.spark.read.schema(self.stored).parquet(*paths)

    def _merged(self, rows: DataFrame) -> DataFrame:
        """One row of each key from all its versions."""
        m, last = self.merge, F.col(_VERSION)
        single = F.count("*") == 1
        late = F.max_by(F.struct(*(c for c in rows.columns if c not in m.key)), last)
        found = rows.groupBy(*m.key).agg(
            late.alias("late"),
            *(F.min_by(c, F.when(F.col(c).isNotNull(), last)).alias(f"first_{c}") for c in m.first),
            *(F.max(c).alias(f"largest_{c}") for c in m.largest),
            single.alias("single"),
        )

        def value(name: str):
            if name in m.key:
                return F.col(name)
            if name in m.first:
                return F.col(f"first_{name}").alias(name)
            if name in m.largest:
                return F.col(f"largest_{name}").alias(name)
            own = F.col(f"late.{name}")
            if name == m.updated and not m.set_on_insert:
                own = F.when(F.col("single") & ~F.col(f"late.{_SNAPSHOT}"), None).otherwise(own)
            return own.alias(name)

        return found.select(*(value(c) for c in self.columns.names))

    def read(self) -> DataFrame:
        """The table as of the latest version; buckets without deltas are read as they are."""
        version = self.version()
        if version is None:
            return self.spark.createDataFrame([], self.columns)
        split = {True: [], False: []}
        for b, held in version["parts"].items():
            split[bool(held["deltas"])].append(b)
        whole = self._rows(version, split[False]).select(*self.columns.names)
        return whole.unionByName(self._merged(self._rows(version, split[True]))) if split[True] else whole

    # Writing

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(_BUCKET, F.pmod(F.xxhash64(*self.merge.key), F.lit(self.buckets)).cast("int"))

    def _write(self, rows: DataFrame, kind: str, batch: int, snapshot: bool) -> None:
        marked = rows.select(*self.columns.names, F.lit(batch).cast("long").alias(_VERSION), F.lit(snapshot).alias(_SNAPSHOT))
        placed = self._bucketed(marked).repartition(self.buckets, _BUCKET)
        placed.write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{self.folder}/{kind}-{batch}")

    def start(self, rows: DataFrame) -> None:
        """Make the table from rows, one of each key; does nothing if it has a version already."""
        if self.version() is not None:
            return
        self._write(rows, "snapshot", -1, True)
        filled = [r[0] for r in self._bucketed(rows).select(_BUCKET).distinct().collect()]  # at most `buckets`
        parts = {str(b): {"snapshot": -1, "deltas": []} for b in sorted(filled)}
        self._publish({"batch": -1, "buckets": self.buckets, "parts": parts})

    def upsert(self, rows: DataFrame, batch: int) -> list[int]:
        """Insert or update rows, one of each key, as micro-batch `batch`; returns the buckets written anew."""
        version = self.version() or {"batch": -1, "buckets": self.buckets, "parts": {}}
        if version["batch"] >= batch:
            return []
        placed = self._bucketed(rows.select(*self.columns.names)).persist()
        try:
            touched = [r[0] for r in placed.select(_BUCKET).distinct().collect()]  # at most `buckets`
            parts = version["parts"]
            full = [b for b in touched if len(parts.get(str(b), {"deltas": []})["deltas"]) >= self.most_deltas]
            if len(full) < len(touched):
                self._write(placed.where(~F.col(_BUCKET).isin(full)), "delta", batch, False)
            if full:
                new = placed.where(F.col(_BUCKET).isin(full)).drop(_BUCKET)
                new = new.withColumns({_VERSION: F.lit(batch).cast("long"), _SNAPSHOT: F.lit(False)})
                old = self._rows(version, [str(b) for b in full])
                self._write(self._merged(old.unionByName(new)), "snapshot", batch, True)
            for b in touched:
                held = parts.setdefault(str(b), {"snapshot": None, "deltas": []})
                parts[str(b)] = {"snapshot": batch, "deltas": []} if b in full else {**held, "deltas": [*held["deltas"], batch]}
            self._publish({"batch": batch, "buckets": self.buckets, "parts": parts})
            return sorted(full)
        finally:
            placed.unpersist()

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove what none of the last `keep` versions is made of; returns the names removed."""
        names = self.versions()
        used = set()
        for name in names[-keep:]:
            for b, held in self.version(name)["parts"].items():
                used |= {f"snapshot-{held['snapshot']}/{_BUCKET}={b}", *(f"delta-{d}/{_BUCKET}={b}" for d in held["deltas"])}
        files, gone = self._files(), []
        for found in files.globStatus(self._path("*-*", f"{_BUCKET}=*")) or []:
            name = f"{found.getPath().getParent().getName()}/{found.getPath().getName()}"
            if name not in used:
                files.delete(found.getPath(), True)
                gone.append(name)
        for name in names[:-keep]:
            files.delete(self._path("versions", name), False)
            gone.append(f"versions/{name}")
        return sorted(gone)


def cycle_table(spark: SparkSession, folder: str, **options) -> VersionedTable:
    """The current cycle table: a row keeps its key and creation time."""
    merge = Merge(tuple(CYCLE_KEY), first=("asset_cycle_vlx_id", "created_date"))
    return VersionedTable(spark, folder, CYCLE_TABLE, merge, **options)


def progress_table(spark: SparkSession, folder: str, **options) -> VersionedTable:
    """The progress table: a row keeps its key, site and creation time, and its date never falls."""
    first = ("tx_process_info_id", "created_date", "site_guid")
    merge = Merge(("asset_guid", "process_name"), first=first, largest=("process_date",), set_on_insert=False)
    return VersionedTable(spark, folder, PROGRESS_TABLE, merge, **options)


def cycle_rows(log: DataFrame, now: str) -> DataFrame:
    """Rows of the cycle table after a log, as new ones."""
    moment = F.lit(now).cast("timestamp_ntz")
    named = {"asset_cycle_vlx_id": F.xxhash64(*CYCLE_KEY), "created_date": moment, "updated_date": moment}
    return current_cycles(log).select(*CYCLE_COLS).withColumns(named).select(*CYCLE_TABLE_COLS)


def progress_rows(log: DataFrame, now: str, cfg: CycleConfig = DEFAULT) -> DataFrame:
    """Rows of the progress table after a log, as new ones."""
    moment = F.lit(now).cast("timestamp_ntz")
    named = {"tx_process_info_id": F.xxhash64("asset_guid", "process_name"), "created_date": moment, "updated_date": moment}
    return progress(log, cfg).withColumns(named).select(*PROCESS_INFO_COLS)
