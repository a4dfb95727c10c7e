"""Helpers shared by the operators: tables, shared folders, batches of texts, groups."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulwright.session import ship_package, use_checkpoint_dir

#: Bytes of text that one step of numpy work takes at a time; a longer text is a step of its own.
STEP_BYTES = 4 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def mapped(rows: DataFrame, run: Callable, schema: str) -> DataFrame:
    """mapInArrow with this package at hand in the Python workers."""
    ship_package(rows.sparkSession)
    return rows.mapInArrow(run, schema)


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the checkpoint folder, which driver and executors share."""
    use_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{label}-{uuid.uuid4().hex[:12]}"


def stored(rows: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read again, which cuts the lineage."""
    spark = rows.sparkSession
    path = shared_path(spark, label)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


class Filter:
    """A bit field over hashes of keys, of bounded size, to leave rows out before a shuffle.

    Rows with one of the keys always pass, others seldom while 16 bits are there for
    each key. The field never exceeds `most` bits (8 MB, as rows of 64 bits
    16 MB), so it may be broadcast; beyond that size more rows pass, none is lost.
    """

    def __init__(self, keys: DataFrame, most: int = 1 << 26):
        """keys: a stored table with the column key (long)."""
        count = keys.agg(F.approx_count_distinct("key")).first()[0]
        self.bits = min(most, 1 << max(6, (16 * count).bit_length()))
        words = keys.select(*self._place(F.col("key"))).groupBy("_word").agg(F.bit_or("_bit").alias("_held"))
        self.words = F.broadcast(words.withColumnRenamed("_word", "_at"))

    def _place(self, key: Column) -> list[Column]:
        place = F.pmod(F.xxhash64(key), F.lit(self.bits).cast("long"))
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))
        return [F.shiftright(place, 6).alias("_word"), bit.alias("_bit")]

    def split(self, rows: DataFrame, key: Column) -> tuple[DataFrame, DataFrame]:
        """Rows that may have one of the keys, and those that have none."""
        word, bit = self._place(key)
        placed = rows.withColumns({"_word": word, "_bit": bit})
        same = (F.col("_word") == F.col("_at")) & (F.col("_bit").bitwiseAND(F.col("_held")) != 0)
        return tuple(placed.join(self.words, same, how).drop("_word", "_bit") for how in ("left_semi", "left_anti"))


def unused(name: str, columns: list[str]) -> str:
    """A column name that isn't taken, whatever its case."""
    taken = {c.lower() for c in columns}
    name = f"_{name}"
    while name.lower() in taken:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """Texts of a column; null becomes the empty text."""
    return [t or "" for t in column.to_pylist()]


def steps(batches: Iterable[pa.RecordBatch], column: str, most: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into slices whose texts hold about `most` bytes together."""
    for batch in batches:
        sizes = batch.column(column)
        lengths = np.asarray(
            pc.fill_null(pc.binary_length(sizes), 0).to_numpy(zero_copy_only=False), dtype=np.int64
        )
        start, held = 0, 0
        for row, size in enumerate(lengths.tolist()):
            if held and held + size > most:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        if batch.num_rows > start:
            yield batch.slice(start)


def key_groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[tuple[object, pa.Table]]:
    """Rows of each key, from batches sorted by it; holds one key's rows at a time."""
    kept: list[pa.RecordBatch] = []
    current: object = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            if kept and values[start] != current:
                yield current, pa.Table.from_batches(kept)
                kept = []
            current = values[start]
            kept.append(batch.slice(start, end - start))
    if kept:
        yield current, pa.Table.from_batches(kept)


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(values: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit hash of 64-bit values."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def byte_symbols() -> list[str]:
    """The printable symbol that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    symbols = {b: chr(b) for b in plain}
    for b in range(256):
        symbols.setdefault(b, chr(256 + len(symbols) - len(plain)))
    return [symbols[b] for b in range(256)]
