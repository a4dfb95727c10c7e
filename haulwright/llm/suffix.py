"""Removal of repeated passages by suffix arrays over shards of related text.

A byte is removed if it lies in a string of `span` bytes that also starts in a
document with a smaller id. Shards: each window of `span` bytes belongs
to the smallest hash of the short strings in it, so equal windows meet in one
shard wherever they are. Neighbouring windows with the same hash form a run.

1. Texts that a smaller document has as a whole are covered as a whole. The hashes of
   the other documents' runs are dealt by value; those of one document only are out
   of the question.
2. Runs of shared hashes go to their shards with their bytes. Equal runs
   are settled by the smallest id. Over the different runs of a hash a suffix
   array is built by induced sorting (`sais`), and permuted common prefixes of at
   least `span` bytes give the groups of equal windows.
3. Covered stretches return to their documents, where they are joined.

A hash that occurs in more than `hot` documents isn't gathered in a shard:
its windows are aggregated one by one before the shuffle, with all places that
a step has of one.

Null and empty texts have no bytes. Rows with the same id don't cover each other;
rows that repeat id and text share one result. A row without id is neither
covered nor covers. Removed bytes may cut a character in two. A column `repeats`
is replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulwright.llm.common import Filter, mapped, mixed, partitions, steps, stored, table, texts_of
from haulwright.llm.sais import common_prefixes, suffix_array

SPAN = 50
#: Bytes of the short strings whose smallest hash names a window's shard. Strings of 16 bytes meet by chance
#: in more and more documents as the input grows, longer ones make more runs.
SHORT = 24
#: Documents of one hash that a shard gathers at most.
HOT = 200_000
#: Bytes of text for each shard, on average.
SHARE = 16 << 20
#: Bytes of text that one step of numpy work, or one suffix array, takes at a time.
STEP = 1 << 20
#: Windows that are hashed at a time, so that their hashes stay in a core's cache.
BLOCK = 1 << 15

_C1, _C2, _C3 = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_LONGS = pa.list_(pa.int64())


class Runs:
    """Runs of windows of some texts: their hashes, rows, places and window counts."""

    def __init__(self, texts: list[str], span: int):
        encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
        sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.span = span
        self.raw = b"".join(encoded) + bytes(span + 16)
        self.data = np.frombuffer(self.raw, np.uint8)
        total = int(sizes.sum())
        windows = total - span + 1
        empty = np.zeros(0, np.int64)
        self.hash, self.row, self.at, self.count = np.zeros(0, np.uint64), empty, empty, empty
        if windows < 1:
            return
        edge = np.zeros(total + 1, np.int8)
        long = sizes >= span
        np.add.at(edge, self.starts[long], 1)
        np.add.at(edge, self.ends[long] - span + 1, -1)
        inside = np.cumsum(edge[:windows], dtype=np.int8) > 0
        least = self._least(windows)
        change = np.r_[True, (least[1:] != least[:-1]) | ~inside[:-1]]
        self.at = np.flatnonzero(inside & change)
        after = np.r_[change[1:] | ~inside[1:], True]
        self.count = np.flatnonzero(inside & after) - self.at + 1
        self.hash = least[self.at]
        self.row = np.searchsorted(self.starts, self.at, side="right") - 1

    def _least(self, windows: int) -> np.ndarray:
        """The smallest hash of the short strings in each window."""
        words = np.ndarray((windows + self.span - 8,), "<u8", self.data, strides=(1,))
        short = min(SHORT, self.span)
        width = self.span - short + 1
        offsets = [*range(8, short - 8, 8), short - 8]
        out = np.empty(windows, np.uint64)
        for start in range(0, windows, BLOCK):
            size = min(BLOCK, windows - start) + width - 1
            values = words[start : start + size] * _C1
            high = np.empty_like(values)
            for offset in offsets:
                values ^= words[start + offset : start + offset + size]
                values *= _C2
                values ^= np.right_shift(values, np.uint64(31), out=high)
            values *= _C3
            values ^= np.right_shift(values, np.uint64(29), out=high)
            have = 1
            while 2 * have <= width:
                values = np.minimum(values[:-have], values[have:])
                have *= 2
            if have < width:
                values = np.minimum(values[: have - width], values[width - have :])
            out[start : start + BLOCK] = values
        return out

    def texts(self, runs: np.ndarray) -> list[bytes]:
        at, ends = self.at[runs], self.at[runs] + self.count[runs] + self.span - 1
        return [self.raw[a:b] for a, b in zip(at.tolist(), ends.tolist(), strict=True)]


def _marks(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """One number for a hash in a row."""
    return mixed(hashes ^ mixed(rows.view(np.uint64)))


_SIX, _16 = np.uint64((1 << 48) - 1), np.uint64(16)


def _six_bytes(hashes: np.ndarray) -> bytes:
    return np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from_six(packed: bytes) -> np.ndarray:
    out = np.zeros((len(packed) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(packed, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).ravel()


def _parts(values: np.ndarray, count: int) -> np.ndarray:
    return np.mod(values.view(np.int64), count)


def _cuts(values: np.ndarray) -> np.ndarray:
    """Starts of the groups of equal neighbours, and the end."""
    return np.r_[np.flatnonzero(np.r_[True, values[1:] != values[:-1]]), len(values)] if len(values) else np.zeros(1, np.int64)


def _dealt(part: np.ndarray, columns: list[np.ndarray]) -> Iterator[list]:
    """Values by part: [part, values of each column]."""
    # numpy sorts short integers by counting
    order = np.argsort(part.astype(np.uint16) if len(part) and part.max() < 1 << 16 else part, kind="stable")
    part, columns = part[order], [c[order] for c in columns]
    cuts = _cuts(part)
    for start, end in zip(cuts[:-1], cuts[1:], strict=True):
        yield [int(part[start]), *(c[start:end].view(np.int64) for c in columns)]


def _short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of rows that two bytes can number."""
    for batch in batches:
        for start in range(0, batch.num_rows, 1 << 16):
            yield batch.slice(start, 1 << 16)


def _batch(rows: list[list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _held_and_streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[pa.RecordBatch], pa.RecordBatch | None]]:
    """For batches sorted by (part, streams): what a part holds, then its streamed rows batch by batch; None if it has none."""
    current, held, seen = None, [], False
    for batch in batches:
        part, streams = (batch.column(c).to_numpy() for c in ("part", "streams"))
        cuts = _cuts(part * 2 + streams)
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            if part[start] != current:
                if held and not seen:
                    yield held, None
                current, held, seen = part[start], [], False
            rows = batch.slice(start, end - start)
            if streams[start]:
                seen = True
                yield held, rows
            else:
                held.append(rows)
    if held and not seen:
        yield held, None


def _joined(held: list[pa.RecordBatch], column: str, kind=np.int64) -> np.ndarray:
    parts = [b.column(column).flatten().to_numpy() for b in held]
    return np.concatenate(parts).view(kind) if parts else np.zeros(0, kind)


def _shared_hashes(rows: DataFrame, parts: int, span: int, hot: int) -> DataFrame:
    """part (of the row), marks of hashes that several rows have, and these rows; with part -1 the hot hashes.

    Hashes travel as six bytes: two that meet by chance only make a candidate more.
    """
    sent = pa.schema([("part", pa.int64()), ("known", pa.bool_()), ("hash", pa.binary()), ("row", _LONGS), ("rows", _LONGS)])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(_short(batches), "text", STEP):
            runs = Runs(texts_of(batch.column("text")), span)
            if not len(runs.hash):
                continue
            names, number = np.unique(batch.column("row").to_numpy(), return_inverse=True)
            both = np.sort(runs.hash << _16 | number[runs.row].view(np.uint64))  # six bytes of hash, two of row
            both = both[np.r_[True, both[1:] != both[:-1]]]
            value, number = both >> _16, both.astype(np.uint16)
            row = names[number]
            cuts = _cuts(value)
            size = np.repeat(np.diff(cuts), np.diff(cuts))
            lead = np.zeros(len(value), bool)
            lead[cuts[:-1]] = True  # one row asks for all rows of a value here
            by_row = np.argsort(number[lead], kind="stable")  # rows in order take few bytes
            asked = [c[lead][by_row] for c in (value, row, size)]
            out = [[p, False, _six_bytes(h), r, n] for p, h, r, n in _dealt(_parts(asked[0], parts), asked)]
            know = size > 1
            none = np.zeros(0, np.int64)
            known = [_marks(value[know], row[know]), row[know]]
            out += [[p, True, m.tobytes(), r, none] for p, m, r in _dealt(_parts(row[know], parts), known)]
            yield _batch(out, sent)

    found = pa.schema([("part", pa.int64()), ("marks", _LONGS), ("rows", _LONGS)])

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in _part_groups(batches):
            out, asked = [], []
            for b in group:
                known = b.column("known").to_numpy(zero_copy_only=False)
                asked.append(b.filter(pa.array(~known)))
                for own, m, r in zip(known, b.column("hash"), b.column("row"), strict=True):
                    if own:
                        out.append([int(b.column("part")[0].as_py()), np.frombuffer(m.as_py(), np.int64), np.unique(r.values.to_numpy())])
            value = _from_six(b"".join(h for b in asked for h in b.column("hash").to_pylist()))
            row, weight = (_joined(asked, c) for c in ("row", "rows"))
            order = np.argsort(value)
            value, row, weight = value[order], row[order], weight[order]
            if len(value):
                cuts = _cuts(value)
                many = np.add.reduceat(weight, cuts[:-1])
                shared = np.repeat(many > 1, np.diff(cuts))
                burning = value[cuts[:-1]][many > hot]
                marked = [_marks(value[shared], row[shared]), row[shared]]
                out += [[p, m, np.unique(r)] for p, m, r in _dealt(_parts(row[shared], parts), marked)]
                if len(burning):
                    out.append([-1, burning.view(np.int64), np.zeros(0, np.int64)])
            if out:
                yield _batch(out, found)

    dealt = rows.select("row", "text").transform(mapped, find, "part long, known boolean, hash binary, row array<long>, rows array<long>")
    dealt = dealt.repartition(min(parts, 4096), "part").sortWithinPartitions("part")
    return dealt.transform(mapped, settle, "part long, marks array<long>, rows array<long>")


def _part_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    current, held = None, []
    for batch in batches:
        part = batch.column("part").to_numpy()
        cuts = _cuts(part)
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            if held and part[start] != current:
                yield current, held
                held = []
            current = int(part[start])
            held.append(batch.slice(start, end - start))
    if held:
        yield current, held


def _runs_of_shared(rows: DataFrame, marks: DataFrame, burning: np.ndarray, parts: int, span: int) -> DataFrame:
    """Runs of shared hashes with their bytes, dealt to shards.

    Of equal runs in a step only those of the smallest document are sent; the
    others are covered, which goes straight to their rows' parts.
    """
    sent = _RUNS_SENT
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(np.sort(burning))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built, known = None, np.zeros(0, np.uint64)
        for held, streamed in _held_and_streamed(batches):
            if built is not held:
                built, known = held, np.sort(_joined(held, "marks", np.uint64))
            if streamed is None or not len(known):
                continue
            for batch in steps([streamed], "text", STEP):
                runs = Runs(texts_of(batch.column("text")), span)
                doc, row = (batch.column(c).to_numpy()[runs.row] for c in ("doc", "row"))
                value = runs.hash & _SIX
                at = np.flatnonzero(_within(_marks(value, row), known) & ~_within(value, shared.value))
                if not len(at):
                    continue
                number: dict[bytes, int] = {}
                texts = runs.texts(at)
                same = np.array([number.setdefault(t, len(number)) for t in texts])
                least = np.full(len(number), np.iinfo(np.int64).max)
                np.minimum.at(least, same, doc[at])
                place = runs.at[at] - runs.starts[runs.row[at]]
                open_ = doc[at] == least[same]
                go, done = np.flatnonzero(open_), np.flatnonzero(~open_)
                columns = [value[at[go]], doc[at[go]], row[at[go]], place[go], runs.count[at[go]], go]
                out = [
                    [p, _six_bytes(h.view(np.uint64)), d, r, a, n, _pack(b"".join(texts[k] for k in own.tolist()))]
                    for p, h, d, r, a, n, own in _dealt(_parts(columns[0], parts), columns)
                ]
                covered = [row[at[done]], place[done], runs.count[at[done]]]
                none = np.zeros(0, np.int64)
                out += [[p, None, none, r, a, n, None] for p, r, a, n in _dealt(_parts(covered[0], parts), covered)]
                yield _batch(out, sent)

    none = F.lit(None)
    held = marks.where("part >= 0").select("part", F.lit(0).cast("long").alias("streams"), "marks", none.cast("long").alias("doc"), none.cast("long").alias("row"), none.cast("string").alias("text"))
    texts = rows.select(_part_of(F.col("row"), parts).alias("part"), F.lit(1).cast("long").alias("streams"), none.cast("array<long>").alias("marks"), "doc", "row", "text")
    both = held.unionByName(texts).repartition(min(parts, 4096), "part").sortWithinPartitions("part", "streams")
    return both.transform(mapped, run, "part long, hash binary, doc array<long>, row array<long>, at array<int>, count array<int>, text binary")


_INTS = pa.list_(pa.int32())
_RUNS_SENT = pa.schema(
    [("part", pa.int64()), ("hash", pa.binary()), ("doc", _LONGS), ("row", _LONGS), ("at", _INTS), ("count", _INTS), ("text", pa.binary())]
)


def _pack(text: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(text)


def _unpack(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def _part_of(row: Column, parts: int) -> Column:
    """The part of a row, as `_parts` has it."""
    return F.pmod(row, F.lit(parts).cast("long"))


def _within(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


def covered_windows(texts: list[bytes], owners: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows that a text of a smaller owner holds, too: the numbers of their texts, in order, and their starts there."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer(b"\xff".join(texts) + bytes(span + 16), np.uint8)  # no UTF-8 text has the byte 255
    starts = np.r_[0, np.cumsum(sizes[:-1] + 1)]
    total = int(starts[-1] + sizes[-1])
    symbols = np.zeros(total + 1, np.uint16)
    symbols[:total] = data[:total]
    symbols[:total] += 1
    array = suffix_array(symbols, 257)
    edge = np.zeros(total + 2, np.int8)
    long = sizes >= span
    edge[starts[long]] = 1
    edge[(starts + sizes - span + 1)[long]] -= 1
    room = np.cumsum(edge[: total + 1], dtype=np.int8) > 0
    whole = array[room[array]]
    if not len(whole):
        return whole, whole
    text = np.searchsorted(starts, whole, side="right") - 1
    owner = owners[text]
    shared = common_prefixes(data, whole, span)[whole]
    cuts = np.r_[np.flatnonzero(np.r_[True, shared[1:] < span]), len(whole)]
    least = np.repeat(np.minimum.reduceat(owner, cuts[:-1]), np.diff(cuts))
    covered = owner > least
    places = np.sort(whole[covered])
    text = np.searchsorted(starts, places, side="right") - 1
    return text, places - starts[text]


def _stretches(text: np.ndarray, places: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Joined stretches of bytes of windows at sorted places of texts in order: their texts, starts and ends."""
    cut = np.r_[True, (np.diff(places) > 1) | (text[1:] != text[:-1])][: len(places)]
    first = np.flatnonzero(cut)
    last = np.r_[first[1:], len(places)][: len(first)] - 1
    return text[first], places[first], places[last] + span


def _chunks(runs: np.ndarray, value: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Runs in the order of their hashes, cut between hashes into pieces of about a step's bytes."""
    cuts = _cuts(value[runs])
    held, start = 0, 0
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        size = int(sizes[runs[a:b]].sum())
        if held and held + size > STEP:
            yield runs[start:a]
            held, start = 0, int(a)
        held += size
    if held:
        yield runs[start:]


def _shard(held: list[pa.RecordBatch], span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, starts and ends of the covered stretches of a shard."""
    settled = [b.filter(pc.is_null(b.column("hash"))) for b in held]
    held = [b.filter(pc.is_valid(b.column("hash"))) for b in held]
    value = _from_six(b"".join(h for b in held for h in b.column("hash").to_pylist()))
    doc, row, at, count = (_joined(held, c, t).astype(np.int64) for c, t in (("doc", np.int64), ("row", np.int64), ("at", np.int32), ("count", np.int32)))
    blob = b"".join(_unpack(t) for b in held for t in b.column("text").to_pylist())
    number: dict[bytes, int] = {}
    ends = np.cumsum(count + span - 1)
    places = zip((ends - count - span + 1).tolist(), ends.tolist(), strict=True)
    own = np.array([number.setdefault(blob[a:b], len(number)) for a, b in places], np.int64)
    owners = np.full(len(number), np.iinfo(np.int64).max)
    np.minimum.at(owners, own, doc)
    of_run = np.zeros(len(number), np.uint64)
    of_run[own] = value
    full = doc > owners[own]
    rows, starts, ends = [row[full]], [at[full]], [at[full] + count[full] + span - 1]
    for b in settled:
        start, size = _joined([b], "at", np.int32).astype(np.int64), _joined([b], "count", np.int32)
        rows, starts, ends = [*rows, _joined([b], "row")], [*starts, start], [*ends, start + size + span - 1]
    order = np.argsort(of_run, kind="stable")
    size = np.diff(_cuts(of_run[order]))
    texts = list(number)
    rest = np.flatnonzero(~full)
    rest = rest[np.argsort(own[rest], kind="stable")]
    owned = own[rest]
    # different runs of one hash, as many hashes at a time as a step may hold
    for chunk in _chunks(order[np.repeat(size > 1, size)], of_run, np.fromiter(map(len, texts), np.int64, len(texts))):
        found, low, high = _stretches(*covered_windows([texts[u] for u in chunk.tolist()], owners[chunk], span), span)
        # all runs with the bytes of a text have its stretches
        first, last = (np.searchsorted(owned, chunk[found], side=side) for side in ("left", "right"))
        many = last - first
        each = np.repeat(np.arange(len(found)), many)
        j = rest[np.repeat(first - np.cumsum(many) + many, many) + np.arange(len(each))]
        rows.append(row[j])
        starts.append(at[j] + low[each])
        ends.append(at[j] + high[each])
    return np.concatenate(rows), np.concatenate(starts), np.concatenate(ends)


def _stretches_of_shards(runs: DataFrame, parts: int, span: int) -> DataFrame:
    found = pa.schema([("part", pa.int64()), ("rows", _LONGS), ("starts", _LONGS), ("ends", _LONGS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held in _part_groups(batches):
            rows, starts, ends = _shard(held, span)
            if len(rows):
                yield _batch(list(_dealt(_parts(rows, parts), [rows, starts, ends])), found)

    dealt = runs.repartition(min(parts, 4096), "part").sortWithinPartitions("part")
    return dealt.transform(mapped, run, "part long, rows array<long>, starts array<long>, ends array<long>")


def _stretches_of_hot(rows: DataFrame, burning: np.ndarray, parts: int, span: int) -> DataFrame:
    """Covered stretches of hashes too frequent for a shard: windows by their own hashes, aggregated before the shuffle."""
    shared = rows.sparkSession.sparkContext.broadcast(np.sort(burning))
    named = pa.schema([("window", pa.binary()), ("doc", _LONGS), ("row", _LONGS), ("at", _INTS)])

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The windows of a step, each with all places it has there."""
        import hashlib

        for batch in steps(batches, "text", STEP):
            runs = Runs(texts_of(batch.column("text")), span)
            hot = np.flatnonzero(_within(runs.hash & _SIX, shared.value))
            if not len(hot):
                continue
            count = runs.count[hot]
            run = np.repeat(hot, count)
            at = runs.at[run] + np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
            number: dict[bytes, int] = {}
            own = np.array([number.setdefault(runs.raw[a : a + span], len(number)) for a in at.tolist()])
            order = np.argsort(own, kind="stable")
            run, at, offsets = runs.row[run[order]], at[order], pa.array(_cuts(own[order]), pa.int32())
            doc, row = (batch.column(c).to_numpy()[run] for c in ("doc", "row"))
            lists = [pa.array(c, f.type.value_type) for c, f in zip((doc, row, at - runs.starts[run]), list(named)[1:], strict=True)]
            names = pa.array([hashlib.blake2b(w, digest_size=16).digest() for w in number], pa.binary())
            yield pa.RecordBatch.from_arrays([names, *(pa.ListArray.from_arrays(offsets, c) for c in lists)], schema=named)

    found = pa.schema([("part", pa.int64()), ("rows", _LONGS), ("starts", _LONGS), ("ends", _LONGS)])

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, row, at = (batch.column(c).flatten().to_numpy() for c in ("doc", "row", "at"))
            covered = doc > np.repeat(batch.column("least").to_numpy(), pc.list_value_length(batch.column("doc")).to_numpy())
            row, at = row[covered], at[covered].astype(np.int64)
            if len(row):
                yield _batch(list(_dealt(_parts(row, parts), [row, at, at + span])), found)

    windows = stored(rows.select("doc", "row", "text").transform(mapped, name, "window binary, doc array<long>, row array<long>, at array<int>"), "windows")
    least = windows.groupBy("window").agg(F.min(F.array_min("doc")).alias("least"), F.max(F.array_max("doc")).alias("most")).where("least < most")
    both = windows.join(least.drop("most"), "window").select("doc", "row", "at", "least")
    return both.transform(mapped, cover, "part long, rows array<long>, starts array<long>, ends array<long>")


def _copies(texts: DataFrame) -> DataFrame:
    """Rows (row, size) whose whole text a smaller document has, too."""
    first = texts.groupBy("name").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last")
    first = stored(first, "first")  # so that a text with many copies can be split in the join
    return texts.join(first, "name").where("doc > first").select("row", "size").distinct()


def remove_repeats(docs: DataFrame, span: int = SPAN, hot: int = HOT, share: int = SHARE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of the rows but the text, with n_bytes, n_removed, n_spans and kept (the remaining bytes) in a struct `repeats`."""
    spark = docs.sparkSession
    keyed = docs.drop("repeats").select(F.struct("*").alias("doc_row"), F.col(key).cast("long").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    keyed = keyed.withColumn("row", F.xxhash64("doc", "text"))
    usable = keyed.where(F.col("doc").isNotNull() & (F.octet_length("text") >= span)).select("doc", "row", "text")
    texts = stored(usable.select("doc", "row", F.octet_length("text").cast("long").alias("size"), F.unhex(F.sha2("text", 256)).alias("name")), "texts")
    parts = max(partitions(spark), math.ceil((texts.agg(F.sum("size")).first()[0] or 0) / share))
    copies = stored(_copies(texts), "copies")
    # Copies have no windows that the first one lacks; some others pass the filter with them.
    some, once = Filter(copies.select(F.col("row").alias("key"))).split(usable, F.col("row"))
    once = once.unionByName(some.join(copies.hint("merge"), "row", "left_anti").select(*once.columns))
    marks = stored(_shared_hashes(once, parts, span, hot), "marks")
    burning = [r["marks"] for r in marks.where("part = -1").select("marks").collect()]
    burning = np.concatenate([np.array(b, np.int64) for b in burning]).view(np.uint64) if burning else np.zeros(0, np.uint64)
    marked = Filter(marks.select(F.explode("rows").alias("key")))
    concerned, _ = marked.split(usable, F.col("row"))
    stretches = _stretches_of_shards(_runs_of_shared(concerned, marks, burning, parts, span), parts, span)
    if len(burning):
        stretches = stretches.unionByName(_stretches_of_hot(usable, burning, parts, span))
    whole = [F.array(c).alias(name) for c, name in (("row", "rows"), (F.lit(0).cast("long"), "starts"), ("size", "ends"))]
    stretches = stretches.unionByName(copies.select(_part_of(F.col("row"), parts).alias("part"), *whole))
    stretches = stored(stretches, "stretches")
    covered = Filter(stretches.select(F.explode("rows").alias("key")))
    some, none = covered.split(keyed.select("doc_row", "row"), F.col("row"))
    cleaned = _cleaned(some, stretches, parts, text)
    data = F.coalesce(F.col(f"doc_row.{text}"), F.lit("")).cast("binary")
    whole = F.struct(
        F.octet_length(data).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), data.alias("kept"),
    )
    left = [F.col(f"doc_row.{c}").alias(c) for c in docs.columns if c not in (text, "repeats")]
    return cleaned.unionByName(none.select(*left, whole.alias("repeats")))


def _cleaned(rows: DataFrame, stretches: DataFrame, parts: int, text: str) -> DataFrame:
    left = [f for f in rows.schema["doc_row"].dataType.fields if f.name != text]
    result = pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built, own, starts, ends = None, *[np.zeros(0, np.int64)] * 3
        for held, streamed in _held_and_streamed(batches):
            if built is not held:
                built = held
                own, starts, ends = (_joined(held, c) for c in ("rows", "starts", "ends"))
                order = np.lexsort((starts, own))
                own, starts, ends = own[order], starts[order], ends[order]
            if streamed is None:
                continue
            row = streamed.column("row").to_numpy()
            low, high = np.searchsorted(own, row), np.searchsorted(own, row, side="right")
            out = []
            fields = streamed.column("doc_row")
            for a, b, t in zip(low.tolist(), high.tolist(), fields.field(text).to_pylist(), strict=True):
                data = (t or "").encode("utf-8", "surrogatepass")
                removed, spans, kept, done = 0, 0, [], 0
                for start, end in zip(starts[a:b].tolist(), ends[a:b].tolist(), strict=True):
                    if spans and start <= done:
                        removed += max(0, end - done)
                        done = max(done, end)
                        continue
                    kept.append(data[done:start])
                    spans, removed, done = spans + 1, removed + end - start, end
                kept.append(data[done:])
                out.append((len(data), removed, spans, b"".join(kept)))
            counts = [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), result, strict=True)]
            yield pa.RecordBatch.from_arrays([*(fields.field(f.name) for f in left), pa.StructArray.from_arrays(counts, fields=list(result))], [*(f.name for f in left), "repeats"])

    none = F.lit(None).cast("array<long>")
    kind = rows.schema["doc_row"].dataType
    held = stretches.select("part", F.lit(0).cast("long").alias("streams"), "rows", "starts", "ends", F.lit(None).cast(kind).alias("doc_row"), F.lit(None).cast("long").alias("row"))
    texts = rows.select(_part_of(F.col("row"), parts).alias("part"), F.lit(1).cast("long").alias("streams"), none.alias("rows"), none.alias("starts"), none.alias("ends"), "doc_row", "row")
    both = held.unionByName(texts).repartition(min(parts, 4096), "part").sortWithinPartitions("part", "streams")
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in left)
    return both.transform(mapped, run, schema + "repeats struct<n_bytes: bigint, n_removed: bigint, n_spans: bigint, kept: binary>")


def op7_repeated_spans(spark, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    found = remove_repeats(documents)
    counts = [F.col(f"repeats.{c}") for c in ("n_bytes", "n_removed", "n_spans")]
    return found.select("doc_id", *counts, F.sha2("repeats.kept", 256).alias("kept_sha256"))
