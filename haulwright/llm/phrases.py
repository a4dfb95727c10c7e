"""Phrase collocations by prefix-free parsing.

Texts are cut into chunks wherever the hash of two neighbouring words says so, so equal
passages give equal chunks whatever surrounds them. Neighbouring chunks share those two
words. Spark counts equal chunks; from then on only the dictionary of distinct chunks with
their parse frequencies is read. A phrase of up to three words belongs to the one chunk in
which it ends behind the shared words, so overlaps are counted once.

Counts are exact and found in two readings of the dictionary: the first adds up saturated
counts of hashes, which rules out nearly all phrases below the least count; the second counts
the rest by their words.

Null texts are empty, a null language is `und`; blank texts have no words. Repeated rows count
as often as they occur. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulwright.llm.common import mapped, mixed, partitions, steps, stored, table

LONGEST = 3
#: Words that neighbouring chunks share.
SHARED = LONGEST - 1
#: A chunk ends at one in so many places on average.
EVERY = 48
#: Hashes that one bucket of the first count takes on average, and bits of a hash inside its bucket.
BUCKET_WORDS, LOW_BITS = 1 << 19, 32
#: Bits of the field of frequent hashes at most (16 MB); beyond, more phrases are counted by their words.
MOST_BITS = 1 << 27

_SPACE, _BREAK = 32, 10
# Bytes between words, and those that end a piece.
_BLANKS, _ENDS = b" \t", b".,;:!?\n\x0b\x0c\r"
_KIND = np.zeros(256, np.uint8)
_KIND[list(_BLANKS)], _KIND[list(_ENDS)] = 1, 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TABLE = mixed(np.arange(1, 64 * 256 + 1, dtype=np.uint64)).reshape(64, 256)


class Words:
    """Words of a byte string in order, each followed by a space or the end of a piece."""

    def __init__(self, raw: bytes):
        """raw: any bytes that end in one that is part of no word."""
        data = np.frombuffer(raw, np.uint8)
        kind = _KIND[data]
        inside = kind == 0
        edge = np.diff(inside.astype(np.int8), prepend=np.int8(0))
        self.at = np.flatnonzero(edge == 1)
        ends = np.flatnonzero(edge == -1)
        self.sizes = ends - self.at
        broken = np.cumsum(kind == 2)
        following = np.append(self.at[1:], len(data))
        #: Whether a piece ends behind each word.
        self.ends_piece = broken[following - 1] > broken[ends - 1]
        lower = _LOWER[data]
        lower[ends] = np.where(self.ends_piece, _BREAK, _SPACE)
        inside[ends] = True
        #: Lower-cased words with one byte behind each, and where they start.
        self.text = lower[inside]
        self.starts = np.cumsum(self.sizes + 1) - self.sizes - 1

    def __len__(self) -> int:
        return len(self.at)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        if not len(self):
            return np.zeros(0, np.uint64)
        sizes = self.sizes + 1
        place = np.arange(len(self.text), dtype=np.int32) - np.repeat(self.starts.astype(np.int32), sizes)
        values = _TABLE[place & 63, self.text]
        if sizes.max() > 64:
            values *= ((place >> 6).astype(np.uint64) << np.uint64(1)) + np.uint64(1)
        values[self.starts + self.sizes] = 0
        return mixed(np.add.reduceat(values, self.starts))

    def spans(self, first: np.ndarray, last: np.ndarray) -> pa.Array:
        """The text from each first word to each last one."""
        starts = self.starts[first]
        sizes = self.starts[last] + self.sizes[last] - starts
        offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        place = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(self.text[place])]
        )


def _joined(column: pa.Array) -> tuple[bytes, np.ndarray]:
    """All values with a line end behind each, and where each one starts."""
    values = [v or b"" for v in column.cast(pa.large_binary()).to_pylist()]
    sizes = np.fromiter(map(len, values), np.int64, len(values)) + 1
    return b"\n".join(values) + b"\n", np.cumsum(sizes) - sizes


def chunks(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The dictionary: lang, skip (words of the chunk before), chunk, own (words that count), parse frequency."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, text):
            raw, starts = _joined(batch.column(text))
            words = Words(raw)
            if not len(words):
                continue
            row = np.searchsorted(starts, words.at, "right") - 1
            opens = np.append(True, row[1:] != row[:-1])
            hashed = words.hashes()
            pair = mixed(hashed + np.roll(hashed, 1) * np.uint64(3))
            # The two words of a cut belong to one text, so a chunk behind a cut has words of its own.
            stops = (pair % np.uint64(EVERY) == 0) & ~opens
            closes = np.append(opens[1:], True)
            last = np.flatnonzero(stops | closes)
            before = np.append(-1, last[:-1])
            fresh = opens[np.minimum(before + 1, len(words) - 1)]
            skip = np.where(fresh, 0, SHARED)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(lang).take(pa.array(row[last])),
                    pa.array(skip.astype(np.int32)),
                    words.spans(before + 1 - skip, last).cast(pa.binary()),
                    pa.array((last - before).astype(np.int32)),
                ],
                ["lang", "skip", "chunk", "own"],
            )

    rows = docs.select(F.col(text), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias(lang))
    found = rows.transform(mapped, cut, "lang string, skip int, chunk binary, own int")
    return found.groupBy("lang", "skip", "chunk", "own").agg(F.count("*").alias("freq"))


class _Grams:
    """Phrases of some chunks: for each number of words the places where they end, and hashes."""

    def __init__(self, batch: pa.RecordBatch):
        raw, starts = _joined(batch.column("chunk"))
        self.words = Words(raw)
        row = np.searchsorted(starts, self.words.at, "right") - 1
        self.row = row
        first = np.searchsorted(row, np.arange(batch.num_rows), "left")
        inside = np.arange(len(row)) - first[row]
        self.owned = inside >= batch.column("skip").to_numpy()[row]
        # How many words before each one lie in its chunk and piece.
        self.cut = np.append(True, (row[1:] != row[:-1]) | self.words.ends_piece[:-1])[: len(row)]
        self.salt = batch.column("salt").to_numpy().astype(np.uint64)[row]
        self.freq = batch.column("freq").to_numpy()[row]

    def places(self, n: int) -> np.ndarray:
        ok = self.owned.copy()
        for k in range(n - 1):
            ok[: k + 1] = False
            ok[k + 1 :] &= ~self.cut[1 : len(ok) - k]
        return np.flatnonzero(ok)

    def keys(self, n: int, at: np.ndarray, hashed: np.ndarray) -> np.ndarray:
        value = self.salt[at] + np.uint64(n)
        for k in range(n - 1, -1, -1):
            value = mixed(value * np.uint64(0x9E3779B97F4A7C15) + hashed[at - k])
        return value


def _short(keys: np.ndarray, bits: int) -> np.ndarray:
    return keys >> np.uint64(64 - LOW_BITS - bits)


def frequent_hashes(dictionary: DataFrame, least: int, bits: int) -> DataFrame:
    """Short hashes (key) of all phrases whose saturated counts reach `least`, at most 15."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = np.uint64((1 << LOW_BITS) - 1)
        for batch in steps(batches, "chunk"):
            grams = _Grams(batch)
            hashed = grams.words.hashes()
            few = np.minimum(grams.freq, least).astype(np.uint64)
            for n in range(1, LONGEST + 1):
                at = grams.places(n)
                if not len(at):
                    continue
                # Hash above, saturated count in the lowest four bits: one plain sort brings equal ones together.
                both = np.sort((_short(grams.keys(n, at, hashed), bits) << np.uint64(4)) | few[at])
                keys, counts = _summed(both, least)
                bucket = (keys >> np.uint64(LOW_BITS)).astype(np.int64)
                edges = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
                lows, ends = (keys & low).astype(np.uint32), np.append(edges[1:], len(keys))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(bucket[edges] * LONGEST + n - 1),
                        pa.array([lows[a:b].tobytes() for a, b in zip(edges, ends, strict=True)], pa.binary()),
                        pa.array([counts[a:b].tobytes() for a, b in zip(edges, ends, strict=True)], pa.binary()),
                    ],
                    ["bucket", "lows", "counts"],
                )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, current, size = [], None, 0

        def packed() -> np.ndarray:
            return np.sort(np.concatenate(kept))

        def result(bucket: int, both: np.ndarray) -> pa.RecordBatch:
            keys, counts = _summed(both, least)
            keys = keys[counts >= least] | np.uint64((bucket // LONGEST) << LOW_BITS)
            return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64))], ["key"])

        for batch in batches:
            for bucket, lows, counts in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if bucket != current:
                    if kept:
                        yield result(current, packed())
                    kept, current, size = [], bucket, 0
                own = (np.frombuffer(lows, np.uint32).astype(np.uint64) << np.uint64(4)) | np.frombuffer(counts, np.uint8)
                kept.append(own)
                size += len(own)
                if size > 1 << 22:  # what a bucket holds is bounded by its distinct hashes
                    keys, sums = _summed(packed(), least)
                    kept = [(keys << np.uint64(4)) | sums]
                    size = 0
        if kept:
            yield result(current, packed())

    rows = dictionary.select("skip", "chunk", "freq", F.xxhash64("lang").alias("salt"))
    parted = rows.transform(mapped, count, "bucket long, lows binary, counts binary")
    parts = parted.repartition(partitions(rows.sparkSession), "bucket").sortWithinPartitions("bucket")
    return parts.transform(mapped, merge, "key long")


def _summed(both: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and saturated counts of sorted values with the count in their lowest four bits."""
    keys = both >> np.uint64(4)
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    if not len(first):
        return keys, np.zeros(0, np.uint8)
    counts = np.add.reduceat((both & np.uint64(15)).astype(np.int64), first)
    return keys[first], np.minimum(counts, least).astype(np.uint8)


class _Field:
    """A bit field over short hashes, of bounded size, as a broadcast array."""

    def __init__(self, keys: DataFrame):
        count = keys.agg(F.approx_count_distinct("key")).first()[0]
        bits = min(MOST_BITS, 1 << max(10, (16 * count).bit_length()))

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = np.zeros(bits // 8, np.uint8)
            for batch in batches:
                at = _Field.at(batch.column("key").to_numpy().astype(np.uint64), bits)
                np.bitwise_or.at(held, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
            words = held.view(np.int64)
            some = np.flatnonzero(words)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(words[some])], ["word", "held"])

        found = keys.transform(mapped, place, "word long, held long").groupBy("word").agg(F.bit_or("held").alias("held"))
        rows = found.toArrow()
        words = np.zeros(bits // 64, np.int64)
        words[rows.column("word").to_numpy()] = rows.column("held").to_numpy()
        self.bits = bits
        self.shared = keys.sparkSession.sparkContext.broadcast(words.view(np.uint8))

    @staticmethod
    def at(keys: np.ndarray, bits: int) -> np.ndarray:
        return mixed(keys) % np.uint64(bits)


def phrase_counts(dictionary: DataFrame, least: int) -> DataFrame:
    """lang, phrase (binary), n_words and exact count f of all phrases that occur `least` times (2 to 15) or more."""
    if not 2 <= least <= 15:
        raise ValueError("least must be from 2 to 15")
    total = dictionary.agg(F.sum("own")).first()[0] or 0
    bits = max(4, (total // BUCKET_WORDS).bit_length())
    spark = dictionary.sparkSession
    field = _Field(stored(frequent_hashes(dictionary, least, bits), "hashes"))
    shared, size = field.shared, field.bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in steps(batches, "chunk"):
            grams = _Grams(batch)
            words, hashed = grams.words, grams.words.hashes()
            if not len(words):
                continue
            every = np.arange(len(words))
            ids = words.spans(every, every).dictionary_encode().indices.to_numpy().astype(np.int64)
            salt = np.unique(grams.salt, return_inverse=True)[1]
            for n in range(1, LONGEST + 1):
                at = grams.places(n)
                spot = _Field.at(_short(grams.keys(n, at, hashed), bits), size)
                at = at[(held[spot >> np.uint64(3)] >> (spot & np.uint64(7)).astype(np.uint8)) & 1 == 1]
                if not len(at):
                    continue
                # The words themselves tell phrases apart, and so do the languages.
                key = salt[at]
                for k in range(n - 1, -1, -1):
                    key = np.unique(key * (int(ids.max()) + 1) + ids[at - k], return_inverse=True)[1]
                sums = np.zeros(int(key.max()) + 1, np.int64)
                np.add.at(sums, key, grams.freq[at])
                some = np.zeros(len(sums), np.int64)
                some[key] = at
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("lang").take(pa.array(grams.row[some])),
                        words.spans(some - n + 1, some).cast(pa.binary()),
                        pa.array(np.full(len(some), n, np.int32)),
                        pa.array(sums),
                    ],
                    ["lang", "phrase", "n_words", "f"],
                )

    rows = dictionary.select("lang", "skip", "chunk", "freq", F.xxhash64("lang").alias("salt"))
    found = rows.transform(mapped, count, "lang string, phrase binary, n_words int, f long")
    return found.groupBy("lang", "phrase", "n_words").agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def _big(name: str):
    return F.col(name).cast("decimal(38,0)")


def collocations(docs: DataFrame, least: int = 10, most: int = 2000, covered: int = 50, text: str = "text", lang: str = "lang") -> DataFrame:
    """The best phrases of two and three words by language: lang, rank, phrase, a, l, r, n, score.

    A phrase occurs `least` times or more; one that lies in a longer one with `covered`
    percent of its occurrences or more is left out. Of the ways to cut it in two the one
    that scores least counts. `most` is the length of a language's list.
    """
    dictionary = stored(chunks(docs, text, lang), "parse")
    counts = stored(phrase_counts(dictionary, least), "phrases")
    n = dictionary.groupBy("lang").agg(F.sum(F.col("own") * F.col("freq")).alias("n"))

    spaces = F.split(F.col("phrase").cast("string"), " ")
    part = lambda a, k: F.array_join(F.slice(F.col("_w"), a, k), " ").cast("binary")
    whole = counts.where("n_words > 1").withColumn("_w", spaces)
    cuts = whole.select(
        "lang", "phrase", "n_words", F.col("f").alias("a"), F.explode(F.expr("sequence(1, n_words - 1)")).alias("k"), "_w"
    ).withColumns({"_left": part(1, F.col("k")), "_right": part(F.col("k") + 1, F.col("n_words") - F.col("k"))}).drop("_w")
    known = lambda side, name: counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name))
    both = cuts.join(known("_left", "l"), ["lang", "_left"]).join(known("_right", "r"), ["lang", "_right"])
    exact = F.expr("cast(cast(1000000 AS decimal(38,0)) * _a * _a AS decimal(38,0)) div cast(_l * _r AS decimal(38,0))")
    scored = both.withColumns({"_a": _big("a"), "_l": _big("l"), "_r": _big("r")}).withColumn("score", exact)
    best = scored.groupBy("lang", "phrase", "n_words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    longer = whole.where(f"n_words = {LONGEST}").select("lang", "f", F.explode(F.array(part(1, F.lit(2)), part(2, F.lit(2)))).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("f").alias("_longer")).withColumn("n_words", F.lit(2))
    kept = best.join(longer, ["lang", "phrase", "n_words"], "left").where(F.expr(f"_longer is null or 100 * _longer < {covered} * a"))
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")))
    top = ranked.where(F.col("rank") <= most).join(n, "lang")
    return top.select(
        "lang", F.col("rank").cast("long").alias("rank"), F.col("phrase").cast("string").alias("phrase"),
        "a", "cut.l", "cut.r", "n", F.col("cut.score").cast("long").alias("score"),
    )


def op12_phrase_collocations(spark, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))


#: The same by words, positions and joins.
ORACLE = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, doc_id, rn, unnest(range(1, len(cut) + 1)) AS p, unnest(cut) AS piece FROM (
        SELECT lang, doc_id, row_number() OVER () AS rn, regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS cut
        FROM documents)),
words AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda w: w <> '') AS w FROM pieces),
grams AS (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
    FROM words, (SELECT unnest([1, 2, 3]) AS k)),
counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1 AND f >= 10),
cuts AS (
    SELECT c.lang, c.k, c.phrase, c.a, c.w, j, l.f AS l, r.f AS r,
        CAST((1000000::HUGEINT * c.a * c.a) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
    FROM (SELECT *, unnest(range(1, k)) AS j FROM candidates) c
    JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:j], ' ')
    JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[j + 1:c.k], ' ')),
least AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
longer AS (
    SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a FROM candidates WHERE k = 3),
kept AS (
    SELECT * FROM least c WHERE k = 3 OR NOT EXISTS (
        SELECT 1 FROM longer x WHERE x.lang = c.lang AND x.phrase = c.phrase AND 100 * x.a >= 50 * c.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
