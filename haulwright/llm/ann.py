"""Nearest neighbours by multi-index hashing of learned rotated binary codes.

Codes: a projection on principal axes and a rotation are learned on a bounded
sample (iterative quantisation); a vector's code is the signs of its rotated
projection. A code is cut into substrings, each with an index of its own. Two
codes within r bits agree in one of m substrings up to r // m bits (pigeonhole),
so looking up each substring and its neighbours of so many bits finds every
code within r. Those are reranked by the exact cosine.

The radius is learned on the sample, too: the smallest one that holds the wanted
share of true neighbours. Queries for which fewer than k candidates turn up are
compared with all vectors in blocks afterwards. The index lies in shards of
bounded size; a task holds one shard while the queries stream past, and each
shard gives its best k + 1 for each query. Equal vectors are one entry with
their smallest ids, so copies neither multiply candidates nor fill a bucket,
and no bucket has a cap.

Vectors that are null, zero, of another dimension than most, or that hold null
or non-finite components take no part, as query or as candidate. A row that
repeats both id and vector counts once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from haulwright.llm.common import mapped, partitions, stored, table

#: Entries that rotation and radius are learned on at most; all are indexed.
SAMPLE = 20_000
#: Entries of the index in one shard.
SHARD = 8192


@dataclass(frozen=True)
class Coder:
    """Rotated binary codes: mean, projection with rotation, and the widths of the substrings."""

    mean: np.ndarray
    turn: np.ndarray
    widths: tuple[int, ...]

    def bits(self, vectors: np.ndarray) -> np.ndarray:
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        return (unit - self.mean) @ self.turn > 0

    def parts(self, vectors: np.ndarray) -> np.ndarray:
        """Substring values, one column for each substring."""
        bits = self.bits(vectors)
        out = np.empty((len(bits), len(self.widths)), np.uint8)
        start = 0
        for k, width in enumerate(self.widths):
            out[:, k] = bits[:, start : start + width] @ (1 << np.arange(width))
            start += width
        return out


def learn_coder(sample: np.ndarray, rounds: int = 30, seed: int = 0) -> Coder:
    """Iterative quantisation on a sample: up to 64 bits, in substrings of up to 8."""
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    mean = unit.mean(axis=0)
    centred = unit - mean
    bits = min(64, sample.shape[1])
    axes = np.linalg.eigh(centred.T @ centred)[1][:, ::-1][:, :bits]
    flat = centred @ axes
    turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, bits)))[0]
    for _ in range(rounds):
        left, _, right = np.linalg.svd(np.where(flat @ turn > 0, 1.0, -1.0).T @ flat)
        turn = (left @ right).T
    count = -(-bits // 8)
    widths = tuple(bits // count + (k < bits % count) for k in range(count))
    return Coder(mean, axes @ turn, widths)


def learn_radius(coder: Coder, sample: np.ndarray, k: int, share: float, queries: int = 200) -> int:
    """The smallest radius that holds a share of the true neighbours within the sample."""
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    bits = coder.bits(sample)
    distances = []
    for q in range(min(queries, len(sample))):
        near = unit @ unit[q]
        near[q] = -2
        top = np.argsort(-near, kind="stable")[: min(k, len(sample) - 1)]
        distances += (bits[top] != bits[q]).sum(axis=1).tolist()
    return int(np.quantile(distances, share, method="higher")) if distances else bits.shape[1]


_ONES = np.array([bin(v).count("1") for v in range(256)], np.uint8)


class Index:
    """One shard: entries by substring values, and their vectors."""

    def __init__(self, coder: Coder, vectors: np.ndarray):
        self.coder, self.vectors = coder, vectors
        self.norms = np.linalg.norm(vectors, axis=1)
        self.parts = coder.parts(vectors)
        self.order = [np.argsort(self.parts[:, k], kind="stable") for k in range(len(coder.widths))]
        self.starts = [
            np.searchsorted(self.parts[o, k], np.arange(257)) for k, o in enumerate(self.order)
        ]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Entries whose codes differ from a code in at most radius bits."""
        flips = radius // len(self.coder.widths)
        hit = np.zeros(len(self.parts), bool)
        for k, width in enumerate(self.coder.widths):
            values = code[k] ^ _flipped(width, min(flips, width))
            low, high = self.starts[k][values], self.starts[k][values.astype(np.int64) + 1]
            sizes = high - low
            places = np.repeat(low - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
            hit[self.order[k][places]] = True
        found = np.flatnonzero(hit)
        return found[_ONES[self.parts[found] ^ code].sum(axis=1) <= radius]

    def search(self, query: np.ndarray, radius: int | None, smallest: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best entries and their cosines; ties to the smaller id. Without a radius, of all entries."""
        if radius is None:
            found = np.arange(len(self.vectors))
        else:
            found = self.within(self.coder.parts(query[None, :])[0], radius)
        scores = (self.vectors[found] * query).sum(axis=1) / (self.norms[found] * np.sqrt((query * query).sum()))
        if len(found) > 4 * k:
            cut = np.partition(scores, len(scores) - k)[len(scores) - k]
            found, scores = found[scores >= cut], scores[scores >= cut]
        best = np.lexsort((smallest[found], -scores))[:k]
        return found[best], scores[best]


_masks: dict[tuple[int, int], np.ndarray] = {}


def _flipped(width: int, flips: int) -> np.ndarray:
    """All values of so many bits with at most so many ones."""
    if (width, flips) not in _masks:
        ones = [sum(1 << b for b in c) for n in range(flips + 1) for c in combinations(range(width), n)]
        _masks[width, flips] = np.array(ones, np.uint8)
    return _masks[width, flips]


def usable(vectors: DataFrame, key: str, value: str) -> DataFrame:
    """Rows that take part, once each: key and an array of doubles."""
    v = F.col(value).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = vectors.where(F.col(key).isNotNull() & F.col(value).isNotNull() & F.coalesce(finite, F.lit(False)))
    good = good.select(F.col(key).cast("long").alias("vec_id"), v.alias("vector"))
    good = good.where(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x) > 0)
    sizes = good.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return good.where(F.size("vector") == (sizes[0]["n"] if sizes else 0)).distinct()


def entries(rows: DataFrame, keep: int) -> DataFrame:
    """Distinct vectors with their smallest ids, at most `keep` of them."""
    salted = Window.partitionBy("vector", F.pmod("vec_id", F.lit(64))).orderBy("vec_id")
    few = rows.withColumn("n", F.row_number().over(salted)).where(F.col("n") <= keep)
    return few.groupBy("vector").agg(F.slice(F.sort_array(F.collect_list("vec_id")), 1, keep).alias("ids"))


def _search(index: DataFrame, queries: DataFrame, coder: Coder, radius: int | None, k: int, shards: int) -> DataFrame:
    """Best k entries of each query (entry, vector): query, ids, score; every shard is searched."""
    spark = index.sparkSession
    shared = spark.sparkContext.broadcast((coder, radius))
    held = index.select("shard", F.lit(0).alias("asks"), "entry", "vector", "ids")
    asked = queries.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"),
        F.lit(1).alias("asks"), "entry", "vector", F.lit(None).cast("array<long>").alias("ids"),
    )
    rows = held.unionByName(asked).repartition(max(1, min(shards, 4096)), "shard").sortWithinPartitions("shard", "asks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, within = shared.value
        shard, kept, built = None, [], None
        for batch in batches:
            numbers, asks = batch.column("shard").to_numpy(), batch.column("asks").to_numpy()
            flat = batch.column("vector").flatten().to_numpy()
            vectors = flat.reshape(batch.num_rows, -1) if batch.num_rows else flat
            ids, keys = batch.column("ids"), batch.column("entry").to_numpy()
            out: tuple[list, list, list] = ([], [], [])
            cuts = np.flatnonzero(np.r_[True, (np.diff(numbers) != 0) | (np.diff(asks) != 0)])
            for start, end in zip(cuts, [*cuts[1:], batch.num_rows], strict=True):
                if numbers[start] != shard:
                    shard, kept, built = numbers[start], [], None
                if not asks[start]:
                    kept.append((vectors[start:end], ids.slice(start, end - start).to_pylist()))
                    continue
                if not kept:
                    continue
                if built is None:
                    names = [i for _, part in kept for i in part]
                    built = (Index(own, np.concatenate([v for v, _ in kept])), names, np.array([i[0] for i in names]))
                for row in range(start, end):
                    found, scores = built[0].search(vectors[row], within, built[2], k)
                    out[0].extend([keys[row]] * len(found))
                    out[1].extend(built[1][f] for f in found)
                    out[2].extend(scores.tolist())
            if out[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int64()), pa.array(out[1], pa.list_(pa.int64())), pa.array(out[2])],
                    ["entry", "ids", "score"],
                )

    found = rows.transform(mapped, run, "entry long, ids array<long>, score double")
    best = Window.partitionBy("entry").orderBy(F.desc("score"), F.col("ids")[0])
    return found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k).drop("n")


def nearest_neighbours(
    vectors: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", value: str = "embedding",
    share: float = 0.97, sample: int = SAMPLE, shard: int = SHARD,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row that is a query (a condition on vec_id)."""
    rows = usable(vectors, key, value)
    index = stored(entries(rows, k + 1).withColumn("entry", F.monotonically_increasing_id()), "entries")
    count = index.count()
    shards = max(1, math.ceil(count / shard))
    index = index.withColumn("shard", F.pmod(F.xxhash64("entry"), F.lit(shards)))
    drawn = index.select("vector").sample(min(1.0, 1.2 * sample / max(1, count)), seed=7).limit(sample).toArrow()
    learned = np.array(drawn.column("vector").to_pylist(), float)
    names = ("query_id", "rank", "vec_id", "score")
    if len(learned) < 2:  # too few to learn from: everything is compared
        coder, radius = Coder(np.zeros(1), np.zeros((1, 1)), (1,)), None
        learned = np.array(index.select("vector").limit(1).toArrow().column("vector").to_pylist(), float)
        if len(learned):
            coder = Coder(np.zeros(learned.shape[1]), np.zeros((learned.shape[1], 1)), (1,))
    else:
        coder = learn_coder(learned)
        radius = learn_radius(coder, learned, k, share)
    asked = stored(rows.where(is_query).join(index.select("entry", "vector"), "vector"), "queries")
    wanted = asked.select("entry", "vector").dropDuplicates(["entry"]).repartition(partitions(asked.sparkSession), "entry")
    found = stored(_search(index, wanted, coder, radius, k + 1, shards), "found")
    if radius is not None:
        got = found.groupBy("entry").agg(F.sum(F.size("ids")).alias("n"))
        lacking = wanted.join(got, "entry", "left").where(F.coalesce("n", F.lit(0)) <= k).select("entry", "vector")
        lacking = stored(lacking, "lacking")
        if not lacking.isEmpty():
            exact = _search(index, lacking, coder, None, k + 1, shards)
            found = found.join(lacking.select("entry"), "entry", "left_anti").unionByName(exact)
    pairs = asked.select(F.col("vec_id").alias("query_id"), "entry").join(found, "entry")
    pairs = pairs.select("query_id", F.explode("ids").alias("vec_id"), "score", F.col("entry").alias("_e")).where("vec_id <> query_id")
    order = Window.partitionBy("query_id", "_e").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(*names)


def op3_multi_index_hashing(spark, folder: str) -> DataFrame:
    return nearest_neighbours(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)
