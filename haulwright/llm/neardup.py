"""Near-duplicates by a chosen-path set similarity join.

Documents are sets of word shingles. Equal sets are one class. In each of some
independent trees a class chooses minwise tokens of its set: two at the first
level, one at each level below, and goes to the nodes that these paths name.
Nodes of bounded size are compared exhaustively by sketches of minima; larger ones
branch on, and those still large at the last level are taken whole. There are so
many trees that a link at the threshold is met in one of them with a stated
probability even if its nodes get small at the last level only. Whatever a
node relates falls into one cluster, with a wide margin below the threshold, and
within clusters links are confirmed on the full sets. Only links between
documents not yet connected are looked for, so copies never become all pairs.

A cluster too large for a task is confirmed in blocks: twice in blocks
drawn by different hashes, then every document outside the cluster's largest
component against all blocks. That leaves no pair of different components
uncompared.

Null and empty texts and those without words have an empty set and are linked
with nothing. Rows that repeat a doc_id are one document. A row
without doc_id is kept and linked with nothing. Sets hold 64-bit hashes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulwright.llm.common import Filter, key_groups, mapped, mixed, partitions, steps, stored, table, texts_of
from haulwright.llm.graph import components


@dataclass(frozen=True)
class Join:
    """Parameters: similar if 100 * intersection >= percent * union."""

    words: int = 5
    percent: int = 80
    missed: float = 0.001  # largest probability that a link at the threshold meets in no node compared or taken whole
    depth: int = 4
    node: int = 400  # members that are compared exhaustively
    margin: float = 0.2  # sketches may underestimate by so much
    block_tokens: int = 4_000_000  # hashes that a task holds while confirming
    bins: int = 128

    @property
    def trees(self) -> int:
        """Trees for that recall where nodes get small at the last level: the pair agrees on the path with at least `met`."""
        alike = self.percent / 100
        met = alike * (2 - alike) * alike ** (self.depth - 1)  # two tokens at the first level, one at each below
        return math.ceil(math.log(self.missed) / math.log1p(-met)) if met < 1 else 1


_WORD_SEED, _TREE_SEED, _BIN_SEED = (np.uint64(s) for s in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7))


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text (A-Z lower-cased, words between ASCII white space)."""
    split = [t.encode("utf-8", "surrogatepass").lower().split() for t in texts]
    lengths = np.fromiter(map(len, split), np.int64, len(split))
    flat = np.empty(int(lengths.sum()), object)
    flat[:] = [w for s in split for w in s]
    hashed = pd.util.hash_array(flat, categorize=False) if len(flat) else np.zeros(0, np.uint64)
    size = max(0, len(hashed) - words + 1)
    rolled = hashed[:size].copy()
    for k in range(1, words):
        rolled = mixed(rolled + _WORD_SEED) + hashed[k : size + k]
    rolled = mixed(rolled)
    sets, start = [], 0
    for n in lengths.tolist():
        if n >= words:
            sets.append(np.unique(rolled[start : start + n - words + 1]))
        elif n:
            whole = np.zeros(1, np.uint64)
            for h in hashed[start : start + n]:
                whole = mixed(whole + _WORD_SEED + h)
            sets.append(whole + np.uint64(n))
        else:
            sets.append(np.zeros(0, np.uint64))
        start += n
    return sets


def chosen_tokens(tokens: np.ndarray, how: Join) -> np.ndarray:
    """One row for each tree: two tokens of the first level (equal ones if the set has one), one of each below."""
    count = how.trees * how.depth
    seeds = mixed(np.arange(1, count + 1, dtype=np.uint64) * _TREE_SEED)
    values = mixed(tokens[None, :] ^ seeds[:, None]).reshape(how.trees, how.depth, -1)
    first = np.sort(np.partition(values[:, 0], min(1, len(tokens) - 1), axis=1)[:, :2], axis=1)
    first = np.repeat(first, 2, axis=1) if first.shape[1] == 1 else first
    return np.concatenate([first, values[:, 1:].min(axis=2)], axis=1).astype(np.int64)


def sketch(tokens: np.ndarray, bins: int) -> np.ndarray:
    """Minimum of each bin of a set's hashes, 16 bits; 65535 for an empty bin."""
    values = mixed(tokens ^ _BIN_SEED)
    least = np.full(bins, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, (values % np.uint64(bins)).astype(np.int64), values >> np.uint64(8))
    low = (least & np.uint64(0xFFFF)).astype(np.uint16)
    low[low == 65535] = 65534
    low[least == np.iinfo(np.uint64).max] = 65535
    return low


def describe(docs: DataFrame, how: Join, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, print (of the whole set), chosen tokens and sketch of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, text):
            sets = shingle_sets(texts_of(batch.column(text)), how.words)
            full = [s if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(key).cast(pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([s is not None and hashlib.blake2b(s.tobytes(), digest_size=16).digest() or None for s in full], pa.binary()),
                    pa.array([None if s is None else chosen_tokens(s, how).ravel() for s in full], pa.list_(pa.int64())),
                    pa.array([None if s is None else sketch(s, how.bins).tobytes() for s in full], pa.binary()),
                ],
                names,
            )

    names = ["doc_id", "n_shingles", "print", "chosen", "bins"]
    return docs.select(key, text).transform(mapped, run, "doc_id long, n_shingles long, print binary, chosen array<long>, bins binary")


def _paths(classes: DataFrame, how: Join) -> DataFrame:
    """node, doc_id and the tokens below of each class at the first level."""
    width = how.depth + 1
    trees = F.transform(F.sequence(F.lit(0), F.lit(how.trees - 1)), lambda t: F.struct(t.alias("tree"), F.slice("chosen", t * width + 1, width).alias("own")))
    rows = classes.select("doc_id", F.explode(trees).alias("t"))
    below = F.slice("t.own", 3, how.depth - 1).alias("below")
    first = F.array_distinct(F.slice("t.own", 1, 2))
    return rows.select("doc_id", F.col("t.tree").alias("tree"), below, F.explode(first).alias("token")).select(
        F.xxhash64("tree", "token").alias("node"), "doc_id", "below"
    )


def nodes_of(classes: DataFrame, how: Join) -> tuple[DataFrame, DataFrame]:
    """Members (node, doc_id) of nodes to be compared, and pairs (a, b) of nodes that stay large."""
    rows = _paths(classes, how)
    small: list[DataFrame] = []
    for level in range(how.depth):
        sizes = rows.groupBy("node").agg(F.count("*").alias("n"), F.min("doc_id").alias("least")).where("n > 1")
        rows = stored(rows.join(sizes, "node"), "nodes")
        small.append(rows.where(F.col("n") <= how.node).select("node", "doc_id"))
        rows = rows.where(F.col("n") > how.node)
        if level < how.depth - 1:
            if rows.isEmpty():
                break
            rows = rows.select(F.xxhash64("node", F.col("below")[level]).alias("node"), "doc_id", "below")
    members = small[0]
    for more in small[1:]:
        members = members.unionByName(more)
    whole = rows.select(F.col("doc_id").alias("a"), F.col("least").alias("b")) if level == how.depth - 1 else None
    return members, whole


def _grow(count: int, alike, known: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect the members of a group: alike(member, others) says which of the others are similar.

    Members are visited component by component; a member is compared with those no link has reached yet.
    known: numbers of components that are connected already.
    """
    links: list[tuple[int, int]] = []
    waiting = np.arange(count)
    while len(waiting):
        seed = waiting[:1] if known is None else waiting[known[waiting] == known[waiting[0]]]
        queue = list(seed)
        waiting = np.setdiff1d(waiting, seed, assume_unique=True)
        while queue and len(waiting):
            member = queue.pop()
            hits = waiting[alike(member, waiting)]
            if len(hits):
                links += [(int(member), int(h)) for h in hits]
                reached = hits if known is None else waiting[np.isin(known[waiting], known[hits])]
                queue += list(reached)
                waiting = np.setdiff1d(waiting, reached, assume_unique=True)
    return links


def related(members: DataFrame, how: Join) -> DataFrame:
    """Pairs (a, b) that connect the members of each node whose sketches are similar, for (node, doc_id, n_shingles, bins)."""
    least = how.percent / 100 - how.margin

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in key_groups(batches, "node"):
            ids = group.column("doc_id").to_numpy()
            if len(ids) < 2:
                continue
            n = group.column("n_shingles").to_numpy()
            bins = np.frombuffer(b"".join(group.column("bins").to_pylist()), np.uint16).reshape(len(ids), -1)
            filled = bins != 65535

            def alike(x, others):
                rows = bins[others]
                same = ((rows == bins[x]) & filled[x]).sum(axis=1)
                either = (filled[others] | filled[x]).sum(axis=1)
                sizes = 100 * np.minimum(n[others], n[x]) >= how.percent * np.maximum(n[others], n[x])
                return sizes & (same >= least * either)

            links = _grow(len(ids), alike)
            if links:
                a, b = zip(*links, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(ids[list(a)]), pa.array(ids[list(b)])], ["a", "b"])

    spark = members.sparkSession
    dealt = members.repartition(4 * partitions(spark), "node").sortWithinPartitions("node")
    return dealt.transform(mapped, run, "a long, b long")


class Sets:
    """Sets of a group as rows of small numbers, for many intersections with one of them."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        self.starts = np.r_[0, np.cumsum(self.sizes)]
        self.names, self.flat = np.unique(np.concatenate(sets), return_inverse=True)
        self.flat = self.flat.astype(np.int32)
        self.mark = np.zeros(len(self.names), bool)
        self.percent = percent
        self.held: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None  # others, their tokens and starts

    def own(self, member: int) -> np.ndarray:
        return self.flat[self.starts[member] : self.starts[member + 1]]

    def alike(self, member: int, others: np.ndarray) -> np.ndarray:
        return self.similar(self.own(member), int(self.sizes[member]), others)

    def similar(self, tokens: np.ndarray, size: int, others: np.ndarray) -> np.ndarray:
        """Which others are similar to a set of so many tokens, of which some are known here."""
        if self.held is None or 2 * len(others) < len(self.held[0]) or not np.isin(others, self.held[0], assume_unique=True).all():
            parts = np.concatenate([self.own(o) for o in others])
            self.held = (others, parts, np.r_[0, np.cumsum(self.sizes[others])[:-1]])
        pool, parts, starts = self.held
        self.mark[tokens] = True
        common = np.add.reduceat(self.mark[parts], starts, dtype=np.int64)
        self.mark[tokens] = False
        if len(pool) != len(others):
            common = common[np.searchsorted(pool, others)]
        return 100 * common >= self.percent * (size + self.sizes[others] - common)


def _link_schema() -> tuple[str, list[str]]:
    return "a long, b long", ["a", "b"]


def confirmed(sets: DataFrame, how: Join) -> DataFrame:
    """Links (a, b) that connect each group's similar sets, for (group, doc_id, known, tokens)."""
    schema, names = _link_schema()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in key_groups(batches, "group"):
            if group.num_rows < 2:
                continue
            ids = group.column("doc_id").to_numpy()
            known = np.unique(group.column("known").to_numpy(), return_inverse=True)[1]
            own = Sets([np.frombuffer(t, np.uint64) for t in group.column("tokens").to_pylist()], how.percent)
            links = _grow(len(ids), own.alike, known if known.max() < len(ids) - 1 else None)
            if links:
                a, b = zip(*links, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(ids[list(a)]), pa.array(ids[list(b)])], names)

    spark = sets.sparkSession
    dealt = sets.select("group", "doc_id", "known", "tokens").repartition(4 * partitions(spark), "group")
    return dealt.sortWithinPartitions("group").transform(mapped, run, schema)


def confirmed_outside(sets: DataFrame, how: Join) -> DataFrame:
    """Links of streamed sets (asks = 1) with a group's held ones (asks = 0) of another component."""
    schema, names = _link_schema()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, kept, own, ids, known = None, [], None, None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["group"] != group:
                    group, kept, own = row["group"], [], None
                if not row["asks"]:
                    kept.append(row)
                    continue
                if not kept:
                    continue
                if own is None:
                    own = Sets([np.frombuffer(r["tokens"], np.uint64) for r in kept], how.percent)
                    ids = np.array([r["doc_id"] for r in kept])
                    known = np.array([r["known"] for r in kept])
                others = np.flatnonzero(known != row["known"])
                if len(others):
                    tokens = np.frombuffer(row["tokens"], np.uint64)
                    at = np.searchsorted(own.names, tokens)
                    at = at[(at < len(own.names)) & (own.names[np.minimum(at, len(own.names) - 1)] == tokens)]
                    hits = others[own.similar(at, len(tokens), others)]
                    if len(hits):
                        yield pa.RecordBatch.from_arrays([pa.array([row["doc_id"]] * len(hits), pa.int64()), pa.array(ids[hits], pa.int64())], names)

    dealt = sets.repartition(4 * partitions(sets.sparkSession), "group").sortWithinPartitions("group", "asks")
    return dealt.transform(mapped, run, schema)


def _sets_of(docs: DataFrame, members: DataFrame, how: Join, key: str, text: str) -> DataFrame:
    """cluster, doc_id, blocks and tokens of the members, whose texts are read again.

    Only texts that may be members' come along: their sets are shuffled, no text is.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows, _ = Filter(members.select(F.col("doc_id").alias("key"))).split(rows, F.col("doc_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            sets = [s.tobytes() for s in shingle_sets(texts_of(batch.column("text")), how.words)]
            prints = [hashlib.blake2b(s, digest_size=16).digest() for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(prints, pa.binary()), pa.array(sets, pa.binary())],
                ["doc_id", "print", "tokens"],
            )

    sets = rows.transform(mapped, run, "doc_id long, print binary, tokens binary")
    # No broadcast: the members grow with the documents.
    wanted = members.select("doc_id", "cluster", "blocks", "print").hint("merge")
    found = sets.join(wanted, ["doc_id", "print"])
    return found.select("cluster", "doc_id", "blocks", "tokens")


def near_duplicates(docs: DataFrame, how: Join = Join(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row."""
    described = stored(describe(docs, how, key, text), "described")
    filled = described.where(F.col("doc_id").isNotNull() & F.col("print").isNotNull())
    first = F.min_by(F.struct("doc_id", "n_shingles", "chosen", "bins"), "doc_id").alias("first")
    classes = filled.groupBy("print").agg(first, F.count("*").alias("copies")).select("print", "copies", "first.*")
    classes = stored(classes, "classes")

    members, whole = nodes_of(classes, how)
    shapes = classes.select("doc_id", "n_shingles", "bins")
    pairs = related(members.join(shapes, "doc_id"), how)
    clusters = components(pairs if whole is None else pairs.unionByName(whole))
    roots = clusters.select(F.col("root").alias("doc_id"), F.col("root").alias("cluster")).distinct()
    clustered = clusters.select(F.col("node").alias("doc_id"), F.col("root").alias("cluster")).unionByName(roots)
    clustered = clustered.join(classes.select("doc_id", "n_shingles", "print"), "doc_id")
    totals = clustered.groupBy("cluster").agg(F.ceil(F.sum("n_shingles") / how.block_tokens).cast("long").alias("blocks"))
    clustered = stored(clustered.join(totals, "cluster"), "clustered")
    sets = _sets_of(docs, clustered, how, key, text)
    links = _links(stored(sets, "sets"), how)
    found = components(links)

    copies = classes.where("copies > 1").select("print", F.col("doc_id").alias("first"))
    out = described.select("doc_id", "n_shingles", "print").join(copies, "print", "left")
    out = out.withColumn("first", F.coalesce("first", "doc_id"))
    out = out.join(found.select(F.col("node").alias("first"), "root"), "first", "left")
    out = out.withColumn("component_id", F.coalesce("root", "first"))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")
    return out.select("doc_id", "n_shingles", "component_id", kept)


def _links(sets: DataFrame, how: Join) -> DataFrame:
    """Confirmed links within clusters, in blocks where a cluster exceeds what a task may hold."""
    one = sets.where("blocks = 1").select(F.col("cluster").alias("group"), "doc_id", F.col("doc_id").alias("known"), "tokens")
    links = confirmed(one, how)
    large = sets.where("blocks > 1")
    if large.isEmpty():
        return links
    known = large.withColumn("known", F.col("doc_id"))
    found = None
    for turn in range(2):
        block = F.pmod(F.xxhash64("doc_id", F.lit(turn)), "blocks")
        dealt = known.withColumn("group", F.xxhash64("cluster", block, F.lit(turn)))
        more = confirmed(dealt, how)
        found = more if found is None else found.unionByName(more)
        found = stored(found, "links")
        roots = components(found).select(F.col("node").alias("doc_id"), "root")
        known = large.join(roots, "doc_id", "left").withColumn("known", F.coalesce("root", "doc_id")).drop("root")
    known = stored(known, "known")
    counts = known.groupBy("cluster", "known").count().groupBy("cluster").agg(F.max_by("known", "count").alias("main"))
    outside = known.join(counts, "cluster").where("known <> main").drop("main")
    held = known.withColumn("block", F.pmod(F.xxhash64("doc_id"), "blocks")).withColumn("asks", F.lit(0))
    asked = outside.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).withColumn("asks", F.lit(1))
    both = held.unionByName(asked).select(F.xxhash64("cluster", "block").alias("group"), "asks", "doc_id", "known", "tokens")
    return links.unionByName(found).unionByName(confirmed_outside(both, how))


def op4_chosen_path(spark, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), Join(words=3, percent=85))


ORACLE = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, [w FOR w IN regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF w <> ''] AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) END AS s
  FROM words
), items AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets),
classes AS (SELECT min(doc_id) AS c, list_sort(s) AS s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY 2, 3),
marks AS (SELECT c, n, unnest(s) AS t FROM classes),
pairs AS (
  SELECT a.c AS a, b.c AS b FROM marks a JOIN marks b ON a.t = b.t AND a.c < b.c
    AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), links AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reach AS (SELECT c AS x, c AS y FROM classes UNION SELECT r.x, l.b FROM reach r JOIN links l ON l.a = r.y),
roots AS (SELECT x AS c, min(y) AS root FROM reach GROUP BY x),
own AS (SELECT d.doc_id, len(d.s) AS n_shingles, c.c FROM sets d LEFT JOIN classes c ON len(d.s) > 0 AND c.s = list_sort(d.s))
SELECT doc_id, n_shingles::BIGINT AS n_shingles, coalesce(root, doc_id) AS component_id,
       doc_id = coalesce(root, doc_id) AS kept
FROM own LEFT JOIN roots USING (c)
"""
