"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Learning takes a sample of labelled rows of bounded size and finds the words that go with the
label most (chi-square), the terms. One reading of all texts gives every row its counts of terms;
document frequencies cover all rows. Sampled rows that hold a term are the examples. Their
postings lie in blocks of similar examples with the largest weight of each term in each block.
A query visits blocks in order of their bounds until the next bound is below its k-th best
cosine, so the neighbours are exact. Neighbours vote by cosine, and a logistic curve fitted
to the votes that examples get without themselves turns votes into probabilities.

A row without terms (null, empty and blank texts are such) gets the share of label 1 among
sampled rows without terms. Without labelled rows every score is 0, without rows of both
labels it is their one label's. Ties between examples go to the smaller number, which follows
their heaviest terms, then their keys. Labels of a repeated key: 1 if any is. Rows with a null
label or key aren't learned from; each row of `docs`, repeated or not, gets a result. Other
columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulwright.llm.common import mapped, steps, stored, table, texts_of
from haulwright.llm.langid import held_out

_WORD = re.compile(r"\w+")
#: Distinct words that one task counts before it hands them on.
_HELD = 300_000
_LONGEST_WORD = 100
#: Results that one task remembers by the counts of terms.
_REMEMBERED = 10_000


@dataclass(frozen=True)
class Settings:
    """Bounds of what is learned from; every other figure covers all rows."""

    most_labels: int = 65_536  # labelled rows that terms are learned from
    most_examples: int = 8_192  # of these, rows with terms that are searched
    most_terms: int = 4_096
    least_rows: int = 4  # sampled rows that hold a term
    least_chi2: float = 10.0  # not by chance
    least_share: float = 0.01  # chi-square by the number of rows: how much of the label a word tells, at any size
    neighbours: int = 25
    block: int = 32
    prior_weight: float = 0.25  # cosine that the share of label 1 votes with


def words(text: str) -> list[str]:
    """Lower-cased runs of letters, digits and underscores, the first 100 characters of each."""
    return [w[:_LONGEST_WORD] for w in _WORD.findall(text.lower())]


def sampled_labels(labels: DataFrame, learnable: Column, key: str, label: str, most: int) -> DataFrame:
    """_key and _label of at most `most` learnable keys, those with the smallest hashes."""
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & learnable)
    known = known.groupBy(F.col(key).alias("_key")).agg(F.max(F.col(label).cast("int")).alias("_label"))
    count = known.count()
    place = F.xxhash64(F.col("_key"))
    if count > most:  # leave most rows out before they are put in order
        share = min(1.0, 1.2 * most / count + 20 / count)
        known = known.where(F.pmod(place, F.lit(1 << 30)) < int(share * (1 << 30)))
    return known.orderBy(F.pmod(place, F.lit(1 << 30)), "_key").limit(most)


def chosen_terms(labelled: DataFrame, cfg: Settings, text: str) -> list[str]:
    """The words that go with label 1 or 0 most; labelled has the text and _label."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[Counter, Counter] = Counter(), Counter()

        def out() -> pa.RecordBatch:
            names = list(held[0] | held[1])
            sides = [pa.array([side[w] for w in names], pa.int64()) for side in held]
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *sides], ["term", "zeros", "ones"])

        for batch in steps(batches, text):
            for t, y in zip(texts_of(batch.column(text)), batch.column("_label").to_pylist(), strict=True):
                held[y == 1].update(set(words(t)))
                held[y == 1][""] += 1  # rows of the label
                if len(held[0]) + len(held[1]) > _HELD:
                    yield out()
                    held = Counter(), Counter()
        yield out()

    found = labelled.select(text, "_label").transform(mapped, count, "term string, zeros long, ones long")
    sums = stored(found.groupBy("term").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones")), "terms")
    rows = sums.where("term = ''").first()
    if rows is None:
        return []
    n0, n1 = float(rows.zeros), float(rows.ones)
    if not n0 or not n1:
        return []
    a, b = F.col("ones").cast("double"), F.col("zeros").cast("double")
    gap = a * (n0 - b) - b * (n1 - a)
    chi2 = F.try_divide((n0 + n1) * gap * gap, n0 * n1 * (a + b) * (n0 + n1 - a - b))
    best = sums.where((F.col("term") != "") & (a + b >= cfg.least_rows) & (a + b < n0 + n1)).withColumn("chi2", chi2)
    least = max(cfg.least_chi2, cfg.least_share * (n0 + n1))
    best = best.where(F.col("chi2") >= least).orderBy(F.desc("chi2"), "term").limit(cfg.most_terms)
    return sorted(r.term for r in best.select("term").collect())


def term_counts(docs: DataFrame, terms: list[str], text: str = "text") -> DataFrame:
    """docs without its text, with terms (their numbers, ascending) and counts (how often each occurs)."""
    shared = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(terms)})
    rest = docs.drop(text)
    names = rest.columns
    schema = T.StructType([*rest.schema, *(T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("terms", "counts"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in steps(batches, text):
            held = [sorted(Counter(known[w] for w in words(t) if w in known).items()) for t in texts_of(batch.column(text))]
            lists = [pa.array([[p[k] for p in one] for one in held], pa.list_(pa.int32())) for k in (0, 1)]
            others = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*others, *lists], [*names, "terms", "counts"])

    return docs.select(*names, text).transform(mapped, run, schema)


def weighted(terms: list[int], counts: list[int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terms and their TF-IDF weights as a vector of length 1; nothing for a vector of zeros."""
    at = np.asarray(terms, np.int64)
    values = (1.0 + np.log(np.asarray(counts, float))) * idf[at]
    norm = np.sqrt((values * values).sum())
    return (at, values / norm) if norm > 0 else (at[:0], values[:0])


class BlockMax:
    """Postings by term and block of examples, with the largest weight in each."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], terms: int, block: int):
        self.block, self.blocks = block, -(-len(vectors) // block)
        term = np.concatenate([v[0] for v in vectors] or [np.zeros(0, np.int64)])
        weight = np.concatenate([v[1] for v in vectors] or [np.zeros(0)])
        example = np.repeat(np.arange(len(vectors)), [len(v[0]) for v in vectors])
        order = np.lexsort((example, term))
        term, self.example, self.weight = term[order], example[order], weight[order]
        pair = term * max(1, self.blocks) + self.example // block
        #: Where the postings of each (term, block) start, its block and largest weight.
        self.starts = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])[: len(pair)])
        self.ends = np.append(self.starts[1:], len(pair))
        self.of_block = self.example[self.starts] // block
        self.largest = np.maximum.reduceat(self.weight, self.starts) if len(pair) else self.weight
        self.first = np.searchsorted(term[self.starts], np.arange(terms + 1))

    def nearest(self, at: np.ndarray, values: np.ndarray, k: int, leave: int = -1) -> tuple[np.ndarray, np.ndarray, int]:
        """Examples with the k largest cosines above 0, those cosines, and how many blocks were visited.

        The blocks with the largest bounds are visited first, then all others whose bounds reach
        the k-th best cosine found in them.
        """
        lists, owner = _ranges(self.first[at], self.first[at + 1])
        factor, of_block = values[owner], self.of_block[lists]
        bound = np.bincount(of_block, factor * self.largest[lists], self.blocks)
        order = np.argsort(-bound, kind="stable")
        order = order[: np.count_nonzero(bound)]
        leading = max(1, 2 * k // self.block)
        visited = np.zeros(self.blocks + 1, bool)
        visited[order[:leading]] = True
        names, cosines = self._visit(lists, factor, visited[of_block], leave)
        seen = min(leading, len(order))
        if len(order) > leading:
            least = np.partition(cosines, -k)[-k] if len(cosines) >= k else 0.0
            rest = order[leading:]
            rest = rest[bound[rest] >= least * (1 - 1e-12)]
            if len(rest):
                visited[:] = False
                visited[rest] = True
                more = self._visit(lists, factor, visited[of_block], leave)
                names, cosines = np.concatenate((names, more[0])), np.concatenate((cosines, more[1]))
                seen += len(rest)
        best = np.lexsort((names, -cosines))[:k]
        return names[best], cosines[best], seen

    def _visit(self, lists: np.ndarray, factor: np.ndarray, use: np.ndarray, leave: int) -> tuple[np.ndarray, np.ndarray]:
        """Cosines above 0 of the examples in the lists to use."""
        some = lists[use]
        at, owner = _ranges(self.starts[some], self.ends[some])
        names, place = np.unique(self.example[at], return_inverse=True)
        cosines = np.bincount(place, factor[use][owner] * self.weight[at], len(names))
        kept = (cosines > 0) & (names != leave)
        return names[kept], cosines[kept]


def _ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges one behind the other, and the range that each one is of."""
    sizes = ends - starts
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(owner)) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes), owner


class Model:
    """Terms, examples, and the curve from votes to probabilities."""

    def __init__(self, idf: np.ndarray, keys: list, vectors: list, labels: np.ndarray, bare: tuple[int, int], cfg: Settings):
        """bare: sampled rows without terms, and those of them with label 1."""
        self.cfg, self.idf, self.keys, self.labels = cfg, idf, keys, labels
        self.index = BlockMax(vectors, len(idf), cfg.block)
        rows, ones = bare[0] + len(labels), bare[1] + int(labels.sum())
        self.bare = (bare[1] + ones / max(1, rows)) / (bare[0] + 1) if rows else 0.0
        self.share = float(labels.mean()) if len(labels) else 0.0
        self.curve = (0.0, 1.0)
        if 0 < labels.sum() < len(labels):
            found = [self.index.nearest(*v, cfg.neighbours, leave=i)[:2] for i, v in enumerate(vectors)]
            self.curve = self._fit(np.array([self.vote(*f) for f in found]), labels)

    def vote(self, examples: np.ndarray, cosines: np.ndarray) -> float:
        """Log-odds of the neighbours' votes, each as large as its cosine."""
        w = self.cfg.prior_weight
        p = ((cosines * self.labels[examples]).sum() + w * self.share) / (cosines.sum() + w)
        p = min(max(p, 1e-4), 1 - 1e-4)
        return float(np.log(p / (1 - p)))

    @staticmethod
    def _fit(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 1e-3) -> tuple[float, float]:
        """Offset and slope of a logistic curve by Newton's method."""
        both, beta = np.stack([np.ones_like(x), x], axis=1), np.array([0.0, 1.0])
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(both @ beta, -30, 30)))
            slope = both.T @ (y - p) - ridge * (beta - [0.0, 1.0])
            step = np.linalg.solve((both * (p * (1 - p))[:, None]).T @ both + ridge * np.eye(2), slope)
            beta = beta + step
            if np.abs(step).max() < 1e-9:
                break
        return float(beta[0]), float(max(beta[1], 0.0))

    def score(self, terms: list[int], counts: list[int]) -> tuple[float, np.ndarray, np.ndarray]:
        """Probability of label 1, the neighbours that voted and their cosines."""
        found = self.index.nearest(*weighted(terms, counts, self.idf), self.cfg.neighbours)[:2]
        if not len(found[0]):
            return self.bare, *found
        a, b = self.curve
        return float(1 / (1 + np.exp(-np.clip(a + b * self.vote(*found), -30, 30)))), *found


def learn(counted: DataFrame, terms: list[str], sample: DataFrame, key: str, cfg: Settings) -> Model:
    """A model from the counts of terms of all rows, and the sampled labels."""
    rows = counted.agg(F.count("*").alias("n")).first().n
    df = np.zeros(len(terms))
    for r in counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # at most most_terms rows
        df[r.t] = r["count"]
    idf = np.log((1.0 + rows) / (1.0 + df))
    known = counted.where(F.col(key).isNotNull()).join(F.broadcast(sample), F.col(key) == F.col("_key")).dropDuplicates([key])
    held = F.size("terms") > 0
    bare = known.where(~held).agg(F.count("*"), F.coalesce(F.sum("_label"), F.lit(0))).first()
    some = known.where(held).orderBy(F.xxhash64(key), key).limit(cfg.most_examples).select(key, "_label", "terms", "counts").collect()
    made = [(weighted(r.terms, r["counts"], idf), r[key], r["_label"]) for r in some]
    made = [m for m in made if len(m[0][0])]
    # Similar examples share blocks: by their heaviest terms.
    made.sort(key=lambda m: (m[0][0][np.argsort(-m[0][1], kind="stable")][:4].tolist(), m[1]))
    labels = np.array([m[2] for m in made], float)
    return Model(idf, [m[1] for m in made], [m[0] for m in made], labels, tuple(bare), cfg)


def toxicity(docs: DataFrame, labels: DataFrame, cfg: Settings = Settings(), key: str = "doc_id", text: str = "text", label: str = "toxic", learnable: Column | None = None) -> DataFrame:
    """key, score, predicted, and evidence (key and cosine of the neighbours, nearest first) of each row.

    `learnable` says which rows of `labels` may be learned from; default: all.
    """
    learnable = F.lit(True) if learnable is None else learnable
    sample = stored(sampled_labels(labels, learnable, key, label, cfg.most_labels), "labels")
    labelled = docs.select(key, text).join(F.broadcast(sample), F.col(key) == F.col("_key"))
    terms = chosen_terms(labelled, cfg, text)
    counted = stored(term_counts(docs.select(key, text), terms, text), "counted")
    shared = docs.sparkSession.sparkContext.broadcast(learn(counted, terms, sample, key, cfg))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        known: dict[tuple, tuple] = {}  # rows with few terms are often alike
        for batch in batches:
            found = []
            for pair in zip(map(tuple, batch.column("terms").to_pylist()), map(tuple, batch.column("counts").to_pylist()), strict=True):
                if pair not in known:
                    if len(known) >= _REMEMBERED:
                        known.clear()
                    known[pair] = model.score(*pair)
                found.append(known[pair])
            shown = [[{"example": model.keys[e], "cosine": c} for e, c in zip(f[1].tolist(), f[2].tolist(), strict=True)] for f in found]
            scores = [f[0] for f in found]
            kind = pa.list_(pa.struct([("example", batch.schema.field(key).type), ("cosine", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array(shown, kind)],
                [key, "score", "predicted", "evidence"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return counted.transform(mapped, run, f"{key} {kind}, score double, predicted int, evidence array<struct<example {kind}, cosine double>>")


def op11_nearest_examples(spark, folder: str) -> DataFrame:
    found = toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"), learnable=~held_out(F.col("doc_id")))
    nearest = F.array_join(F.transform(F.slice("evidence", 1, 3), lambda e: e["example"].cast("string")), ",")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", nearest.alias("nearest"))
