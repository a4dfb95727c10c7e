"""Language identification: multinomial naive Bayes over hashed character n-grams.

Learning counts the n-grams of every labelled text, task by task in dense
vectors that Spark then adds up, so the work grows with the rows and what comes
to the driver is bounded by languages times buckets. The log-probability
matrix is broadcast, and texts are scored in numpy a few megabytes at a time.

N-grams are of 1 to 4 characters of the lower-cased text, letters only inside,
with a space for whatever isn't a letter at their ends. A text that is null or
has no letter is `und` with score 0, as is every text if nothing was learned.
Ties go to the first language in order. The score is the posterior probability.
Of more than 500 languages those with the most rows are learned (`MOST_LANGUAGES`).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulwright.llm.common import mapped, mixed, steps, table, texts_of

BUCKETS = 1 << 16
#: Languages that a model has at most, as each holds a vector in memory: those with the most rows (ties by name).
MOST_LANGUAGES = 500
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def grams(texts: list[str], longest: int = 4) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n the buckets of all n-grams of the texts and the numbers of their texts, in order."""
    lowered = [t.lower() for t in texts]
    lengths = np.fromiter(map(len, lowered), np.int64, len(lowered)) + 2
    codes = np.frombuffer("".join(f" {t} " for t in lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _is_letter()[codes]
    codes = np.where(letter, codes, np.uint32(32)).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), lengths)
    value = np.zeros(len(codes), np.uint64)
    for n in range(1, min(longest, len(codes)) + 1):
        size = len(codes) - n + 1
        value = value[:size] * np.uint64(1_000_003) + codes[n - 1 :]
        use = owner[:size] == owner[n - 1 :]
        if n == 1:
            use &= letter
        elif n == 2:
            use &= letter[:size] | letter[1:]
        else:
            for k in range(1, n - 1):
                use &= letter[k : size + k]
        at = np.flatnonzero(use)
        yield (mixed(value[at] + np.uint64(n << 60)) % np.uint64(BUCKETS)).astype(np.int64), owner[at]


@dataclass(frozen=True)
class Model:
    """Languages in order, log priors, and log probabilities by language and bucket."""

    languages: tuple[str, ...]
    priors: np.ndarray
    logs: np.ndarray

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and posterior probability of each text."""
        totals = np.zeros((len(texts), len(self.languages)))
        lettered = np.zeros(len(texts), bool)
        for buckets, owner in grams(texts):
            if not len(owner):
                continue
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            rows = owner[first]
            lettered[rows] = True
            for k in range(len(self.languages)):
                totals[rows, k] += np.add.reduceat(self.logs[k][buckets], first)
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts))
        totals += self.priors
        best = totals.argmax(axis=1)
        scores = 1 / np.exp(totals - totals.max(axis=1, keepdims=True)).sum(axis=1)
        named = [self.languages[b] if ok else "und" for b, ok in zip(best, lettered, strict=True)]
        return named, np.where(lettered, scores, 0.0)


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", smoothing: float = 0.5) -> Model:
    """A model from all rows with text and language; counts cover every row."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in steps(batches, text):
            texts, names = texts_of(batch.column(text)), batch.column(lang).to_pylist()
            known = sorted(set(names))
            for name in known:
                if name not in held:
                    held[name] = np.zeros(BUCKETS + 1, np.int64)
                held[name][BUCKETS] += names.count(name)
            number = np.array([known.index(n) for n in names])
            for buckets, owner in grams(texts):
                both = np.bincount(number[owner] * BUCKETS + buckets, minlength=len(known) * BUCKETS)
                for k, name in enumerate(known):
                    held[name][:BUCKETS] += both[k * BUCKETS : (k + 1) * BUCKETS]
        for name, counts in held.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(counts[at])], ["lang", "bucket", "n"])

    labelled = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text), F.col(lang))
    sizes = labelled.groupBy(lang).count().orderBy(F.desc("count"), lang).limit(MOST_LANGUAGES + 1)
    if len(learned := [r[0] for r in sizes.select(lang).collect()]) > MOST_LANGUAGES:
        labelled = labelled.where(F.col(lang).isin(learned[:MOST_LANGUAGES]))
    counted = labelled.transform(mapped, count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = counted.toArrow()
    names = found.column("lang").to_pylist()
    languages = tuple(sorted(set(names)))
    counts = np.zeros((len(languages), BUCKETS + 1))
    order = {name: k for k, name in enumerate(languages)}
    counts[[order[n] for n in names], found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    rows, counts = counts[:, BUCKETS], counts[:, :BUCKETS] + smoothing
    priors = np.log(rows / rows.sum()) if languages else rows
    return Model(languages, priors, np.log(counts / counts.sum(axis=1, keepdims=True)))


def held_out(key: Column, parts: int = 5) -> Column:
    """Whether crc32 of the key as text is divisible by parts; a null key isn't held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts == 0, F.lit(False))


def identify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, lang_pred and score of each row, from its text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, text):
            named, scores = shared.value.predict(texts_of(batch.column(text)))
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(named, pa.string()), pa.array(scores)], [key, "lang_pred", "score"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).transform(mapped, run, f"{key} {kind}, lang_pred string, score double")


def op6_language_id(spark, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = learn(documents.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))))
    found = identify(documents, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
