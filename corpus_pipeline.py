"""Training-corpus pipeline: quality rules, near-duplicates, repeated passages, personal data, packing.

Each stage takes (spark, docs, sf_dir), docs with the columns of `documents`, and
works on all rows it is given; all but the last return those columns again. Null
and empty texts fail the quality rules, so later stages see them only when
called by themselves, where they are kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulwright.llm.common import Filter, stored, table
from haulwright.llm.neardup import Join, near_duplicates
from haulwright.llm.packing import pack_documents
from haulwright.llm.pii import redact
from haulwright.llm.quality import judged
from haulwright.llm.suffix import remove_repeats

_REPLACEMENT, _MARK = "\ufffd", "\ufdd0"
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality rules keep (op 2)."""
    return judged(docs.select(*COLUMNS), keep_text=True).where("kept").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, that with the smallest doc_id (op 4).

    Rows without doc_id stay; of rows that repeat a doc_id and its text one stays. Different texts
    under one doc_id are told apart by nothing but their text, so they stay or go together.
    """
    found = stored(near_duplicates(docs, Join(words=5, percent=80)).select("doc_id", "kept"), "near")
    ids = found.where("doc_id is not null").groupBy("doc_id").agg(F.bool_or("kept").alias("stays"), F.count("*").alias("n"))
    odd = stored(ids.where("not stays or n > 1"), "odd")
    # Rows that surely stay aren't shuffled; no broadcast, as these ids grow with the documents.
    some, rest = Filter(odd.select(F.col("doc_id").alias("key"))).split(docs.select(*COLUMNS), F.col("doc_id"))
    some = some.join(odd.hint("merge"), "doc_id", "left").where(F.coalesce("stays", F.lit(True)))
    out = rest.unionByName(some.where("n is null or n = 1").select(*COLUMNS))
    if not odd.where("n > 1").isEmpty():
        out = out.unionByName(some.where("n > 1").dropDuplicates(["doc_id", "text"]).select(*COLUMNS))
    return out


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that documents with smaller ids hold, too (op 7).

    Halves of characters that a removed passage cuts in two are dropped, a replacement character
    that the text held before stays. Rows whose whole text is gone are dropped as well; a text
    that was null or empty before stays.
    """
    found = remove_repeats(docs.select(*COLUMNS))
    whole = F.col("repeats.kept").cast("string")
    # The text's own replacement characters are written otherwise while those of halves are dropped.
    kept = F.replace(F.replace(whole, F.lit(_MARK), F.lit(f"{_MARK}a")), F.lit(_REPLACEMENT), F.lit(f"{_MARK}b"))
    kept = F.replace(F.make_valid_utf8(kept), F.lit(_REPLACEMENT), F.lit(""))
    kept = F.replace(F.replace(kept, F.lit(f"{_MARK}b"), F.lit(_REPLACEMENT)), F.lit(f"{_MARK}a"), F.lit(_MARK))
    text = F.when(F.col("repeats.n_removed") == 0, whole).otherwise(kept)
    rows = found.where("repeats.n_removed < repeats.n_bytes or repeats.n_bytes = 0").withColumn("text", text)
    return rows.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by the name of its kind (op 1)."""
    return redact(docs.select(*COLUMNS))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all rows with their sequences of at most 2048 tokens (op 5)."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("personal_data", personal_data),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Tokenising and the joins of whole texts are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None
