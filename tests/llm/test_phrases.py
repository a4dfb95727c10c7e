"""Phrases against plain counting, with chunks and hashes of several sizes."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from haulwright.llm import phrases

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def plain(rows, least=10, most=2000):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n\x0b-\r]", text):
            words = [w for w in re.split(r"[ \t]", piece) if w]
            total[lang] += len(words)
            for k in (1, 2, 3):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        found = []
        held = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        for p, a in held.items():
            longer = [b for q, b in held.items() if len(q) > len(p) and p in (q[:2], q[1:])] if len(p) == 2 else []
            if any(100 * b >= 50 * a for b in longer):
                continue
            cut = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-cut[0], -a, " ".join(p).encode(), f[p[: cut[1]]], f[p[cut[1] :]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:most], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def shown(found):
    return sorted(tuple(r) for r in found.select(*COLUMNS).collect())


def odd_rows():
    r = random.Random(4)
    words = ["New", "york", "is", "a", "big", "city", "été", "日本", "x" * 70, "x" * 70 + "y", "the", "of", "\x00"]
    rows = [(r.choice(["en", "de", None, ""]), " ".join(r.choice(words) + r.choice(["", "", ",", ".\n", "\t"]) for _ in range(r.randint(0, 90)))) for _ in range(60)]
    rows += [("en", "In New York City the new york times. " * 30)] * 3
    rows += [("en", None), ("fr", ""), ("fr", " \n.,"), (None, "only once"), ("es", "palabra " * 20_000), ("es", "a b " * 3_000)]
    return rows


@pytest.mark.parametrize("every, low_bits, parts", [(48, 32, 3), (2, 32, 5), (10**9, 32, 1), (7, 6, 4)])
def test_phrases_agree_with_plain_counting(spark, monkeypatch, every, low_bits, parts):
    monkeypatch.setattr(phrases, "EVERY", every)
    monkeypatch.setattr(phrases, "LOW_BITS", low_bits)  # few bits let more phrases pass, none is lost
    rows = odd_rows()
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(parts)
    docs = docs.withColumns({"freq": F.lit(7), "chunk": F.lit("x"), "phrase": F.lit("y"), "a": F.lit(1)})
    assert shown(phrases.collocations(docs)) == plain(rows)


def test_list_ends_at_its_length_and_least_counts(spark):
    rows = odd_rows()
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert shown(phrases.collocations(docs, least=3, most=5)) == plain(rows, 3, 5)
    with pytest.raises(ValueError):
        phrases.phrase_counts(docs, 16)


def test_equal_passages_share_chunks(spark):
    passage = " ".join(f"w{i * i % 977}" for i in range(4000))
    rows = [("en", f"start {i} {passage} end {i}") for i in range(20)]
    found = phrases.chunks(spark.createDataFrame(rows, "lang string, text string"))
    sums = found.agg(F.sum(F.col("own") * F.col("freq")), F.sum("own"), F.max("freq")).first()
    assert sums[0] == 20 * 4004 and sums[1] < 3 * 4004 and sums[2] >= 20


def test_scores_beyond_64_bits_are_exact(spark):
    # As counts of a corpus far larger than a test has; the last one differs in its last digit only.
    rows = [(10**12, 10**12, 10**12), (3 * 10**11, 7 * 10**12, 10**13 - 1), (999_999_999_999, 10**12, 10**12)]
    frame = spark.createDataFrame(rows, "a long, l long, r long")
    big = frame.select(*[F.col(c).cast("decimal(38,0)").alias(f"_{c}") for c in "alr"])
    score = F.expr("cast(cast(1000000 AS decimal(38,0)) * _a * _a AS decimal(38,0)) div cast(_l * _r AS decimal(38,0))")
    assert [r[0] for r in big.select(score).collect()] == [1000000 * a * a // (left * right) for a, left, right in rows]


def test_empty_table(spark):
    none = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(none).count() == 0
