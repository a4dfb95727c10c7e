"""Nearest labelled examples: the index against all cosines, and labels that were held out."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from haulwright.llm import toxicity as tox


@pytest.mark.parametrize("block, k", [(1, 5), (8, 5), (8, 1), (1000, 30)])
def test_index_finds_what_all_cosines_give(block, k):
    r = np.random.default_rng(block + k)
    idf = r.uniform(0.1, 5, 60)
    vectors = []
    for _ in range(400):
        n = int(r.integers(1, 9))
        vectors.append(tox.weighted(sorted(r.choice(60, n, replace=False).tolist()), r.integers(1, 5, n).tolist(), idf))
    vectors += vectors[:20]  # ties
    dense = np.zeros((len(vectors), 60))
    for i, (at, w) in enumerate(vectors):
        dense[i, at] = w
    index = tox.BlockMax(vectors, 60, block)
    visited = 0
    for q in range(0, len(vectors), 3):
        cosines = dense @ dense[q]
        for leave in (-1, q):
            names, found, seen = index.nearest(*vectors[q], k, leave)
            want = [i for i in np.lexsort((np.arange(len(vectors)), -np.round(cosines, 10))) if cosines[i] > 0 and i != leave][:k]
            assert np.allclose(found, cosines[want]) and np.all(np.diff(found) <= 1e-12)
            assert np.allclose(cosines[names], found) and leave not in names
            visited += seen
    if block == 8:
        assert visited < 2 * index.blocks * len(range(0, len(vectors), 3))  # bounds leave blocks out


def test_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    found = tox.op11_nearest_examples(spark, folder)
    assert found.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = found.join(spark.read.parquet(f"{folder}/labels.parquet").dropDuplicates(["doc_id"]), "doc_id", "left").toPandas()
    assert len(rows) == 10_000 and rows.score.between(0, 1).all() and (rows.predicted == (rows.score >= 0.5)).all()
    known = rows[rows.held_out & rows.toxic.notna()]
    hits = known[known.toxic == 1].predicted.mean()
    spared = 1 - known[known.toxic == 0].predicted.mean()
    brier = ((known.score - known.toxic) ** 2).mean()
    assert hits >= 0.9 and spared >= 0.97 and brier < 0.04


def small(spark):
    good = [(i, f"the weather is fine on day {i} and so on") for i in range(60)]
    bad = [(100 + i, f"You IDIOT, what a moron on day {i}") for i in range(30)]
    odd = [(200, None), (201, ""), (202, " \n"), (203, "idiot " * 50_000), (None, "an idiot"), (204, "nothing known"), (100, "You IDIOT, what a moron on day 0")]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in good + bad + odd], "doc_id long, text string, score int, terms string")
    labels = [(i, 0) for i, _ in good] + [(100 + i, 1) for i in range(30)] + [(200, 0), (None, 1), (300, 1), (5, None), (6, 0), (6, 0)]
    return docs, spark.createDataFrame([(i, y, "q") for i, y in labels], "doc_id long, toxic int, _label string")


def test_odd_rows(spark):
    docs, labels = small(spark)
    found = tox.toxicity(docs, labels).collect()
    assert len(found) == docs.count()
    by = {r.doc_id: r for r in found}
    assert by[203].predicted == 1 and by[None].predicted == 1 and by[130 - 1].score > 0.9
    assert by[200].score == by[201].score == by[202].score == by[204].score < 0.2 and by[200].evidence == []
    assert all(r.predicted == 0 for i, r in by.items() if i is not None and i < 60)
    assert all(e.example >= 100 for e in by[110].evidence[:5])
    assert all(0 < e.cosine <= 1 + 1e-9 for e in by[110].evidence)


def test_bounds_hold_and_nothing_learned(spark):
    docs, labels = small(spark)
    few = tox.Settings(most_labels=40, most_examples=5, most_terms=2, least_chi2=0.0, least_share=0.0)
    found = tox.toxicity(docs, labels, few).collect()
    assert len(found) == docs.count() and len({e.example for r in found for e in r.evidence}) <= 5
    none = tox.toxicity(docs, labels.limit(0)).collect()
    assert len(none) == docs.count() and {r.score for r in none} == {0.0}
    one = tox.toxicity(docs, labels.where("toxic = 1")).collect()
    assert len({r.score for r in one}) == 1 and one[0].score > 0.9
    assert tox.toxicity(docs.limit(0), labels).count() == 0


def test_labels_that_may_not_be_learned_from_change_nothing(spark):
    docs, labels = small(spark)
    learnable = F.col("doc_id") % 4 != 0
    turned = labels.withColumn("toxic", F.when(learnable, F.col("toxic")).otherwise(1 - F.col("toxic")))
    scores = lambda ys: sorted((str(r.doc_id), r.score) for r in tox.toxicity(docs, ys, learnable=learnable).collect())
    assert scores(labels) == scores(turned)
