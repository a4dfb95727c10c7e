"""Many labels, names that helpers might take, and texts that stages must not lose."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from haulwright.llm import langid, packing, quality

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], SCHEMA)


def test_quality_with_more_labels_than_references(spark, monkeypatch):
    monkeypatch.setattr(quality, "MOST_LANGUAGES", 3)
    r = random.Random(1)
    rows = []
    for k in range(8):
        words = [f"w{k}{c}{d}" for c in "abcdefgh" for d in "abcdefgh"]
        for n in range(12 + k):
            rows.append((100 * k + n, " ".join(r.choice(words) for _ in range(70)) + ".", f"l{k}"))
    found = quality.judged(documents(spark, rows)).collect()
    assert len(found) == len(rows) and not any(x.base_failed for x in found)
    by = {k: [x.char_distance for x in found if x.doc_id // 100 == k] for k in range(8)}
    assert max(by[7]) < 0.1  # the labels with the most documents are references


def test_quality_with_columns_named_like_helpers(spark):
    text = "the of and to in is that it was for on are with as his they be at one have this " * 5
    rows = [(i, text + str(i), "en") for i in range(15)]
    docs = documents(spark, rows)
    odd = docs.withColumns({c: F.lit(7) for c in ("_w", "_chars", "_upper", "_digit", "_mark", "_both", "_w_", "N_WORDS")})
    plain = {r.doc_id: r.kept for r in quality.judged(docs).collect()}
    found = quality.judged(odd).collect()
    assert {r.doc_id: r.kept for r in found} == plain and {r["_w"] for r in found} == {7}


def test_language_model_with_more_labels_than_it_may_have(spark, monkeypatch):
    monkeypatch.setattr(langid, "MOST_LANGUAGES", 2)
    rows = [(i, "the cat sat on the mat", "en") for i in range(9)] + [(20 + i, "der Hund und die Katze", "de") for i in range(9)]
    rows += [(40 + i, "xyzzy qwrt", f"rare{i}") for i in range(5)]
    model = langid.learn(documents(spark, rows))
    assert model.languages == ("de", "en")
    assert model.predict(["the mat", "die Katze"])[0] == ["en", "de"]


def test_packing_with_columns_named_like_helpers(spark):
    r = random.Random(2)
    items = spark.createDataFrame([(i, r.randint(1, 90), 5, 6, 7, 8) for i in range(300)], "id long, length long, _row int, _block int, _fill int, offset int")
    found = packing.pack(items, most=100, block=60).collect()
    assert sorted(x.id for x in found) == list(range(300)) and {(x["_row"], x["_block"], x["_fill"]) for x in found} == {(5, 6, 7)}
    fills = {}
    for x in sorted(found, key=lambda x: (x.sequence_id, x.offset)):
        assert x.offset == fills.get(x.sequence_id, 0)
        fills[x.sequence_id] = x.offset + x.length
    assert max(fills.values()) <= 100


def test_texts_of_one_id_are_not_lost(spark):
    r = random.Random(3)
    one, two = (" ".join(str(r.random()) for _ in range(60)) for _ in range(2))
    rows = [(1, one, "en"), (1, two, "en"), (1, one, "en"), (2, " ".join(str(r.random()) for _ in range(60)), "en"), (None, "x", None)]
    found = corpus_pipeline.near_dedup(spark, documents(spark, rows), "").collect()
    assert sorted(((x.doc_id, x.text) for x in found), key=repr) == sorted({(a, b) for a, b, _ in rows}, key=repr)


@pytest.mark.parametrize("odd", ["�", "﷐", "﷐a﷐b��"])
def test_replacement_characters_of_a_text_stay(spark, odd):
    passage = "Ein Absatz, der in zwei Texten steht und lang genug ist, damit er entfernt wird. " * 2
    # The passage begins and ends inside characters that share a byte.
    rows = [(1, f"anfang ü{passage}ß", "de"), (2, f"{odd} davor ü{passage}ü danach {odd}", "de"), (3, f"ganz anders {odd}", "de")]
    found = {x.doc_id: x for x in corpus_pipeline.suffix_dedup(spark, documents(spark, rows), "").collect()}
    assert found[3].text == rows[2][1] and found[1].text == rows[0][1]
    text = found[2].text
    assert passage.strip() not in text and text.startswith(f"{odd} davor") and text.endswith(f"danach {odd}")
    assert text.count("�") == 2 * odd.count("�") and text.count("﷐") == 2 * odd.count("﷐")
    assert found[2].n_chars == len(text)
