"""Operators over whole tables, against brute force and SQL."""

import hashlib
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from haulwright.llm import ann, graph, neardup, sais, suffix, warc
from haulwright.llm.queries import ORACLES, QUERIES

# op 3


def plain_neighbours(rows, queries, k=5):
    good = {(i, tuple(v)) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)}
    size = Counter(len(v) for _, v in good).most_common(1)[0][0]
    good = sorted((i, v) for i, v in good if len(v) == size)
    names = np.array([i for i, _ in good])
    x = np.array([v for _, v in good])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for q in np.flatnonzero(np.isin(names, list(queries))):
        near = np.round(unit @ unit[q], 12)
        order = [j for j in np.lexsort((names, -near)) if names[j] != names[q]][:k]
        out[int(names[q])] = [(int(names[j]), float(near[j])) for j in order]
    return out


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_neighbours_with_odd_vectors(spark):
    r = np.random.default_rng(0)
    base = r.normal(size=(60, 16)).astype(np.float32)
    rows = [(i, base[i].tolist()) for i in range(60)]
    rows += [(100 + i, base[0].tolist()) for i in range(40)]  # many copies of one vector
    rows += [(200, None), (201, [0.0] * 16), (202, [float("nan")] + [1.0] * 15), (203, [1.0] * 3), (204, [None] + [1.0] * 15)]
    rows += [(205, [float("inf")] + [1.0] * 15), (50, base[50].tolist())]
    found = ann.nearest_neighbours(vectors(spark, rows), F.col("vec_id") % 10 == 0, share=1.0).collect()
    want = plain_neighbours(rows, {i for i, _ in rows if i % 10 == 0})
    got = {}
    for x in sorted(found, key=lambda x: (x["query_id"], x["rank"])):
        got.setdefault(x["query_id"], []).append((x["vec_id"], round(x["score"], 6)))
    assert set(got) == set(want)
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want) and all(len(v) == 5 for v in got.values())
    assert [v for v, _ in got[100]] == [0, 101, 102, 103, 104]
    assert {q for q in got} & {200, 201, 202, 203, 204, 205} == set()


def test_few_and_no_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 2.0])]
    found = ann.nearest_neighbours(vectors(spark, rows), F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(x["vec_id"], round(x["score"], 9)) for x in found] == [(1, round(0.5**0.5, 9)), (2, 0.0)]
    assert ann.nearest_neighbours(vectors(spark, rows[:1]), F.col("vec_id") == 0).count() == 0
    assert ann.nearest_neighbours(vectors(spark, rows).limit(0), F.col("vec_id") == 0).count() == 0


def test_index_finds_every_code_within_the_radius():
    x = np.random.default_rng(1).normal(size=(500, 20))
    coder = ann.learn_coder(x)
    index, bits = ann.Index(coder, x), coder.bits(x)
    for radius in (0, 3, 5, 9):
        for q in range(20):
            want = np.flatnonzero((bits != bits[q]).sum(axis=1) <= radius)
            assert np.array_equal(index.within(coder.parts(x[q : q + 1])[0], radius), want)


def test_recall_on_the_given_vectors(spark, folder):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    want = plain_neighbours(rows, {i for i, _ in rows if i % 50 == 0})
    found = QUERIES["op3_multi_index_hashing"](spark, folder).collect()
    hits = sum(f["vec_id"] in {v for v, _ in want[f["query_id"]]} for f in found)
    assert len(found) == 5 * len(want) and hits >= 0.9 * len(found)


# op 4


def plain_components(rows, words, percent):
    sets = []
    for _, text in rows:
        ws = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        sets.append({tuple(ws[i : i + words]) for i in range(max(1, len(ws) - words + 1))} if ws else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            same_id = rows[i][0] == rows[j][0]
            if None not in (rows[i][0], rows[j][0]) and (same_id or (a and b and 100 * len(a & b) >= percent * len(a | b))):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(s), d if d is None else least[find(i)] if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def near_rows(seed, bases=6, copies=12):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, shared = [], [r.choice(vocabulary) for _ in range(30)]
    for _ in range(bases):
        base = [r.choice(vocabulary) for _ in range(r.randint(20, 90))] + shared
        for _ in range(r.randint(1, copies)):
            text = list(base)
            for _ in range(r.randint(0, 4)):
                text[r.randrange(len(text))] = r.choice(vocabulary)
            rows.append(" ".join(text))
    rows += ["One two", "one TWO", "one", "", None, " \n", "É two", "é two"]
    r.shuffle(rows)
    return [(i * 3, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize(
    "how",
    [
        neardup.Join(words=3, percent=85),
        neardup.Join(),
        neardup.Join(words=3, percent=85, node=4, depth=2),  # nodes taken whole
        neardup.Join(words=3, percent=85, node=4, depth=2, block_tokens=400),  # clusters in blocks
    ],
)
def test_near_duplicates(spark, how):
    rows = near_rows(7)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = neardup.near_duplicates(docs, how).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found), key=repr) == plain_components(rows, how.words, how.percent)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


@pytest.mark.parametrize("how", [neardup.Join(words=3, percent=85), neardup.Join()])
def test_recall_where_nodes_get_small_at_the_last_level(how):
    r = np.random.default_rng(12)
    pairs, missed = 3000, 0
    for _ in range(pairs):
        size = 200
        common = round(2 * size * how.percent / (100 + how.percent)) + 1
        tokens = r.integers(0, 2**63, 2 * size - common, dtype=np.uint64)
        a, b = (neardup.chosen_tokens(np.sort(t), how) for t in (tokens[:size], tokens[size - common :]))
        below = (a[:, 2:] == b[:, 2:]).all(axis=1)
        first = (a[:, :2, None] == b[:, None, :2]).any(axis=(1, 2))
        missed += not (below & first).any()
    assert missed <= 2 * pairs / 1000


def test_near_duplicates_of_odd_rows(spark, odd_docs, no_docs):
    found = neardup.near_duplicates(odd_docs).collect()
    assert len(found) == odd_docs.count() and all(r["kept"] for r in found if r["doc_id"] is None)
    assert neardup.near_duplicates(no_docs).count() == 0


def test_a_large_group_of_near_copies(spark):
    r = random.Random(8)
    base = [f"w{r.randrange(2000)}" for _ in range(150)]
    texts = [" ".join(base[: r.randint(130, 150)] + [f"x{i}"]) for i in range(1500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = neardup.near_duplicates(docs, neardup.Join(words=3, percent=85, block_tokens=60_000)).collect()
    assert Counter(x["component_id"] for x in found) == {0: 1500}


def test_components_of_random_graphs(spark):
    r = random.Random(9)
    pairs = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(40)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    want = {(x, find(x)) for x in list(root) if find(x) != x}
    found = graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {(x["node"], x["root"]) for x in found} == want and len(found) == len(want)


# op 7


def test_suffix_arrays():
    r = random.Random(0)
    for _ in range(1500):
        size = r.choice([1, 2, 3, 5, 20, 6000])
        text = [r.randint(1, size) for _ in range(r.randint(0, 60))] + [0]
        want = sorted(range(len(text)), key=lambda i: text[i:])
        assert sais.suffix_array(np.array(text), size + 1).tolist() == want


def test_common_prefixes():
    r = random.Random(1)
    text = "".join(r.choice("ab") * r.randint(1, 9) for _ in range(150))
    data = np.frombuffer(text.encode() + bytes(80), np.uint8)
    array = sais.suffix_array(np.r_[data[: len(text)].astype(int) + 1, 0], 257)
    shared = sais.common_prefixes(data, array, 13)
    for before, place in zip(array, array[1:], strict=False):
        n = 0
        while n < 13 and max(before, place) + n < len(data) and data[before + n] == data[place + n]:
            n += 1
        assert shared[place] == n


def plain_repeats(rows, span):
    encoded = [(d, (t or "").encode()) for d, t in rows]
    least = {}
    for d, b in encoded:
        for i in range(len(b) - span + 1) if d is not None else ():
            least[b[i : i + span]] = min(d, least.get(b[i : i + span], d))
    out = []
    for d, b in encoded:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - span + 1) if d is not None else ():
            if least[b[i : i + span]] < d:
                gone[i : i + span] = True
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def repeats(docs, **how):
    found = suffix.remove_repeats(docs, **how)
    names = ["repeats.n_bytes", "repeats.n_removed", "repeats.n_spans"]
    return sorted(map(tuple, found.select("doc_id", *names, F.sha2("repeats.kept", 256)).collect()), key=repr)


@pytest.mark.parametrize("how", [{}, {"hot": 4}, {"span": 20}])
def test_repeats_against_brute_force(spark, how):
    r = random.Random(3)
    words = ["alpha", "beta", "gamma", "é", "delta delta delta", "x"]
    passages = [" ".join(r.choice(words) for _ in range(r.randint(5, 40))) for _ in range(8)]
    rows = []
    for i in range(80):
        parts = [r.choice(passages) if r.random() < 0.6 else "".join(r.choice("abc ") for _ in range(r.randint(0, 80))) for _ in range(r.randint(0, 6))]
        text = None if i % 17 == 3 else "a" * r.randint(0, 130) if i % 11 == 2 else " ".join(parts)
        rows.append((None if i == 9 else i // 2 * 2 if i % 13 == 0 else i, text))
    rows += rows[5:9]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert repeats(docs, **how) == plain_repeats(rows, how.get("span", 50))


def test_repeats_of_the_given_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = plain_repeats(rows, 50)
    assert repeats(docs) == want and sum(x[2] for x in want) > 0
    found = QUERIES["op7_repeated_spans"](spark, folder)
    assert sorted(map(tuple, found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=repr) == want


def test_short_strings_that_meet_by_chance_are_left_out(spark):
    r = random.Random(5)
    phrases = ["".join(r.choice("abcdefgh") for _ in range(18)) for _ in range(1000)]
    rows = [(i, " ".join(r.choice(phrases) for _ in range(80))) for i in range(60)]
    docs = spark.createDataFrame([(d, d, t) for d, t in rows], "doc long, row long, text string")
    marked = suffix._shared_hashes(docs, 8, 50, 1000).where("part >= 0").select(F.sum(F.size("marks"))).first()[0] or 0
    runs = len(suffix.Runs([t for _, t in rows], 50).at)
    assert runs > 5000 and marked < runs / 20


def test_whole_copies_stay_out_of_the_search(spark, monkeypatch):
    r = random.Random(6)
    texts = ["".join(r.choice("abcdefgh ") for _ in range(r.randint(40, 300))) for _ in range(12)]
    rows = [(100 - i, texts[i % 12]) for i in range(60)]
    rows += [(7, texts[0] + texts[1]), (None, texts[2]), (100, texts[0]), (3, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen, search = [], suffix._shared_hashes
    monkeypatch.setattr(suffix, "_shared_hashes", lambda some, *a: seen.extend(x.doc for x in some.select("doc").collect()) or search(some, *a))
    assert repeats(docs) == plain_repeats(rows, 50)
    first = {t: min(d for d, other in rows if other == t and d is not None) for t in texts}
    assert sorted(seen) == sorted([*(first[t] for t in texts if len(t) >= 50), 7])


def test_hot_windows_of_a_step_share_a_row(spark, monkeypatch):
    r = random.Random(7)
    passage = "".join(r.choice("abcdefgh ") for _ in range(120))
    rows = [(i, "".join(r.choice("abcdefgh ") for _ in range(60)) + passage + "".join(r.choice("abcdefgh ") for _ in range(60))) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    tables, store = {}, suffix.stored
    monkeypatch.setattr(suffix, "stored", lambda rows, label: tables.setdefault(label, store(rows, label)))
    assert repeats(docs, hot=10) == plain_repeats(rows, 50)
    windows = tables["windows"]
    assert windows.count() == windows.select("window").distinct().count()
    places = [len(x.at) for x in windows.select("at").collect()]
    assert max(places) == 100 and sum(n == 100 for n in places) > 20


def test_covered_windows_against_brute_force():
    r = random.Random(8)
    for _ in range(60):
        texts = list({"".join(r.choice("ab") * r.randint(1, 9) for _ in range(r.randint(1, 12))).encode() for _ in range(r.randint(1, 12))})
        owners = np.array([r.randint(0, 9) for _ in texts])
        least = {}
        for t, d in zip(texts, owners.tolist(), strict=True):
            for i in range(len(t) - 11):
                least[t[i : i + 12]] = min(d, least.get(t[i : i + 12], d))
        want = [(k, i) for k, t in enumerate(texts) for i in range(len(t) - 11) if least[t[i : i + 12]] < owners[k]]
        found = suffix.covered_windows(texts, owners, 12)
        assert list(zip(*(c.tolist() for c in found), strict=True)) == want


def test_repeats_of_odd_rows(odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    found = suffix.remove_repeats(odd_docs.withColumn("repeats", F.lit(1)))
    assert {"lang", "n_words", "kept", "repeats"} <= set(found.columns)
    assert repeats(odd_docs) == plain_repeats(rows, 50)
    assert repeats(no_docs) == []


# op 8


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def odd_pages():
    big = "<p>é\r\n\r\nWARC/1.1\r\n</p>" * 60
    return [(1, "http://a.example/x y", big), (2, None, big), (3, " ", big + "!"), (7, "http://b.example/\n", big), (4, "u", ""), (5, "u", None), (6, "u", "short"),
            (8, "v", "short"), (7, "http://b.example/\n", big), (9, "w", "x" * 200_000)]


def test_archives_round_trip(spark, tmp_path):
    folder = str(tmp_path)
    pages(spark, odd_pages()).write.parquet(f"{folder}/pages.parquet")
    found = sorted(map(tuple, QUERIES["op8_arc_to_warc"](spark, folder).collect()), key=repr)
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet/*.parquet'")
    assert found == sorted(db.execute(ORACLES["op8_arc_to_warc"]).fetchall(), key=repr)
    assert [x[4] for x in found if x[0] in (1, 2)] == [7, 7] and [x[3] for x in found if x[0] == 7] == ["response"] * 2


def test_no_pages(spark, tmp_path):
    pages(spark, odd_pages()).limit(0).write.parquet(f"{tmp_path}/pages.parquet")
    assert QUERIES["op8_arc_to_warc"](spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("version", [1, 2])
def test_both_arc_versions(version):
    content = warc.arc_bytes([(p, f"http://x.example/{p}", h) for p, _, h in odd_pages()], version, "a.arc")
    records = list(warc.arc_records(content))
    assert [r["body"].decode() for r in records] == [h or "" for _, _, h in odd_pages()]
    assert [content[r["offset"] :].startswith(r["url"].encode()) for r in records] == [True] * len(records)
    with pytest.raises(ValueError):
        list(warc.arc_records(content[:-50]))


def test_warc_files_are_plain_records(spark, tmp_path):
    records = warc.convert_arc(warc.pages_to_arc(pages(spark, odd_pages())))
    path = f"{tmp_path}/out"
    warc.write_warc(warc.warc_records(records, warc.largest_copies(records, 1000)), path, records_per_file=2)
    seen = [x for f in tmp_path.glob("out/*.gz") for x in warc.warc_parse(f.read_bytes())]
    assert Counter(f["warc-type"] for f, _ in seen) == {"response": 8, "revisit": 2}
    assert all(re.fullmatch(r"<urn:uuid:[0-9a-f-]{36}>", f["warc-record-id"]) for f, _ in seen)
    ids = {f["warc-record-id"] for f, _ in seen if f["warc-type"] == "response"}
    assert all(f["warc-refers-to"] in ids for f, _ in seen if f["warc-type"] == "revisit")


# SQL and the pipeline


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_match_their_statements(spark, folder, name):
    db = duckdb.connect()
    for table in ("documents", "pages"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    cursor = db.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    found = QUERIES[name](spark, folder).select(*columns).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(cursor.fetchall(), key=repr)


def test_pipeline_stages(spark, odd_docs):
    docs = odd_docs.select("doc_id", "text", "lang", F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "suffix_dedup", "personal_data", "packing"]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        for given in (docs, docs.limit(0)):
            found = stage(spark, given, "")
            if number < 4:
                assert tuple(found.columns) == corpus_pipeline.COLUMNS
            rows = found.collect()
            assert rows or not given.count()
    kept = corpus_pipeline.near_dedup(spark, docs, "").select("doc_id").collect()
    assert len(kept) == len(set(kept))


def test_pipeline_against_plain_steps(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    good = corpus_pipeline.quality_rules(spark, docs, folder)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = {r["doc_id"]: r["text"] for r in good.collect()}
    assert sum(labels.get(d) == 1 for d in rows) >= 0.9 * sum(q == 1 for q in labels.values())
    unique = corpus_pipeline.near_dedup(spark, good, folder)
    want = {c for _, _, c in plain_components(list(rows.items()), 5, 80)}
    assert {r["doc_id"] for r in unique.collect()} == want
    cut = corpus_pipeline.suffix_dedup(spark, unique, folder)
    sizes = {d: n - gone for d, n, gone, _, _ in plain_repeats([(d, rows[d]) for d in want], 50)}
    assert {r["doc_id"] for r in cut.collect()} == {d for d, n in sizes.items() if n}
    clean = corpus_pipeline.personal_data(spark, cut, folder)
    assert not any("@mail" in r["text"] for r in clean.collect())
    packed = corpus_pipeline.packing(spark, clean, folder).collect()
    assert {r["doc_id"] for r in packed} == {d for d, n in sizes.items() if n}
