"""Operators on single texts, against the libraries, brute force and held-out accuracy."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from haulwright.llm import counts, langid, packing, pieces, pii, quality

SPACE = r"[^\x20\x09-\x0D]+"


def texts_in(folder):
    return [r[0] for r in duckdb.sql(f"select text from '{folder}/documents.parquet' order by doc_id").fetchall()]


# op 1


def plain_spans(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((0, *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        odd, even = digits[-1::-2], digits[-2::-2]
        total = sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)
        if 16 <= len(digits) <= 19 and total % 10 == 0:
            out.append((2, *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((3, *m.span()))
    return sorted(out)


def test_base_spans_are_those_of_the_patterns(folder, odd_texts):
    r = random.Random(1)
    bits = ["1", "2", "55", "255", "4111 1111 1111 1111", ".", "@", "+", "-", " ", "a", "b.c", "(", ")", "é", "a@b.c"]
    made = ["".join(r.choice(bits) for _ in range(r.randint(0, 14))) for _ in range(20_000)]
    for text in [*made, *texts_in(folder), *[t or "" for t in odd_texts]]:
        assert [s[:3] for s in pii.spans_of(text) if s[3]] == plain_spans(text), text


def test_anchors_add_spans():
    text = "jörg@firma.de, http://bob:pw@host.com/x. IBAN: GB82 WEST 1234 5698 7654 32 AND account no. 12345678 http://[::1]/ http://x.org/a Konto 1"
    added = {(text[a:b], pii.KINDS[k]) for k, a, b, base in pii.spans_of(text) if not base}
    assert added == {
        ("jörg@firma.de", "email"),
        ("http://bob:pw@host.com/x", "address"),
        ("http://[::1]/", "address"),
        ("GB82 WEST 1234 5698 7654 32", "account"),
        ("12345678", "account"),
    }


def test_redaction_keeps_the_rest(odd_docs):
    assert pii.redacted("call +1 (499) 555-6503 or x.y@z.example now") == "call [phone] or [email] now"
    rows = pii.redact(odd_docs.withColumn("n_chars", F.length("text"))).collect()
    assert len(rows) == odd_docs.count()
    assert all(r["text"] is None or len(r["text"]) == r["n_chars"] for r in rows)
    assert not any(pii.spans_of(r["text"] or "") for r in rows)


def test_personal_data_of_odd_rows(odd_docs, no_docs):
    found = pii.find_personal_data(odd_docs).collect()
    assert len(found) == odd_docs.count()
    assert pii.find_personal_data(no_docs).count() == 0


# op 2


def plain_counts(text):
    words = re.findall(SPACE, text or "")
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = set()
    for i, w in enumerate(zip(words, words[1:], words[2:], strict=False)):
        if windows[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [line for line in (text or "").split("\n") if re.search(SPACE, line)]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_quality_counts(odd_docs, folder, spark):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    for docs in (odd_docs, spark.read.parquet(f"{folder}/documents.parquet")):
        rows = quality.measures(docs).select("text", *names).collect()
        assert len(rows) == docs.count()
        for r in rows:
            assert tuple(r[n] for n in names) == plain_counts(r["text"]), r["text"][:80]


def shares(bins):
    return [b / max(1, sum(bins)) for b in bins]


def distance(p, q):
    m = [(a + b) / 2 for a, b in zip(p, q, strict=True)]
    kl = lambda x: sum(a * math.log2(a / b) for a, b in zip(x, m, strict=True) if a > 0)
    return math.sqrt(max(0.0, (kl(p) + kl(q)) / 2))


def test_quality_verdicts_follow_the_divergence(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    limits = quality.Limits()
    rows = quality.judged(docs, keep_text=True).collect()
    means = {}
    for bins in ("char_bins", "common_bins"):
        for lang in sorted({r["lang"] for r in rows if r["lang"]}):
            good = [shares(r[bins]) for r in rows if r["lang"] == lang and not r["base_failed"]]
            means.setdefault(bins, []).append([sum(c) / len(good) for c in zip(*good, strict=True)])
    for r in rows:
        n, _, _, _, repeats = plain_counts(r["text"])
        failed = n < 50 or 100 * repeats > 50 * n
        chars = min(distance(shares(r["char_bins"]), q) for q in means["char_bins"])
        common = min(distance(shares(r["common_bins"]), q) for q in means["common_bins"])
        assert abs(chars - r["char_distance"]) < 1e-9 and abs(common - r["common_distance"]) < 1e-9
        both = n >= limits.both_words and chars > limits.both_char_distance and common > limits.both_common_distance
        assert r["base_failed"] == failed
        assert r["kept"] == (not failed and not (n >= limits.char_words and chars > limits.char_distance) and not both)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    clean = [r["kept"] for r in rows if labels.get(r["doc_id"]) == 1 and not r["base_failed"]]
    assert all(clean)


def test_quality_with_a_further_label_and_a_label_of_junk(spark, folder):
    r = random.Random(5)
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    before = {x["doc_id"]: x["kept"] for x in quality.judged(docs).collect()}
    stems = [a + b + c for a in "bdgkmprstw" for b in "aeiou" for c in ("sk", "rz", "ny", "lo", "wi", "ch")]
    polish = [" ".join(r.choice(["w", "i", "na", "z", "do", "nie"]) if r.random() < 0.3 else r.choice(stems) for _ in range(150)) for _ in range(40)]
    junk = " ".join(f"#{r.randrange(10**6)}|X{r.randrange(10**6)}" for _ in range(150))
    mild = " ".join(r.choice("AEIOUBDG") + r.choice("KLMN") + r.choice(stems) + r.choice(stems) for _ in range(150))
    rows = [(10**6 + i, t, "pl") for i, t in enumerate(polish)] + [(2 * 10**6, junk, "zz"), (2 * 10**6 + 1, mild, "de")]
    found = {x["doc_id"]: x["kept"] for x in quality.judged(docs.unionByName(spark.createDataFrame(rows, docs.schema))).collect()}
    assert all(found[10**6 + i] for i in range(40))
    assert not found[2 * 10**6] and not found[2 * 10**6 + 1]
    assert {d: k for d, k in found.items() if d < 10**6} == before


def test_quality_of_odd_rows(odd_docs, no_docs):
    rows = quality.judged(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(r["base_failed"] for r in rows if r["n_words"] == 0)
    assert quality.judged(no_docs).count() == 0


# op 5


def test_word_ids_are_those_of_the_library(folder, odd_texts):
    file = public_tokenizers.path("word_bpe_49k.json")
    own, library, r = packing.encoder(file), Tokenizer.from_file(file), random.Random(2)
    signs = list("aÉé .,'\n\t12!\x1c\x85  Σs|<>́")
    texts = ["a<|endoftext|> b<|startoftext|>", "don't we'll", "İ ﬁ ΑΣ ΣΑΣ", *[t or "" for t in odd_texts if len(t or "") < 9999]]
    texts += ["".join(r.choice(signs) for _ in range(r.randint(0, 20))) for _ in range(1000)] + texts_in(folder)[:60]
    for text in texts:
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def check_packing(rows, most):
    fill = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == fill.get(r["sequence_id"], 0)
        fill[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(fill.values(), default=0) <= most
    return fill


def test_packing_is_whole_and_tight(spark, odd_docs, no_docs):
    file = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(file)
    rows = packing.pack_documents(odd_docs, file).collect()
    fill = check_packing(rows, 2048)
    assert len(fill) == -(-sum(fill.values()) // 2048)
    ids = {r["doc_id"]: library.encode(r["text"] or "", add_special_tokens=False).ids + [0] for r in odd_docs.collect()}
    for r in rows:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["start"] == 2048 * r["piece"] and zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]
    assert Counter((r["doc_id"], r["piece"]) for r in rows) == Counter(
        (r["doc_id"], p) for r in odd_docs.collect() for p in range(-(-len(ids[r["doc_id"]]) // 2048))
    )
    assert packing.pack_documents(no_docs, file).count() == 0


def test_packing_in_rounds(spark):
    r = random.Random(4)
    items = spark.createDataFrame([(i, r.choice([3, 40, 55, 60, 70])) for i in range(900)], "doc_id long, length long")
    rows = packing.pack(items, most=100, block=50).collect()
    assert len({r["doc_id"] for r in rows}) == len(rows) == 900
    check_packing(rows, 100)


def test_search_empties_bins_and_raises_squares():
    r = random.Random(5)
    better = 0
    for _ in range(200):
        lengths = np.array([r.randint(5, 70) for _ in range(r.randint(1, 40))])
        start = np.arange(len(lengths)) % max(1, -(-int(lengths.sum()) // 70))  # any packing, made valid below
        start = packing.best_fit(lengths, 100) if np.bincount(start, lengths).max() > 100 else start
        search = packing.Search(lengths, start, 100)
        found = search.run()
        fill = lambda bins: np.bincount(bins, lengths)
        assert fill(found).max() <= 100 and fill(found).sum() == lengths.sum()
        assert (fill(found) ** 2).sum() >= (fill(start) ** 2).sum()
        better += (fill(found) > 0).sum() < (fill(start) > 0).sum()
    assert better > 10


# op 6


def test_language_model_matches_a_plain_one(spark):
    docs = spark.createDataFrame([(1, "ab ab", "x"), (2, "cd", "y"), (3, "ba", "x"), (4, None, "x"), (5, "q", None)], "doc_id long, text string, lang string")
    model = langid.learn(docs)
    assert model.languages == ("x", "y")

    def plain(text):
        out = Counter()
        padded = f" {''.join(c if c.isalpha() else ' ' for c in text.lower())} "
        for n in range(1, 5):
            for i in range(len(padded) - n + 1):
                g = padded[i : i + n]
                inner = g.strip() != "" if n <= 2 else " " not in g[1:-1]
                if n == 1 and g == " ":
                    continue
                if inner:
                    out[g] += 1
        return out

    bucket = lambda g: int(next(b for k, (b, _) in enumerate(langid.grams([g], len(g))) if k == len(g) - 1)[0]) if " " not in g else None
    grams = plain("ab ba")
    assert sum(len(b) for b, _ in langid.grams(["ab ba"])) == sum(grams.values())
    assert bucket("ab") is not None
    assert model.predict(["ab", "cd", "12", ""])[0] == ["x", "y", "und", "und"]
    scores = model.predict(["ab", "cd", "12"])[1]
    assert scores[0] > 0.9 and scores[2] == 0 and all(0 <= s <= 1 for s in scores)
    both = [np.log(p) + sum(model.logs[k][b].sum() for b, _ in langid.grams(["ab"])) for k, p in enumerate((2 / 3, 1 / 3))]
    assert abs(scores[0] - 1 / (1 + math.exp(both[1] - both[0]))) < 1e-12


def test_held_out_accuracy(spark, folder):
    rows = langid.op6_language_id(spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id").collect()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    held = [r["lang"] == r["lang_pred"] for r in rows if r["held_out"] and r["lang"] and len(r["text"]) > 50]
    assert sum(held) >= 0.95 * len(held) > 0


def test_language_of_odd_rows(odd_docs, no_docs):
    model = langid.learn(odd_docs)
    rows = langid.identify(odd_docs, model).collect()
    assert len(rows) == odd_docs.count()
    empty = langid.learn(no_docs)
    assert {r["lang_pred"] for r in langid.identify(odd_docs, empty).collect()} == {"und"}
    assert langid.identify(no_docs, model).count() == 0


# op 9


ODD = ["", " ", "  a", "a  b ", "\n", "▁a", "ﬁx é 日本 \x00 ​", "a　b", "    x\t\ty", "<s> </s> <0x0A>",
       "don't we'll they've x'r 'll", "a<|endoftext|> b <|endoftext|>c", "12 34,5!!  \n\n x", "tab\tx\r\ny\x1cz\x85q", "h   w\n  foo"]


def test_totals_and_prefix_counts(folder, odd_texts):
    file = public_tokenizers.path("byte_bpe_50k.json")
    own, library = counts.counter(file), Tokenizer.from_file(file)
    many = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    for text in [*ODD, *texts_in(folder)[:80], *[t or "" for t in odd_texts]]:
        assert own.total(text) == many(text), text[:80]
    for text in [*ODD, *[t[:250] for t in texts_in(folder)[:10]]]:
        assert own.prefixes(text) == [many(text[:i]) for i in range(len(text) + 1)], text


def test_budget_needs_no_second_encoding(folder):
    own = counts.counter(public_tokenizers.path("byte_bpe_50k.json"))
    for text in [*texts_in(folder)[:20], *ODD]:
        for budget in (0, 1, 7, 50):
            place = own.within(text, budget)
            assert own.total(text[:place]) <= budget or "<|endoftext|>" in text
            if own.total(text) <= budget:
                assert place == len(text)


def test_counts_of_odd_rows(odd_docs, no_docs):
    file = public_tokenizers.path("byte_bpe_50k.json")
    rows = counts.token_counts(odd_docs, file, 10).collect()
    assert len(rows) == odd_docs.count()
    assert all(r["over_limit"] == (r["n_tokens"] > 10) for r in rows)
    assert counts.token_counts(no_docs, file, 10).count() == 0


# op 10


def test_pieces_are_those_of_the_library(spark, folder, odd_docs, no_docs, odd_texts):
    file = public_tokenizers.path("piece_bpe_32k.model")
    own, library = pieces.coder(file), sentencepiece.SentencePieceProcessor(model_file=file)
    r = random.Random(6)
    signs = list("aethi ▁\n\t.1éß日\x00\U0001f600")
    made = ["".join(r.choice(signs) for _ in range(r.randint(0, 25))) for _ in range(2000)]
    for text in [*ODD, *made, *texts_in(folder)[:80]]:
        ids = library.encode(text)
        assert own.encode(text) == ids and own.decode(ids) == library.decode(ids), text
    rows = {r["doc_id"]: r for r in pieces.piece_digests(odd_docs, file).collect()}
    for i, text in enumerate(odd_texts):
        if i in rows and i < 20:
            ids = library.encode(text or "", add_eos=True)
            assert rows[i]["n_tokens"] == len(ids)
            assert rows[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
            assert rows[i]["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    whole = {r["doc_id"]: r for r in pieces.encode_texts(odd_docs, file).collect()}
    assert all(whole[i]["decoded"] == library.decode(library.encode(t or "")) for i, t in enumerate(odd_texts) if i < 12)
    assert pieces.piece_digests(no_docs, file).count() == 0
