"""Quality rules in DataFrame functions: base counts and distribution divergence.

A document's histograms of character classes and of common words are compared
with references of each language by the Jensen-Shannon distance (base 2,
0 to 1); the nearest language counts, so a wrong or missing label does no harm.
The rule on both histograms takes both distances to one language, that with the
least sum. Common words are learned by label from all documents that are long
enough; references are means over all documents that pass the base rules, for
labels with a minimum number of these. Short texts are not judged by a distance:
each histogram has a minimum number of words.

Null and empty texts have no words and fail the base rules. Without any
reference (an empty table, no label with enough documents) only the base rules hold. Of more than
100 labels those with the most documents are references (`MOST_LANGUAGES`); texts in a
language of another label are measured against these. Repeated rows count as often as they occur.

A column with the name of a result is replaced by it.

Three-word windows are compared by 64-bit hashes within one document.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulwright.llm.common import stored, table, unused

SPACE = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Most common words of each language that are bins of the histogram.
COMMON_WORDS = 4
#: Labels that references are kept for at most, as they are literals of the plan: those with the most documents.
MOST_LANGUAGES = 100


@dataclass(frozen=True)
class Limits:
    """Thresholds: minimum words and largest distances, of characters alone and of both histograms together."""

    least_words: int = 50
    least_documents: int = 10  # of a label, to be a reference
    repeat_percent: int = 50
    char_words: int = 50
    char_distance: float = 0.24
    both_words: int = 80
    both_char_distance: float = 0.11
    both_common_distance: float = 0.16


RESULTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "char_bins", "common_bins",
    "base_failed", "char_distance", "common_distance", "kept",
)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _repeated(words: Column) -> Column:
    """Words in three-word windows that occur twice or more."""

    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda p, k: F.when(k == 0, 3).otherwise(F.least(F.lit(3), p - F.get(places, k - 1))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, s: a + s)

    def marked(pairs: Column) -> Column:
        same = lambda s, other: F.coalesce(s["h"] == other["h"], F.lit(False))
        places = F.transform(
            pairs, lambda s, k: F.when(same(s, F.get(pairs, k - 1)) | same(s, F.get(pairs, k + 1)), s["i"])
        )
        return let(F.sort_array(F.filter(places, lambda p: p.isNotNull())), covered)

    def counted(hashes: Column) -> Column:
        pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        none = F.size(F.array_distinct(hashes)) == F.size(hashes)
        return F.when(none, F.lit(0).cast("long")).otherwise(let(F.sort_array(pairs), marked))

    windows = F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)),
    )
    return let(windows, counted)


def _words(plain: Column) -> Column:
    return F.filter(F.split(plain, SPACE), lambda w: w != "")


def common_words(docs: DataFrame, limits: Limits, text: str = "text", lang: str = "lang") -> tuple[str, ...]:
    """The most common words of each label with enough documents, by their mean share of a document's words."""
    labels = docs.where(F.col(lang).isNotNull()).groupBy(lang).count().where(F.col("count") >= limits.least_documents)
    labels = labels.orderBy(F.desc("count"), lang).limit(MOST_LANGUAGES)
    labels = [r[0] for r in labels.select(lang).collect()]
    if not labels:
        return ()
    rows = docs.where(F.col(lang).isin(labels)).select(F.col(lang).alias("lang"), _words(F.coalesce(F.col(text), F.lit(""))).alias("words"))
    rows = rows.where(F.size("words") >= limits.least_words)
    # Whole numbers, so that the order of adding up makes no difference.
    rows = rows.select("lang", F.explode("words").alias("word"), F.expr("1000000000 div size(words)").alias("share"))
    shares = rows.groupBy("lang", "word").agg(F.sum("share").alias("share")).where("word rlike '\\\\p{L}'")
    order = Window.partitionBy("lang").orderBy(F.desc("share"), "word")
    top = shares.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= COMMON_WORDS)
    return tuple(sorted({r[0] for r in top.select("word").collect()}))


def measures(docs: DataFrame, text: str = "text", common: tuple[str, ...] = ()) -> DataFrame:
    """All columns of the rows, base counts, and the two histograms (char_bins, common_bins)."""
    plain = F.coalesce(F.col(text), F.lit(""))
    less = lambda pattern: F.length(plain) - F.length(F.regexp_replace(plain, pattern, ""))
    symbols = sum((F.octet_length(plain) - F.octet_length(F.replace(plain, F.lit(c), F.lit(""))) for c in SYMBOLS), F.lit(0))
    lines = F.filter(F.split(plain, "\n"), lambda line: F.length(F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))) > 0)
    doubled = let(lines, lambda ls: F.size(ls) - F.size(F.array_distinct(ls)))
    words = _words(plain)

    def of_words(ws: Column) -> Column:
        hits = F.filter(ws, lambda w: w.isin(*common))
        bins = let(
            hits,
            lambda hs: F.concat(
                F.transform(F.array(*map(F.lit, common)).cast("array<string>"), lambda c: F.size(F.filter(hs, lambda w: w == c)).cast("long")),
                F.array((F.size(ws) - F.size(hs)).cast("long")),
            ),
        )
        return F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.length(F.array_join(ws, "")).cast("long").alias("word_chars"),
            _repeated(ws).alias("n_repeat_words"),
            bins.alias("common_bins"),
        )

    helpers = {name: unused(name, docs.columns) for name in ("w", "chars", "upper", "digit", "mark")}
    counted = docs.drop(*RESULTS).select(
        "*",
        let(words, of_words).alias(helpers["w"]),
        symbols.cast("long").alias("n_symbols"),
        doubled.cast("long").alias("n_dup_lines"),
        F.length(plain).cast("long").alias(helpers["chars"]),
        less("\\p{Lu}+").cast("long").alias(helpers["upper"]),
        less("[0-9]+").cast("long").alias(helpers["digit"]),
        less("[.,;:!?'\"()-]+").cast("long").alias(helpers["mark"]),
    ).select("*", f"{helpers['w']}.*")
    space = F.col(helpers["chars"]) - F.col("word_chars")
    rest = F.col("word_chars") - F.col(helpers["upper"]) - F.col(helpers["digit"]) - F.col(helpers["mark"]) - F.col("n_symbols")
    bins = F.array(F.col(helpers["upper"]), F.col(helpers["digit"]), F.col(helpers["mark"]), F.col("n_symbols"), space, rest)
    return counted.withColumn("char_bins", bins).drop(*helpers.values())


def base_failed(limits: Limits) -> Column:
    repeats = F.col("n_repeat_words") * 100 > F.col("n_words") * limits.repeat_percent
    return (F.col("n_words") < limits.least_words) | repeats


def _shares(bins: Column) -> Column:
    return let(F.aggregate(bins, F.lit(0.0), lambda a, b: a + b), lambda t: F.transform(bins, lambda b: b / F.greatest(t, F.lit(1.0))))


def references(measured: DataFrame, limits: Limits, common: tuple[str, ...], lang: str = "lang") -> dict[str, dict[str, list[float]]]:
    """Mean shares of each histogram by label, over all rows that pass the base rules, of labels with enough of them."""
    sizes = {"char_bins": 6, "common_bins": len(common) + 1}
    good = measured.where(F.col(lang).isNotNull() & ~base_failed(limits))
    shares = good.select(lang, *(_shares(F.col(b)).alias(b) for b in sizes))
    means = [F.avg(F.col(b)[k]).alias(f"{b}_{k}") for b, n in sizes.items() for k in range(n)]
    means_of = shares.groupBy(lang).agg(F.count(F.lit(1)).alias("n"), *means).where(F.col("n") >= limits.least_documents)
    rows = means_of.orderBy(F.desc("n"), lang).limit(MOST_LANGUAGES).drop("n").collect()
    return {b: {r[0]: [r[f"{b}_{k}"] for k in range(n)] for r in sorted(rows)} for b, n in sizes.items()}


def _distance(shares: Column, reference: list[float]) -> Column:
    """Jensen-Shannon distance of shares to a reference."""
    term = lambda p, m: F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)
    q = F.array(*(F.lit(float(v)) for v in reference))
    terms = F.zip_with(shares, q, lambda p, r: (term(p, (p + r) / 2) + term(r, (p + r) / 2)) / 2)
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, t: a + t), F.lit(0.0)))


def nearest(bins: str, by_lang: dict[str, list[float]]) -> Column:
    """Distance to the nearest reference; null without any."""
    if not by_lang:
        return F.lit(None).cast("double")
    return let(_shares(F.col(bins)), lambda s: F.array_min(F.array(*(_distance(s, r) for r in by_lang.values()))))


def far_from_one(limits: Limits, found: dict[str, dict[str, list[float]]]) -> Column:
    """Whether both histograms are far from those of one language, that with the least sum of distances."""
    if not found["char_bins"]:
        return F.lit(False)

    def of_both(s: Column) -> Column:
        pairs = []
        for lang, reference in found["char_bins"].items():
            char, common = _distance(s["c"], reference), _distance(s["w"], found["common_bins"][lang])
            pairs.append(let(F.struct(char.alias("c"), common.alias("w")), lambda d: F.struct((d["c"] + d["w"]).alias("sum"), d["c"].alias("c"), d["w"].alias("w"))))
        far = lambda d: (d["c"] > limits.both_char_distance) & (d["w"] > limits.both_common_distance)
        return let(F.array_min(F.array(*pairs)), far)

    return let(F.struct(_shares(F.col("char_bins")).alias("c"), _shares(F.col("common_bins")).alias("w")), of_both)


def judged(
    docs: DataFrame, limits: Limits = Limits(), text: str = "text", lang: str = "lang", keep_text: bool = False
) -> DataFrame:
    """All columns (the text if asked for), base counts, distances, base_failed and kept.

    Common words are learned in a first pass over the texts. Base counts and
    histograms are computed in a second one and written to the shared folder; references and verdicts come from there.
    """
    common = common_words(docs, limits, text, lang)
    measured = measures(docs, text, common)
    measured = stored(measured if keep_text else measured.drop(text), "quality")
    found = references(measured, limits, common, lang)
    both = unused("both", measured.columns)
    with_distance = measured.select(
        "*",
        base_failed(limits).alias("base_failed"),
        nearest("char_bins", found["char_bins"]).alias("char_distance"),
        nearest("common_bins", found["common_bins"]).alias("common_distance"),
        far_from_one(limits, found).alias(both),
    )
    far = lambda name, most: F.coalesce(F.col(name) > most, F.lit(False))
    far_alone = (F.col("n_words") >= limits.char_words) & far("char_distance", limits.char_distance)
    off = far_alone | ((F.col("n_words") >= limits.both_words) & F.col(both))
    return with_distance.withColumn("kept", ~F.col("base_failed") & ~off).drop(both)


def op2_divergence(spark, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return judged(documents).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("char_distance", 6).alias("char_distance"), F.round("common_distance", 6).alias("common_distance"),
    )
