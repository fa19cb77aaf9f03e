"""Quality rules by distribution divergence.

Each text is reduced to two histograms, of character classes and of common words, and compared with
the reference histograms of languages by Jensen-Shannon distance (base 2, so 0 to 1). References are
computed from the corpus itself: per language, the mean histogram of all its texts that pass the base
rules. Character classes alone are judged from ``min_chars`` word characters on, both histograms
together from ``min_words`` words on; shorter texts give too coarse a histogram and pass.

Languages with a word list have references of both kinds, and their texts are held against the nearest of
these. Any other label of at least ``min_texts`` such texts has a reference of character classes; its texts
are held against that one too, by character classes alone.

Defined results: a null or empty text has no words and fails the base rules; where the
language is null or has no reference (in an empty table, or where no text of it passes the base rules)
only the base rules count. Equal
rows are judged alike; other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from sensorloom.llm.common import written

# Frequent words of each language.
COMMON_WORDS = {
    "en": "the of and to in is it that for as was with by be this on are from or an at not a",
    "fr": "le la les de des du et en un une est que qui dans pour par sur pas au avec ce plus se",
    "de": "der die das und in zu den von mit ist des im sich auf dem ein eine nicht als für es an auch",
    "es": "el la los las de y en que un una del se por con para no es su lo al como más o",
}
# Characters of each class; what is not listed is one of the classes named after it.
SYMBOLS = b"#*$%&|<>"
SENTENCE = b".,;:?!'\"-"
CLASSES = ("lower", "upper", "digit", "sentence", "symbol", "other_ascii", "two_bytes", "more_bytes")
WINDOW = 8
FEATURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "classes array<long>, common array<array<long>>"
)


@dataclass(frozen=True)
class Limits:
    """A text of ``min_chars`` word characters is rejected above ``class_distance``, one of
    ``min_words`` words where both distances are above ``both_class`` and ``both_word``."""

    least_words: int = 20
    repeat_percent: int = 30
    min_chars: int = 500
    class_distance: float = 0.25
    min_words: int = 50
    both_class: float = 0.13
    both_word: float = 0.26
    min_texts: int = 20


def _class_of_byte() -> np.ndarray:
    """Index into CLASSES for bytes that begin a character in a word, else the number of classes."""
    of = np.full(256, len(CLASSES))
    for byte in range(256):
        char = bytes([byte])
        if char.isspace() or 0x80 <= byte < 0xC0:
            continue
        if char.islower():
            name = "lower"
        elif char.isupper():
            name = "upper"
        elif char.isdigit():
            name = "digit"
        elif char in SENTENCE:
            name = "sentence"
        elif char in SYMBOLS:
            name = "symbol"
        elif byte < 0x80:
            name = "other_ascii"
        else:
            name = "two_bytes" if byte < 0xE0 else "more_bytes"
        of[byte] = CLASSES.index(name)
    return of


CLASS_OF_BYTE = _class_of_byte()
SYMBOL_CLASS = CLASSES.index("symbol")
WORD_INDEX = {
    lang: {word.encode(): i for i, word in enumerate(words.split())} for lang, words in COMMON_WORDS.items()
}
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def _next_ranks(ranks: np.ndarray, step: int) -> np.ndarray:
    """Numbers that are equal where both the run at i and the run at i + step are."""
    pairs = ranks[:-step] * (int(ranks.max()) + 1) + ranks[step:]
    return np.unique(pairs, return_inverse=True)[1]


def repeated_words(words: list[bytes]) -> int:
    """Words inside runs of WINDOW words that occur twice or more; the first run counts too."""
    n = len(words)
    if n <= WINDOW:
        return 0
    run = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    for level, mix in enumerate(MIX):
        step = 1 << level
        run = run[:-step] * mix + run[step:]
    run.sort()
    if not (run[1:] == run[:-1]).any():
        return 0
    seen: dict[bytes, int] = {}
    ranks = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    for level in range(len(MIX)):  # exact, unlike the hashes above
        ranks = _next_ranks(ranks, 1 << level)
    repeats = np.bincount(ranks)[ranks] > 1
    edges = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(repeats)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + WINDOW, -1)
    return int((np.cumsum(edges[:n]) > 0).sum())


def _features(text: str | None) -> dict:
    data = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""
    words = data.split()
    counts = np.bincount(
        CLASS_OF_BYTE, np.bincount(np.frombuffer(data, np.uint8), minlength=256), len(CLASSES) + 1
    ).astype(np.int64)[:-1]
    lines = [line for line in data.split(b"\n") if line.strip()]
    small = data.lower().split()
    common = []
    for index in WORD_INDEX.values():
        found = [index[w] for w in small if w in index]
        histogram = np.bincount(np.array(found, np.int64), minlength=len(index) + 1)
        histogram[-1] = len(small) - len(found)
        common.append(histogram)
    return {
        "n_words": len(words),
        "word_chars": int(counts.sum()),
        "n_symbols": int(counts[SYMBOL_CLASS]),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": repeated_words(words),
        "classes": counts,
        "common": common,
    }


def features(text: Column) -> Column:
    """The struct of features of each text."""

    @F.pandas_udf(FEATURES)
    def of(texts: pd.Series) -> pd.DataFrame:
        names = [c.split()[0] for c in FEATURES.split(", ")]
        return pd.DataFrame([_features(t) for t in texts], columns=names)

    return of(text)


def base_failed(f: Column, limits: Limits) -> Column:
    return (f["n_words"] < limits.least_words) | (
        100 * f["n_repeat_words"] > limits.repeat_percent * f["n_words"]
    )


def _shares(histogram: Column) -> Column:
    total = F.aggregate(histogram, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return F.transform(histogram, lambda x: x / F.greatest(total, F.lit(1)))


def references(judged: DataFrame, limits: Limits) -> list[tuple[str, list[float], list[float]]]:
    """Mean histograms of each language's texts that pass the base rules: language, classes, words.

    ``judged`` has ``lang`` and ``f``. Only languages with a word list have one, so the result is small.
    """
    good = judged.where(F.col("lang").isin(*COMMON_WORDS) & ~base_failed(F.col("f"), limits))
    order = list(COMMON_WORDS)
    shares = good.select(
        "lang",
        _shares(F.col("f.classes")).alias("classes"),
        _shares(F.get(F.col("f.common"), F.array_position(F.array(*map(F.lit, order)), F.col("lang")).cast("int") - 1)).alias("words"),
    )
    width = max(len(w) for w in WORD_INDEX.values()) + 1
    means = [F.avg(F.get("classes", F.lit(i))).alias(f"c{i}") for i in range(len(CLASSES))]
    means += [F.avg(F.get("words", F.lit(i))).alias(f"w{i}") for i in range(width)]
    rows = shares.groupBy("lang").agg(*means).orderBy("lang").collect()
    return [
        (
            r["lang"],
            [r[f"c{i}"] for i in range(len(CLASSES))],
            [r[f"w{i}"] for i in range(len(WORD_INDEX[r["lang"]]) + 1)],
        )
        for r in rows
    ]


def class_references(judged: DataFrame, limits: Limits) -> DataFrame:
    """own_lang, own_classes: mean class histogram of each label without a word list."""
    good = judged.where(~F.col("lang").isin(*COMMON_WORDS) & ~base_failed(F.col("f"), limits))
    shares = good.select(F.col("lang").alias("own_lang"), _shares(F.col("f.classes")).alias("classes"))
    means = [F.avg(F.get("classes", F.lit(i))).alias(f"c{i}") for i in range(len(CLASSES))]
    rows = shares.groupBy("own_lang").agg(F.count("*").alias("n"), *means).where(F.col("n") >= limits.min_texts)
    return rows.select("own_lang", F.array(*[f"c{i}" for i in range(len(CLASSES))]).alias("own_classes"))


def js_distance(shares: Column, reference: list[float] | Column) -> Column:
    """Jensen-Shannon distance between an array of shares and a distribution."""
    if isinstance(reference, list):
        reference = F.array(*[F.lit(float(x)) for x in reference])

    def part(p: Column, m: Column) -> Column:
        return F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)

    def both(p: Column, q: Column) -> Column:
        middle = (p + q) / 2
        return part(p, middle) + part(q, middle)

    terms = F.zip_with(shares, reference, both)
    divergence = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2
    return F.sqrt(F.greatest(divergence, F.lit(0.0)))


def judged(docs: DataFrame) -> DataFrame:
    """``docs`` with the struct ``f`` of features."""
    return docs.withColumn("f", features(F.col("text")))


def with_verdict(rows: DataFrame, refs: list, own: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``rows`` (with ``lang`` and ``f``) with base_failed, class_distance, word_distance and kept.

    The distances are those to the reference that is nearest over all, or by classes to the one of the
    text's own label in ``own``, which has no word distance.
    """
    order = list(COMMON_WORDS)
    rows = rows.withColumn("base_failed", base_failed(F.col("f"), limits))
    rows = rows.join(F.broadcast(own), F.col("lang") == F.col("own_lang"), "left")
    own_class = F.when(
        F.col("own_classes").isNotNull(), js_distance(_shares(F.col("f.classes")), F.col("own_classes"))
    )
    pairs = [
        F.struct(
            js_distance(_shares(F.col("f.classes")), classes).alias("class"),
            js_distance(_shares(F.get("f.common", F.lit(order.index(lang)))), words).alias("word"),
        )
        for lang, classes, words in refs
    ]
    nearest = F.lit(None).cast("struct<sum: double, class: double, word: double>")
    if pairs:
        ranked = F.array_sort(
            F.transform(
                F.array(*pairs), lambda p: F.struct((p["class"] + p["word"]).alias("sum"), p["class"], p["word"])
            )
        )
        nearest = F.get(ranked, F.lit(0))
    rows = rows.withColumns({"nearest": nearest, "own_class": own_class})
    by_words = F.coalesce(F.col("lang").isin(*[lang for lang, _, _ in refs]), F.lit(False)) if refs else F.lit(False)
    by_own = F.col("own_class").isNotNull() & (F.col("nearest").isNull() | (F.col("own_class") < F.col("nearest.class")))
    long = F.col("f.word_chars") >= limits.min_chars
    strange = (
        F.when(
            by_words,
            (long & (F.col("nearest.class") > limits.class_distance))
            | (
                (F.col("f.n_words") >= limits.min_words)
                & (F.col("nearest.class") > limits.both_class)
                & (F.col("nearest.word") > limits.both_word)
            ),
        )
        .when(
            F.col("own_class").isNotNull(),
            long & (F.least("own_class", F.col("nearest.class")) > limits.class_distance),
        )
        .otherwise(False)
    )
    return rows.withColumns(
        {
            "class_distance": F.when(by_own, F.col("own_class")).otherwise(F.col("nearest.class")),
            "word_distance": F.when(~by_own, F.col("nearest.word")),
            "kept": ~F.col("base_failed") & ~strange,
        }
    ).drop("nearest", "own_class", "own_lang", "own_classes")


def verdicts(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """doc_id, the features of the base rules, the distances and the verdict of every row."""
    rows = written(judged(docs.select("doc_id", "lang", "text")).drop("text"), "quality-features")
    done = with_verdict(rows, references(rows, limits), class_references(rows, limits), limits)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return done.select(
        "doc_id", *[F.col(f"f.{n}").alias(n) for n in names], "base_failed", "kept", "class_distance", "word_distance"
    )


def kept_documents(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` that the rules keep, unchanged."""
    slim = docs.select(F.col("lang"), features(F.col("text")).alias("f"))
    seen = written(slim, "quality-features")
    refs = references(seen, limits)
    packed = docs.select(F.struct(*docs.columns).alias("doc"), "lang", "text")  # no clash with other columns
    return with_verdict(judged(packed), refs, class_references(seen, limits), limits).where("kept").select("doc.*")
