"""Benchmark decontamination by winnowing.

Of the ``k``-gram hashes of a text, winnowing keeps the least one in each run of ``w`` neighbours. Any
two texts that share ``window = k + w - 1`` consecutive words then keep a hash in common, so a join of
the kept fingerprints finds every shared window. Each hit is extended around its anchor, word by word,
which settles exactly which words lie in a shared window. Items shorter than a window are one window
of their own length; winnowing gives them no guarantee, so their whole hash is looked for among all
grams of that length instead. Everything is a DataFrame expression.

Defined results: a null text has no words, nor has an empty one: nothing is hit. Items without words
are ignored, items with equal texts all count, and rows with equal or null ids are each judged by
their own text. Empty tables give no rows, or rows without hits. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sensorloom.llm.common import ascii_lower, discard, let, row_of, written

# Fixed value: what separates words (letters, digits and everything beyond ASCII form words).
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 10
GRAM = 4


def raw_words(text: Column) -> Column:
    """Words in order, letters as they are."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS, -1), "")


def words_of(text: Column) -> Column:
    """Words in order, A-Z in lower case."""
    return F.transform(raw_words(text), ascii_lower)


def folded_words(text: Column) -> Column:
    """Words in order, every letter in lower case: equal wherever ``words_of`` is equal.

    Lower-casing a whole text at once is much the cheapest; it serves to find candidates. The
    one letter whose lower case depends on its neighbours is mapped first.
    """
    return raw_words(F.lower(F.replace(text, F.lit("\u03a3"), F.lit("\u03c3"))))


def _starts(length: Column, size: int) -> Column:
    """0-based starts of all runs of ``size`` elements (none when there are fewer)."""
    return F.when(length >= size, F.sequence(F.lit(0), length - size)).otherwise(
        F.array().cast("array<int>")
    )


def gram_hashes(words: Column, size: int) -> Column:
    """Hash of each run of ``size`` words."""

    def of(hashes: Column) -> Column:
        def gram(i: Column) -> Column:
            return F.xxhash64(*[F.get(hashes, i + j) for j in range(size)])

        return F.transform(_starts(F.size(hashes), size), gram)

    return let(F.transform(words, lambda w: F.xxhash64(w)), of)


def kept_hashes(hashes: Column, w: int) -> Column:
    """The distinct least hashes of all runs of ``w`` neighbours."""

    def of(h: Column) -> Column:
        def least(i: Column) -> Column:
            return F.least(*[F.get(h, i + j) for j in range(w)])

        return F.array_distinct(F.transform(_starts(F.size(h), w), least))

    return let(hashes, of)


def text_key(text: Column) -> Column:
    """Equal texts are judged once and share the verdict."""
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def benchmark_grams(items: DataFrame, window: int, gram: int) -> tuple[DataFrame, list[int]]:
    """Anchors of the items, written: size, hash, item_id, length, and the words around the anchor.

    ``around`` holds the item's words from ``lead`` words before the anchor on, as far as a window
    that holds the anchor can reach. Also returns the lengths of items shorter than a window, of
    which there are fewer than ``window``.
    """
    items = items.select(
        "item_id", words_of(F.col("text")).alias("words"), folded_words(F.col("text")).alias("folded")
    )
    items = written(items.where(F.size("words") > 0), "items")
    w = window - gram + 1
    whole = items.where(F.size("words") >= window).withColumn("hashes", gram_hashes(F.col("folded"), gram))
    whole = whole.withColumn("kept", kept_hashes(F.col("hashes"), w))
    whole = whole.select("item_id", "words", "kept", F.posexplode("hashes").alias("q", "hash"))
    whole = whole.where(F.array_contains("kept", F.col("hash")))
    lead = F.least(F.col("q"), F.lit(w - 1))
    whole = whole.select(
        F.lit(gram).alias("size"),
        "hash",
        F.col("item_id").cast("string").alias("item_id"),
        F.lit(window).alias("length"),
        lead.alias("lead"),
        F.slice("words", F.col("q") - lead + 1, lead + window).alias("around"),
    )
    size = F.size("words")
    brief = items.where(size < window).select(
        size.alias("size"),
        F.get(whole_hash(F.col("folded"), window), F.lit(0)).alias("hash"),
        F.col("item_id").cast("string").alias("item_id"),
        size.alias("length"),
        F.lit(0).alias("lead"),
        F.col("words").alias("around"),
    )
    anchors = written(whole.unionByName(brief), "item-anchors")
    brief_sizes = anchors.where(F.col("length") < window).select("length").distinct()
    return anchors, sorted(r["length"] for r in brief_sizes.collect())


def whole_hash(words: Column, window: int) -> Column:
    """As ``gram_hashes`` with the number of words as size, where that is below a window."""
    cases = F.lit(None).cast("array<bigint>")
    for size in range(1, window):
        cases = F.when(F.size(words) == size, gram_hashes(words, size)).otherwise(cases)
    return cases


def fingerprints(words: Column, sizes: list[int], window: int, gram: int) -> Column:
    """Distinct (size, hash) of a text: its winnowed grams, and all grams of the given sizes."""

    def of(folded: Column) -> Column:
        kept = kept_hashes(gram_hashes(folded, gram), window - gram + 1)
        parts = [F.transform(kept, lambda h: F.struct(F.lit(gram).alias("size"), h.alias("hash")))]
        for size in sizes:
            grams = F.array_distinct(gram_hashes(folded, size))
            parts.append(_sized(grams, size))
        return parts[0] if len(parts) == 1 else F.array_distinct(F.concat(*parts))

    return let(words, of)


def _sized(hashes: Column, size: int) -> Column:
    return F.transform(hashes, lambda h: F.struct(F.lit(size).alias("size"), h.alias("hash")))


def _with_places(words: Column, anchors: Column, size: int) -> Column:
    """``anchors`` with the 0-based places of their hash among the grams of ``words``."""

    def place(hashes: Column) -> Column:
        def of(anchor: Column) -> Column:
            spots = F.transform(hashes, lambda x, i: F.when(x == anchor["hash"], i))
            return F.struct(
                anchor["item_id"].alias("item_id"),
                anchor["length"].alias("length"),
                anchor["lead"].alias("lead"),
                anchor["around"].alias("around"),
                F.filter(spots, lambda i: i.isNotNull()).alias("places"),
            )

        return F.transform(anchors, of)

    return let(gram_hashes(words, size), place)


def _hit_places(words: Column, anchors: Column) -> Column:
    """Per anchor and place of its hash in the text: the item, and the hit word places.

    An anchor has ``places`` (0-based places of its hash in this text), ``lead``, ``length`` and
    ``around``. Word j of ``around`` stands beside word ``place - lead + j`` of the text.
    """

    def in_text(words: Column) -> Column:
        def at_place(anchor: Column, place: Column) -> Column:
            start = place - anchor["lead"]

            def beside(word: Column, j: Column) -> Column:
                other = F.get(words, F.greatest(start + j, F.lit(0)))
                return (start + j >= 0) & F.coalesce(other == word, F.lit(False))

            def windows(same: Column) -> Column:
                spots = F.sequence(F.lit(0), F.size(same) - anchor["length"])
                return F.filter(
                    spots, lambda s: ~F.exists(F.slice(same, s + 1, anchor["length"]), lambda x: ~x)
                )

            full = let(F.transform(anchor["around"], beside), windows)
            return F.flatten(
                F.transform(full, lambda s: F.sequence(start + s, start + s + anchor["length"] - 1))
            )

        def of(anchor: Column) -> Column:
            hit = F.flatten(F.transform(anchor["places"], lambda p: at_place(anchor, p)))
            return F.struct(anchor["item_id"].alias("item_id"), F.array_distinct(hit).alias("hit"))

        return F.transform(anchors, of)

    return let(words, in_text)


def judged(docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, key, n_words) of all documents, and (key, hit, item_ids) of the texts hit.

    ``hit`` has the 0-based places of hit words, ``item_ids`` the items (as sorted strings).
    """
    anchors, sizes = benchmark_grams(items, window, gram)
    key = text_key(F.col("text"))
    prints = docs.select(
        "doc_id",
        key.alias("key"),
        folded_words(F.col("text")).alias("words"),
    ).select(
        "doc_id",
        "key",
        F.size("words").cast("long").alias("n_words"),
        fingerprints(F.col("words"), sizes, window, gram).alias("prints"),
    )
    prints = written(prints, "fingerprints")
    found = prints.select("key", F.explode("prints").alias("f")).select("key", "f.size", "f.hash")
    shared = found.join(anchors.select("size", "hash").distinct(), ["size", "hash"], "left_semi")
    shared = written(shared.distinct(), "shared-fingerprints")
    rows = written(prints.select("doc_id", "key", "n_words"), "word-counts")
    discard(prints)
    about = F.struct("size", "hash", "item_id", "length", "lead", "around")
    spread = shared.join(anchors, ["size", "hash"]).groupBy("key").agg(F.collect_set(about).alias("anchors"))
    # Each text travels once, copies collapse before the shuffle; a merge join at every size.
    texts = docs.groupBy(key.alias("key")).agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    texts = texts.join(written(spread, "anchors-by-text").hint("merge"), "key")
    texts = texts.select("key", "anchors", words_of(F.col("text")).alias("words"), folded_words(F.col("text")).alias("folded"))
    found = None
    for size in [gram, *[n for n in sizes if n != gram]]:
        of_size = F.filter("anchors", lambda a: a["size"] == F.lit(size))
        hits = _hit_places(F.col("words"), _with_places(F.col("folded"), of_size, size))
        found = hits if found is None else F.concat(found, hits)
    texts = texts.select("key", F.filter(found, lambda x: F.size(x["hit"]) > 0).alias("found"))
    hits = texts.where(F.size("found") > 0).select(
        "key",
        F.array_sort(F.array_distinct(F.flatten(F.transform("found", lambda x: x["hit"])))).alias("hit"),
        F.array_sort(F.array_distinct(F.transform("found", lambda x: x["item_id"]))).alias("item_ids"),
    )
    return rows, written(hits, "benchmark-hits")


def digest(rows: DataFrame, hits: DataFrame) -> DataFrame:
    """Per row: the numbers of words, hit words and items, and the digest of the item ids."""
    n_hit = F.coalesce(F.size("hit"), F.lit(0)).cast("long")
    ids = F.coalesce(F.col("item_ids"), F.array().cast("array<string>"))
    return rows.join(hits, "key", "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``docs`` without the rows whose text shares a window with an item."""
    _, hits = judged(docs, items, window, gram)
    packed = docs.select(row_of(docs), text_key(F.col("text")).alias("key"))
    return packed.join(hits.select("key"), "key", "left_anti").select("row.*")
