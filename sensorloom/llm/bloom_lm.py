"""Language-model scores from a log-frequency Bloom filter.

Counts are quantised on a logarithmic scale: an n-gram of count c has level 1 + floor(log_b(c)) and is
entered in the filter once for each level up to its own. A look-up probes level 1, 2, ... until the
first miss, so a false positive can only raise a count by a level.

Every word and every pair of the training texts is entered, however rare, so the model grows with the
corpus. No process holds it whole: texts are tokenised once into written chunks of about CHUNK_TOKENS
tokens, each chunk sends its distinct n-grams (40 bits of hash, and the count in training texts) to the
section of the filter that their hash names, a section sums up, sets its bits and answers each chunk with
levels, and the chunks are scored from the answers. The number of sections is the number of tokens over
SECTION_TOKENS, so the size of a section and of a chunk is the same at every size.

Probabilities: P(w | v) = (c(v, w) + mu P(w)) / (c(v) + mu), with c from the filter. ``base_score`` uses
exact counts: those of words whose share is at least ``exact_share`` (at most 1 / exact_share, so
bounded) are broadcast, all others are joined.

Defined results: a null or empty text is the end token alone; rows with equal or null ids are scored on
their own; without training rows every count is zero. An empty table gives no rows. Other columns are
ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from sensorloom.llm.common import crc_bucket, discard, release, written

# Fixed value: the end token; no word holds white space.
END = b"\n"
#: Tokens of a chunk (or of one longer text), and of all texts for each section of the filter.
CHUNK_TOKENS = 1 << 20
SECTION_TOKENS = 1 << 18
BLOCK_BITS = 1 << 19
PROBES = 4
#: Bytes of an n-gram's hash within its section.
KEY_BYTES = 5


@dataclass(frozen=True)
class Model:
    share: float = 1e-7  # without effect: every n-gram is entered
    exact_share: float = 1e-6
    base: float = 1.5
    bits_per_entry: int = 12
    mu: float = 30.0


class _Ids(dict):
    """Word -> its place in the chunk's vocabulary."""

    def __missing__(self, word: bytes) -> int:
        self[word] = place = len(self)
        return place


def tokens(text: bytes) -> list[bytes]:
    return [*text.lower().split(), END]


def _hashed(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)).view(np.int64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit."""
    x = x.view(np.uint64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def pair_hashes(hashes: np.ndarray) -> np.ndarray:
    """Hash of each token with the one before; before the first stands the end of another text."""
    before = np.concatenate([_hashed([END]), hashes[:-1]])
    return _mixed((_mixed(before) * np.uint64(3) + hashes.view(np.uint64)).view(np.int64)).view(np.int64)


# ---------------------------------------------------------------- chunks


def with_split(docs: DataFrame, modulus: int = 5, held: int = 1) -> DataFrame:
    """doc_id, held_out and text as bytes."""
    return docs.select(
        "doc_id",
        (crc_bucket(F.col("doc_id"), modulus) == held).alias("held_out"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    )


CHUNKS = "chunk long, n_tokens long, doc_ids array<long>, held_out array<boolean>, sizes array<int>, words binary, ids binary"


def chunked(split: DataFrame) -> DataFrame:
    """The rows of ``with_split`` as chunks of tokens, written: a vocabulary, and places in it.

    The vocabulary starts with the end token, which is not stored. Places are compressed byte by byte.
    """

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chunk = TaskContext.get().partitionId() << 24
        packer = zstandard.ZstdCompressor(level=1)
        places, docs, held, ids, size = _Ids({END: 0}), [], [], [], 0

        def made() -> pd.DataFrame:
            planes = np.concatenate(ids).view(np.uint8).reshape(-1, 4).T
            return pd.DataFrame(
                {
                    "chunk": [chunk],
                    "n_tokens": [size],
                    "doc_ids": [docs],
                    "held_out": [held],
                    "sizes": [[len(i) for i in ids]],
                    "words": [packer.compress(b" ".join(list(places)[1:]))],
                    "ids": [packer.compress(planes.tobytes())],
                }
            )

        for batch in batches:
            for doc_id, out, text in zip(batch["doc_id"], batch["held_out"], batch["text"], strict=True):
                words = tokens(text)
                docs.append(None if pd.isna(doc_id) else int(doc_id))
                held.append(bool(out))
                ids.append(np.fromiter(map(places.__getitem__, words), np.uint32, len(words)))
                size += len(words)
                if size >= CHUNK_TOKENS:
                    yield made()
                    chunk += 1
                    places, docs, held, ids, size = _Ids({END: 0}), [], [], [], 0
        if size:
            yield made()

    exact = split.withColumn("doc_id", F.col("doc_id").cast("decimal(20,0)"))
    return written(exact.mapInPandas(gather, CHUNKS), "token-chunks")


class _Chunk:
    """A chunk opened: its words, the place of each token, and which tokens train."""

    def __init__(self, words: bytes, ids: bytes, sizes: list[int], held_out: list[bool]):
        opener = zstandard.ZstdDecompressor()
        joined = opener.decompress(words)
        self.words = [END, *joined.split(b" ")] if joined else [END]
        planes = np.frombuffer(opener.decompress(ids), np.uint8).reshape(4, -1)
        self.ids = np.ascontiguousarray(planes.T).view(np.uint32).ravel().astype(np.int64)
        self.sizes = np.asarray(sizes, np.int64)
        self.trains = np.repeat(~np.asarray(held_out, bool), self.sizes)

    def grams(self, n_sections: int) -> tuple[np.ndarray, ...]:
        """By section: keys, counts in training texts, first place of each section present, these sections;
        then the place of every word of the vocabulary and of every token's pair among the keys."""
        hashes = _hashed(self.words)
        pairs, place = np.unique(pair_hashes(hashes[self.ids]), return_inverse=True)
        n = np.concatenate(
            [
                np.bincount(self.ids[self.trains], minlength=len(hashes)),
                np.bincount(place[self.trains], minlength=len(pairs)),
            ]
        )
        mixed = _mixed(np.concatenate([hashes, pairs]) ^ np.int64(0x5DEECE66D))
        section = ((mixed >> np.uint64(32)) % np.uint64(n_sections)).astype(
            np.uint16 if n_sections <= 1 << 16 else np.int64
        )
        order = np.argsort(section, kind="stable")
        sections, first = np.unique(section[order], return_index=True)
        at = np.empty(len(order), np.int64)
        at[order] = np.arange(len(order))
        keys = mixed[order] & np.uint64(2 ** (8 * KEY_BYTES) - 1)
        return keys, n[order], first, sections.astype(np.int64), at[: len(hashes)], at[len(hashes) :][place]


def word_counts(chunks: DataFrame) -> DataFrame:
    """word, n: exact counts of all training tokens, written."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                chunk = _Chunk(row.words, row.ids, row.sizes, row.held_out)
                n = np.bincount(chunk.ids[chunk.trains], minlength=len(chunk.words))
                yield pd.DataFrame({"word": chunk.words, "n": n})[n > 0]

    parts = chunks.select("words", "ids", "sizes", "held_out").mapInPandas(count, "word binary, n long")
    return written(parts.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")


# ---------------------------------------------------------------- filter


class LogFrequencyFilter:
    """Levels of n-grams by their hash. ``blocks`` has a row of BLOCK_BITS bits for each block."""

    def __init__(self, blocks: np.ndarray, floor: int, base: float):
        self.blocks, self.floor, self.base = blocks, floor, base

    def _held(self, grams: np.ndarray, level: int) -> np.ndarray:
        block = block_of(grams, len(self.blocks))
        held = np.ones(len(grams), bool)
        for bit in bits_of(grams, level):
            held &= (self.blocks[block, bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 > 0
        return held

    @classmethod
    def of(cls, grams: np.ndarray, n: np.ndarray, floor: int, model: Model) -> "LogFrequencyFilter":
        """The filter of distinct grams, all of which have n >= floor."""
        level = level_of(n, floor, model.base)
        n_blocks = max(1, int(-(-int(level.sum()) * model.bits_per_entry // BLOCK_BITS)))
        bits = np.zeros(n_blocks * BLOCK_BITS, bool)
        start = block_of(grams, n_blocks) * BLOCK_BITS
        for k in range(1, int(level.max(initial=0)) + 1):
            at = level >= k
            for bit in bits_of(grams[at], k):
                bits[start[at] + bit] = True
        return cls(np.packbits(bits, bitorder="little").reshape(n_blocks, -1), floor, model.base)

    def contains(self, grams: np.ndarray) -> np.ndarray:
        return self._held(grams, 1)

    def levels(self, grams: np.ndarray) -> np.ndarray:
        """The level of each gram; 0 where it isn't held."""
        levels = np.zeros(len(grams), np.int64)
        left, level = np.arange(len(grams)), 1
        while len(left):
            left = left[self._held(grams[left], level)]
            levels[left] = level
            level += 1
        return levels

    def counts(self, grams: np.ndarray) -> np.ndarray:
        """The count that each gram's level stands for; 0 where it isn't held."""
        return counts_of(self.levels(grams), self.floor, self.base)


def counts_of(levels: np.ndarray, floor: int, base: float) -> np.ndarray:
    low = floor * base ** (levels - 1.0)
    middle = (low + low * base) / 2
    return np.where(levels > 0, middle if floor > 1 else np.maximum(1.0, np.floor(middle)), 0.0)


def level_of(counts: np.ndarray, floor: int, base: float) -> np.ndarray:
    return 1 + np.floor(np.log(np.maximum(counts, floor) / floor) / np.log(base) + 1e-9).astype(np.int64)


def block_of(grams: np.ndarray, n_blocks: int) -> np.ndarray:
    return (_mixed(grams ^ np.int64(0x5DEECE66D)) % np.uint64(n_blocks)).astype(np.int64)


def bits_of(grams: np.ndarray, level: int) -> list[np.ndarray]:
    """Bits within its block of each gram at a level."""
    salt = np.uint64(level * 0x632BE59BD9B4E019 % 2**64)
    first = _mixed((grams.view(np.uint64) + salt).view(np.int64))
    second = _mixed(first.view(np.int64)) | np.uint64(1)
    return [((first + np.uint64(i) * second) % np.uint64(BLOCK_BITS)).astype(np.int64) for i in range(PROBES)]


def built_filter(grams: DataFrame, floor: int, model: Model) -> LogFrequencyFilter:
    """The filter of a small table of distinct ``grams`` (gram, n), all of which have n >= floor."""
    rows = grams.select("gram", "n").toPandas()
    return LogFrequencyFilter.of(rows["gram"].to_numpy(np.int64), rows["n"].to_numpy(), floor, model)


def levels(chunks: DataFrame, n_sections: int, model: Model) -> DataFrame:
    """chunk, section, levels (compressed bytes): the filter's levels of each chunk's grams, written."""

    def sent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                chunk = _Chunk(row.words, row.ids, row.sizes, row.held_out)
                keys, n, first, sections, _, _ = chunk.grams(n_sections)
                packed = keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]
                ends = [*first[1:], len(keys)]
                few = np.minimum(n, 255).astype(np.uint8)
                yield pd.DataFrame(
                    {
                        "section": sections,
                        "chunk": row.chunk,
                        "grams": [packed[a:b].tobytes() for a, b in zip(first, ends, strict=True)],
                        "n": [few[a:b].tobytes() for a, b in zip(first, ends, strict=True)],
                        "more": [
                            n[a:b][few[a:b] == 255].astype("<i8").tobytes() for a, b in zip(first, ends, strict=True)
                        ],
                    }
                )

    def answered(group: pd.DataFrame) -> pd.DataFrame:
        wide = np.zeros((sum(map(len, group["n"])), 8), np.uint8)
        wide[:, :KEY_BYTES] = np.frombuffer(b"".join(group["grams"]), np.uint8).reshape(-1, KEY_BYTES)
        n = np.frombuffer(b"".join(group["n"]), np.uint8).astype(np.int64)
        n[n == 255] = np.frombuffer(b"".join(group["more"]), "<i8")
        grams, place = np.unique(wide.view("<u8").ravel().view(np.int64), return_inverse=True)
        sums = np.bincount(place, weights=n)
        held = LogFrequencyFilter.of(grams[sums > 0], sums[sums > 0], 1, model)
        found = held.levels(grams).astype(np.uint8)[place]
        packer = zstandard.ZstdCompressor(level=1)
        parts = np.split(found, np.cumsum([len(x) for x in group["n"]])[:-1])
        return pd.DataFrame(
            {
                "chunk": group["chunk"].to_numpy(),
                "section": group["section"].to_numpy(),
                "levels": [packer.compress(p.tobytes()) for p in parts],
            }
        )

    grams = chunks.select("chunk", "words", "ids", "sizes", "held_out").mapInPandas(
        sent, "section long, chunk long, grams binary, n binary, more binary"
    )
    answers = grams.groupBy("section").applyInPandas(answered, "chunk long, section long, levels binary")
    return written(answers, "gram-levels")


# ---------------------------------------------------------------- scores


@dataclass
class Trained:
    """What workers need: the bounded exact counts, and totals."""

    exact: np.ndarray
    exact_n: np.ndarray
    n_tokens: int
    n_words: int
    model: Model

    def word_shares(self, counts: np.ndarray) -> np.ndarray:
        """One unseen word has what half a token would."""
        return np.where(counts > 0, counts / max(1, self.n_tokens), 0.5 / (self.n_tokens + 0.5))


def trained(words: DataFrame, model: Model) -> Trained:
    """Totals and frequent words of the exact word counts."""
    totals = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n, v = int(totals["n"]), int(totals["v"])
    often = words.where(F.col("n") >= max(1, int(np.ceil(model.exact_share * n)))).toPandas()
    exact = often.assign(gram=_hashed(list(often["word"]))).sort_values("gram")
    return Trained(exact["gram"].to_numpy(np.int64), exact["n"].to_numpy(np.int64), n, v, model)


SCORED = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, "
    "words array<binary>, times array<long>"
)


def _score_chunk(row, answers: pd.DataFrame, fitted: Trained, n_sections: int) -> pd.DataFrame:
    chunk = _Chunk(row["words"], row["ids"], row["sizes"], row["held_out"])
    keys, _, _, sections, word_at, pair_at = chunk.grams(n_sections)
    answers = answers.sort_values("section")
    opener = zstandard.ZstdDecompressor()
    found = np.frombuffer(b"".join(map(opener.decompress, answers["levels"])), np.uint8)
    if len(found) != len(keys) or not np.array_equal(answers["section"].to_numpy(), sections):
        raise ValueError("the filter's answers are not those of the chunk's n-grams")
    held = counts_of(found.astype(np.int64), 1, fitted.model.base)
    ids, sizes = chunk.ids, chunk.sizes
    ends = np.cumsum(sizes)
    starts = ends - sizes
    word_n = held[word_at]
    shares = fitted.word_shares(word_n)[ids]
    before = word_n[np.concatenate([[0], ids[:-1]])]  # place 0 is the end token, also between texts
    pairs = np.minimum(held[pair_at], before)
    logs = np.log10((pairs + fitted.model.mu * shares) / (before + fitted.model.mu))
    distinct = _hashed(chunk.words)
    known, exact = np.zeros(len(distinct), bool), np.zeros(len(distinct))
    if len(fitted.exact):
        spot = np.minimum(np.searchsorted(fitted.exact, distinct), len(fitted.exact) - 1)
        known = fitted.exact[spot] == distinct
        exact = np.where(known, fitted.exact_n[spot], 0)
    is_known = known[ids]
    base = np.where(known, np.log10(exact + 0.5), 0.0)[ids]
    rare, texts = np.flatnonzero(~is_known), np.repeat(np.arange(len(sizes)), sizes)
    uses, times = np.unique(texts[rare] * len(distinct) + ids[rare], return_counts=True)
    cuts = np.searchsorted(uses, np.arange(len(sizes) + 1) * len(distinct))
    return pd.DataFrame(
        {
            "row": (int(row["chunk"]) << 20) + np.arange(len(sizes)),
            "doc_id": pd.array([None if pd.isna(x) else int(x) for x in row["doc_ids"]], "Int64"),
            "held_out": np.asarray(row["held_out"], bool),
            "n_tokens": sizes,
            "n_known": np.add.reduceat(is_known.astype(np.int64), starts),
            "base": np.add.reduceat(base, starts),
            "score": np.add.reduceat(logs, starts),
            "words": [
                [chunk.words[i] for i in uses[a:b] % len(distinct)] for a, b in zip(cuts[:-1], cuts[1:], strict=True)
            ],
            "times": [times[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)],
        }
    )


def scored(docs: DataFrame, model: Model = Model()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    spark = docs.sparkSession
    chunks = chunked(with_split(docs))
    n_sections = 1 + (chunks.agg(F.sum("n_tokens").alias("n")).first()["n"] or 0) // SECTION_TOKENS
    words = word_counts(chunks)
    fitted = trained(words, model)
    answers = levels(chunks, n_sections, model)
    release(spark)
    shared = spark.sparkContext.broadcast(fitted)

    def score(chunk: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        return _score_chunk(chunk.iloc[0], answers, shared.value, n_sections)

    # doc_ids as text: pandas would turn a list with nulls into floats.
    exact = chunks.withColumn("doc_ids", F.col("doc_ids").cast("array<string>"))
    rows = written(exact.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(score, SCORED), "scored")
    discard(chunks, answers)
    pairs = rows.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select(
        "row", F.col("w.words").alias("word"), F.col("w.times").alias("times")
    )
    few = words.where(F.col("n") < max(1, int(np.ceil(model.exact_share * fitted.n_tokens))))
    found = pairs.join(few, "word").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + 0.5)).alias("more_base"),
        F.sum("times").alias("more_known"),
    )
    known = F.col("n_known") + F.coalesce("more_known", F.lit(0))
    per_token = float(np.log10(fitted.n_tokens + 0.5 * (fitted.n_words + 1)))
    base = F.col("base") + F.coalesce("more_base", F.lit(0.0)) + (F.col("n_tokens") - known) * float(np.log10(0.5))
    return rows.join(found, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        known.alias("n_known"),
        F.lit(fitted.n_tokens).cast("long").alias("train_tokens"),
        (base - F.col("n_tokens") * per_token).alias("base_score"),
        "score",
    )
