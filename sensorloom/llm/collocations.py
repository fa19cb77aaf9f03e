"""Phrase collocation mining with direct-address tiles.

Words are ranked by frequency within their language. The most frequent ones (``Mining.head`` of all
languages together) have their rank as id and are cut into strips of about equal mass; a pair of strips is a
tile, and a pair of words is a cell of its tile. Tasks turn texts into cells and hand on each tile's cells with
their counts; what comes together is counted with one dense ``bincount`` where a tile has few cells, and as
sorted coordinates where it has many. Pairs that are frequent enough are ranked anew and take the place of
words for the phrases of three words: a tile is then a strip of pairs by a strip of words.

Words and pairs beyond the head are known by the hashes of their words and meet in sparse tiles of their own; a
bit map of fixed size says which of them can be frequent at all (false hits are counted and found rare). So
what is broadcast has a fixed bound, and all counts are exact at any size. Hashes of words are checked for
collisions over the whole vocabulary; if a counted word has one, another seed is taken.

A cell reaches a tile's reducer once a task and chunk, however often it occurs there; strips of equal mass keep
tiles alike, as a strip of the most frequent words has few cells.

Defined results: a null text is empty, a null language is ``und``; equal texts and repeated rows all count; ties in
the order of results go by count, then by the UTF-8 bytes of the phrase. An empty table, or texts without a
frequent phrase, give no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from sensorloom.llm.common import discard, release, written

#: What ends a piece of text, and what parts words.
PIECE_ENDS, BLANKS = b".,;:!?\x0a\x0b\x0c\x0d", b" \t"
BREAK = b"\n"
_FOLD = bytes.maketrans(
    bytes(range(65, 91)) + PIECE_ENDS + BLANKS, bytes(range(97, 123)) + BREAK * len(PIECE_ENDS) + b" " * len(BLANKS)
)

#: Distinct words, or ids, that a task holds before it hands them on.
CHUNK_WORDS, CHUNK_IDS = 1 << 19, 1 << 21
#: Cells of a tile that is counted densely, and coordinates held before they are added up.
DENSE_CELLS, HELD_CELLS = 1 << 22, 1 << 22
#: Tiles of the phrases that no head covers.
SPARSE_TILES = 256
_NONE, _EMPTY = -1, np.iinfo(np.int64).min


@dataclass(frozen=True)
class Mining:
    """Phrases of 2 and 3 words found ``least`` times or more; the ``top`` of each language.

    A phrase inside a longer one that occurs at least ``inside`` % as often is left to the longer one. ``head``
    and ``map_bits`` bound what is broadcast, ``strips`` is the number of strips of an alphabet.
    """

    least: int = 10
    top: int = 2000
    inside: int = 50
    head: int = 1 << 19
    map_bits: int = 1 << 26
    strips: int = 24


# ---------------------------------------------------------------- texts


def tokens(texts: list[bytes]) -> list[bytes]:
    """Words of some texts, A-Z in lower case; ``BREAK`` stands between pieces. Some tokens are empty."""
    return BREAK.join(texts).translate(_FOLD).replace(BREAK, b" " + BREAK + b" ").split(b" ")


def _hash(word: bytes, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(word, seed) >> 2


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _joint(*hashes: np.ndarray) -> np.ndarray:
    """One hash for the words of a phrase, given theirs."""
    total = np.zeros(len(hashes[0]), np.uint64)
    for part in hashes:
        total = _mixed(total + part.astype(np.uint64))
    return total >> np.uint64(2)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.where("text is not null").select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text")
    )


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    """The tokens of a batch's texts, language by language."""
    texts: dict[str, list[bytes]] = {}
    for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
        texts.setdefault(lang, []).append(text)
    for lang, some in texts.items():
        yield lang, tokens(some)


def word_counts(docs: DataFrame, seed: int) -> DataFrame:
    """lang, word, hash, n: occurrences of every word, however rare."""

    def rows(held: dict[str, Counter]) -> pa.RecordBatch:
        names, words, hashes, counts = [], [], [], []
        for lang, found in held.items():
            del found[BREAK], found[b""]  # a counter lets go of what it lacks
            names += [lang] * len(found)
            words += found.keys()
            counts += found.values()
            hashes += [_hash(word, seed) for word in found]
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(words, pa.binary()), pa.array(hashes, pa.int64()), pa.array(counts, pa.int64())],
            names=["lang", "word", "hash", "n"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        for batch in batches:
            for lang, found in _by_language(batch):
                held.setdefault(lang, Counter()).update(found)
            if sum(map(len, held.values())) > CHUNK_WORDS:
                yield rows(held)
                held = {}
        yield rows(held)

    made = _texts(docs).mapInArrow(count, "lang string, word binary, hash long, n long")
    return made.groupBy("lang", "word", "hash").agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame, mining: Mining) -> tuple[DataFrame, int]:
    """The written word counts and the seed with which no frequent word shares its hash."""
    seed = 0
    while True:
        words = written(word_counts(docs, seed), "word-counts")
        clash = words.groupBy("lang", "hash").agg(F.count("*").alias("words"), F.max("n").alias("most"))
        if clash.where((F.col("words") > 1) & (F.col("most") >= mining.least)).isEmpty():
            return words, seed
        discard(words)
        seed += 1


# ---------------------------------------------------------------- alphabets


@dataclass
class Letters:
    """The head of one language: ``keys`` sorted, the rank of each, and by rank the hashes of its words and the
    strips (``starts`` of each; strip of each rank)."""

    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    ranks: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    hashes: np.ndarray = field(default_factory=lambda: np.zeros((0, 1), np.int64))
    starts: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    strip: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Ranks, -1 where a key isn't in the head."""
        if not len(self.keys):
            return np.full(len(keys), _NONE)
        spot = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[spot] == keys, self.ranks[spot].astype(np.int64), _NONE)

    def width(self, strip: int) -> int:
        ends = np.append(self.starts[1:], len(self.keys))
        return int(ends[strip] - self.starts[strip])


@dataclass
class Alphabet:
    """Heads by language, and the bit map of what is frequent beyond them."""

    heads: dict[str, Letters]
    bits: np.ndarray
    beyond: bool = False

    def __post_init__(self):
        self.beyond = bool(self.bits.any())

    def of(self, lang: str) -> Letters:
        return self.heads.get(lang) or Letters()

    def maybe(self, hashes: np.ndarray) -> np.ndarray:
        """Whether phrases beyond the head, by their joint hashes, may be frequent."""
        place = hashes.astype(np.uint64) % np.uint64(len(self.bits) * 8)
        return (self.bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _letters(keys: np.ndarray, counts: np.ndarray, hashes: np.ndarray, strips: int) -> Letters:
    order = np.lexsort((keys, -counts))  # by rank
    counts = counts[order].astype(np.float64)
    mass = np.cumsum(counts) - counts
    strip = np.minimum((mass * strips / max(1.0, counts.sum())).astype(np.int64), strips - 1)
    starts, strip = np.unique(strip, return_index=True)[1], np.unique(strip, return_inverse=True)[1]
    by_key = np.argsort(keys[order], kind="stable")
    return Letters(keys[order][by_key], by_key.astype(np.int32), hashes[order], starts.astype(np.int64), strip.astype(np.uint8))


def _head_rows(counts: DataFrame, columns: list[str], mining: Mining) -> tuple[dict[str, np.ndarray], int]:
    """The most frequent rows, at most ``mining.head``, and the count from which on they are taken: by language
    an array of the columns and n.

    A histogram over classes of counts (an eighth of a power of two wide) sets the threshold.
    """
    step = F.floor(F.log2(F.col("n").cast("double")) * 8).cast("int")
    classes = counts.groupBy(step.alias("step")).agg(F.count("*").alias("rows"), F.min("n").alias("least")).collect()
    threshold, taken = np.iinfo(np.int64).max, 0
    for row in sorted(classes, key=lambda r: -r["step"]):
        taken += row["rows"]
        if taken > mining.head:
            break
        threshold = row["least"]
    found = counts.where(F.col("n") >= threshold).select(F.col("lang"), *columns, "n").toArrow()
    out = {}
    for lang in pc.unique(found["lang"]).to_pylist():
        part = found.filter(pc.equal(found["lang"], lang))
        out[lang] = np.stack([part[c].to_numpy() for c in (*columns, "n")], axis=1)
    return out, threshold


def _bit_map(joint: DataFrame, mining: Mining) -> np.ndarray:
    """Bits set for the column ``joint``; no more rows than the map has words reach the driver."""
    bit = F.col("joint") % mining.map_bits
    words = joint.groupBy(F.shiftright(bit, 6).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast((joint % {mining.map_bits}) & 63 as int))")).alias("bits")
    ).toArrow()
    bits = np.zeros(max(1, mining.map_bits // 64), np.int64)
    bits[words["word"].to_numpy()] = words["bits"].to_numpy()
    return bits.view(np.uint8)


def word_alphabet(words: DataFrame, mining: Mining) -> Alphabet:
    frequent = words.where(F.col("n") >= mining.least)
    head, threshold = _head_rows(frequent, ["hash"], mining)
    heads = {lang: _letters(part[:, 0], part[:, 1], part[:, :1], mining.strips) for lang, part in head.items()}
    rest = frequent.where(F.col("n") < threshold).select(F.col("hash").alias("joint"))
    return Alphabet(heads, _bit_map(rest, mining))


def pair_alphabet(pairs: DataFrame, alphabet: Alphabet, mining: Mining) -> Alphabet:
    """Frequent pairs ranked as words were. A pair with a word beyond the words' head is beyond the pairs'."""
    head, threshold = _head_rows(pairs, ["first", "second"], mining)
    heads, beyond = {}, []
    for lang, part in head.items():
        hashes, counts, letters = part[:, :2], part[:, 2], alphabet.of(lang)
        one, two = letters.find(hashes[:, 0]), letters.find(hashes[:, 1])
        inner = (one >= 0) & (two >= 0)
        beyond.append(_joint(hashes[~inner, 0], hashes[~inner, 1]))
        heads[lang] = _letters((one << 32 | two)[inner], counts[inner], hashes[inner], mining.strips)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            joint = _joint(*[np.asarray(batch.column(c)) for c in ("first", "second")])
            yield pa.RecordBatch.from_pydict({"joint": pa.array(joint.astype(np.int64), pa.int64())})

    rest = pairs.where(F.col("n") < threshold).select("first", "second").mapInArrow(hashed, "joint long")
    bits = _bit_map(rest, mining)
    place = np.concatenate([np.zeros(0, np.uint64), *beyond]) % np.uint64(len(bits) * 8)
    np.bitwise_or.at(bits, place >> np.uint64(3), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8))
    return Alphabet(heads, bits)


# ---------------------------------------------------------------- tiles

TILES = "lang string, tile long, cells binary, counts binary"


class _Ids:
    """Word -> rank, or -2 - hash if it may be frequent beyond the head, or -1; -1 also between pieces."""

    def __init__(self, letters: Letters, alphabet: Alphabet, seed: int):
        self.letters, self.alphabet, self.seed = letters, alphabet, seed
        self.known: dict[bytes, int] = {}

    def code(self, found: list[bytes]) -> np.ndarray:
        if len(self.known) > CHUNK_WORDS or not self.known:
            self.known = {BREAK: _NONE, b"": _EMPTY}
        fresh = list(set(found).difference(self.known))
        hashes = np.fromiter((_hash(word, self.seed) for word in fresh), np.int64, len(fresh))
        ranks = self.letters.find(hashes)
        if self.alphabet.beyond:
            rest = np.flatnonzero(ranks == _NONE)
            rest = rest[self.alphabet.maybe(hashes[rest])]
            ranks[rest] = -2 - hashes[rest]
        self.known.update(zip(fresh, ranks.tolist(), strict=True))
        code = np.fromiter(map(self.known.__getitem__, found), np.int64, len(found))
        return code[code != _EMPTY]


def _added(cells: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted coordinates (rows of one or more columns), equal ones added up."""
    if len(cells):
        order = np.lexsort(cells.T[::-1]) if cells.shape[1] > 1 else np.argsort(cells[:, 0], kind="stable")
        cells, counts = cells[order], counts[order]
        fresh = np.flatnonzero(np.append(True, (cells[1:] != cells[:-1]).any(1)))
        cells, counts = cells[fresh], np.add.reduceat(counts, fresh)
    return cells, counts


def _tile_rows(lang: str, first: np.ndarray, second: np.ndarray, rows: Letters, columns: Letters) -> Iterator[tuple]:
    """Cells and counts of phrases within both heads, by tile."""
    keys, counts = np.unique(first << 32 | second, return_counts=True)
    first, second = keys >> 32, keys & 0xFFFFFFFF
    across = len(columns.starts)
    tile = rows.strip[first].astype(np.int64) * across + columns.strip[second]
    order = np.argsort(tile, kind="stable")
    first, second, tile, counts = first[order], second[order], tile[order], counts[order]
    for part in np.split(np.arange(len(tile)), np.flatnonzero(np.diff(tile)) + 1):
        if len(part):
            down, right = divmod(int(tile[part[0]]), across)
            cells = (first[part] - rows.starts[down]) * columns.width(right) + second[part] - columns.starts[right]
            yield lang, int(tile[part[0]]), np.diff(cells, prepend=0).astype(np.int64).tobytes(), counts[part].astype(np.int64).tobytes()


def _sparse_rows(lang: str, hashes: np.ndarray) -> Iterator[tuple]:
    """Coordinates and counts of phrases beyond a head, by a hash."""
    cells, counts = _added(hashes, np.ones(len(hashes), np.int64))
    tile = (_joint(*cells.T) % np.uint64(SPARSE_TILES)).astype(np.int64)
    for number in np.unique(tile):
        part = tile == number
        yield lang, -1 - int(number), cells[part].tobytes(), counts[part].tobytes()


def _hashes_of(ids: np.ndarray, letters: Letters) -> np.ndarray:
    """The words' hashes, from ranks or ids beyond the head."""
    out = -2 - ids
    out[ids >= 0] = letters.hashes[ids[ids >= 0], 0]
    return out


def _counted(docs: DataFrame, words: Broadcast, pairs: Alphabet | None, seed: int, mining: Mining) -> DataFrame:
    """Frequent phrases of two words, or of three if ``pairs`` are given: lang, first, second(, third), n."""
    context = docs.sparkSession.sparkContext
    shared, shared_pairs = words, context.broadcast(pairs)
    size = 2 if pairs is None else 3

    def phrases(lang: str, code: np.ndarray) -> Iterator[tuple]:
        letters, pairs = shared.value.of(lang), shared_pairs.value
        one, two = code[:-1], code[1:]
        if pairs is None:
            there = (one != _NONE) & (two != _NONE)
            head = there & (one >= 0) & (two >= 0)
            yield from _tile_rows(lang, one[head], two[head], letters, letters)
            rest = np.flatnonzero(there & ~head)
        else:
            rows = pairs.of(lang)
            pair = np.full(len(one), _NONE)
            both = (one >= 0) & (two >= 0)
            pair[both] = rows.find(one[both] << 32 | two[both])
            asked = np.flatnonzero((pair == _NONE) & (one != _NONE) & (two != _NONE) & pairs.beyond)
            maybe = pairs.maybe(_joint(_hashes_of(one[asked], letters), _hashes_of(two[asked], letters)))
            pair[asked[maybe]] = -2
            there = (pair[:-1] != _NONE) & (pair[1:] != _NONE)
            head = there & (pair[:-1] >= 0) & (code[2:] >= 0)
            yield from _tile_rows(lang, pair[:-1][head], code[2:][head], rows, letters)
            rest = np.flatnonzero(there & ~head)
        if len(rest):
            yield from _sparse_rows(lang, np.stack([_hashes_of(code[rest + i], letters) for i in range(size)], 1))

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: dict[str, _Ids] = {}
        held: dict[str, list] = {}
        waiting = 0

        def rows() -> pa.RecordBatch:
            made = [x for lang, codes in held.items() for x in phrases(lang, np.concatenate(codes))]
            held.clear()
            kinds = (pa.string(), pa.int64(), pa.binary(), pa.binary())
            columns = zip(*made, strict=True) if made else [[]] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["lang", "tile", "cells", "counts"]
            )

        for batch in batches:
            for lang, found in _by_language(batch):
                if lang not in ids:
                    ids[lang] = _Ids(shared.value.of(lang), shared.value, seed)
                code = ids[lang].code(found)
                held.setdefault(lang, []).extend((code, [_NONE]))
                waiting += len(code)
            if waiting > CHUNK_IDS:
                yield rows()
                waiting = 0
        yield rows()

    def finish(lang: str, tile: int, cells: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        frequent = counts >= mining.least
        cells, counts = cells[frequent], counts[frequent]
        if tile >= 0:
            columns = shared.value.of(lang)
            rows = columns if pairs_none else shared_pairs.value.of(lang)
            down, right = divmod(tile, len(columns.starts))
            first, second = np.divmod(cells[:, 0], columns.width(right))
            cells = np.concatenate(
                [rows.hashes[first + rows.starts[down]], columns.hashes[second + columns.starts[right]]], axis=1
            )
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(counts), pa.string()), *[pa.array(c, pa.int64()) for c in cells.T], pa.array(counts, pa.int64())],
            names=["lang", *names, "n"],
        )

    def dense(lang: str, tile: int) -> int:
        """Cells of a tile if it is to be counted densely, else 0."""
        if tile < 0:
            return 0
        columns = shared.value.of(lang)
        rows = columns if pairs_none else shared_pairs.value.of(lang)
        down, right = divmod(tile, len(columns.starts))
        cells = rows.width(down) * columns.width(right)
        return cells if cells <= DENSE_CELLS else 0

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows arrive by tile; one tile is held at a time."""
        at, parts, held, total, limit = None, [], 0, 0, HELD_CELLS

        def together() -> tuple[np.ndarray, np.ndarray]:
            cells, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
            if total and len(cells) * 8 > total:
                counts = np.bincount(cells[:, 0], weights=counts, minlength=total).astype(np.int64)
                cells = np.flatnonzero(counts)
                return cells[:, None], counts[cells]
            return _added(cells, counts)

        for batch in batches:
            for lang, tile, cells, counts in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if (lang, tile) != at:
                    if at:
                        yield finish(*at, *together())
                    at, parts, held, total, limit = (lang, tile), [], 0, dense(lang, tile), HELD_CELLS
                cells = np.frombuffer(cells, np.int64)
                cells = np.cumsum(cells)[:, None] if tile >= 0 else cells.reshape(-1, size)
                parts.append((cells, np.frombuffer(counts, np.int64)))
                held += len(cells)
                if held > limit:
                    parts = [together()]
                    held = len(parts[0][0])
                    limit = max(limit, 2 * held)
        if at:
            yield finish(*at, *together())

    pairs_none = pairs is None
    names = ("first", "second", "third")[:size]
    schema = ", ".join(["lang string", *[f"{c} long" for c in names], "n long"])
    made = _texts(docs).mapInArrow(tiles, TILES)
    dealt = made.repartition("lang", "tile").sortWithinPartitions("lang", "tile")
    return dealt.mapInArrow(add_up, schema)


# ---------------------------------------------------------------- phrases and scores


def _score(a: str, left: str, right: str) -> str:
    """floor(1000000 * a * a / (left * right)), exact up to 38 digits."""
    wide = "cast({} as decimal(19, 0))".format
    return f"(cast(1000000 as decimal(7, 0)) * {wide(a)} * {wide(a)}) div ({wide(left)} * {wide(right)})"


def candidates(docs: DataFrame, mining: Mining = Mining()) -> tuple[DataFrame, DataFrame]:
    """All frequent phrases (lang, phrase, words, a, l, r, score, dropped), and lang, n."""
    words, seed = vocabulary(docs, mining)
    alphabet = docs.sparkSession.sparkContext.broadcast(word_alphabet(words, mining))
    pairs = written(_counted(docs, alphabet, None, seed, mining), "pairs")
    triples = written(_counted(docs, alphabet, pair_alphabet(pairs, alphabet.value, mining), seed, mining), "triples")
    release(docs.sparkSession)

    frequent = words.where(F.col("n") >= mining.least)
    known = frequent.select("lang", F.col("hash").alias("first"), F.col("word").cast("string").alias("one"), F.col("n").alias("l"))
    after = known.toDF("lang", "second", "two", "r")
    two = pairs.withColumnRenamed("n", "a").join(known, ["lang", "first"]).join(after, ["lang", "second"])
    two = written(two.select("lang", "first", "second", "one", "two", "a", "l", "r"), "scored-pairs")

    starts = two.select(
        "lang", "first", "second", F.concat_ws(" ", "one", "two").alias("start"), F.col("l").alias("one_n"), F.col("a").alias("start_n")
    )
    ends = two.select(
        "lang", F.col("first").alias("second"), F.col("second").alias("third"), F.col("two").alias("three"),
        F.col("r").alias("three_n"), F.col("a").alias("end_n"),
    )
    three = triples.withColumnRenamed("n", "a").join(starts, ["lang", "first", "second"]).join(ends, ["lang", "second", "third"])
    three = three.withColumns({"s1": F.expr(_score("a", "one_n", "end_n")), "s2": F.expr(_score("a", "start_n", "three_n"))})
    early = F.col("s1") <= F.col("s2")
    three = three.select(
        "lang",
        F.concat_ws(" ", "start", "three").alias("phrase"),
        F.lit(3).alias("words"),
        "a",
        F.when(early, F.col("one_n")).otherwise(F.col("start_n")).alias("l"),
        F.when(early, F.col("end_n")).otherwise(F.col("three_n")).alias("r"),
        F.least("s1", "s2").alias("score"),
        F.lit(False).alias("dropped"),
    )
    inner = F.explode(
        F.array(F.struct("first", "second"), F.struct(F.col("second").alias("first"), F.col("third").alias("second")))
    )
    covers = triples.select("lang", "n", inner.alias("pair")).groupBy("lang", "pair.first", "pair.second")
    covers = covers.agg(F.max("n").alias("longer"))
    two = two.join(covers, ["lang", "first", "second"], "left").select(
        "lang",
        F.concat_ws(" ", "one", "two").alias("phrase"),
        F.lit(2).alias("words"),
        "a",
        "l",
        "r",
        F.expr(_score("a", "l", "r")).alias("score"),
        F.coalesce(100 * F.col("longer") >= mining.inside * F.col("a"), F.lit(False)).alias("dropped"),
    )
    return two.unionByName(three), words.groupBy("lang").agg(F.sum("n").alias("n"))


def best(found: DataFrame, totals: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """Each language's first ``mining.top`` phrases: lang, rank, phrase, a, l, r, n, score.

    The first of each of some parts are taken before those of the whole language.
    """
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(16))
    kept = found.where("not dropped").withColumn("part", part)
    kept = kept.withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    kept = kept.where(F.col("place") <= mining.top)
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    ranked = ranked.where(F.col("rank") <= mining.top).join(totals, "lang")
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, mining: Mining = Mining()) -> DataFrame:
    return best(*candidates(docs, mining), mining)
