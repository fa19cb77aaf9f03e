"""Exact n-gram Jaccard join with a token-group matrix.

Documents are sets of word n-grams. Equal sets form one class. Classes are partitioned into groups of
similar sets, by a least hash; of each group the union of its members' tokens is stored, and a query
opens a group only if enough of the query's tokens lie in that union: |Q and U| >= t |Q| bounds the
overlap with every member. No link is lost: all bounds are exact and every link rests on a count of
common tokens.

Steps, each a Spark job whose tasks hold a bounded number of sets:

1. A sketch counts how many n-grams fall into each of a fixed number of buckets; it gives tokens a
   global order, rare ones first.
2. Every text yields its class, its group and its family (least hashes of its tokens) and its first tokens in the
   global order. A class is compared with the most central class of its group and of its family, that with the
   most frequent tokens; this is linear in their size. Classes linked that way have a label and need no
   comparison with each other: they form the groups of their label. The others are in one group if such comparisons
   connect them, linked or not. Groups are cut into blocks of a bounded number of sets and tokens.
3. Two linked sets share c of the |Q| - ceil(t |Q|) + c first tokens, for any c. Where a query of the smaller of two
   groups has that many first tokens in the union of the other's, it is checked against the blocks
   of the other, and likewise between blocks of one group: bound by the block's whole union, then member by member. The members of a block are checked with each other as well. A task returns
   no more links than its sets need to be connected.
4. The links give connected components.

Sets are computed anew from the texts where they are needed; a bit map of fixed size (a semi-join
filter, whose false hits are joined away) tells which.

Defined results: a text without words, or null, has an empty set and is linked with nothing; rows with
equal texts, also with equal or null ids, are in one component; a component whose ids are all null has
a null id. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from sensorloom.llm.common import discard, release, row_of, written
from sensorloom.llm.components import components

#: Buckets of the sketch that orders tokens, and rows that a task's counts are handed on in.
SKETCH_BUCKETS, SKETCH_ROWS = 1 << 20, 16
#: Bits of the map that tells which sets are needed.
MAP_BITS = 1 << 26
#: Members of a block and queries checked in one task, and tokens of either (a longer set is alone).
BLOCK_MEMBERS, BLOCK_QUERIES, BLOCK_TOKENS = 256, 256, 1 << 18
#: Salts of the least hashes that make groups and families.
FAMILIES = {"group": np.uint64(0xA24BAED4963EE407), "family": np.uint64(0x9FB21C651E98DF25)}
#: One more common first token is asked for with each so many tokens of a set: a few tokens in common
#: are chance in long texts.
SHARE_OF = 50
CACHE_WORDS = 150_000
#: Tokens of the sets that a task hands on at a time.
BATCH_TOKENS = 1 << 19
FACTOR = np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class Join:
    """Sets of ``size`` words; linked if ``over`` * common >= ``least`` * union."""

    size: int = 4
    least: int = 85
    over: int = 100

    def shared(self, n: int) -> int:
        """First tokens that a set of ``n`` shares with any linked one: c in what follows."""
        return 1 + n // SHARE_OF

    def prefix(self, n: int) -> int:
        """Linked sets share c of their first |Q| - ceil(t |Q|) + c tokens."""
        return n - -(-self.least * n // self.over) + self.shared(n)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        value -= (value >> 63) << 64
        self[word] = value
        return value


_HASHES = _Hashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def tokens(text: bytes | None, size: int) -> np.ndarray:
    """The set of a text: sorted hashes of its n-grams (A-Z in lower case)."""
    words = (text or b"").lower().split()
    if len(_HASHES) > CACHE_WORDS:
        _HASHES.clear()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.int64, len(words)).view(np.uint64)
    size = min(size, len(words))
    runs = hashes[: len(words) - size + 1] + np.uint64(size)
    for i in range(1, size):
        runs *= FACTOR
        runs += hashes[i : i + len(runs)]
    runs = _mixed(runs)
    runs.sort()
    fresh = np.ones(len(runs), bool)
    np.not_equal(runs[1:], runs[:-1], out=fresh[1:])
    return runs[fresh]


def _class_of(found: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(found.tobytes(), seed=len(found)) - (1 << 63)


def _bucket(found: np.ndarray) -> np.ndarray:
    return (found >> np.uint64(40)).astype(np.int64) & (SKETCH_BUCKETS - 1)


# ---------------------------------------------------------------- passes over the texts


def row_key(doc_id: Column, text: Column) -> Column:
    """Equal for rows with equal id and text."""
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def sketch(docs: DataFrame, join: Join) -> np.ndarray:
    """Tokens in each bucket, over all documents. Its size is fixed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SKETCH_BUCKETS, np.int32)
        for batch in batches:
            found = [_bucket(tokens(text, join.size)) for text in batch.column("text").to_pylist()]
            if found:
                total += np.bincount(np.concatenate(found), minlength=SKETCH_BUCKETS).astype(np.int32)
        parts = np.minimum(total, 65535).astype(np.uint16).reshape(SKETCH_ROWS, -1)
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array(range(SKETCH_ROWS), pa.int32()), "counts": pa.array([p.tobytes() for p in parts], pa.binary())}
        )

    def add(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(c, np.uint16).astype(np.int64) for c in parts["counts"])
        return pd.DataFrame({"part": [key[0]], "counts": [total.tobytes()]})

    made = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(count, "part int, counts binary")
    rows = made.groupBy("part").applyInPandas(add, "part int, counts binary").collect()
    out = np.zeros((SKETCH_ROWS, SKETCH_BUCKETS // SKETCH_ROWS), np.int64)
    for row in rows:
        out[row["part"]] = np.frombuffer(row["counts"], np.int64)
    return out.reshape(-1)


HEADS = (
    "doc_id long, key string, n long, class long, group long, family long, centre long, prefix array<long>"
)


def heads(docs: DataFrame, counts: np.ndarray, join: Join) -> DataFrame:
    """Per document: size, class, group and family of its set, how frequent its tokens are, and the first of
    them in the global order."""
    mean = max(1.0, float(counts.mean()))
    # On this scale the mean is 256; equal ranks are ordered by hash.
    ranks = np.minimum(counts * (256.0 / mean), 65535).astype(np.uint16)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = shared.value
        for batch in batches:
            n, classes, centres, prefix = [], [], [], []
            families = {name: [] for name in FAMILIES}
            for text in batch.column("text").to_pylist():
                found = tokens(text, join.size)
                n.append(len(found))
                if not len(found):
                    for column in (classes, centres, prefix, *families.values()):
                        column.append(None)
                    continue
                often = ranks[_bucket(found)]
                classes.append(_class_of(found))
                for name, salt in FAMILIES.items():
                    families[name].append(int(_mixed(found ^ salt).min()) - (1 << 63))
                centres.append(int(1024 * often.mean()))
                first = np.argsort(often, kind="stable")[: join.prefix(len(found))]
                prefix.append(found[first].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    batch.column("key").cast(pa.string()),
                    pa.array(n, pa.int64()),
                    pa.array(classes, pa.int64()),
                    *[pa.array(column, pa.int64()) for column in families.values()],
                    pa.array(centres, pa.int64()),
                    pa.array(prefix, pa.list_(pa.int64())),
                ],
                names=["doc_id", "key", "n", "class", *families, "centre", "prefix"],
            )

    key = row_key(F.col("doc_id"), F.col("text")).alias("key")
    return docs.select("doc_id", key, F.col("text").cast("binary").alias("text")).mapInArrow(make, HEADS)


def sets_of(docs: DataFrame, classes: DataFrame, join: Join) -> DataFrame:
    """class, tokens: the sets of ``classes`` (and a few more), each once, written."""
    bit = F.pmod("class", F.lit(MAP_BITS))
    words = classes.groupBy(F.shiftright(bit, 6).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(class, {MAP_BITS}) & 63 as int))")).alias("bits")
    )
    bits = np.zeros(MAP_BITS // 64, np.int64)
    some = words.toPandas()  # at most MAP_BITS / 64 rows
    bits[some["word"].to_numpy(np.int64)] = some["bits"].to_numpy(np.int64)
    shared = docs.sparkSession.sparkContext.broadcast(bits.view(np.uint8))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        needed = shared.value

        def rows(made: dict[int, np.ndarray]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {"class": pa.array(list(made), pa.int64()), "tokens": pa.array(list(made.values()), pa.list_(pa.int64()))}
            )

        for batch in batches:
            made, held = {}, 0
            for text in batch.column("text").to_pylist():
                found = tokens(text, join.size)
                if len(found):
                    number = _class_of(found)
                    place = number % MAP_BITS
                    if number not in made and needed[place >> 3] >> (place & 7) & 1:
                        made[number] = found.view(np.int64)
                        held += len(found)
                        if held > BATCH_TOKENS:
                            yield rows(made)
                            made, held = {}, 0
            yield rows(made)

    found = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(make, "class long, tokens array<long>")
    sets = written(found.groupBy("class").agg(F.first("tokens").alias("tokens")), "sets")
    release(docs.sparkSession)
    return sets


# ---------------------------------------------------------------- links


def _star_links(docs: DataFrame, classes: DataFrame, join: Join) -> tuple[DataFrame, DataFrame]:
    """a, b: links between classes and the most central class of their group and of their family; and class,
    cluster of all classes that were compared."""
    pairs = None
    for family in FAMILIES:
        centre = F.max(F.struct("centre", "class", "n")).alias("top")
        centres = classes.groupBy(family).agg(F.count("*").alias("members"), centre).where("members > 1")
        centres = centres.select(family, F.col("top.class").alias("pivot"), F.col("top.n").alias("pivot_n"))
        some = classes.select("class", "n", family).join(centres.hint("merge"), family)
        small, large = F.least("n", "pivot_n"), F.greatest("n", "pivot_n")
        some = some.where((F.col("class") != F.col("pivot")) & (join.over * small >= join.least * large))
        some = some.select("class", "pivot")
        pairs = some if pairs is None else pairs.unionByName(some)
    pairs = written(pairs.distinct(), "star-pairs")
    sets = sets_of(docs, pairs.select("class").unionByName(pairs.select(F.col("pivot").alias("class"))), join)
    left = pairs.join(sets.hint("merge"), "class").withColumnRenamed("tokens", "own")
    both = left.join(sets.hint("merge").withColumnRenamed("class", "pivot"), "pivot")
    common = F.size(F.array_intersect("own", "tokens"))
    union = F.size("own") + F.size("tokens") - common
    linked = both.where(join.over * common >= join.least * union)
    links = written(linked.select(F.col("class").alias("a"), F.col("pivot").alias("b")), "star-links")
    clusters = components(pairs.select(F.col("class").alias("a"), F.col("pivot").alias("b")))
    discard(pairs, sets)
    release(docs.sparkSession)
    return links, clusters.select(F.col("node").alias("class"), F.col("component").alias("cluster"))


def _placed(classes: DataFrame, labels: DataFrame, clusters: DataFrame) -> DataFrame:
    """class, n, first_key, label (of classes linked already, else null), team: the number of a group, its size, its
    blocks, and unit: the one of these blocks that holds the class."""
    placed = classes.select("class", "n", "first_key", "group").join(labels.hint("merge"), "class", "left")
    placed = placed.join(clusters.hint("merge"), "class", "left")
    placed = placed.withColumn("group", F.coalesce("label", "cluster", "group")).drop("cluster")
    placed = placed.withColumn("team", F.xxhash64("group", F.col("label").isNotNull())).drop("group")
    placed = written(placed, "grouped")
    size = F.count("*")
    blocks = F.greatest(F.ceil(size / BLOCK_MEMBERS), F.least(size, F.ceil(F.sum("n") / BLOCK_TOKENS))).cast("long")
    sizes = placed.groupBy("team").agg(size.alias("size"), blocks.alias("blocks"))
    placed = placed.join(sizes.hint("merge"), "team")
    block = F.pmod(F.xxhash64("class"), F.col("blocks"))
    return written(placed.withColumn("unit", _unit("team", block)), "placed")


def _unit(team: str, block: Column) -> Column:
    return F.xxhash64(team, block)


class _Forest:
    """Disjoint sets of the classes that a task holds."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (y := self.up.setdefault(x, x)) != x:
            self.up[x] = x = self.up.setdefault(y, y)
        return x

    def joins(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[x] = y
        return x != y


def _checked(queries: pd.DataFrame, members: pd.DataFrame, inside: bool, join: Join) -> list[tuple[int, int]]:
    """Links of queries with members, and of members with each other if ``inside``: as many as are
    needed to connect what is linked."""
    sets = members["tokens"].tolist()
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    union = np.unique(flat)
    names = members["class"].to_numpy()
    asking = [*zip(queries["class"], queries["tokens"], strict=True)]
    if inside:
        asking += zip(names, sets, strict=True)
    forest, out = _Forest(), []
    for name, query in asking:
        spot = np.minimum(np.searchsorted(union, query), len(union) - 1)
        within = query[union[spot] == query]
        if join.over * len(within) < join.least * len(query):
            continue  # no member can have enough in common: the group stays closed
        low, high = np.searchsorted(flat, within), np.searchsorted(flat, within, "right")
        lengths = high - low
        hits = np.repeat(low - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        common = np.bincount(owner[hits], minlength=len(sets))
        for i in np.flatnonzero(join.over * common >= join.least * (len(query) + sizes - common)):
            if name != names[i] and forest.joins(int(name), int(names[i])):
                out.append((int(name), int(names[i])))
    return out


def _group_links(docs: DataFrame, rows: DataFrame, placed: DataFrame, join: Join) -> DataFrame:
    """a, b: links between classes of different groups, and of groups without a label. ``placed``: see there."""
    heads_of = rows.select("class", F.col("key").alias("first_key"), "prefix")
    spread = heads_of.join(
        placed.select("class", "first_key", F.coalesce("label", "unit").alias("mark")).hint("merge"),
        ["class", "first_key"],
    ).select("class", "mark", F.explode("prefix").alias("token"))
    # Only tokens of two groups matter. The first tokens are rare ones.
    of_token = Window.partitionBy("token")
    spread = spread.withColumns({"low": F.min("mark").over(of_token), "high": F.max("mark").over(of_token)})
    tokens_of = written(spread.where("low < high").select("token", "class").distinct(), "shared-tokens")
    own = placed.select("class", "n", "unit", "label", "team", "size")
    shared = written(tokens_of.join(own.hint("merge"), "class"), "shared-token-rows")
    discard(tokens_of)
    release(docs.sparkSession)
    index = shared.groupBy("token", F.col("team").alias("to")).agg(
        F.min("n").alias("least"),
        F.max("n").alias("most"),
        F.first("label").alias("to_label"),
        F.first("size").alias("to_size"),
        (F.min("unit") < F.max("unit")).alias("several"),
    )
    close = (join.least * F.col("n") <= join.over * F.col("most")) & (
        join.least * F.col("least") <= join.over * F.col("n")
    )
    apart = ~F.coalesce(F.col("label") == F.col("to_label"), F.lit(False))
    # Of two groups the smaller asks, once for all blocks of the other: a token's rows grow with its classes, not
    # with classes times blocks. A group of several blocks asks itself as well.
    asking = (F.struct("size", "team") < F.struct("to_size", "to")) | ((F.col("team") == F.col("to")) & F.col("several"))
    index = written(index, "token-groups")
    asks = shared.join(index.hint("merge"), "token").where(asking & close & apart)
    fewest = 1 + F.floor(F.least(F.min("n"), F.min("least")) / SHARE_OF)
    asks = asks.groupBy("class", "n", "unit", "team", "to").agg(F.count("*").alias("common"), fewest.alias("fewest"))
    asks = asks.where("common >= fewest")
    blocks = placed.groupBy(F.col("team").alias("to")).agg(F.max("blocks").alias("blocks"))
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")
    asks = asks.join(blocks.hint("merge"), "to").select("class", "n", "unit", "team", "to", block)
    asks = asks.select("class", "n", "unit", (F.col("team") == F.col("to")).alias("within"), _unit("to", F.col("block")).alias("to"))
    asks = asks.where("not within or unit < to")
    asks = written(asks.select("class", "to", "n"), "group-queries")
    discard(shared, index)
    release(docs.sparkSession)
    # Units of two or more classes that aren't linked yet are checked inside as well.
    inner = placed.where("label is null").groupBy("unit").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.greatest(F.ceil(F.count("*") / BLOCK_QUERIES), F.ceil(F.sum("n") / BLOCK_TOKENS)).cast("int")
    parts = asks.groupBy("to").agg(parts.alias("parts"))
    parts = parts.join(inner.select(F.col("unit").alias("to"), F.lit(True).alias("inside")), "to", "full")
    parts = written(
        parts.select("to", F.coalesce("parts", F.lit(1)).alias("parts"), F.coalesce("inside", F.lit(False)).alias("inside")),
        "opened-groups",
    )
    members = placed.select("class", F.col("unit").alias("to")).join(parts.hint("merge"), "to").select(
        "class", "to", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "inside", F.lit(False).alias("asks")
    )
    queries = asks.join(parts.hint("merge"), "to").select(
        "class", "to", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int").alias("part"), "inside", F.lit(True).alias("asks")
    )
    every = written(members.unionByName(queries), "opened")
    sets = sets_of(docs, every.select("class"), join)
    filled = every.join(sets.hint("merge"), "class")

    def check(group: pd.DataFrame) -> pd.DataFrame:
        queries, members = group[group["asks"]], group[~group["asks"]]
        inside = bool(group["inside"].iloc[0]) and int(group["part"].iloc[0]) == 0
        found = _checked(queries, members, inside, join) if len(members) else []
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    links = written(filled.groupBy("to", "part").applyInPandas(check, "a long, b long"), "group-links")
    discard(sets, every, asks)
    release(docs.sparkSession)
    return links


# ---------------------------------------------------------------- results


def joined(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """doc_id, key, n_shingles, component_id and joint of every row.

    ``joint`` is the component's inner number, null for rows that are linked with no other.
    """
    rows = written(heads(docs, sketch(docs, join), join), "heads")
    classes = rows.where("n > 0").groupBy("class").agg(
        F.min("n").alias("n"),
        *[F.min(name).alias(name) for name in (*FAMILIES, "centre")],
        F.min("key").alias("first_key"),
        F.min("doc_id").alias("least"),
        F.count("*").alias("copies"),
    )
    classes = written(classes, "classes")
    links, clusters = _star_links(docs, classes, join)
    labels = components(links).select(F.col("node").alias("class"), F.col("component").alias("label"))
    # The same row of the documents stands for a class everywhere, copies of it included.
    placed = _placed(classes, labels, clusters)
    found = _group_links(docs, rows.where("n > 0"), placed, join)
    slim = written(rows.select("doc_id", "key", "n", "class"), "document-classes")
    discard(rows)
    joint = components(found.unionByName(links))
    joint = joint.select(F.col("node").alias("class"), F.col("component").alias("joint"))
    # A class without links only needs an id of its own where it has copies.
    named = classes.select("class", "least", "copies").join(joint, "class", "left")
    named = named.where((F.col("copies") > 1) | F.col("joint").isNotNull())
    named = written(named.withColumn("joint", F.coalesce("joint", "class")), "members")
    ids = written(named.groupBy("joint").agg(F.min("least").alias("component_id")), "component-ids")
    named = written(named.select("class", "joint").join(ids, "joint"), "named")
    return slim.join(named, "class", "left").select(
        "doc_id",
        "key",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        "joint",
    )


def digest(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """``docs`` with one row of each component: that with the least id (null last), then text key.

    Rows with an empty set are linked with nothing and all stay.
    """
    rows = written(joined(docs, join).where("joint is not null").select("doc_id", "key", "joint"), "linked-rows")
    rank = F.struct(F.isnull("doc_id").alias("none"), "doc_id", "key")
    first = written(rows.groupBy("joint").agg(F.min(rank).alias("first")), "first-rows")
    judged = rows.join(first.hint("merge"), "joint")
    judged = judged.groupBy("key").agg(
        F.max(F.col("first.key") == F.col("key")).alias("stays"), F.count("*").alias("rows")
    )
    judged = written(judged.where("not stays or rows > 1"), "judged-rows")
    keyed = docs.select(row_of(docs), row_key(F.col("doc_id"), F.col("text")).alias("key"))
    marked = keyed.join(judged.hint("merge"), "key", "left")
    stays = marked.where("stays is null")
    repeated = marked.where("stays").dropDuplicates(["key"])
    return stays.unionByName(repeated).select("row.*")
