"""Exact top-k search by inner product, by distributed histogram selection.

Vectors become integers (``floor(scale * x)``), so scores are exact and every run gives the same rows. Queries are
taken in groups of ``QUERIES`` at most; for each group, passes over all candidates count the scores into a
histogram of a query's range, the counts of all tasks are added up, and the bin that holds the kth value becomes the
next range, until it is one value wide. A last pass keeps what reaches that value. Of a histogram a task hands
on only the bins from the top down to its own kth value, which the global one can't be below: k rows a query at
most. Of rows at the kth value it keeps the k of least id, as no more can be among the result, so a vector that a
third of all rows share costs no more than any other.

The passes score each query against each row, in blocks; their work grows with queries times rows, which is the
task. Nothing but the vectors of one group, its ranges and its k best rows leaves a task.

Defined results: a vector that is null, or holds a component that is null or not finite, takes no part. Vectors of
different lengths aren't scored with each other. A query's own row is left out, rows that repeat it are not; a
repeated query row is answered again. Ties go to the smaller id, null ids last. No queries, or no other rows, give no
rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sensorloom.llm.common import written

#: Queries whose vectors are broadcast together, and bins of a histogram.
QUERIES, BINS = 2048, 512
_EXACT = 1 << 53


@dataclass(frozen=True)
class Search:
    k: int = 5
    scale: int = 256
    every: int = 50


def prepared(vectors: DataFrame, search: Search) -> DataFrame:
    """row, vec_id, v: the vectors that take part, as integers. Written: ``row`` names one row for good."""
    whole = F.transform("embedding", lambda x: x.cast("double") * search.scale)
    usable = F.forall(whole, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    vectors = vectors.where("embedding is not null").where(usable)
    ints = vectors.select("vec_id", F.transform(whole, lambda x: F.floor(x)).alias("v"))
    return written(ints.withColumn("row", F.monotonically_increasing_id()), "vectors")


class Group:
    """The vectors of some queries of one length, and what is known of each one's kth score."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.rows, self.ids, self.vectors = rows, ids, vectors
        order = np.argsort(rows)
        self.sorted_rows, self.place = rows[order], order
        # Range of the kth score: from low, below high, in bins of this width.
        self.low, self.high, self.width = (np.full(len(rows), x, np.int64) for x in (0, 1, 1))
        self.need = np.full(len(rows), k, np.int64)  # still wanted from the range

    def scores(self, rows: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores of a block and which of them count: exact integers, whatever their size in a long."""
        bound = int(np.abs(self.vectors).max(initial=0)) * int(np.abs(vectors).max(initial=0)) * max(1, vectors.shape[1])
        if bound < _EXACT:
            made = (self.vectors.astype(np.float64) @ vectors.T.astype(np.float64)).astype(np.int64)
        elif bound < 1 << 63:
            made = self.vectors @ vectors.T
        else:
            made = (self.vectors.astype(object) @ vectors.T.astype(object)).astype(np.int64)  # fails beyond a long
        counts = np.ones(made.shape, bool)
        if len(self.rows):
            spot = np.minimum(np.searchsorted(self.sorted_rows, rows), len(self.rows) - 1)
            own = np.flatnonzero(self.sorted_rows[spot] == rows)
            counts[self.place[spot[own]], own] = False
        return made, counts


def _blocks(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
    for batch in batches:
        v = batch.column("v")
        vectors = np.asarray(v.flatten(), np.int64).reshape(len(batch), length)
        yield np.asarray(batch.column("row")), vectors, batch.column("vec_id")


def _range(group: Group, most: int) -> None:
    """The first range of each query, from the Cauchy-Schwarz bound with the greatest squared length."""
    for i, vector in enumerate(group.vectors.astype(object)):
        bound = isqrt(int(vector @ vector) * most) + 1
        group.low[i], group.high[i], group.width[i] = -bound, bound + 1, -(-(2 * bound + 1) // BINS)


def _histogram(candidates: DataFrame, group: Group, k: int) -> DataFrame:
    """query (place in the group), bin, n: global counts of the bins that can hold a kth score."""
    shared, length = candidates.sparkSession.sparkContext.broadcast(group), group.vectors.shape[1]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = shared.value
        total = np.zeros((len(group.rows), BINS), np.int64)
        base = np.arange(len(group.rows))[:, None] * BINS
        for rows, vectors, _ in _blocks(batches, length):
            scores, counts = group.scores(rows, vectors)
            counts &= (scores >= group.low[:, None]) & (scores < group.high[:, None])
            bins = (scores - group.low[:, None]) // group.width[:, None]
            total += np.bincount((bins + base)[counts], minlength=total.size).reshape(total.shape)
        above = np.cumsum(total[:, ::-1], axis=1)[:, ::-1] - total
        query, place = np.nonzero((total > 0) & (above < k))
        yield pa.RecordBatch.from_arrays(
            [pa.array(query, pa.int64()), pa.array(place, pa.int64()), pa.array(total[query, place], pa.int64())],
            names=["query", "bin", "n"],
        )

    made = candidates.mapInArrow(count, "query long, bin long, n long")
    return made.groupBy("query", "bin").agg(F.sum("n").alias("n"))


def _refined(candidates: DataFrame, group: Group, k: int) -> None:
    """Narrow the ranges until each holds one value: the kth score, or the least if there are fewer."""
    settled = np.zeros(len(group.rows), bool)
    down = Window.partitionBy("query").orderBy(F.desc("bin"))
    while not settled.all():  # as often as BINS goes into the first range
        wanted = candidates.sparkSession.createDataFrame(
            [(i, int(n)) for i, n in enumerate(group.need)], "query long, need long"
        )
        reached = _histogram(candidates, group, k).withColumn("reached", F.sum("n").over(down)).join(wanted, "query")
        # The first bin from the top that reaches what is needed, else the last one: there are fewer rows than k.
        enough = F.when(F.col("reached") >= F.col("need"), F.col("bin"))
        found = reached.groupBy("query").agg(
            F.coalesce(F.max(enough), F.min("bin")).alias("bin"),
            F.coalesce(F.max(F.when(F.col("reached") < F.col("need"), F.col("reached"))), F.lit(0)).alias("before"),
            F.max("reached").alias("all"),
        ).toPandas()
        query, place = found["query"].to_numpy(np.int64), found["bin"].to_numpy(np.int64)
        fewer = found["all"].to_numpy(np.int64) < group.need[query]
        group.need[query] = np.where(fewer, k, group.need[query] - found["before"].to_numpy(np.int64))
        there = np.zeros(len(group.rows), bool)
        there[query] = True
        settled |= ~there  # nothing to score with
        settled[query[group.width[query] == 1]] = True
        group.low[query] += place * group.width[query]
        group.high[query] = np.minimum(group.high[query], group.low[query] + group.width[query])
        group.width[query] = -(-group.width[query] // BINS)


def _selected(candidates: DataFrame, group: Group, search: Search) -> DataFrame:
    """query_id, query row, vec_id, score of all rows above the kth score, and of those at it the first by id of
    each task."""
    shared, length = candidates.sparkSession.sparkContext.broadcast(group), group.vectors.shape[1]

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = shared.value
        ties: dict[int, list[int | None]] = {}

        def made(query, ids, scores) -> pa.RecordBatch:
            query = np.asarray(query, np.int64)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(group.ids[query], pa.int64()),
                    pa.array(group.rows[query], pa.int64()),
                    pa.array(ids, pa.int64()),
                    pa.array(scores, pa.int64()),
                ],
                names=["query_id", "query_row", "vec_id", "score"],
            )

        for rows, vectors, ids in _blocks(batches, length):
            scores, counts = group.scores(rows, vectors)
            query, place = np.nonzero(counts & (scores > group.low[:, None]))
            yield made(query, ids.take(pa.array(place, pa.int64())), scores[query, place])
            query, place = np.nonzero(counts & (scores == group.low[:, None]))
            for one, name in _first(query, ids.take(pa.array(place, pa.int64())), search.k):
                held = ties.setdefault(one, [])
                held.append(name)
                if len(held) > 8 * search.k:
                    held.sort(key=_last)
                    del held[search.k :]
        left = [(q, x) for q, held in ties.items() for x in sorted(held, key=_last)[: search.k]]
        if left:
            query, names = zip(*left, strict=True)
            yield made(query, list(names), group.low[list(query)])

    return candidates.mapInArrow(pick, "query_id long, query_row long, vec_id long, score long")


def _first(query: np.ndarray, names: pa.Array, k: int) -> Iterator[tuple[int, int | None]]:
    """The ``k`` of least id of each query of a block."""
    none = np.asarray(names.is_null())
    values = np.asarray(names.fill_null(0))
    order = np.lexsort((values, none, query))
    query, values, none = query[order], values[order], none[order]
    start = np.flatnonzero(np.append(True, query[1:] != query[:-1])[: len(query)])
    place = np.arange(len(query)) - np.repeat(start, np.diff(np.append(start, len(query))))
    for i in np.flatnonzero(place < k):
        yield int(query[i]), None if none[i] else int(values[i])


def _last(name: int | None) -> tuple[bool, int]:
    return name is None, name or 0


def top_k(vectors: DataFrame, search: Search = Search()) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best of every query, one whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    rows = prepared(vectors, search)
    asking = rows.where(F.col("vec_id") % search.every == 0)
    squares = F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    lengths = rows.groupBy(F.size("v").alias("length")).agg(F.max(squares).alias("most")).collect()
    asked = {r["length"]: r["n"] for r in asking.groupBy(F.size("v").alias("length")).agg(F.count("*").alias("n")).collect()}
    out = None
    for length, most in lengths:
        candidates = rows.where(F.size("v") == length)
        parts = -(-asked.get(length, 0) * 2 // QUERIES)
        for part in range(parts):
            chosen = asking.where((F.size("v") == length) & _in_part(part, parts)).orderBy("row").toPandas()
            for at in range(0, len(chosen), QUERIES):
                some = chosen.iloc[at : at + QUERIES]
                matrix = np.array(some["v"].tolist(), np.int64).reshape(len(some), length)
                group = Group(some["row"].to_numpy(np.int64), some["vec_id"].to_numpy(np.int64), matrix, search.k)
                _range(group, int(most * (1 + 1e-9)) + 1)
                _refined(candidates, group, search.k)
                picked = _best(_selected(candidates, group, search), search.k)
                picked = written(picked, "best")
                out = picked if out is None else out.unionByName(picked)
    if out is None:
        out = spark.createDataFrame([], "query_id long, query_row long, rank int, vec_id long, score long")
    return out.select("query_id", "rank", "vec_id", "score")


def _in_part(part: int, parts: int) -> Column:
    return F.pmod(F.xxhash64("row"), F.lit(parts)) == part


def _best(picked: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each query; Spark ranks within tasks before it brings a query together."""
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = picked.withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k).select("query_id", "query_row", "rank", "vec_id", "score")
