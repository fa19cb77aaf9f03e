"""Phrase mining, top-k search and conversation repair against SQL and brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from oracle_check import connect, differences
from pyspark.sql import functions as F

from sensorloom.llm import collocations, topk, turns
from sensorloom.llm.oracle import LLM_ORACLE
from sensorloom.llm.queries import LLM_QUERIES

SF = "/root/testdata/sf0.01"


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("name", ["op11_collocation_tiles", "op12_histogram_topk"])
def test_equals_sql(spark, name):
    assert differences(LLM_QUERIES[name](spark, SF), connect(SF), LLM_ORACLE[name]) == []


# ---------------------------------------------------------------- phrases


def brute_phrases(rows, least=10, top=2000, inside=50):
    counts, total = {}, Counter()
    for lang, text in rows:
        found = counts.setdefault(lang or "und", Counter())
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            words = re.findall("[^ \t]+", piece)
            total[lang or "und"] += len(words)
            for size in (1, 2, 3):
                found.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, found in counts.items():
        often = {p: a for p, a in found.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in often.items():
            if any(len(q) > len(p) and 100 * b >= inside * a and p in (q[:2], q[1:]) for q, b in often.items()):
                continue
            cuts = [(1000000 * a * a // (found[p[:k]] * found[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            kept.append((score, a, " ".join(p), found[p[:k]], found[p[k:]]))
        kept.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, i, p, a, le, r, total[lang], s) for i, (s, a, p, le, r) in enumerate(kept[:top], 1)]
    return ordered(out)


def phrase_rows(seed=3):
    """Common words and phrases, ties, nulls, odd spaces, upper case and letters beyond ASCII."""
    rng = random.Random(seed)
    rows = [(None, None), ("en", ""), ("en", " \t "), (None, "A b A b, a b. A B a b a b a b\x0bA b a b ! a b a b a b a b"), ("en", "x\x00y \x1cz " * 15)]
    names = ["Été", "straße", "İx", "new", "york", "city", "the", "of", "a b"] + [f"w{i}" for i in range(40)]
    for i in range(400):
        words = rng.choices(names, weights=[9, 8, 7, 6, 6, 5, 30, 20, 4] + [1] * 40, k=rng.randrange(60))
        if i % 3 == 0:
            words += ["New", "York\tcity"] * rng.randrange(4)
        rows.append((rng.choice(["en", "de", None]), rng.choice(["en ", " ", ", ", "\n"]).join(words) if i % 7 else " ".join(words)))
    return rows + [("en", "tick tock " * 6000)]


PHRASES = "lang string, text string, n long, hash long, tile string, word int, first int"


@pytest.mark.parametrize("head", [1 << 19, 20, 0])
def test_phrases_brute(spark, head):
    """With a head of all words, of a few, and none: the sparse tiles count the rest."""
    rows = phrase_rows()
    docs = spark.createDataFrame([(*r, 1, 2, "t", 3, 4) for r in rows], PHRASES).repartition(5)
    for mining in (collocations.Mining(head=head, map_bits=1 << 14), collocations.Mining(head=head, least=3, top=7, strips=3)):
        want = brute_phrases(rows, least=mining.least, top=mining.top)
        assert len(want) > 20 and ordered(collocations.collocations(docs, mining).collect()) == want


@pytest.mark.parametrize("dense", [0, 1 << 22])
def test_phrases_of_small_chunks(spark, dense, monkeypatch):
    """Small chunks, added up in many parts, in tiles that are all sparse or all dense."""
    for name, value in (("CHUNK_IDS", 300), ("CHUNK_WORDS", 40), ("HELD_CELLS", 50), ("DENSE_CELLS", dense)):
        monkeypatch.setattr(collocations, name, value)
    rows = phrase_rows(5)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    assert ordered(collocations.collocations(docs).collect()) == brute_phrases(rows)


def test_tile_rows_hold_every_cell():
    letters = collocations._letters(np.arange(5, 105), np.arange(100, 0, -1), np.arange(5, 105)[:, None], 6)
    assert letters.find(np.array([5, 104, 4, 105])).tolist() == [0, 99, -1, -1]
    assert sum(letters.width(i) for i in range(len(letters.starts))) == 100
    rng = np.random.default_rng(0)
    first, second = rng.integers(0, 100, 5000), rng.integers(0, 100, 5000)
    got = Counter()
    for _, tile, cells, counts in collocations._tile_rows("x", first, second, letters, letters):
        down, right = divmod(tile, len(letters.starts))
        cells = np.cumsum(np.frombuffer(cells, np.int64))
        a, b = np.divmod(cells, letters.width(right))
        for x, y, n in zip(a + letters.starts[down], b + letters.starts[right], np.frombuffer(counts, np.int64)):
            got[int(x), int(y)] += int(n)
    assert got == Counter(zip(first.tolist(), second.tolist()))


def test_a_clash_of_hashes_takes_another_seed(spark, monkeypatch):
    rows = [("en", "aa bb " * 20), ("en", "cc dd " * 20)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    real = collocations.word_counts
    seeds = []

    def clashing(docs, seed):
        seeds.append(seed)
        made = real(docs, seed)
        return made.withColumn("hash", F.lit(7).cast("long")) if seed == 0 else made

    monkeypatch.setattr(collocations, "word_counts", clashing)
    got = collocations.collocations(docs)
    assert seeds == [0, 1] and ordered(got.collect()) == brute_phrases(rows)


def test_scores_are_exact_beyond_64_bits(spark):
    a, le, r = 3_000_000_000_007, 4_000_000_000_009, 5_000_000_000_011
    frame = spark.createDataFrame([(a, le, r)], "a long, l long, r long")
    assert frame.select(F.expr(collocations._score("a", "l", "r"))).first()[0] == 1000000 * a * a // (le * r)


def test_no_phrases(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(empty).collect() == []
    rare = spark.createDataFrame([("en", "one two three")], "lang string, text string")
    assert collocations.collocations(rare).collect() == []


# ---------------------------------------------------------------- search


def brute_top(rows, k=5, every=50):
    usable = [
        (vec_id, [int(np.floor(256.0 * x)) for x in v])
        for vec_id, v in rows
        if v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for i, (query, q) in enumerate(usable):
        if query is None or query % every:
            continue
        found = [
            (-sum(a * b for a, b in zip(q, v)), name is None, name or 0, name)
            for j, (name, v) in enumerate(usable)
            if j != i and len(v) == len(q)
        ]
        out += [(query, rank, name, -s) for rank, (s, _, _, name) in enumerate(sorted(found)[:k], 1)]
    return ordered(out)


def search_rows():
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(400)]  # ties in every query
    rows += [(100, rows[100][1]), (150, rows[7][1]), (None, rows[7][1]), (None, [9.0] * 6)]  # repeated rows, null ids
    rows += [(2000, None), (2050, [1.0, None, 2.0, 0.0, 0.0, 0.0]), (2100, [float("nan")] * 6), (2150, [float("inf")] * 6)]
    rows += [(-50, [1.0, 2.0]), (-51, [1.0, -2.0]), (-52, []), (-100, []), (-150, [0.5] * 3)]
    return rows + [(0, [0.0] * 6)]


VECTORS = "vec_id long, embedding array<double>, row int, v string, score int, rank int"


@pytest.mark.parametrize("queries", [2048, 3])
def test_search_brute(spark, queries, monkeypatch):
    monkeypatch.setattr(topk, "QUERIES", queries)
    rows = search_rows()
    frame = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], VECTORS).repartition(4)
    assert ordered(topk.top_k(frame).collect()) == brute_top(rows)
    if queries > 3:
        assert ordered(topk.top_k(frame, topk.Search(k=1)).collect()) == brute_top(rows, k=1)
        assert ordered(topk.top_k(frame, topk.Search(k=2000)).collect()) == brute_top(rows, k=2000)


def test_search_beyond_exact_floats(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=4) * 1e6).tolist()) for i in range(120)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert ordered(topk.top_k(frame).collect()) == brute_top(rows)


def test_search_without_queries_or_rows(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(empty).collect() == [] and topk.top_k(empty).columns == ["query_id", "rank", "vec_id", "score"]
    alone = spark.createDataFrame([(50, [1.0])], "vec_id long, embedding array<float>")
    assert topk.top_k(alone).collect() == []
    assert topk.top_k(spark.createDataFrame([(1, [1.0]), (2, [1.0])], "vec_id long, embedding array<float>")).collect() == []


# ---------------------------------------------------------------- conversations


def brute_repair(table):
    """By conversation: a shortest path over (cost, audit), least in ASCII order."""
    held = {}
    for conv, turn, role, text in table:
        rows = held.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        rows += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return ordered(_brute_one(conv, rows) for conv, rows in held.items())


def _brute_one(conv, rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    known = [r[0] for r in rows if r[0] is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    seen, faults = set(), []
    for _, role, text in rows:
        words = re.sub("[ \t-\r]+", "", text)
        fault = "blank" if not words else "duplicate" if (role, text) in seen else "" if words[-1] in ".!?" else "truncated"
        seen.add((role, text))
        faults.append(fault)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = {"": (0, "", ())}

    def insert(best):
        for _ in range(2):
            for state, (cost, audit, lines) in list(best.items()):
                for letter, role in (("u", "user"), ("a", "assistant")):
                    if to := step.get((state, letter)):
                        new = (cost + 3, audit + "I", (*lines, f"{role}:"))
                        best[to] = min(best.get(to, new), new, key=lambda x: x[:2])
        return best

    for (_, role, text), fault in zip(rows, faults):
        best, after = insert(best), {}
        for state, (cost, audit, lines) in best.items():
            ways = [(cost + 4, audit + "D", lines, state)]
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                if to := step.get((state, role[:1])):
                    ways.append((cost + more, audit + "K", (*lines, f"{role}:{text}"), to))
                for letter, name in (("u", "user"), ("a", "assistant")):
                    if to := step.get((state, letter)):
                        ways.append((cost + more + 3, audit + "R", (*lines, f"{name}:{text}"), to))
            for *new, to in ways:
                after[to] = min(after.get(to, tuple(new)), tuple(new), key=lambda x: x[:2])
        best = after
    best = insert(best)
    cost, audit, lines = min((best[s] for s in ("", "a") if s in best), key=lambda x: x[:2])
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


TURNS = "conv_id long, turn long, role string, text string, place string, letter int, chunk int, kind string"


def repair_rows(seed=0):
    rng = random.Random(seed)
    roles, texts = ["user", "assistant", "system", "tool", None, "", "User", "spam"], ["Hi.", "No", "", None, " \n", "Why? \t", "So!", "é", "Hi.\x85"]
    rows = []
    for conv in [None, *range(60)]:
        for turn in range(rng.randrange(1, 14)):
            role = rng.choice(roles[:3]) if rng.random() < 0.8 else rng.choice(roles)
            text = f"say {rng.random()}{rng.choice(['.', '', '!'])}" if rng.random() < 0.6 else rng.choice(texts)
            rows.append((conv, turn * rng.choice([1, 1, 3]) if conv != 3 else None, role, text))
    # Turns of equal number are ordered by role and hash; the brute force keeps one each.
    return list({(r[0], r[1] if r[1] is not None else rng.random()): r for r in rows if r[1] is not None or r[0] == 3}.values())[:]


def check(spark, rows):
    frame = spark.createDataFrame([(*r, "p", 1, 2, "k") for r in rows], TURNS).repartition(3)
    got = ordered(turns.repaired(frame).collect())
    want = brute_repair(rows)
    assert [g for g, w in zip(got, want) if g != w] == [w for g, w in zip(got, want) if g != w] and got == want


@pytest.mark.parametrize("chunk", [1 << 12, 4, 1])
def test_repair_brute(spark, chunk, monkeypatch):
    monkeypatch.setattr(turns, "CHUNK", chunk)
    rows = [r for r in repair_rows() if r[1] is not None] + [(99, None, "user", "one.")]
    check(spark, rows)


def test_repair_of_a_long_conversation(spark, monkeypatch):
    """Stretches where costs never meet (rows that are best deleted), over many chunks, among ordinary ones."""
    monkeypatch.setattr(turns, "CHUNK", 8)
    rng = random.Random(4)
    rows = [(1, i, ["user", "assistant"][i % 2], f"t{i}.") for i in range(120)]
    rows += [(1, 200 + i, "system", f"cut{i}") for i in range(150)]  # all truncated and out of place
    rows += [(1, 400 + i, rng.choice(["user", "assistant", "system"]), f"z{i}{rng.choice(['', '.'])}") for i in range(90)]
    rows += [(1, 600 + i, "user", "same words again.") for i in range(100)]
    rows += [(2, i, "system", f"s{i}") for i in range(70)]
    check(spark, rows)


def test_starts_of_chunks_meet():
    """A fix-up pass stops where costs meet, and finds what a run to the end finds."""
    rng = random.Random(1)
    for _ in range(300):
        letters = "".join(rng.choices("uasxUASXbd", k=rng.randrange(1, 30)))
        old, new = (turns._level(turns._closed(tuple(rng.randrange(8) for _ in range(4)))) for _ in range(2))
        known = (old, turns._start(letters, old))
        assert turns._start(letters, new, known) == turns._start(letters, new)


def test_repair_on_tables_and_empty(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    assert ordered(LLM_QUERIES["op13_viterbi_repair"](spark, SF).collect()) == brute_repair(rows)
    assert turns.repaired(spark.createDataFrame([], TURNS)).collect() == []
    gone = next(i for i in range(500) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got = turns.repaired(spark.createDataFrame([(gone, 0, "user", "a.", "p", 1, 2, "k")], TURNS)).collect()
    assert [tuple(r) for r in got] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]
