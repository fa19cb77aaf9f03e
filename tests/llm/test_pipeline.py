"""The pipeline's stages on the smallest tables, each against its own input."""

import collections

import pytest
from conftest import SMALL
from test_llm import brute_components, brute_hits, brute_quality, brute_spans

import corpus_pipeline
import __spark_entry__ as entry


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows before the first and after each stage."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
        out.append(docs)
    return out


def pairs(frame):
    return [tuple(r) for r in frame.select("doc_id", "text").collect()]


def test_columns(stages):
    for frame in stages[:-1]:
        assert frame.columns == stages[0].columns


def test_quality_stage(stages):
    before, after = dict(pairs(stages[0])), dict(pairs(stages[1]))
    assert after.items() <= before.items()
    assert all(not brute_quality(t)[-1] for t in after.values())
    passed = [d for d, t in before.items() if not brute_quality(t)[-1]]
    assert len(after) > 0.8 * len(passed)


def test_near_copy_stage(stages):
    before, after = pairs(stages[1]), pairs(stages[2])
    groups = brute_components(before, size=5, least=80)
    assert sorted(d for d, _ in after) == sorted({least for _, _, least in groups})


def test_benchmark_stage(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    expected = [(d, t) for d, t in pairs(stages[2]) if not brute_hits(t, items)[-1]]
    assert sorted(pairs(stages[3])) == sorted(expected)


def test_secret_stage(stages):
    before, after = dict(pairs(stages[3])), dict(pairs(stages[4]))
    assert before.keys() == after.keys()
    none = brute_spans("")
    assert all(brute_spans(t) == none for t in after.values())
    assert all(after[d] == t for d, t in before.items() if brute_spans(t) == none)
    lengths = {r["doc_id"]: r["n_chars"] for r in stages[4].collect()}
    assert all(lengths[d] == len(after[d]) for d in after)


def test_packing_stage(stages):
    rows = stages[5].collect()
    assert {r["doc_id"] for r in rows} == {d for d, _ in pairs(stages[4])}
    bins = collections.Counter()
    for r in rows:
        bins[r["sequence_id"]] += r["length"]
    assert max(bins.values()) <= 1024


def test_registered(spark):
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert {f"op{n}_" for n in range(1, 14)} == {q.split("_")[0] + "_" for q in entry.queries() if q.startswith("op")}
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_empty_tables(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert docs.count() == 0


def test_stages_keep_columns_of_any_name(spark):
    """Columns named like inner ones come out as they went in."""
    names = ["row", "key", "__key", "__blob", "blob_id", "spans", "stays", "rows", "doc", "odd `name`"]
    said = "the cat sat on the mat and looked at the dog that was by the door password=abcdefgh12"
    rows = [(i, said + " " + "x" * (i % 2), "en", "s", 5, *[f"{n}{i}" for n in names]) for i in range(4)]
    fields = [("doc_id", "long"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "long")]
    schema = ", ".join([f"{n} {t}" for n, t in fields] + [f"`{n.replace('`', '``')}` string" for n in names])
    docs = spark.createDataFrame(rows, schema)
    items = spark.createDataFrame([("i", "nothing of this is in any of them at all, be sure")], "item_id string, text string")
    from sensorloom.llm import ngram_join, secret_ledger, winnow

    for made, ids in (
        (ngram_join.one_of_each(docs, corpus_pipeline.NEAR_COPIES), {0}),
        (winnow.decontaminate(docs, items), {0, 1, 2, 3}),
        (secret_ledger.redact(docs), {0, 1, 2, 3}),
    ):
        assert made.columns == docs.columns
        got = {r[0]: r for r in made.collect()}
        assert got.keys() == ids and all(tuple(r)[5:] == rows[i][5:] for i, r in got.items())
