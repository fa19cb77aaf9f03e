"""The n-gram join's queries grow with a group's classes, not with classes times blocks."""

import random

from pyspark.sql import functions as F
from test_llm import brute_components

from sensorloom.llm import ngram_join


def test_the_smaller_group_asks_the_larger(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_MEMBERS", 64)
    rng = random.Random(3)
    base = [f"w{i}" for i in range(200)]

    def changed(number, count):
        words = list(base)
        for k, place in enumerate(rng.sample(range(0, 200, 8), count)):
            words[place] = f"x{number}-{k}"
        return " ".join(words)

    near, beside = 200, 12  # near copies, each linked with any other, and texts that are linked with none
    rows = [(i, changed(i, 1)) for i in range(near)] + [(near + i, changed(near + i, 6)) for i in range(beside)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    tables, kept = {}, ngram_join.written

    def write(frame, name):
        tables[name] = kept(frame, name)
        return tables[name]

    monkeypatch.setattr(ngram_join, "written", write)
    monkeypatch.setattr(ngram_join, "discard", lambda *tables: None)
    found = ngram_join.digest(ngram_join.joined(docs)).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, brute_components(rows)))
    placed = tables["placed"].where("label is not null").groupBy("label").agg(
        F.count("*").alias("classes"), F.countDistinct("unit").alias("blocks")
    )
    largest = placed.orderBy(F.desc("classes")).first()
    assert largest["blocks"] > 1
    # A label is one group to a token, whatever its blocks.
    groups = tables["token-groups"].where("to_label is not null").groupBy("token", "to_label").count()
    assert [r["count"] for r in groups.select("count").distinct().collect()] == [1]
    assert tables["group-queries"].join(tables["placed"].where("label is not null"), "class").count() == 0
