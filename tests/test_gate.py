"""The slide gate against a plain walk, however many levels its maps have."""

import random

import pytest
from pyspark.sql import functions as F

from sensorloom.operators.gate import evaluation_points, stretch_maps


def walked(rows, slide):
    due, out = {}, []
    for key, at in sorted(rows):
        if key not in due or at >= due[key]:
            out.append((key, at))
            due[key] = at + slide
    return sorted(out)


def maxima(seed, keys=4, rows=900):
    """Key 0 has most rows; gaps range from none at all to many widest stretches."""
    rng = random.Random(seed)
    found = set()
    for _ in range(rows):
        key = 0 if rng.random() < 0.7 else rng.randrange(keys)
        found.add((key, rng.choice([rng.randrange(-500, 500), rng.randrange(-40_000, 90_000), 10**9 + rng.randrange(300)])))
    return sorted(found)


def frame_of(spark, rows):
    return spark.createDataFrame([(*r, r[1] * 2) for r in rows], "key int, at long, more long")


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize(("fan_out", "serial_rows"), [(64, 1 << 16), (4, 1), (2, 8), (3, 40)])
def test_gate_matches_a_walk(spark, seed, fan_out, serial_rows):
    rows, slide = maxima(seed), [1, 7, 60][seed]
    out = evaluation_points(frame_of(spark, rows), ["key"], "at", slide, fan_out, serial_rows)
    assert out.columns == ["key", "at", "more"]
    found = out.collect()
    assert sorted((r["key"], r["at"]) for r in found) == walked(rows, slide)
    assert all(r["more"] == 2 * r["at"] for r in found)


def test_gate_of_the_widest_times(spark):
    rows = [(key, at) for key in range(3) for at in (-(2**61), -(2**61) + 1, 0, 5, 9, 2**61, 2**61 + 5)]
    out = evaluation_points(frame_of(spark, rows), ["key"], "at", 5, 64, 1)
    assert sorted((r["key"], r["at"]) for r in out.collect()) == walked(rows, 5)


def test_gate_of_nothing(spark):
    assert evaluation_points(frame_of(spark, [(0, 0)]).where("key > 0"), ["key"], "at", 5).collect() == []


def test_every_level_shrinks_the_hottest_key(spark):
    fan_out, slide = 16, 10
    hot = spark.range(200_000).select(F.lit(1).alias("key"), (F.col("id") * 3).alias("at"))
    cold = spark.range(50).select(F.lit(2).alias("key"), (F.col("id") * 700).alias("at"))
    levels = stretch_maps(hot.union(cold), ["key"], "at", slide, fan_out, 50)
    sizes = [200_000] + [rows.where("key = 1").count() for _, rows in levels]
    assert len(levels) == 4 and sizes[-1] <= 50
    # the maxima of one slide (four) and the first one beyond it, a stretch
    for (width, _), size in zip(levels, sizes[1:]):
        assert size <= 5 * (600_000 // width + 1)
    widest = [rows.groupBy("key", "__stretch").count().agg(F.max("count")).first()[0] for _, rows in levels]
    assert max(widest) <= 5
