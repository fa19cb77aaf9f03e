"""Window means that meet a threshold exactly, whatever order their rows come in."""

import random
from functools import reduce
from operator import add

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorloom.operators import decide
from sensorloom.operators.windows import statistics
from sensorloom.streaming.processor import mean

WHOLE = [45.85, 57.73, 36.05, 5.88, 3.85, 19.29, 6.35]  # 175.00


def orders(values, count=60):
    rng = random.Random(5)
    return [rng.sample(values, len(values)) for _ in range(count)]


def test_orders_matter_to_plain_sums():
    assert len({reduce(add, values) / 7 for values in orders(WHOLE)}) > 1


def test_a_mean_at_a_threshold_breaks_no_rule(spark):
    rows = [(g, v, float(t)) for g, values in enumerate(orders(WHOLE)) for t, v in enumerate(values)]
    stats = statistics(spark.createDataFrame(rows, "g int, value double, t double").coalesce(1), ["g"])
    assert {r["mean_value"] for r in stats.collect()} == {25.0}
    limits = {"has_config": True, "min_threshold": 25.0, "max_threshold": 25.0, "max_std_dev": 0.0, "max_drift": 0.0}
    judged = decide.evaluate_rules(stats.withColumns({k: F.lit(v) for k, v in limits.items()}))
    assert not judged.where("is_anomaly").count()


def test_the_stream_has_the_same_means():
    assert {mean(np.array(values)) for values in orders(WHOLE)} == {25.0}


@pytest.mark.parametrize("values", [[1e300, 1e300], [1 / 3, 2 / 3, 1e-9], [float("nan"), 1.0], [9e12, 9e12, -1.5], [-0.0]])
def test_other_numbers_have_the_plain_mean(spark, values):
    frame = spark.createDataFrame([(0, v, 0.0) for v in values], "g int, value double, t double")
    got = statistics(frame.coalesce(1), ["g"]).first()["mean_value"]
    assert got == pytest.approx(sum(values) / len(values), nan_ok=True)
    assert mean(np.array(values)) == pytest.approx(got, nan_ok=True)
