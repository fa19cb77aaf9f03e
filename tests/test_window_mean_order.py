"""Window means add their doubles in one order, from the last arrival to the first, as the SQL does."""

import random
from functools import reduce
from operator import add

from pyspark.sql import functions as F

from sensorloom.functions.arrival import arrival
from sensorloom.operators.windows import WindowSpec, sliding_windows

WHOLE = [45.85, 57.73, 36.05, 5.88, 3.85, 19.29, 6.35]  # 175.00


def test_a_window_is_summed_from_its_last_arrival(spark):
    rng = random.Random(5)
    orders = {f"s{i}": rng.sample(WHOLE, len(WHOLE)) for i in range(40)}
    wanted = {sensor: reduce(add, reversed(values)) / len(values) for sensor, values in orders.items()}
    assert len(set(wanted.values())) > 1  # the order shows
    spec = WindowSpec(60, 30, 15)
    rows = [(sensor, i * 5, v, i) for sensor, values in orders.items() for i, v in enumerate(values)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "sensor_id string, s int, value double, number int").repartition(5)
    at = F.timestamp_seconds(F.col("s") + 1_700_000_000)
    readings = frame.select(
        "sensor_id", F.lit("m").alias("machine_id"), at.alias("ts"), "value",
        arrival(at, 1, F.col("number") % 4, F.col("number")),
    )
    windows = sliding_windows(readings, spec=spec).where(F.col("n_items") == len(WHOLE))
    assert {r["sensor_id"]: r["mean_value"] for r in windows.collect()} == wanted
