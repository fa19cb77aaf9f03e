"""What the streams cost: records made on all cores, rows without a data frame per sensor."""

from conftest import SMALL
from pyspark.sql import Row

from sensorloom.operators.windows import WindowSpec
from sensorloom.sources import derived
from sensorloom.streaming.processor import SlidingWindowProcessor

INPUT = Row("sensor_id", "machine_id", "ts_us", "value", "at_us", "source", "partition", "offset", "state", "stop_us")


class Held:
    def __init__(self):
        self.value = None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


class HeldList(Held):
    def get(self):
        return iter(self.value or [])

    def put(self, items):
        self.value = items

    def appendList(self, items):
        self.value = [*(self.value or []), *items]

    def clear(self):
        self.value = None


def test_records_of_a_table_of_one_row_group_are_made_on_all_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    assert derived.events(spark, SMALL).rdd.getNumPartitions() < cores
    for made in (derived.raw_records, derived.readings, derived.lifecycle_messages):
        assert made(spark, SMALL).rdd.getNumPartitions() == cores


def test_rows_come_and_go_as_rows():
    machine = SlidingWindowProcessor(WindowSpec(60, 30, 15))
    machine.clock, machine.buffer = Held(), HeldList()
    s = 1_000_000
    rows = [
        INPUT("a", "m2", 100 * s, 2.0, 7, 1, 0, 0, None, None),
        INPUT("a", "m1", 100 * s, 1.0, 7, 1, None, 9, None, None),  # a missing partition sorts first
        INPUT("a", "m3", 131 * s, 4.5, 8, 1, 0, 1, None, None),
    ]
    made = list(machine.handleInputRows(("a",), iter(rows), None))
    assert [(w.machine_id, w.window_end_us, w.n_items, w.mean_value) for w in made] == [
        ("m1", 100 * s, 1, 1.0), ("m3", 131 * s, 3, 2.5)
    ]
    stop = INPUT("a", None, None, None, 9, 0, 0, 0, "STOPPED", 100 * s)
    late = INPUT("a", "m1", 140 * s, 9.0, 10, 1, 0, 2, None, None)
    assert not list(machine.handleInputRows(("a",), iter([late, stop]), None))
    assert machine.clock.get() == (131 * s, 131 * s, True, 0)
    assert [item[0] for item in machine.buffer.get()] == [100 * s, 100 * s]
