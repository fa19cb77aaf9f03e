"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) names the tables, ``BENCH_CPUS`` (default 8) the
local cores. After one warm-up query each query runs once, whole, into a no-op sink; eager writes
of intermediate tables and streams count into its time. For streams, which also build their input and
start several times in that time, ``stream_rows_per_sec`` tells the rows a second of their micro-batches alone.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql.streaming import StreamingQueryListener  # noqa: E402

from sensorloom.plans import streams  # noqa: E402,F401  registers the streaming queries
from sensorloom.plans.queries import QUERIES  # noqa: E402
from sensorloom.session import build_session  # noqa: E402

HEADLINE = (
    "ingest_clean",
    "envelope_encode",
    "window_stats",
    "sliding_eval",
    "sliding_eval_sessions",
    "decision_stage",
    "metrics_snapshot",
    "points_last_write_wins",
    "event_counters",
    "lifecycle_asof",
    "throughput_rate",
    "latency_percentiles",
    "stream_ingest",
    "stream_sliding_eval",
)


class Batches(StreamingQueryListener):
    """Input rows and milliseconds of all micro-batches since the last look."""

    def __init__(self) -> None:
        self.rows = self.millis = 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.rows += event.progress.numInputRows
        self.millis += event.progress.durationMs.get("triggerExecution", 0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def rate(self) -> int:
        found = round(1000 * self.rows / self.millis) if self.millis else 0
        self.rows = self.millis = 0
        return found


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    QUERIES["sliding_eval"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    batches = Batches()
    spark.streams.addListener(batches)
    seconds: dict[str, float] = {}
    streamed: dict[str, int] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        if name.startswith("stream_"):
            time.sleep(1)  # the last progress reports are on their way
            streamed[name] = batches.rate()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "events": rows,
                "events_per_sec": {n: round(rows / s) for n, s in seconds.items()},
                "stream_rows_per_sec": streamed,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
