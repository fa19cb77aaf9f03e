"""The queries of ``sensorloom.plans.queries`` restated as SQL on the given tables.

The SQL is written from the definitions, not from the Spark plans: the sliding window, for instance,
replays each sensor's rows one by one in a recursive query and trims the buffer by arrival number.
"""

from __future__ import annotations

HOUR_US = 3_600_000_000
SIZE, SLIDE, LATENESS = 60 * HOUR_US, 30 * HOUR_US, 15 * HOUR_US
RANGE, BUCKET = 180 * HOUR_US, 120 * HOUR_US
NOW = "TIMESTAMP '2024-01-31 00:00:00'"
COUNTER_NOW = "TIMESTAMP '2024-01-16 12:00:00'"
STATS = ("min_value", "mean_value", "max_value", "std_dev", "rate_of_change")


def _with(*ctes: str, select: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + select


def r(expr: str, digits: int = 6) -> str:
    return f"(round({expr}, {digits}) + 0.0::DOUBLE)"


def arrived(at: str, source: str, partition: str, offset: str) -> str:
    """The arrival order over sources and partitions; structs are compared field by field."""
    return f"""{{'at': {at}, 'source': ({source})::INTEGER, 'partition': ({partition})::INTEGER,
      'offset': ({offset})::BIGINT}}"""


SPREAD = """arrived."at" AS recorded, arrived.source AS source, arrived."partition" AS "partition",
  arrived."offset" AS "offset\""""


BASE = f"""base AS (
  SELECT event_id, ts, user_id, event_type, value AS plain_value,
    CAST(user_id AS VARCHAR) AS sensor_id,
    'machine_' || CAST(user_id % 10 AS VARCHAR) AS machine_id,
    CASE WHEN user_id % 2 = 0 THEN 'pressure-topic-sensor'
         ELSE 'temperature-topic-sensor' END AS topic,
    CASE WHEN event_id % 100 = 0 THEN CAST(-999.99 AS DOUBLE) ELSE value END AS value,
    ts + to_hours(CAST((event_id * 7919) % 48 AS INTEGER)) AS arrival,
    (event_id % 4)::INTEGER AS "partition", event_id // 4 AS "offset",
    {arrived("ts + to_hours(CAST((event_id * 7919) % 48 AS INTEGER))",
             "CASE WHEN user_id % 2 = 0 THEN 2 ELSE 1 END", "event_id % 4", "event_id // 4")} AS arrived
  FROM events)"""

RECORDS = """records AS (
  SELECT *,
    CASE WHEN event_id % 97 = 13 THEN 'malformed' WHEN event_id % 40 = 7 THEN 'marker'
         WHEN event_id % 101 = 17 THEN 'unhandled' ELSE 'data' END AS route,
    event_id % 103 = 19 AS broken,
    event_id % 89 <> 5 AS measured,
    CASE WHEN event_id % 83 = 11 THEN '' ELSE sensor_id END AS payload_id,
    CASE WHEN event_id % 97 <> 13 AND event_id % 40 = 7 THEN 'LATENCY_MARKER'
         ELSE sensor_id END AS rkey,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_time_text,
    CASE WHEN user_id % 2 = 0 THEN 'pressure' ELSE 'temperature' END AS kind
  FROM base),
data AS (SELECT * FROM records WHERE route = 'data' AND NOT broken),
typed AS (
  SELECT *, CASE WHEN measured THEN value ELSE 0.0::DOUBLE END AS measure FROM data),
clean AS (
  SELECT * FROM typed
  WHERE CASE WHEN kind = 'temperature' THEN measure > -100 AND measure < 400
             ELSE measure >= 0 AND measure <= 300 END)"""

READINGS = "items AS (SELECT * FROM base)"


def sliding(keys: tuple[str, ...] = ("sensor_id",)) -> str:
    """CTEs from ``items`` to ``windows`` (and ``clocked``, ``kept``, ``evals`` on the way)."""
    k = ", ".join(keys)
    same = lambda a, b: " AND ".join(f"{a}.{c} = {b}.{c}" for c in keys)
    ek = ", ".join(f"e.{c}" for c in keys)
    return f"""clocked AS (
  SELECT *, epoch_us(ts) AS ts_us,
    max(epoch_us(ts)) OVER (PARTITION BY {k} ORDER BY arrived ROWS UNBOUNDED PRECEDING) AS max_us
  FROM items),
kept AS (
  SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY arrived) AS rn
  FROM clocked WHERE ts_us >= max_us - {LATENESS}::BIGINT),
replay AS (
  SELECT {k}, rn, max_us AS last_us, true AS fires FROM kept WHERE rn = 1
  UNION ALL
  SELECT {ek}, e.rn,
    CASE WHEN e.max_us - f.last_us >= {SLIDE}::BIGINT THEN e.max_us ELSE f.last_us END,
    e.max_us - f.last_us >= {SLIDE}::BIGINT
  FROM replay f JOIN kept e ON {same("f", "e")} AND e.rn = f.rn + 1),
evals AS (
  SELECT {ek}, e.machine_id, e.rn AS end_rn, e.max_us AS end_us
  FROM replay f JOIN kept e ON {same("f", "e")} AND e.rn = f.rn WHERE f.fires),
starts AS (
  SELECT {ek}, e.end_rn, min(i.rn) AS start_rn
  FROM evals e JOIN kept i ON {same("e", "i")} AND i.rn <= e.end_rn
    AND i.ts_us >= e.end_us - {SIZE}::BIGINT
  GROUP BY ALL),
windows AS (
  SELECT {ek}, e.machine_id, make_timestamp(e.end_us - {SIZE}::BIGINT) AS window_start,
    make_timestamp(e.end_us) AS window_end, e.end_us,
    count(*) AS n_items, min(i.value) AS min_value, avg(i.value) AS mean_value,
    max(i.value) AS max_value, stddev_pop(i.value) AS std_dev,
    CASE WHEN count(*) >= 2 AND max(i.ts_us) > min(i.ts_us)
      THEN regr_slope(i.value, (i.ts_us - e.end_us) / 1e6) ELSE 0.0::DOUBLE END AS rate_of_change
  FROM evals e JOIN starts s ON {same("e", "s")} AND e.end_rn = s.end_rn
    JOIN kept i ON {same("e", "i")} AND i.rn BETWEEN s.start_rn AND e.end_rn
  GROUP BY {ek}, e.machine_id, e.end_us)"""


WINDOW_STATS = ", ".join(
    f"{r(name, 9 if name == 'rate_of_change' else 6)} AS {name}" for name in STATS
)
WINDOW_CTES = (BASE, READINGS, sliding())

CONFIG = """config AS (
  SELECT DISTINCT sensor_id,
    CASE WHEN user_id % 2 = 0 THEN 'PressureSensor' ELSE 'TemperatureSensor' END AS type,
    machine_id,
    CAST(20 + user_id % 7 AS DOUBLE) AS min_threshold,
    CAST(75 + user_id % 11 AS DOUBLE) AS max_threshold,
    CASE WHEN user_id % 6 = 0 THEN 0.0::DOUBLE
         ELSE CAST(45 + user_id % 5 AS DOUBLE) END AS max_std_dev,
    (1.0::DOUBLE + (user_id % 4) * 0.5::DOUBLE) / 3600.0::DOUBLE AS max_drift
  FROM base WHERE user_id % 10 <> 9)"""


def rule(intended: bool = True) -> str:
    unstable = "max_std_dev > 0 AND std_dev > max_std_dev" if intended else "false"
    return f"""CASE WHEN mean_value < min_threshold OR mean_value > max_threshold THEN 'out_of_range'
      WHEN {unstable} THEN 'instability'
      WHEN max_drift > 0 AND abs(rate_of_change) > max_drift THEN 'drift' END"""


def judged(intended: bool = True) -> str:
    return f"""judged AS (
  SELECT w.*, {rule(intended)} AS rule_code
  FROM windows w JOIN config c ON w.sensor_id = c.sensor_id)"""


REQUESTS = """requests AS (
  SELECT event_id AS request_no,
    CASE WHEN event_id % 37 = 6 THEN '' ELSE sensor_id END AS sensor_id,
    CASE WHEN event_id % 31 = 4 THEN 'HumiditySensor' WHEN user_id % 2 = 0 THEN 'PressureSensor'
         ELSE 'TemperatureSensor' END AS type,
    machine_id, plain_value AS base_mean, plain_value / 100.0::DOUBLE AS variance,
    plain_value * 0.7::DOUBLE AS min_threshold, plain_value * 1.3::DOUBLE AS max_threshold,
    1.5::DOUBLE + event_id % 4 AS max_std_dev, 0.01::DOUBLE * (1 + event_id % 5) AS max_drift,
    (1 + event_id % 3) * 1000000000::BIGINT AS interval_ns
  FROM base),
normal AS (
  SELECT request_no, sensor_id, type, machine_id, interval_ns,
    base_mean::FLOAT::DOUBLE AS base_mean, variance::FLOAT::DOUBLE AS variance,
    min_threshold::FLOAT::DOUBLE AS min_threshold, max_threshold::FLOAT::DOUBLE AS max_threshold,
    max_std_dev::FLOAT::DOUBLE AS max_std_dev, max_drift::FLOAT::DOUBLE AS max_drift
  FROM requests)"""

def lifecycle_of(rows: str = "base") -> str:
    """CTEs from the readings ``rows`` (``sensor_id, arrived, event_id``) to ``in_force``: each with the
    lifecycle that its sensor has heard of by then."""
    return f"""messages AS (
  SELECT sensor_id, machine_id, state, event_id, ts + to_hours(after) AS event_ts,
    CASE WHEN state = 'STOPPED' THEN ts - to_hours(10) END AS stop_ts,
    {arrived("ts + to_hours(after)", "0", "0", "event_id * 3 + number")} AS arrived
  FROM base, (VALUES ('STOPPED', 0, 0), ('WARM-UP', 20, 1), ('READY', 24, 2)) AS s(state, after, number)
  WHERE event_id % 29 = 3),
lifecycle AS (SELECT * FROM messages WHERE event_id % 23 <> 5),
heard AS (
  SELECT l.* FROM lifecycle l
  JOIN (SELECT sensor_id, min(arrived) AS first FROM {rows} GROUP BY 1) f
    ON l.sensor_id = f.sensor_id AND l.arrived > f.first),
merged AS (
  SELECT sensor_id, arrived, NULL::VARCHAR AS event_state, NULL::TIMESTAMP AS stop_ts,
    event_id FROM {rows}
  UNION ALL
  SELECT sensor_id, arrived, state, stop_ts, NULL::BIGINT FROM heard),
states AS (
  SELECT *,
    last_value(event_state IGNORE NULLS) OVER w AS state,
    count(*) FILTER (event_state = 'WARM-UP') OVER w AS session_no,
    coalesce(last_value(CASE WHEN event_state IN ('STOPPED', 'READY') THEN event_state END
      IGNORE NULLS) OVER w = 'STOPPED', false) AS stopped
  FROM merged
  WINDOW w AS (PARTITION BY sensor_id ORDER BY arrived ROWS UNBOUNDED PRECEDING)),
in_force AS (
  SELECT b.*, s.state, s.session_no, s.stopped
  FROM states s JOIN {rows} b ON s.event_id = b.event_id)"""


LIFECYCLE = lifecycle_of()
LIVE = "items AS (SELECT * FROM in_force WHERE NOT stopped)"

PROCESSED = f"""processed AS (
  SELECT epoch_us(window_end) AS "offset", sensor_id, machine_id, n_items = 7 AS damaged,
    min_value, mean_value, max_value, std_dev, rate_of_change,
    window_end + INTERVAL 1 HOUR AS record_ts,
    date_trunc('second', window_end + INTERVAL 1 HOUR) AS emit_ts
  FROM windows)"""

BUCKETED = f"""bucketed AS (
  SELECT sensor_id, machine_id, value, ts,
    epoch_us(ts) - epoch_us(ts) % {SIZE}::BIGINT AS bucket_us,
    (epoch_us(ts) % {SIZE}::BIGINT) / 1e6 AS t
  FROM base)"""


def _bucket_stats(keys: str) -> str:
    return f"""stats AS (
  SELECT {keys}, count(*) AS n_items, min(value) AS min_value, avg(value) AS mean_value,
    max(value) AS max_value, stddev_pop(value) AS std_dev,
    CASE WHEN count(*) >= 2 AND max(ts) > min(ts) THEN regr_slope(value, t)
         ELSE 0.0::DOUBLE END AS rate_of_change
  FROM bucketed GROUP BY {keys})"""


SCRAPE = 6 * HOUR_US
AT = f"(epoch_us(ts) - epoch_us(ts) % {SCRAPE}::BIGINT + {SCRAPE}::BIGINT)"


def counter(name: str, keys: dict[str, str], amount: str) -> str:
    """A cumulative counter per scrape that restarts once: CTE ``name`` with keys, at_us, value."""
    expressions = ", ".join(f"{e} AS {k}" for k, e in keys.items())
    names = ", ".join(keys)
    return f"""{name} AS (
  SELECT {names}, at_us, sum(amount) OVER (
      PARTITION BY {names}, at_us > epoch_us(TIMESTAMP '2024-01-15 00:00:00')
      ORDER BY at_us ROWS UNBOUNDED PRECEDING)::DOUBLE AS value
  FROM (SELECT {expressions}, {AT} AS at_us, {amount} AS amount FROM base GROUP BY ALL))"""


def grown(name: str, source: str, keys: tuple[str, ...], hours: int = 72) -> str:
    """Reset-aware increase per series over the trailing hours: CTE with keys and ``inc``."""
    names = ", ".join(keys)
    return f"""{name} AS (
  SELECT {names}, sum(CASE WHEN prev IS NULL THEN 0.0::DOUBLE WHEN value < prev THEN value
                           ELSE value - prev END) AS inc
  FROM (SELECT *, lag(value) OVER (PARTITION BY {names} ORDER BY at_us) AS prev FROM {source}
        WHERE at_us > epoch_us({COUNTER_NOW}) - {hours} * {HOUR_US}::BIGINT
          AND at_us <= epoch_us({COUNTER_NOW}))
  GROUP BY {names})"""


EVENT_COUNTER = (
    BASE,
    counter(
        "c",
        {
            "type": "event_type",
            "status": "CASE WHEN event_id % 10 = 0 THEN 'ignored' ELSE 'success' END",
        },
        "count(*)",
    ),
    grown("g", "c", ("type", "status")),
)


def last_gauge(keys: tuple[str, ...], value: str) -> str:
    names = ", ".join(keys)
    return f"""latest AS (
  SELECT {names}, arg_max(v, epoch_us(ts)) AS v FROM (SELECT *, {value} AS v FROM g)
  WHERE ts <= {NOW} AND ts > {NOW} - INTERVAL 24 HOUR GROUP BY {names})"""


LATENCIES = """lat AS (
  SELECT event_id AS op_id, (event_id * 37) % 20000 AS latency_ms, event_id % 50 <> 0 AS ok
  FROM events)"""

HISTOGRAM_BOUNDS = [0.001 * 2**k for k in range(15)]
HISTOGRAM = ", ".join(
    f"('{bound!r}', {bound!r}::DOUBLE)" for bound in HISTOGRAM_BOUNDS
) + ", ('+Inf', 'infinity'::DOUBLE)"

POINTS = """points AS (
  SELECT machine_id, CASE WHEN payload_id = '' THEN rkey ELSE payload_id END AS sensor_id,
    kind AS metric_type, value, ts, arrived
  FROM data WHERE measured)"""
LAST_POINTS = f"""SELECT machine_id, sensor_id, metric_type, ts, value, {SPREAD} FROM (
  SELECT machine_id, sensor_id, metric_type, date_trunc('hour', ts) AS ts,
    arg_max(value, arrived) AS value, max(arrived) AS arrived
  FROM points GROUP BY 1, 2, 3, 4)"""

SIGNALS = """signals AS (
  SELECT sensor_id AS key, sensor_id,
    CASE WHEN event_id % 3 = 0 THEN 'ModeNormal' ELSE 'ModeStop' END AS command,
    event_id % 17 = 2 AS broken, "partition", "offset",
    {'at': arrival, 'source': 5, 'partition': "partition", 'offset': "offset"} AS arrived FROM base)"""

ORACLE: dict[str, str] = {
    "src_raw_scan": _with(
        BASE,
        RECORDS,
        select="""SELECT rkey AS key, topic, "partition", "offset",
          arrival AS "timestamp" FROM records""",
    ),
    "union_sensor_streams": _with(
        BASE, RECORDS, select='SELECT rkey AS key, topic, "offset" FROM records'
    ),
    "signals_stop_commands": _with(
        BASE,
        SIGNALS,
        select="""SELECT key, sensor_id, command, "partition", "offset" FROM signals
          WHERE NOT broken AND command = 'ModeStop'""",
    ),
    "signals_compacted": _with(
        BASE,
        SIGNALS,
        select=f"""SELECT key, value, {SPREAD} FROM (
          SELECT key, arg_max(CASE WHEN broken THEN '{{broken' ELSE
            '{{"sensorId":"' || sensor_id || '","command":"' || command || '"}}' END, arrived) AS value,
          max(arrived) AS arrived FROM signals GROUP BY key)""",
    ),
    "sink_telemetry_points": _with(BASE, RECORDS, POINTS, select=LAST_POINTS),
    "sink_two_writers": _with(BASE, RECORDS, POINTS, select=LAST_POINTS),
    "points_last_write_wins": _with(BASE, RECORDS, POINTS, select=LAST_POINTS),
    "sink_sensor_metrics": _with(
        *WINDOW_CTES,
        select=f"""SELECT sensor_id, machine_id, day AS ts, window_end AS recorded, 4::INTEGER AS source,
            0::INTEGER AS "partition", end_us AS "offset", {WINDOW_STATS}
          FROM (SELECT *, date_trunc('day', window_end)::TIMESTAMP AS day, row_number() OVER (
              PARTITION BY sensor_id, machine_id, date_trunc('day', window_end)
              ORDER BY end_us DESC) AS place FROM windows) WHERE place = 1""",
    ),
    "retention_filter": _with(
        BASE,
        RECORDS,
        select=f"""SELECT rkey AS key, topic, "offset", arrival AS "timestamp" FROM records
          WHERE arrival >= {NOW} - INTERVAL 168 HOUR""",
    ),
    "config_upsert_latest": _with(
        BASE,
        REQUESTS,
        select="""SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (
            PARTITION BY sensor_id ORDER BY request_no DESC) AS place FROM normal
            WHERE sensor_id <> '' AND type <> 'HumiditySensor') WHERE place = 1""",
    ),
    "status_current": _with(
        BASE,
        LIFECYCLE,
        select="""SELECT sensor_id, arg_max(machine_id, arrived) AS machine_id,
          arg_max(state, arrived) AS status FROM lifecycle GROUP BY 1""",
    ),
    "envelope_decode": _with(
        BASE,
        RECORDS,
        select="""SELECT "offset",
          CASE route WHEN 'malformed' THEN '' WHEN 'marker' THEN 'LATENCY_MARKER'
            WHEN 'unhandled' THEN 'HEARTBEAT' ELSE 'DATA' END AS type,
          CASE WHEN route = 'marker' THEN epoch_us(ts) * 1000::BIGINT END AS ingress_ts_nano,
          route = 'data' AS has_payload, route = 'marker' AS has_marker,
          route = 'malformed' AS malformed FROM records""",
    ),
    "envelope_route": _with(
        BASE, RECORDS, select='SELECT "offset", rkey AS key, route FROM records'
    ),
    "payload_typed_decode": _with(
        BASE,
        RECORDS,
        select="""SELECT "offset", NOT broken AS payload_ok,
          CASE WHEN NOT broken THEN 'm-' || CAST(event_id AS VARCHAR) END AS message_id,
          CASE WHEN NOT broken THEN payload_id END AS sensor_id,
          CASE WHEN NOT broken THEN machine_id END AS machine_id,
          CASE WHEN NOT broken THEN CASE WHEN measured THEN value ELSE 0.0::DOUBLE END END AS measure
          FROM records WHERE route = 'data'""",
    ),
    "sensor_id_fallback": _with(BASE, RECORDS, select='SELECT "offset", sensor_id FROM data'),
    "event_time_parse": _with(
        BASE,
        select="""SELECT event_id, CASE event_id % 7
            WHEN 3 THEN date_trunc('second', ts) - INTERVAL 2 HOUR
            WHEN 4 THEN date_trunc('second', ts)
            WHEN 6 THEN ts ELSE arrival END AS ts FROM base""",
    ),
    "value_merge_analyzer": _with(
        BASE,
        RECORDS,
        select=f"""SELECT sensor_id, machine_id, ts,
          CASE WHEN measured THEN value ELSE 0.0::DOUBLE END AS value, {SPREAD} FROM data""",
    ),
    "value_metric_type": _with(BASE, RECORDS, POINTS, select=f"SELECT machine_id, sensor_id, metric_type, value, ts, {SPREAD} FROM points"),
    "ingest_restamp": _with(
        BASE,
        RECORDS,
        select="""SELECT "offset", payload_id AS sensor_id,
          '2024-01-31T00:00:00Z' AS event_time_text FROM clean""",
    ),
    "envelope_encode": _with(
        BASE,
        RECORDS,
        select="""SELECT payload_id AS key, '{"type":"DATA","payload":{"messageId":"m-' || event_id ||
          '","sensorId":"' || payload_id || '","machineId":"' || machine_id ||
          '","timestamp":"' || event_time_text || CASE WHEN kind = 'temperature'
            THEN '","temperature_celsius":' ELSE '","pressure_bar":' END || measure || '}}' AS value,
          "partition", "offset", arrival AS "timestamp" FROM clean""",
    ),
    "marker_passthrough": _with(
        BASE,
        RECORDS,
        select="""SELECT rkey AS key, '{"type":"LATENCY_MARKER","marker":{"ingress_ts_nano":' ||
          epoch_us(ts) * 1000::BIGINT || '}}' AS value, topic, "partition", "offset"
          FROM records WHERE route = 'marker'""",
    ),
    "marker_latency_ms": _with(
        BASE,
        RECORDS,
        select=f"""SELECT "offset",
          {r(f"(epoch_us({NOW}) - epoch_us(ts)) / 1e3")} AS latency_ms,
          {r(f"(epoch_us({NOW}) - epoch_us(ts)) / 1e6")} AS latency_seconds
          FROM records WHERE route = 'marker'""",
    ),
    "window_bounds_format": _with(
        *WINDOW_CTES,
        select="""SELECT sensor_id, window_end, strftime(window_start, '%H:%M:%S') AS start_text,
          strftime(window_end, '%H:%M:%S') AS end_text FROM windows""",
    ),
    "message_id": _with(
        *WINDOW_CTES,
        select="""SELECT sensor_id, window_end,
          sha256(sensor_id || '#' || CAST(end_us AS VARCHAR)) AS message_id FROM windows""",
    ),
    "config_normalize": _with(BASE, REQUESTS, select="SELECT * FROM normal"),
    "config_type_check": _with(
        BASE,
        REQUESTS,
        select="""SELECT request_no, type, type <> 'HumiditySensor' AS accepted,
          CASE WHEN type = 'HumiditySensor'
            THEN 'unsupported sensor type: HumiditySensor' END AS message FROM requests""",
    ),
    "lifecycle_parse": _with(
        BASE,
        LIFECYCLE,
        select=f"""SELECT sensor_id, state, machine_id, event_ts, stop_ts, {SPREAD}
          FROM lifecycle""",
    ),
    "filter_temperature_range": _with(
        BASE,
        RECORDS,
        select="""SELECT "offset", measure FROM typed
          WHERE kind = 'temperature' AND measure > -100 AND measure < 400""",
    ),
    "filter_pressure_range": _with(
        BASE,
        RECORDS,
        select="""SELECT "offset", measure FROM typed
          WHERE kind = 'pressure' AND measure BETWEEN 0 AND 300""",
    ),
    "ingest_clean": _with(
        BASE,
        RECORDS,
        select="""SELECT payload_id AS sensor_id, rkey AS key, topic, "partition", "offset", machine_id,
          'm-' || event_id AS message_id, event_time_text, measure FROM clean""",
    ),
    "reject_reasons": _with(
        BASE,
        RECORDS,
        select="""SELECT topic, reason, count(*) AS n FROM (
          SELECT topic, CASE WHEN route = 'malformed' THEN 'malformed_envelope'
            WHEN route = 'data' AND broken THEN 'malformed_payload' END AS reason FROM records
          UNION ALL
          SELECT topic, 'out_of_range' FROM typed
          WHERE event_id NOT IN (SELECT event_id FROM clean))
        WHERE reason IS NOT NULL GROUP BY 1, 2""",
    ),
    "config_missing_anti": _with(
        *WINDOW_CTES,
        select="""SELECT sensor_id, window_end, n_items FROM windows
          WHERE CAST(sensor_id AS BIGINT) % 10 = 9""",
    ),
    "late_data_split": _with(
        *WINDOW_CTES,
        select=f"""SELECT "partition", "offset", sensor_id, ts_us < max_us - {LATENESS}::BIGINT AS is_late
          FROM clocked""",
    ),
    "lifecycle_asof": _with(
        BASE,
        LIFECYCLE,
        select='SELECT "partition", "offset", sensor_id, state, session_no, stopped FROM in_force',
    ),
    "lifecycle_gate": _with(
        BASE,
        LIFECYCLE,
        LIVE,
        select='SELECT "partition", "offset", sensor_id, value, session_no FROM items',
    ),
    "lifecycle_stop_purge": _with(
        BASE,
        LIFECYCLE,
        LIVE,
        sliding(("sensor_id", "session_no")),
        f"""stops AS (
  SELECT s.sensor_id, s.session_no, s.arrived, s.stop_ts,
    (SELECT max(k.max_us) FROM kept k WHERE k.sensor_id = s.sensor_id
       AND k.session_no = s.session_no AND k.arrived < s.arrived) AS at_us
  FROM states s WHERE s.event_state = 'STOPPED'),
held AS (
  SELECT s.sensor_id, s.session_no, s.arrived, k.arrived AS item,
    k.ts <= s.stop_ts AS stays
  FROM stops s JOIN kept k ON k.sensor_id = s.sensor_id AND k.session_no = s.session_no
    AND k.arrived < s.arrived AND k.max_us >= s.at_us - {SIZE}::BIGINT),
fate AS (
  SELECT h.sensor_id, h.session_no, h.arrived, count(*) FILTER (h.stays) AS n_kept,
    count(*) FILTER (NOT h.stays) AS n_purged
  FROM held h WHERE NOT EXISTS (SELECT 1 FROM held p WHERE p.item = h.item
    AND p.sensor_id = h.sensor_id AND p.arrived < h.arrived AND NOT p.stays)
  GROUP BY 1, 2, 3)""",
        select=f"""SELECT sensor_id, session_no, stop_ts, n_kept, n_purged, {SPREAD} FROM (
          SELECT s.sensor_id, s.session_no, s.arrived, s.stop_ts,
            coalesce(f.n_kept, 0) AS n_kept, coalesce(f.n_purged, 0) AS n_purged
          FROM stops s LEFT JOIN fate f ON s.sensor_id = f.sensor_id
            AND s.session_no = f.session_no AND s.arrived = f.arrived)""",
    ),
    "lifecycle_intervals": _with(
        BASE,
        LIFECYCLE,
        select=f"""SELECT sensor_id, state, event_ts AS start_ts, end_ts,
          {r("(epoch_us(end_ts) - epoch_us(event_ts)) / 1e6")} AS seconds
          FROM (SELECT *, lead(event_ts) OVER (PARTITION BY sensor_id ORDER BY arrived) AS end_ts
                FROM lifecycle)""",
    ),
    "window_stats": _with(
        BASE,
        BUCKETED,
        _bucket_stats("sensor_id, bucket_us"),
        select=f"""SELECT sensor_id, bucket_us, n_items, {r("min_value")} AS min_value,
          {r("mean_value")} AS mean_value, {r("max_value")} AS max_value,
          {r("std_dev")} AS std_dev FROM stats""",
    ),
    "window_rate_of_change": _with(
        BASE,
        BUCKETED,
        _bucket_stats("sensor_id, bucket_us"),
        select=f"""SELECT sensor_id, bucket_us, {r("rate_of_change", 9)} AS rate_of_change
          FROM stats""",
    ),
    "running_max_event_time": _with(
        *WINDOW_CTES,
        select="""SELECT "partition", "offset", sensor_id, make_timestamp(max_us) AS max_event_time
          FROM clocked""",
    ),
    "per_key_watermark": _with(
        *WINDOW_CTES,
        select=f"""SELECT "partition", "offset", sensor_id,
          make_timestamp(max_us - {LATENESS}::BIGINT) AS watermark FROM clocked""",
    ),
    "sliding_eval_points": _with(
        *WINDOW_CTES,
        select="SELECT sensor_id, machine_id, make_timestamp(end_us) AS window_end FROM evals",
    ),
    "sliding_eval": _with(
        *WINDOW_CTES,
        select=f"""SELECT sensor_id, machine_id, window_start, window_end, n_items, {WINDOW_STATS}
          FROM windows""",
    ),
    "sliding_eval_sessions": _with(
        BASE,
        LIFECYCLE,
        LIVE,
        sliding(("sensor_id", "session_no")),
        select=f"""SELECT sensor_id, session_no, machine_id, window_start, window_end, n_items,
          {WINDOW_STATS} FROM windows""",
    ),
    "tumbling_mean": _with(
        BASE,
        select=f"""SELECT machine_id, sensor_id,
          epoch_us(ts) - epoch_us(ts) % {BUCKET}::BIGINT AS bucket_us, {r("avg(value)")} AS value
          FROM base GROUP BY 1, 2, 3""",
    ),
    "event_counters": _with(
        *WINDOW_CTES,
        RECORDS,
        CONFIG,
        PROCESSED,
        """outcomes AS (
  SELECT 'DATA' AS type, CASE WHEN damaged THEN 'unmarshal_payload_error'
    WHEN c.sensor_id IS NULL THEN 'redis_config_missing' ELSE 'success' END AS status
  FROM processed p LEFT JOIN config c ON p.sensor_id = c.sensor_id
  UNION ALL SELECT 'LATENCY_MARKER', 'success' FROM records WHERE route = 'marker'
  UNION ALL SELECT 'UNHANDLED', 'ignored' FROM records WHERE route = 'unhandled')""",
        select="""SELECT type, status, sum(n)::BIGINT AS n FROM (
          SELECT type, status, 1 AS n FROM outcomes
          UNION ALL VALUES ('LATENCY_MARKER', 'success', 0), ('DATA', 'success', 0),
            ('DATA', 'unmarshal_payload_error', 0), ('DATA', 'redis_config_missing', 0))
          GROUP BY 1, 2""",
    ),
    "event_counters_sink": _with(
        *WINDOW_CTES,
        RECORDS,
        PROCESSED,
        """outcomes AS (
  SELECT 'DATA' AS type, CASE WHEN damaged THEN 'error' ELSE 'success' END AS status
  FROM processed
  UNION ALL SELECT 'LATENCY_MARKER', 'success' FROM records WHERE route = 'marker')""",
        select="""SELECT type, status, sum(n)::BIGINT AS n FROM (
          SELECT type, status, 1 AS n FROM outcomes
          UNION ALL VALUES ('LATENCY_MARKER', 'success', 0), ('DATA', 'success', 0),
            ('DATA', 'unmarshal_payload_error', 0), ('DATA', 'redis_config_missing', 0))
          GROUP BY 1, 2""",
    ),
    "latency_histogram": _with(
        LATENCIES,
        f"bounds AS (SELECT * FROM (VALUES {HISTOGRAM}) AS b(le, bound))",
        select=f"""SELECT le, (SELECT count(*) FROM lat WHERE latency_ms / 1e3 <= bound) AS n,
          (SELECT {r("sum(latency_ms / 1e3)", 3)} FROM lat) AS total_seconds,
          (SELECT count(*) FROM lat) AS total_n FROM bounds""",
    ),
    "lag_gauge_decision": _with(
        *WINDOW_CTES,
        PROCESSED,
        select=f"""SELECT sensor_id,
          {r(f"(epoch_us({NOW}) - epoch_us(arg_max(record_ts, \"offset\"))) / 1e6")} AS lag_seconds
          FROM processed WHERE NOT damaged GROUP BY 1""",
    ),
    "lag_gauge_sink": _with(
        *WINDOW_CTES,
        PROCESSED,
        select=f"""SELECT sensor_id, {r(
            f"greatest((epoch_us({NOW}) - epoch_us(arg_max(emit_ts, \"offset\"))) / 1e6, 0)"
          )} AS lag_seconds FROM processed WHERE NOT damaged GROUP BY 1""",
    ),
    "lag_max_by_sensor": _with(
        """g AS (SELECT ts, CAST(user_id AS VARCHAR) AS sensor_id, event_id % 2 AS instance,
          event_id FROM events)""",
        last_gauge(("sensor_id", "instance"), "((event_id * 13) % 700) / 10.0::DOUBLE"),
        select="SELECT sensor_id, max(v) AS value FROM latest GROUP BY 1",
    ),
    "throughput_increase": _with(
        *EVENT_COUNTER, select="SELECT type, sum(inc) AS increase FROM g GROUP BY 1"
    ),
    "throughput_rate": _with(
        *EVENT_COUNTER,
        select=f'SELECT type, {r("sum(inc) / (72 * 3600)", 9)} AS rate FROM g GROUP BY 1',
    ),
    "latency_mean_rate": _with(
        BASE,
        counter(
            "sums",
            {"service": "CASE WHEN user_id % 3 = 0 THEN 'decision' ELSE 'sink' END"},
            "sum(((event_id * 37) % 20000) / 1e3)",
        ),
        counter(
            "counts",
            {"service": "CASE WHEN user_id % 3 = 0 THEN 'decision' ELSE 'sink' END"},
            "count(*)",
        ),
        grown("gs", "sums", ("service",)),
        grown("gc", "counts", ("service",)),
        select=f"""SELECT service, {r("gs.inc / nullif(gc.inc, 0)")} AS mean_seconds
          FROM gs JOIN gc USING (service)""",
    ),
    "gauge_sum_scaled": _with(
        """g AS (SELECT ts, 'svc_' || CAST(user_id % 6 AS VARCHAR) AS name, user_id, value
          FROM events)""",
        last_gauge(("name", "user_id"), "value * 1e6"),
        select=f"""SELECT name, {r("sum(v) / 1024 / 1024")} AS mebibytes
          FROM latest GROUP BY 1""",
    ),
    "cpu_percent_rate": _with(
        BASE,
        counter(
            "c",
            {
                "name": """CASE WHEN user_id % 8 = 7 THEN ''
                  ELSE 'svc_' || CAST(user_id % 8 AS VARCHAR) END""",
                "cpu": "user_id % 2",
            },
            "sum(plain_value)",
        ),
        grown("g", "c", ("name", "cpu")),
        select=f"""SELECT name, {r("sum(inc) / (72 * 3600) * 100")} AS cpu_percent FROM g
          WHERE name <> '' GROUP BY 1""",
    ),
    "consumer_lag_avg": _with(
        f"""series AS (SELECT 'group_' || event_type AS consumergroup, user_id % 4 AS p,
          avg((event_id * 31) % 500) AS v FROM events
          WHERE ts > {NOW} - INTERVAL 180 HOUR AND ts <= {NOW} GROUP BY 1, 2)""",
        select=f"""SELECT consumergroup, {r("sum(v)")} AS value FROM series GROUP BY 1""",
    ),
    "latency_percentiles": _with(
        LATENCIES,
        """ranked AS (SELECT latency_ms, row_number() OVER (ORDER BY latency_ms) - 1 AS rank0,
          count(*) OVER () AS n FROM lat WHERE ok)""",
        select="""SELECT statistic, latency_ms, n FROM ranked,
          (VALUES ('p50', 0.5::DOUBLE), ('p95', 0.95::DOUBLE), ('p99', 0.99::DOUBLE),
            ('max', 1.0::DOUBLE)) AS s(statistic, p)
          WHERE rank0 = CASE WHEN p < 1 THEN floor(n * p) ELSE n - 1 END""",
    ),
    "latency_summary": _with(
        LATENCIES,
        select="""SELECT count(*) FILTER (ok) AS n_success, count(*) FILTER (NOT ok) AS n_failed,
          (sum(latency_ms) FILTER (ok) // count(*) FILTER (ok))::BIGINT AS mean_latency_ms
          FROM lat""",
    ),
    "estimated_rate": f"""SELECT {r("sum(cnt / interval_sec)")} AS rate FROM (
        SELECT (user_id % 5) * 0.5::DOUBLE AS interval_sec, count(DISTINCT user_id) AS cnt
        FROM events GROUP BY 1) WHERE interval_sec > 0""",
    "active_sensors": "SELECT DISTINCT CAST(user_id AS VARCHAR) AS sensor_id FROM events",
    "config_enrich": _with(
        *WINDOW_CTES,
        CONFIG,
        select=f"""SELECT w.sensor_id, w.window_end, c.sensor_id IS NOT NULL AS has_config,
          min_threshold, max_threshold, max_std_dev, {r("max_drift", 9)} AS max_drift
          FROM windows w LEFT JOIN config c ON w.sensor_id = c.sensor_id""",
    ),
    "anomaly_rules": _with(
        *WINDOW_CTES,
        CONFIG,
        judged(),
        select="""SELECT sensor_id, window_end, rule_code, rule_code IS NOT NULL AS is_anomaly
          FROM judged""",
    ),
    "anomaly_rules_as_written": _with(
        *WINDOW_CTES,
        CONFIG,
        judged(intended=False),
        select="""SELECT sensor_id, window_end, rule_code, rule_code IS NOT NULL AS is_anomaly
          FROM judged""",
    ),
    "alarms": _with(
        *WINDOW_CTES,
        CONFIG,
        judged(),
        select="""SELECT sensor_id, 'ModeStop' AS command, window_end FROM judged
          WHERE rule_code IS NOT NULL""",
    ),
    "decision_stage": _with(
        *WINDOW_CTES,
        CONFIG,
        PROCESSED,
        f"""decided AS (
  SELECT p."offset", p.sensor_id,
    CASE WHEN c.sensor_id IS NULL THEN 'redis_config_missing' ELSE 'success' END AS status,
    CASE WHEN c.sensor_id IS NOT NULL THEN {rule()} END AS rule_code
  FROM processed p LEFT JOIN config c ON p.sensor_id = c.sensor_id WHERE NOT damaged)""",
        select="""SELECT *, CASE WHEN rule_code IS NOT NULL THEN 'ModeStop' END AS command
          FROM decided""",
    ),
    "metrics_snapshot": _with(
        *WINDOW_CTES,
        f"""means AS (
  SELECT machine_id, sensor_id, end_us - end_us % {BUCKET}::BIGINT AS bucket_us,
    {", ".join(f"avg({name}) AS {name}" for name in STATS)}
  FROM windows WHERE window_end >= {NOW} - INTERVAL 180 HOUR AND window_end < {NOW}
  GROUP BY 1, 2, 3)""",
        select=f"""SELECT machine_id, sensor_id, {", ".join(
            f"(round(arg_max({name}, bucket_us) * 1e5) / 1e5 + 0.0::DOUBLE) AS {name}"
            for name in STATS)} FROM means GROUP BY 1, 2""",
    ),
    "pivot_fields": _with(
        BASE,
        BUCKETED,
        _bucket_stats("machine_id, sensor_id, bucket_us"),
        select=f"SELECT machine_id, sensor_id, bucket_us, {WINDOW_STATS} FROM stats",
    ),
    "round_half_away": """SELECT event_id,
        (round((event_id % 41 - 20) * 0.5::DOUBLE) + 0.0::DOUBLE) AS whole,
        (round(value / 3.0::DOUBLE * 1e5) / 1e5 + 0.0::DOUBLE) AS five_digits FROM events""",
    "sensor_types": _with(
        BASE,
        CONFIG,
        select="""SELECT t.type, count(c.sensor_id) AS n_sensors
          FROM (VALUES ('TemperatureSensor'), ('PressureSensor')) AS t(type)
          LEFT JOIN config c ON t.type = c.type GROUP BY 1""",
    ),
}

CLEANED_VALUE = """'{"type":"DATA","payload":{"messageId":"m-' || event_id ||
  '","sensorId":"' || payload_id || '","machineId":"' || machine_id ||
  '","timestamp":"' || event_time_text || CASE WHEN kind = 'temperature'
    THEN '","temperature_celsius":' ELSE '","pressure_bar":' END || measure || '}}'"""

ORACLE |= {
    "stream_ingest": _with(
        BASE,
        RECORDS,
        select=f"""SELECT payload_id AS key, {CLEANED_VALUE} AS value,
          'data-topic-cleaned' AS topic, "offset" FROM clean
          UNION ALL
          SELECT rkey, '{{"type":"LATENCY_MARKER","marker":{{"ingress_ts_nano":' ||
            epoch_us(ts) * 1000::BIGINT || '}}}}', 'data-topic-cleaned', "offset"
          FROM records WHERE route = 'marker'""",
    ),
    "stream_sliding_eval": ORACLE["sliding_eval_sessions"],
    "stream_decision": _with(
        *WINDOW_CTES,
        CONFIG,
        PROCESSED,
        select=f"""SELECT sensor_id AS key,
          '{{"sensorId":"' || sensor_id || '","command":"ModeStop"}}' AS value, count(*) AS n
          FROM (SELECT p.sensor_id, {rule()} AS rule_code
                FROM processed p JOIN config c ON p.sensor_id = c.sensor_id WHERE NOT damaged)
          WHERE rule_code IS NOT NULL GROUP BY 1, 2""",
    ),
    "stream_telemetry_sink": _with(
        BASE,
        RECORDS,
        select=f"""SELECT machine_id, sensor_id, metric_type, ts, value, {SPREAD.replace("arrived.source", "3::INTEGER")} FROM (
          SELECT machine_id, payload_id AS sensor_id, kind AS metric_type, ts,
            arg_max(measure, arrived) AS value, max(arrived) AS arrived
          FROM clean GROUP BY 1, 2, 3, 4)""",
    ),
    "stream_metrics_sink": _with(
        *WINDOW_CTES,
        PROCESSED,
        select=f"""SELECT sensor_id, machine_id, emit_ts::TIMESTAMP AS ts, {WINDOW_STATS}
          FROM (SELECT *, row_number() OVER (
              PARTITION BY sensor_id, machine_id, emit_ts ORDER BY "offset" DESC) AS place
              FROM processed WHERE NOT damaged) WHERE place = 1""",
    ),
    "stream_decision_lags": ORACLE["lag_gauge_decision"],
    "stream_decision_latency": _with(
        BASE,
        RECORDS,
        f"""bounds(le, bound) AS (VALUES {HISTOGRAM})""",
        f"""seen AS (SELECT (epoch_us({NOW}) - epoch_us(ts)) / 1e6 AS s FROM records WHERE route = 'marker')""",
        select="""SELECT le, (SELECT count(*) FROM seen WHERE s <= bound) AS n,
          (SELECT count(*) FROM seen) AS total_n FROM bounds""",
    ),
    "stream_status": ORACLE["status_current"],
}

_SLICE = """((T >= TIMESTAMP '2024-01-12 06:00:00')::INTEGER + (T >= TIMESTAMP '2024-01-23 18:00:00')::INTEGER)"""


def slice_of(at: str) -> str:
    """Number of the slice of arrivals that streams take in one start."""
    return _SLICE.replace("T >=", f"{at} >=")


#: Everything that arrives on the processed topic, with the columns of a topic record.
PROCESSED_ALL = """passing AS (
  SELECT route, key, "partition", "offset", "timestamp", damaged, sensor_id FROM (
    SELECT 'data' AS route, sensor_id AS key, (CAST(sensor_id AS BIGINT) % 4)::INTEGER AS "partition", "offset",
      record_ts AS "timestamp", damaged, sensor_id FROM processed
    UNION ALL
    SELECT route, rkey, "partition", "offset", arrival, NULL, NULL FROM records
    WHERE route IN ('malformed', 'marker', 'unhandled')))"""

ORACLE |= {
    "table_retained": _with(
        BASE,
        RECORDS,
        POINTS,
        select=f"SELECT * FROM ({LAST_POINTS}) WHERE ts >= {NOW} - INTERVAL 72 HOUR",
    ),
    "stream_rejects": _with(
        *WINDOW_CTES,
        RECORDS,
        CONFIG,
        PROCESSED,
        PROCESSED_ALL,
        select="""SELECT 'ingest' AS stage, reason, rkey AS key, topic, "partition", "offset", arrival AS "timestamp" FROM (
            SELECT *, CASE WHEN route = 'malformed' THEN 'malformed_envelope'
              WHEN route = 'data' AND broken THEN 'malformed_payload'
              WHEN route = 'data' AND event_id NOT IN (SELECT event_id FROM clean) THEN 'out_of_range' END AS reason
            FROM records) WHERE reason IS NOT NULL
          UNION ALL
          SELECT 'decision', reason, key, 'processed-data-topic', "partition", "offset", "timestamp" FROM (
            SELECT p.*, CASE WHEN route = 'malformed' THEN 'malformed_envelope'
              WHEN route = 'data' AND damaged THEN 'unmarshal_payload_error'
              WHEN route = 'data' AND c.sensor_id IS NULL THEN 'redis_config_missing' END AS reason
            FROM passing p LEFT JOIN config c ON p.sensor_id = c.sensor_id) WHERE reason IS NOT NULL""",
    ),
    "config_merge_table": ORACLE["config_upsert_latest"],
    "stream_decision_config": _with(
        *WINDOW_CTES,
        PROCESSED,
        REQUESTS,
        f"""stored AS (
  SELECT at_slice, r.* FROM (VALUES (0), (1), (2)) AS s(at_slice), (
    SELECT n.*, {slice_of("b.ts")} AS slice FROM normal n JOIN base b ON b.event_id = n.request_no
    WHERE n.sensor_id <> '' AND n.type <> 'HumiditySensor') r
  WHERE slice <= at_slice
  QUALIFY row_number() OVER (PARTITION BY at_slice, sensor_id ORDER BY request_no DESC) = 1)""",
        select=f"""SELECT p.sensor_id AS key, '{{"sensorId":"' || p.sensor_id || '","command":"ModeStop"}}' AS value,
            (CAST(p.sensor_id AS BIGINT) % 4)::INTEGER AS "partition", "offset", record_ts AS "timestamp"
          FROM processed p JOIN stored c ON c.sensor_id = p.sensor_id AND c.at_slice = {slice_of("p.record_ts")}
          WHERE NOT damaged AND {rule()} IS NOT NULL""",
    ),
    "window_state_snapshot": _with(
        BASE,
        LIFECYCLE,
        LIVE,
        sliding(("sensor_id", "session_no")),
        f"""now_in AS (
  SELECT sensor_id, max(session_no) AS session_no, arg_max(stopped, arrived) AS stopped FROM states GROUP BY 1),
clock AS (
  SELECT n.*, max(k.max_us) AS max_us FROM now_in n LEFT JOIN kept k USING (sensor_id, session_no) GROUP BY ALL),
fired AS (SELECT sensor_id, session_no, max(end_us) AS last_us FROM evals GROUP BY 1, 2),
purges AS (
  SELECT s.sensor_id, s.session_no, s.arrived, s.stop_ts FROM states s WHERE s.event_state = 'STOPPED'),
buffer AS (
  SELECT k.* FROM kept k JOIN clock c USING (sensor_id, session_no)
  WHERE k.max_us >= c.max_us - {SIZE}::BIGINT AND NOT EXISTS (
    SELECT 1 FROM purges p WHERE p.sensor_id = k.sensor_id AND p.session_no = k.session_no
      AND p.arrived > k.arrived AND NOT coalesce(k.ts <= p.stop_ts, false)))""",
        select=f"""SELECT c.sensor_id, c.session_no, c.stopped, c.max_us, f.last_us, count(b.arrived) AS n_items,
            min(b.ts_us) AS first_us, max(b.ts_us) AS last_item_us, {r("coalesce(sum(b.value), 0)")} AS value_sum
          FROM clock c LEFT JOIN fired f USING (sensor_id, session_no) LEFT JOIN buffer b USING (sensor_id, session_no)
          GROUP BY ALL""",
    ),
}

#: What the service makes of the raw topics: the cleaned topic's records as readings of their payload's sensor.
SERVICE = (
    BASE,
    RECORDS,
    """heard_of AS (
  SELECT event_id, payload_id AS sensor_id, machine_id, ts, measure AS value, kind,
    {'at': arrived."at", 'source': 3, 'partition': arrived."partition", 'offset': arrived."offset"} AS arrived
  FROM clean)""",
    lifecycle_of("heard_of"),
    LIVE,
    sliding(("sensor_id", "session_no")),
    """emitted AS (
  SELECT *, window_end + INTERVAL 1 HOUR AS record_ts,
    date_trunc('second', window_end + INTERVAL 1 HOUR)::TIMESTAMP AS emit_ts FROM windows)""",
)
ORACLE |= {
    "stream_analyzer": _with(
        *SERVICE,
        select=f"""SELECT sensor_id AS key, 'data' AS route, machine_id, {WINDOW_STATS}, emit_ts FROM emitted
          UNION ALL
          SELECT rkey, 'marker', '', {", ".join(["0.0::DOUBLE"] * len(STATS))}, NULL
          FROM records WHERE route = 'marker'""",
    ),
    "stream_pipeline": _with(
        *SERVICE,
        CONFIG,
        f"""decided AS (
  SELECT e.sensor_id, e.record_ts, {rule()} AS rule_code
  FROM emitted e JOIN config c ON e.sensor_id = c.sensor_id)""",
        """last_windows AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sensor_id, machine_id, emit_ts
    ORDER BY record_ts DESC, session_no DESC) AS place FROM emitted) WHERE place = 1)""",
        select=f"""SELECT 'telemetry' AS sink, sensor_id, machine_id, ts, kind AS name,
            {r("arg_max(value, arrived)")} AS value FROM heard_of GROUP BY sensor_id, machine_id, ts, kind
          UNION ALL
          SELECT 'metrics', sensor_id, machine_id, emit_ts, name, {r("value")} FROM (
            {" UNION ALL ".join(
                f"SELECT sensor_id, machine_id, emit_ts, '{name}' AS name, {name} AS value FROM last_windows"
                for name in STATS)})
          UNION ALL
          SELECT 'signals', sensor_id, NULL, record_ts,
            '{{"sensorId":"' || sensor_id || '","command":"ModeStop"}}', NULL
          FROM decided WHERE rule_code IS NOT NULL""",
    ),
}
