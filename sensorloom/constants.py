"""Values of the sensor protocol and its default tuning."""

# --- fixed values: wire names, limits and defaults of the protocol ---
TOPIC_TEMPERATURE = "temperature-topic-sensor"
TOPIC_PRESSURE = "pressure-topic-sensor"
TOPIC_CLEANED = "data-topic-cleaned"
TOPIC_PROCESSED = "processed-data-topic"
TOPIC_SIGNALS = "signals-topic"

#: The lifecycle channel and the topics, in the order in which records of one instant count.
SOURCE_LIFECYCLE = "sensor-lifecycle"
SOURCES = (
    SOURCE_LIFECYCLE,
    TOPIC_TEMPERATURE,
    TOPIC_PRESSURE,
    TOPIC_CLEANED,
    TOPIC_PROCESSED,
    TOPIC_SIGNALS,
)

TYPE_DATA = "DATA"
TYPE_MARKER = "LATENCY_MARKER"
TYPE_UNHANDLED = "UNHANDLED"
COMMAND_STOP = "ModeStop"

SENSOR_TYPES = ("TemperatureSensor", "PressureSensor")
READY, STOPPED, WARM_UP = "READY", "STOPPED", "WARM-UP"

TEMPERATURE_OPEN_RANGE = (-100.0, 400.0)
PRESSURE_CLOSED_RANGE = (0.0, 300.0)

WINDOW_SECONDS = 60
SLIDE_SECONDS = 30
LATENESS_SECONDS = 15

SNAPSHOT_RANGE_SECONDS = 180
SNAPSHOT_BUCKET_SECONDS = 120
SNAPSHOT_DIGITS = 5

RETENTION_HOURS = {
    TOPIC_TEMPERATURE: 12,
    TOPIC_PRESSURE: 12,
    TOPIC_CLEANED: 24,
    TOPIC_PROCESSED: 72,
}

LATENCY_BUCKET_START, LATENCY_BUCKET_FACTOR, LATENCY_BUCKET_COUNT = 0.001, 2, 15

SEEDED_COUNTERS = (
    ("LATENCY_MARKER", "success"),
    ("DATA", "success"),
    ("DATA", "unmarshal_payload_error"),
    ("DATA", "redis_config_missing"),
)
# --- end of fixed values ---

LATENCY_BOUNDS = tuple(
    LATENCY_BUCKET_START * LATENCY_BUCKET_FACTOR**k for k in range(LATENCY_BUCKET_COUNT)
)
MICROS = 1_000_000
#: Sensors write decimal numbers of at most six places: whole numbers of these are exact.
UNITS = 1e6
