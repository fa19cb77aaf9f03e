"""Session helpers: settings the operators rely on, and the shared folder for written tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str, master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings this library expects; ``conf`` wins over the defaults.

    Keys in ``conf`` use ``__`` for dots: ``spark__driver__memory="8g"``.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.python.unix.domain.socket.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings |= {k.replace("__", "."): str(v) for k, v in conf.items()}
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return ship_package(builder.getOrCreate())


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers, once per application.

    Workers import the functions they run by name, so they need the package wherever they start.
    """
    context = spark.sparkContext
    if getattr(context, "_sensorloom_shipped", False):
        return spark
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="sensorloom-package-")  # read by the driver's file server only
    archive = Path(folder) / "sensorloom.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context._sensorloom_shipped = True
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session, whose one process has one disk, may leave it unset: it gets a temporary
    folder of its own, once per session.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master.split("[")[0] != "local":
        raise ValueError(
            f"spark.checkpoint.dir is not set, and on {master} executors share no local folder: "
            "set it to a folder that the driver and all executors reach"
        )
    chosen = tempfile.mkdtemp(prefix="sensorloom-")
    atexit.register(shutil.rmtree, chosen, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", chosen)
    return chosen


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder. What is written there goes when the driver's JVM ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of the written table.

    Cuts lineage for inputs that several later steps read. Unlike a cache it survives the loss of
    executors, and unlike ``checkpoint()`` it keeps Parquet column pruning and filter push-down for
    each reader.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
