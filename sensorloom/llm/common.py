"""What several operators of this subpackage share."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sensorloom.session import fresh_path

#: Rows in an Arrow batch. Texts can be very long, so batches stay short.
BATCH_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new path below the folder that the driver and all executors share."""
    return fresh_path(spark, name)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder, and read again; ``discard`` takes the result."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.written_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``written`` that nothing reads any more: all that came from them is written."""
    for table in tables:
        context = table.sparkSession.sparkContext
        place = context._jvm.org.apache.hadoop.fs.Path(table.written_path)
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs whose results are written.

    They go when the driver's JVM collects garbage, which a driver with little to do puts off for long.
    """
    spark.sparkContext._jvm.System.gc()


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound what a Python worker holds of one Arrow batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def row_of(docs: DataFrame) -> Column:
    """All columns of ``docs`` as one struct ``row``, so that no inner name can clash with theirs."""
    return F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("row")


def quoted(name: str) -> str:
    """A column's name as an identifier, whatever it holds."""
    return "`" + name.replace("`", "``") + "`"


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z in lower case and every other character kept.

    ``lower`` also maps letters beyond ASCII, so it serves only texts that have none.
    """
    plain = F.octet_length(text) == F.length(text)
    mapped = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(plain, F.lower(text)).otherwise(mapped)


def crc_bucket(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``; a null key falls in bucket 0."""
    return F.coalesce(F.crc32(key.cast("string")) % modulus, F.lit(0))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where a lambda in ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
