"""Helpers shared by the text operators."""

from __future__ import annotations

import string
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.session import shared_dir

SPACE = r"[\x20\x09-\x0D]+"
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lower_ascii(c: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def words_of(c: Column) -> Column:
    """The words of a text, parted by space and the characters 9 to 13; none for null."""
    return F.array_remove(F.split(F.coalesce(c, F.lit("")), SPACE), "")


def words(text: str | None) -> list[bytes]:
    """The same words in Python, as UTF-8 with A-Z lower-cased (bytes know ASCII only)."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to a table in the shared folder and read back: cuts the lineage and
    survives lost executors. `discard` removes it again; what a result still reads, the cluster clears."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with shuffles_released(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


@contextmanager
def shuffles_released(spark: SparkSession):
    """Spark removes the shuffle files of what runs inside as soon as it is done. Without, they stay until
    the driver's garbage collector finds that nothing refers to them, which may not come before a long job
    has filled the executors' disks. For writes, whose plans nothing runs again."""
    before = spark.conf.get(RELEASE)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.set(RELEASE, before)


def discard(*frames: DataFrame) -> None:
    """Removes the tables of `stored` frames that nothing will read again."""
    for df in frames:
        spark = df.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Texts go to the Python workers `rows` at a time instead of 10,000, for the session: an Arrow
    batch is held whole by the JVM and by the worker, and texts can be very long. Cells are not cut,
    results stay the same."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def sliced(batches, rows: int = 500):
    """Arrow batches in slices, so that few rows are Python objects at a time."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)
