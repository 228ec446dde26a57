"""Stream sources and sinks on files, with checkpoints in the shared folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..schemas import ENVELOPE


def file_stream(spark: SparkSession, folder: str, schema: StructType, fmt: str = "parquet",
                pattern: str | None = None, max_files: int | None = None) -> DataFrame:
    """New files of a folder as a stream."""
    reader = spark.readStream.format(fmt).schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def table_stream(spark: SparkSession, path: str, schema: StructType,
                 max_bytes: int | None = None) -> DataFrame:
    """A Parquet table as a stream, whether it is one file or a folder of part files.

    A missing path is an error, not an empty stream. `max_bytes` sizes the batches.
    """
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    status = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(at)
    reader = spark.readStream.format("parquet").schema(schema)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    if status.isDirectory():
        return reader.load(path)
    return reader.option("pathGlobFilter", at.getName()).load(at.getParent().toString())


def topic_files(spark: SparkSession, folder: str, topics: list[str],
                max_files: int | None = None) -> DataFrame:
    """JSON files with the record envelope of a topic, for jobs without a broker."""
    stream = file_stream(spark, folder, ENVELOPE, "json", max_files=max_files)
    return stream.where(F.col("topic").isin(topics))


def _started(writer, trigger_seconds: int | None) -> StreamingQuery:
    if trigger_seconds is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{trigger_seconds} seconds")
    return writer.start()


def to_parquet(df: DataFrame, path: str, checkpoint: str,
               trigger_seconds: int | None = 60) -> StreamingQuery:
    """Appends to Parquet files exactly once. trigger_seconds=None: process what is there, stop."""
    return _started(
        df.writeStream.outputMode("append").format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint), trigger_seconds)


def for_each(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
             mode: str = "append", trigger_seconds: int | None = 60) -> StreamingQuery:
    return _started(
        df.writeStream.outputMode(mode).foreachBatch(fn)
        .option("checkpointLocation", checkpoint), trigger_seconds)


def changed_rows(path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch sink: the rows of each batch in their own folder; a repeat overwrites it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def current_rows(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The newest version of each key written by an update-mode query through `changed_rows`."""
    rows = spark.read.parquet(path)
    values = [c for c in rows.columns if c not in (*keys, "batch")]
    return rows.groupBy(*keys).agg(
        F.max_by(F.struct(*values), "batch").alias("_v")).select(*keys, "_v.*")


def finish(query: StreamingQuery) -> None:
    """Waits for an availableNow query and raises its error, if any."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
