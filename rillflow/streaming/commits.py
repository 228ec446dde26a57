"""Several outputs of one stream in one write per batch, valid together by a commit record.

Layout below a root folder: `data/attempt=<batch>-<id>/sink=<name>/` holds the rows, one struct column per
sink, `commits/<batch>.json` the record: batch, attempt, and what was measured while writing. An
attempt without a record does not exist for readers, so a batch that fails or is repeated shows all of its outputs
or none. Records are put in place by a rename, after the data.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def put_once(spark: SparkSession, path: str, text: str) -> bool:
    """A small file that appears whole, if nothing is there yet."""
    fs, target = _fs(spark, path)
    _, temp = _fs(spark, f"{path.rsplit('/', 1)[0]}/_{uuid.uuid4().hex}.tmp")
    out = fs.create(temp, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    done = not fs.exists(target) and fs.rename(temp, target)
    if not done:
        fs.delete(temp, False)
    return done


class Sinks:
    """Named outputs of a stream below one root.

    `parts` has for each output its condition and its columns, over what `prepare` makes of a batch; a row goes
    to the first whose condition holds, rows that fit none are not written. `measures` are aggregates
    over these rows that the same write takes along, for the commit record (numbers).
    """

    def __init__(self, root: str, parts: dict[str, tuple[Column, list]], measures: tuple[Column, ...] = (),
                 prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch):
        self.root, self.parts, self.measures, self.prepare = root.rstrip("/"), parts, measures, prepare

    def _record(self, batch_id: int) -> str:
        return f"{self.root}/commits/{batch_id:020d}.json"

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """The foreachBatch function. A batch that has its record is done and not written again."""
        spark = batch.sparkSession
        fs, record = _fs(spark, self._record(batch_id))
        if fs.exists(record):
            return
        attempt = f"{batch_id:020d}-{uuid.uuid4().hex[:12]}"
        parts = self.parts
        sink = F.coalesce(*[F.when(cond, F.lit(name)) for name, (cond, _) in parts.items()])
        rows = self.prepare(batch).withColumn("_sink", sink)
        seen = Observation()
        counts = [F.count_if(F.col("_sink") == name).alias(f"rows_{name}") for name in parts]
        rows = rows.observe(seen, F.count("*").alias("rows"), *counts, *self.measures)
        rows.select(F.col("_sink").alias("sink"), *[
            F.when(F.col("_sink") == name, F.struct(*cols)).alias(name) for name, (_, cols) in parts.items()
        ]).where("sink IS NOT NULL").write.partitionBy("sink").parquet(f"{self.root}/data/attempt={attempt}")
        put_once(spark, self._record(batch_id), json.dumps(
            {"batch": batch_id, "attempt": attempt, **seen.get}))

    def commits(self, spark: SparkSession, schema: str = "") -> DataFrame:
        """The records: batch, attempt, rows and what else `schema` names of them."""
        fields = "batch long, attempt string, rows long" + (f", {schema}" if schema else "")
        return spark.read.schema(fields).json(f"{self.root}/commits")

    def read(self, spark: SparkSession, name: str, schema: StructType) -> DataFrame:
        """The committed rows of one output. Only its folders are read; attempts without a record
        drop out by a join on the partition column."""
        kind = StructType([StructField(name, schema)]).add("attempt", "string").add("sink", "string")
        rows = spark.read.schema(kind).parquet(f"{self.root}/data").where(F.col("sink") == name)
        return rows.join(self.commits(spark).select("attempt"), "attempt", "left_semi").select(f"{name}.*")

    def clean(self, spark: SparkSession) -> int:
        """Removes the data of attempts that were not committed. Only while no batch is being written."""
        fs, data = _fs(spark, f"{self.root}/data")
        valid = {r.attempt for r in self.commits(spark).select("attempt").toLocalIterator()}
        gone = [s.getPath() for s in fs.listStatus(data) if s.isDirectory()
                and s.getPath().getName().removeprefix("attempt=") not in valid]
        for path in gone:
            fs.delete(path, True)
        return len(gone)
