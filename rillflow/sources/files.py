"""Files on local disk or object stores: datasets, inventories, snapshots, retention."""

from __future__ import annotations

from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..config import Settings
from ..functions.timefn import ago

# Text formats would otherwise cut timestamps to milliseconds.
TEXT_TIME = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _options(fmt: str) -> dict:
    out = dict(TEXT_TIME) if fmt in ("json", "csv") else {}
    return {**out, "header": True} if fmt == "csv" else out


def read_files(spark: SparkSession, uri: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """A parquet, json, csv or text dataset from any Spark file system (s3a://, gs://, file:/)."""
    reader = spark.read.format(fmt).options(**_options(fmt))
    return (reader.schema(schema) if schema is not None else reader).load(uri)


def write_files(df: DataFrame, uri: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    writer = df.write.format(fmt).options(**_options(fmt)).mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(uri)


def write_bucket(df: DataFrame, path: str, settings: Settings, store: str,
                 fmt: str = "parquet") -> bool:
    """Overwrites s3a://bucket/path or gs://bucket/path; does nothing when no bucket is set."""
    bucket = {"s3": settings.s3_bucket, "gcs": settings.gcs_bucket}[store]
    if not bucket:
        return False
    write_files(df, f"{'s3a' if store == 's3' else 'gs'}://{bucket}/{path}", fmt)
    return True


def write_all(frames: dict[str, DataFrame], folder: str, as_json: tuple[str, ...] = ()) -> None:
    """Named results: Parquet each, JSON for the names in `as_json` (KPI rows)."""
    for name, df in frames.items():
        write_files(df, f"{folder}/{name}", "json" if name in as_json else "parquet")


def file_inventory(spark: SparkSession, uri: str, pattern: str = "*",
                   recursive: bool = True) -> DataFrame:
    """(key, size, last_modified) of every file. The content column is never read."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", recursive).load(uri)
        .select(F.col("path").alias("key"), F.col("length").alias("size"),
                F.col("modificationTime").alias("last_modified"))
    )


def snapshot(df: DataFrame, root: str, name: str, day: date) -> str:
    """Copies a dataset below backup/yyyy/MM/dd/ and returns the folder."""
    target = f"{root}/backup/{day:%Y/%m/%d}/{name}"
    write_files(df, target)
    return target


def row_digest(columns: list[str]) -> list[Column]:
    """Count and order-independent digest of rows: equal for equal bags of rows, whatever their order or files.
    The sums of two hashes tell repeated rows apart, which a plain XOR would cancel out."""
    one, two = F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)
    return [F.count("*").alias("rows"), F.bit_xor(one).alias("xor"),
            F.sum(F.pmod(one, F.lit(2**31))).alias("sum_one"), F.sum(F.pmod(two, F.lit(2**31))).alias("sum_two")]


MANIFEST = "part string, rows long, xor long, sum_one long, sum_two long"
_DIGEST = ("rows", "xor", "sum_one", "sum_two")


class Snapshots:
    """Verified copies of a dataset, cut into parts (such as days), of which only the changed ones are copied.

    `root`/data has the newest copy of each part in a folder of its own, `root`/manifests/<n> the digests of copy n.
    """

    def __init__(self, spark: SparkSession, root: str, part: Column, columns: list[str]):
        self.spark, self.root, self.part, self.columns = spark, root.rstrip("/"), part, columns

    def digests(self, df: DataFrame) -> DataFrame:
        return df.groupBy(self.part.cast("string").alias("part")).agg(*row_digest(self.columns))

    def manifest(self, number: int) -> DataFrame:
        return self.spark.read.schema(MANIFEST).json(f"{self.root}/manifests/{number:06d}")

    def changes(self, df: DataFrame, number: int) -> DataFrame:
        """(part, change): parts of `df` that are new, changed or gone against manifest `number`."""
        new, old = self.digests(df), self.manifest(number)
        equal = reduce(and_, [F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")) for c in _DIGEST])
        both = new.alias("n").join(old.alias("o"), F.col("n.part").eqNullSafe(F.col("o.part")), "full")
        change = F.when(F.col("o.rows").isNull(), "new").when(F.col("n.rows").isNull(), "gone").when(~equal, "changed")
        return both.select(F.coalesce("n.part", "o.part").alias("part"), change.alias("change")).where("change IS NOT NULL")

    def copy(self, df: DataFrame, number: int) -> DataFrame:
        """Copy `number`: writes the parts that differ from copy number - 1, and the manifest. Returns the changes."""
        rows = df.withColumn("part", F.coalesce(self.part.cast("string"), F.lit("null")))
        if number == 0:
            rows.write.mode("overwrite").partitionBy("part").parquet(f"{self.root}/data")
            changes = self.digests(df).select("part", F.lit("new").alias("change"))
        else:
            changes = self.changes(df, number - 1)
            write_files(changes, f"{self.root}/changes/{number:06d}", "json")
            changes = self.spark.read.schema("part string, change string").json(f"{self.root}/changes/{number:06d}")
            wanted = changes.where("change != 'gone'").select(F.coalesce("part", F.lit("null")).alias("part"))
            rows.join(wanted, "part", "left_semi").write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic").partitionBy("part").parquet(f"{self.root}/data")
        write_files(self.digests(df), f"{self.root}/manifests/{number:06d}", "json")
        return changes

    def read(self, number: int) -> DataFrame:
        """The rows of the newest copy; parts that are gone are left out."""
        known = self.manifest(number).select(F.coalesce("part", F.lit("null")).alias("part"))
        return self.spark.read.option("recursiveFileLookup", False).parquet(f"{self.root}/data").withColumn(
            "part", F.col("part").cast("string")).join(known, "part", "left_semi")

    def verify(self, number: int) -> DataFrame:
        """Parts of the stored copy that do not fit the manifest; no rows when the copy is whole."""
        return self.changes(self.read(number).drop("part"), number)


def expired(df: DataFrame, ts: str, as_of: str, days: int = 30) -> DataFrame:
    """Adds `expired`: older than `days` before `as_of`. Nothing is deleted here."""
    return df.withColumn("expired", F.col(ts) < ago(df, ts, as_of, f"{int(days)} days"))


def retention_counts(df: DataFrame, ts: str, as_of: str, days: int = 30) -> DataFrame:
    """Rows to keep and to drop, by day."""
    return expired(df, ts, as_of, days).groupBy(F.to_date(ts).alias("day"), "expired").agg(
        F.count("*").alias("rows"))
