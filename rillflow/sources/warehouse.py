"""Databases, warehouses and catalog tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..config import Settings
from ..functions.timefn import moment
from ..session import shared_dir


def jdbc_options(settings: Settings, table: str) -> dict[str, str]:
    return {"url": settings.database_url, "dbtable": table, "driver": "org.postgresql.Driver"}


def write_database(df: DataFrame, settings: Settings, table: str, mode: str = "append") -> None:
    """Writes over JDBC (needs the database driver on the class path)."""
    df.write.format("jdbc").options(**jdbc_options(settings, table)).mode(mode).save()


def append_warehouse(df: DataFrame, table: str, bigquery: bool = False) -> None:
    """Appends to a warehouse table, creating it from the frame's schema when it is missing."""
    if bigquery:
        df.write.format("bigquery").option("table", table).mode("append").save()
    else:
        df.write.mode("append").saveAsTable(table)


def run_sql(spark: SparkSession, query: str, params: dict | None = None,
            frames: dict[str, DataFrame] | None = None) -> DataFrame:
    """A query over catalog tables and, as {name}, given frames, with :named parameters.

    Errors are raised, not turned into no rows.
    """
    return spark.sql(query, args=params or {}, **(frames or {}))


def create_table(spark: SparkSession, name: str, schema: StructType) -> None:
    cols = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
        for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet")


def missing_required(df: DataFrame, schema: StructType) -> DataFrame:
    """Rows that break a NOT NULL rule of the schema."""
    rules = [f"`{f.name}` IS NULL" for f in schema.fields if not f.nullable]
    return df.where(" OR ".join(rules) if rules else "false")


class MaterializedView:
    """A query result stored as a table behind a view.

    A refresh writes a new version next to the old one and then points the view at it, so readers
    never see a half-written table and the query may read the view it refreshes.
    """

    def __init__(self, spark: SparkSession, name: str, query: str,
                 frames: dict[str, DataFrame] | None = None):
        self.spark, self.name, self.query, self.frames = spark, name, query, frames

    def create(self) -> "MaterializedView":
        if not self.spark.catalog.tableExists(self.name):
            self.refresh()
        return self

    def versions(self) -> list[str]:
        """The stored versions, oldest first."""
        found = [t.name for t in self.spark.catalog.listTables(pattern=f"{self.name}__*")]
        return sorted(n for n in found if n[len(self.name) + 2:].isdigit())

    def refresh(self) -> "MaterializedView":
        """A new version; of the old ones the last stays, for readers that began before."""
        old = self.versions()
        number = int(old[-1].rsplit("__", 1)[1]) + 1 if old else 1
        version = f"{self.name}__{number:09d}"
        folder = f"{shared_dir(self.spark)}/matview/{version}-{uuid.uuid4().hex[:12]}"
        run_sql(self.spark, self.query, frames=self.frames).write.option("path", folder).saveAsTable(version)
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name} AS SELECT * FROM {version}")
        for name in old[:-1]:
            self._drop(name)
        return self

    def _drop(self, version: str) -> None:
        """The table and its folder, which as an external one outlives it."""
        at = self.spark.sql(f"DESCRIBE EXTENDED {version}").where("col_name = 'Location'").first().data_type
        self.spark.sql(f"DROP TABLE {version}")
        path = self.spark._jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)


def write_partitioned(df: DataFrame, path: str, ts: str, column: str = "event_date", replace: str = "all") -> None:
    """A copy partitioned by the date of `ts`.

    Rows are range-partitioned by time first: each task writes few dates, and a busy date is split
    over several tasks and files. `replace`: all dates, or with "days" only those that `df` has rows of, such
    as a day that came late or was corrected; the folders of other days are not touched.
    """
    mode = {"all": "static", "days": "dynamic"}[replace]
    df.withColumn(column, F.to_date(ts)).repartitionByRange(ts).write.mode("overwrite").option(
        "partitionOverwriteMode", mode).partitionBy(column).parquet(path)


def _folders(spark: SparkSession, path: str, column: str) -> dict[str, object]:
    """The partition folders of a copy by their value; no file is opened."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return {}
    names = {s.getPath().getName(): s.getPath() for s in fs.listStatus(at) if s.isDirectory()}
    return {n.split("=", 1)[1]: p for n, p in names.items() if n.startswith(f"{column}=")}


def partition_expiry(spark: SparkSession, path: str, as_of: str, days: int = 30, column: str = "event_date") -> DataFrame:
    """(partition date, expired) of a partitioned copy, from its folder names alone. A day is
    expired when all of it is older than `days` before `as_of`."""
    found = [(d,) for d in sorted(_folders(spark, path, column)) if d[:1].isdigit()]
    rows = spark.createDataFrame(found, f"{column} string").select(F.col(column).cast("date").alias(column))
    last = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"interval {int(days)} days")
    return rows.withColumn("expired", (F.date_add(column, 1)).cast("timestamp_ntz") <= last)


def drop_expired(spark: SparkSession, path: str, as_of: str, days: int = 30, column: str = "event_date") -> list[str]:
    """Deletes the folders of expired days; the rows of the others are neither read nor rewritten."""
    gone = [str(r[0]) for r in partition_expiry(spark, path, as_of, days, column).where("expired").collect()]
    folders = _folders(spark, path, column)
    for day in gone:
        folders[day].getFileSystem(spark._jsc.hadoopConfiguration()).delete(folders[day], True)
    return gone


class DailyView:
    """A result kept up to date from partial aggregates per day.

    `partial` aggregates rows to (day, keys, parts) that `merge` can combine, such as counts, sums, extremes and
    sketches. A refresh reads the rows from the newest stored day on (it may have been incomplete) and
    replaces these days only; `days` recomputes earlier ones that were corrected. The rest of the
    history is neither read nor shuffled, and a day has one stored version.
    """

    def __init__(self, spark: SparkSession, path: str, partial: Callable[[DataFrame], DataFrame],
                 merge: Callable[[DataFrame], DataFrame], ts: str = "timestamp"):
        self.spark, self.path, self.partial, self.merge, self.ts = spark, path, partial, merge, ts

    def refresh(self, rows: DataFrame, days: list[str] | None = None) -> "DailyView":
        stored = [d for d in _folders(self.spark, self.path, "day") if d[:1].isdigit()]
        if stored:
            fresh = F.col(self.ts) >= moment(rows, self.ts, f"{max(stored)} 00:00:00")
            for d in days or []:
                start = moment(rows, self.ts, f"{d} 00:00:00")
                fresh |= (F.col(self.ts) >= start) & (F.col(self.ts) < start + F.expr("interval 1 day"))
            rows = rows.where(fresh)
        parts = self.partial(rows.withColumn("day", F.to_date(self.ts)))
        # a day is one small partition of aggregates, written by one task
        parts.repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "day").parquet(self.path)
        return self

    def stored(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def read(self) -> DataFrame:
        return self.merge(self.stored())
