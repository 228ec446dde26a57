"""Sources, sinks and catalog tables."""

import json
from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from conftest import SF, T0, rows_of
from rillflow.config import Settings
from rillflow.plans import jobs
from rillflow.schemas import TABLES, USER_EVENTS_TABLE
from rillflow.session import shared_dir
from rillflow.sources import files, model, topics, warehouse


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_settings_from_environment():
    s = Settings.from_env({"S3_BUCKET": "b", "WINDOW_DURATION": "60", "OTHER": "x"})
    assert (s.s3_bucket, s.window_duration, s.gcs_bucket) == ("b", 60, "")


def test_topic_and_database_options():
    s = Settings(poll_records=500)
    o = topics.kafka_options(s, ["a", "b"])
    assert (o["subscribe"], o["startingOffsets"], o["maxOffsetsPerTrigger"]) == ("a,b", "latest", "500")
    assert "maxOffsetsPerTrigger" not in topics.kafka_options(Settings(), ["a"])
    assert warehouse.jdbc_options(s, "t")["dbtable"] == "t"


def test_envelope_round_trip(spark, make_events):
    e = make_events([(0.000001, "a", "view", 1.5)]).select("user_id", "event_type", "timestamp", "value")
    env = topics.to_envelope(e, "user_id", ["event_type"])
    r = env.collect()[0]
    assert r.key == "a" and [(h.key, bytes(h.value)) for h in r.headers] == [("event_type", b"view")]
    assert json.loads(r.value)["timestamp"] == "2024-01-01T00:00:00.000001"
    assert rows_of(topics.parse_json(env, e.schema), *e.columns) == rows_of(e, *e.columns)


def test_bad_messages(spark):
    rows = [('{"k": 1}', "t"), ('{"k": ', "t"), ("[", "t"), (None, "t"), ('{"k": 2}', "u"),
            ('{"k": 3}', None), ('{"other": 1}', "t")]
    checked = topics.check_messages(spark.createDataFrame(rows, "value string, topic string"),
                                    StructType().add("k", "long"), ["t"])
    assert [r.k for r in topics.good_messages(checked).collect()] == [1, None]
    assert [r.reason for r in topics.dead_letters(checked).collect()] == [
        "bad message"] * 3 + ["unknown topic"] * 2


def test_bucket_writes_are_skipped_without_bucket(spark):
    assert not files.write_bucket(spark.range(1), "x", Settings(), "s3")
    assert not files.write_bucket(spark.range(1), "x", Settings(), "gcs")


def test_inventory_reads_no_content(spark):
    inv = files.file_inventory(spark, SF, "*.parquet")
    assert "content" not in plan(inv).split("ReadSchema")[1]
    assert inv.count() == 14 and inv.where("size > 0").count() == 14


def test_text_files(spark, tmp_path):
    files.write_files(spark.createDataFrame([("a",), ("b",)], "value string"), str(tmp_path / "t"), "text")
    assert rows_of(files.read_files(spark, str(tmp_path / "t"), "text"), "value") == [("a",), ("b",)]


def test_snapshot_folder(spark, tmp_path):
    path = files.snapshot(spark.range(3), str(tmp_path), "n", date(2024, 2, 3))
    assert path.endswith("backup/2024/02/03/n") and spark.read.parquet(path).count() == 3


def test_retention_boundary(spark, make_events):
    e = make_events([(0, "a"), (-0.000001, "a")])
    got = rows_of(files.expired(e, "timestamp", "2024-01-31 00:00:00", 30), "id", "expired")
    assert got == [(0, False), (1, True)]


def test_partitioned_copy_prunes(spark, make_events, tmp_path):
    e = make_events([(i * 3600, "a") for i in range(72)])
    warehouse.write_partitioned(e, str(tmp_path / "p"), "timestamp")
    day = spark.read.parquet(str(tmp_path / "p")).where("event_date = date'2024-01-02'")
    assert "PartitionFilters: [isnotnull(event_date" in plan(day)
    assert day.count() == 24


def test_sql_parameters_and_errors(spark, make_events):
    e = make_events([(0, "a"), (1, "b")])
    got = warehouse.run_sql(spark, "select id from {ev} where user_id = :u", {"u": "b"}, {"ev": e})
    assert rows_of(got, "id") == [(1,)]
    with pytest.raises(PySparkException):
        warehouse.run_sql(spark, "select nothing from nowhere").collect()


def test_create_tables_and_required_columns(spark):
    for name, schema in TABLES.items():
        warehouse.create_table(spark, name, schema)
        assert spark.table(name).columns == schema.names
    row = {f.name: None for f in USER_EVENTS_TABLE.fields}
    full = {**row, "id": 1, "user_id": "u", "session_id": "s", "event_type": "t", "timestamp": T0}
    loose = StructType([type(f)(f.name, f.dataType, True) for f in USER_EVENTS_TABLE.fields])
    df = spark.createDataFrame([full, {**full, "id": 2, "user_id": None}], loose)
    assert [r.id for r in warehouse.missing_required(df, USER_EVENTS_TABLE).collect()] == [2]


def test_append_creates_then_appends(spark):
    for _ in range(2):
        warehouse.append_warehouse(spark.range(2), "appended")
    assert spark.table("appended").count() == 4


def test_materialized_view_refresh(spark, make_events):
    make_events([(0, "a")]).createOrReplaceTempView("mv_source")
    view = warehouse.MaterializedView(spark, "mv", "select count(*) as n from mv_source").create()
    make_events([(0, "a"), (1, "b")]).createOrReplaceTempView("mv_source")
    assert view.create().read().collect()[0].n == 1
    assert view.refresh().read().collect()[0].n == 2
    warehouse.MaterializedView(spark, "mv2", "select n + 1 as n from mv").create()
    own = warehouse.MaterializedView(spark, "mv2", "select n + 1 as n from mv2")
    assert own.refresh().read().collect()[0].n == 4


class Fake:
    """A session with the given setting, master and checkpoint folder."""

    def __init__(self, setting, master="yarn", folder=None):
        self.sparkContext = self.conf = self
        self.setting, self.master, self.folder = setting, master, folder

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.setting or default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_shared_dir():
    assert shared_dir(Fake("hdfs://x/cp/")) == "hdfs://x/cp"
    assert shared_dir(Fake(None, folder="hdfs://x/own")) == "hdfs://x/own"
    with pytest.raises(ValueError):
        shared_dir(Fake(None))
    local = Fake(None, "local[2]")
    assert shared_dir(local) == shared_dir(local) and "rillflow-" in local.folder


def test_event_job(spark, make_events, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    make_events([(0, "a"), (60, "a"), (7000, "b")]).write.parquet(src)
    jobs.run_events(spark, src, out)
    got = spark.read.parquet(out)
    assert {"clean_page_url", "session_duration", "events_5min", "unique_users_1hour",
            "is_anomaly"} <= set(got.columns) and got.count() == 3
    jobs.run_events(spark, src, out, "2024-01-01 02:30:00", only_essential=True)
    assert rows_of(spark.read.parquet(out), "user_id") == [("b",)]


def test_report_job(spark, make_events, tmp_path):
    e = make_events([(i * 600, "ab"[i % 2], "view", 1.0 * i) for i in range(10)]).withColumns({
        "category": F.lit("A"), "device_type": F.lit("Mobile"), "country": F.lit("DE")})
    jobs.run_report(e, str(tmp_path / "r"), "2024-01-02 00:00:00", 2)
    kpi = spark.read.json(str(tmp_path / "r" / "kpis")).collect()[0]
    assert (kpi.total_events, kpi.unique_users, kpi.events_last_24h, kpi.avg_value) == (10, 2, 10, 4.5)
    assert "user_id" in spark.read.parquet(str(tmp_path / "r" / "user_metrics")).columns


def test_filters_and_columns_reach_the_scan(spark):
    from __spark_entry__ import queries

    p = plan(queries()["hourly_metrics"](spark, SF))
    assert "GreaterThanOrEqual(ts,2024-01-24T00:00)" in p
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in p
    assert "In(event_type" in plan(queries()["funnel"](spark, SF))
    assert "html" not in plan(queries()["essential_cols"](spark, SF)).split("ReadSchema", 1)[1]


def test_no_pairwise_joins_and_no_python_in_built_in_queries(spark):
    from rillflow.plans.registry import QUERIES

    quick = {n: f for n, f in QUERIES.items() if not n.startswith(
        ("stream_", "round_trip", "matview", "snapshot", "partition"))}
    for name, fn in quick.items():
        p = plan(fn(spark, SF))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name
        assert "Python" not in p and "Pandas" not in p, name


def test_model_joins_only_what_is_asked_for(spark):
    assert "Join" not in plan(model.user_events(spark, SF))
    assert plan(model.user_events(spark, SF, pages=True)).count("Join") == 1
