"""Small frames for ties, nulls, empty input, zero denominators and year ends."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import T0, rows_of
from rillflow.functions.numeric import exact_mean, exact_std, exact_sum, pct2
from rillflow.functions.timefn import between, cell, since
from rillflow.operators import aggregates as A, enrich as E, metrics as M, product as P, quality as Q
from rillflow.operators.transforms import apply_all, shared_input

AS_OF = "2024-01-31 00:00:00"


def one(spark, sql):
    return spark.sql(f"select {sql} as x").collect()[0].x


def test_pct2_half_up_and_zero(spark):
    df = spark.createDataFrame([(1, 8), (1, 3), (2, 3), (0, 5), (1, 0)], "a long, b long")
    assert [r.p for r in df.select(pct2(F.col("a"), F.col("b")).alias("p")).collect()] == [
        12.5, 33.33, 66.67, 0.0, None]


def test_exact_numbers_do_not_depend_on_partitions(spark):
    df = spark.range(2000).select((F.col("id") * 37 % 1001 / 100).alias("v"))
    v = F.col("v")
    aggs = [exact_sum(v, 2).alias("s"), exact_mean(v, 2).alias("m"), exact_std(v, 2).alias("d")]
    results = {tuple(df.repartition(n).agg(*aggs).collect()[0]) for n in (1, 3, 7)}
    assert len(results) == 1
    s, m, d = results.pop()
    plain = df.agg(F.sum("v"), F.avg("v"), F.stddev_samp("v")).collect()[0]
    assert [s, m, d] == pytest.approx(list(plain))


def test_std_of_one_row_is_null(make_events):
    r = A.user_metrics(make_events([(0, "a", None, 3.0)]), 2).collect()[0]
    assert r.value_std is None and r.value_sum == 3.0 and r.value_count == 1


def test_cell_floors_before_the_epoch(spark):
    df = spark.createDataFrame([(-1,), (0,), (59,), (60,)], "us long")
    assert [r.c for r in df.select(cell("us", 60).alias("c")).collect()] == [-60, 0, 0, 60]


def test_since_and_between(make_events):
    e = make_events([(-86400, "a"), (0, "b"), (1, "c")])
    assert since(e, "timestamp", "2024-01-02 00:00:00", "24 hours").count() == 2
    assert between(e, "timestamp", "2023-12-31", "2024-01-01 00:00:01").count() == 2


AGENTS = [
    ("Mozilla/5.0 (iPhone) Chrome/91 Mobile Safari", "Mobile", "Chrome"),
    ("Tablet Mobile Firefox", "Mobile", "Firefox"), ("Tablet Edge/91 Safari/537", "Tablet", "Safari"),
    ("Opera/9.80", "Desktop", "Other"), ("mobile chrome", "Desktop", "Other"),
    (None, "Desktop", "Other"),
]


def test_agents(spark):
    df = spark.createDataFrame([(a,) for a, *_ in AGENTS], "user_agent string").withColumn(
        "page_url", F.lit("https://a.b/c?u=http://x.y/z"))
    got = E.enrich_events(df).collect()
    assert [(r.device_type, r.browser) for r in got] == [(d, b) for _, d, b in AGENTS]
    assert got[0].clean_page_url == "/c?u=/z"


def test_value_band_null_and_edges(spark):
    df = spark.createDataFrame([(4.99,), (5.0,), (14.99,), (15.0,), (None,)], "value double")
    want = ["low", "medium", "medium", "high", None]
    assert [r.b for r in df.select(E.value_band(F.col("value")).alias("b")).collect()] == want
    assert [r.b for r in df.select(F.call_function(E.register_value_band(spark), F.col("value")).alias("b")).collect()] == want


def test_weekday(make_events):
    got = E.time_features(make_events([(i * 86400, "a") for i in range(7)])).orderBy("id").collect()
    assert [r.day_of_week for r in got] == [0, 1, 2, 3, 4, 5, 6]  # 2024-01-01 is a Monday
    assert [r.is_weekend for r in got] == [False] * 5 + [True] * 2


def test_payload_defaults(spark):
    df = spark.createDataFrame([
        (1, "purchase", '{"total_amount": 12.5, "items_count": 3}'), (2, "purchase", "{}"),
        (3, "purchase", "not json"), (4, "purchase", None), (5, "video_complete", '{"video_id": "v"}'),
        (6, "search", '{"search_query": "tv", "search_results_count": 7}'), (7, "search", "{}"),
    ], "id long, event_type string, event_data string")
    assert rows_of(E.purchase_payload(df), "id", "total_amount", "items_count") == [
        (1, 12.5, 3), (2, 0.0, 0), (3, 0.0, 0), (4, 0.0, 0)]
    typed = {r.id: r for r in E.typed_payload(df).collect()}
    assert (typed[5].video_id, typed[5].video_duration, typed[5].search_query) == ("v", 0, None)
    assert (typed[6].search_query, typed[6].search_results_count) == ("tv", 7)
    assert (typed[7].search_query, typed[7].search_results_count) == ("", 0)


def test_dimensions_missing_gives_empty_map(spark):
    df = spark.createDataFrame([('{"a": 1, "b": "x"}',), (None,)], "dimensions string")
    assert [r.dims for r in E.metric_dimensions(df).collect()] == [{"a": "1", "b": "x"}, {}]


def test_session_analytics_ties_and_unknown(make_events):
    e = make_events([(0, "a", "view", 1.0, "s"), (0, "b", "click", 2.0, "s"), (90, "a", "view", 3.0, "s"),
                     (5, "c", "view", 4.0, "t")])
    e = e.withColumns({
        "category": F.when(F.col("id") == 0, "Z").when(F.col("id") == 1, "A"),
        "device_type": F.lit("d"), "country": F.concat(F.lit("c"), F.col("id").cast("string"))})
    got = {r.session_id: r for r in A.session_analytics(e, 2).collect()}
    s = got["s"]
    assert (s.user_id_first, s.country_first, s.category_mode) == ("a", "c0", "A")
    assert (s.events_per_session, s.total_value, s.avg_value, s.unique_event_types) == (3, 6.0, 2.0, 2)
    assert s.session_duration_minutes == 1.5 and got["t"].category_mode == "Unknown"


def test_empty_hours(make_events):
    e = make_events([(0, "a", "view", 2.0), (10, "b", "click", 4.0), (3 * 3600, "a", "view", 8.0)])
    got = A.rolling_24h(e, 2).orderBy("hour").collect()
    assert [(r.value_sum, r.value_count, r.user_id_nunique, r.event_type_mode) for r in got] == [
        (6.0, 2, 2, "click"), (0.0, 0, 0, "None"), (0.0, 0, 0, "None"), (8.0, 1, 1, "view")]
    assert got[1].value_mean is None and got[3].value_sum_rolling_24h == 3.5
    assert [r.value_sum for r in A.resample_sum(e, 2).orderBy("hour").collect()] == [6.0, 0.0, 0.0, 8.0]


def test_empty_input(make_events):
    e = make_events([]).withColumn("country", F.lit("x"))
    assert A.rolling_24h(e).count() == 0 and A.user_zscore(e).count() == 0
    r = A.event_statistics(e).collect()[0]
    assert (r.total_events_processed, r.unique_users, r.average_events_per_user) == (0, 0, 0.0)
    assert [x.conversion_rate for x in P.funnel(e, AS_OF).collect()] == [None] * 4
    assert A.engagement_histogram(e).count() == 0
    assert A.kpis(e, AS_OF).collect()[0].avg_value is None


def test_scale_none_is_plain_double(make_events):
    e = make_events([(i, "ab"[i % 2], "view", i + 0.123456) for i in range(6)])
    got = {r.user_id: r for r in A.user_metrics(e).collect()}
    assert got["a"].value_sum == pytest.approx(0.123456 * 3 + 6)
    z = A.user_zscore(e).collect()
    assert sorted(round(r.z_score, 6) for r in z) == [-0.707107, 0.707107]
    other = A.user_zscore(e, dispersion="std_of_std").collect()
    assert all(r.z_score is None or abs(r.z_score) > 1 for r in other)


def test_zscore_flags_outlier(make_events):
    rows = [(i, f"u{i}", "view", 10.0 + i % 2) for i in range(30)] + [(99, "odd", "view", 500.0)]
    got = A.user_zscore(make_events(rows), 2, only_anomalies=True).collect()
    assert [r.user_id for r in got] == ["odd"]
    assert got[0].z_score == pytest.approx(
        [r for r in A.user_zscore(make_events(rows)).collect() if r.user_id == "odd"][0].z_score)


@pytest.mark.parametrize("days,level", [(20, "Highly Active"), (10, "Moderately Active"),
                                        (5, "Occasionally Active"), (4, "Rarely Active")])
def test_activity_level(make_events, days, level):
    r = A.user_activity(make_events([(i * 86400, "a") for i in range(days)]), AS_OF).collect()[0]
    assert (r.active_days, r.activity_level) == (days, level)


def test_user_activity_tie_break_and_top(make_events):
    got = A.user_activity(make_events([(0, "b"), (1, "a"), (2, "c"), (3, "c")]), AS_OF, top=2).collect()
    assert [r.user_id for r in got] == ["c", "a"]


def test_retention_over_the_year_end(make_events):
    start = (datetime(2023, 12, 27) - T0).total_seconds()
    e = make_events([(start, "a"), (start + 7 * 86400, "a"), (start + 86400, "b"),
                     (start + 14 * 86400, "b"), (start + 7 * 86400, "c")])
    got = rows_of(P.cohort_retention(e), "cohort_week", "week_number", "cohort_size", "active_users",
                  "retention_rate")
    first, second = datetime(2023, 12, 25), datetime(2024, 1, 1)
    assert [(r[0].replace(tzinfo=None), *r[1:]) for r in got] == [
        (first, 0, 2, 2, 100.0), (first, 1, 2, 1, 50.0), (first, 2, 2, 1, 50.0), (second, 0, 1, 1, 100.0)]


def test_retention_keeps_first_twelve_weeks(make_events):
    e = make_events([(w * 7 * 86400, "a") for w in (0, 12, 13)])
    assert rows_of(P.cohort_retention(e), "week_number") == [(0,), (12,)]


def test_funnel_middle_step_missing(make_events):
    e = make_events([(0, "a", "page_view"), (1, "a", "click"), (2, "a", "purchase"), (3, "b", "page_view"),
                     (4, "c", "scroll")])
    got = {r.step_name: (r.completions, r.conversion_rate) for r in P.funnel(e, AS_OF).collect()}
    assert got == {"Page View": (2, 100.0), "Click": (1, 50.0), "Add to Cart": (0, 0.0),
                   "Purchase": (1, None)}


def test_session_analysis_null_duration_first(spark, make_events):
    e = make_events([(0, "a", "page_view"), (1, "b", "click"), (2, "a", "click")])
    s = spark.createDataFrame(
        [("sa", "a", 5, 2, 1, "d", "x", T0), ("sb", "b", None, 1, 1, "d", "x", T0),
         ("sz", "z", 9, 1, 1, "d", "x", T0), ("old", "a", 9, 1, 1, "d", "x", T0 - timedelta(days=30))],
        "session_id string, user_id string, duration_seconds int, page_views int, unique_pages int, "
        "device_type string, country string, start_time timestamp_ntz")
    got = P.session_analysis(s, e, "2024-01-07 00:00:00").collect()
    assert [(r.session_id, r.actual_events, r.page_view_ratio) for r in got] == [
        ("sb", 1, 0.0), ("sa", 2, 0.5)]


def test_user_with_two_countries(make_events):
    e = make_events([(0, "a"), (1, "a"), (0, "b")]).withColumn(
        "country", F.when(F.col("id") == 1, "B").otherwise("A"))
    assert rows_of(A.user_dim(e), "user_id", "country") == [("a", "A"), ("a", "B"), ("b", "A")]
    assert rows_of(A.with_user_dim(e), "id", "user_country") == [(0, "B"), (1, "B"), (2, "A")]


def test_histogram_of_equal_users(make_events):
    got = A.engagement_histogram(make_events([(0, "a"), (1, "b")])).collect()
    assert [(r.bin, r.users) for r in got] == [(0, 2)]


def test_recent_events_page(make_events):
    got = E.recent_events(make_events([(i // 2, "a") for i in range(10)]), 3, 2).collect()
    assert [r.id for r in got] == [7, 6, 5]


def test_health_rules(spark):
    rows = [("p", c, s) for c, s in zip("abcd", ["healthy"] * 4)]
    rows += [("q", "a", "healthy"), ("q", "b", "healthy"), ("q", "c", "unavailable")]
    rows += [("r", "a", "healthy"), ("r", "b", "error")]
    df = spark.createDataFrame(rows, "pipeline string, component string, status string")
    health = M.health_rollup(df, ["pipeline"])
    assert rows_of(health, "pipeline", "overall_status", "api_status") == [
        ("p", "healthy", "healthy"), ("q", "degraded", "degraded"), ("r", "unhealthy", "error")]
    bad = M.alerts(M.health_measures(health, "pipeline"))
    assert rows_of(bad, "window_start", "num", "severity") == [("q", 1, "error"), ("r", 1, "error")]


def test_alert_thresholds_are_exclusive(spark):
    df = spark.createDataFrame([
        (1, "error_rate", 1, 100), (2, "error_rate", 2, 100), (3, "utilization", 80, 100),
        (4, "utilization", 81, 100), (5, "processing_lag_seconds", 300, 1),
        (6, "processing_lag_seconds", 301, 1), (7, "error_rate", 0, 0), (8, "unknown", 9, 1),
    ], "window_start int, metric string, num long, den long")
    assert rows_of(M.alerts(df), "window_start", "severity") == [
        (2, "error"), (4, "warning"), (6, "warning")]


def test_align_reduce_differs_from_plain_mean(spark):
    rows = [(1, "m", 1.0, '{"h": "a"}'), (2, "m", 1.0, '{"h": "a"}'), (3, "m", 4.0, '{"h": "b"}')]
    df = spark.createDataFrame(rows, "id long, metric_name string, metric_value double, dimensions string"
                               ).withColumn("timestamp", F.lit(T0).cast("timestamp_ntz"))
    for scale in (None, 2):
        assert [(r.value, r.series) for r in M.align_reduce(df, scale=scale).collect()] == [(2.5, 2)]
    assert [r.value for r in M.align_reduce(df, labels={"h": "b"}).collect()] == [4.0]


def test_quality_scores(spark, make_events):
    e = make_events([(0, "a"), (1, "b"), (2, None), (3, "a", "odd")])
    e = e.unionByName(e.where("id = 0"))
    known = spark.createDataFrame([("a",), ("a",)], "user_id string")
    got = {r.metric: (r.score, r.status) for r in Q.quality_scores(
        e, known, "2024-01-02 00:00:00", "1 day", ["id", "user_id"], ["view"], {"page_url": 2}).collect()}
    assert got == {"completeness": (80.0, "Fair"), "accuracy": (60.0, "Poor"),
                   "consistency": (80.0, "Fair"), "timeliness": (100.0, "Excellent"),
                   "validity": (0.0, "Poor")}


def test_profile_nulls_and_approximate(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (2, "y"), (None, None)], "a int, b string")
    exact = {r.column_name: (r.rows, r.nulls, r.distinct_values, r.min_value, r.max_value)
             for r in Q.column_profile(df, ["a", "b"]).collect()}
    assert exact == {"a": (4, 1, 2, "1", "2"), "b": (4, 2, 2, "x", "y")}
    rough = {r.column_name: (r.rows, r.nulls, r.distinct_values, r.min_value, r.max_value)
             for r in Q.column_profile(df, ["a", "b"], exact=False).collect()}
    assert rough == exact


def test_correlation(spark):
    df = spark.range(50).select("id", (F.col("id") * 2).alias("up"), (-F.col("id")).alias("down"),
                                F.lit(3).alias("flat"))
    got = {r.column_name: r.correlation
           for r in Q.order_correlation(df, ["up", "down", "flat"], "id").collect()}
    assert got["up"] == pytest.approx(1) and got["down"] == pytest.approx(-1) and got["flat"] is None
    far = spark.range(100).select((F.col("id") * 7 + 1_500_000_000_000_000_000).alias("id"), "id", F.lit(1).alias("z")).toDF("k", "up", "z")
    assert Q.order_correlation(far, ["up"], "k").collect()[0].correlation == pytest.approx(1)


def test_apply_all_and_shared_input(spark):
    with shared_input(spark.range(10)) as d:
        done = apply_all(d, {"even": lambda x: x.where("id % 2 = 0"), "n": lambda x: x.agg(F.count("*"))})
        assert d.is_cached and done["even"].count() == 5 and done["n"].collect()[0][0] == 10
    assert not d.is_cached


def test_daily_activity_uses_dates(make_events):
    e = make_events([(86399, "a"), (86400, "a")])
    assert rows_of(A.daily_activity(e, AS_OF), "activity_date", "daily_events") == [
        (date(2024, 1, 1), 1), (date(2024, 1, 2), 1)]
