-- name: metric_summary
WITH r AS (SELECT *, row_number() OVER (PARTITION BY metric_name ORDER BY "timestamp" DESC, id DESC) AS rn FROM analytics_metrics)
SELECT metric_name, count(*) AS count, min(metric_value) AS min, max(metric_value) AS max,
       CAST(sum(cents) AS DOUBLE) / count(*) / 100 AS avg, last(metric_value ORDER BY "timestamp", id) AS latest_value
FROM r WHERE rn <= 1000 GROUP BY metric_name

-- name: metric_change
WITH p AS (SELECT *, lag(metric_value) OVER (PARTITION BY metric_name ORDER BY "timestamp", id) AS pv FROM analytics_metrics)
SELECT id, metric_name, metric_value, pv AS previous_value,
       (metric_value - pv) / nullif(pv, 0) * 100 AS change_percent,
       coalesce(abs((metric_value - pv) / nullif(pv, 0) * 100) > 20, FALSE) AS is_significant FROM p

-- name: metric_rollup_5m
SELECT time_bucket(INTERVAL 5 MINUTE, "timestamp") AS period_start, metric_name, dimensions,
       CAST(sum(cents) AS DOUBLE) / count(*) / 100 AS average, CAST(sum(cents) AS DOUBLE) / 100 AS sum,
       max(metric_value) AS maximum, min(metric_value) AS minimum
FROM analytics_metrics GROUP BY 1, 2, 3

-- name: metric_align_reduce
WITH a AS (
  SELECT time_bucket(INTERVAL 5 MINUTE, "timestamp") AS w, metric_name, dimensions,
         (20000 * sum(cents) + count(*)) // (2 * count(*)) AS m FROM analytics_metrics GROUP BY 1, 2, 3)
SELECT w AS period_start, w + INTERVAL 5 MINUTE AS period_end, metric_name,
       CAST(sum(m) AS DOUBLE) / count(*) / 1000000 AS value, count(*) AS series FROM a GROUP BY w, metric_name

-- name: metric_align_label
WITH a AS (
  SELECT time_bucket(INTERVAL 1 DAY, "timestamp") AS w, metric_name, dimensions,
         (20000 * sum(cents) + count(*)) // (2 * count(*)) AS m FROM analytics_metrics
  WHERE json_extract_string(dimensions, '$.k') = '7' GROUP BY 1, 2, 3)
SELECT w AS period_start, w + INTERVAL 1 DAY AS period_end, metric_name,
       CAST(sum(m) AS DOUBLE) / count(*) / 1000000 AS value, count(*) AS series FROM a GROUP BY w, metric_name

-- name: latest_metric
WITH r AS (SELECT * FROM analytics_metrics WHERE "timestamp" >= TIMESTAMP '2024-01-31' - INTERVAL 1 HOUR),
p AS (SELECT metric_name, time_bucket(INTERVAL 5 MINUTE, "timestamp") AS w, CAST(sum(cents) AS DOUBLE) / count(*) / 100 AS average
      FROM r GROUP BY 1, 2)
SELECT r.metric_name, last(metric_value ORDER BY "timestamp", id) AS latest_value, max("timestamp") AS latest_time,
       min(l.average) AS latest_average
FROM r JOIN (SELECT metric_name, last(average ORDER BY w) AS average FROM p GROUP BY metric_name) l
  ON l.metric_name = r.metric_name GROUP BY r.metric_name

-- name: health_rollup
WITH s AS (
  SELECT country, CAST(date_trunc('day', "timestamp") AS TIMESTAMP) AS day, event_type,
         CASE WHEN max(value) > 200 THEN 'error' WHEN max(value) > 100 THEN 'unavailable' ELSE 'healthy' END AS status
  FROM user_events GROUP BY 1, 2, 3)
SELECT country, day, count(*) AS components, count(*) FILTER (status = 'healthy') AS healthy_components,
       CASE WHEN count(*) FILTER (status = 'healthy') = count(*) THEN 'healthy'
            WHEN count(*) FILTER (status = 'healthy') > count(*) // 2 THEN 'degraded' ELSE 'unhealthy' END AS overall_status,
       CASE WHEN bool_and(status = 'healthy') THEN 'healthy' WHEN bool_or(status = 'error') THEN 'error'
            ELSE 'degraded' END AS api_status
FROM s GROUP BY country, day

-- name: error_rate_alerts
WITH h AS (
  SELECT date_trunc('hour', "timestamp") AS w, count(*) AS n, count(*) FILTER (event_type = 'error') AS e,
         CAST(epoch(date_trunc('hour', max("timestamp")) + INTERVAL 1 HOUR) - floor(epoch(max("timestamp"))) AS BIGINT) AS lag
  FROM user_events GROUP BY 1)
SELECT w AS window_start, 'error_rate' AS metric, e AS num, n AS den, 'error' AS severity FROM h WHERE 100 * e > n
UNION ALL
SELECT w, 'processing_lag_seconds', lag, 1, 'warning' FROM h WHERE lag > 300

-- name: health_alerts
WITH s AS (
  SELECT country, CAST(date_trunc('day', "timestamp") AS TIMESTAMP) AS day, event_type, max(value) > 100 AS bad
  FROM user_events GROUP BY 1, 2, 3)
SELECT day AS window_start, 'failed_checks' AS metric, 'error' AS severity,
       count(*) FILTER (bad) AS failed FROM s GROUP BY day HAVING count(*) FILTER (bad) > 0

-- name: sliding_counts
SELECT w AS window_start, w + INTERVAL 300 SECOND AS window_end, event_type, count(*) AS n FROM (
  SELECT event_type, date_trunc('minute', "timestamp") - INTERVAL 1 MINUTE * k AS w
  FROM user_events, range(5) r(k)) GROUP BY w, event_type

-- name: stream_sliding_counts
SELECT w AS window_start, w + INTERVAL 300 SECOND AS window_end, event_type, count(*) AS n FROM (
  SELECT event_type, date_trunc('minute', "timestamp") - INTERVAL 1 MINUTE * k AS w
  FROM user_events, range(5) r(k))
WHERE w + INTERVAL 300 SECOND <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR
GROUP BY w, event_type

-- name: stream_enrich
SELECT id, device_type, browser, "timestamp" FROM user_events

-- name: stream_type_counts
SELECT event_type, count(*) AS n FROM user_events GROUP BY event_type

-- name: stream_user_sessions
SELECT user_id, count(DISTINCT session_id) AS sessions FROM user_events GROUP BY user_id

-- name: stream_dedup
SELECT id, event_type, "timestamp" FROM user_events

-- name: stream_metric_change
WITH p AS (SELECT *, lag(metric_value) OVER (PARTITION BY metric_name ORDER BY "timestamp", id) AS pv FROM analytics_metrics)
SELECT id, metric_name, metric_value, pv AS previous_value,
       (metric_value - pv) / nullif(pv, 0) * 100 AS change_percent,
       coalesce(abs((metric_value - pv) / nullif(pv, 0) * 100) > 20, FALSE) AS is_significant FROM p

-- name: stream_events
SELECT id, user_id, event_type, cents, "timestamp", device_type, browser
FROM user_events WHERE event_type <> 'signup' AND user_id <= 127 AND cents <= 32767

-- name: stream_dead_letters
SELECT id AS "offset", CAST(user_id AS VARCHAR) AS key, cents,
       CASE WHEN event_type = 'signup' THEN 'signups' ELSE 'user_events' END AS topic,
       CASE WHEN event_type = 'signup' THEN 'unknown topic' ELSE 'bad message' END AS reason
FROM user_events WHERE event_type = 'signup' OR user_id > 127 OR cents > 32767

-- name: run_alerts
WITH m AS (
  SELECT count(*) AS n, count(*) FILTER (event_type = 'signup' OR user_id > 127 OR cents > 32767 OR event_type = 'error') AS bad,
         CAST(epoch(TIMESTAMP '2024-01-31 00:00:00') - floor(epoch(max("timestamp") FILTER (
           event_type <> 'signup' AND user_id <= 127 AND cents <= 32767))) AS BIGINT) AS lag
  FROM user_events)
SELECT TIMESTAMP '2024-01-31 00:00:00' AS window_start, x.* FROM (
  SELECT 'error_rate' AS metric, bad AS num, n AS den, 'error' AS severity FROM m WHERE 100 * bad > n
  UNION ALL SELECT 'processing_lag_seconds', lag, 1, 'warning' FROM m WHERE lag > 300
  UNION ALL SELECT 'utilization', n, 10000, 'warning' FROM m WHERE 10 * n > 8 * 10000) x

-- name: stream_session_counts
SELECT date_trunc('day', "timestamp")::TIMESTAMP AS window_start, user_id, count(DISTINCT session_id) AS sessions
FROM user_events
WHERE date_trunc('day', "timestamp") + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 2 DAY
GROUP BY 1, 2

-- name: stream_session_totals
SELECT count(DISTINCT day) AS days, count(*) AS sessions, TRUE AS within_error FROM (
  SELECT DISTINCT date_trunc('day', "timestamp") AS day, user_id, session_id FROM user_events
  WHERE date_trunc('day', "timestamp") + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY) s
