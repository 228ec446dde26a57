user_events AS (
  SELECT e.event_id AS id, e.user_id,
         CAST(e.user_id AS VARCHAR) || '-' || CAST(CAST(e.ts AS DATE) AS VARCHAR) AS session_id,
         e.event_type, e.props AS event_data, e.ts AS "timestamp", e.value,
         CAST(round(e.value * 100) AS BIGINT) AS cents,
         CASE CAST(json_extract_string(e.props, '$.k') AS INTEGER) % 5
           WHEN 0 THEN 'Mozilla/5.0 (Linux; Android 10) Chrome/91.0 Mobile Safari/537.36'
           WHEN 1 THEN 'Mozilla/5.0 (Android 10; Tablet) Firefox/89.0'
           WHEN 2 THEN 'Mozilla/5.0 (Macintosh) Version/14.1 Safari/605.1'
           WHEN 3 THEN 'Opera/9.80 (Windows NT 6.1) Presto/2.12' END AS user_agent,
         CASE CAST(json_extract_string(e.props, '$.k') AS INTEGER) % 5
           WHEN 0 THEN 'Mobile' WHEN 1 THEN 'Tablet' ELSE 'Desktop' END AS device_type,
         CASE CAST(json_extract_string(e.props, '$.k') AS INTEGER) % 5
           WHEN 0 THEN 'Chrome' WHEN 1 THEN 'Firefox' WHEN 2 THEN 'Safari' ELSE 'Other' END AS browser,
         p.url AS page_url, n.n_name AS country, c.c_mktsegment AS category
  FROM events e
  LEFT JOIN pages p ON p.page_id = e.event_id % (SELECT count(*) FROM pages)
  LEFT JOIN customer c ON c.c_custkey = e.user_id
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
),
user_sessions AS (
  SELECT session_id, min(user_id) AS user_id, first(device_type ORDER BY "timestamp", id) AS device_type,
         min(country) AS country, min("timestamp") AS start_time, max("timestamp") AS end_time,
         CAST(floor(epoch(max("timestamp"))) - floor(epoch(min("timestamp"))) AS BIGINT) AS duration_seconds,
         count(*) AS page_views, count(DISTINCT page_url) AS unique_pages
  FROM user_events GROUP BY session_id
),
analytics_metrics AS (
  SELECT event_id AS id, event_type AS metric_name, value AS metric_value, props AS dimensions,
         ts AS "timestamp", CAST(round(value * 100) AS BIGINT) AS cents
  FROM events
)
