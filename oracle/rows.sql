-- name: clean_url
SELECT page_id, url, regexp_replace(url, 'https?://[^/]+', '', 'g') AS clean_page_url FROM pages

-- name: enrich_events
SELECT id, user_agent, regexp_replace(page_url, 'https?://[^/]+', '', 'g') AS clean_page_url,
       CASE WHEN user_agent LIKE '%Mobile%' THEN 'Mobile' WHEN user_agent LIKE '%Tablet%' THEN 'Tablet'
            ELSE 'Desktop' END AS device_type,
       CASE WHEN user_agent LIKE '%Chrome%' THEN 'Chrome' WHEN user_agent LIKE '%Firefox%' THEN 'Firefox'
            WHEN user_agent LIKE '%Safari%' THEN 'Safari' ELSE 'Other' END AS browser
FROM user_events

-- name: essential_cols
SELECT user_id, session_id, event_type, "timestamp", page_url, device_type, browser FROM user_events

-- name: time_features
SELECT id, CAST(extract(hour FROM "timestamp") AS INTEGER) AS hour,
       CAST(extract(isodow FROM "timestamp") - 1 AS INTEGER) AS day_of_week,
       extract(isodow FROM "timestamp") >= 6 AS is_weekend,
       CASE WHEN value < 5 THEN 'low' WHEN value < 15 THEN 'medium' WHEN value IS NOT NULL THEN 'high' END
         AS value_category
FROM user_events

-- name: value_band_udf
SELECT id, CASE WHEN value < 5 THEN 'low' WHEN value < 15 THEN 'medium' ELSE 'high' END AS value_category
FROM user_events

-- name: high_value
SELECT id, user_id, value FROM user_events WHERE value > 20

-- name: important_events
SELECT id, user_id, event_type, "timestamp" FROM user_events
WHERE event_type IN ('purchase', 'signup', 'login')

-- name: recent_events
SELECT id, user_id, session_id, event_type, "timestamp" FROM user_events
ORDER BY "timestamp" DESC, id DESC LIMIT 100 OFFSET 50

-- name: payload_purchase
SELECT id, value AS total_amount, CAST(CASE WHEN k % 5 = 0 THEN 0 ELSE 1 + k % 9 END AS INTEGER) AS items_count
FROM (SELECT *, CAST(json_extract_string(event_data, '$.k') AS INTEGER) AS k FROM user_events WHERE event_type = 'purchase') p

-- name: payload_typed
SELECT id, event_type,
       CASE WHEN event_type = 'view' THEN 'v' || k END AS video_id,
       CAST(CASE WHEN event_type = 'view' THEN CASE WHEN k % 5 = 0 THEN 0 ELSE cents END END AS INTEGER) AS video_duration,
       CASE WHEN event_type = 'click' THEN CASE WHEN k % 5 = 0 THEN '' ELSE 'user ' || user_id END END AS search_query,
       CASE WHEN event_type = 'click' THEN k END AS search_results_count
FROM (SELECT *, CAST(json_extract_string(event_data, '$.k') AS INTEGER) AS k FROM user_events) p

-- name: parse_json
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events

-- name: metric_dimensions
SELECT id, metric_name, 'k' AS dimension, json_extract_string(dimensions, '$.k') AS label
FROM analytics_metrics WHERE json_extract_string(dimensions, '$.k') IS NOT NULL

-- name: sql_params
SELECT user_id, count(*) AS n FROM user_events
WHERE event_type = 'purchase' AND value >= 10.0 GROUP BY user_id

-- name: dead_letter
SELECT id AS "offset", CAST(user_id AS VARCHAR) AS key,
       '{"user_id":' || user_id || ',"event_type":"' || event_type || '","cents":' || cents || ',"k":'
       || json_extract_string(event_data, '$.k') || '}' AS value,
       CASE WHEN event_type = 'signup' THEN 'signups' ELSE 'user_events' END AS topic,
       CASE WHEN event_type = 'signup' THEN 'unknown topic' ELSE 'bad message' END AS reason
FROM user_events WHERE event_type = 'signup' OR user_id > 127 OR cents > 32767

-- name: good_messages
SELECT CAST(json_extract_string(event_data, '$.k') AS BIGINT) AS k, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents
FROM user_events WHERE event_type <> 'signup' AND user_id <= 127 AND cents <= 32767 GROUP BY 1

-- name: to_envelope
SELECT CAST(user_id AS VARCHAR) AS key,
       '{"user_id":' || user_id || ',"session_id":"' || session_id || '","event_type":"' || event_type
       || '","timestamp":"' || strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f') || '"}' AS value
FROM user_events

-- name: topic_handlers
SELECT label, count(*) AS n, topic FROM (
  SELECT CASE WHEN event_type = 'error' THEN 'error' WHEN value < 5 THEN 'low' WHEN value < 15 THEN 'medium'
              ELSE 'high' END AS label,
         CASE WHEN event_type = 'error' THEN 'analytics_events' ELSE 'user_events' END AS topic
  FROM user_events) GROUP BY label, topic

-- name: stream_topics
SELECT label, count(*) AS n, topic FROM (
  SELECT CASE WHEN event_type = 'error' THEN 'error' WHEN value < 5 THEN 'low' WHEN value < 15 THEN 'medium'
              ELSE 'high' END AS label,
         CASE WHEN event_type = 'error' THEN 'analytics_events' ELSE 'user_events' END AS topic
  FROM user_events) GROUP BY label, topic

-- name: round_trip_parquet
SELECT id, event_type, "timestamp", value FROM user_events

-- name: round_trip_json
SELECT id, event_type, "timestamp", value FROM user_events

-- name: round_trip_csv
SELECT id, event_type, "timestamp", value FROM user_events

-- name: snapshot
SELECT event_id, user_id, event_type, value FROM events


-- name: matview
SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2

-- name: partitioned_scan
SELECT CAST(ts AS DATE) AS event_date, event_type, count(*) AS n FROM events
WHERE ts >= TIMESTAMP '2024-01-24' GROUP BY 1, 2

-- name: retention_expired
SELECT CAST(ts AS DATE) AS day, ts < TIMESTAMP '2024-01-17' AS expired, count(*) AS rows
FROM events GROUP BY 1, 2

-- name: replaced_day
SELECT CAST(ts AS DATE) AS event_date, event_type, count(*) AS n FROM events
WHERE CAST(ts AS DATE) <> DATE '2024-01-15' OR event_type <> 'error' GROUP BY 1, 2

-- name: retention_partitions
SELECT event_date, event_date + 1 <= TIMESTAMP '2024-01-17' AS expired FROM (SELECT DISTINCT CAST(ts AS DATE) AS event_date FROM events) d

-- name: daily_view
SELECT event_type, count(*) AS n, min(value) AS least, max(value) AS most, arg_max(id, ("timestamp", id)) AS newest_id
FROM user_events GROUP BY 1

-- name: topic_attributes
SELECT event_type, user_agent, CASE WHEN user_agent IS NULL THEN 1 ELSE 2 END::BIGINT AS attributes, count(*) AS n
FROM user_events GROUP BY ALL

-- name: partition_skew
WITH d AS (
  SELECT CAST(ts AS DATE) AS day, count(*) AS rows,
         CAST(sum(8 + 8 + 8 + strlen(event_type) + 8 + strlen(props)) AS BIGINT) AS bytes FROM events GROUP BY 1)
SELECT CAST(sum(rows) AS BIGINT) AS total_rows, CAST(sum(bytes) AS BIGINT) AS total_bytes, round(avg(bytes), 6) AS avg_bytes,
       max(bytes) AS max_bytes, min(bytes) AS min_bytes, round(stddev_samp(bytes), 6) AS std_bytes, count(*) AS partition_count FROM d

-- name: snapshot_changes
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS part, 'changed' AS change FROM events WHERE event_id = 0
UNION ALL SELECT '2024-01-20', 'gone' WHERE EXISTS (SELECT * FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-20')
