-- name: user_dim
SELECT DISTINCT user_id, country FROM user_events

-- name: user_dim_join
SELECT e.id, e.user_id, e.value, d.user_country, d.user_events
FROM user_events e LEFT JOIN (
  SELECT user_id, last(country ORDER BY "timestamp", id) AS user_country, count(*) AS user_events
  FROM user_events GROUP BY user_id) d ON d.user_id = e.user_id

-- name: user_metrics
SELECT user_id, CAST(sum(cents) AS DOUBLE) / 100 AS value_sum,
       CAST(sum(cents) AS DOUBLE) / count(*) / 100 AS value_mean,
       CASE WHEN count(*) > 1 THEN
         sqrt(CAST(count(*) * sum(cents * cents) - sum(cents) * sum(cents) AS DOUBLE)
              / (CAST(count(*) AS DOUBLE) * CAST(count(*) - 1 AS DOUBLE))) / 100 END AS value_std,
       count(value) AS value_count, count(DISTINCT event_type) AS event_type_nunique,
       count(DISTINCT session_id) AS session_id_nunique,
       min("timestamp") AS timestamp_min, max("timestamp") AS timestamp_max
FROM user_events GROUP BY user_id

-- name: session_analytics
WITH modes AS (
  SELECT session_id, category FROM (
    SELECT session_id, category,
           row_number() OVER (PARTITION BY session_id ORDER BY count(*) DESC, category) AS rn
    FROM user_events WHERE category IS NOT NULL GROUP BY session_id, category) WHERE rn = 1)
SELECT e.session_id, first(e.user_id ORDER BY e."timestamp", e.id) AS user_id_first,
       first(e.device_type ORDER BY e."timestamp", e.id) AS device_type_first,
       first(e.country ORDER BY e."timestamp", e.id) AS country_first,
       min(e."timestamp") AS timestamp_min, max(e."timestamp") AS timestamp_max,
       count(e."timestamp") AS events_per_session,
       CAST(sum(e.cents) AS DOUBLE) / 100 AS total_value,
       CAST(sum(e.cents) AS DOUBLE) / count(*) / 100 AS avg_value,
       count(DISTINCT e.event_type) AS unique_event_types,
       coalesce(min(m.category), 'Unknown') AS category_mode,
       (epoch_us(max(e."timestamp")) - epoch_us(min(e."timestamp"))) / 60000000.0::DOUBLE AS session_duration_minutes
FROM user_events e LEFT JOIN modes m ON m.session_id = e.session_id GROUP BY e.session_id

-- name: hourly_resample
WITH e AS (SELECT date_trunc('hour', "timestamp") AS hour, * FROM user_events),
hours AS (SELECT unnest(generate_series((SELECT min(hour) FROM e), (SELECT max(hour) FROM e), INTERVAL 1 HOUR)) AS hour),
agg AS (
  SELECT hour, CAST(sum(cents) AS DOUBLE) / 100 AS value_sum, CAST(sum(cents) AS DOUBLE) / count(*) / 100 AS value_mean,
         count(value) AS value_count, count(DISTINCT user_id) AS user_id_nunique,
         count(DISTINCT session_id) AS session_id_nunique FROM e GROUP BY hour),
modes AS (
  SELECT hour, event_type FROM (
    SELECT hour, event_type, row_number() OVER (PARTITION BY hour ORDER BY count(*) DESC, event_type) AS rn
    FROM e GROUP BY hour, event_type) WHERE rn = 1)
SELECT h.hour, coalesce(value_sum, 0.0::DOUBLE) AS value_sum, value_mean, coalesce(value_count, 0) AS value_count,
       coalesce(user_id_nunique, 0) AS user_id_nunique, coalesce(session_id_nunique, 0) AS session_id_nunique,
       coalesce(m.event_type, 'None') AS event_type_mode
FROM hours h LEFT JOIN agg ON agg.hour = h.hour LEFT JOIN modes m ON m.hour = h.hour

-- name: rolling_24h
WITH e AS (SELECT date_trunc('hour', "timestamp") AS hour, cents, user_id FROM user_events),
hours AS (SELECT unnest(generate_series((SELECT min(hour) FROM e), (SELECT max(hour) FROM e), INTERVAL 1 HOUR)) AS hour),
agg AS (SELECT hour, sum(cents) AS cents, count(DISTINCT user_id) AS users FROM e GROUP BY hour),
full_hours AS (SELECT h.hour, coalesce(cents, 0) AS cents, coalesce(users, 0) AS users
               FROM hours h LEFT JOIN agg ON agg.hour = h.hour)
SELECT hour, CAST(sum(cents) OVER w AS DOUBLE) / count(*) OVER w / 100 AS value_sum_rolling_24h,
       CAST(sum(users) OVER w AS DOUBLE) / count(*) OVER w AS user_id_nunique_rolling_24h
FROM full_hours WINDOW w AS (ORDER BY hour ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)

-- name: resample_sum
WITH e AS (SELECT date_trunc('hour', "timestamp") AS hour, cents FROM user_events),
hours AS (SELECT unnest(generate_series((SELECT min(hour) FROM e), (SELECT max(hour) FROM e), INTERVAL 1 HOUR)) AS hour)
SELECT h.hour, coalesce(CAST(sum(cents) AS DOUBLE) / 100, 0.0::DOUBLE) AS value_sum
FROM hours h LEFT JOIN e ON e.hour = h.hour GROUP BY h.hour

-- name: groupby_user
SELECT user_id, CAST(sum(cents) AS DOUBLE) / 100 AS value_sum FROM user_events GROUP BY user_id

-- name: groupby_session
SELECT session_id, CAST(sum(cents) AS DOUBLE) / count(*) / 100 AS value_mean FROM user_events GROUP BY session_id

-- name: daily_activity
SELECT user_id, CAST("timestamp" AS DATE) AS activity_date, count(*) AS daily_events,
       count(DISTINCT session_id) AS daily_sessions, count(DISTINCT event_type) AS event_types_used,
       min("timestamp") AS first_event, max("timestamp") AS last_event
FROM user_events WHERE "timestamp" >= TIMESTAMP '2024-01-31' - INTERVAL 30 DAY
GROUP BY user_id, CAST("timestamp" AS DATE)

-- name: user_activity
WITH d AS (
  SELECT user_id, CAST("timestamp" AS DATE) AS day, count(*) AS n, count(DISTINCT session_id) AS s
  FROM user_events WHERE "timestamp" >= TIMESTAMP '2024-01-31' - INTERVAL 30 DAY GROUP BY 1, 2)
SELECT user_id, CAST(sum(n) AS DOUBLE) / count(*) AS avg_daily_events,
       CAST(sum(s) AS DOUBLE) / count(*) AS avg_daily_sessions,
       CAST(sum(n) AS BIGINT) AS total_events_30d, count(DISTINCT day) AS active_days, max(n) AS peak_daily_events,
       CASE WHEN count(DISTINCT day) >= 20 THEN 'Highly Active' WHEN count(DISTINCT day) >= 10 THEN 'Moderately Active'
            WHEN count(DISTINCT day) >= 5 THEN 'Occasionally Active' ELSE 'Rarely Active' END AS activity_level
FROM d GROUP BY user_id ORDER BY total_events_30d DESC, user_id LIMIT 1000

-- name: event_statistics
SELECT count(*) AS total_events_processed, count(DISTINCT user_id) AS unique_users,
       count(DISTINCT (user_id, session_id)) AS total_sessions,
       CAST(count(*) AS DOUBLE) / count(DISTINCT user_id) AS average_events_per_user
FROM user_events

-- name: event_type_counts
SELECT event_type, count(*) AS n FROM user_events GROUP BY event_type

-- name: kpis
SELECT count(*) AS total_events, count(DISTINCT user_id) AS unique_users,
       count(DISTINCT session_id) AS unique_sessions,
       count(*) FILTER ("timestamp" >= TIMESTAMP '2024-01-30') AS events_last_24h,
       CAST(sum(cents) AS DOUBLE) / count(*) / 100 AS avg_value FROM user_events

-- name: kpis_between
SELECT count(*) AS total_events, count(DISTINCT user_id) AS unique_users,
       count(DISTINCT session_id) AS unique_sessions,
       count(*) FILTER ("timestamp" >= TIMESTAMP '2024-01-16') AS events_last_24h,
       CAST(sum(cents) AS DOUBLE) / count(*) / 100 AS avg_value FROM user_events
WHERE "timestamp" >= TIMESTAMP '2024-01-10' AND "timestamp" < TIMESTAMP '2024-01-17'

-- name: user_zscore
WITH u AS (
  SELECT user_id, CAST(sum(cents) AS DOUBLE) / count(*) / 100 AS mean,
         CASE WHEN count(*) > 1 THEN
           sqrt(CAST(count(*) * sum(cents * cents) - sum(cents) * sum(cents) AS DOUBLE)
                / (CAST(count(*) AS DOUBLE) * CAST(count(*) - 1 AS DOUBLE))) / 100 END AS std,
         count(*) AS count, (20000 * sum(cents) + count(*)) // (2 * count(*)) AS m
  FROM user_events GROUP BY user_id),
g AS (SELECT count(*) AS n, sum(m) AS s,
             sqrt(CAST(count(*) * sum(m * m) - sum(m) * sum(m) AS DOUBLE)
                  / (CAST(count(*) AS DOUBLE) * CAST(count(*) - 1 AS DOUBLE))) AS w FROM u)
SELECT user_id, mean, std, count, CAST(n * m - s AS DOUBLE) / (CAST(n AS DOUBLE) * w) AS z_score,
       abs(CAST(n * m - s AS DOUBLE) / (CAST(n AS DOUBLE) * w)) > 3 AS is_anomaly FROM u, g

-- name: top_event_types
SELECT event_type, count(*) AS n FROM user_events GROUP BY event_type ORDER BY n DESC, event_type LIMIT 5

-- name: country_distribution
SELECT country, count(*) AS n FROM user_events GROUP BY country ORDER BY n DESC, country LIMIT 10

-- name: device_distribution
SELECT device_type, count(*) AS n FROM user_events GROUP BY device_type

-- name: hour_of_day
SELECT CAST(extract(hour FROM "timestamp") AS INTEGER) AS hour, count(*) AS n FROM user_events GROUP BY 1

-- name: event_share
SELECT event_type, n, ((20000 * n + t) // (2 * t)) / 100.0::DOUBLE AS share_pct
FROM (SELECT event_type, count(*) AS n FROM user_events GROUP BY event_type), (SELECT count(*) AS t FROM events)

-- name: events_timeline
SELECT date_trunc('hour', "timestamp") AS hour, count(*) AS events FROM user_events GROUP BY 1

-- name: live_kpis
SELECT date_trunc('hour', "timestamp") AS window_start, count(*) AS events,
       CAST(count(*) AS DOUBLE) / 3600 AS events_per_second, count(DISTINCT session_id) AS active_sessions,
       ((20000 * count(*) FILTER (event_type = 'purchase') + count(*)) // (2 * count(*))) / 100.0::DOUBLE AS conversion_rate,
       ((20000 * count(*) FILTER (event_type = 'error') + count(*)) // (2 * count(*))) / 100.0::DOUBLE AS error_rate
FROM user_events GROUP BY 1

-- name: engagement_histogram
WITH u AS (SELECT user_id, count(*) AS n FROM user_events GROUP BY user_id),
g AS (SELECT min(n) AS lo, max(n) AS hi FROM u)
SELECT CAST(CASE WHEN hi > lo THEN least(((n - lo) * 20) // nullif(hi - lo, 0), 19) ELSE 0 END AS BIGINT) AS bin,
       count(*) AS users, min(n) AS min_events, max(n) AS max_events
FROM u, g GROUP BY 1

-- name: users_by_country
SELECT country, count(DISTINCT user_id) AS users FROM user_events GROUP BY country

-- name: apply_all
SELECT event_type AS label, count(*) AS n, 'by_type' AS result FROM user_events GROUP BY event_type
UNION ALL
SELECT CAST(extract(hour FROM "timestamp") AS VARCHAR) AS label, count(*) AS n, 'by_hour' AS result
FROM user_events GROUP BY 1

-- name: column_profile
SELECT 'user_id' AS column_name, count(*) AS rows, count(*) - count(user_id) AS nulls, count(DISTINCT user_id) AS distinct_values,
       min(CAST(user_id AS VARCHAR)) AS min_value, max(CAST(user_id AS VARCHAR)) AS max_value FROM user_events
UNION ALL
SELECT 'event_type', count(*), count(*) - count(event_type), count(DISTINCT event_type), min(event_type), max(event_type) FROM user_events
UNION ALL
SELECT 'value', count(*), count(*) - count(value), count(DISTINCT value), min(CAST(value AS VARCHAR)), max(CAST(value AS VARCHAR)) FROM user_events
UNION ALL
SELECT 'event_data', count(*), count(*) - count(event_data), count(DISTINCT event_data), min(event_data), max(event_data) FROM user_events

-- name: column_top_values
WITH long_form AS (
  SELECT 'user_id' AS column_name, CAST(user_id AS VARCHAR) AS value FROM user_events UNION ALL
  SELECT 'event_type', event_type FROM user_events UNION ALL
  SELECT 'value', CAST(value AS VARCHAR) FROM user_events UNION ALL
  SELECT 'event_data', event_data FROM user_events),
counted AS (SELECT column_name, value, count(*) AS n FROM long_form GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS position FROM counted)
SELECT column_name, value, n, CAST(position AS INTEGER) AS position,
       ((20000 * n + t) // (2 * t)) / 100.0::DOUBLE AS frequency_pct
FROM ranked, (SELECT count(*) AS t FROM events) WHERE position <= 10

-- name: order_correlation
SELECT 'user_id' AS column_name, round(corr(user_id, id), 6) AS correlation FROM user_events
UNION ALL SELECT 'value', round(corr(value, id), 6) FROM user_events

-- name: quality_scores
WITH g AS (SELECT count(*) AS n FROM user_events),
m AS (
  SELECT 'completeness' AS metric, count(*) FILTER (user_agent IS NOT NULL) AS num FROM user_events UNION ALL
  SELECT 'timeliness', count(*) FILTER ("timestamp" >= TIMESTAMP '2024-01-31' - INTERVAL 28 DAY) FROM user_events UNION ALL
  SELECT 'validity', count(*) FILTER (event_type IN ('click', 'purchase', 'signup', 'view')
                                      AND coalesce(length(user_agent) <= 60, TRUE)) FROM user_events UNION ALL
  SELECT 'accuracy', count(*) FILTER (user_id IN (SELECT c_custkey FROM customer)) FROM user_events UNION ALL
  SELECT 'consistency', count(DISTINCT id) FROM user_events),
s AS (SELECT metric, ((20000 * num + n) // (2 * n)) / 100.0::DOUBLE AS score FROM m, g)
SELECT metric, score, CASE WHEN score >= 96 THEN 'Excellent' WHEN score >= 90 THEN 'Good'
                           WHEN score >= 80 THEN 'Fair' ELSE 'Poor' END AS status FROM s
