"""Oracle SQL for each registered job, written for DuckDB.

Each statement is the plain, unoptimised definition of what the Spark job
computes, over the same parquet tables (views named as the tables). Column
names and types match the Spark output: counts BIGINT, sums exact in
DECIMAL and reported as DOUBLE, days DATE, times TIMESTAMP.
"""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {
    "district_entries_between": """
        SELECT n_nationkey, n_name, event_type, CAST(count(*) AS BIGINT) AS entries
        FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey
        WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00'
        GROUP BY n_nationkey, n_name, event_type
    """,
    "diary_quality_report": """
        SELECT 'null_person' AS rule, CAST(count(*) FILTER (WHERE user_id IS NULL) AS BIGINT) AS violations
        FROM events
        UNION ALL
        SELECT 'non_positive_value', CAST(count(*) FILTER (WHERE value <= 0) AS BIGINT) FROM events
        UNION ALL
        SELECT 'missing_attribute_k',
               CAST(count(*) FILTER (WHERE json_extract_string(props, '$.k') IS NULL) AS BIGINT)
        FROM events
        UNION ALL
        SELECT unnest(['null_time', 'null_id', 'not_finite_amount', 'out_of_range_amount', 'sub_cent_amount', 'unlisted_kind']),
               unnest([count(*) FILTER (WHERE ts IS NULL), count(*) FILTER (WHERE event_id IS NULL),
                       count(*) FILTER (WHERE NOT isfinite(value)),
                       count(*) FILTER (WHERE isfinite(value) AND abs(value) >= 1e12),
                       count(*) FILTER (WHERE isfinite(value) AND abs(value) < 1e12
                                          AND CAST(TRY_CAST(value AS DECIMAL(14,2)) AS DOUBLE) <> value),
                       count(*) FILTER (WHERE event_type IS NULL
                                          OR event_type NOT IN ('click', 'error', 'purchase', 'signup', 'view'))])
        FROM events
        UNION ALL
        SELECT 'unknown_person', CAST(count(*) AS BIGINT) FROM events e
        WHERE e.user_id IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = e.user_id)
    """,
    "diary_day_export": """
        SELECT event_id, ts, user_id, event_type, value, props, CAST(ts AS DATE) AS day FROM events
    """,
    "diary_entries_between": """
        SELECT * FROM events
        WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00'
    """,
    "attribute_counts": """
        SELECT TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(count(*) AS BIGINT) AS entries
        FROM events GROUP BY 1
    """,
    "diary_enriched": """
        SELECT event_id, ts, user_id, event_type, value, c_name, n_nationkey, n_name, r_regionkey, r_name
        FROM events JOIN customer ON user_id = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    """,
    "persons_with_entries": """
        SELECT c_custkey, c_name, c_nationkey FROM customer
        WHERE EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)
    """,
    "persons_without_entries": """
        SELECT c_custkey, c_name, c_nationkey FROM customer
        WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)
    """,
    "visits_without_services": """
        SELECT o_orderkey, o_custkey, o_orderdate FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
    """,
    "person_day_services": """
        SELECT user_id, CAST(ts AS DATE) AS day, event_type, CAST(count(*) AS BIGINT) AS entries,
               CAST(sum(TRY_CAST(value AS DECIMAL(14,2))) AS DOUBLE) AS total_value
        FROM events GROUP BY 1, 2, 3
    """,
    "worker_month_load": """
        SELECT l_suppkey, CAST(year(o_orderdate) AS BIGINT) AS year, CAST(month(o_orderdate) AS BIGINT) AS month,
               CAST(count(DISTINCT o_orderkey) AS BIGINT) AS visits,
               CAST(count(DISTINCT o_custkey) AS BIGINT) AS persons,
               CAST(sum(TRY_CAST(l_quantity AS DECIMAL(14,2))) AS DOUBLE) AS quantity
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        GROUP BY 1, 2, 3
    """,
    "district_rollup": """
        SELECT r_name, n_name, CAST(count(*) AS BIGINT) AS entries,
               CAST(GROUPING(r_name, n_name) AS BIGINT) AS grouping_level
        FROM events JOIN customer ON user_id = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        GROUP BY ROLLUP (r_name, n_name)
    """,
    "district_by_kind": """
        SELECT n_nationkey, n_name,
               CAST(count(*) FILTER (WHERE e.event_type = 'click') AS BIGINT) AS click,
               CAST(count(*) FILTER (WHERE e.event_type = 'error') AS BIGINT) AS error,
               CAST(count(*) FILTER (WHERE e.event_type = 'purchase') AS BIGINT) AS purchase,
               CAST(count(*) FILTER (WHERE e.event_type = 'signup') AS BIGINT) AS signup,
               CAST(count(*) FILTER (WHERE e.event_type = 'view') AS BIGINT) AS view,
               CAST(count(*) FILTER (WHERE e.user_id IS NOT NULL AND (e.event_type IS NULL OR e.event_type NOT IN
                    ('click', 'error', 'purchase', 'signup', 'view'))) AS BIGINT) AS other
        FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey
        LEFT JOIN events e ON e.user_id = c_custkey
        GROUP BY n_nationkey, n_name
    """,
    "same_day_visits": """
        SELECT o_custkey, CAST(o_orderdate AS DATE) AS visit_day, CAST(count(*) AS BIGINT) AS visits
        FROM orders GROUP BY 1, 2 HAVING count(*) > 1
    """,
    "latest_entry": """
        SELECT user_id, ts, event_id, event_type, value, props FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
    """,
    "visit_gaps": """
        SELECT o_custkey, o_orderkey, o_orderdate,
               lag(o_orderkey) OVER w AS prev_orderkey,
               lag(o_orderdate) OVER w AS prev_orderdate,
               CAST(date_diff('day', CAST(lag(o_orderdate) OVER w AS DATE), CAST(o_orderdate AS DATE)) AS BIGINT)
                   AS days_since_prev
        FROM orders
        WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
    """,
    "running_and_trailing_load": """
        SELECT event_id, user_id, ts,
               CAST(sum(TRY_CAST(value AS DECIMAL(14,2))) OVER (
                   PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id NULLS FIRST
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_value,
               CAST(count(*) OVER (
                   PARTITION BY user_id ORDER BY ts NULLS FIRST
                   RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW) AS BIGINT) AS trailing_entries
        FROM events
    """,
    "top_workers_by_district": """
        WITH v AS (SELECT l_suppkey, count(DISTINCT l_orderkey) AS visits FROM lineitem GROUP BY l_suppkey),
        r AS (SELECT s_nationkey, s_suppkey, visits,
                     row_number() OVER (PARTITION BY s_nationkey ORDER BY visits DESC, s_suppkey) AS rn
              FROM v JOIN supplier ON l_suppkey = s_suppkey)
        SELECT s_nationkey, s_suppkey, CAST(visits AS BIGINT) AS visits, CAST(rn AS BIGINT) AS rank_in_district
        FROM r WHERE rn <= 3
    """,
    "care_episodes": """
        WITH g AS (
            SELECT user_id, ts,
                   CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL
                          OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > INTERVAL 2 HOURS
                        THEN 1 ELSE 0 END AS brk
            FROM events WHERE ts IS NOT NULL),
        s AS (
            SELECT user_id, ts,
                   sum(brk) OVER (PARTITION BY user_id ORDER BY ts
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ep
            FROM g)
        SELECT user_id, min(ts) AS episode_start, max(ts) + INTERVAL 2 HOURS AS episode_end,
               CAST(count(*) AS BIGINT) AS entries
        FROM s GROUP BY user_id, ep
    """,
    "days_without_entry": """
        SELECT p.user_id, CAST(d.day AS DATE) AS day
        FROM (SELECT DISTINCT user_id FROM events WHERE user_id IS NOT NULL) p
        CROSS JOIN (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY)) AS day) d
        WHERE NOT EXISTS (SELECT 1 FROM events e
                          WHERE e.user_id = p.user_id AND CAST(e.ts AS DATE) = CAST(d.day AS DATE))
    """,
    "weekly_sliding_tally": """
        SELECT CAST(CAST(ts AS DATE) - CAST(i.range AS INTEGER) AS DATE) AS window_start,
               CAST(CAST(ts AS DATE) - CAST(i.range AS INTEGER) + 7 AS DATE) AS window_end,
               event_type, CAST(count(*) AS BIGINT) AS entries
        FROM events CROSS JOIN range(7) i WHERE ts IS NOT NULL
        GROUP BY 1, 2, 3
    """,
    "lapsed_persons": """
        SELECT user_id FROM events WHERE ts < TIMESTAMP '2024-01-02 00:00:00' AND user_id IS NOT NULL
        EXCEPT
        SELECT user_id FROM events WHERE ts >= TIMESTAMP '2024-01-30 00:00:00' AND user_id IS NOT NULL
    """,
    "retained_persons": """
        SELECT user_id FROM events WHERE ts < TIMESTAMP '2024-01-02 00:00:00' AND user_id IS NOT NULL
        INTERSECT
        SELECT user_id FROM events WHERE ts >= TIMESTAMP '2024-01-30 00:00:00' AND user_id IS NOT NULL
    """,
    "entries_with_last_signup": """
        SELECT e.event_id, e.ts, e.user_id, e.event_type, s.event_id AS signup_id, s.ts AS signup_ts
        FROM events e LEFT JOIN events s ON s.user_id = e.user_id AND s.event_type = 'signup' AND s.ts < e.ts
        QUALIFY row_number() OVER (PARTITION BY e.event_id ORDER BY s.ts DESC NULLS LAST, s.event_id DESC) = 1
    """,
    "concurrent_care": """
        WITH g AS (
            SELECT user_id, ts,
                   CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL 2 HOURS THEN 1 ELSE 0 END AS brk
            FROM events WHERE ts IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
        s AS (SELECT user_id, ts, sum(brk) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS ep FROM g),
        ep AS (
            SELECT c_nationkey AS d, min(ts) AS a, max(ts) + INTERVAL 2 HOURS AS z
            FROM s JOIN customer ON user_id = c_custkey GROUP BY user_id, c_nationkey, ep),
        times AS (SELECT d, a AS tm FROM ep UNION SELECT d, z FROM ep),
        opened AS (SELECT d, tm, (SELECT count(*) FROM ep WHERE ep.d = times.d AND a <= tm AND tm < z) AS n FROM times),
        peak AS (SELECT d, n, min(tm) AS since FROM opened o WHERE n = (SELECT max(n) FROM opened p WHERE p.d = o.d) GROUP BY d, n)
        SELECT n_nationkey, n_name, CAST(n AS BIGINT) AS open_episodes, since AS peak_start,
               (SELECT min(tm) FROM opened o WHERE o.d = peak.d AND o.tm > since AND o.n < peak.n) AS peak_end
        FROM peak JOIN nation ON d = n_nationkey
    """,
    "neighbour_visits": """
        SELECT o_orderkey, c_nationkey, o_orderdate,
               CASE WHEN o_orderdate IS NOT NULL THEN CAST(count(*) OVER (
                   PARTITION BY c_nationkey ORDER BY o_orderdate
                   RANGE BETWEEN INTERVAL 3 DAYS PRECEDING AND INTERVAL 3 DAYS FOLLOWING) - 1 AS BIGINT) END AS neighbours
        FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE c_nationkey IS NOT NULL
    """,
    # Streams: drained once with availableNow; append mode emits only what the
    # final watermark (latest ts - 1 hour) has closed.
    "daily_tally_stream": """
        SELECT CAST(ts AS DATE) AS day, event_type, CAST(count(*) AS BIGINT) AS entries
        FROM events
        WHERE CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)
        GROUP BY 1, 2
    """,
    "dedup_entries_stream": """
        SELECT event_id, ts, user_id, event_type, value, props FROM events
        QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ts) = 1 OR event_id IS NULL
    """,
    "enrich_stream": """
        SELECT event_id, ts, user_id, event_type, value, c_name, n_nationkey, n_name, r_regionkey, r_name
        FROM events JOIN customer ON user_id = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    """,
    "episodes_stream": """
        WITH g AS (
            SELECT user_id, ts,
                   CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL
                          OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > INTERVAL 2 HOURS
                        THEN 1 ELSE 0 END AS brk
            FROM events WHERE ts IS NOT NULL),
        s AS (
            SELECT user_id, ts,
                   sum(brk) OVER (PARTITION BY user_id ORDER BY ts
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ep
            FROM g),
        ep AS (
            SELECT user_id, min(ts) AS episode_start, max(ts) + INTERVAL 2 HOURS AS episode_end,
                   CAST(count(*) AS BIGINT) AS entries
            FROM s GROUP BY user_id, ep)
        SELECT * FROM ep WHERE episode_end <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)
    """,
    # An error comes out once both watermarks (the lesser counts) are 2 h past it.
    "errors_resolved_stream": """
        SELECT e.event_id, e.user_id, e.ts, p.event_id AS resolution_id, p.ts AS resolution_ts
        FROM events e LEFT JOIN events p ON p.user_id = e.user_id AND p.event_type = 'purchase'
             AND p.ts >= e.ts AND p.ts <= e.ts + INTERVAL 2 HOURS
        WHERE e.event_type = 'error' AND e.ts <= (
            SELECT least(max(ts) FILTER (WHERE event_type = 'error'), max(ts) FILTER (WHERE event_type = 'purchase')) - INTERVAL 3 HOURS FROM events)
        QUALIFY row_number() OVER (PARTITION BY e.event_id ORDER BY p.ts NULLS LAST, p.event_id) = 1
    """,
    "silent_person_stream": """
        WITH n AS (SELECT user_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS next_ts
                   FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL)
        SELECT user_id, ts AS silent_since, ts + INTERVAL 3 DAYS AS alert_at FROM n
        WHERE (next_ts IS NULL OR next_ts >= ts + INTERVAL 3 DAYS) AND ts + INTERVAL 3 DAYS <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)
    """,
    # Sketches: the exact figure, and that the estimate is within the stated error.
    "period_persons_sketch": """
        SELECT n_nationkey, n_name, CAST(count(DISTINCT user_id) AS BIGINT) AS persons, true AS estimate_is_near
        FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey
        WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00'
        GROUP BY n_nationkey, n_name
    """,
    "amount_quantiles_sketch": """
        SELECT event_type, CAST(q.q AS DOUBLE) AS quantile, CAST(count(*) AS BIGINT) AS amounts, true AS rank_is_near
        FROM events, (SELECT unnest([0.05, 0.25, 0.5, 0.75, 0.95]) AS q) q
        WHERE isfinite(value) AND ts IS NOT NULL GROUP BY event_type, q.q
    """,
    "attribute_profile": """
        WITH e AS (SELECT props, CASE WHEN json_valid(props) THEN CAST(props AS JSON) END AS j FROM events),
        p AS (SELECT CASE WHEN props IS NULL THEN 'missing' WHEN j IS NULL THEN 'malformed'
                          WHEN json_type(j) = 'OBJECT' THEN 'attribute' ELSE 'not_object' END AS part, j FROM e),
        k AS (SELECT j, unnest(json_keys(j)) AS attribute FROM p WHERE part = 'attribute'),
        v AS (SELECT attribute, json_extract(j, '$."' || attribute || '"') AS val FROM k),
        t AS (SELECT attribute, CAST(val AS VARCHAR) AS val,
                     CASE json_type(val) WHEN 'VARCHAR' THEN 'string' WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array'
                          WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' ELSE 'number' END AS type FROM v)
        SELECT 'attribute' AS part, attribute, CAST(count(*) AS BIGINT) AS entries, CAST(count(DISTINCT val) AS BIGINT) AS distinct_values,
               string_agg(DISTINCT type, ',' ORDER BY type) AS types
        FROM t GROUP BY attribute
        UNION ALL
        SELECT f, NULL, (SELECT count(*) FROM p WHERE part = f), 0, ''
        FROM (SELECT unnest(['malformed', 'missing', 'not_object']) AS f)
    """,
    "worker_rota": """
        WITH s AS (SELECT l_suppkey, date_trunc('month', min(o_orderdate))::DATE AS a, last_day(max(o_orderdate)) AS z
                   FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_suppkey IS NOT NULL GROUP BY l_suppkey),
        d AS (SELECT l_suppkey, unnest(generate_series(a, z, INTERVAL 1 DAY))::DATE AS day FROM s)
        SELECT l_suppkey, day FROM d WHERE isodow(day) <= 5
    """,
}
