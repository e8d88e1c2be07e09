"""The same results as plain SQL over the driver's tables (columns named as in the catalog)."""

from __future__ import annotations

SQL: dict[str, str] = {}

# -- shared table expressions (SQL twins of lakequeries.adapter) ---------------------------------

EV = """
src AS (
  SELECT event_id, ts, user_id, event_type AS t, CAST(props->>'$.k' AS BIGINT) AS k FROM events
), ev AS (
  SELECT event_id,
    CASE t WHEN 'click' THEN 'PushEvent' WHEN 'view' THEN 'WatchEvent' WHEN 'error' THEN 'IssuesEvent'
           ELSE 'PullRequestEvent' END AS event_type,
    ts AS created_at, user_id AS actor_id,
    ' User' || user_id || '-' || ((day(ts) - 1) // 10) || ' ' AS actor_login,
    k AS repo_id,
    chr(160) || ' Org' || (k % 7) || '/Repo' || k || '-' || CASE WHEN k % 2 = 1 THEN (day(ts) - 1) // 10 ELSE 0 END || ' ' AS repo_name,
    k % 7 AS org_id,
    CASE t WHEN 'signup' THEN 'opened' WHEN 'purchase' THEN 'merged' END AS action,
    CASE WHEN t IN ('signup', 'purchase') THEN CAST(user_id AS INTEGER) END AS pr_number,
    CASE WHEN t = 'error' THEN CAST(user_id AS INTEGER) END AS issue_number,
    CAST(date_trunc('hour', ts) AS TIMESTAMP) + INTERVAL 2 HOUR AS ingested_at,
    strftime(ts, '%Y-%m-%d-') || hour(ts) || '.json.gz' AS source_file
  FROM src
)"""

BRONZE = EV + """, bronze AS (
  SELECT * FROM ev UNION ALL
  SELECT * REPLACE (ingested_at + INTERVAL 1 DAY AS ingested_at, 'Fixed' || actor_id AS actor_login)
  FROM ev WHERE event_type = 'IssuesEvent'
)"""

LATEST = BRONZE + """, latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ingested_at DESC) AS rn FROM bronze
  ) WHERE rn = 1
)"""


def silver(source: str, name: str = "stg") -> str:
    return f""", {name} AS (
  SELECT * REPLACE (trim(actor_login) AS actor_login, trim(lower(repo_name)) AS repo_name),
    split_part(trim(lower(repo_name)), '/', 1) AS repo_owner,
    split_part(trim(lower(repo_name)), '/', 2) AS repo_short_name,
    CAST(created_at AS DATE) AS event_date,
    CAST(extract(hour FROM created_at) AS BIGINT) AS event_hour
  FROM {source}
)"""


REPOS = """, repos AS (
  SELECT repo_id, repo_name, repo_owner, repo_short_name, event_date FROM (
    SELECT *, row_number() OVER (PARTITION BY repo_id, event_date ORDER BY created_at DESC, event_id DESC) AS rn
    FROM stg WHERE repo_id IS NOT NULL
  ) WHERE rn = 1
)"""

DIM_REPO = """, seen AS (
  SELECT *, lag(repo_name) OVER w AS prev_name, lag(repo_owner) OVER w AS prev_owner,
    row_number() OVER w AS rn
  FROM stg WHERE repo_id IS NOT NULL WINDOW w AS (PARTITION BY repo_id ORDER BY created_at, event_id)
), dim_repo AS (
  SELECT md5(CAST(repo_id AS VARCHAR) || '-' || CAST(created_at AS VARCHAR)) AS repo_key,
    repo_id, repo_name, repo_owner, repo_short_name, created_at AS valid_from,
    lead(created_at) OVER (PARTITION BY repo_id ORDER BY created_at) AS valid_to,
    lead(created_at) OVER (PARTITION BY repo_id ORDER BY created_at) IS NULL AS is_current
  FROM seen
  WHERE rn = 1 OR repo_name IS DISTINCT FROM prev_name OR repo_owner IS DISTINCT FROM prev_owner
)"""

DIM_DATE = """, dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date_day,
    CAST(dayofweek(d) AS BIGINT) AS day_of_week, dayofweek(d) IN (0, 6) AS is_weekend,
    CAST(weekofyear(d) AS BIGINT) AS iso_week, CAST(month(d) AS BIGINT) AS month,
    CAST(quarter(d) AS BIGINT) AS quarter, CAST(year(d) AS BIGINT) AS year
  FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '2015-01-01', TIMESTAMP '2030-12-31', INTERVAL 1 DAY)) AS TIMESTAMP) AS d)
)"""

# The event-type lookup.
TYPES = """, event_types(event_type, description, category) AS (VALUES
  ('PushEvent', 'Commits were pushed to a repository branch', 'code'),
  ('PullRequestEvent', 'A pull request was opened closed merged or otherwise updated', 'code'),
  ('IssuesEvent', 'An issue was opened closed or otherwise updated', 'collaboration'),
  ('IssueCommentEvent', 'A comment was added to an issue or pull request', 'collaboration'),
  ('WatchEvent', 'A user starred a repository', 'social'),
  ('ForkEvent', 'A repository was forked', 'social')
)"""


def pairs(source: str) -> str:
    return f""", opened AS (
  SELECT repo_id, pr_number, min(created_at) AS opened_at FROM {source}
  WHERE event_type = 'PullRequestEvent' AND action = 'opened' AND pr_number IS NOT NULL GROUP BY ALL
), pairs AS (
  SELECT m.event_id AS merge_event_id, m.repo_id, m.pr_number, o.opened_at, m.created_at AS merged_at,
    date_diff('second', o.opened_at, m.created_at) / 3600.0 AS hours_to_merge
  FROM {source} m JOIN opened o ON m.repo_id = o.repo_id AND m.pr_number = o.pr_number
  WHERE m.event_type = 'PullRequestEvent' AND m.action = 'merged'
)"""


FACT = (
    LATEST
    + silver("latest")
    + DIM_REPO
    + pairs("stg")
    + """, fact AS (
  SELECT e.event_id, e.event_type, e.created_at, e.ingested_at, r.repo_key,
    md5(CAST(e.actor_id AS VARCHAR)) AS actor_key,
    CAST(strftime(e.created_at, '%Y%m%d') AS INTEGER) AS date_key,
    md5(e.event_type) AS event_type_key,
    e.repo_id, e.actor_id, e.action, e.pr_number, e.issue_number,
    coalesce(e.event_type = 'PullRequestEvent' AND e.action = 'merged', false) AS is_pr_merged,
    CAST(p.hours_to_merge AS DOUBLE) AS hours_to_merge
  FROM stg e
  LEFT JOIN dim_repo r ON e.repo_id = r.repo_id AND e.created_at >= r.valid_from
    AND e.created_at < coalesce(r.valid_to, TIMESTAMP '9999-12-31')
  LEFT JOIN pairs p ON e.event_id = p.merge_event_id
)"""
)


def activity(source: str) -> str:
    return f""", activity AS (
  SELECT f.repo_id, d.date_key, d.date_day, t.category, count(*) AS event_count,
    count(DISTINCT f.actor_id) AS distinct_contributors,
    count(*) FILTER (WHERE f.event_type = 'PushEvent') AS push_event_count
  FROM {source} f
  JOIN dim_date d ON CAST(strftime(f.created_at, '%Y%m%d') AS INTEGER) = d.date_key
  JOIN event_types t ON f.event_type = t.event_type
  WHERE f.repo_id IS NOT NULL GROUP BY ALL
)"""


VOLUME = """, volume AS (
  SELECT CAST(strftime(created_at, '%Y%m%d') AS INTEGER) AS date_key,
    CAST(extract(hour FROM created_at) AS BIGINT) AS event_hour, count(*) AS event_count
  FROM ev GROUP BY ALL
)"""

NAMED = EV + silver("ev") + DIM_REPO + DIM_DATE + TYPES + activity("ev") + """, named AS (
  SELECT a.repo_id, a.date_key, a.category, a.event_count, a.distinct_contributors, a.date_day,
    d.is_weekend, r.repo_name
  FROM activity a JOIN dim_date d ON a.date_key = d.date_key
  LEFT JOIN dim_repo r ON a.repo_id = r.repo_id AND r.is_current
)"""

LIFECYCLE = EV + pairs("ev") + """, lifecycle AS (
  SELECT repo_id, pr_number, merged_at - hours_to_merge * INTERVAL '1 hour' AS opened_at, merged_at,
    hours_to_merge,
    quantile_cont(hours_to_merge, 0.5) OVER (PARTITION BY repo_id) AS repo_p50_hours_to_merge,
    quantile_cont(hours_to_merge, 0.95) OVER (PARTITION BY repo_id) AS repo_p95_hours_to_merge
  FROM pairs
)"""

RUNS = """
runs AS (
  SELECT CAST(event_id AS VARCHAR) AS run_id, ts AS started_at, ts + value * INTERVAL '1 second' AS finished_at,
    value AS duration_s, CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
    CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour_processed, event_id + 10 AS rows_read,
    CASE WHEN event_type = 'error' THEN 0 ELSE event_id END AS rows_written, CAST(10 AS BIGINT) AS malformed_rows,
    user_id * 100 AS bytes_written, CASE WHEN event_type = 'error' THEN props END AS error_message
  FROM events
)"""

VERSIONS = """
obs AS (
  SELECT user_id, event_type, ts, event_id, lag(event_type) OVER w AS prev, row_number() OVER w AS rn
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
), versions AS (
  SELECT user_id, event_type, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to
  FROM obs WHERE rn = 1 OR event_type IS DISTINCT FROM prev
)"""

STG_COLUMNS = (
    "event_id, event_type, created_at, actor_id, actor_login, repo_id, repo_name, repo_owner, repo_short_name, "
    "org_id, action, pr_number, issue_number, event_date, event_hour, ingested_at, source_file"
)
KEPT = "event_type IN ('PullRequestEvent', 'PushEvent')"
HOURS = """
hours AS (
  SELECT CAST(unnest(generate_series(CAST(date_trunc('hour', min(ts)) AS TIMESTAMP), CAST(date_trunc('hour', max(ts)) AS TIMESTAMP), INTERVAL 1 HOUR)) AS TIMESTAMP) AS hour
  FROM events
)"""


def _q(name: str, sql: str, ctes: str = "") -> None:
    SQL[name] = f"WITH {ctes.lstrip(', ')} {sql}" if ctes else sql


# -- sources and sinks --------------------------------------------------------------------------

_q("s01_hourly_ndjson_scan", """
SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour,
  CAST(sum(CASE WHEN event_type = 'signup' THEN 2 ELSE 1 END) AS BIGINT) AS lines FROM events GROUP BY 1""")
_q("s02_bronze_partition_sink", """
SELECT CAST(ts AS DATE) AS event_date, strftime(ts, '%H') AS hour, count(*) AS n,
  CAST(sum(event_id) AS BIGINT) AS ids, count(DISTINCT user_id) AS actors FROM events GROUP BY 1, 2""")
_q("s03_bronze_scan", """
SELECT *, CAST(created_at AS DATE) AS event_date, strftime(created_at, '%H') AS hour FROM ev""", EV)
_q("s04_seed_lookup", """
SELECT t.event_type, t.description, t.category, count(e.event_id) AS n
FROM event_types t LEFT JOIN ev e ON e.event_type = t.event_type GROUP BY ALL""", EV + TYPES)
_q("s05_table_publish", "SELECT * FROM volume", EV + VOLUME)
_q("s06_run_log_append", "SELECT * FROM runs", RUNS)
_q("s07_read_or_empty", "SELECT event_type, count(*) AS n FROM ev GROUP BY 1", EV)
_q("s08_partition_listing", """
SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour, true AS has_files, true AS has_bytes
FROM events GROUP BY 1""")

# -- ingest -------------------------------------------------------------------------------------

_q("i01_blank_lines", """
SELECT CAST(sum(CASE WHEN event_type = 'signup' THEN 2 ELSE 1 END) AS BIGINT) AS lines, count(*) AS rows_read FROM events""")
_q("i02_malformed_lines", """
SELECT source_file, count(*) AS malformed_rows FROM ev WHERE event_type = 'IssuesEvent' GROUP BY 1""", EV)
_q("i03_type_filter", """
SELECT event_type, CASE WHEN event_type = 'WatchEvent' THEN 'filtered' ELSE 'kept' END AS outcome, count(*) AS n
FROM ev WHERE event_type != 'IssuesEvent' GROUP BY 1""", EV)
_q("i07_lineage", f"""
SELECT source_file, TIMESTAMP '2024-02-01' AS ingested_at, count(*) AS n FROM ev WHERE {KEPT} GROUP BY 1""", EV)
_q("i10_force_reingest", f"""
, present AS (SELECT DISTINCT hour FROM hours WHERE hour IN (SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) FROM events)),
s AS (
  SELECT 'success' AS status, count(*) FILTER (WHERE {KEPT}) AS rows_kept FROM ev
  UNION ALL SELECT 'failed', 0 WHERE (SELECT count(*) FROM hours) > (SELECT count(*) FROM present)
)
SELECT status, rows_kept, (SELECT count(*) FROM ev WHERE {KEPT}) AS stored, TIMESTAMP '2024-01-31' AS stamp FROM s""",
   HOURS + "," + EV)
_q("i04_flatten", f"""
SELECT * REPLACE (TIMESTAMP '2024-02-01' AS ingested_at) FROM ev WHERE {KEPT}""", EV)
_q("i05_quarantine", """
SELECT source_file, CAST(
    length('{"id":"' || event_id || '","type":"IssuesEvent","created_at":"2024-01-01T00:00:00.000000Z","actor":{"id":'
    || actor_id || ',"login":"' || actor_login || '"},"repo":{"id":' || repo_id || ',"name":"' || repo_name
    || '"},"org":{"id":' || org_id || '},"payload":{"issue":{"number":' || issue_number || '}}')
    + CASE event_id % 4 WHEN 1 THEN 3 WHEN 2 THEN 5 WHEN 3 THEN 11 ELSE 0 END AS BIGINT) AS raw_length
FROM ev WHERE event_type = 'IssuesEvent'""", EV)
_q("i06_timestamp_normalisation", "SELECT o_orderkey, o_orderdate AS placed_at FROM orders")
_q("i08_line_counters", f"""
SELECT source_file, count(*) AS rows_read, count(*) FILTER (WHERE {KEPT}) AS rows_kept,
  count(*) FILTER (WHERE event_type = 'WatchEvent') AS filtered_rows,
  count(*) FILTER (WHERE event_type = 'IssuesEvent') AS malformed_rows, CAST(0 AS BIGINT) AS nulled_fields
FROM ev GROUP BY 1""", EV)
_q("i11_hour_range", "SELECT hour FROM hours", HOURS)
_q("i12_backfill", f"""
SELECT * EXCLUDE (source_file) REPLACE (TIMESTAMP '2024-02-01' AS ingested_at),
  CAST(created_at AS DATE) AS event_date, strftime(created_at, '%H') AS hour
FROM ev WHERE {KEPT}""", EV)
_q("i09_idempotent_skip", """
SELECT CASE WHEN e.hour IS NULL THEN 'failed' ELSE 'skipped' END AS status, count(*) AS hours FROM hours
LEFT JOIN (SELECT DISTINCT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour FROM events) e USING (hour) GROUP BY 1""", HOURS)
_q("i14_unreadable_files", """
, e AS (SELECT DISTINCT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour FROM events)
SELECT * FROM (
  SELECT 'success' AS status, '' AS error, count(*) AS hours FROM e
  UNION ALL SELECT 'failed', 'source file not found', (SELECT count(*) FROM hours WHERE hour NOT IN (SELECT hour FROM e)) + 1
  UNION ALL SELECT 'failed', 'corrupt gzip', 1 UNION ALL SELECT 'failed', 'truncated gzip', 1)""", HOURS)
_q("i13_missing_hours", """
SELECT hour FROM hours WHERE hour NOT IN (
  SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) FROM events WHERE event_type = 'purchase')""", HOURS)
_q("i15_run_log_rows", """
SELECT md5('batch-' || CAST(hour_processed AS VARCHAR)) AS run_id, TIMESTAMP '2024-02-01' AS started_at,
  TIMESTAMP '2024-02-01 00:00:30' AS finished_at, CAST(30 AS DOUBLE) AS duration_s, status, hour_processed,
  rows_read, rows_written, malformed_rows, error_message FROM runs""", RUNS)
_q("i16_backfill_summary", """
, present AS (SELECT DISTINCT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour FROM events),
marked AS (
  SELECT CASE WHEN hour NOT IN (SELECT hour FROM present) THEN 'failed'
              WHEN hour < TIMESTAMP '2024-01-16' THEN 'skipped' ELSE 'success' END AS status FROM hours
  UNION ALL SELECT unnest(['failed', 'failed', 'failed', 'failed', 'failed'])
)
SELECT status, count(*) AS hours FROM marked GROUP BY 1""", HOURS)

# -- silver -------------------------------------------------------------------------------------

_q("v01_dedupe_latest", "SELECT * FROM latest", LATEST)
_q("v01_latest_shipment", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC,
    l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS rn FROM lineitem) WHERE rn = 1""")
_q("v02_conform_names", """
SELECT p_partkey, trim(lower('  ' || p_brand || '/' || p_name || '  ')) AS name FROM part""")
_q("v03_split_name", """
SELECT p_partkey, split_part(raw, '/', 1) AS owner, split_part(raw, '/', 2) AS short_name FROM (
  SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN p_brand || '/' || p_name || '/' || p_type
    WHEN 'SMALL' THEN p_name END AS raw FROM part)""")
_q("v04_date_hour", """
SELECT event_id, CAST(ts AS DATE) AS event_date, CAST(extract(hour FROM ts) AS BIGINT) AS event_hour FROM events""")
_q("v05_daily_latest", "SELECT * FROM repos", EV + silver("ev") + REPOS)
_q("v06_latest_per_key", """
SELECT actor_id, actor_login FROM (
  SELECT *, row_number() OVER (PARTITION BY actor_id ORDER BY created_at DESC, event_id DESC) AS rn FROM ev
) WHERE rn = 1""", EV)
_q("v07_stg_events", f"SELECT {STG_COLUMNS} FROM stg", LATEST + silver("latest"))

# -- gold ---------------------------------------------------------------------------------------

_q("g01_surrogate_key", """
SELECT o_orderkey, md5(CAST(o_custkey AS VARCHAR)) AS one_field,
  md5(o_orderkey || '-' || CAST(o_orderdate AS VARCHAR) || '-'
    || CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE '_dbt_utils_surrogate_key_null_' END) AS three_fields
FROM orders""")
_q("g02_scd2_history", "SELECT * FROM versions", VERSIONS)
_q("g02_scd2_snapshot", """
, cur AS (
  SELECT repo_id, repo_name, repo_owner, repo_short_name, run FROM (
    SELECT *, row_number() OVER (PARTITION BY repo_id, run ORDER BY event_date DESC) AS rn FROM (
      SELECT *, CAST(first + CAST(10 * ((event_date - first) // 10 + 1) AS INTEGER) AS TIMESTAMP) AS run
      FROM repos, (SELECT min(event_date) AS first FROM repos))) WHERE rn = 1
), marked AS (
  SELECT *, lag(repo_name) OVER w AS pn, lag(repo_owner) OVER w AS po, row_number() OVER w AS rn
  FROM cur WINDOW w AS (PARTITION BY repo_id ORDER BY run)
)
SELECT repo_id, repo_name, repo_owner, repo_short_name, run AS valid_from,
  lead(run) OVER (PARTITION BY repo_id ORDER BY run) AS valid_to
FROM marked WHERE rn = 1 OR repo_name IS DISTINCT FROM pn OR repo_owner IS DISTINCT FROM po""",
   EV + silver("ev") + REPOS)
_q("g03_current_per_repo", """
SELECT repo_id, repo_name, repo_owner, repo_short_name FROM (
  SELECT *, row_number() OVER (PARTITION BY repo_id ORDER BY event_date DESC) AS rn FROM repos) WHERE rn = 1""",
   EV + silver("ev") + REPOS)
_q("g04_scd2_dimension", "SELECT * FROM dim_repo", EV + silver("ev") + DIM_REPO)
_q("g04_scd2_current", "SELECT repo_id, repo_name, valid_from FROM dim_repo WHERE is_current", EV + silver("ev") + DIM_REPO)
_q("g05_scd1_upsert", """
SELECT md5(CAST(actor_id AS VARCHAR)) AS actor_key, actor_id, actor_login FROM (
  SELECT *, row_number() OVER (PARTITION BY actor_id ORDER BY created_at DESC, event_id DESC) AS rn FROM ev
) WHERE rn = 1""", EV)
_q("g06_calendar", """
SELECT d.*, coalesce(o.n, 0) AS orders FROM dim_date d LEFT JOIN (
  SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key, count(*) AS n FROM orders GROUP BY 1
) o ON d.date_key = o.date_key""", DIM_DATE)

AS_OF = """
SELECT e.event_id, e.user_id, e.ts, v.event_type AS state, v.valid_from, v.valid_to FROM events e
LEFT JOIN versions v ON e.user_id = v.user_id AND e.ts >= v.valid_from
  AND e.ts < coalesce(v.valid_to, TIMESTAMP '9999-12-31')"""
_q("g07_point_in_time_join", AS_OF, VERSIONS)
_q("g07b_asof_window", AS_OF, VERSIONS)
_q("g07c_asof_unmatched", """
SELECT o.o_orderkey, o.o_custkey AS user_id, o.o_orderdate, v.event_type AS state, v.valid_from, v.valid_to FROM orders o
LEFT JOIN versions v ON o.o_custkey = v.user_id AND o.o_orderdate >= v.valid_from
  AND o.o_orderdate < coalesce(v.valid_to, TIMESTAMP '9999-12-31')""", VERSIONS)
_q("g08_incremental_filter", """
SELECT * FROM bronze WHERE ingested_at > (SELECT coalesce(max(ingested_at), TIMESTAMP '1900-01-01')
  FROM bronze WHERE ingested_at < TIMESTAMP '2024-01-16')""", BRONZE)
_q("g08b_unconsumed_batches", """
SELECT b.* FROM bronze b WHERE NOT EXISTS (SELECT 1 FROM bronze o WHERE o.created_at < TIMESTAMP '2024-01-16'
  AND o.source_file = b.source_file AND o.ingested_at = b.ingested_at)""", BRONZE)
_q("g09_upsert", "SELECT * FROM latest", LATEST)
_q("g09b_upsert_table", """
SELECT event_id, actor_login, ingested_at, CAST(strftime(ingested_at, '%Y%m%d') AS INTEGER) AS date_key FROM latest""", LATEST)
_q("g10_fact_events", "SELECT * FROM fact", FACT)
_q("g10c_fact_late_batches", "SELECT * FROM fact", FACT)
_q("g10b_fact_events_window", "SELECT * FROM fact", FACT)
_q("g11_open_merge_pairs", "SELECT * REPLACE (CAST(hours_to_merge AS DOUBLE) AS hours_to_merge) FROM pairs", EV + pairs("ev"))
_q("g11b_first_merge", """
SELECT * EXCLUDE (rn) REPLACE (CAST(hours_to_merge AS DOUBLE) AS hours_to_merge) FROM (
  SELECT *, row_number() OVER (PARTITION BY repo_id, pr_number ORDER BY merged_at, merge_event_id) AS rn FROM pairs
) WHERE rn = 1""", EV + pairs("ev"))
_q("g12_elapsed_hours", """
SELECT l_orderkey, l_linenumber, round(CAST(date_diff('second', o_orderdate, l_shipdate) AS DOUBLE) / 3600.0, 6) AS hours
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
_q("g13_merge_flag", """
SELECT event_id, coalesce(event_type = 'PullRequestEvent' AND action = 'merged', false) AS is_pr_merged FROM ev""", EV)
_q("g14_event_type_dimension", """
SELECT md5(t.event_type) AS event_type_key, t.event_type, description, category, count(event_id) AS events
FROM event_types t LEFT JOIN ev USING (event_type) GROUP BY ALL""", EV + TYPES)
_q("g15_date_key", """
SELECT CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS date_key, count(*) AS n FROM lineitem GROUP BY 1""")

# -- marts --------------------------------------------------------------------------------------

_q("m01_daily_activity", "SELECT * FROM activity", EV + DIM_DATE + TYPES + activity("ev"))
_q("m01b_activity_from_fact", "SELECT * FROM activity", FACT + DIM_DATE + TYPES + activity("fact"))
for _name, _unit in (("m01c_weekly_contributors", "week"), ("m01d_monthly_contributors", "month")):
    _q(_name, f"""
SELECT f.repo_id, t.category, CAST(date_trunc('{_unit}', f.created_at) AS DATE) AS period, count(DISTINCT f.actor_id) AS distinct_contributors
FROM ev f JOIN event_types t ON f.event_type = t.event_type WHERE f.repo_id IS NOT NULL GROUP BY ALL""", EV + TYPES)
_q("m02_lifecycle_percentiles", """
SELECT repo_id, pr_number, opened_at, merged_at, round(CAST(hours_to_merge AS DOUBLE), 6) AS hours_to_merge,
  round(CAST(repo_p50_hours_to_merge AS DOUBLE), 6) AS repo_p50_hours_to_merge,
  round(CAST(repo_p95_hours_to_merge AS DOUBLE), 6) AS repo_p95_hours_to_merge FROM lifecycle""", LIFECYCLE)
_q("m02c_percentiles_by_day", """
SELECT DISTINCT repo_id, round(CAST(repo_p50_hours_to_merge AS DOUBLE), 6) AS repo_p50_hours_to_merge,
  round(CAST(repo_p95_hours_to_merge AS DOUBLE), 6) AS repo_p95_hours_to_merge FROM lifecycle""", LIFECYCLE)
_q("m03_back_derived_start", """
SELECT repo_id, pr_number, merged_at - date_diff('second', opened_at, merged_at) * INTERVAL 1 SECOND AS opened_at, merged_at
FROM pairs""", EV + pairs("ev"))
_q("m02b_line_price_percentiles", """
SELECT l_returnflag, l_linestatus, round(quantile_cont(l_extendedprice, 0.5), 4) AS p50,
  round(quantile_cont(l_extendedprice, 0.95), 4) AS p95, round(quantile_cont(l_extendedprice, 0.99), 4) AS p99
FROM lineitem GROUP BY 1, 2""")
_q("m04_hourly_volume", "SELECT * FROM volume", EV + VOLUME)


def _rates(now: str) -> str:
    def one(name: str, span: str) -> str:
        w = f"started_at >= {now} - INTERVAL {span}"
        ok = f"count(*) FILTER (WHERE {w} AND status = 'success')"
        return (
            f"count(*) FILTER (WHERE {w}) AS runs_{name}, {ok} AS successes_{name}, "
            f"round(CAST({ok} AS DOUBLE) / nullif(count(*) FILTER (WHERE {w}), 0), 6) AS success_rate_{name}"
        )

    return one("24h", "24 HOUR") + ", " + one("7d", "7 DAY")


STREAK = """(SELECT coalesce((SELECT min(rn) - 1 FROM ordered WHERE status != 'failed'), (SELECT count(*) FROM ordered)))"""
ORDERED = """, ordered AS (SELECT status, row_number() OVER (ORDER BY started_at DESC) AS rn FROM runs)"""
_q("m05_health_snapshot", f"""
SELECT TIMESTAMP '2024-01-31' AS computed_at, {_rates("TIMESTAMP '2024-01-31'")},
  round(quantile_cont(duration_s, 0.5), 6) AS p50_duration_s, round(quantile_cont(duration_s, 0.95), 6) AS p95_duration_s,
  {STREAK} AS consecutive_failures, max(started_at) AS latest_event_at,
  round(CAST(date_diff('second', max(started_at), TIMESTAMP '2024-01-31') AS DOUBLE) / 3600.0, 6) AS data_age_hours
FROM runs""", RUNS + ORDERED)
_q("m06_run_rates", "SELECT " + _rates("TIMESTAMP '2024-01-20 12:00:00'") + " FROM runs", RUNS)
_q("m07_duration_percentiles", """
SELECT round(quantile_cont(duration_s, 0.5), 6) AS p50_duration_s, round(quantile_cont(duration_s, 0.95), 6) AS p95_duration_s
FROM runs""", RUNS)
SQL["m07b_durations_by_day"] = SQL["m07_duration_percentiles"]
_q("m08_failure_streak", f"SELECT {STREAK} AS consecutive_failures", RUNS + ORDERED)
_q("m08b_long_streak", f"SELECT {STREAK} AS consecutive_failures", RUNS + """, ordered AS (
  SELECT CASE WHEN started_at < TIMESTAMP '2024-01-16' THEN status ELSE 'failed' END AS status,
    row_number() OVER (ORDER BY started_at DESC) AS rn FROM runs)""")
_q("m09_data_age", """
SELECT max(ts) AS latest_event_at,
  round(CAST(date_diff('second', max(ts), TIMESTAMP '2024-01-31') AS DOUBLE) / 3600.0, 6) AS data_age_hours FROM events""")

# -- checks -------------------------------------------------------------------------------------

_q("q01_unique", "SELECT l_orderkey, count(*) AS n_records FROM lineitem GROUP BY 1 HAVING count(*) > 1")
_COLS = ("event_id", "event_type", "created_at", "actor_id", "actor_login", "repo_id", "repo_name", "org_id", "action",
         "pr_number", "issue_number", "ingested_at", "source_file")
_q("q02_not_null", " UNION ALL ".join(
    f"SELECT 'test.feed.not_null_{c}' AS unique_id, count(*) AS violations, "
    f"CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END AS status FROM ev WHERE {c} IS NULL" for c in _COLS), EV)
_q("q03_accepted_values", """
SELECT event_type, count(*) AS n_records FROM ev WHERE event_type NOT IN ('PushEvent', 'WatchEvent') GROUP BY 1""", EV)
_q("q04_relationships", """
SELECT o_custkey, count(*) AS n_records FROM orders WHERE o_custkey IS NOT NULL
  AND o_custkey NOT IN (SELECT user_id FROM events) GROUP BY 1""")
_q("q05_unique_combination", """
SELECT l_suppkey, l_returnflag, l_linestatus, count(*) AS n_records FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
_q("q06_no_future_events", "SELECT event_id, ts AS created_at FROM events WHERE ts > TIMESTAMP '2024-01-30 12:00:00'")
_q("q07_merge_after_open", """
SELECT * REPLACE (CAST(hours_to_merge AS DOUBLE) AS hours_to_merge) FROM pairs WHERE merged_at < opened_at""", EV + pairs("ev"))
_q("q08_anomaly", """
, hourly AS (SELECT v.*, d.date_day FROM volume v JOIN dim_date d ON v.date_key = d.date_key),
latest_day AS (SELECT max(date_day) AS d FROM hourly),
base AS (
  SELECT event_hour, avg(event_count) AS m, stddev_samp(event_count) AS s FROM hourly, latest_day
  WHERE date_day >= d - INTERVAL 7 DAY AND date_day < d GROUP BY 1
)
SELECT h.date_day, h.event_hour, h.event_count, round(m, 6) AS mean_count, round(s, 6) AS stddev_count
FROM hourly h JOIN latest_day ON h.date_day = d JOIN base b ON h.event_hour = b.event_hour
WHERE s > 0 AND abs(h.event_count - m) > 3 * s""", EV + VOLUME + DIM_DATE)
_q("q08b_anomaly_filled", """
, latest_day AS (SELECT max(date_day) AS d, min(date_day) AS f FROM volume v JOIN dim_date USING (date_key)),
grid AS (
  SELECT date_key, date_day, d, unnest(range(24)) AS event_hour FROM dim_date, latest_day
  WHERE date_day BETWEEN greatest(f, d - INTERVAL 7 DAY) AND d
), hourly AS (
  SELECT g.date_day, g.d, g.event_hour, coalesce(v.event_count, 0) AS event_count
  FROM grid g LEFT JOIN volume v ON v.date_key = g.date_key AND v.event_hour = g.event_hour
), base AS (
  SELECT event_hour, avg(event_count) AS m, stddev_samp(event_count) AS s FROM hourly WHERE date_day < d GROUP BY 1
)
SELECT h.date_day, h.event_hour, h.event_count, round(m, 6) AS mean_count, round(s, 6) AS stddev_count
FROM hourly h JOIN base b ON h.event_hour = b.event_hour
WHERE h.date_day = h.d AND s > 0 AND abs(h.event_count - m) > s""", EV + VOLUME + DIM_DATE)

_CHECKS = [
    ("orders.unique_o_orderkey", "error", "SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1"),
    ("lineitem.unique_l_orderkey", "warn", "SELECT l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1"),
    ("events.unique_user_id", "error", "SELECT user_id FROM events WHERE user_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1"),
    ("orders.not_null_o_custkey", "error", "SELECT 1 FROM orders WHERE o_custkey IS NULL"),
    ("orders.accepted_values_o_orderstatus", "warn", "SELECT 1 FROM orders WHERE o_orderstatus NOT IN ('F', 'O')"),
    ("events.accepted_values_event_type", "error",
     "SELECT 1 FROM events WHERE event_type NOT IN ('signup', 'purchase', 'click', 'view', 'error')"),
    ("orders.relationships_o_custkey", "error",
     "SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)"),
    ("events.relationships_user_id", "warn",
     "SELECT DISTINCT user_id FROM events WHERE user_id NOT IN (SELECT o_custkey FROM orders)"),
]
_q("q09_severity", "SELECT *, CASE WHEN violations = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status FROM ("
   + " UNION ALL ".join(f"SELECT 'test.{n}' AS unique_id, '{s}' AS severity, count(*) AS violations FROM ({q})" for n, s, q in _CHECKS)
   + ")")
_BY_DAY = [
    ("not_null_pr_number", "warn", "pr_number IS NULL"), ("not_null_repo_id", "error", "repo_id IS NULL"),
    ("accepted_values_event_type", "error", "event_type NOT IN ('PushEvent', 'WatchEvent')"), ("no_late_hours", "error", "extract(hour FROM created_at) >= 22"),
]
_q("q09b_checks_by_day", "SELECT *, CASE WHEN violations = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status FROM ("
   + " UNION ALL ".join(f"SELECT 'test.feed.{n}' AS unique_id, '{s}' AS severity, count(*) FILTER (WHERE {w}) AS violations FROM ev" for n, s, w in _BY_DAY)
   + ")", EV)
# Tables of the lake that other queries do not need as such.
_LAKE = FACT + REPOS + DIM_DATE + TYPES + activity("fact") + "," + RUNS + """, actors AS (
  SELECT actor_id, actor_login FROM (
    SELECT *, row_number() OVER (PARTITION BY actor_id ORDER BY created_at DESC, event_id DESC) AS rn FROM stg) WHERE rn = 1
), dim_actor AS (
  SELECT md5(CAST(actor_id AS VARCHAR)) AS actor_key, actor_id, actor_login FROM actors
), dim_event_type AS (
  SELECT md5(event_type) AS event_type_key, * FROM event_types
), volume AS (
  SELECT date_key, CAST(extract(hour FROM created_at) AS BIGINT) AS event_hour, count(*) AS event_count FROM fact GROUP BY ALL
), merges AS (
  SELECT repo_id, pr_number, hours_to_merge FROM fact WHERE is_pr_merged AND hours_to_merge IS NOT NULL
), health AS (
  SELECT (SELECT count(*) FROM runs WHERE started_at > coalesce((SELECT max(started_at) FROM runs WHERE status <> 'failed'), TIMESTAMP '1970-01-01')) AS consecutive_failures,
    date_diff('second', max(created_at), TIMESTAMP '2024-01-31') / 3600.0 AS data_age_hours FROM fact
), latest_day AS (
  SELECT max(date_day) AS d FROM volume JOIN dim_date USING (date_key)
), past AS (
  SELECT event_hour, avg(event_count) AS m, stddev_samp(event_count) AS s FROM volume JOIN dim_date USING (date_key), latest_day
  WHERE date_day >= d - INTERVAL 7 DAY AND date_day < d GROUP BY 1
)"""
_PLACE = {
    "stg_events": "stg", "stg_repos": "repos", "stg_actors": "actors", "pr_lifecycle": "pairs", "pipeline_runs": "runs", "dim_repo": "dim_repo",
    "dim_actor": "dim_actor", "dim_date": "dim_date", "dim_event_type": "dim_event_type", "fact_events": "fact", "mart_daily_repo_activity": "activity",
    "mart_pr_lifecycle": "merges", "mart_hourly_volume": "volume", "mart_pipeline_health": "health",
}
# What the suite declares: columns that are never NULL, keys, allowed values, parents and predicates ("~" only warns).
_NEVER_NULL = {
    "stg_events": "event_id event_type created_at actor_id actor_login event_date event_hour ~repo_id", "stg_repos": "repo_id event_date repo_name",
    "stg_actors": "actor_id actor_login", "pr_lifecycle": "merge_event_id hours_to_merge", "pipeline_runs": "run_id status",
    "dim_repo": "repo_key repo_id valid_from", "dim_actor": "actor_key actor_id", "dim_date": "date_key date_day",
    "dim_event_type": "event_type_key event_type category", "fact_events": "event_id ingested_at actor_key date_key event_type_key is_pr_merged",
    "mart_daily_repo_activity": "repo_id event_count", "mart_pr_lifecycle": "hours_to_merge", "mart_hourly_volume": "event_count",
    "mart_pipeline_health": "consecutive_failures data_age_hours",
}
_KEYS = {
    "stg_events": ["event_id"], "stg_actors": ["actor_id"], "pr_lifecycle": ["merge_event_id", "repo_id, pr_number"], "pipeline_runs": ["run_id"],
    "dim_repo": ["repo_key"], "dim_actor": ["actor_key", "actor_id"], "dim_date": ["date_key", "date_day"], "dim_event_type": ["event_type_key", "event_type"],
    "fact_events": ["event_id"], "mart_daily_repo_activity": ["repo_id, date_key, category"], "mart_pr_lifecycle": ["repo_id, pr_number"],
    "mart_hourly_volume": ["date_key, event_hour"],
}
_ALLOWED = {
    ("stg_events", "event_type"): "SELECT event_type FROM event_types", ("pipeline_runs", "status"): "'success', 'failed'",
    ("dim_event_type", "category"): "'code', 'collaboration', 'social'",
}
_PARENTS = {"repo_key": ("dim_repo", "warn"), "actor_key": ("dim_actor", "error"), "date_key": ("dim_date", "error"), "event_type_key": ("dim_event_type", "error")}


def _declared() -> list[tuple[str, str, str]]:
    """Name, severity and violating rows of every declared check."""
    out = []
    for table, columns in _NEVER_NULL.items():
        for c in columns.split():
            out.append((f"{table}.not_null_{c.lstrip('~')}", "warn" if c[0] == "~" else "error", f"SELECT 1 FROM {_PLACE[table]} WHERE {c.lstrip('~')} IS NULL"))
    for table, keys in _KEYS.items():
        for k in keys:
            present = "" if "," in k else f"WHERE {k} IS NOT NULL"
            out.append((f"{table}.unique_{k.replace(', ', '_')}", "error", f"SELECT 1 FROM {_PLACE[table]} {present} GROUP BY {k} HAVING count(*) > 1"))
    for (table, c), values in _ALLOWED.items():
        out.append((f"{table}.accepted_values_{c}", "warn", f"SELECT 1 FROM {_PLACE[table]} WHERE {c} NOT IN ({values})"))
    for c, (parent, severity) in _PARENTS.items():
        out.append((f"fact_events.relationships_{c}", severity, f"SELECT DISTINCT {c} FROM fact WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {c} FROM {parent})"))
    out.append(("stg_events.no_future_events", "error", "SELECT 1 FROM stg WHERE created_at > TIMESTAMP '2024-01-31'"))
    out.append(("pr_lifecycle.merge_after_open", "error", "SELECT 1 FROM pairs WHERE merged_at < opened_at"))
    out.append(("mart_hourly_volume.hourly_volume_not_anomalous", "warn", """SELECT 1 FROM volume JOIN dim_date USING (date_key) JOIN latest_day ON date_day = d
      JOIN past USING (event_hour) WHERE s > 0 AND abs(event_count - m) > 3 * s"""))
    return out


_q("q10b_declared_checks", "SELECT *, CASE WHEN violations = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status FROM ("
   + " UNION ALL ".join(f"SELECT 'test.{n}' AS unique_id, '{s}' AS severity, count(*) AS violations FROM ({q})" for n, s, q in _declared())
   + ")", _LAKE)
_q("q10_summary", """
SELECT 'run' AS run_id, TIMESTAMP '2024-01-31' AS recorded_at, count(*) AS total_tests,
  count(*) FILTER (WHERE event_type IN ('click', 'view')) AS passed_tests,
  count(*) FILTER (WHERE event_type = 'signup') AS warned_tests,
  count(*) FILTER (WHERE event_type IN ('purchase', 'error')) AS failed_tests FROM events""")
_AGE = "CAST(date_diff('microsecond', max(ts), TIMESTAMP '2024-01-31') AS DOUBLE) / 3600000000.0"
_BAND = "CASE WHEN age <= {0} THEN 'fresh' WHEN age <= 2 * {0} THEN 'aging' ELSE 'stale' END AS band"
_q("q11_freshness", f"""
SELECT age <= 3 AS is_fresh, latest_event_at, round(age, 6) AS age_hours, CAST(3 AS DOUBLE) AS sla_hours,
  {_BAND.format(3)} FROM (SELECT max(ts) AS latest_event_at, {_AGE} AS age FROM events)""")
_q("q12_band", f"""
SELECT repo_id, {_BAND.format(6)} FROM (
  SELECT CAST(props->>'$.k' AS BIGINT) AS repo_id, {_AGE} AS age FROM events GROUP BY 1)""")
_q("q13_failure_report", """
SELECT hour_processed AS hour, 'ingest' AS step, error_message AS error, 'run/' || run_id AS run_url
FROM runs WHERE status = 'failed'""", RUNS)

# -- retention ----------------------------------------------------------------------------------

_EXPIRED = """SELECT CAST(ts AS DATE) AS event_date, count(DISTINCT date_trunc('hour', ts)) AS files FROM events
  WHERE CAST(ts AS DATE) < DATE '2024-01-24' GROUP BY 1"""
_q("r01_expired_partitions", f"SELECT event_date, files > 0 AS has_files FROM ({_EXPIRED})")
_q("r02_reclaimable", f"""
SELECT DATE '2024-01-24' AS cutoff_date, count(*) AS dates_expired, coalesce(sum(files), 0) > 0 AS files_expired,
  count(*) > 0 AS bytes_reclaimable FROM ({_EXPIRED})""")
_q("r03_retained", """
SELECT CAST(ts AS DATE) AS event_date, count(*) AS n FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-24' GROUP BY 1""")

_q("r04_footprint", """
SELECT zone, filled AS has_files, filled AS has_bytes, filled AS has_mb FROM (
  VALUES ('bronze', (SELECT count(*) > 0 FROM events)), ('tables', true), ('none', false)) AS z(zone, filled)""")

# -- analytics ----------------------------------------------------------------------------------

_DAYS = "BETWEEN DATE '2024-01-06' AND DATE '2024-01-25'"
_q("a01_activity_named", "SELECT * FROM named", NAMED)
_q("a02_hourly_series", f"""
SELECT d.date_day + to_hours(CAST(v.event_hour AS INTEGER)) AS timestamp, v.event_count
FROM volume v JOIN dim_date d ON v.date_key = d.date_key WHERE CAST(d.date_day AS DATE) {_DAYS}""", EV + VOLUME + DIM_DATE)
_q("a03_filtered", f"""
SELECT * FROM named WHERE CAST(date_day AS DATE) {_DAYS} AND category IN ('code', 'social')""", NAMED)
_q("a04_top20", """
SELECT repo_id, repo_name, CAST(sum(event_count) AS BIGINT) AS event_count FROM named WHERE repo_name IS NOT NULL
GROUP BY 1, 2 ORDER BY event_count DESC, repo_id LIMIT 20""", NAMED)
_q("a05_histogram", f"""
, r AS (SELECT CAST(hours_to_merge AS DOUBLE) AS h FROM lifecycle WHERE CAST(merged_at AS DATE) {_DAYS}),
e AS (SELECT min(h) AS lo, max(h) AS hi, (max(h) - min(h)) / 30.0 AS w FROM r),
b AS (SELECT least(CASE WHEN w = 0 THEN 0 ELSE floor((h - lo) / w) END, 29) + 1 AS bin, lo, w FROM r, e)
SELECT CAST(bin AS BIGINT) AS bin, round(lo + (bin - 1) * w, 6) AS bin_start, round(lo + bin * w, 6) AS bin_end,
  count(*) AS n FROM b GROUP BY bin, lo, w""", LIFECYCLE)
_q("a06_weekend_split", """
SELECT CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS day_type, CAST(sum(event_count) AS BIGINT) AS event_count
FROM named GROUP BY 1""", NAMED)
_q("a07_latest48", """
SELECT started_at, run_id, status, rows_written FROM runs ORDER BY started_at DESC, run_id LIMIT 48""", RUNS)
_q("a08_latest_check_result", """
, daily AS (SELECT CAST(ts AS DATE) AS d, count(*) AS total, count(*) FILTER (WHERE event_type != 'error') AS passed FROM events GROUP BY 1)
SELECT CAST(d AS VARCHAR) AS run_id, CAST(d AS TIMESTAMP) AS recorded_at, total AS total_tests, passed AS passed_tests,
  CAST(0 AS BIGINT) AS warned_tests, total - passed AS failed_tests, round(CAST(passed AS DOUBLE) / total, 6) AS pass_rate
FROM daily ORDER BY d DESC LIMIT 1""".replace(", daily", "WITH daily", 1))
_q("a09_filter_choices", """
SELECT string_agg(DISTINCT category, ',' ORDER BY category) AS categories, CAST(min(date_day) AS DATE) AS min_date,
  CAST(max(date_day) AS DATE) AS max_date FROM activity""", EV + DIM_DATE + TYPES + activity("ev"))

# -- profiling ----------------------------------------------------------------------------------

_q("p01_type_distribution", """
SELECT event_type AS type, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM ev), 6) AS pct FROM ev GROUP BY 1""", EV)
_PATHS = {
    "id": "true", "type": "true", "created_at": "true", "actor.id": "true", "actor.login": "true",
    "repo.id": "repo_id IS NOT NULL", "repo.name": "repo_name IS NOT NULL", "org.id": "org_id IS NOT NULL",
    "payload.action": "action IS NOT NULL", "payload.pull_request.number": "pr_number IS NOT NULL",
    "payload.pull_request.merged": "false", "payload.issue.number": "issue_number IS NOT NULL", "payload.commits": "false",
}
_LEAF = {"id": "STRING", "type": "STRING", "created_at": "STRING", "actor.login": "STRING", "repo.name": "STRING",
         "payload.action": "STRING"}
_q("p02_schema_tree", " UNION ALL ".join(
    f"SELECT event_type AS type, '{p}' AS path, '{_LEAF.get(p, 'BIGINT')}' AS data_type FROM ev WHERE {c} GROUP BY 1"
    for p, c in _PATHS.items() if c != "false"), EV)
_q("p03_field_presence", " UNION ALL ".join(
    f"SELECT '{p}' AS path, count(*) FILTER (WHERE {c}) AS present, count(*) AS total, "
    f"round(100.0 * count(*) FILTER (WHERE {c}) / count(*), 6) AS pct FROM ev" for p, c in _PATHS.items()), EV)
_q("p04_key_sets", """
SELECT CASE event_type WHEN 'PullRequestEvent' THEN 'action,pull_request' WHEN 'IssuesEvent' THEN 'issue' ELSE '' END AS keys,
  count(*) AS n FROM ev GROUP BY 1""", EV)
_q("p05_action_distribution", """
SELECT action, count(*) AS n FROM ev WHERE event_type = 'PullRequestEvent' GROUP BY 1""", EV)

_q("p07_array_lengths", """
SELECT CAST(CASE WHEN event_type = 'PushEvent' THEN extract(hour FROM created_at) + 1 END AS INTEGER) AS length, count(*) AS n FROM ev GROUP BY 1""", EV)
_q("p06_form_sizes", """
SELECT form, true AS has_bytes, true AS not_larger FROM (VALUES ('raw'), ('gzip'), ('all_columns'), ('projected')) AS f(form)
WHERE EXISTS (SELECT 1 FROM events)""")

# -- streaming ----------------------------------------------------------------------------------

_STREAMED = f"""
SELECT * REPLACE (TIMESTAMP '2024-02-01' AS ingested_at), CAST(created_at AS DATE) AS event_date, strftime(created_at, '%H') AS hour
FROM ev WHERE {KEPT}"""
_q("t01_stream_ingest", _STREAMED, EV)
_q("t01b_stream_then_batch", _STREAMED, EV)
_q("t01c_stream_counters", f"""
SELECT CAST(date_trunc('hour', created_at) AS TIMESTAMP) AS hour, count(*) AS rows_read, count(*) FILTER (WHERE {KEPT}) AS rows_kept,
  count(*) FILTER (WHERE event_type = 'IssuesEvent') AS malformed_rows, count(*) FILTER (WHERE event_type = 'IssuesEvent') AS quarantined
FROM ev GROUP BY 1""", EV)
_q("t01d_stream_unreadable_files", f"""
SELECT 'success' AS status, '' AS error, count(DISTINCT CAST(date_trunc('hour', created_at) AS TIMESTAMP)) AS hours, count(*) FILTER (WHERE {KEPT}) AS rows_kept FROM ev
UNION ALL SELECT 'failed', 'corrupt gzip', 1, 0 UNION ALL SELECT 'failed', 'truncated gzip', 1, 0""", EV)
_q("t02_stream_dedupe", "SELECT event_id, event_type, created_at, repo_id FROM ev", EV)
_q("t03_stream_upsert", """
SELECT *, CAST(strftime(created_at, '%Y%m%d') AS INTEGER) AS date_key FROM latest""", LATEST)
_q("t04_stream_hourly_volume", "SELECT * FROM volume", EV + VOLUME)
_q("t05_late_data", """
, m AS (SELECT max(created_at) - INTERVAL 2 HOUR AS mark FROM ev WHERE event_type != 'IssuesEvent'),
h AS (
  SELECT date_key, event_hour, CAST(date_trunc('hour', created_at) AS TIMESTAMP) + INTERVAL 1 HOUR > mark AS open,
    event_type = 'IssuesEvent' AS late
  FROM (SELECT *, CAST(strftime(created_at, '%Y%m%d') AS INTEGER) AS date_key,
    CAST(extract(hour FROM created_at) AS BIGINT) AS event_hour FROM ev), m
)
SELECT date_key, event_hour, nullif(count(*) FILTER (WHERE open OR NOT late), 0) AS streamed_count, count(*) AS recovered_count
FROM h GROUP BY 1, 2""", EV)
SQL["t05b_late_rows"] = SQL["t05_late_data"]
