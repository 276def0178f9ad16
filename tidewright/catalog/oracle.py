"""SQL counterparts of the registered queries, for DuckDB on the same tables.

They compute the expected rows from the table columns, not from the JSON
texts the engine parses, so the two sides share no logic.
"""

from __future__ import annotations

AS_OF = "(SELECT max(ts) FROM events)"
STAMP = "TIMESTAMP '2024-02-01 00:00:00'"
THRESHOLD_US = 15 * 24 * 3600 * 1_000_000

EV = """
ev AS (
  SELECT event_id AS number, CAST(event_id AS VARCHAR) AS event_id, event_type AS log_type,
    CASE event_type WHEN 'click' THEN 'PushEvent' WHEN 'view' THEN 'PullRequestEvent'
      WHEN 'purchase' THEN 'IssuesEvent' WHEN 'signup' THEN 'WatchEvent'
      ELSE CASE WHEN k % 2 = 0 THEN 'CreateEvent' ELSE 'ForkEvent' END END AS event_type,
    user_id, 'user-' || user_id AS actor_login, k % 10 AS repo_id,
    'org/repo-' || (k % 10) AS repo_name, ts AS created_at,
    ts + to_microseconds(CAST(round(value * 1e6) AS BIGINT)) AS ingested_at, value, k
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
)"""

CI = """
ci AS (
  SELECT number AS run_id, repo_name AS repo, 'wf-' || user_id AS workflow_name,
    'completed' AS status,
    CASE log_type WHEN 'error' THEN 'failure' WHEN 'purchase' THEN 'success'
      WHEN 'click' THEN 'success' WHEN 'view' THEN 'cancelled' END AS conclusion,
    created_at
  FROM ev
)"""

# What the rules say about the raw form of each row.
RAW = f"""
judged AS (
  SELECT *, number % 97 = 0 AS cut,
    CASE
      WHEN user_id % 50 = 49 THEN 'required field missing: ''actor'''
      WHEN event_type = 'PushEvent' AND k % 10 = 0 THEN 'payload.ref is missing'
      WHEN event_type = 'PullRequestEvent' AND k % 10 = 9 THEN 'payload.number is missing'
      WHEN event_type = 'IssuesEvent' AND k % 5 = 0 THEN 'payload.action is missing'
      WHEN event_type = 'IssuesEvent' AND k % 10 = 8 THEN 'payload.issue.number is missing'
      WHEN event_type = 'WatchEvent' AND k % 10 = 7 THEN 'payload.action is missing'
      WHEN event_type = 'CreateEvent' AND k % 16 = 6
        THEN 'payload.ref_type invalid or missing: ''other'''
      WHEN event_type = 'CreateEvent' AND k % 16 = 14
        THEN 'payload.ref_type invalid or missing: '''''
      WHEN event_type = 'ForkEvent' AND k % 10 = 5 THEN 'payload.forkee is missing'
      WHEN event_type = 'ForkEvent' AND k % 10 = 3 THEN 'payload.forkee.full_name is missing'
    END AS reason
  FROM ev
),
raw AS (
  SELECT *, NOT cut AND reason IS NULL AS ok,
    CASE WHEN cut THEN '' ELSE event_id END AS raw_id,
    CASE WHEN cut THEN 'unknown' ELSE event_type END AS raw_type,
    CASE WHEN cut THEN '[default] id='''': not a JSON object'
      WHEN reason IS NOT NULL THEN '[' || event_type || '] id=''' || event_id || ''': ' || reason
    END AS error_reason,
    CASE WHEN cut OR k = 77 THEN {STAMP} ELSE created_at END AS stored_at
  FROM judged
)"""

ROUTED_DATE = f"""CASE WHEN epoch_us({STAMP}) - epoch_us(stored_at) > {THRESHOLD_US} THEN 'late'
  ELSE strftime(stored_at, '%Y-%m-%d') END"""

KB = """
it AS (
  SELECT doc_id AS n, doc_id % 3 <> 0 AS is_pr,
    CASE WHEN doc_id % 10 = 0 THEN 'Revert change #' || (doc_id - 3)
      WHEN doc_id % 10 = 5 THEN 'revert: undo' ELSE split_part(text, chr(10), 1) END AS title,
    CASE WHEN doc_id % 10 = 5 THEN 'Reverts org/repo#' || (doc_id - 4) || chr(10) || text
      WHEN doc_id % 11 = 0 THEN NULL ELSE text END AS body,
    lang, source, n_chars
  FROM documents
),
flat AS (
  SELECT n, n AS number, CASE WHEN is_pr THEN 'pr' ELSE 'issue' END AS kind, title,
    nullif(substr(body, 1, 1000), '') AS body_snippet, 'https://example.org/' || n AS url,
    ['Severity/' || lang, source, CASE WHEN n % 5 = 0 THEN 'P0' ELSE 'kind/change' END] AS labels,
    TIMESTAMP '2024-01-01 00:00:00' + to_hours(n) AS created_at,
    CASE WHEN n % 7 <> 0
      THEN TIMESTAMP '2024-01-01 00:00:00' + to_hours(n) + to_minutes(n_chars) END AS closed_at,
    is_pr AND regexp_matches(title, '(?i)^revert\\b') AS is_revert,
    CASE WHEN is_pr AND n % 10 = 5 THEN n - 4 WHEN is_pr AND n % 10 = 0 THEN n - 3
    END AS reverts_number
  FROM it
),
linked AS (
  SELECT reverts_number AS target, arg_max(number, n) AS by_number
  FROM flat WHERE reverts_number IS NOT NULL GROUP BY 1
),
kb AS (
  SELECT f.kind || '-' || f.number AS case_id, f.*,
    (epoch_us(closed_at) - epoch_us(created_at)) / 3.6e9 AS time_to_resolve_hours,
    l.by_number IS NOT NULL AS was_reverted, l.by_number AS reverted_by
  FROM flat f LEFT JOIN linked l ON f.kind = 'pr' AND l.target = f.number
)"""

CASE_TEXT = (
    "regexp_replace(title || chr(10) || coalesce(body_snippet, ''), '^\\s+|\\s+$', '', 'g')"
)


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


def _pct(x: str) -> str:
    return f"(CAST(CAST(round_even({x} * 100, 0) AS BIGINT) AS VARCHAR) || '%')"


def _one(x: str) -> str:
    return f"printf('%.1f', round_even(CAST({x} AS DOUBLE), 1))"


# ---- two windows ---------------------------------------------------------


def _scope(column: str) -> str:
    return f"CASE WHEN grouping({column}) = 1 THEN 'all' ELSE 'repo' END AS scope"


def ci_rates(as_of: str = AS_OF, window: int = 24, baseline: int = 168) -> str:
    return f"""
ci_w AS (
  SELECT repo, conclusion = 'failure' AS failed,
    created_at >= {as_of} - to_hours({window}) AS recent
  FROM ci WHERE conclusion IN ('success', 'failure')
    AND created_at >= {as_of} - to_hours({baseline}) AND created_at < {as_of}
),
ci_r AS (
  SELECT {_scope('repo')}, repo AS repo_name,
    avg(CASE WHEN failed THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) FILTER (recent) AS recent_failure_rate,
    count(*) FILTER (recent) AS recent_runs,
    avg(CASE WHEN failed THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) FILTER (NOT recent)
      AS baseline_failure_rate,
    count(*) FILTER (NOT recent) AS baseline_runs
  FROM ci_w GROUP BY GROUPING SETS ((repo), ())
)"""


def merges(as_of: str = AS_OF, window: int = 24, baseline: int = 168) -> str:
    return f"""
pr_w AS (
  SELECT repo_name, round(value * 3600) / 3600 AS hours,
    created_at >= {as_of} - to_hours({window}) AS recent
  FROM ev WHERE event_type = 'PullRequestEvent' AND k % 4 = 0
    AND created_at >= {as_of} - to_hours({baseline}) AND created_at < {as_of}
),
pr_r AS (
  SELECT {_scope('repo_name')}, repo_name,
    avg(hours) FILTER (recent) AS recent_avg_merge_hours,
    count(*) FILTER (recent) AS recent_merged,
    avg(hours) FILTER (NOT recent) AS baseline_avg_merge_hours,
    count(*) FILTER (NOT recent) AS baseline_merged
  FROM pr_w GROUP BY GROUPING SETS ((repo_name), ())
)"""


def pushes(as_of: str = AS_OF, window: int = 24, baseline: int = 168) -> str:
    return f"""
push_w AS (
  SELECT repo_name, created_at >= {as_of} - to_hours({window}) AS recent
  FROM ev WHERE event_type = 'PushEvent'
    AND created_at >= {as_of} - to_hours({baseline}) AND created_at < {as_of}
),
push_r AS (
  SELECT {_scope('repo_name')}, repo_name,
    count(*) FILTER (recent) / {window}::DOUBLE AS recent_pushes_per_hour,
    count(*) FILTER (recent) AS recent_pushes,
    count(*) FILTER (NOT recent) / {baseline - window}::DOUBLE AS baseline_pushes_per_hour,
    count(*) FILTER (NOT recent) AS baseline_pushes
  FROM push_w GROUP BY GROUPING SETS ((repo_name), ())
)"""


def _anomaly_id(kind: str, at: str, repo: str = "repo_name") -> str:
    return (
        f"substr(sha1(concat_ws(':', '{kind}', strftime({at}, '%Y-%m-%dT%H'), {repo})), 1, 12)"
    )


def _metric_text(**values: str) -> str:
    parts = [
        f"'{name}=' || printf('%.3f', round_even(CAST({x} AS DOUBLE), 3))" for name, x in sorted(values.items())
    ]
    return " || ';' || ".join(parts) + " AS metric"


def spike(as_of: str, window: int = 24) -> str:
    base = "coalesce(baseline_failure_rate, 0)"
    return f"""
spike AS (
  SELECT {_anomaly_id('ci_failure_spike', as_of)} AS anomaly_id, 'ci_failure_spike' AS type,
    'CI failure rate spiked to ' || {_pct('recent_failure_rate')} AS title,
    CASE WHEN {base} = 0 OR recent_failure_rate / {base} >= 3 OR recent_failure_rate >= 0.5
      THEN 'high' WHEN recent_failure_rate / {base} >= 2 THEN 'medium' ELSE 'low' END AS severity,
    'CI failure rate over the last {window}h is ' || {_pct('recent_failure_rate')} || ' (' ||
      recent_runs || ' runs), vs a ' || {_pct(base)} || ' baseline.' AS description,
    repo_name AS repo,
    {_metric_text(recent_failure_rate="recent_failure_rate", baseline_failure_rate=base,
                  recent_runs="recent_runs", baseline_runs="baseline_runs")}
  FROM ci_r WHERE recent_runs >= 5 AND recent_failure_rate > greatest(1.5 * {base}, 0.2)
)"""


def stretch(as_of: str, window: int = 24) -> str:
    ratio = "(recent_avg_merge_hours / baseline_avg_merge_hours)"
    return f"""
stretch AS (
  SELECT {_anomaly_id('merge_time_anomaly', as_of)} AS anomaly_id, 'merge_time_anomaly' AS type,
    'PR merge time ' || {_one(ratio)} || 'x above baseline' AS title,
    CASE WHEN {ratio} >= 3 THEN 'high' WHEN {ratio} >= 2 THEN 'medium' ELSE 'low' END AS severity,
    'PRs merged in the last {window}h averaged ' || {_one('recent_avg_merge_hours')} ||
      'h open-to-merge, vs a ' || {_one('baseline_avg_merge_hours')} || 'h baseline.' AS description,
    repo_name AS repo,
    {_metric_text(recent_avg_merge_hours="recent_avg_merge_hours", recent_merged="recent_merged",
                  baseline_avg_merge_hours="baseline_avg_merge_hours", ratio=ratio)}
  FROM pr_r WHERE recent_merged >= 3 AND baseline_merged >= 3 AND baseline_avg_merge_hours > 0
    AND {ratio} > 1.5
)"""


def drought(as_of: str, window: int = 24) -> str:
    recent, base = "recent_pushes_per_hour", "baseline_pushes_per_hour"
    return f"""
drought AS (
  SELECT {_anomaly_id('commit_drought', as_of)} AS anomaly_id, 'commit_drought' AS type,
    'Commit activity dropped to ' || {_one(recent)} || '/h' AS title,
    CASE WHEN {recent} = 0 THEN 'high' WHEN {recent} < 0.15 * {base} THEN 'medium'
      ELSE 'low' END AS severity,
    'PushEvents averaged ' || {_one(recent)} || '/h over the last {window}h, vs a ' ||
      {_one(base)} || '/h baseline.' AS description,
    repo_name AS repo,
    {_metric_text(recent_pushes_per_hour=recent, baseline_pushes_per_hour=base)}
  FROM push_r WHERE {base} >= 1 AND {recent} < 0.3 * {base}
)"""


LATER = f"({AS_OF} + to_hours(20))"
ALL_RULES = _with(
    EV, CI, ci_rates(LATER), merges(LATER), pushes(LATER), spike(LATER), stretch(LATER),
    drought(LATER),
)
ALL_ANOMALIES = (
    ALL_RULES
    + f"""SELECT anomaly_id, type, severity, repo, {LATER} AS detected_at FROM (
  SELECT anomaly_id, type, severity, repo FROM spike UNION ALL
  SELECT anomaly_id, type, severity, repo FROM stretch UNION ALL
  SELECT anomaly_id, type, severity, repo FROM drought)"""
)

# Window hours, baseline hours and hours after the newest event, chosen so that rules speak up.
RULE_TIMES = ((24, 168, 20), (6, 168, 0), (2, 48, 1), (12, 336, -100), (48, 336, 0))


def _anomalies_at(window: int, baseline: int, shift: int, where: dict[str, str] | None = None) -> str:
    at = f"({AS_OF} + to_hours({shift}))"
    tests = where or dict.fromkeys(("spike", "stretch", "drought"), "true")
    rules = " UNION ALL ".join(f"SELECT * FROM {rule} WHERE {test}" for rule, test in tests.items())
    return (
        "SELECT * FROM ("
        + _with(
            EV, CI, ci_rates(at, window, baseline), merges(at, window, baseline), pushes(at, window, baseline),
            spike(at, window), stretch(at, window), drought(at, window),
        )
        + f"SELECT anomaly_id, type, severity, repo, metric, {at} AS detected_at FROM ({rules}))"
    )


SNAP = (
    f"""
wf AS (
  SELECT scope, repo_name, workflow_name, failures, runs, failures / runs::DOUBLE AS rate,
    row_number() OVER (PARTITION BY scope, repo_name
      ORDER BY failures / runs::DOUBLE DESC, failures DESC, workflow_name) AS rank
  FROM (
    SELECT {_scope('repo')}, repo AS repo_name, workflow_name,
      count(*) FILTER (conclusion = 'failure') AS failures, count(*) AS runs
    FROM ci WHERE conclusion IN ('success', 'failure')
      AND created_at >= {AS_OF} - to_hours(24) AND created_at < {AS_OF}
    GROUP BY GROUPING SETS ((repo, workflow_name), (workflow_name)) HAVING count(*) >= 2)
),
wf_text AS (
  SELECT scope, coalesce(repo_name, '') AS key,
    'Most-failing workflows:' || chr(10) || string_agg('  - ' || workflow_name || ': ' || failures
      || '/' || runs || ' failed (' || {_pct('rate')} || ')', chr(10) ORDER BY rank) AS text,
    max(CASE WHEN rank = 1 THEN ' Worst workflow: ' || workflow_name || ' (' || failures || '/'
      || runs || ' failed).' END) AS worst
  FROM wf WHERE rank <= 5 GROUP BY ALL
),
pr AS (
  SELECT scope, repo_name, number, k, actor_login,
    row_number() OVER (PARTITION BY scope, repo_name ORDER BY created_at DESC, event_id) AS rank
  FROM (
    SELECT 'repo' AS scope, repo_name, number, k, actor_login, created_at, event_id FROM ev
    WHERE event_type = 'PullRequestEvent' AND k % 4 = 0
      AND created_at >= {AS_OF} - to_hours(24) AND created_at < {AS_OF}
    UNION ALL
    SELECT 'all', NULL, number, k, actor_login, created_at, event_id FROM ev
    WHERE event_type = 'PullRequestEvent' AND k % 4 = 0
      AND created_at >= {AS_OF} - to_hours(24) AND created_at < {AS_OF})
),
pr_text AS (
  SELECT scope, coalesce(repo_name, '') AS key,
    'PRs merged in the window (' || count(*) || ' most recent):' || chr(10) ||
      string_agg('  - #' || CASE WHEN k % 10 <> 9 THEN CAST(number AS VARCHAR) ELSE 'None' END
        || ' Change ' || number || ' (@' || actor_login || ')', chr(10) ORDER BY rank) AS text
  FROM pr WHERE rank <= 10 GROUP BY ALL
),
snap AS (
  SELECT scope, key, coalesce(nullif(key, ''), 'all repositories') AS repo, c.*, p.*,
    w.text AS workflows, w.worst, m.text AS merges
  FROM (SELECT scope, coalesce(repo_name, '') AS key, recent_failure_rate AS rate,
          recent_runs AS runs, baseline_failure_rate AS base FROM ci_r) c
  FULL JOIN (SELECT scope, coalesce(repo_name, '') AS key, recent_pushes_per_hour AS push,
          baseline_pushes_per_hour AS push_base FROM push_r) p USING (scope, key)
  FULL JOIN wf_text w USING (scope, key)
  FULL JOIN pr_text m USING (scope, key)
)"""
)
SNAP_CTES = _with(EV, CI, ci_rates(), pushes(), SNAP)

ANOMALY_ROWS = f"""
daily AS (
  SELECT repo_name, date_trunc('day', created_at) AS day, count(*) AS n FROM ev GROUP BY ALL
),
anomaly_rows AS (
  SELECT {_anomaly_id('commit_drought', 'day')} AS anomaly_id, 'seen ' || n AS title,
    repo_name AS repo, day, CAST(n AS DOUBLE) AS n
  FROM daily
)"""


# ---- search --------------------------------------------------------------


def matches(k: int, corpus: str) -> str:
    """Top-k of every vector against a corpus (case_id, embedding)."""
    return f"""
scored AS (
  SELECT q.vec_id AS query_id, c.case_id,
    round(list_cosine_similarity(q.embedding::DOUBLE[], c.embedding::DOUBLE[]), 9) AS similarity
  FROM embeddings q, ({corpus}) c
),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, case_id)
      AS INTEGER) AS rank,
    CASE WHEN similarity >= 0.75 THEN 'high' WHEN similarity >= 0.5 THEN 'medium' ELSE 'low'
    END AS similarity_band
  FROM scored
),
found AS (SELECT * FROM ranked WHERE rank <= {k})"""


VECTOR_CORPUS = "SELECT vec_id AS case_id, embedding FROM embeddings"
CASE_CORPUS = "SELECT kb.case_id, e.embedding FROM kb JOIN embeddings e ON e.vec_id = kb.number"
TOPK = (
    _with(matches(5, VECTOR_CORPUS))
    + "SELECT query_id, case_id, rank, round(similarity, 6) AS similarity, similarity_band FROM found"
)
SEVERE = (
    "(contains(label, 'severity') OR contains(label, 'priority') OR contains(label, 'p0') "
    "OR contains(label, 'p1') OR contains(label, 'hotfix') OR contains(label, 'critical'))"
)


def estimate(rows: str, key: str) -> str:
    """Outcome numbers per key over (key, case columns)."""
    return f"""
numbers AS (
  SELECT {key}, count(*) AS sample_size, count(*) FILTER (kind = 'pr') AS pr_count,
    avg(CASE WHEN was_reverted THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) FILTER (kind = 'pr')
      AS revert_rate,
    avg(time_to_resolve_hours) AS avg_time_to_resolve_hours
  FROM ({rows}) GROUP BY {key}
),
label_sets AS (
  SELECT {key}, string_agg(label, ',' ORDER BY label) AS severity_labels FROM (
    SELECT DISTINCT {key}, lower(label) AS label FROM (
      SELECT {key}, unnest(labels) AS label FROM ({rows})))
  WHERE {SEVERE} GROUP BY {key}
)"""


FOUND_CASES = "SELECT f.query_id, kb.* FROM found f JOIN kb USING (case_id)"
BLOCK = """'[' || case_id || '] ' || title || chr(10) || 'labels: ' ||
  array_to_string(labels, ', ') || ' | reverted: ' ||
  CASE WHEN was_reverted THEN 'yes' ELSE 'no' END || ' | similarity: ' || similarity_band ||
  chr(10) || coalesce(body_snippet, '(no body)')"""
EVAL = f"""
pairs AS (
  SELECT vec_id AS query_id, CASE WHEN label < 5 THEN vec_id ELSE vec_id + 1 END AS expected_case_id
  FROM embeddings
),
{matches(10, VECTOR_CORPUS).strip()},
ranks AS (
  SELECT p.query_id, p.expected_case_id, f.rank FROM pairs p
  LEFT JOIN found f ON f.query_id = p.query_id AND f.case_id = p.expected_case_id
)"""


def _metric(event_type: str, columns: str) -> str:
    return (
        _with(EV, RAW)
        + f"SELECT event_id, {columns} FROM raw WHERE ok AND event_type = '{event_type}'"
    )


def _text(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


WEEK = f"created_at >= {AS_OF} - to_days(7)"
COMMITS = "CASE WHEN k % 9 = 0 THEN 0 ELSE k % 4 END"

ORACLE: dict[str, str] = {
    "event_counts": _with(EV)
    + f"SELECT event_type, count(*) AS event_count FROM ev WHERE {WEEK} GROUP BY 1",
    "top_entities": _with(EV)
    + f"""SELECT repo_name, count(*) AS event_count, count(DISTINCT actor_login) AS unique_actors,
  max(created_at) AS last_seen_at FROM ev WHERE {WEEK}
GROUP BY 1 ORDER BY event_count DESC, repo_name LIMIT 10""",
    "total_events": "SELECT count(*) AS n FROM events",
    "latest_event": "SELECT max(ts) AS latest FROM events",
    "newest_partition_event": "SELECT max(ts) AS latest FROM events",
    "lag_stats": _with(EV)
    + """, lag AS (SELECT (epoch_us(ingested_at) - epoch_us(created_at)) / 1e6 AS lag FROM ev
  WHERE ingested_at >= (SELECT max(ingested_at) FROM ev) - to_days(7) AND ingested_at >= created_at)
SELECT round(avg(lag), 1) AS avg_lag_seconds, round(min(lag), 1) AS min_lag_seconds,
  round(max(lag), 1) AS max_lag_seconds, count(*) AS sample_size FROM lag""",
    "lag_band": _with(EV)
    + """, lag AS (SELECT (epoch_us(ingested_at) - epoch_us(created_at)) / 1e6 AS lag FROM ev
  WHERE ingested_at >= (SELECT max(ingested_at) FROM ev) - to_days(7) AND ingested_at >= created_at)
SELECT count(*) AS sample_size, CASE WHEN round(avg(lag), 1) < 30 THEN 'healthy'
  WHEN round(avg(lag), 1) < 60 THEN 'elevated' ELSE 'high' END AS status FROM lag""",
    "recent_events": _with(EV)
    + """SELECT event_type, actor_login, repo_name, created_at FROM ev
ORDER BY created_at DESC, event_id LIMIT 20""",
    "recent_by_type": _with(EV)
    + """SELECT event_type, actor_login, repo_name, created_at FROM ev
WHERE event_type = 'PushEvent' ORDER BY created_at DESC, event_id LIMIT 20""",
    "recent_feed": _with(EV)
    + """SELECT event_type, actor_login, repo_name, created_at FROM ev
WHERE event_type = 'WatchEvent' ORDER BY created_at DESC, event_id LIMIT 20""",
    "type_share": _with(EV)
    + f"""SELECT event_type, event_count, total, round(pct, 6) AS pct,
  greatest(1, CAST(floor(pct / 5) AS INTEGER)) AS bar FROM (
  SELECT *, CAST(sum(event_count) OVER () AS BIGINT) AS total,
    event_count / sum(event_count) OVER ()::DOUBLE * 100 AS pct
  FROM (SELECT event_type, count(*) AS event_count FROM ev WHERE {WEEK} GROUP BY 1))""",
    "type_bar": _with(EV)
    + f"""SELECT event_type, event_count, greatest(1,
  CAST(round_even(event_count / (max(event_count) OVER ())::DOUBLE * 14, 0) AS INTEGER)) AS bar
FROM (SELECT event_type, count(*) AS event_count FROM ev WHERE {WEEK} GROUP BY 1)""",
    "entity_rank": _with(EV)
    + f"""SELECT actor_login, event_count,
  CAST(row_number() OVER (ORDER BY event_count DESC, actor_login) AS INTEGER) AS rank
FROM (SELECT actor_login, count(*) AS event_count FROM ev WHERE {WEEK} GROUP BY 1)
ORDER BY event_count DESC, actor_login LIMIT 10""",
    "bench_q1_top_repos": _with(EV)
    + """SELECT repo_name, count(*) AS event_count FROM ev GROUP BY 1
ORDER BY event_count DESC, repo_name LIMIT 10""",
    "bench_q2_type_distribution": _with(EV)
    + "SELECT event_type, count(*) AS cnt FROM ev GROUP BY 1",
    "bench_q3_recent_count": f"""SELECT count(*) AS recent_count FROM events
WHERE ts >= {AS_OF} - to_hours(1)""",
    "bench_q4_actor_activity": _with(EV)
    + """SELECT actor_login, count(*) AS events, count(DISTINCT event_type) AS types FROM ev
GROUP BY 1 ORDER BY events DESC, actor_login LIMIT 20""",
    "bench_q5_push_stats": _with(EV)
    + """SELECT count(*) AS total_push_events, CAST(sum(k) AS BIGINT) AS total_commits FROM ev
WHERE event_type = 'PushEvent'""",
    "latency_percentiles": _with(EV)
    + """SELECT event_type, n, round(median, 6) AS p50,
  round(s[greatest(0, CAST(floor(n * 0.99::DOUBLE) AS BIGINT) - 1) + 1], 6) AS p99 FROM (
  SELECT event_type, count(*) AS n, median(value) AS median, list_sort(list(value)) AS s
  FROM ev GROUP BY 1)""",
    "event_date_keys": _with(EV)
    + """SELECT strftime(created_at, '%Y-%m-%d') AS day,
  strftime(created_at, '%Y-%m-%dT%H') AS hour, count(*) AS n FROM ev GROUP BY ALL""",
    "failure_rate_windows": _with(EV, CI, ci_rates())
    + """SELECT scope, repo_name, round(recent_failure_rate, 6) AS recent_failure_rate, recent_runs,
  round(baseline_failure_rate, 6) AS baseline_failure_rate, baseline_runs FROM ci_r""",
    "failing_workflows": _with(EV, CI)
    + f"""SELECT workflow_name, count(*) FILTER (conclusion = 'failure') AS failures,
  count(*) AS runs,
  round(avg(CASE WHEN conclusion = 'failure' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS failure_rate
FROM ci WHERE conclusion IN ('success', 'failure')
  AND created_at >= {AS_OF} - to_hours(168) AND created_at < {AS_OF}
GROUP BY 1 HAVING count(*) >= 2
ORDER BY avg(CASE WHEN conclusion = 'failure' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) DESC,
  failures DESC, workflow_name LIMIT 5""",
    "failing_workflows_by_repo": _with(EV, CI)
    + f"""SELECT repo, workflow_name, failures, runs, round(rate, 6) AS failure_rate,
  CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY repo ORDER BY rate DESC, failures DESC, workflow_name)
    AS rank FROM (
    SELECT repo, workflow_name, count(*) FILTER (conclusion = 'failure') AS failures,
      count(*) AS runs,
      avg(CASE WHEN conclusion = 'failure' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS rate
    FROM ci WHERE conclusion IN ('success', 'failure')
      AND created_at >= {AS_OF} - to_hours(720) AND created_at < {AS_OF}
    GROUP BY ALL HAVING count(*) >= 2))
WHERE rank <= 3""",
    "merge_hours_windows": _with(EV, merges())
    + """SELECT scope, repo_name, round(recent_avg_merge_hours, 6) AS recent_avg_merge_hours,
  recent_merged, round(baseline_avg_merge_hours, 6) AS baseline_avg_merge_hours, baseline_merged
FROM pr_r""",
    "event_rate_windows": _with(EV, pushes())
    + """SELECT scope, repo_name, round(recent_pushes_per_hour, 6) AS recent_pushes_per_hour,
  recent_pushes, round(baseline_pushes_per_hour, 6) AS baseline_pushes_per_hour, baseline_pushes
FROM push_r""",
    "merged_recent": _with(EV)
    + f"""SELECT CASE WHEN k % 10 <> 9 THEN event_id END AS pr_number,
  'Change ' || number AS title, actor_login, created_at AS merged_at
FROM ev WHERE event_type = 'PullRequestEvent' AND k % 4 = 0
  AND created_at >= {AS_OF} - to_hours(24) AND created_at < {AS_OF}
ORDER BY created_at DESC, event_id LIMIT 10""",
    "merged_recent_by_repo": _with(EV)
    + f"""SELECT repo_name, pr_number, title, actor_login, merged_at, CAST(rank AS INTEGER) AS rank
FROM (SELECT repo_name, CASE WHEN k % 10 <> 9 THEN event_id END AS pr_number,
    'Change ' || number AS title, actor_login, created_at AS merged_at,
    row_number() OVER (PARTITION BY repo_name ORDER BY created_at DESC, event_id) AS rank
  FROM ev WHERE event_type = 'PullRequestEvent' AND k % 4 = 0
    AND created_at >= {AS_OF} - to_hours(168) AND created_at < {AS_OF})
WHERE rank <= 3""",
    "rule_failure_spike": _with(EV, CI, ci_rates(AS_OF, 6), spike(AS_OF, 6))
    + "SELECT * FROM spike",
    "rule_merge_stretch": _with(EV, merges(AS_OF, 48, 336), stretch(AS_OF, 48))
    + "SELECT * FROM stretch",
    "rule_drought": _with(
        EV, pushes(f"({AS_OF} + to_hours(22))"), drought(f"({AS_OF} + to_hours(22))")
    )
    + "SELECT * FROM drought",
    "all_anomalies": "\nUNION ALL\n".join(_anomalies_at(*times) for times in RULE_TIMES),
    "anomaly_sweep": ALL_ANOMALIES,
    "repo_anomalies": "\nUNION ALL\n".join(
        _anomalies_at(
            *times, {"spike": "repo IS NULL", "stretch": "repo = 'org/repo-3'", "drought": "repo = 'org/repo-3'"}
        )
        for times in RULE_TIMES
    ),
    "health_signal": _with(EV, CI, ci_rates(), merges(), pushes())
    + """SELECT scope, nullif(key, '') AS repo_name,
  CASE WHEN rate IS NULL THEN 'unknown' WHEN rate >= 0.35 THEN 'alert' WHEN rate >= 0.15 THEN 'warn'
    ELSE 'ok' END AS ci_status,
  CASE WHEN hours IS NULL OR base_hours IS NULL OR base_hours <= 0 THEN 'unknown'
    WHEN hours / base_hours >= 3 THEN 'alert' WHEN hours / base_hours >= 1.5 THEN 'warn'
    ELSE 'ok' END AS pr_status,
  CASE WHEN coalesce(push_base, 0) < 1 THEN 'unknown' WHEN push / push_base < 0.15 THEN 'alert'
    WHEN push / push_base < 0.5 THEN 'warn' ELSE 'ok' END AS cadence_status,
  coalesce(runs, 0) AS ci_runs, round(coalesce(push, 0), 6) AS pushes_per_hour,
  round(rate, 6) AS ci_rate, CASE WHEN rate IS NOT NULL THEN round(base_rate, 6) END AS ci_baseline,
  round(hours, 6) AS merge_hours,
  CASE WHEN hours IS NOT NULL AND base_hours > 0 THEN round(base_hours, 6) END AS merge_baseline,
  CASE WHEN push_base >= 1 THEN round(push_base, 6) END AS pushes_baseline,
  'Based on CI/PR/commit signals — not a live production health check' AS caption
FROM (SELECT scope, coalesce(repo_name, '') AS key, recent_failure_rate AS rate, recent_runs AS runs,
      baseline_failure_rate AS base_rate FROM ci_r)
FULL JOIN (SELECT scope, coalesce(repo_name, '') AS key, recent_avg_merge_hours AS hours,
      baseline_avg_merge_hours AS base_hours FROM pr_r) USING (scope, key)
FULL JOIN (SELECT scope, coalesce(repo_name, '') AS key, recent_pushes_per_hour AS push,
      baseline_pushes_per_hour AS push_base FROM push_r) USING (scope, key)""",
    "snapshot_text": SNAP_CTES
    + f"""SELECT scope, repo, concat_ws(chr(10),
  'Live pipeline snapshot — ' || repo || ', last 24h (computed, not generated)',
  CASE WHEN rate IS NULL THEN 'CI: no workflow-run data in the window'
    ELSE 'CI failure rate: ' || {_pct('rate')} || ' over ' || runs || ' runs' ||
      CASE WHEN base IS NULL THEN '' ELSE ' (baseline ' || {_pct('base')} || ')' END END,
  workflows, coalesce(merges, 'PRs merged in the window: none observed in the stream yet'),
  'Push rate: ' || {_one('coalesce(push, 0)')} || '/h' || CASE WHEN coalesce(push_base, 0) > 0
    THEN ' (baseline ' || {_one('push_base')} || '/h)' ELSE '' END) AS text
FROM snap""",
    "snapshot_anomaly": SNAP_CTES
    + f"""SELECT 'ci_failure_spike' AS type,
  'CI snapshot: ' || {_pct('rate')} || ' failure rate (' || runs || ' runs)' AS title,
  CASE WHEN rate >= 0.35 THEN 'high' WHEN rate >= 0.15 THEN 'medium' ELSE 'low' END AS severity,
  'Manually triggered snapshot of ' || repo || '''s current CI state over the last 24h — ' ||
    'real data, not a detected anomaly.' || coalesce(worst, '') AS description,
  repo, true AS is_demo,
  'snap-' || substr(sha1(concat_ws(':', scope, repo, epoch_us({AS_OF}))), 1, 8) AS anomaly_id,
  round(rate, 6) AS recent_failure_rate, round(base, 6) AS baseline_failure_rate, CAST(runs AS DOUBLE) AS recent_runs
FROM snap WHERE rate IS NOT NULL AND runs > 0""",
    "freshness": """SELECT max(ts) AS latest_event_at, max(ts) AS latest_ci_run_at,
  (SELECT count(*) FROM documents) AS case_count,
  (SELECT count(*) FROM documents) > 0 AS kb_ready FROM events""",
    "anomaly_merge": _with(EV, ANOMALY_ROWS)
    + """SELECT anomaly_id, title, repo, n,
  day + to_hours(CASE WHEN repo < 'org/repo-5' THEN 1 ELSE 2 END) AS detected_at FROM anomaly_rows""",
    "anomaly_lookup": _with(EV, ANOMALY_ROWS)
    + """SELECT repo, CAST(sum(n) AS BIGINT) AS n, count(*) AS anomalies FROM anomaly_rows GROUP BY 1""",
    "flatten_events": _with(EV, RAW)
    + f"""SELECT raw_id AS event_id, CASE WHEN cut THEN '' ELSE event_type END AS event_type,
  CASE WHEN NOT cut AND user_id % 50 <> 49 THEN user_id END AS actor_id,
  CASE WHEN NOT cut AND user_id % 50 <> 49 THEN actor_login END AS actor_login,
  CASE WHEN NOT cut THEN repo_id END AS repo_id,
  CASE WHEN cut THEN '' ELSE repo_name END AS repo_name,
  CASE WHEN NOT cut THEN true END AS public, stored_at AS created_at, {STAMP} AS ingested_at,
  NOT cut AND NOT (event_type = 'ForkEvent' AND k % 10 = 5) AS has_payload FROM raw""",
    "validate_push": _metric(
        "PushEvent",
        f"""{_text(COMMITS)} AS commit_count,
  CASE k % 10 WHEN 1 THEN 'main' WHEN 2 THEN 'v1' ELSE 'topic-' || k END AS branch,
  {_text('k % 10 = 1')} AS is_default_branch,
  CASE WHEN k % 6 <> 0 THEN {_text('k // 2')} ELSE {_text(COMMITS)} END AS distinct_size""",
    ),
    "validate_pull_request": _metric(
        "PullRequestEvent",
        f"""CASE WHEN k % 2 = 0 THEN 'closed' ELSE 'opened' END AS action, event_id AS pr_number,
  {_text('k % 4 = 0')} AS is_merged, {_text('k % 3 = 0')} AS is_draft, 'main' AS target_branch,
  {_text('k')} AS additions, {_text('k // 2')} AS deletions, {_text('k % 5')} AS changed_files""",
    ),
    "validate_issues": _metric(
        "IssuesEvent",
        f"""CASE WHEN k % 5 = 1 THEN 'closed' ELSE 'opened' END AS action, event_id AS issue_number,
  {_text('k % 5 = 1')} AS is_closed, {_text('k % 3')} AS label_count,
  CASE WHEN k % 7 <> 0 THEN {_text('k')} ELSE '0' END AS comment_count""",
    ),
    "validate_fork": _metric(
        "ForkEvent",
        f"""'fork/repo-' || k AS fork_full_name, actor_login AS fork_owner,
  {_text('k % 4 = 1')} AS is_private""",
    ),
    "validate_create": _metric(
        "CreateEvent",
        f"""CASE k % 8 WHEN 0 THEN 'branch' WHEN 2 THEN 'tag' ELSE 'repository' END AS ref_type,
  CASE WHEN k % 3 = 0 THEN 'v1.' || k ELSE 'release-' || k END AS ref_name,
  {_text('k % 8 = 2')} AS is_tag, {_text('k % 8 = 2 AND k % 3 = 0')} AS is_semver_tag""",
    ),
    "validate_watch": _metric("WatchEvent", "'started' AS action"),
    "validate_default": """SELECT event_type, CASE WHEN user_id % 50 = 49
    THEN '[default] id='''': required field missing: ''id''' END AS error_reason,
  count(*) AS n FROM events GROUP BY ALL""",
    "dead_letter": _with(EV, RAW)
    + """SELECT raw_id AS event_id, raw_type AS event_type, error_reason FROM raw WHERE NOT ok""",
    "dead_letter_latest": _with(EV, RAW)
    + f"""SELECT raw_id AS event_id, raw_type AS event_type, error_reason,
  {STAMP} + to_seconds(number) AS failed_at FROM raw WHERE NOT ok
ORDER BY failed_at DESC, event_id LIMIT 20""",
    "partition_route": _with(EV, RAW)
    + f"SELECT event_id, {ROUTED_DATE} AS date FROM raw WHERE ok",
    "dedupe_first": _with(EV, RAW)
    + "SELECT event_id, true AS public, number AS position FROM raw WHERE ok",
    "dedupe_stored": _with(EV, RAW)
    + "SELECT event_id, event_type FROM raw WHERE ok AND event_type <> 'PushEvent'",
    "stream_ingest": _with(EV, RAW)
    + f"""SELECT event_id, event_type, user_id AS actor_id, actor_login, repo_name,
  stored_at AS created_at, {ROUTED_DATE} AS date FROM raw WHERE ok""",
    "stream_dead_letters": _with(EV, RAW)
    + """SELECT raw_type AS event_type, error_reason, 2 * count(*) AS n FROM raw WHERE NOT ok
GROUP BY ALL""",
    "ingest_counters": _with(EV, RAW)
    + f"""SELECT 3 * count(*) AS received, 3 * count(*) FILTER (NOT ok) AS dead_lettered,
  CAST(0 AS BIGINT) AS skipped, count(*) FILTER (ok) AS duplicate_in_batch,
  count(*) FILTER (ok) AS already_stored,
  2 * count(*) FILTER (ok AND {ROUTED_DATE} = 'late') AS late, count(*) FILTER (ok) AS written FROM raw""",
    "stream_metrics": _with(EV, RAW)
    + """SELECT event_type, count(*) AS events, CAST(0 AS BIGINT) AS with_type_key
FROM raw WHERE ok GROUP BY 1""",
    "metric_refresh": _with(EV, RAW)
    + f"""SELECT event_type, event_count, total, round(pct, 6) AS pct,
  greatest(1, CAST(floor(pct / 5) AS INTEGER)) AS bar FROM (
  SELECT *, CAST(sum(event_count) OVER () AS BIGINT) AS total,
    event_count / sum(event_count) OVER ()::DOUBLE * 100 AS pct
  FROM (SELECT event_type, count(*) AS event_count FROM raw
        WHERE ok AND stored_at >= {STAMP} - to_days(7) GROUP BY 1))""",
    "jsonl_roundtrip": _with(EV, RAW)
    + f"""SELECT raw_id AS event_id, CASE WHEN cut THEN '' ELSE event_type END AS event_type,
  CASE WHEN NOT cut AND user_id % 50 <> 49 THEN user_id END AS actor_id,
  CASE WHEN cut THEN '' ELSE repo_name END AS repo_name, stored_at AS created_at,
  {ROUTED_DATE} AS date FROM raw""",
    "json_lines_text": _with(EV)
    + """SELECT event_id, strftime(created_at, '%Y-%m-%dT%H:%M:%S.%fZ') AS created_at, actor_login
FROM ev""",
    "compact_partitions": _with(EV)
    + """SELECT 'date=' || day AS partition, files = 1 AS skipped, files AS files_before,
  CAST(1 AS BIGINT) AS files_after, CASE WHEN files = 1 THEN 0 ELSE n END AS rows FROM (
  SELECT strftime(created_at, '%Y-%m-%d') AS day, count(DISTINCT event_type) AS files,
    count(*) AS n FROM ev GROUP BY 1)""",
    "compacted_table": _with(EV)
    + """SELECT strftime(created_at, '%Y-%m-%d') AS date, event_type, count(*) AS n,
  count(DISTINCT event_id) AS ids FROM ev GROUP BY ALL""",
    "compaction_totals": _with(EV)
    + """SELECT count(*) FILTER (files > 1) AS compacted, count(*) FILTER (files = 1) AS skipped,
  CAST(sum(CASE WHEN files > 1 THEN n ELSE 0 END) AS BIGINT) AS total_rows FROM (
  SELECT strftime(created_at, '%Y-%m-%d') AS day, count(DISTINCT event_type) AS files,
    count(*) AS n FROM ev GROUP BY 1)""",
    "list_partitions": "SELECT DISTINCT 'date=' || strftime(ts, '%Y-%m-%d') AS partition FROM events",
    "dlq_replay": _with(EV, RAW)
    + """SELECT CASE WHEN ok THEN event_type ELSE raw_type END AS event_type, ok, count(*) AS n
FROM raw GROUP BY ALL""",
    "backfill_partitions": """SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS n,
  count(*) AS without_public FROM events GROUP BY 1""",
    "schema_evolution": _with(EV)
    + """SELECT event_type, count(*) AS n,
  CASE WHEN event_type = 'PushEvent' THEN 0 ELSE count(*) END AS with_public,
  CASE WHEN event_type = 'PushEvent' THEN 0 ELSE count(*) END AS with_repo_id
FROM ev GROUP BY 1""",
    "ci_runs_build": _with(EV, CI) + "SELECT * FROM ci",
    "ci_runs_newest": _with(EV, CI)
    + """SELECT run_id, repo, created_at FROM ci
QUALIFY row_number() OVER (PARTITION BY repo ORDER BY created_at DESC, run_id) <= 20""",
    "ci_latest_run": "SELECT max(ts) AS latest FROM events",
    "kb_cases": _with(KB)
    + """SELECT case_id, kind, number, title, body_snippet, url,
  array_to_string(labels, ',') AS labels, created_at, closed_at,
  round(time_to_resolve_hours, 6) AS time_to_resolve_hours FROM kb""",
    "revert_linkage": _with(KB)
    + "SELECT case_id, is_revert, reverts_number, was_reverted, reverted_by FROM kb",
    "build_totals": _with(KB)
    + """SELECT count(*) AS total, count(DISTINCT reverts_number) AS reverts,
  count(*) FILTER (was_reverted) AS linked FROM kb""",
    "case_count": "SELECT count(*) AS case_count FROM documents",
    "case_text": _with(KB) + f"SELECT case_id, {CASE_TEXT} AS text FROM kb",
    "label_pluck": _with(KB)
    + "SELECT label, count(*) AS n FROM (SELECT unnest(labels) AS label FROM kb) GROUP BY 1",
    "newest_items": """SELECT doc_id AS position FROM documents
QUALIFY row_number() OVER (PARTITION BY CASE WHEN doc_id % 10 < 7 THEN 'busy'
  ELSE 'quiet-' || doc_id % 3 END ORDER BY doc_id DESC) <= 50""",
    "hash_embed": _with(KB)
    + f""", texts AS (SELECT case_id, {CASE_TEXT} AS text FROM kb),
digests AS (
  SELECT case_id, string_agg(sha256(k || ':' || text), '' ORDER BY k) AS hex
  FROM texts, (SELECT unnest(range(64)) AS k) GROUP BY case_id
),
words AS (
  SELECT case_id, i, CAST('0x' || substr(hex, i * 8 + 1, 8) AS BIGINT) / 2147483648.0::DOUBLE
    - 1.0::DOUBLE AS v
  FROM digests, (SELECT CAST(unnest(range(512)) AS INTEGER) AS i)
),
unit AS (
  SELECT case_id, i, CAST(CAST(v / sqrt(sum(v * v) OVER (PARTITION BY case_id)) AS FLOAT) AS DOUBLE) AS v
  FROM words
)
SELECT case_id, count(*) AS dims, round(sum(v * (i % 7 + 1)), 3) AS weighted, round(min(v), 5) AS least,
  round(max(v), 5) AS most, round(max(v) FILTER (i = 511), 5) AS last
FROM unit GROUP BY case_id""",
    "knowledge_build": _with(KB)
    + "SELECT kind, count(*) AS n, 512 * count(*) AS dims FROM kb GROUP BY 1",
    "cosine_topk": TOPK,
    "index_neighbors": TOPK,
    "approx_recall": """
SELECT count(*) AS n_queries, CAST(sum(least(5, n)) AS BIGINT) AS n_pairs, true AS recall_reached
FROM embeddings, (SELECT count(*) AS n FROM embeddings) WHERE vec_id % 100 = 0
""",
    "corpus_join": _with(KB)
    + """SELECT case_id, kind, CAST(len(e.embedding) AS INTEGER) AS dim
FROM kb JOIN embeddings e ON e.vec_id = kb.number""",
    "outcome_estimate": _with(KB, matches(5, CASE_CORPUS), estimate(FOUND_CASES, "query_id"))
    + """SELECT e.vec_id AS query_id, coalesce(sample_size, 0) AS sample_size,
  coalesce(pr_count, 0) AS pr_count, round(revert_rate, 6) AS revert_rate,
  round(avg_time_to_resolve_hours, 6) AS avg_time_to_resolve_hours,
  coalesce(severity_labels, '') AS severity_labels,
  CASE WHEN coalesce(sample_size, 0) = 0 THEN 'insufficient' WHEN sample_size < 3 THEN 'weak'
    ELSE 'ok' END AS evidence
FROM embeddings e LEFT JOIN numbers n ON n.query_id = e.vec_id
LEFT JOIN label_sets s ON s.query_id = e.vec_id""",
    "severity_labels": _with(KB, estimate("SELECT * FROM kb", "kind"))
    + "SELECT kind, severity_labels FROM label_sets",
    "outcomes_for_ids": _with(KB, estimate("SELECT * FROM kb WHERE kind = 'pr'", "kind"))
    + """SELECT sample_size, pr_count, round(revert_rate, 6) AS revert_rate,
  round(avg_time_to_resolve_hours, 6) AS avg_time_to_resolve_hours, severity_labels
FROM numbers JOIN label_sets USING (kind)""",
    "evidence_blocks": _with(KB, matches(3, CASE_CORPUS))
    + f"""SELECT query_id, CAST(rank - 1 AS INTEGER) AS i, {BLOCK} AS block
FROM found JOIN kb USING (case_id)""",
    "trimmed_cases": _with(KB, matches(3, CASE_CORPUS))
    + """SELECT query_id, rank, case_id, similarity_band, was_reverted,
  nullif(substr(body_snippet, 1, 200), '') AS snippet FROM found JOIN kb USING (case_id)""",
    "context_text": _with(KB, matches(2, CASE_CORPUS))
    + f"""SELECT query_id, concat_ws(chr(10) || chr(10), '## Subject' || chr(10) || 'subject ' || query_id,
  CASE WHEN query_id % 2 = 0 THEN '## Live pipeline evidence (computed from current stream/CI data — '
    || 'cite specific workflows and PR numbers from here)' || chr(10) || 'live ' || query_id END,
  '## Retrieved similar historical cases' || chr(10) ||
    string_agg({BLOCK}, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank)) AS context
FROM found JOIN kb USING (case_id) GROUP BY query_id""",
    "parse_output": """SELECT conv_id, turn,
  regexp_replace(CASE WHEN turn % 3 = 2 THEN '  ' || text || ' {broken' || chr(10) ELSE text END,
    '^\\s+|\\s+$', '', 'g') AS summary,
  CASE WHEN turn % 3 = 2 THEN '' ELSE 'Review,' || role END AS actions,
  CASE WHEN turn % 3 = 2 THEN 'low' WHEN turn % 2 = 0 THEN 'high' ELSE 'medium' END AS confidence
FROM conversations""",
    "diagnosis": _with(KB, matches(3, CASE_CORPUS), estimate(FOUND_CASES, "query_id"))
    + """, ids AS (SELECT query_id, string_agg(case_id, ',' ORDER BY rank) AS similar_cases,
  count(*) AS n FROM found GROUP BY 1)
SELECT i.query_id, 'subject ' || i.query_id AS subject, sample_size,
  CASE WHEN sample_size < 3 THEN 'weak' ELSE 'ok' END AS evidence, pr_count,
  round(revert_rate, 6) AS revert_rate, coalesce(severity_labels, '') AS severity_labels,
  similar_cases, CAST(n + 1 AS INTEGER) AS n_evidence,
  '[live pipeline snapshot]' || chr(10) || 'all calm' AS first_evidence
FROM ids i JOIN numbers USING (query_id) LEFT JOIN label_sets USING (query_id)""",
    "anomaly_diagnosis": _with(EV, ANOMALY_ROWS)
    + """SELECT anomaly_id, title AS subject, CAST(3 AS BIGINT) AS sample_size, 'ok' AS evidence
FROM anomaly_rows""",
    "eval_set": _with(KB)
    + """SELECT * FROM (SELECT regexp_replace(title, '^\\s+|\\s+$', '', 'g') AS query,
  case_id AS expected_case_id FROM kb) WHERE length(query) >= 15""",
    "eval_sample": _with(KB)
    + """SELECT * FROM (SELECT regexp_replace(title, '^\\s+|\\s+$', '', 'g') AS query,
  case_id AS expected_case_id FROM kb) WHERE length(query) >= 15
ORDER BY md5('42:' || expected_case_id), expected_case_id LIMIT 50""",
    "recall_mrr": _with(EVAL)
    + """SELECT count(*) AS n,
  round_even(avg(CASE WHEN rank <= 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 4) AS recall_at_1,
  round_even(avg(CASE WHEN rank <= 3 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 4) AS recall_at_3,
  round_even(avg(CASE WHEN rank <= 5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 4) AS recall_at_5,
  round_even(avg(coalesce(1.0::DOUBLE / rank, 0.0::DOUBLE)), 4) AS mrr FROM ranks""",
    "eval_ranks": _with(EVAL) + "SELECT query_id, expected_case_id, rank FROM ranks",
}
ORACLE["format_comparison"] = "\nUNION ALL\n".join(
    f"SELECT '{name.removeprefix('bench_')}' AS query, count(*) AS n_rows, true AS same FROM ({sql})"
    for name, sql in ORACLE.items()
    if name.startswith("bench_q")
)

ORACLE["metric_refresh_hourly"] = ORACLE["metric_refresh"].replace(
    "to_days(7)", "to_days(7) - to_minutes(25)"
)
ORACLE["top_entities_sketch"] = _with(EV) + f"""SELECT repo_name, count(*) AS event_count, max(created_at) AS last_seen_at,
  true AS actors_close FROM ev WHERE created_at >= {STAMP} - to_days(40) - to_minutes(25)
GROUP BY 1 ORDER BY event_count DESC, repo_name LIMIT 10"""
ORACLE["rolled_dead_letters"] = ORACLE["stream_dead_letters"]
ORACLE["partition_files"] = _with(EV) + """SELECT partition, CASE WHEN i <= total // 2 THEN 1 ELSE files END AS files, n AS rows FROM (
  SELECT 'date=' || strftime(created_at, '%Y-%m-%d') AS partition, count(DISTINCT event_type) AS files, count(*) AS n,
    row_number() OVER (ORDER BY partition) AS i, count(*) OVER () AS total
  FROM ev GROUP BY 1)"""
