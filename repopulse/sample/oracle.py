"""DuckDB SQL for each registered query, over the same sample records.

Dates and timestamps are compared as ISO text, so no engine's own rendering matters.
"""

from __future__ import annotations

from repopulse.sample.adapter import (
    BAD_MEASURES,
    FEW,
    FULL,
    GAPS,
    MANY,
    SPOILT,
    TIMED_GAPS,
    TIMED_PULL_REQUESTS,
    field_expressions,
)
from repopulse.sources.layout import LAYOUT, TABLES, Staged, raw_schema

AS_OF = "2001-07-31"
_SQL_TYPES = {"bigint": "BIGINT", "long": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN"}
_ISO = "%Y-%m-%dT%H:%M:%SZ"


def _raw(view: tuple) -> str:
    """Select of a raw-shaped table, timestamps as ISO text."""
    table, source, _ = view
    expressions = field_expressions(view, f"strftime({{}}, '{_ISO}')")
    columns = []
    for field in raw_schema(table, "string"):
        kind = _SQL_TYPES[field.dataType.simpleString()]
        columns.append(f"CAST({expressions.get(field.name, 'NULL')} AS {kind}) AS \"{field.name}\"")
    return f"SELECT {', '.join(columns)} FROM {source}"


def _staged_column(column: Staged) -> str:
    value = f'"{column.field}"'
    if column.path:
        value = f"json_extract_string({value}, '{column.path}')"
    if column.kind == "counter":
        value = f"CAST(coalesce({value}, 0) AS BIGINT)"
    elif column.kind == "timestamp":
        value = f"CAST({value} AS TIMESTAMP)"
    else:
        value = f"CAST({value} AS {_SQL_TYPES[column.kind]})"
    return f"{value} AS {column.name}"


def _staged(views: dict, *names: str) -> str:
    """WITH items for staged tables."""
    items = []
    for name in names:
        columns = ", ".join(_staged_column(column) for column in LAYOUT[views[name][0]])
        items.append(f"{name} AS (SELECT {columns} FROM ({_raw(views[name])}))")
    return ", ".join(items)


def _stage_query(views: dict, name: str) -> str:
    times = ", ".join(
        f"strftime({column.name}, '{_ISO}') AS {column.name}"
        for column in LAYOUT[name]
        if column.kind == "timestamp"
    )
    return f"WITH {_staged(views, name)} SELECT * REPLACE ({times}) FROM {name}"


_ISSUE_DAYS = """issue_days AS (
    SELECT repo_name AS repo, CAST(issue_created_at AS DATE) AS day, count(*) AS opened
    FROM issues GROUP BY ALL)"""
_PR_DAYS = """pr_days AS (
    SELECT repo_name AS repo, CAST(pr_created_at AS DATE) AS day, count(*) AS opened,
           count(pr_merged_at) AS merged
    FROM pull_requests GROUP BY ALL)"""
_COMMENT_DAYS = """comment_days AS (
    SELECT repo_name AS repo, CAST(comment_created_at AS DATE) AS day, count(*) AS written
    FROM comments GROUP BY ALL)"""
# Every record as one row of its key and what it counts for, without which the key has zeros.
_RECORDS = """records AS (
    SELECT repo_name AS repo, CAST(issue_created_at AS DATE) AS on_day, 'issue' AS kind FROM issues
    UNION ALL SELECT repo_name, CAST(pr_created_at AS DATE), 'pr' FROM pull_requests
    UNION ALL SELECT repo_name, CAST(pr_created_at AS DATE), 'merged' FROM pull_requests WHERE pr_merged_at IS NOT NULL
    UNION ALL SELECT repo_name, CAST(comment_created_at AS DATE), 'comment' FROM comments)"""


def _tally(kind: str, name: str) -> str:
    # A key with a NULL in it is equal to nothing, so its records belong to no row.
    own = f"kind = '{kind}' AND repo IS NOT NULL AND on_day IS NOT NULL"
    return f"count(CASE WHEN {own} THEN 1 END) AS {name}"


_TALLIES = ", ".join(
    _tally(kind, name)
    for kind, name in (
        ("issue", "issues_created"),
        ("pr", "prs_created"),
        ("merged", "prs_merged"),
        ("comment", "comments_created"),
    )
)
_DAILY = f"""daily AS (
    SELECT listed.repo_id, listed.repo_full_name, keys.on_day AS day, issues_created, prs_created,
           prs_merged, comments_created
    FROM (SELECT repo, on_day, {_TALLIES} FROM records GROUP BY repo, on_day) keys
    LEFT JOIN repositories listed ON listed.repo_full_name = keys.repo)"""
_MEASURES = ("issues_created", "prs_created", "prs_merged", "comments_created")


def _sums(suffix: str = "") -> str:
    return ", ".join(f"CAST(sum({m}) AS BIGINT) AS {m}{suffix}" for m in _MEASURES)


def _with_daily(views: dict) -> str:
    staged = _staged(views, "issues", "pull_requests", "comments", "repositories")
    return f"WITH {staged}, {_RECORDS}, {_DAILY}"


def _daily(views: dict) -> str:
    return f"{_with_daily(views)} SELECT * REPLACE (CAST(day AS VARCHAR) AS day) FROM daily"


def _recent(as_of: str) -> str:
    return f"SELECT repo_full_name, {_sums('_30d')} FROM daily WHERE day >= DATE '{as_of}' - 30 GROUP BY ALL"


def _stats(views: dict, as_of: str = AS_OF) -> str:
    zeroed = ", ".join(f"ifnull({m}_30d, 0) AS {m}_30d" for m in _MEASURES)
    return f"""{_with_daily(views)}, recent AS ({_recent(as_of)})
    SELECT repo_id, repo_full_name, language, stargazers_count, forks_count, open_issues_count,
           strftime(repo_created_at, '{_ISO}') AS repo_created_at,
           strftime(repo_updated_at, '{_ISO}') AS repo_updated_at, {zeroed}
    FROM repositories LEFT JOIN recent USING (repo_full_name)"""


def _counts(name: str, days: str, columns: str, views: dict = FEW) -> str:
    table = days.split(" ", 1)[0]
    return (
        f"WITH {_staged(views, name)}, {days}"
        f" SELECT repo AS repo_full_name, CAST(day AS VARCHAR) AS day, {columns} FROM {table}"
    )


def _check(check: str, relation: str, key: str, severity: str, failures: str) -> str:
    return (
        f"SELECT '{check}' AS \"check\", '{relation}' AS relation, '{key}' AS key,"
        f" '{severity}' AS severity, CAST(({failures}) AS BIGINT) AS failures"
    )


def _readable(name: str) -> str:
    """The staged rows of a table whose landed lines are whole; the first staged column is the id."""
    return f"{_stage_query(FULL, name)} WHERE NOT ({SPOILT.replace('id', LAYOUT[name][0].name)})"


def _unreadable(*names: str) -> str:
    rows = [
        f"SELECT '{name}' AS relation, 'unreadable_records' AS \"check\", 'record' AS key, 'warn' AS severity,"
        f" count(*) AS failures, count(*) AS put_aside FROM ({_raw(FULL[name])}) WHERE {SPOILT} HAVING count(*) > 0"
        for name in names
    ]
    return " UNION ALL ".join(rows)


def _null_keys(views: dict = FEW) -> str:
    keys = {
        "issues": ("repo_name", "issue_created_at"),
        "pull_requests": ("repo_name", "pr_created_at"),
        "comments": ("repo_name", "comment_created_at"),
    }
    rows = [
        _check("null_keys", table, key, "warn", f"SELECT count(*) FROM {table} WHERE {key} IS NULL")
        for table, columns in keys.items()
        for key in columns
    ]
    return f"WITH {_staged(views, *keys)} " + " UNION ALL ".join(rows)


def _duplicate_keys(views: dict = FEW) -> str:
    def repeated(table: str, keys: str) -> str:
        present = " AND ".join(f"{key} IS NOT NULL" for key in keys.split(", "))
        return f"SELECT count(*) FROM (SELECT {keys} FROM {table} WHERE {present} GROUP BY ALL HAVING count(*) > 1)"

    rows = [
        _check("duplicate_keys", "repositories", "repo_full_name", "error", repeated("repositories", "repo_full_name")),
        _check(
            "duplicate_keys",
            "repo_daily_activity",
            "repo_full_name,day",
            "error",
            repeated("daily", "repo_full_name, day"),
        ),
        _check("duplicate_keys", "comments", "comment_id", "warn", repeated("comments", "comment_id")),
    ]
    return f"{_with_daily(views)} " + " UNION ALL ".join(rows)


def _orphans(views: dict = FEW) -> str:
    tables = ("issues", "pull_requests", "comments")
    rows = [
        _check(
            "orphans",
            table,
            "repo_name",
            "warn",
            f"SELECT count(*) FROM {table} WHERE repo_name IS NOT NULL AND NOT EXISTS"
            f" (SELECT 1 FROM repositories WHERE repo_full_name = {table}.repo_name)",
        )
        for table in tables
    ]
    return f"WITH {_staged(views, *tables, 'repositories')} " + " UNION ALL ".join(rows)


_MEASURE_TESTS = {**{m: f"{m} < 0" for m in _MEASURES}, "prs_merged<=prs_created": "prs_merged > prs_created"}


def _bad_measures(views: dict = FEW) -> str:
    rows = [
        _check("bad_measures", "repo_daily_activity", key, "error", f"SELECT count(*) FROM daily WHERE {test}")
        for key, test in _MEASURE_TESTS.items()
    ]
    return f"{_with_daily(views)} " + " UNION ALL ".join(rows)


def _bad_measures_gaps() -> str:
    columns = ", ".join(f"{value} AS {name}" for name, value in BAD_MEASURES.items())
    rows = [
        _check("bad_measures", "orders", key, "error", f"SELECT count(*) FROM bad WHERE {test}")
        for key, test in _MEASURE_TESTS.items()
    ]
    return f"WITH bad AS (SELECT {columns} FROM orders) " + " UNION ALL ".join(rows)


def _gate() -> str:
    """Checks of all three kinds on the records with gaps, and whether each stops a run."""
    parts = [
        f"SELECT * FROM ({sql}) q{n}"
        for n, sql in enumerate((_null_keys(GAPS), _orphans(GAPS), _duplicate_keys(GAPS), _bad_measures_gaps()))
    ]
    rows = " UNION ALL ".join(parts)
    return f"SELECT *, severity = 'error' AND failures > 0 AS stops FROM ({rows}) every_check"


def _refresh_checks() -> str:
    """The checks of a refresh name the keys as the counts do."""
    names = {"repo_name": "repo_full_name", "issue_created_at": "day", "pr_created_at": "day", "comment_created_at": "day"}
    cases = " ".join(f"WHEN '{key}' THEN '{name}'" for key, name in names.items())
    parts = [
        f"SELECT * REPLACE (CASE key {cases} ELSE key END AS key) FROM ({sql}) q{n}"
        for n, sql in enumerate((_null_keys(GAPS), _orphans(GAPS), _duplicate_keys(GAPS), _bad_measures(GAPS)))
    ]
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) every_check WHERE relation <> 'comments' OR \"check\" <> 'duplicate_keys'"


def _both_marts() -> str:
    return f"""SELECT s.repo_full_name, s.prs_created_30d, s.comments_created_30d, d.prs_created, d.comments_created
    FROM ({_stats(FEW)}) s LEFT JOIN (
        SELECT repo_full_name, CAST(sum(prs_created) AS BIGINT) AS prs_created,
               CAST(sum(comments_created) AS BIGINT) AS comments_created
        FROM ({_daily(FEW)}) days GROUP BY repo_full_name) d ON s.repo_full_name = d.repo_full_name"""


def _lead_time(view: tuple) -> str:
    return f"""WITH {_staged({"pull_requests": view}, "pull_requests")}, lead AS (
    SELECT repo_name, epoch(pr_merged_at)::BIGINT - epoch(pr_created_at)::BIGINT AS seconds
    FROM pull_requests WHERE pr_merged_at IS NOT NULL AND pr_created_at IS NOT NULL AND repo_name IS NOT NULL)
SELECT repo_name AS repo_full_name, count(*) AS prs_merged,
       CAST(sum(seconds) AS DOUBLE) / count(*) / 3600 AS mean_hours,
       quantile_cont(seconds, 0.5) / 3600 AS median_hours
FROM lead GROUP BY ALL"""


def _top(views: dict = FEW) -> str:
    return (
        f"{_with_daily(views)} SELECT repo_full_name, CAST(sum(prs_created) AS BIGINT) AS prs_created"
        " FROM daily WHERE repo_full_name IS NOT NULL GROUP BY ALL ORDER BY prs_created DESC, repo_full_name LIMIT 5"
    )


def _spine(views: dict = FEW) -> str:
    return f"""WITH {_staged(views, "issues", "pull_requests", "comments")},
    {_RECORDS} SELECT DISTINCT repo AS repo_full_name, CAST(on_day AS VARCHAR) AS day FROM records"""


def _time_series(views: dict = FEW) -> str:
    return f"""{_with_daily(views)} SELECT CAST(day AS VARCHAR) AS day, {_sums()}
    FROM daily WHERE daily.day IS NOT NULL GROUP BY daily.day ORDER BY 1"""


def _backlog(views: dict = FEW) -> str:
    return f"""WITH {_staged(views, "issues")}, changes AS (
        SELECT repo_name, CAST(issue_created_at AS DATE) AS day, 1 AS opened, 0 AS closed FROM issues
        UNION ALL
        SELECT repo_name, CAST(issue_closed_at AS DATE), 0, 1 FROM issues),
    per_day AS (
        SELECT repo_name, day, CAST(sum(opened) AS BIGINT) AS opened, CAST(sum(closed) AS BIGINT) AS closed
        FROM changes WHERE repo_name IS NOT NULL AND day IS NOT NULL GROUP BY ALL)
    SELECT repo_name AS repo_full_name, CAST(day AS VARCHAR) AS day, opened, closed,
           CAST(sum(opened - closed) OVER (PARTITION BY repo_name ORDER BY day) AS BIGINT) AS backlog
    FROM per_day"""


def _contributors(views: dict = FEW) -> str:
    return f"""WITH {_staged(views, "issues", "pull_requests", "comments")}, acts AS (
        SELECT repo_name, author_login AS login, issue_created_at AS moment, 'issue' AS kind FROM issues
        UNION ALL SELECT repo_name, author_login, pr_created_at, 'pr' FROM pull_requests
        UNION ALL SELECT repo_name, commenter_login, comment_created_at, 'comment' FROM comments)
    SELECT repo_name AS repo_full_name, login, count(*) FILTER (kind = 'issue') AS issues,
           count(*) FILTER (kind = 'pr') AS prs, count(*) FILTER (kind = 'comment') AS comments,
           strftime(min(moment), '%Y-%m-%d') AS first_day, strftime(max(moment), '%Y-%m-%d') AS last_day
    FROM acts WHERE repo_name IS NOT NULL GROUP BY ALL"""


def _rolling(views: dict = FEW) -> str:
    rolled = ", ".join(f"CAST(sum({m}) OVER recent_days AS BIGINT) AS {m}_30d" for m in _MEASURES)
    return f"""{_with_daily(views)}, named AS (
        SELECT repo_full_name, day, {_sums()} FROM daily
        WHERE repo_full_name IS NOT NULL AND daily.day IS NOT NULL GROUP BY ALL)
    SELECT repo_full_name, CAST(day AS VARCHAR) AS day, {rolled} FROM named
    WINDOW recent_days AS (PARTITION BY repo_full_name ORDER BY day
                           RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND CURRENT ROW)"""


ORACLE = {
    "scan_raw_comments": _raw(FULL["comments"]),
    "scan_raw_issues": _raw(FULL["issues"]),
    "scan_raw_pull_requests": _raw(FULL["pull_requests"]),
    "scan_raw_repositories": _raw(FULL["repositories"]),
    "scan_raw_users": _raw(FULL["users"]),
    "raw_pass_through": " UNION ALL ".join(
        f"SELECT '{name}' AS relation, id, _airbyte_raw_id FROM ({_raw(view)})" for name, view in FEW.items()
    ),
    **{f"landed_json_{name}": _stage_query(FULL, name) for name in TABLES},
    "landed_json_bad_lines_issues": _readable("issues"),
    "landed_json_bad_lines_repositories": _readable("repositories"),
    "dq_unreadable_records": _unreadable("comments", "issues", "repositories"),
    "stored_variant_pull_requests": _stage_query(FULL, "pull_requests"),
    "stage_comments": _stage_query(FULL, "comments"),
    "stage_issues": _stage_query(FULL, "issues"),
    "stage_pull_requests": _stage_query(FULL, "pull_requests"),
    "stage_repositories": _stage_query(FULL, "repositories"),
    "stage_users": _stage_query(FULL, "users"),
    "registered_raw_repositories": _raw(FEW["repositories"]),
    "staging_view_comments": _stage_query(FULL, "comments"),
    "refreshed_staging_users": _stage_query(FEW, "users"),
    "issue_daily": _counts("issues", _ISSUE_DAYS, "opened AS issues_created"),
    "issue_daily_gaps": _counts("issues", _ISSUE_DAYS, "opened AS issues_created", GAPS),
    "pr_daily": _counts("pull_requests", _PR_DAYS, "opened AS prs_created, merged AS prs_merged"),
    "pr_daily_gaps": _counts("pull_requests", _PR_DAYS, "opened AS prs_created, merged AS prs_merged", GAPS),
    "comment_daily": _counts("comments", _COMMENT_DAYS, "written AS comments_created"),
    "comment_daily_gaps": _counts("comments", _COMMENT_DAYS, "written AS comments_created", GAPS),
    "activity_spine": _spine(),
    "activity_spine_gaps": _spine(GAPS),
    "repo_daily_activity": _daily(FEW),
    "repo_daily_activity_many_repos": _daily(MANY),
    "repo_daily_activity_gaps": _daily(GAPS),
    "repo_daily_activity_crowded_names": _daily(GAPS),
    "activity_trailing_30d": f"{_with_daily(FEW)} {_recent(AS_OF)}",
    "repo_current_stats": _stats(FEW),
    "repo_current_stats_many_repos": _stats(MANY),
    "repo_current_stats_gaps": _stats(GAPS),
    "bucketed_current_stats_many_repos": _stats(MANY),
    "bucketed_current_stats_gaps": _stats(GAPS),
    "activity_time_series": _time_series(),
    "activity_time_series_gaps": _time_series(GAPS),
    "top_repos_by_prs": _top(),
    "top_repos_by_prs_gaps": _top(GAPS),
    "published_time_series": _time_series(),
    "published_top_repos": _top(),
    "published_both_marts": _both_marts(),
    "published_kept_run": _time_series(),
    "published_one_repository": f"SELECT * FROM ({_daily(FEW)}) WHERE repo_full_name = 'NATION_7'",
    "dq_null_keys": _null_keys(),
    "dq_null_keys_gaps": _null_keys(GAPS),
    "dq_duplicate_keys": _duplicate_keys(),
    "dq_duplicate_keys_gaps": _duplicate_keys(GAPS),
    "dq_orphans": _orphans(),
    "dq_orphans_gaps": _orphans(GAPS),
    "dq_measures": _bad_measures(),
    "dq_measures_gaps": _bad_measures_gaps(),
    "dq_gate_gaps": _gate(),
    "dq_refresh_gaps": _refresh_checks(),
    "pr_lead_time": _lead_time(TIMED_PULL_REQUESTS),
    "pr_lead_time_gaps": _lead_time(TIMED_GAPS),
    "issue_backlog": _backlog(),
    "issue_backlog_gaps": _backlog(GAPS),
    "contributor_activity": _contributors(),
    "contributor_activity_gaps": _contributors(GAPS),
    "repo_rolling_30d": _rolling(),
    "repo_rolling_30d_gaps": _rolling(GAPS),
    "published_mart_roundtrip": _daily(FEW),
    "published_stats_roundtrip": _stats(FEW),
}
