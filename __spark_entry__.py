"""The registered queries, over the supplied tables in the shape of raw activity records.

Dates and timestamps leave these queries as ISO text; the library functions return them typed.
"""

from __future__ import annotations

import atexit
import contextlib
import functools
import os
import tempfile
import uuid
import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse import sinks
from repopulse.operators import activity, checks, staging
from repopulse.plans import dashboard, insights, layers, marts
from repopulse.plans.refresh import DAILY, STATS, count, refresh
from repopulse.sample.adapter import (
    FEW,
    FULL,
    GAPS,
    MANY,
    SPOILT,
    TIMED_GAPS,
    TIMED_PULL_REQUESTS,
    bad_daily,
    raw_tables,
    raw_view,
)
from repopulse.sample.oracle import AS_OF, ORACLE
from repopulse.session import apply_settings, scratch_dir
from repopulse.sources import landing
from repopulse.sources.layout import LAYOUT, TABLES
from repopulse.sources.readers import read_raw

try:
    from repopulse.llm import queries as llm
except ImportError as missing:  # the package, its pipeline or what they need may not be here
    if missing.name not in ("repopulse.llm", "corpus_pipeline"):
        warnings.warn(f"no text operators: {missing}", stacklevel=1)
    llm = None

# For sessions on this machine that name no shared folder.
LOCAL_SCRATCH = os.path.join(tempfile.gettempdir(), "repopulse-queries")

# Landed lines are packed; a packed file cannot be split, so its number of lines is bounded.
PACKED_LINES = {"compression": "gzip", "maxRecordsPerFile": 250_000}

Query = Callable[[SparkSession, str], DataFrame]


def iso(df: DataFrame) -> DataFrame:
    formats = {"date": "yyyy-MM-dd", "timestamp": "yyyy-MM-dd'T'HH:mm:ss'Z'"}
    return df.select(
        *[
            F.date_format(name, formats[kind]).alias(name) if kind in formats else F.col(f"`{name}`")
            for name, kind in df.dtypes
        ]
    )


def _query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_settings(spark)
        return iso(build(spark, sf_dir))

    return run


STREAMS = ("issues", "pull_requests", "comments")


def _staged(spark: SparkSession, sf_dir: str, *names: str, views: dict = FEW) -> list[DataFrame]:
    return [staging.stage(name, raw_view(spark, sf_dir, views[name])) for name in names]


def _daily(spark: SparkSession, sf_dir: str, views: dict = FEW) -> DataFrame:
    return marts.repo_daily_activity(*_staged(spark, sf_dir, *STREAMS, "repositories", views=views))


def _stats(spark: SparkSession, sf_dir: str, views: dict = FEW) -> DataFrame:
    (repositories,) = _staged(spark, sf_dir, "repositories", views=views)
    return marts.repo_current_stats(repositories, _daily(spark, sf_dir, views), AS_OF)


def _scan(view: tuple) -> Query:
    return lambda spark, sf_dir: raw_view(spark, sf_dir, view, times="string")


def _stage(view: tuple) -> Query:
    return lambda spark, sf_dir: staging.stage(view[0], raw_view(spark, sf_dir, view, times="string"))


def _raw_pass_through(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        df.select(F.lit(name).alias("relation"), "id", "_airbyte_raw_id")
        for name, df in raw_tables(spark, sf_dir).items()
    ]
    return functools.reduce(DataFrame.unionByName, parts)


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder for one call of a query; it goes when the session's process ends."""
    local = LOCAL_SCRATCH if spark.sparkContext.master.startswith("local") else None
    folder = scratch_dir(spark, f"{name}-{uuid.uuid4().hex}", local)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def _layer(spark: SparkSession, name: str, folder: str) -> str:
    """A new layer for one call of a query; it is dropped at the end, if the session is still there."""
    layer = f"repopulse_{name}_{uuid.uuid4().hex[:12]}"
    sinks.ensure_layer(spark, layer, f"{folder}/{layer}.db")

    def drop() -> None:
        with contextlib.suppress(Exception):
            sinks.drop_layer(spark, layer)

    atexit.register(drop)
    return layer


OBJECTS = {name: [c.field for c in columns if c.path] for name, columns in LAYOUT.items()}


def _landed_json(table: str) -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = _folder(spark, f"json-{table}")
        objects = {name: F.parse_json(name) for name in OBJECTS[table]}
        raw_view(spark, sf_dir, FULL[table]).withColumns(objects).write.options(**PACKED_LINES).json(f"{root}/{table}")
        return staging.stage(table, read_raw(spark, root, table, fmt="json"))

    return build


def _landed(spark: SparkSession, sf_dir: str, *tables: str) -> landing.Landed:
    """Landed JSON lines of which some are cut off, with those put aside."""
    root = _folder(spark, "lines")
    for table in tables:
        rows = raw_view(spark, sf_dir, FULL[table], times="string")
        line = F.to_json(F.struct(*rows.columns))
        broken = F.substr(line, F.lit(1), (F.length(line) / 2).cast("int"))
        lines = rows.select(F.when(F.expr(SPOILT), broken).otherwise(line))
        lines.write.options(**PACKED_LINES).text(f"{root}/{table}")
    return landing.land(spark, root, _folder(spark, "landed"), tables)


def _landed_with_bad_lines(table: str) -> Query:
    return lambda spark, sf_dir: staging.stage(table, _landed(spark, sf_dir, table).raw[table])


def _bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check rows, beside the number of lines that were put aside."""
    landed = _landed(spark, sf_dir, "comments", "issues", "repositories")
    aside = landed.quarantine.where(f"{landing.RECORD} is not null").groupBy("relation").agg(F.count("*").alias("put_aside"))
    return spark.createDataFrame(landed.checks).join(aside, "relation")


def _stored_variant_pull_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _folder(spark, "variants")
    objects = {name: F.parse_json(name) for name in OBJECTS["pull_requests"]}
    raw_view(spark, sf_dir, FULL["pull_requests"]).withColumns(objects).write.parquet(f"{root}/pull_requests")
    return staging.stage_pull_requests(read_raw(spark, root, "pull_requests", objects="variant"))


def _registered(spark: SparkSession, sf_dir: str, table: str, views: dict) -> tuple[str, str]:
    """A raw table, registered over a few rows, used by a staging view, and then registered anew over all rows; the
    layers of both."""
    root = _folder(spark, "views")
    raw, staged = (_layer(spark, kind, root) for kind in ("raw", "staging"))
    rows = raw_view(spark, sf_dir, views[table])
    for part, stored in (("few", rows.limit(3)), ("all", rows)):
        stored.write.parquet(f"{root}/{part}/{table}")
        layers.register_raw(spark, f"{root}/{part}", raw, tables=[table])
        if part == "few":
            layers.create_staging_views(spark, staged, raw, tables=[table])
    return raw, staged


def _staging_view(table: str, views: dict) -> Query:
    return lambda spark, sf_dir: spark.table(f"{_registered(spark, sf_dir, table, views)[1]}.{table}")


def _registered_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(f"{_registered(spark, sf_dir, 'repositories', FEW)[0]}.repositories")


def _null_keys(spark: SparkSession, sf_dir: str, views: dict = FEW) -> DataFrame:
    issues, prs, comments = _staged(spark, sf_dir, *STREAMS, views=views)
    return (
        checks.null_keys(issues, "issues", ["repo_name", "issue_created_at"])
        .unionByName(checks.null_keys(prs, "pull_requests", ["repo_name", "pr_created_at"]))
        .unionByName(checks.null_keys(comments, "comments", ["repo_name", "comment_created_at"]))
    )


def _duplicate_keys(spark: SparkSession, sf_dir: str, views: dict = FEW) -> DataFrame:
    comments, repositories = _staged(spark, sf_dir, "comments", "repositories", views=views)
    daily = _daily(spark, sf_dir, views)
    return (
        checks.duplicate_keys(repositories, "repositories", ["repo_full_name"])
        .unionByName(checks.duplicate_keys(daily, "repo_daily_activity", ["repo_full_name", "day"]))
        .unionByName(checks.duplicate_keys(comments, "comments", ["comment_id"], checks.WARN))
    )


def _orphans(spark: SparkSession, sf_dir: str, views: dict = FEW) -> DataFrame:
    *streams, repositories = _staged(spark, sf_dir, *STREAMS, "repositories", views=views)
    found = [
        checks.orphans(df, name, "repo_name", repositories, "repo_full_name") for name, df in zip(STREAMS, streams)
    ]
    return functools.reduce(DataFrame.unionByName, found)


def _gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks on the records with gaps, as a gate that lets them pass sees them."""
    bad = checks.bad_measures(bad_daily(spark, sf_dir), "orders")
    found = [build(spark, sf_dir, GAPS) for build in (_null_keys, _orphans, _duplicate_keys)]
    rows = checks.gate(*found, bad, enforce=False)
    stops = F.expr(f"severity = '{checks.ERROR}' and failures > 0").alias("stops")
    return spark.createDataFrame(rows).select("*", stops)


def _refresh_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a refresh finds in the records with gaps, while it stores the counts and in one look at them."""
    staged = staging.stage_all(raw_tables(spark, sf_dir, GAPS))
    return spark.createDataFrame(count(staged, _layer(spark, "checked", _folder(spark, "checked")), enforce=False).checks)


def _bucketed_stats(spark: SparkSession, sf_dir: str, views: dict) -> DataFrame:
    """The current state of the repositories from tables stored in buckets of their name."""
    staged = staging.stage_all(raw_tables(spark, sf_dir, views))
    done = count(staged, _layer(spark, "buckets", _folder(spark, "bucketed")), enforce=False)
    stats = marts.repo_current_stats_from_counts(done.repositories, done.counts, AS_OF)
    return stats.unionByName(marts.without_activity(done.unnamed))


class _Published:
    """A layer of its own with the marts, as often refreshed as asked."""

    def __init__(self, spark: SparkSession):
        self.spark, self.place = spark, _folder(spark, "marts")
        self.layer = _layer(spark, "mart", self.place)

    def refresh(self, raw: dict[str, DataFrame]):
        scratch = LOCAL_SCRATCH if self.spark.sparkContext.master.startswith("local") else None
        return refresh(self.spark, raw, AS_OF, layer=self.layer, keep=1, scratch=scratch)

    def view(self, name: str) -> str:
        return f"{self.layer}.{name}"


def _refreshed(spark: SparkSession, sf_dir: str):
    return _Published(spark).refresh(raw_tables(spark, sf_dir))


def _both_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query over both published views, after a second refresh has taken the place of one without comments."""
    marts_of, raw = _Published(spark), raw_tables(spark, sf_dir)
    marts_of.refresh({**raw, "comments": raw["comments"].limit(0)})
    marts_of.refresh(raw)
    daily, stats = marts_of.view(DAILY), marts_of.view(STATS)
    return spark.sql(
        f"SELECT s.repo_full_name, s.prs_created_30d, s.comments_created_30d, d.prs_created, d.comments_created"
        f" FROM {stats} s LEFT JOIN (SELECT repo_full_name, sum(prs_created) AS prs_created,"
        f" sum(comments_created) AS comments_created FROM {daily} GROUP BY repo_full_name) d"
        " ON s.repo_full_name = d.repo_full_name"
    )


def _kept_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A frame of one run, read after a later run has been published."""
    marts_of, raw = _Published(spark), raw_tables(spark, sf_dir)
    series = dashboard.activity_time_series(marts_of.refresh(raw).daily)
    marts_of.refresh({**raw, "comments": raw["comments"].limit(0)})
    return series


def _one_repository(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refreshed(spark, sf_dir).daily.where("repo_full_name = 'NATION_7'")


def _crowded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily mart where a join task may get one id of a name only."""
    issues, prs, comments, repositories = _staged(spark, sf_dir, *STREAMS, "repositories", views=GAPS)
    crowds = marts.crowded_names(repositories, ids_per_task=1)
    return marts.repo_daily_activity(issues, prs, comments, repositories, crowds)


def _rolling(spark: SparkSession, sf_dir: str, views: dict = FEW) -> DataFrame:
    *streams, repositories = _staged(spark, sf_dir, *STREAMS, "repositories", views=views)
    return insights.repo_rolling_from_counts(activity.activity_counts(*streams), repositories)


def _lead_time(view: tuple) -> Query:
    return lambda spark, sf: insights.pr_lead_time(staging.stage_pull_requests(raw_view(spark, sf, view)))


def queries() -> dict[str, Query]:
    builds: dict[str, Query] = {
        "scan_raw_comments": _scan(FULL["comments"]),
        "scan_raw_issues": _scan(FULL["issues"]),
        "scan_raw_pull_requests": _scan(FULL["pull_requests"]),
        "scan_raw_repositories": _scan(FULL["repositories"]),
        "scan_raw_users": _scan(FULL["users"]),
        "raw_pass_through": _raw_pass_through,
        **{f"landed_json_{table}": _landed_json(table) for table in TABLES},
        "landed_json_bad_lines_issues": _landed_with_bad_lines("issues"),
        "landed_json_bad_lines_repositories": _landed_with_bad_lines("repositories"),
        "dq_unreadable_records": _bad_lines,
        "stored_variant_pull_requests": _stored_variant_pull_requests,
        "stage_comments": _stage(FULL["comments"]),
        "stage_issues": _stage(FULL["issues"]),
        "stage_pull_requests": _stage(FULL["pull_requests"]),
        "stage_repositories": _stage(FULL["repositories"]),
        "stage_users": _stage(FULL["users"]),
        "registered_raw_repositories": _registered_raw,
        "staging_view_comments": _staging_view("comments", FULL),
        "refreshed_staging_users": _staging_view("users", FEW),
        "issue_daily": lambda spark, sf: activity.issue_daily(*_staged(spark, sf, "issues")),
        "issue_daily_gaps": lambda spark, sf: activity.issue_daily(*_staged(spark, sf, "issues", views=GAPS)),
        "pr_daily": lambda spark, sf: activity.pr_daily(*_staged(spark, sf, "pull_requests")),
        "pr_daily_gaps": lambda spark, sf: activity.pr_daily(*_staged(spark, sf, "pull_requests", views=GAPS)),
        "comment_daily": lambda spark, sf: activity.comment_daily(*_staged(spark, sf, "comments")),
        "comment_daily_gaps": lambda spark, sf: activity.comment_daily(*_staged(spark, sf, "comments", views=GAPS)),
        "activity_spine": lambda spark, sf: activity.activity_spine(*_staged(spark, sf, *STREAMS)),
        "activity_spine_gaps": lambda spark, sf: activity.activity_spine(*_staged(spark, sf, *STREAMS, views=GAPS)),
        "repo_daily_activity": _daily,
        "repo_daily_activity_many_repos": lambda spark, sf: _daily(spark, sf, MANY),
        "repo_daily_activity_gaps": lambda spark, sf: _daily(spark, sf, GAPS),
        "repo_daily_activity_crowded_names": _crowded,
        "activity_trailing_30d": lambda spark, sf: activity.trailing_totals(_daily(spark, sf), AS_OF),
        "repo_current_stats": _stats,
        "repo_current_stats_many_repos": lambda spark, sf: _stats(spark, sf, MANY),
        "repo_current_stats_gaps": lambda spark, sf: _stats(spark, sf, GAPS),
        "bucketed_current_stats_many_repos": lambda spark, sf: _bucketed_stats(spark, sf, MANY),
        "bucketed_current_stats_gaps": lambda spark, sf: _bucketed_stats(spark, sf, GAPS),
        "activity_time_series": lambda spark, sf: dashboard.activity_time_series(_daily(spark, sf)),
        "activity_time_series_gaps": lambda spark, sf: dashboard.activity_time_series(_daily(spark, sf, GAPS)),
        "top_repos_by_prs": lambda spark, sf: dashboard.top_repos_by_prs(_daily(spark, sf)),
        "top_repos_by_prs_gaps": lambda spark, sf: dashboard.top_repos_by_prs(_daily(spark, sf, GAPS)),
        "published_time_series": lambda spark, sf: dashboard.activity_time_series(_refreshed(spark, sf).daily),
        "published_top_repos": lambda spark, sf: dashboard.top_repos_by_prs(_refreshed(spark, sf).daily),
        "published_both_marts": _both_marts,
        "published_kept_run": _kept_run,
        "published_one_repository": _one_repository,
        "dq_null_keys": _null_keys,
        "dq_null_keys_gaps": lambda spark, sf: _null_keys(spark, sf, GAPS),
        "dq_duplicate_keys": _duplicate_keys,
        "dq_duplicate_keys_gaps": lambda spark, sf: _duplicate_keys(spark, sf, GAPS),
        "dq_orphans": _orphans,
        "dq_orphans_gaps": lambda spark, sf: _orphans(spark, sf, GAPS),
        "dq_measures": lambda spark, sf: checks.bad_measures(_daily(spark, sf), "repo_daily_activity"),
        "dq_measures_gaps": lambda spark, sf: checks.bad_measures(bad_daily(spark, sf), "orders"),
        "dq_gate_gaps": _gate,
        "dq_refresh_gaps": _refresh_checks,
        "pr_lead_time": _lead_time(TIMED_PULL_REQUESTS),
        "pr_lead_time_gaps": _lead_time(TIMED_GAPS),
        "issue_backlog": lambda spark, sf: insights.issue_backlog(*_staged(spark, sf, "issues")),
        "issue_backlog_gaps": lambda spark, sf: insights.issue_backlog(*_staged(spark, sf, "issues", views=GAPS)),
        "contributor_activity": lambda spark, sf: insights.contributor_activity(*_staged(spark, sf, *STREAMS)),
        "contributor_activity_gaps": lambda spark, sf: insights.contributor_activity(
            *_staged(spark, sf, *STREAMS, views=GAPS)
        ),
        "repo_rolling_30d": _rolling,
        "repo_rolling_30d_gaps": lambda spark, sf: _rolling(spark, sf, GAPS),
        "published_mart_roundtrip": lambda spark, sf: _refreshed(spark, sf).daily,
        "published_stats_roundtrip": lambda spark, sf: _refreshed(spark, sf).stats,
    }
    registered = {name: _query(build) for name, build in builds.items()}
    return registered | (llm.queries() if llm else {})


def oracle_sql() -> dict[str, str]:
    return ORACLE | (llm.oracle_sql() if llm else {})


def entry(spark: SparkSession) -> DataFrame:
    return queries()["repo_current_stats"](spark, "/root/testdata/sf0.001")
