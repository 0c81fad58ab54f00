"""The shape of the physical plans: what is read, shuffled and joined."""

import re

import pytest

from repopulse.operators import activity, checks
from repopulse.operators.staging import stage_all
from repopulse.plans import insights, marts
from repopulse.sources.layout import TABLES
from repopulse.sources.readers import read_all
from tests.records import golden_raw


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("raw"))
    typed = {t: df.selectExpr(*[
        f"cast(`{c}` as timestamp) as `{c}`" if c.endswith("_at") else f"`{c}`" for c in df.columns
    ]) for t, df in golden_raw(spark).items()}
    for table in TABLES:
        typed[table].write.parquet(f"{root}/{table}")
    return stage_all(read_all(spark, root))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def daily_of(staged):
    return marts.repo_daily_activity(
        staged["issues"], staged["pull_requests"], staged["comments"], staged["repositories"]
    )


def operators(text, name):
    return len(re.findall(rf"[-:] \*?(?:\(\d+\) )?{name}\b", text))


def test_counts_scan_each_stream_once_and_shuffle_once(staged):
    text = plan(activity.activity_counts(staged["issues"], staged["pull_requests"], staged["comments"]))
    assert operators(text, "FileScan") == 3
    assert operators(text, "Exchange") == 1
    assert "partial_sum" in text
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", text):
        assert set(re.findall(r"(\w+):", schema)) <= {"repository", "created_at", "merged_at"}


def test_daily_reads_two_repository_columns_and_forces_no_broadcast(spark, staged):
    text = plan(daily_of(staged))
    assert operators(text, "FileScan") == 4
    assert "ReadSchema: struct<id:bigint,full_name:string>" in text
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(daily_of(staged))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert operators(text, "SortMergeJoin") == 1
    assert "Broadcast" not in text


@pytest.mark.parametrize("threshold, join", [("-1", "SortMergeJoin"), ("10m", "BroadcastHashJoin")])
def test_orphans_are_counted_per_key_before_the_join(spark, staged, threshold, join):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        text = plan(checks.orphans(staged["issues"], "issues", "repo_name", staged["repositories"], "repo_full_name"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "LeftOuter" in text
    assert text.index("keys=[repo_name") > text.index(join)


def test_lead_time_scans_the_pull_requests_once(spark, staged):
    df = insights.pr_lead_time(staged["pull_requests"])
    df.collect()
    final = plan(df).split("Initial Plan")[0]
    assert operators(final, "FileScan") == 1 and "ReusedExchange" in final


def test_backlog_scans_the_issues_once(staged):
    assert operators(plan(insights.issue_backlog(staged["issues"])), "FileScan") == 1


def test_trailing_filter_reaches_the_raw_scans(staged):
    text = plan(marts.repo_current_stats(staged["repositories"], daily_of(staged), "2024-01-31"))
    assert text.count("GreaterThanOrEqual(created_at,2024-01-01 00:00:00.0)") == 3


def test_trailing_filter_reaches_the_stored_mart(spark, staged, tmp_path):
    daily_of(staged).write.parquet(str(tmp_path / "daily"))
    text = plan(activity.trailing_totals(spark.read.parquet(str(tmp_path / "daily")), "2024-01-31"))
    assert "PushedFilters: [IsNotNull(day), GreaterThanOrEqual(day,2024-01-01)]" in text
    assert operators(text, "Exchange") == 1


def test_unread_json_is_not_parsed(staged):
    text = plan(daily_of(staged))
    assert "parseJson" not in text and "variant" not in text.lower()


def test_no_plan_pairs_rows_or_runs_python(staged):
    daily = daily_of(staged)
    streams = [staged[name] for name in ("issues", "pull_requests", "comments")]
    for df in (
        daily,
        marts.repo_current_stats(staged["repositories"], daily, "2024-01-31"),
        insights.pr_lead_time(staged["pull_requests"]),
        insights.issue_backlog(staged["issues"]),
        insights.contributor_activity(*streams),
        insights.repo_rolling_totals(daily),
    ):
        text = plan(df)
        assert "CartesianProduct" not in text and "NestedLoop" not in text
        assert "Python" not in text and "Pandas" not in text


def test_every_window_is_partitioned(staged):
    for df in (
        insights.pr_lead_time(staged["pull_requests"]),
        insights.issue_backlog(staged["issues"]),
        insights.repo_rolling_totals(daily_of(staged)),
    ):
        assert "SinglePartition" not in plan(df)


def test_merged_pull_requests_are_filtered_in_the_scan(staged):
    assert "IsNotNull(merged_at)" in plan(insights.pr_lead_time(staged["pull_requests"]))
