import collections
import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from repopulse.functions import repeat_rows
from repopulse.operators import activity
from repopulse.operators.staging import stage, stage_all
from repopulse.plans import dashboard, marts
from repopulse.sources.readers import read_raw
from tests.records import DAILY, REPOSITORIES, day, golden_staged, raw_frames, tuples, unordered


def daily_of(staged):
    return marts.repo_daily_activity(
        staged["issues"], staged["pull_requests"], staged["comments"], staged["repositories"]
    )


def test_daily_golden_rows(spark):
    daily = daily_of(golden_staged(spark))
    assert unordered(tuples(daily)) == unordered(DAILY)
    assert daily.dtypes == [
        ("repo_id", "bigint"),
        ("repo_full_name", "string"),
        ("day", "date"),
        ("issues_created", "bigint"),
        ("prs_created", "bigint"),
        ("prs_merged", "bigint"),
        ("comments_created", "bigint"),
    ]


def test_doubled_repository_multiplies_its_rows_and_totals(spark):
    staged = golden_staged(spark, REPOSITORIES + [{"id": 1, "full_name": "o/a"}])
    daily = daily_of(staged)
    assert daily.count() == 14
    stats = marts.repo_current_stats(staged["repositories"], daily, "2024-01-31")
    rows = [r for r in stats.collect() if r.repo_full_name == "o/a"]
    assert [r.issues_created_30d for r in rows] == [4, 4]


def test_repositories_sharing_a_name_each_get_the_activity(spark):
    staged = golden_staged(spark, REPOSITORIES + [{"id": 9, "full_name": "o/a"}])
    daily = daily_of(staged)
    assert collections.Counter(r.repo_id for r in daily.collect()) == {None: 2, 1: 5, 9: 5, 2: 2}


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_dealing_the_ids_of_crowded_names_changes_nothing_but_the_tasks(spark, threshold):
    more = [{"id": n, "full_name": "o/a"} for n in (9, 10, 11)] + [{"id": None, "full_name": "o/b"}]
    staged = golden_staged(spark, REPOSITORIES + REPOSITORIES + more)
    counts = activity.without_unkeyed(
        activity.activity_counts(staged["issues"], staged["pull_requests"], staged["comments"])
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        whole = marts.with_repository(counts, staged["repositories"]).drop(marts.SPREAD)
        crowds = marts.crowded_names(staged["repositories"], ids_per_task=1)
        dealt = marts.with_repository(counts, staged["repositories"], crowds).drop(marts.SPREAD)
        assert unordered(tuples(whole)) == unordered(tuples(dealt))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert whole.count() == 2 + 2 * 5 + 3 * 5 + 2 * 2 + 2


def test_only_crowded_names_are_dealt(spark):
    repositories = spark.range(2500).selectExpr("id as repo_id", "if(id < 2400, 'crowd', concat('r', id)) as repo_full_name")
    found = marts.crowded_names(repositories, ids_per_task=1000)
    assert tuples(found) == [("crowd", 3)]
    counts = spark.range(4).selectExpr(
        "if(id < 2, 'crowd', 'r2450') as repo_full_name",
        "date_add(date'2024-01-01', cast(id as int)) as day",
        *[f"1 as {m}" for m in activity.MEASURES],
    )
    plain = marts.with_repository(counts, repositories)
    assert "id_part" not in plain._jdf.queryExecution().toString()
    dealt = marts.with_repository(counts, repositories, found)
    assert "id_part" in dealt._jdf.queryExecution().toString()
    assert plain.count() == dealt.count() == 2 * 2400 + 2


def test_building_the_daily_mart_starts_no_job(spark):
    staged = golden_staged(spark)
    context = spark.sparkContext
    context.setJobGroup("lazy", "lazy")
    try:
        daily = daily_of(staged)
        marts.repo_daily_activity(
            *[staged[n] for n in ("issues", "pull_requests", "comments", "repositories")],
            marts.crowded_names(staged["repositories"], 1),
        )
        assert not context.statusTracker().getJobIdsForGroup("lazy")
        daily.count()
        assert context.statusTracker().getJobIdsForGroup("lazy")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("as_of", ["2024-01-31", "2024-02-10"])
def test_current_stats_from_counts_equal_those_from_the_daily_mart(spark, as_of):
    more = [{"id": 9, "full_name": "o/a"}, {"id": 1, "full_name": "o/a"}, {"id": 4, "full_name": None}, {"id": None, "full_name": "o/x"}]
    staged = golden_staged(spark, REPOSITORIES + more)
    counts = activity.activity_counts(staged["issues"], staged["pull_requests"], staged["comments"])
    found = marts.repo_current_stats_from_counts(staged["repositories"], counts, as_of)
    whole = marts.repo_current_stats(staged["repositories"], daily_of(staged), as_of)
    assert found.dtypes == whole.dtypes
    assert unordered(tuples(found)) == unordered(tuples(whole))


@pytest.mark.parametrize(
    "as_of, expected",
    [
        ("2024-01-31", {"o/a": (2, 2, 1, 2), "o/b": (0, 1, 1, 1), "o/c": (0, 0, 0, 0)}),
        ("2024-02-10", {"o/a": (0, 0, 0, 1), "o/b": (0, 1, 1, 1), "o/c": (0, 0, 0, 0)}),
        (datetime.date(2024, 2, 9), {"o/a": (2, 2, 1, 2), "o/b": (0, 1, 1, 1), "o/c": (0, 0, 0, 0)}),
    ],
)
def test_current_stats_golden_rows(spark, as_of, expected):
    staged = golden_staged(spark)
    stats = marts.repo_current_stats(staged["repositories"], daily_of(staged), as_of)
    assert {r.repo_full_name: tuple(r)[8:] for r in stats.collect()} == expected


def test_current_stats_default_to_today(spark):
    raw = raw_frames(spark, repositories=[{"id": 1, "full_name": "o/a"}])
    staged = stage_all(raw)
    issues = staged["issues"].select("repo_name", "issue_created_at").limit(0)
    today = spark.range(3).select(
        F.lit("o/a").alias("repo_name"),
        (F.current_timestamp() - F.expr("make_dt_interval(cast(id * 30 as int))")).alias("issue_created_at"),
    )
    staged["issues"] = issues.unionByName(today)
    stats = marts.repo_current_stats(staged["repositories"], daily_of(staged))
    assert stats.first().issues_created_30d == 2  # today and the 30th day before, not the 60th


def test_counts_per_stream_and_spine(spark):
    staged = golden_staged(spark)
    issues = unordered(tuples(activity.issue_daily(staged["issues"])))
    assert issues == unordered(
        [
            (None, day("2024-01-10"), 1),
            ("o/a", None, 1),
            ("o/a", day("2023-12-31"), 1),
            ("o/a", day("2024-01-10"), 2),
            ("o/x", day("2024-01-11"), 1),
        ]
    )
    assert ("o/a", day("2024-01-10"), 2, 1) in tuples(activity.pr_daily(staged["pull_requests"]))
    assert ("o/b", day("2024-01-13"), 1) in tuples(activity.comment_daily(staged["comments"]))
    spine = activity.activity_spine(staged["issues"], staged["pull_requests"], staged["comments"])
    assert len(tuples(spine)) == 9 and (None, day("2024-01-10")) in tuples(spine)


def test_days_are_utc_days_whatever_zone_the_session_had(spark, tmp_path):
    late = [{"repository": "o/a", "created_at": "2024-01-01T23:30:00Z"}]
    raw_frames(spark, issues=late)["issues"].write.parquet(str(tmp_path / "issues"))
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        issues = stage("issues", read_raw(spark, str(tmp_path), "issues", times="string"))
        assert activity.issue_daily(issues).first().day == day("2024-01-01")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_names_join_by_exact_equality_on_the_full_name(spark):
    repositories = [{"id": 1, "full_name": "o/a", "name": "a"}]
    issues = [{"repository": name, "created_at": "2024-01-01T00:00:00Z"} for name in ("o/a", "O/a", "a", "o/a ")]
    staged = stage_all(raw_frames(spark, repositories=repositories, issues=issues))
    rows = daily_of(staged).collect()
    assert sorted((r.repo_full_name or "", r.issues_created) for r in rows) == [("", 1)] * 3 + [("o/a", 1)]


def test_trailing_totals_keep_unknown_repositories_as_one_group(spark):
    totals = activity.trailing_totals(daily_of(golden_staged(spark)), "2024-02-09")
    rows = {r.repo_full_name: tuple(r)[1:] for r in totals.collect()}
    assert rows == {None: (1, 0, 0, 0), "o/a": (2, 2, 1, 2), "o/b": (0, 1, 1, 1)}


def test_repeat_rows(spark):
    df = spark.createDataFrame([("a", 1), ("b", 5), ("c", 4), ("d", 2)], "k string, n long")
    repeated = collections.Counter(r.k for r in repeat_rows(df, "n", block=2).collect())
    assert repeated == {"a": 1, "b": 5, "c": 4, "d": 2}


def test_dashboard_cards(spark):
    daily = daily_of(golden_staged(spark))
    series = tuples(dashboard.activity_time_series(daily))
    assert series == [
        (day("2023-12-30"), 0, 1, 1, 0),
        (day("2023-12-31"), 1, 0, 0, 0),
        (day("2024-01-10"), 2, 2, 1, 1),
        (day("2024-01-11"), 1, 0, 0, 0),
        (day("2024-01-12"), 0, 1, 1, 0),
        (day("2024-01-13"), 0, 0, 0, 1),
        (day("2024-02-02"), 0, 0, 0, 1),
    ]
    assert tuples(dashboard.top_repos_by_prs(daily)) == [("o/a", 3), ("o/b", 1)]
    assert tuples(dashboard.top_repos_by_prs(daily, 1)) == [("o/a", 3)]


def test_ties_in_the_top_list_go_by_name(spark):
    prs = [{"repository": name, "created_at": "2024-01-01T00:00:00Z"} for name in ("o/c", "o/a", "o/b")]
    staged = stage_all(raw_frames(spark, repositories=REPOSITORIES, pull_requests=prs))
    assert tuples(dashboard.top_repos_by_prs(daily_of(staged), 2)) == [("o/a", 1), ("o/b", 1)]


# Brute force: every key of any stream, its counts looked up by equality (which NULL never meets),
# and one row per repository of that name.

_names = st.sampled_from([None, "o/a", "o/b", "o/x"])
_days = st.sampled_from([None, "2024-01-01", "2024-01-02", "2024-02-01"])
_records = st.lists(st.tuples(_names, _days, st.booleans()), max_size=12)
_repositories = st.lists(st.tuples(st.integers(1, 3), st.sampled_from([None, "o/a", "o/b"])), max_size=5)


def brute_force(issues, prs, comments, repositories):
    counts = [collections.Counter(), collections.Counter(), collections.Counter(), collections.Counter()]
    keys = set()
    for place, rows in ((0, issues), (1, prs), (3, comments)):
        for name, when, merged in rows:
            keys.add((name, when))
            counts[place][name, when] += 1
            if place == 1 and merged:
                counts[2][name, when] += 1
    result = []
    for name, when in keys:
        found = [c[name, when] if name and when else 0 for c in counts]
        owners = [(i, n) for i, n in repositories if n and n == name] or [(None, None)]
        result += [(i, n, day(when), *found) for i, n in owners]
    return result


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(_records, _records, _records, _repositories)
def test_daily_against_brute_force(spark, issues, prs, comments, repositories):
    def rows(records):
        return [
            {
                "repository": name,
                "created_at": when and f"{when}T12:00:00Z",
                "merged_at": "2024-03-01T00:00:00Z" if merged else None,
            }
            for name, when, merged in records
        ]

    staged = stage_all(
        raw_frames(
            spark,
            issues=[{k: v for k, v in r.items() if k != "merged_at"} for r in rows(issues)],
            pull_requests=rows(prs),
            comments=rows(comments),
            repositories=[{"id": i, "full_name": n} for i, n in repositories],
        )
    )
    assert unordered(tuples(daily_of(staged))) == unordered(brute_force(issues, prs, comments, repositories))
