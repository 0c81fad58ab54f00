import collections
import random
import statistics

import pytest

from repopulse.operators.staging import stage_all
from repopulse.plans import insights, marts
from tests.records import REPOSITORIES, day, golden_staged, raw_frames, tuples, unordered


def test_lead_time_golden(spark):
    prs = golden_staged(spark)["pull_requests"]
    rows = {r.repo_full_name: tuple(r)[1:] for r in insights.pr_lead_time(prs).collect()}
    assert rows == {"o/a": (2, (48 + 135) / 2, (48 + 135) / 2), "o/b": (1, 1.0, 1.0)}


def test_lead_time_against_brute_force(spark):
    rng = random.Random(3)
    rows = [
        (rng.choice(["hot"] * 5 + [f"r{i}" for i in range(20)]), rng.choice([rng.randrange(-5000, 90_000), 7200, 7201]))
        for _ in range(3000)
    ]
    prs = spark.createDataFrame(rows, "repo_name string, lead long").selectExpr(
        "repo_name",
        "timestamp '2024-01-01 00:00:00' as pr_created_at",
        "timestamp '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, lead) as pr_merged_at",
    )
    expected = collections.defaultdict(list)
    for repo, lead in rows:
        expected[repo].append(lead)
    found = {r.repo_full_name: r for r in insights.pr_lead_time(prs).collect()}
    assert found.keys() == expected.keys()
    for repo, leads in expected.items():
        assert found[repo].prs_merged == len(leads)
        assert found[repo].mean_hours == pytest.approx(statistics.fmean(leads) / 3600)
        assert found[repo].median_hours == pytest.approx(statistics.median(leads) / 3600)


def test_backlog(spark):
    issues = [
        {"repository": "o/a", "created_at": "2024-01-01T00:00:00Z", "closed_at": "2024-01-03T00:00:00Z"},
        {"repository": "o/a", "created_at": "2024-01-01T09:00:00Z", "closed_at": None},
        {"repository": "o/a", "created_at": "2024-01-03T00:00:00Z", "closed_at": "2024-01-03T05:00:00Z"},
        {"repository": "o/b", "created_at": "2024-01-02T00:00:00Z", "closed_at": "2024-01-04T00:00:00Z"},
        {"repository": None, "created_at": "2024-01-02T00:00:00Z", "closed_at": None},
    ]
    staged = stage_all(raw_frames(spark, issues=issues))
    assert unordered(tuples(insights.issue_backlog(staged["issues"]))) == unordered(
        [
            ("o/a", day("2024-01-01"), 2, 0, 2),
            ("o/a", day("2024-01-03"), 1, 2, 1),
            ("o/b", day("2024-01-02"), 1, 0, 1),
            ("o/b", day("2024-01-04"), 0, 1, 0),
        ]
    )


def test_contributors(spark):
    def act(login, when, repo="o/a"):
        return {"repository": repo, "created_at": when, "user": login and f'{{"login":"{login}"}}'}

    staged = stage_all(
        raw_frames(
            spark,
            issues=[act("ada", "2024-01-05T00:00:00Z"), act(None, "2024-01-05T00:00:00Z")],
            pull_requests=[act("ada", "2024-01-02T00:00:00Z"), act("ada", None)],
            comments=[act("ada", "2024-02-01T00:00:00Z", "o/b"), act("bob", "2024-02-01T23:59:59Z")],
        )
    )
    found = insights.contributor_activity(staged["issues"], staged["pull_requests"], staged["comments"])
    assert unordered(tuples(found)) == unordered(
        [
            ("o/a", "ada", 1, 2, 0, day("2024-01-02"), day("2024-01-05")),
            ("o/a", None, 1, 0, 0, day("2024-01-05"), day("2024-01-05")),
            ("o/a", "bob", 0, 0, 1, day("2024-02-01"), day("2024-02-01")),
            ("o/b", "ada", 0, 0, 1, day("2024-02-01"), day("2024-02-01")),
        ]
    )


def test_rolling_totals_end_where_the_trailing_totals_stand(spark):
    staged = golden_staged(spark)
    streams = [staged[name] for name in ("issues", "pull_requests", "comments", "repositories")]
    daily = marts.repo_daily_activity(*streams)
    rows = {(r[0], r[1]): tuple(r)[2:] for r in insights.repo_rolling_totals(daily).collect()}
    assert rows == {
        ("o/a", day("2023-12-30")): (0, 1, 1, 0),
        ("o/a", day("2023-12-31")): (1, 1, 1, 0),
        ("o/a", day("2024-01-10")): (3, 3, 2, 1),
        ("o/a", day("2024-02-02")): (2, 2, 1, 2),
        ("o/b", day("2024-01-12")): (0, 1, 1, 0),
        ("o/b", day("2024-01-13")): (0, 1, 1, 1),
    }
    stats = marts.repo_current_stats(staged["repositories"], daily, "2024-02-02")
    assert rows["o/a", day("2024-02-02")] == tuple(next(r for r in stats.collect() if r.repo_id == 1))[8:]


def test_rolling_window_counts_the_thirtieth_day_before(spark):
    days = ["2024-01-01", "2024-01-31", "2024-02-01"]
    issues = [{"repository": "o/a", "created_at": f"{d}T00:00:00Z"} for d in days]
    staged = stage_all(raw_frames(spark, repositories=REPOSITORIES, issues=issues))
    streams = [staged[name] for name in ("issues", "pull_requests", "comments", "repositories")]
    rolled = insights.repo_rolling_totals(marts.repo_daily_activity(*streams))
    assert [r.issues_created_30d for r in rolled.orderBy("day").collect()] == [1, 2, 2]
