"""Counts per repository and day.

The three activity streams are read once each and counted in one aggregation: Spark combines
rows inside each scan task first, so a repository that holds a third of all rows sends no more
than one row per task and day into the shuffle, and its days spread over the reducers.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repopulse.functions import as_date, day_of

KEYS = ("repo_full_name", "day")
MEASURES = ("issues_created", "prs_created", "prs_merged", "comments_created")


def _events(df: DataFrame, moment: str, **ones: str) -> DataFrame:
    """One row per record: its repository, its day, and 0 or 1 for each measure."""
    measures = [f"{ones.get(measure, 0)} as {measure}" for measure in MEASURES]
    return df.selectExpr("repo_name as repo_full_name", f"{day_of(moment)} as day", *measures)


def issue_events(issues: DataFrame) -> DataFrame:
    return _events(issues, "issue_created_at", issues_created="1")


def pr_events(prs: DataFrame) -> DataFrame:
    """`prs_merged` marks a pull request on the day it was created if it was merged at any time
    since: it does not count merges per day of the merge."""
    merged = "case when pr_merged_at is not null then 1 else 0 end"
    return _events(prs, "pr_created_at", prs_created="1", prs_merged=merged)


def comment_events(comments: DataFrame) -> DataFrame:
    return _events(comments, "comment_created_at", comments_created="1")


def count_by_day(events: DataFrame, *measures: str) -> DataFrame:
    """Sums per repository and day; NULL keys form groups of their own."""
    return events.groupBy(*KEYS).agg(*[F.sum(measure).alias(measure) for measure in measures])


def issue_daily(issues: DataFrame) -> DataFrame:
    return count_by_day(issue_events(issues), "issues_created")


def pr_daily(prs: DataFrame) -> DataFrame:
    return count_by_day(pr_events(prs), "prs_created", "prs_merged")


def comment_daily(comments: DataFrame) -> DataFrame:
    return count_by_day(comment_events(comments), "comments_created")


def all_events(issues: DataFrame, prs: DataFrame, comments: DataFrame) -> DataFrame:
    streams = (issue_events(issues), pr_events(prs), comment_events(comments))
    return functools.reduce(DataFrame.unionByName, streams)


def activity_spine(issues: DataFrame, prs: DataFrame, comments: DataFrame) -> DataFrame:
    """Distinct (repository, day) keys of the three streams."""
    return all_events(issues, prs, comments).select(*KEYS).distinct()


def activity_counts(issues: DataFrame, prs: DataFrame, comments: DataFrame) -> DataFrame:
    """All four measures per repository and day, rows with NULL keys counted too."""
    return count_by_day(all_events(issues, prs, comments), *MEASURES)


def without_unkeyed(counts: DataFrame) -> DataFrame:
    """Zero counts where the repository or the day is NULL: such keys stay in the table once,
    but nothing equals NULL, so their counts belong to no row."""
    keyed = " and ".join(f"{key} is not null" for key in KEYS)
    return counts.selectExpr(*KEYS, *[f"if({keyed}, {m}, 0) as {m}" for m in MEASURES])


def trailing_totals(daily: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    """Totals per repository from `as_of - days` on. The first day counts, there is no last
    day, and rows without a day drop out. On a stored table the filter reaches the scan."""
    recent = daily.where(F.col("day") >= F.date_sub(as_date(as_of), days))
    return recent.groupBy("repo_full_name").agg(*[F.sum(m).alias(f"{m}_{days}d") for m in MEASURES])
