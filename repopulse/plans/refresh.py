"""The daily refresh: raw tables in, checked and published marts out.

Scheduling, retries and timeouts stay with the caller; a run that fails can be started again.
"""

from __future__ import annotations

import datetime
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from repopulse import sinks
from repopulse.operators import checks
from repopulse.operators.activity import activity_counts
from repopulse.operators.staging import stage_all
from repopulse.plans.layers import create_staging_views
from repopulse.plans.marts import (
    IDS_PER_TASK,
    SPREAD,
    STATS_COLUMNS,
    crowded,
    daily_from_counts,
    listed_names,
    repo_current_stats_from_counts,
    without_activity,
)
from repopulse.session import apply_settings, scratch_dir

DAILY, STATS = "repo_daily_activity", "repo_current_stats"

COMMENTS = {
    DAILY: "Issues, pull requests and comments per repository and day of their creation.",
    STATS: "One row per repository: its attributes and its activity over the trailing days.",
}
COLUMN_COMMENTS = {
    "repo_id": "NULL for activity of a repository that is not listed",
    "repo_full_name": "NULL for activity of a repository that is not listed",
    "prs_merged": "Pull requests created on this day that were merged at any time since",
    "prs_merged_30d": "Pull requests created in the trailing days that were merged at any time since",
}


@dataclass(frozen=True)
class Refreshed:
    run: str
    daily: DataFrame
    stats: DataFrame
    checks: list[Row]


def new_run(as_of: datetime.date) -> str:
    """Run names sort by the time of the run, and two runs never share one."""
    now = datetime.datetime.now(datetime.timezone.utc)
    return f"{now:%Y%m%d%H%M%S%f}_{as_of:%Y%m%d}_{uuid.uuid4().hex[:8]}"


STREAMS = {"issues": "issues_created", "pull_requests": "prs_created", "comments": "comments_created"}
NAME = "repo_full_name"
#: How long a run stays readable after the next one is published.
HOLD = datetime.timedelta(days=1)
#: Bytes of the parts of a file that statistics are kept for.
ROW_GROUP = 32 * 1024 * 1024


def daily_order() -> list[Column | str]:
    """The stored daily mart is in order of the week, and within a week of the repository. So a filter on days reads the
    weeks that it touches, and one on a repository a small part of each week."""
    return [F.date_trunc("week", F.col("day")), NAME, "day", "repo_id"]


def count_checks() -> list[checks.Check]:
    """Checks that the counts per repository and day pass on their way into storage: the keys of the records of each
    stream, and the measures."""
    found = [checks.null_key_check(name, [NAME, "day"], F.col(rows)) for name, rows in STREAMS.items()]
    return [*found, checks.measures_check(DAILY)]


@dataclass(frozen=True)
class Counted:
    """What a refresh stores before it builds the marts, and what the checks found in it."""

    counts: DataFrame
    repositories: DataFrame
    unnamed: DataFrame
    crowds: DataFrame | None
    checks: list[Row]


def count(
    staged: dict[str, DataFrame],
    work: str,
    buckets: int | None = None,
    enforce: bool = True,
    ids_per_task: int = IDS_PER_TASK,
) -> Counted:
    """Store the counts per repository and day, and the repositories, in buckets of the name, and check them.

    Records are counted while they are written; what both tables have to be looked at for is one aggregation that
    reads each of them once and shuffles neither. The number of names that very many ids share comes from it too,
    and only if there are any, they are dealt into parts. Repositories without a name, of which there may be any number,
    have no activity and no bucket.
    """
    observation, own = Observation("counts"), count_checks()
    counts = activity_counts(staged["issues"], staged["pull_requests"], staged["comments"])
    counts = sinks.write_bucketed(
        counts, "activity_counts", work, NAME, buckets, lambda rows: checks.observed(rows, observation, *own)
    )
    listed = staged["repositories"].select(*STATS_COLUMNS)
    repositories = sinks.write_bucketed(listed.where(F.col(NAME).isNotNull()), "repositories", work, NAME, buckets)
    names = listed_names(repositories)
    together, tested = checks.names_checks(counts, names, STREAMS, DAILY, ids_per_task)
    *found, crowds = checks.results(together, *tested).collect()
    rows = checks.judge([*checks.observed_rows(observation, *own), *found], enforce)
    unnamed = listed.where(F.col(NAME).isNull())
    return Counted(counts, repositories, unnamed, crowded(names, ids_per_task) if crowds.failures else None, rows)


def refresh(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    as_of: datetime.date | str | None = None,
    layer: str = "mart",
    location: str | None = None,
    keep: int = 2,
    hold: datetime.timedelta = HOLD,
    enforce: bool = True,
    prefix: str = "",
    staging: str | None = None,
    raw_layer: str = "raw",
    scratch: str | None = None,
    buckets: int | None = None,
) -> Refreshed:
    """Stage, count, check, build both marts, and only then publish them, together and in one statement.

    The raw activity is scanned once: the counts per repository and day and the
    repositories are kept for the length of the run as tables in the shared scratch folder, in `buckets` of the name (as
    many as there are shuffle partitions, if not given), and the marts read those without shuffling them by name.
    Doubled repositories stop the run before they can multiply the daily mart. With
    `enforce=False` the marts are published whatever the checks find. `prefix` goes before the names
    of both marts and of their pointer, for readers that know them by longer names. `staging` names a layer in which
    the five staging views are made, or made anew, over the raw tables of `raw_layer`. `scratch` is the shared
    folder where the cluster names none.

    The last `keep` runs stay, and every run until `hold` has passed since the next one was published, so that what
    readers have begun they can end. A run that fails, in publishing too, leaves readers both marts as they were and
    drops what it built.
    """
    apply_settings(spark)
    if as_of is None:
        as_of = spark.range(1).select(F.current_date()).first()[0]
    elif isinstance(as_of, str):
        as_of = datetime.date.fromisoformat(as_of)
    run = new_run(as_of)
    names = [prefix + DAILY, prefix + STATS]
    work = f"repopulse_work_{run}"
    sinks.ensure_layer(spark, layer, location)
    sinks.require_free(spark, names, layer, prefix + sinks.POINTER)
    if staging:
        create_staging_views(spark, staging, raw_layer)
    sinks.ensure_layer(spark, work, scratch_dir(spark, root=scratch))
    staged = stage_all(raw)
    try:
        done = count(staged, work, buckets, enforce)
        # Stored once before they are dealt into ranges, since finding the ranges reads them one more time.
        built = sinks.write_table(daily_from_counts(done.counts, done.repositories, done.crowds), "daily", work)
        sinks.write_run(built, names[0], run, layer, daily_order(), SPREAD, ROW_GROUP)
        stats = repo_current_stats_from_counts(done.repositories, done.counts, as_of)
        stats = sinks.write_table(stats.unionByName(without_activity(done.unnamed)), "stats", work)
        sinks.write_run(stats, names[1], run, layer, (NAME, "repo_id"), row_group=ROW_GROUP)
        comments = dict(zip(names, (COMMENTS[DAILY], COMMENTS[STATS])))
        daily, stats = sinks.publish_all(spark, names, run, layer, comments, COLUMN_COMMENTS, prefix + sinks.POINTER)
    except Exception:
        for name in names:
            sinks.drop_run(spark, name, run, layer)
        raise
    finally:
        sinks.drop_layer(spark, work)
    for name in names:
        sinks.retire(spark, name, run, keep, layer, hold)
    return Refreshed(run, daily, stats, done.checks)
