"""The two marts: activity per repository and day, and the current state of each repository."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repopulse.functions import present, repeat_rows
from repopulse.operators.activity import MEASURES, activity_counts, trailing_totals, without_unkeyed


# Ids of one name that one join task may get with each of the name's days.
IDS_PER_TASK = 10_000

# Tells stored rows apart that are equal in day, name and id.
SPREAD = "_spread"


def listings(repositories: DataFrame) -> DataFrame:
    """(repo_id, repo_full_name, copies): each different repository, and how often it is listed."""
    return repositories.groupBy("repo_id", "repo_full_name").agg(F.count("*").alias("copies"))


def listed_names(repositories: DataFrame) -> DataFrame:
    """(repo_full_name, listed, ids): each name, how often it is listed, and how many ids have it."""
    known = listings(repositories.where(present("repo_full_name")))
    return known.groupBy("repo_full_name").agg(F.sum("copies").alias("listed"), F.count("*").alias("ids"))


def crowded(names: DataFrame, ids_per_task: int = IDS_PER_TASK) -> DataFrame:
    """(crowded_name, parts) from `listed_names`: names that more ids have than a join task should get."""
    return names.where(F.col("ids") > ids_per_task).selectExpr(
        "repo_full_name as crowded_name", f"cast(ceil(ids / {ids_per_task}) as int) as parts"
    )


def crowded_names(repositories: DataFrame, ids_per_task: int = IDS_PER_TASK) -> DataFrame:
    return crowded(listed_names(repositories), ids_per_task)


def with_repository(counts: DataFrame, repositories: DataFrame, crowds: DataFrame | None = None) -> DataFrame:
    """Put the repository's id and name, as the repositories table has them, on each row, and a
    column `_spread` that differs between rows which are equal otherwise.

    Activity of an unknown repository stays, with NULL id and name. A repository that is listed
    several times multiplies its rows. Such copies are counted before the join and opened after
    it, so that they never meet in one join task. No broadcast is forced: Spark broadcasts the
    repositories if their measured size allows, and otherwise shuffles both sides by name, or neither, where
    both are stored in buckets of it.

    `crowds` are the names that very many ids share, as `crowded` gives them. The ids of just these names are
    dealt into as many parts as their number asks for, and just their days are copied for each part. All other
    repositories and days are joined once. Without them all are, and adaptive execution splits what is too much
    for a task.
    """
    known = listings(repositories)
    days = counts.withColumnRenamed("repo_full_name", "name")
    same = F.col("name") == F.col("repo_full_name")
    if crowds is not None:
        known = known.join(crowds, F.col("repo_full_name") == F.col("crowded_name"), "left").selectExpr(
            "repo_id", "repo_full_name", "copies", "pmod(xxhash64(repo_id), coalesce(parts, 1)) as id_part", "parts"
        )
        # Days go to the parts that hold ids and to no others, where they would seem unlisted.
        used = known.where("parts is not null").selectExpr("repo_full_name as used_name", "id_part as used_part")
        days = days.join(used.distinct(), F.col("name") == F.col("used_name"), "left").selectExpr(
            "name", "day", *MEASURES, "coalesce(used_part, 0) as part"
        )
        same &= F.col("part") == F.col("id_part")
    joined = days.join(known, same, "left")
    rows = joined.selectExpr("repo_id", "repo_full_name", "day", *MEASURES, "name", "coalesce(copies, 1) as copies")
    spread = f"xxhash64(name, _copy_number) as {SPREAD}"
    return repeat_rows(rows, "copies", "_copy_number").selectExpr("repo_id", "repo_full_name", "day", *MEASURES, spread)


def daily_from_counts(counts: DataFrame, repositories: DataFrame, crowds: DataFrame | None = None) -> DataFrame:
    """The daily mart with its `_spread` column, from the counts per name and day."""
    return with_repository(without_unkeyed(counts), repositories, crowds)


def repo_daily_activity(
    issues: DataFrame,
    prs: DataFrame,
    comments: DataFrame,
    repositories: DataFrame,
    crowds: DataFrame | None = None,
) -> DataFrame:
    """One row per repository and day on which it has an issue, a pull request or a comment."""
    return daily_from_counts(activity_counts(issues, prs, comments), repositories, crowds).drop(SPREAD)


STATS_COLUMNS = (
    "repo_id",
    "repo_full_name",
    "language",
    "stargazers_count",
    "forks_count",
    "open_issues_count",
    "repo_created_at",
    "repo_updated_at",
)


def repo_current_stats(repositories: DataFrame, daily: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    """One row per repository with its totals since `as_of - days`, zero where there are none."""
    totals = trailing_totals(daily, as_of, days).withColumnRenamed("repo_full_name", "name")
    joined = repositories.join(totals, F.col("repo_full_name") == F.col("name"), "left")
    return joined.selectExpr(*STATS_COLUMNS, *[f"coalesce({m}_{days}d, 0) as {m}_{days}d" for m in MEASURES])


def repo_current_stats_from_counts(repositories: DataFrame, counts: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    """The same from the counts per name and day. The daily mart would hold the days of a name as often as it is listed,
    so its totals count that often.

    Nothing but names meets here. Where both tables are stored in buckets of the name, no row is shuffled.
    """
    totals = trailing_totals(counts, as_of, days).withColumnRenamed("repo_full_name", "name")
    listed = listed_names(repositories).selectExpr("repo_full_name as listed_name", "listed")
    totals = totals.join(listed, F.col("name") == F.col("listed_name"))
    joined = repositories.join(totals, F.col("repo_full_name") == F.col("name"), "left")
    sums = [f"coalesce({m}_{days}d * listed, 0) as {m}_{days}d" for m in MEASURES]
    return joined.selectExpr(*STATS_COLUMNS, *sums)


def without_activity(repositories: DataFrame, days: int = 30) -> DataFrame:
    """The current state of repositories that have no activity, such as those without a name."""
    return repositories.selectExpr(*STATS_COLUMNS, *[f"0L as {m}_{days}d" for m in MEASURES])
