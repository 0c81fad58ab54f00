"""Lead time, backlog, contributors and rolling totals. The definitions are ours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repopulse.functions import day_of, present
from repopulse.operators.activity import MEASURES

HOUR = 3600


def pr_lead_time(prs: DataFrame) -> DataFrame:
    """Per repository: merged pull requests, mean and exact median hours from creation to merge.

    The exact median of a repository with a third of all pull requests must not gather them in
    one task. So lead times, in whole seconds, are counted first; the hour that holds the middle
    is found among the counts per hour; and only that hour's seconds are looked at again.
    """
    merged = prs.where(present("repo_name", "pr_created_at", "pr_merged_at")).select(
        F.col("repo_name").alias("repo_full_name"),
        (F.unix_seconds("pr_merged_at") - F.unix_seconds("pr_created_at")).alias("seconds"),
    )
    hour = F.floor(F.col("seconds") / HOUR).alias("hour")
    by_second = merged.groupBy("repo_full_name", hour, "seconds").agg(F.count("*").alias("n"))

    by_hour = by_second.groupBy("repo_full_name", "hour").agg(
        F.sum("n").alias("hour_n"), F.sum(F.col("n") * F.col("seconds")).alias("hour_seconds")
    )
    repo = Window.partitionBy("repo_full_name")
    up_to_hour = repo.orderBy("hour").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hours = by_hour.select(
        "repo_full_name",
        "hour",
        (F.sum("hour_n").over(up_to_hour) - F.col("hour_n")).alias("before"),
        F.sum("hour_n").over(up_to_hour).alias("upto"),
        F.sum("hour_n").over(repo).alias("prs"),
        F.sum("hour_seconds").over(repo).alias("total"),
    )
    # Ranks, from 1, of the two middle rows; the same row twice if the number is odd.
    low, high = F.expr("(prs + 1) div 2"), F.expr("prs div 2 + 1")

    def holds(rank: Column) -> Column:
        return (rank > F.col("before")) & (rank <= F.col("upto"))

    middle_hours = hours.where(holds(low) | holds(high)).drop("upto")
    up_to_second = (
        Window.partitionBy("repo_full_name", "hour")
        .orderBy("seconds")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # Null-safe equality, though no key is NULL: plain equality would add a filter to one of the two
    # uses of the counts, and Spark would scan and count the pull requests once for each.
    same = F.col("m.repo_full_name").eqNullSafe(F.col("s.repo_full_name")) & F.col("m.hour").eqNullSafe(F.col("s.hour"))
    ranked = (
        middle_hours.alias("m")
        .join(by_second.alias("s"), same)
        .select("m.*", "s.seconds", "s.n")
        .withColumn("upto", F.col("before") + F.sum("n").over(up_to_second))
        .withColumn("before", F.col("upto") - F.col("n"))
    )
    return (
        ranked.groupBy("repo_full_name")
        .agg(
            F.max("prs").alias("prs_merged"),
            F.max("total").alias("total"),
            F.max(F.when(holds(low), F.col("seconds"))).alias("low"),
            F.max(F.when(holds(high), F.col("seconds"))).alias("high"),
        )
        .select(
            "repo_full_name",
            "prs_merged",
            (F.col("total") / F.col("prs_merged") / HOUR).alias("mean_hours"),
            ((F.col("low") + F.col("high")) / 2 / HOUR).alias("median_hours"),
        )
    )


def issue_backlog(issues: DataFrame) -> DataFrame:
    """Per repository and day with a change: issues opened, closed, and open at its end.

    The window sorts one row per day of a repository, so its size is bounded by the calendar.
    """
    days = issues.where(present("repo_name")).selectExpr(
        "repo_name as repo_full_name",
        f"{day_of('issue_created_at')} as opened",
        f"{day_of('issue_closed_at')} as closed",
    )
    changes = days.unpivot("repo_full_name", ["opened", "closed"], "change", "day").where(present("day"))
    daily = changes.groupBy("repo_full_name", "day").agg(
        F.count_if(F.col("change") == "opened").alias("opened"),
        F.count_if(F.col("change") == "closed").alias("closed"),
    )
    running = Window.partitionBy("repo_full_name").orderBy("day").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return daily.withColumn("backlog", F.sum(F.col("opened") - F.col("closed")).over(running))


def contributor_activity(issues: DataFrame, prs: DataFrame, comments: DataFrame) -> DataFrame:
    """Per repository and login: issues, pull requests, comments, first and last active day."""
    streams = (
        (issues, "author_login", "issue_created_at", "issues"),
        (prs, "author_login", "pr_created_at", "prs"),
        (comments, "commenter_login", "comment_created_at", "comments"),
    )
    kinds = [kind for *_, kind in streams]
    events = None
    for df, login, moment, own in streams:
        part = df.where(present("repo_name")).selectExpr(
            "repo_name as repo_full_name",
            f"{login} as login",
            f"{day_of(moment)} as day",
            *[f"{int(kind == own)} as {kind}" for kind in kinds],
        )
        events = part if events is None else events.unionByName(part)
    return events.groupBy("repo_full_name", "login").agg(
        *[F.sum(kind).alias(kind) for kind in kinds],
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
    )


def _rolled(per_day: DataFrame, days: int) -> DataFrame:
    window = Window.partitionBy("repo_full_name").orderBy(F.unix_date("day")).rangeBetween(-days, 0)
    return per_day.select(
        "repo_full_name", "day", *[F.sum(m).over(window).alias(f"{m}_{days}d") for m in MEASURES]
    )


def repo_rolling_totals(daily: DataFrame, days: int = 30) -> DataFrame:
    """Per named repository and active day of a stored daily table: totals of that day and the `days`
    before it.

    Days are summed up first, so the window sees one row per day of a repository even where the
    repository is listed several times.
    """
    keyed = daily.where(present("repo_full_name", "day"))
    return _rolled(keyed.groupBy("repo_full_name", "day").agg(*[F.sum(m).alias(m) for m in MEASURES]), days)


def repo_rolling_from_counts(counts: DataFrame, repositories: DataFrame, days: int = 30) -> DataFrame:
    """The same from the counts per name and day: a name that is listed several times has its totals as
    often. Listings are counted per name, so no row is multiplied and summed up again."""
    rolled = _rolled(counts.where(present("repo_full_name", "day")), days)
    listed = repositories.where(present("repo_full_name")).groupBy("repo_full_name").agg(F.count("*").alias("_listed"))
    totals = [(F.col(f"{m}_{days}d") * F.col("_listed")).alias(f"{m}_{days}d") for m in MEASURES]
    return rolled.join(listed, "repo_full_name").select("repo_full_name", "day", *totals)
