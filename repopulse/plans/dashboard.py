"""The two dashboard cards, read from the daily mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repopulse.functions import present
from repopulse.operators.activity import MEASURES


def activity_time_series(daily: DataFrame) -> DataFrame:
    """Activity of all repositories together per day, in date order."""
    dated = daily.where(present("day"))
    return dated.groupBy("day").agg(*[F.sum(m).alias(m) for m in MEASURES]).orderBy("day")


def top_repos_by_prs(daily: DataFrame, k: int = 5) -> DataFrame:
    """The `k` named repositories with the most pull requests, ties by name."""
    named = daily.where(present("repo_full_name"))
    totals = named.groupBy("repo_full_name").agg(F.sum("prs_created").alias("prs_created"))
    return totals.orderBy(F.desc("prs_created"), "repo_full_name").limit(k)
