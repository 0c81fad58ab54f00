"""Data checks. Each gives rows (check, relation, key, severity, failures); `gate` stops a run.

A `Check` is a set of counts over the rows of a table. Any number of them make one aggregation of it (`results`), or no
scan at all where the table is being written anyhow (`observed`). Either way a row per tested key comes back, so a
gate collects a few rows however large the tables are.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F

from repopulse.functions import present
from repopulse.operators.activity import MEASURES

WARN, ERROR = "warn", "error"


class ChecksFailed(Exception):
    def __init__(self, rows: Sequence[Row]):
        self.rows = list(rows)
        super().__init__("; ".join(f"{r.check} {r.relation}.{r.key}: {r.failures}" for r in self.rows))


class Check(NamedTuple):
    """Aggregations that count the failures for each tested key of a relation."""

    check: str
    relation: str
    severity: str
    failures: dict[str, Column]


def _counts(checks: Sequence[Check]) -> list[Column]:
    every = [count for check in checks for count in check.failures.values()]
    return [F.coalesce(count, F.lit(0)).cast("long").alias(f"check_{n}") for n, count in enumerate(every)]


def _keys(checks: Sequence[Check]) -> list[tuple[str, str, str, str]]:
    return [(c.check, c.relation, key, c.severity) for c in checks for key in c.failures]


def results(df: DataFrame, *checks: Check) -> DataFrame:
    """One aggregation for all checks of a table, then a row for each key."""
    rows = [
        F.struct(
            F.lit(check).alias("check"),
            F.lit(relation).alias("relation"),
            F.lit(key).alias("key"),
            F.lit(severity).alias("severity"),
            F.col(f"check_{n}").alias("failures"),
        )
        for n, (check, relation, key, severity) in enumerate(_keys(checks))
    ]
    return df.agg(*_counts(checks)).select(F.inline(F.array(*rows)))


def observed(df: DataFrame, observation: Observation, *checks: Check) -> DataFrame:
    """The same rows, counted on their way. Read them with `observed_rows` once they have been written."""
    return df.observe(observation, *_counts(checks))


def observed_rows(observation: Observation, *checks: Check) -> list[Row]:
    found = observation.get
    return [
        Row(check=check, relation=relation, key=key, severity=severity, failures=found[f"check_{n}"])
        for n, (check, relation, key, severity) in enumerate(_keys(checks))
    ]


def null_key_check(relation: str, keys: Sequence[str], weight: Column | None = None, severity: str = WARN) -> Check:
    weight = F.lit(1) if weight is None else weight
    return Check("null_keys", relation, severity, {key: F.sum(F.when(F.col(key).isNull(), weight)) for key in keys})


def null_keys(
    df: DataFrame, relation: str, keys: Sequence[str], weight: Column | None = None, severity: str = WARN
) -> DataFrame:
    """Rows in which a key is NULL. `weight` is the number of rows that a row stands for."""
    return results(df, null_key_check(relation, keys, weight, severity))


def duplicate_keys(df: DataFrame, relation: str, keys: Sequence[str], severity: str = ERROR) -> DataFrame:
    """Keys that occur more than once; rows with a NULL in the key do not count."""
    repeated = df.where(present(*keys)).groupBy(*keys).agg(F.count("*").alias("_rows")).where(F.col("_rows") > 1)
    return results(repeated, Check("duplicate_keys", relation, severity, {",".join(keys): F.count("*")}))


def doubled_days(counts: DataFrame, repositories: DataFrame, relation: str, severity: str = ERROR) -> DataFrame:
    """Repositories and days that a daily table made of these counts and repositories holds more than
    once: those whose name is listed more than once. The table itself need not be grouped for it."""
    named = repositories.where(present("repo_full_name")).groupBy("repo_full_name").agg(F.count("*").alias("_listed"))
    days = counts.where(present("repo_full_name", "day"))
    doubled = days.join(named.where(F.col("_listed") > 1), "repo_full_name", "left_semi")
    return results(doubled, Check("duplicate_keys", relation, severity, {"repo_full_name,day": F.count("*")}))


def orphans(
    df: DataFrame,
    relation: str,
    key: str,
    parents: DataFrame,
    parent_key: str,
    weight: Column | None = None,
    severity: str = WARN,
) -> DataFrame:
    """Rows whose key has no parent; NULL keys do not count.

    Rows are counted per key before the join, so a key with a third of the rows is one row in it.
    An anti join would not keep that order: Spark moves it below the count if it expects to
    broadcast the parents, and shuffles all rows if these turn out to be larger.
    """
    weight = F.lit(1) if weight is None else weight
    per_key = df.where(present(key)).groupBy(key).agg(F.sum(weight).alias("_rows"))
    known = parents.select(F.col(parent_key).alias(key)).distinct().withColumn("_known", F.lit(True))
    unknown = per_key.join(known, key, "left").where(F.col("_known").isNull())
    return results(unknown, Check("orphans", relation, severity, {key: F.sum("_rows")}))


def names_checks(
    counts: DataFrame, names: DataFrame, streams: dict[str, str], daily: str, ids_per_task: int
) -> tuple[DataFrame, list[Check]]:
    """What is tested on counts per repository and day and the `names` of the repositories together: records of unknown
    repositories for each stream (its relation, and the column of its counts), names that are listed more than once, days
    that the `daily` table made of both would hold more than once; and last the names that more than `ids_per_task` ids
    share, which is no failure but decides how they are joined.

    Gives the table to aggregate, a row per name, and the checks. The counts are read once for all of them.
    """
    weights = [F.sum(column).alias(column) for column in streams.values()]
    per_name = counts.where(present("repo_full_name")).groupBy("repo_full_name").agg(
        *weights, F.count_if(present("day")).alias("days")
    )
    unknown, twice = F.col("listed").isNull(), F.col("listed") > 1
    found = [
        Check("orphans", relation, WARN, {"repo_full_name": F.sum(F.when(unknown, F.col(column)))})
        for relation, column in streams.items()
    ]
    found.append(Check("duplicate_keys", "repositories", ERROR, {"repo_full_name": F.count_if(twice)}))
    found.append(Check("duplicate_keys", daily, ERROR, {"repo_full_name,day": F.sum(F.when(twice, F.col("days")))}))
    found.append(Check("crowded_names", "repositories", WARN, {"repo_full_name": F.count_if(F.col("ids") > ids_per_task)}))
    return per_name.join(names, "repo_full_name", "full_outer"), found


def measures_check(relation: str, severity: str = ERROR) -> Check:
    failures = {m: F.count_if(F.col(m) < 0) for m in MEASURES}
    failures["prs_merged<=prs_created"] = F.count_if(F.col("prs_merged") > F.col("prs_created"))
    return Check("bad_measures", relation, severity, failures)


def bad_measures(daily: DataFrame, relation: str, severity: str = ERROR) -> DataFrame:
    """Negative counts, and days with more merged pull requests than created ones."""
    return results(daily, measures_check(relation, severity))


def judge(rows: Sequence[Row], enforce: bool = True) -> list[Row]:
    """The rows of checks; raises if one of severity `error` found anything, unless the checks are not to be enforced."""
    failed = [row for row in rows if row.severity == ERROR and row.failures > 0]
    if failed and enforce:
        raise ChecksFailed(failed)
    return list(rows)


def gate(*checks: DataFrame, enforce: bool = True) -> list[Row]:
    """Run the checks and `judge` their rows."""
    return judge(functools.reduce(DataFrame.unionByName, checks).collect(), enforce)
