"""Landed JSON lines as Parquet, with the lines that cannot be read put aside.

A reader that stops at the first bad line (`read_raw`) is right where the files are known to be good. Here each table is
parsed once, all of it, and written once: records as raw rows, and lines that are no record, or hold a value of
another type than the table has, as they are, with the file they come from. Both are counted on their way, so the
check of the bad ones costs no scan.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from repopulse.operators import checks
from repopulse.session import apply_settings
from repopulse.sources.layout import TABLES, raw_schema

#: The columns of what is put aside, and the folder of each part below that of the table.
RECORD, SOURCE, ASIDE = "record", "source_file", "quarantined"
GOOD = f"{{table}}/{ASIDE}=false"


@dataclass(frozen=True)
class Landed:
    """The raw tables, what was put aside (relation, record, source_file), and a check row per table."""

    raw: dict[str, DataFrame]
    quarantine: DataFrame
    checks: list[Row]


def unreadable_check(relation: str, severity: str = checks.WARN) -> checks.Check:
    return checks.Check("unreadable_records", relation, severity, {RECORD: F.count_if(F.col(RECORD).isNotNull())})


@contextlib.contextmanager
def _both_parts_open(spark: SparkSession) -> Iterator[None]:
    """While it lasts, a task keeps the files of both parts open instead of sorting its rows, which may be many where
    packed files are read."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, "2")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def land_table(
    spark: SparkSession,
    root: str,
    table: str,
    folder: str,
    times: str = "timestamp",
    objects: str = "string",
    severity: str = checks.WARN,
) -> Row:
    """Write the landed lines of `<root>/<table>` to `<folder>/<table>` and return the check row of the bad ones."""
    schema = raw_schema(table, times, objects)
    wide = raw_schema(table, times, objects).add(RECORD, "string")
    reader = spark.read.schema(wide).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RECORD)
    lines = reader.json(f"{root.rstrip('/')}/{table}").select("*", F.col("_metadata.file_path").alias(SOURCE))
    bad = F.col(RECORD).isNotNull()
    rows = lines.select(
        # What could be read of a bad line is no record.
        *[F.when(~bad, F.col(f"`{f.name}`")).alias(f.name) for f in schema],
        RECORD,
        F.when(bad, F.col(SOURCE)).alias(SOURCE),
        bad.alias(ASIDE),
    )
    observation, check = Observation(f"landing {table}"), unreadable_check(table, severity)
    rows = checks.observed(rows, observation, check)
    with _both_parts_open(spark):
        rows.write.mode("errorifexists").partitionBy(ASIDE).parquet(f"{folder.rstrip('/')}/{table}")
    return checks.observed_rows(observation, check)[0]


def _stored(spark: SparkSession, folder: str, table: str, times: str, objects: str) -> DataFrame:
    schema = raw_schema(table, times, objects).add(RECORD, "string").add(SOURCE, "string").add(ASIDE, "boolean")
    return spark.read.schema(schema).parquet(f"{folder.rstrip('/')}/{table}")


def read_landed(spark: SparkSession, folder: str, table: str, times: str = "timestamp", objects: str = "string") -> DataFrame:
    """The records of one table."""
    apply_settings(spark)
    return _stored(spark, folder, table, times, objects).where(f"not {ASIDE}").drop(RECORD, SOURCE, ASIDE)


def read_quarantine(
    spark: SparkSession, folder: str, tables: Sequence[str] = TABLES, times: str = "timestamp", objects: str = "string"
) -> DataFrame:
    """(relation, record, source_file): the lines that were put aside. Only their part of the files is read."""
    found = None
    for table in tables:
        own = _stored(spark, folder, table, times, objects).where(ASIDE).select(F.lit(table).alias("relation"), RECORD, SOURCE)
        found = own if found is None else found.unionByName(own)
    return found


def land(
    spark: SparkSession,
    root: str,
    folder: str,
    tables: Sequence[str] = TABLES,
    times: str = "timestamp",
    objects: str = "string",
    severity: str = checks.WARN,
    enforce: bool = True,
) -> Landed:
    """Land the tables below `root` in a new folder. With `severity="error"` a line that cannot be read raises after all
    tables are written, so that what was put aside can be looked at."""
    apply_settings(spark)
    rows = [land_table(spark, root, table, folder, times, objects, severity) for table in tables]
    raw = {table: read_landed(spark, folder, table, times, objects) for table in tables}
    return Landed(raw, read_quarantine(spark, folder, tables, times, objects), checks.judge(rows, enforce))
