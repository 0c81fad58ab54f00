"""Readers for landed raw records. Schemas are stated, never inferred: inference costs a scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from repopulse.session import apply_settings
from repopulse.sources.layout import TABLES, raw_schema


def read_raw(
    spark: SparkSession,
    root: str,
    table: str,
    fmt: str = "parquet",
    times: str = "timestamp",
    objects: str = "string",
) -> DataFrame:
    """One raw table from `<root>/<table>`.

    `fmt="json"` reads landed records, one JSON object per line; a malformed line raises.
    `times="string"` reads Parquet that keeps timestamps as ISO text; typed files are better, since
    filters on a day reach the scan. `objects="variant"` reads embedded objects as variants: from
    JSON lines they are then parsed once, and from Parquet the scan can return only the parts read.
    """
    apply_settings(spark)
    reader = spark.read.schema(raw_schema(table, times, objects))
    if fmt == "json":
        reader = reader.option("mode", "FAILFAST")
    return reader.format(fmt).load(f"{root.rstrip('/')}/{table}")


def read_all(
    spark: SparkSession, root: str, fmt: str = "parquet", times: str = "timestamp", objects: str = "string"
) -> dict[str, DataFrame]:
    """All five raw tables below one folder."""
    return {table: read_raw(spark, root, table, fmt, times, objects) for table in TABLES}
