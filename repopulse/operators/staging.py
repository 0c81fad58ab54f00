"""Typed, renamed projections of the raw tables: no filter, no dedup, no order, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType, VariantType

from repopulse.functions import json_text
from repopulse.sources.layout import LAYOUT, Staged


def _expression(column: Staged, raw: StructType) -> str:
    value = f"`{column.field}`"  # quoted: `user` is a reserved word
    if column.path:
        value = json_text(value, column.path, isinstance(raw[column.field].dataType, VariantType))
    if column.kind == "counter":
        return f"cast(coalesce({value}, 0) as long) as `{column.name}`"
    return f"cast({value} as {column.kind}) as `{column.name}`"


def staging_columns(table: str, raw: StructType) -> list[str]:
    """Expressions of the staged columns over a raw schema, for a projection or a view."""
    return [_expression(column, raw) for column in LAYOUT[table]]


def stage(table: str, raw: DataFrame) -> DataFrame:
    return raw.selectExpr(*staging_columns(table, raw.schema))


def stage_comments(raw: DataFrame) -> DataFrame:
    return stage("comments", raw)


def stage_issues(raw: DataFrame) -> DataFrame:
    return stage("issues", raw)


def stage_pull_requests(raw: DataFrame) -> DataFrame:
    return stage("pull_requests", raw)


def stage_repositories(raw: DataFrame) -> DataFrame:
    return stage("repositories", raw)


def stage_users(raw: DataFrame) -> DataFrame:
    return stage("users", raw)


def stage_all(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {table: stage(table, frame) for table, frame in raw.items()}
