"""The layers as catalog databases: raw tables over landed files, and a staging view on each.

Views are expanded and pruned per query: a column nobody reads is not parsed, and so cannot fail.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from repopulse.operators.staging import staging_columns
from repopulse.session import apply_settings
from repopulse.sinks import described, ensure_layer, put_view, qualified, quoted, text_literal
from repopulse.sources.layout import TABLES, raw_schema


def _version(name: str, definition: str) -> str:
    """Name of the table that a definition makes. The same definition makes the same table."""
    return f"{name}__{hashlib.sha256(definition.encode()).hexdigest()[:16]}"


def _versions(spark: SparkSession, name: str, layer: str) -> list[str]:
    """The tables over landed files that stand or stood behind a raw name."""
    found = spark.sql(f"SHOW TABLES IN {quoted(layer)} LIKE {text_literal(name + '__*')}").collect()
    start, names = len(name) + 2, [row.tableName for row in found if not row.isTemporary]
    return [n for n in names if len(n) == start + 16 and set(n[start:]) <= set("0123456789abcdef")]


def _require_raw(spark: SparkSession, name: str, layer: str) -> None:
    """Raise where something else than a raw name stands under it."""
    view = qualified(name, layer)
    if spark.catalog.tableExists(view):
        about = described(spark, view)
        own = f"SELECT * FROM {quoted(layer)}.`{name.replace('`', '``')}__"
        if about.get("Type") != "VIEW" or not about.get("View Text", "").startswith(own):
            raise ValueError(f"{view} is {about.get('Type')}, not a raw table")


def register_raw(
    spark: SparkSession,
    root: str,
    layer: str = "raw",
    fmt: str = "parquet",
    times: str = "timestamp",
    objects: str = "string",
    tables: Sequence[str] = TABLES,
    prefix: str = "",
    path: str = "{table}",
) -> None:
    """Raw tables over the folders `<root>/<table>`, or those that `path` says. The files stay where they are.

    A raw name is a view on a table over the files, which is named after its definition: folder, format and types. To
    register it anew makes the new table beside the old one, if there is no such table yet, points the view to it in one
    statement and then drops the old entry. So readers find one definition or the other at any time, and where a table
    cannot be made, all names are as before. Anything else that stands under one of the names raises before that.
    """
    apply_settings(spark)
    ensure_layer(spark, layer)
    options = " OPTIONS (mode 'FAILFAST')" if fmt == "json" else ""
    for table in tables:
        _require_raw(spark, prefix + table, layer)
    made: dict[str, str] = {}
    new: list[str] = []
    try:
        for table in tables:
            columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in raw_schema(table, times, objects))
            place = text_literal(f"{root.rstrip('/')}/{path.format(table=table)}")
            definition = f"({columns}) USING {fmt}{options} LOCATION {place}"
            made[table] = _version(prefix + table, definition)
            stored = qualified(made[table], layer)
            if not spark.catalog.tableExists(stored):
                spark.sql(f"CREATE TABLE {stored} {definition}")
                new.append(stored)
    except Exception:
        for stored in new:
            spark.sql(f"DROP TABLE IF EXISTS {stored}")
        raise
    for table, version in made.items():
        put_view(spark, qualified(prefix + table, layer), f"SELECT * FROM {qualified(version, layer)}")
    for table, version in made.items():
        for old in _versions(spark, prefix + table, layer):
            if old != version and described(spark, qualified(old, layer)).get("Type") == "EXTERNAL":
                spark.sql(f"DROP TABLE IF EXISTS {qualified(old, layer)}")


def create_staging_views(
    spark: SparkSession,
    layer: str = "staging",
    raw_layer: str = "raw",
    tables: Sequence[str] = TABLES,
    prefix: str = "",
    raw_prefix: str = "",
) -> None:
    """One view per raw table, kept in the catalog for later sessions. One that exists is altered in one step."""
    apply_settings(spark)
    ensure_layer(spark, layer)
    for table in tables:
        raw = qualified(raw_prefix + table, raw_layer)
        columns = ", ".join(staging_columns(table, spark.table(raw).schema))
        put_view(spark, qualified(prefix + table, layer), f"SELECT {columns} FROM {raw}")


def raw_frames(spark: SparkSession, layer: str = "raw", prefix: str = "") -> dict[str, DataFrame]:
    apply_settings(spark)
    return {table: spark.table(qualified(prefix + table, layer)) for table in TABLES}
