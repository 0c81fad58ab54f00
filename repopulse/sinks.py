"""Views, stored tables, and the swap from one run of a set of tables to the next.

The runs of a table are partitions of `<layer>.<name>__runs`, each written to a folder of its own and listed when
it is whole. Readers use the view `<layer>.<name>`, which shows the run that the set's pointer names. The pointer
is a view of one constant row, and to alter it is one statement in the catalog: all tables of the set go from one run to
the next together, and a query that reads several of them sees one run. A failed run changes nothing for readers.

The pointer also holds when each run was published, so that a run is kept as long as somebody may still read it.

A view that exists is always altered: to create or replace it would drop it first, and readers could find none.
"""

from __future__ import annotations

import datetime
import re
from collections.abc import Callable, Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_LAYER = "default"
POINTER = "published_run"
RUN = "run"
#: Run names become folder names.
RUN_NAME = re.compile(r"[A-Za-z0-9_.-]+")
NO_HOLD = datetime.timedelta(0)


def quoted(name: str) -> str:
    """A name as SQL takes it, whatever signs it has."""
    return "`" + name.replace("`", "``") + "`"


def text_literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def qualified(name: str, layer: str | None = None) -> str:
    """A given layer is used as it is, without a prefix; none means the default one."""
    return f"{quoted(layer or DEFAULT_LAYER)}.{quoted(name)}"


def same_place(spark: SparkSession, one: str, other: str) -> bool:
    """Whether two locations are the same folder of the same file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()

    def whole(place: str) -> str:
        # The catalog gives locations as URIs, with signs such as spaces encoded.
        found = path(unquote(place) if re.match(r"[a-z0-9+.-]+:", place) else place)
        return found.getFileSystem(conf).makeQualified(found).toString().rstrip("/")

    return whole(one) == whole(other)


def ensure_layer(spark: SparkSession, layer: str, location: str | None = None) -> None:
    """Create a layer. One that is there already must have the location that is asked for."""
    if location and spark.catalog.databaseExists(quoted(layer)):
        there = spark.catalog.getDatabase(quoted(layer)).locationUri
        if not same_place(spark, there, location):
            raise ValueError(f"layer {layer} is at {there}, not at {location}")
    place = f" LOCATION {text_literal(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(layer)}{place}")


def drop_layer(spark: SparkSession, layer: str) -> None:
    """Drop a work layer and the tables stored in it."""
    spark.sql(f"DROP DATABASE IF EXISTS {quoted(layer)} CASCADE")


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Name a relation without storing it."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def described(spark: SparkSession, table: str) -> dict[str, str]:
    """What the catalog says of a table: its type, place, view text and so on."""
    rows = spark.sql(f"DESCRIBE EXTENDED {table}").collect()
    names = [row.col_name for row in rows]
    start = names.index("# Detailed Table Information") if "# Detailed Table Information" in names else 0
    return {row.col_name: row.data_type for row in rows[start:]}


def put_view(spark: SparkSession, view: str, query: str, columns: str = "", comment: str | None = None) -> bool:
    """Make a view, or let one that exists show another query, in one step; whether it is new. Of one that exists the
    columns keep the comments that they were made with."""
    if not spark.catalog.tableExists(view):
        said = f" COMMENT {text_literal(comment)}" if comment is not None else ""
        spark.sql(f"CREATE VIEW {view} {columns}{said} AS {query}")
        return True
    if described(spark, view).get("View Text") != query:
        spark.sql(f"ALTER VIEW {view} AS {query}")
    if comment is not None and spark.catalog.getTable(view).description != comment:
        spark.sql(f"ALTER VIEW {view} SET TBLPROPERTIES ('comment' = {text_literal(comment)})")
    return False


def column_types(df: DataFrame) -> str:
    return ", ".join(f"{quoted(field.name)} {field.dataType.simpleString()}" for field in df.schema)


def write_bucketed(
    df: DataFrame,
    name: str,
    layer: str | None,
    by: str,
    buckets: int | None = None,
    watched: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """Store a table in buckets of one column, each in one file sorted by it, and return it as read back.

    Tables with the same number of buckets of the same column are joined and grouped by it without a shuffle. There
    are as many as the session has shuffle partitions, where no number is given. `watched` puts observed metrics on the
    rows as they are written, after the shuffle, where a task that is run again is not counted again.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = watched(df.repartition(buckets, F.col(by)))
    table = qualified(name, layer)
    rows.write.mode("errorifexists").format("parquet").bucketBy(buckets, by).sortBy(by).saveAsTable(table)
    return spark.table(table)


def runs_table(name: str) -> str:
    return f"{name}__runs"


def write_table(df: DataFrame, name: str, layer: str | None = None) -> DataFrame:
    """Store a work table and return it as read back."""
    table = qualified(name, layer)
    df.write.mode("errorifexists").format("parquet").saveAsTable(table)
    return df.sparkSession.table(table)


def run_frame(spark: SparkSession, name: str, run: str, layer: str | None = None) -> DataFrame:
    """One run of a table, whichever is published."""
    return spark.table(qualified(runs_table(name), layer)).where(F.col(RUN) == run).drop(RUN)


def write_run(
    df: DataFrame,
    name: str,
    run: str,
    layer: str | None = None,
    order: Sequence[str | Column] = (),
    spread: str | None = None,
    row_group: int | None = None,
) -> DataFrame:
    """Store one run of a table and return it as read back.

    `order` spreads the rows over the files by range and sorts each file, so that the statistics
    in a file rule parts of it out for filters on the leading columns. The number of files follows from the
    size: adaptive execution merges small ranges. `spread` names a column that tells rows apart which
    are equal in the others, so that very many of them make several ranges; it is not stored. `row_group` is the
    size, in bytes, of the parts that statistics are kept for.
    """
    if not RUN_NAME.fullmatch(run):
        raise ValueError(f"{run!r} is no run name")
    spark = df.sparkSession
    if order:
        ranges = [*order, spread] if spread else order
        df = df.repartitionByRange(*ranges).sortWithinPartitions(*order)
    if spread:
        df = df.drop(spread)
    table = qualified(runs_table(name), layer)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({column_types(df)}, {RUN} STRING) USING parquet PARTITIONED BY ({RUN})")
    if (there := spark.table(table).drop(RUN).dtypes) != df.dtypes:
        raise ValueError(f"{table} has the columns {there}, not {df.dtypes}")
    folder = f"{unquote(described(spark, table)['Location'])}/{RUN}={run}"
    writer = df.write.mode("errorifexists")
    if row_group:
        writer = writer.option("parquet.block.size", row_group)
    writer.parquet(folder)
    spark.sql(f"ALTER TABLE {table} ADD PARTITION ({RUN} = {text_literal(run)})")
    return run_frame(spark, name, run, layer)


def runs(spark: SparkSession, name: str, layer: str | None = None) -> list[str]:
    """Stored runs of a table, in name order."""
    table = qualified(runs_table(name), layer)
    if not spark.catalog.tableExists(table):
        return []
    return sorted(row.partition.removeprefix(f"{RUN}=") for row in spark.sql(f"SHOW PARTITIONS {table}").collect())


def drop_run(spark: SparkSession, name: str, run: str, layer: str | None = None) -> None:
    """Drop a run, and what a failed one has written but not listed."""
    table = qualified(runs_table(name), layer)
    if spark.catalog.tableExists(table):
        partition = f"PARTITION ({RUN} = {text_literal(run)})"
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {partition}")
        spark.sql(f"ALTER TABLE {table} DROP {partition}")


def _shown(columns: str, name: str, layer: str | None, pointer: str) -> str:
    """The text of a view that shows the published run."""
    return f"SELECT {columns} FROM {qualified(runs_table(name), layer)} WHERE {RUN} = (SELECT {RUN} FROM {pointer})"


def published_by(spark: SparkSession, name: str, layer: str | None = None) -> str | None:
    """The pointer that a published table follows; none if it was never published. Raises if something else than
    a published table stands under the name, which a later `publish` could not replace."""
    view = qualified(name, layer)
    if not spark.catalog.tableExists(view):
        return None
    about = described(spark, view)
    text = re.escape(_shown("@", name, layer, "@")).replace("@", "(.*)", 1).replace("@", r"(`.*`\.`.*`)", 1)
    found = re.fullmatch(text, about.get("View Text", ""), re.DOTALL)
    if about.get("Type") != "VIEW" or not found:
        raise ValueError(f"{view} is no published table")
    return found[2]


def require_free(spark: SparkSession, names: Sequence[str], layer: str | None = None, pointer: str = POINTER) -> None:
    """Raise where the names of a set are taken by something that `publish_all` could not replace: no published tables,
    tables of another set, or no pointer."""
    place = qualified(pointer, layer)
    if spark.catalog.tableExists(place):
        text = described(spark, place).get("View Text", "")
        if not re.match(rf"SELECT '.*' AS {RUN}, map\(", text):
            raise ValueError(f"{place} is no pointer to a run")
    for name in names:
        if (now := published_by(spark, name, layer)) not in (None, place):
            raise ValueError(f"{qualified(name, layer)} follows {now}, not {place}")


def _pointed_to(spark: SparkSession, pointer: str) -> str | None:
    return spark.table(pointer).first()[RUN] if spark.catalog.tableExists(pointer) else None


def published_run(spark: SparkSession, name: str, layer: str | None = None) -> str | None:
    """The run that readers of a table see; none if it was never published. Raises as `published_by` does."""
    pointer = published_by(spark, name, layer)
    return None if pointer is None else _pointed_to(spark, pointer)


def publications(spark: SparkSession, pointer: str) -> dict[str, datetime.datetime]:
    """When each run was published last, for those that the pointer still remembers."""
    if not spark.catalog.tableExists(pointer):
        return {}
    known = spark.table(pointer).first().published
    return {run: datetime.datetime.fromisoformat(when) for run, when in known.items()}


def point_to(spark: SparkSession, pointer: str, run: str, remembered: Mapping[str, datetime.datetime]) -> None:
    """Show a run to all readers of the set, in one statement."""
    known = {**remembered, run: datetime.datetime.now(datetime.timezone.utc)}
    times = ", ".join(f"{text_literal(r)}, {text_literal(when.isoformat())}" for r, when in known.items())
    query = f"SELECT {text_literal(run)} AS {RUN}, map({times}) AS published"
    put_view(spark, pointer, query, comment="The run that readers see, and when this one and those before it were published")


def publish_all(
    spark: SparkSession,
    names: Sequence[str],
    run: str,
    layer: str | None = None,
    comments: Mapping[str, str] | None = None,
    column_comments: Mapping[str, str] | None = None,
    pointer: str = POINTER,
) -> list[DataFrame]:
    """Publish one run of several tables together.

    The views are made first, or altered where their definition has changed; they show the run that they showed before.
    Then the pointer is altered.
    If anything fails, readers have what they had. Where nothing was published before, views come one after the other
    but show the same run.
    """
    place, comments, columns_said = qualified(pointer, layer), comments or {}, column_comments or {}
    for name in names:
        if run not in runs(spark, name, layer):
            raise ValueError(f"run {run} of {name} is not stored")
    require_free(spark, names, layer, pointer)
    stored = {r for name in names for r in runs(spark, name, layer)}
    remembered = {r: when for r, when in publications(spark, place).items() if r in stored}
    before, made = _pointed_to(spark, place), []
    try:
        if before is None:
            point_to(spark, place, run, remembered)
        for name in names:
            view = qualified(name, layer)
            columns = spark.table(qualified(runs_table(name), layer)).drop(RUN).columns
            said = ", ".join(quoted(c) + (f" COMMENT {text_literal(columns_said[c])}" if c in columns_said else "") for c in columns)
            query = _shown(", ".join(map(quoted, columns)), name, layer, place)
            if put_view(spark, view, query, f"({said})", comments.get(name, "")):
                made.append(view)
        if before is not None:
            point_to(spark, place, run, remembered)
    except Exception:
        for view in [*made, place] if before is None else made:
            spark.sql(f"DROP VIEW IF EXISTS {view}")
        raise
    return [spark.table(qualified(name, layer)) for name in names]


def publish(
    spark: SparkSession,
    name: str,
    run: str,
    layer: str | None = None,
    comment: str = "",
    column_comments: Mapping[str, str] | None = None,
) -> DataFrame:
    """Publish a run of a table that is a set of its own."""
    return publish_all(spark, [name], run, layer, {name: comment}, column_comments, f"{name}__{POINTER}")[0]


def published(spark: SparkSession, names: Sequence[str], layer: str | None = None) -> dict[str, DataFrame]:
    """The tables of a set, all of the one run that is published now; later refreshes do not change these frames."""
    pointers = {published_by(spark, name, layer) for name in names}
    if len(pointers) != 1 or None in pointers:
        raise ValueError(f"{', '.join(names)} are not published together")
    run = _pointed_to(spark, pointers.pop())
    return {name: run_frame(spark, name, run, layer) for name in names}


def _last_read(run: str, current: str, known: Mapping[str, datetime.datetime]) -> datetime.datetime | None:
    """When a run could last be found by a reader: until the next one was published. Of a run that was never published
    its start; none where neither is known."""
    if run == current:
        return None
    if run in known:
        later = [when for when in known.values() if when > known[run]]
        return min(later, default=None)
    started = re.match(r"\d{20}(?=_)", run)
    return datetime.datetime.strptime(started[0] + "+0000", "%Y%m%d%H%M%S%f%z") if started else None


def retire(
    spark: SparkSession,
    name: str,
    published: str,
    keep: int,
    layer: str | None = None,
    hold: datetime.timedelta = NO_HOLD,
) -> list[str]:
    """Drop old runs: not the published one, not the last `keep`, and none that a reader could have found within
    `hold`, counted from when the next run was published. With a hold, runs of which no time is known stay."""
    if keep < 1:
        raise ValueError("keep must be at least 1")
    pointer = published_by(spark, name, layer)
    known = publications(spark, pointer) if pointer else {}
    now = datetime.datetime.now(datetime.timezone.utc)
    old = []
    for run in runs(spark, name, layer)[:-keep]:
        last = _last_read(run, published, known)
        if run != published and (not hold or (last is not None and now - last >= hold)):
            old.append(run)
    for run in old:
        drop_run(spark, name, run, layer)
    return old
