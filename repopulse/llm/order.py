"""Global order of a table without one task that holds a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repopulse.llm.store import stored


def ranged(df: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """The rows, stored in ranges of `order`, each range sorted, with `part`, the number of a row's range.

    Ranges are cut by the sizes of the data, so that a group of any size lies in as many as it fills.
    """
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(rows.withColumn("part", F.spark_partition_id()), name)


def matched(left: str, right: str, *names: str) -> Column:
    """Equality of columns of two tables by alias, nulls being equal."""
    found = F.lit(True)
    for name in names:
        found &= F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return found


def running(rows: DataFrame, group: Sequence[str], order: Sequence[str | Column], value: str, name: str) -> DataFrame:
    """`rows` of `ranged` with `name`: the sum of `value` over the rows of the same `group` up to this one.

    `rows` must be in order of the group first and `order` next. A window goes over one range of a group; what
    lies in earlier ranges is added from a table with a row per range and group, of which a group has no more
    rows than there are ranges.
    """
    totals = rows.groupBy("part", *group).agg(F.sum(value).alias("_total"))
    before = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(totals.withColumn("_before", F.coalesce(F.sum("_total").over(before), F.lit(0))), "offsets")
    inside = Window.partitionBy("part", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = rows.withColumn("_inside", F.sum(value).over(inside)).alias("r")
    joined = own.join(offsets.alias("o"), matched("r", "o", "part", *group))
    return joined.select("r.*", (F.col("o._before") + F.col("r._inside")).alias(name)).drop("_inside")
