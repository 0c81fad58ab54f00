from __future__ import annotations

import datetime
import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def json_text(value: str, path: str, parsed: bool = False) -> str:
    """Expression for the text at a path of JSON text, or of a variant if it is `parsed` already.
    Malformed JSON raises; a missing key, a JSON null or a parent that is no object gives NULL."""
    variant = value if parsed else f"parse_json({value})"
    return f"variant_get({variant}, '{path}', 'string')"


def present(*names: str) -> Column:
    """True where no named column is NULL. Unlike `dropna`, it reaches the scan."""
    return functools.reduce(lambda a, b: a & b, (F.col(name).isNotNull() for name in names))


def day_of(moment: str) -> str:
    """Expression for the calendar day in the session zone. Written as `to_date`, since a filter
    on it then becomes a range on the timestamp in the scan; a filter on `date_trunc` does not."""
    return f"to_date({moment})"


def as_date(day: datetime.date | str | Column | None) -> Column:
    """A day given as a date, ISO text or column; today when none is given."""
    if day is None:
        return F.current_date()
    return day if isinstance(day, Column) else F.lit(day).cast("date")


def repeat_rows(df: DataFrame, times: str, copy: str | None = None, block: int = 10_000) -> DataFrame:
    """Each row as often as the column `times` says, and that column dropped; `copy` names a column
    for the number of the copy, if wanted.

    Rows are opened in blocks, so no array grows with the whole number of copies.
    """
    kept = [name for name in df.columns if name != times]
    blocks = f"explode(sequence(0, ({times} - 1) div {block})) as _block"
    rows = f"explode(sequence(1, least({block}, {times} - _block * {block}))) as _copy"
    number = [f"_block * {block} + _copy as {copy}"] if copy else []
    return df.selectExpr("*", blocks).selectExpr(*kept, "_block", rows).selectExpr(*kept, *number)
