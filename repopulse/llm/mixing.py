"""Mixing sources to target weights by weighted fair queueing.

Sources get shares of a word budget by weight. A source may be gone through several times, and what it could
not fill even then goes to the others, by their weights. Each copy of a document has a virtual finish time: the
words of its source up to and with it, divided by the source's weight. All copies, in order of their finish times,
are the mix; it ends where the budget does. So every beginning of the mix has the sources in proportion, and a source
that has run out leaves its share to the others, as the targets say.

Documents are shuffled by a digest of their id, so the mix depends on the documents and the seed alone, and not on
partitions or the order of rows. Finish times are whole numbers, for they are multiplied by a common multiple of
the weights; nothing is rounded.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repopulse.llm.order import matched, ranged, running
from repopulse.llm.store import stored

#: Weights of the sources in order of their names, over and over.
WEIGHTS = (5, 2, 1)
#: How often a document is taken at most.
PASSES = 3

WORD = r"[^\x20\x09-\x0D]+"


class Level(NamedTuple):
    """Sources that are not full share `rest` words by their weights, which add up to `weight`."""

    rest: int
    weight: int


def _sized(docs: DataFrame, seed: str) -> DataFrame:
    key = F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "source",
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        F.substring(F.md5(key), 1, 16).alias("shuffled"),
    )


def _sources(rows: DataFrame, weights: Sequence[int]) -> DataFrame:
    """(source, source_size, place, weight): `place` counts the sources in code point order, null last.

    Rows are in order of their source, so a source is counted in the range that it begins in; no task sees all
    sources, only the number of them that begin in each range.
    """
    found = rows.groupBy("source").agg(F.min("part").alias("first"), F.sum("size").alias("source_size"))
    found = stored(found, "sources")
    begun = found.groupBy("first").agg(F.count("*").alias("many"))
    earlier = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    begun = begun.select("first", F.coalesce(F.sum("many").over(earlier), F.lit(0)).alias("earlier"))
    own = F.row_number().over(Window.partitionBy("first").orderBy(F.col("source").asc_nulls_last())) - 1
    placed = found.withColumn("own", own).join(begun, "first").select("source", "source_size", (F.col("earlier") + F.col("own")).alias("place"))
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    weight = F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int"))
    return stored(placed.withColumn("weight", weight.cast("long")), "weighted")


def _full(level: Level, passes: int) -> Column:
    """Whether a source's share is all that it can give, or more."""
    wide = "decimal(38,0)"
    most = F.col("source_size").cast(wide) * passes * F.lit(level.weight).cast(wide)
    return most <= F.lit(level.rest).cast(wide) * F.col("weight").cast(wide)


def fill_level(sources: DataFrame, budget: int, passes: int) -> Level:
    """Share the budget, take out the sources that are full, share the rest again, until none is above what
    it can give. Each round is one aggregation of the sources, and a row of it comes here."""
    weight = sources.agg(F.sum("weight")).first()[0] or 0
    level = Level(budget, int(weight))
    while True:
        full = _full(level, passes)
        given, still = sources.agg(
            F.sum(F.when(full, F.col("source_size") * passes)), F.sum(F.when(~full, F.col("weight")))
        ).first()
        again = Level(budget - int(given or 0), int(still or 0))
        if again == level:
            return level
        level = again


def _target(level: Level, passes: int) -> Column:
    share = (F.lit(level.rest) * F.col("weight")).cast("double") / F.lit(max(1, level.weight))
    return F.when(_full(level, passes), (F.col("source_size") * passes).cast("double")).otherwise(share)


def _last_taken(copies: DataFrame, budget: int) -> tuple[int, int] | None:
    """(finish, place) of the last copy in the mix, none if it is empty. Copies are sorted globally; the words of
    each range come here, and only the range in which the budget ends is gone through copy by copy."""
    order = ["finish", "place"]
    rows = ranged(copies, order, "copies")
    words = rows.groupBy("part").agg(F.sum("size").alias("words"), F.max(F.struct(*order)).alias("last"))
    left, last = budget, None
    for part in words.orderBy("part").collect():
        if part.words <= left:
            left, last = left - part.words, tuple(part.last)
            continue
        inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        within = rows.where(F.col("part") == part.part).withColumn("words", F.sum("size").over(inside))
        found = within.where(F.col("words") <= left).agg(F.max(F.struct(*order)).alias("last")).first().last
        return tuple(found) if found is not None else last
    return last


def schedule(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    passes: int = PASSES,
    budget: int | None = None,
    seed: str = "",
) -> DataFrame:
    """Per row of `docs`: doc_id, source, size, source_size, target, finish (of its first copy), step (from one copy to
    the next), place and copies, the number of times that the mix takes it.

    `docs` has doc_id, source and text; other columns are ignored. The size is the number of words, 0 for a null
    or empty text, which is never taken. The budget is the words of all documents where none is given. A null source
    is one of its own, the last. Rows with equal or null ids are documents of their own. An empty table gives none.
    Weights are positive whole numbers, by place of the source.
    """
    if not weights or min(weights) < 1 or passes < 1:
        raise ValueError("weights and passes must be at least 1")
    order = [F.col("source").asc_nulls_last(), "shuffled", "doc_id", "size"]
    rows = ranged(stored(_sized(docs, seed), "sized"), order, "shuffled")
    sources = _sources(rows, weights)
    total = int(sources.agg(F.sum("source_size")).first()[0] or 0)
    budget = total if budget is None else budget
    level = fill_level(sources, budget, passes)
    unit = math.lcm(*weights)
    known = sources.withColumn("target", _target(level, passes)).withColumn("slow", F.lit(unit) / F.col("weight"))
    known = known.withColumn("slow", F.col("slow").cast("long"))
    # A range meets the few sources that it holds, so a source of any size is as many small joins.
    held = rows.select("part", "source").distinct().alias("h")
    known = held.join(known.alias("s"), matched("h", "s", "source")).select("h.part", "s.*")
    known = stored(known, "held")
    upto = running(rows, ["source"], order[1:], "size", "upto").alias("r")
    placed = upto.join(known.alias("k"), matched("r", "k", "part", "source")).select(
        "r.doc_id",
        "r.source",
        "r.size",
        "k.source_size",
        "k.target",
        (F.col("r.upto") * F.col("k.slow")).alias("finish"),
        (F.col("k.source_size") * F.col("k.slow")).alias("step"),
        "k.place",
    )
    placed = stored(placed, "placed")
    copy = F.explode(F.sequence(F.lit(0), F.lit(passes - 1))).alias("copy")
    copies = placed.where("size > 0").select("finish", "step", "place", "size", copy)
    copies = copies.select((F.col("finish") + F.col("copy") * F.col("step")).alias("finish"), "place", "size")
    last = _last_taken(copies, budget)
    if last is None:
        return placed.withColumn("copies", F.lit(0).cast("long"))
    taken = F.lit(0)
    for k in range(passes):
        finish = F.col("finish") + k * F.col("step")
        within = (finish < last[0]) | ((finish == last[0]) & (F.col("place") <= last[1]))
        taken = taken + within.cast("long")
    return placed.withColumn("copies", F.when(F.col("size") > 0, taken).otherwise(0).cast("long"))


def mix(planned: DataFrame) -> DataFrame:
    """The mix that `schedule` has planned, a row per copy: doc_id, source, size, copy (from 0) and finish. In order of
    finish and source every beginning of it is mixed as the whole."""
    copy = F.explode(F.sequence(F.lit(0), (F.col("copies") - 1).cast("int"))).alias("copy")
    taken = planned.where("copies > 0").select("doc_id", "source", "size", "finish", "step", copy)
    return taken.select("doc_id", "source", "size", "copy", (F.col("finish") + F.col("copy") * F.col("step")).alias("finish"))


def taken_words(planned: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken): the words that the mix takes of each document, copies counted."""
    return planned.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


ORACLE = r"""
with sized as (
    select row_number() over () as entry, doc_id, source,
           len(regexp_extract_all(coalesce("text", ''), '[^\x20\x09-\x0D]+')) as size,
           substr(md5(coalesce(cast(doc_id as varchar), '')), 1, 16) as shuffled from documents),
counted as (select source, cast(sum(size) as bigint) as source_size,
                   row_number() over (order by source nulls last) - 1 as place from sized group by source),
weighted as (select *, [5, 2, 1][place % 3 + 1] as weight from counted),
-- Sources by how soon they are full: what is left for each and those after it when all before it are full.
shares as (
    select *, sum(source_size) over () - 3 * coalesce(sum(source_size) over (soon rows between unbounded preceding
                  and 1 preceding), 0) as rest,
           sum(weight) over (soon rows between current row and unbounded following) as open_weight
    from weighted window soon as (order by source_size / weight, place)),
level as (select coalesce(arg_min(rest, (source_size / weight, place)), 0) as rest,
                 coalesce(arg_min(open_weight, (source_size / weight, place)), 0) as open_weight
          from shares where 3 * source_size * open_weight > rest * weight),
targets as (select w.*, case when 3 * source_size * l.open_weight <= l.rest * weight then cast(3 * source_size as double)
                             else cast(l.rest * weight as double) / greatest(1, l.open_weight) end as target
            from weighted w, level l),
queued as (
    select s.entry, s.doc_id, s.size, t.source_size, t.target, t.place, c.copy,
           (c.copy * t.source_size + sum(s.size) over (partition by s.source, c.copy order by s.shuffled, s.doc_id, s.size
                rows between unbounded preceding and current row)) * (10 // t.weight) as finish
    from sized s join targets t on s.source is not distinct from t.source, (select unnest([0, 1, 2]) as copy) c),
mixed as (select *, sum(size) over (order by finish, place, size rows between unbounded preceding and current row) as upto,
                 sum(size) over () // 3 as budget from queued)
select any_value(doc_id) as doc_id, cast(any_value(size) as bigint) as size, any_value(source_size) as source_size,
       any_value(target) as target, cast(sum(case when upto <= budget then size else 0 end) as bigint) as taken
from mixed group by entry
"""
