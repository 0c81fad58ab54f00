"""Ranked lexical search without random access (NRA).

1. Documents are read once. Every `SHARD` documents of a task make a shard, and a shard has one posting list for
   each query term that it holds. Nothing is shuffled for that; the terms of all queries reach the tasks as a bitmap of
   fixed size, which lets a few others pass, and are joined exactly afterwards.
2. The numbers of documents and terms then give each posting its impact, and each list is sorted by it.
3. A task goes through its shards one after the other. For every query it reads the lists from the top, all down to
   the same impact, then on to the next lower one. A document's lower score is what has been read of it; its upper
   score adds what the lists it has not been seen in can still give, which the next unread impacts bound. Once a
   document not seen at all cannot reach the `k`-th best lower score, no further ones are let in, and those whose upper
   score is too low go. Lists are read on until the scores of all that are left are final, ties included.
4. The `k` best of a task raise the least score for its next shards. The best of all tasks are ranked at the end.

Terms are told apart by 64-bit hashes. Queries go in blocks, so what a task gets of them is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repopulse.llm import textops as T
from repopulse.llm.order import ranged, running
from repopulse.llm.store import IdFilter, stored

#: How many documents a query gets.
BEST = 10
#: Documents in a shard at most.
SHARD = 4096
#: Query terms that tasks get at a time, a query's own being kept together; 24 bytes each.
BLOCK_TERMS = 1 << 20

#: Bytes that are no part of a term: ASCII but for digits and letters.
BREAK = np.ones(256, np.uint8)
BREAK[0x30:0x3A] = BREAK[0x41:0x5B] = BREAK[0x61:0x7B] = BREAK[0x80:] = 0


class Corpus(NamedTuple):
    documents: int
    terms: int


def _counted(chunk: T.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and number of each different term of a row; and the number of all terms by row."""
    found = T.spans(BREAK[chunk.data], chunk)
    hashes = T.span_hashes(T.lower_ascii(chunk.data), found.start, found.end)
    order = np.lexsort((hashes, found.row))
    hashes, row = hashes[order], found.row[order]
    first = np.flatnonzero(np.r_[True, (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])]) if len(row) else row
    return row[first], T.signed(hashes[first]), np.diff(np.r_[first, len(row)]), T.per_row(row, chunk.rows)


def query_terms(queries: DataFrame) -> DataFrame:
    """(query, item_id, term, times), stored: a row for each different term of a query; `query` numbers the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.each(batches):
            for chunk in T.chunks(batch.column("text")):
                row, term, times, _ = _counted(chunk)
                own = batch.slice(chunk.first, chunk.rows)
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [own.column("query").take(at), own.column("item_id").take(at), pa.array(term), pa.array(times.astype(np.int64))],
                    names=["query", "item_id", "term", "times"],
                )

    numbered = queries.select(F.monotonically_increasing_id().alias("query"), "item_id", "text")
    return stored(numbered.mapInArrow(run, "query long, item_id long, term long, times long"), "query-terms")


def _lists(values: np.ndarray, edges: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(values, kind))


_RAW = pa.schema(
    [("shard", pa.int64()), ("term", pa.int64()), ("docs", pa.list_(pa.int32())), ("times", pa.list_(pa.int64())),
     ("lengths", pa.list_(pa.int64())), ("ids", pa.list_(pa.int64()))]
)


def _shard_rows(number: int, parts: list[tuple], ids: list[int | None], lengths: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """A row for each term of a shard with its postings, and one with the ids and lengths of all its documents."""
    doc, term, times = (np.concatenate(x) for x in zip(*parts))
    length = np.concatenate(lengths)
    order = np.lexsort((doc, term))
    doc, term, times = doc[order], term[order], times[order]
    first = np.flatnonzero(np.r_[True, term[1:] != term[:-1]]) if len(term) else np.zeros(0, np.int64)
    edges = np.r_[first, len(term)] if len(first) else np.zeros(1, np.int64)
    none = pa.nulls(len(first), pa.list_(pa.int64()))
    columns = [
        pa.array(np.full(len(first), number, np.int64)),
        pa.array(term[first]),
        _lists(doc, edges, pa.int32()),
        _lists(times, edges, pa.int64()),
        _lists(length[doc], edges, pa.int64()),
        none,
    ]
    for at in range(0, len(first), T.BATCH_ROWS):
        yield pa.RecordBatch.from_arrays([c.slice(at, T.BATCH_ROWS) for c in columns], schema=_RAW)
    own = [[number], [None], [[]], [[]], [length.tolist()], [ids]]
    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(own, _RAW.types)], schema=_RAW)


def posting_lists(docs: DataFrame, wanted: DataFrame, shard: int = SHARD) -> DataFrame:
    """(shard, term, docs, times, lengths, ids), stored: per shard and term the documents that have it, by number within
    the shard, how often, and how long they are. The row with a null term has the ids and lengths of the shard.

    Of documents without a term nothing is kept. `wanted` (one column) are the terms to keep, and a few others stay.
    """
    held = IdFilter(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, shards = TaskContext.get().partitionId(), 0
        parts: list[tuple] = []
        ids: list[int | None] = []
        lengths: list[np.ndarray] = []
        for batch in T.each(batches):
            for chunk in T.chunks(batch.column("text")):
                row, term, times, length = _counted(chunk)
                own = batch.column("doc_id").slice(chunk.first, chunk.rows)
                begin = 0
                while begin < chunk.rows:
                    # As many documents as the shard has room for, of those that have terms.
                    has = np.flatnonzero(length[begin:] > 0)[: shard - len(ids)] + begin
                    stop = int(has[-1]) + 1 if len(has) == shard - len(ids) else chunk.rows
                    number = np.full(chunk.rows, -1)
                    number[has] = len(ids) + np.arange(len(has))
                    keep = (row >= begin) & (row < stop)
                    keep[keep] = held.holds(term[keep])
                    parts.append((number[row[keep]].astype(np.int32), term[keep], times[keep]))
                    ids += own.take(pa.array(has)).to_pylist()
                    lengths.append(length[has])
                    begin = stop
                    if len(ids) == shard:
                        yield from _shard_rows((task << 32) + shards, parts, ids, lengths)
                        shards, parts, ids, lengths = shards + 1, [], [], []
        if ids:
            yield from _shard_rows((task << 32) + shards, parts, ids, lengths)

    schema = "shard long, term long, docs array<int>, times array<long>, lengths array<long>, ids array<long>"
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stored(read.mapInArrow(run, schema), "lists")


def corpus_size(lists: DataFrame) -> Corpus:
    sums = lists.where("term is null").select(
        F.sum(F.size("ids")), F.sum(F.expr("aggregate(lengths, 0L, (s, n) -> s + n)"))
    )
    return Corpus(*[int(x or 0) for x in sums.first()])


def by_impact(lists: DataFrame, corpus: Corpus) -> DataFrame:
    """(shard, term, docs, impacts, ids), stored: the lists with the highest impact first, then the lowest document.
    An impact is the score that a posting gives at a weight of 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("docs")
            doc, times = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in ("docs", "times"))
            # The row of a shard's ids has lengths too, but no postings.
            real = batch.column("term").is_valid().to_numpy(zero_copy_only=False)
            length = batch.filter(pa.array(real)).column("lengths").flatten().to_numpy()
            damping = 100 - 75 + 75 * length * corpus.documents // corpus.terms
            impact = 1_000_000_000 * times // (1000 * times + 8 * damping)
            many = at.value_lengths().to_numpy()
            edges = np.r_[0, np.cumsum(many)]
            order = np.lexsort((doc, -impact, np.repeat(np.arange(len(many)), many)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("shard"),
                    batch.column("term"),
                    _lists(doc[order].astype(np.int32), edges, pa.int32()),
                    _lists(impact[order], edges, pa.int64()),
                    batch.column("ids"),
                ],
                names=["shard", "term", "docs", "impacts", "ids"],
            )

    return stored(lists.mapInArrow(run, "shard long, term long, docs array<int>, impacts array<long>, ids array<long>"), "impacts")


def term_weights(asked: DataFrame, lists: DataFrame, corpus: Corpus) -> DataFrame:
    """(query, item_id, term, gain), stored: what a posting's impact is multiplied by. Terms that weigh nothing or
    that no document has are left out."""
    counts = lists.where("term is not null").groupBy("term").agg(F.sum(F.size("docs")).alias("df"))
    weight = F.floor(1000 * F.log((2.0 * corpus.documents + 2) / (2 * F.col("df") + 1)))
    gains = asked.join(stored(counts, "df"), "term").select("query", "item_id", "term", (F.col("times") * weight).alias("gain"))
    return stored(gains.where("gain > 0"), "gains")


class Posted(NamedTuple):
    """A query's posting list in a shard: documents and what each adds to a score, the most first."""

    docs: np.ndarray
    adds: np.ndarray


def resolved(lists: list[Posted], documents: int, least: int, best: int = BEST) -> tuple[np.ndarray, np.ndarray]:
    """Documents of a shard and their final scores: all that are among the `best` of the shard, ties included, and
    reach `least`; and maybe some others.

    The intervals are those of NRA: `lower` is what has been read, and `lower + open - known` the upper score, where
    `open` is the sum of the next unread impacts of all lists and `known` that of the lists the document was seen in.
    A step reads all lists down to half of what the next posting of any of them adds.
    """
    lower = np.zeros(documents, np.int64)
    seen = np.zeros((len(lists), documents), bool)
    depth = [0] * len(lists)
    let_in: np.ndarray | None = None
    while True:
        frontier = np.array([int(x.adds[d]) if d < len(x.adds) else 0 for x, d in zip(lists, depth)], np.int64)
        still = int(frontier.sum())
        floor = max(least, 1)
        if documents > best:
            floor = max(floor, int(np.partition(lower, documents - best)[documents - best]))
        if still < floor:
            # Nothing that was not seen can come in; of the rest, those that can still get there.
            upper = lower + still - frontier @ seen
            let_in = (upper >= floor) if let_in is None else let_in & (upper >= floor)
            if not ((frontier > 0) @ ~seen[:, let_in]).any():
                break
        down_to = int(frontier.max()) // 2
        for k, (docs, adds) in enumerate(lists):
            stop = len(adds) - int(np.searchsorted(adds[::-1], down_to, "left"))
            if stop <= depth[k]:
                continue
            at, more = docs[depth[k] : stop], adds[depth[k] : stop]
            depth[k] = stop
            if let_in is not None:
                own = let_in[at]
                at, more = at[own], more[own]
            lower[at] += more  # a document is once in a list
            seen[k, at] = True
    chosen = np.flatnonzero(let_in & (lower >= max(least, 1)))
    return chosen, lower[chosen]


class _Best:
    """The best documents of a query so far: (-score, null id, id, shard, number)."""

    def __init__(self, best: int):
        self.best = best
        self.found: list[tuple] = []

    @property
    def least(self) -> int:
        return -self.found[-1][0] if len(self.found) == self.best else 1

    def add(self, shard: int, ids: list[int | None], docs: np.ndarray, scores: np.ndarray) -> None:
        if len(docs) > self.best:  # equal scores stay together
            enough = np.partition(scores, len(scores) - self.best)[len(scores) - self.best]
            docs, scores = docs[scores >= enough], scores[scores >= enough]
        own = [(-int(s), ids[d] is None, ids[d] or 0, shard, int(d)) for d, s in zip(docs, scores)]
        self.found = sorted([*self.found, *own])[: self.best]


_FOUND = pa.schema([("query", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64()), ("shard", pa.int64()), ("number", pa.int64())])


def _searched(index: DataFrame, asked: pa.Table, best: int) -> DataFrame:
    """(query, doc_id, score, shard, number): the best of each task for the queries in `asked` (query, term, gain)."""
    asked = asked.sort_by([("query", "ascending"), ("term", "ascending")])
    query, term, gain = (asked[c].to_numpy() for c in ("query", "term", "gain"))
    shared = index.sparkSession.sparkContext.broadcast((query, term, gain))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query, term, gain = shared.value
        edges = np.flatnonzero(np.r_[True, query[1:] != query[:-1], True]) if len(query) else np.zeros(1, np.int64)
        leaders = [_Best(best) for _ in edges[1:]]
        lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        now, ids = None, []

        def done() -> None:
            for k, leader in enumerate(leaders):
                own = slice(edges[k], edges[k + 1])
                chosen = [(lists[t], g) for t, g in zip(term[own].tolist(), gain[own].tolist()) if t in lists]
                if sum(int(impacts[0]) * g for (_, impacts), g in chosen) < leader.least:
                    continue
                posted = [Posted(docs, impacts * g) for (docs, impacts), g in chosen]
                leader.add(now, ids, *resolved(posted, len(ids), leader.least, best))

        for batch in batches:
            shards, terms = batch.column("shard").to_pylist(), batch.column("term").to_pylist()
            docs, impacts = batch.column("docs"), batch.column("impacts")
            edge = docs.offsets.to_numpy()
            docs, impacts = docs.values.to_numpy(), impacts.values.to_numpy()
            for k, (shard, own) in enumerate(zip(shards, terms)):
                if shard != now:
                    if now is not None:
                        done()
                    now, ids, lists = shard, [], {}
                if own is None:
                    ids = batch.column("ids")[k].as_py()
                else:
                    # Copies: a batch does not outlive its turn.
                    lists[own] = docs[edge[k] : edge[k + 1]].copy(), impacts[edge[k] : edge[k + 1]].copy()
        if now is not None:
            done()
        rows = [
            (int(query[edges[k]]), None if null else i, -score, shard, number)
            for k, leader in enumerate(leaders)
            for score, null, i, shard, number in leader.found
        ]
        for at in range(0, len(rows), T.BATCH_ROWS):
            columns = zip(*rows[at : at + T.BATCH_ROWS])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _FOUND.types)], schema=_FOUND)

    dealt = index.repartition("shard").sortWithinPartitions("shard", "term")
    fields = "query long, doc_id long, score long, shard long, number long"
    return stored(dealt.mapInArrow(run, fields), "found")


def search(
    docs: DataFrame, queries: DataFrame, best: int = BEST, shard: int = SHARD, block_terms: int = BLOCK_TERMS
) -> DataFrame:
    """(item_id, rank, doc_id, score): the `best` documents of each query with a score above 0, the highest first, equal
    scores by doc_id, nulls last.

    `docs` has doc_id and text, `queries` item_id and text; other columns are ignored. A null text has no terms, and a
    query without a term that any document has gets no rows. Rows with equal or null ids are documents, and queries, of
    their own. Either table may be empty.
    """
    T.prepare(docs)
    ids = queries.select(F.col("item_id").cast("long").alias("item_id"), "text")
    asked = query_terms(ids)
    lists = posting_lists(docs, asked.select("term"), shard)
    corpus = corpus_size(lists)
    gains = term_weights(asked, lists, corpus)
    index = by_impact(lists.where(F.lit(corpus.terms > 0)), corpus)
    many = ranged(gains.groupBy("query").agg(F.count("*").alias("many")), ["query"], "queries")
    upto = running(many.withColumn("all", F.lit(0)), ["all"], ["query"], "many", "upto")
    block = F.floor((F.col("upto") - 1) / block_terms).cast("long").alias("block")
    blocks = stored(upto.select("query", block), "blocks")
    found = []
    for row in blocks.select("block").distinct().orderBy("block").collect():
        own = gains.join(blocks.where(F.col("block") == row.block), "query").select("query", "term", "gain")
        found.append(_searched(index, own.toArrow(), best))
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    together = found[0]
    for more in found[1:]:
        together = together.unionByName(more)
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last(), "shard", "number"]
    place = F.row_number().over(Window.partitionBy("query").orderBy(*order))
    ranks = together.withColumn("rank", place).where(F.col("rank") <= best)
    names = gains.select("query", "item_id").distinct()
    return ranks.join(names, "query").select("item_id", "rank", "doc_id", "score")


ORACLE = r"""
with asked as (
    select item_id, term, count(*) as times from (
        select item_id, unnest(regexp_extract_all(translate("text", 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark)
    group by item_id, term),
postings as (
    select doc_id, term, count(*) as tf from (
        select doc_id, unnest(regexp_extract_all(translate("text", 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from documents)
    group by doc_id, term),
lengths as (select doc_id, cast(sum(tf) as bigint) as n from postings group by doc_id),
corpus as (select count(*) as docs, cast(sum(n) as bigint) as terms from lengths),
weights as (select term, cast(floor(1000 * ln((2.0::double * any_value(c.docs) + 2) / (2 * count(*) + 1))) as bigint) as w
            from postings, corpus c group by term),
scores as (
    select a.item_id, p.doc_id,
           cast(sum(a.times * w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (100 - 75 + (75 * l.n * c.docs) // c.terms)))) as bigint) as score
    from asked a join postings p using (term) join weights w using (term) join lengths l using (doc_id), corpus c
    group by a.item_id, p.doc_id),
ranked as (select *, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as "rank" from scores where score > 0)
select item_id, "rank", doc_id, score from ranked where "rank" <= 10
"""
