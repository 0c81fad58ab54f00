"""Decontamination: rare n-gram seeds, then Smith-Waterman alignment.

N-grams of the test items are looked up in every document. Runs of found n-grams are kept with the
words around them; the rarest n-grams of each stretch of an item are its seeds, and a run with seeds of
an item is aligned with the whole item, so that copies with edits, gaps and replaced words are found.
A copy is a part of the item that reaches a share of its own score, or as much as 50 words in a row give.
An item with fewer words than a seed is one n-gram of its own length, and is held where it stands whole.

Documents are read once. What leaves that read are the runs, not the documents: n-grams of the items
are known there as a bitmap of fixed size, and exact joins follow.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repopulse.llm import textops as T
from repopulse.llm.store import IdFilter, stored, without

#: Words of a seed, and the part of the n-grams of each stretch, from the rarest, that are seeds. As many
#: come from every stretch, an unbroken part of an item has seeds even if many documents hold that part.
SEED = 4
RARE = 0.75
STRETCH = 16
#: Items with fewer words than this are not looked for: a single word is no passage.
LEAST_WORDS = 2
#: Different seeds of an item that a run must have to be aligned with it.
LEAST_SEEDS = 2
MATCH, MISMATCH, GAP = 2, -1, -1
#: A document holds an item if the best alignment reaches this part of the item's own score, or this score.
LEAST_SCORE = 0.4
LEAST_ALIGNED = 50 * MATCH
#: Items are parted by length, from one bound to this many times it, for each to have words around its
#: n-grams in documents as its own length asks for.
_FIRST_BOUND, _WIDER = 64, 4
_CELLS = 1 << 19

#: ASCII signs other than letters and digits part words, as white space does.
_SEPARATORS = T.SPACE.copy()
_SEPARATORS[[b for b in range(33, 127) if not chr(b).isalnum()]] = 1


def _words(chunk: T.Chunk) -> tuple[np.ndarray, np.ndarray]:
    data = T.lower_ascii(chunk.data)
    found = T.spans(_SEPARATORS[data], chunk)
    return T.word_hashes(data, found), found.row


def _items(benchmark: DataFrame) -> DataFrame:
    """(key, item_id, words, n): a row per item, its words as 64-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.each(batches):
            for chunk in T.chunks(batch.column("text")):
                hashes, row = _words(chunk)
                parts = np.split(hashes, np.searchsorted(row, np.arange(1, chunk.rows)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("item_id").slice(chunk.first, chunk.rows),
                        pa.array([part.tobytes() for part in parts], pa.binary()),
                        pa.array([len(part) for part in parts], pa.int64()),
                    ],
                    names=["item_id", "words", "n"],
                )

    rows = benchmark.select("item_id", "text").mapInArrow(run, "item_id long, words binary, n long")
    return rows.select(F.monotonically_increasing_id().alias("key"), "*")


def _grams(items: DataFrame, size: int) -> DataFrame:
    """(key, gram, pos): every n-gram of every item; an item with fewer words is one n-gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.each(batches):
            for key, words in zip(batch.column("key").to_pylist(), batch.column("words").to_pylist()):
                hashes = np.frombuffer(words, np.uint64)
                gram, pos = T.ngrams(hashes, np.zeros(len(hashes), np.int64), max(1, min(size, len(hashes))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(gram), key)), pa.array(T.signed(gram)), pa.array(pos.astype(np.int64))],
                    names=["key", "gram", "pos"],
                )

    return items.select("key", "words").mapInArrow(run, "key long, gram long, pos long")


class _Known:
    """The n-grams of items of like length: their size, the longest item's words, and a bitmap."""

    def __init__(self, size: int, reach: int, grams: DataFrame):
        self.size, self.reach, self.ids = size, reach, IdFilter(grams.select("gram"))


def _known(items: DataFrame, grams: DataFrame, size: int) -> list[_Known]:
    """One entry for each size under `size` that items have, and for each range of lengths from there on."""
    longest = items.agg(F.max("n")).first()[0] or 0
    bounds = [*range(size), max(size, _FIRST_BOUND)]
    while bounds[-1] < longest:
        bounds.append(bounds[-1] * _WIDER)
    number = sum(((F.col("n") > bound).cast("int") for bound in bounds), F.lit(0))
    parts = items.groupBy(number.alias("part")).agg(F.max("n").alias("n")).orderBy("part").collect()
    parted = grams.join(items.select("key", number.alias("part")), "key")
    return [_Known(min(size, p.n), p.n, parted.where(F.col("part") == p.part)) for p in parts]


def run_edges(at: np.ndarray, reach: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Where runs start among found places in ascending order: at a place that neither reaches one
    before it, nor one after it reaches back past it. `low` and `high` bound each place's document."""
    ahead = np.maximum.accumulate(np.minimum(at + reach, high - 1))
    back = np.minimum.accumulate(np.maximum(at - reach, low)[::-1])[::-1]
    return np.flatnonzero(np.r_[True, (at[1:] > ahead[:-1]) & (back[1:] > at[:-1])])


def _runs(docs: DataFrame, known: list[_Known]) -> DataFrame:
    """(doc_id, first, words, grams, at): runs of found n-grams that reach each other, with as many
    words on either side as the longest item of like length has; `first` is the run's first word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.each(batches):
            ids = batch.column("doc_id")
            for chunk in T.chunks(batch.column("text")):
                hashes, row = _words(chunk)
                found = []
                for size in {k.size for k in known}:
                    gram, at = T.ngrams(hashes, row, size)
                    reach = np.zeros(len(gram), np.int64)
                    for k in known:
                        if k.size == size:
                            reach[k.ids.holds(T.signed(gram))] = k.reach
                    hit = np.flatnonzero(reach)
                    found.append((gram[hit], at[hit], reach[hit], np.full(len(hit), size)))
                if not sum(len(part[0]) for part in found):
                    continue
                gram, at, reach, size = (np.concatenate(column) for column in zip(*found))
                order = np.lexsort((size, at))
                gram, at, reach, size = gram[order], at[order], reach[order], size[order]
                begin = np.searchsorted(row, np.arange(chunk.rows + 1))
                low, high = begin[row[at]], begin[row[at] + 1]
                start = run_edges(at, reach, low, high)
                lo = np.minimum.reduceat(np.maximum(at - reach, low), start)
                hi = np.maximum.reduceat(np.minimum(at + size + reach, high), start)
                owner = row[at[start]]
                offsets = np.r_[start, len(at)].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(owner + chunk.first)),
                        pa.array((lo - begin[owner]).astype(np.int64)),
                        pa.array([hashes[a:b].tobytes() for a, b in zip(lo, hi)], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(T.signed(gram))),
                        pa.ListArray.from_arrays(
                            pa.array(offsets), pa.array((at - np.repeat(lo, np.diff(offsets))).astype(np.int64))
                        ),
                    ],
                    names=["doc_id", "first", "words", "grams", "at"],
                )

    schema = "doc_id long, first long, words binary, grams array<long>, at array<long>"
    return docs.mapInArrow(run, schema)


def align(items: list[np.ndarray], windows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Smith-Waterman score of each item within its window, and the end of the best alignment.

    Pairs are aligned side by side: one step of the loop fills a row of every matrix, and the running
    maximum along the row stands for its gaps.
    """
    scores, ends = np.zeros(len(items), np.int64), np.zeros(len(items), np.int64)
    order = np.argsort([len(w) for w in windows], kind="stable")
    first = 0
    while first < len(order):
        last = first + 1
        while last < len(order) and (last - first + 1) * (len(windows[order[last]]) + 1) <= _CELLS:
            last += 1
        chosen = order[first:last]
        first = last
        width = max(len(windows[i]) for i in chosen)
        height = max(len(items[i]) for i in chosen)
        item = np.zeros((len(chosen), height), np.uint64)
        window = np.zeros((len(chosen), width), np.uint64)
        outside = np.ones((len(chosen), width), bool)
        for k, i in enumerate(chosen):
            item[k, : len(items[i])] = items[i]
            window[k, : len(windows[i])] = windows[i]
            outside[k, : len(windows[i])] = False
        length = np.array([len(items[i]) for i in chosen])
        slope = -GAP * np.arange(width, dtype=np.int32)
        above = np.zeros((len(chosen), width + 1), np.int32)
        best, end = np.zeros(len(chosen), np.int32), np.zeros(len(chosen), np.int64)
        for r in range(height):
            same = (window == item[:, r : r + 1]) & ~outside
            cell = np.maximum(above[:, :-1] + np.where(same, MATCH, MISMATCH), above[:, 1:] + GAP)
            cell = np.maximum(cell, 0)
            cell = np.maximum.accumulate(cell + slope, axis=1) - slope
            cell[r >= length] = 0
            above[:, 1:] = cell
            place = cell.argmax(axis=1)
            top = cell[np.arange(len(chosen)), place]
            better = top > best
            best[better], end[better] = top[better], place[better] + 1
        scores[chosen], ends[chosen] = best, end
    return scores, ends


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = SEED,
    rare: float = RARE,
    least_seeds: int = LEAST_SEEDS,
    least_score: float = LEAST_SCORE,
    least_aligned: int = LEAST_ALIGNED,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """(doc_id, item_id, score, end_word): each document and each test item of which it holds a copy,
    whole or edited. `score` is the best alignment as part of the item's own score, and `end_word`
    the number of the document's words up to its end.

    Null and empty texts hold nothing; items with fewer words than `least_words` are held by nothing, and
    those with fewer than a seed are held only where they stand whole; rows without an id are not judged. Rows that share an id are rows of one document or item: the best
    alignment counts, and ties go to the first end. Empty tables give no rows, and other columns are ignored.
    """
    T.prepare(docs)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    bench = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null")
    items = stored(_items(bench).where(F.col("n") >= max(1, least_words)), "items")
    grams = stored(_grams(items, size), "grams")
    runs = _runs(docs, _known(items, grams, size))
    runs = stored(runs.select(F.monotonically_increasing_id().alias("run"), "*"), "runs")
    found = runs.select("run", F.explode(F.arrays_zip("grams", "at")).alias("hit")).select(
        "run", F.col("hit.grams").alias("gram"), F.col("hit.at").alias("at")
    )
    in_corpus = found.join(grams.select("gram").distinct(), "gram").groupBy("gram").agg(F.count("*").alias("many"))
    stretch = Window.partitionBy("key", F.expr(f"pos div {STRETCH}"))
    by_rarity = stretch.orderBy(F.coalesce("many", F.lit(0)), "pos")
    seeds = (
        grams.join(in_corpus, "gram", "left")
        .withColumn("rank", F.row_number().over(by_rarity))
        .withColumn("all", F.count("*").over(stretch))
        .where(f"rank <= ceil({rare} * all)")
        .join(items.select("key", F.expr(f"greatest(1, n - {size - 1})").alias("own")), "key")
        .select("key", "gram", "pos", F.least("own", F.lit(least_seeds)).alias("least"))
    )
    met = (
        found.join(seeds, "gram")
        .groupBy("run", "key")
        .agg(
            F.countDistinct("pos").alias("seeds"),
            F.min("least").alias("least"),
            F.min(F.col("at") - F.col("pos")).alias("lo"),
            F.max(F.col("at") - F.col("pos")).alias("hi"),
        )
        .where("seeds >= least")
        .select("run", "key", "lo", "hi")
    )
    pairs = met.join(items.withColumnRenamed("words", "item"), "key").join(runs.drop("grams", "at"), "run")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.each(batches):
            rows = batch.select(["item", "words", "lo", "hi"]).to_pylist()
            lists, windows, skipped = [], [], []
            for row in rows:
                item, words = np.frombuffer(row["item"], np.uint64), np.frombuffer(row["words"], np.uint64)
                slack = len(item) // 2 + 1
                lo = max(0, row["lo"] - slack)
                lists.append(item)
                windows.append(words[lo : row["hi"] + len(item) + slack])
                skipped.append(lo)
            best, end = align(lists, windows)
            own = MATCH * np.array([len(x) for x in lists])
            part = best / own
            # A short item has no parts: of two words, one is under half of it, but not under the least share.
            short = own < MATCH * size
            holds = np.where(short, best == own, (part >= least_score) | (best >= least_aligned))
            end = end + np.array(skipped) + batch.column("first").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("item_id"), pa.array(part), pa.array(end)],
                names=["doc_id", "item_id", "score", "end_word"],
            ).filter(pa.array(holds))

    scored = pairs.select("doc_id", "item_id", "item", "words", "lo", "hi", "first").mapInArrow(
        score, "doc_id long, item_id long, score double, end_word long"
    )
    best = F.max(F.struct("score", (-F.col("end_word")).alias("end_word"))).alias("best")
    return (
        scored.groupBy("doc_id", "item_id")
        .agg(best)
        .selectExpr("doc_id", "item_id", "best.score", "-best.end_word as end_word")
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **settings: float) -> DataFrame:
    """`docs` without the documents that hold a test item; all columns stay, and rows without an id."""
    return without(docs, stored(contaminated(docs, benchmark, **settings).select("doc_id").distinct(), "leaks"))
