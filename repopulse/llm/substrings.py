"""Substring dedup on runs of sentences.

A text is cut into sentences, and every run of `RUN` consecutive sentences is hashed. Runs are counted over
all documents; of equal runs the first, by doc_id and place, stays, and every sentence that another one
covers is removed, so a repeated passage goes from all documents but one, whatever stands around it. A run of
few words is left out or, with `extend`, goes on sentence by sentence until it has enough, forwards from its
first sentence and backwards from its last, so that passages of short sentences go whole, with both ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from repopulse.llm import textops as T
from repopulse.llm.store import IdFilter, stored

RUN = 3
#: Words that a run must have: shorter ones are equal by chance.
MIN_WORDS = 12
#: A sentence with more words is cut after words with a hash that is a multiple of CUT, so that texts
#: without full stops have sentences too, and the same ones wherever a passage stands.
LONG, CUT = 24, 8
#: The same where runs go on, with as many runs as passages with few stops need; what is still longer than the
#: first of these is cut after every so many words.
FINE_LONG, FINE_CUT = 16, 6
#: Base of the polynomial over word hashes, and its inverse modulo 2**64.
_BASE = 0xC2B2AE3D27D4EB4F
_INVERSE = pow(_BASE, -1, 1 << 64)

# Signs that end a sentence, and those that may follow them.
_STOP, _CLOSE = np.zeros(256, bool), np.zeros(256, bool)
_STOP[list(b".!?")] = True
_CLOSE[list(b"\"')]")] = True


class Sentences(T.NamedTuple):
    """Per sentence: its row, its bytes (up to its last word's end), words and hash."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    words: np.ndarray
    hash: np.ndarray


def _joined(hashes: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of the sequence hashes[begin:stop] for each of these bounds."""
    many = len(hashes)
    power, inverse = T._power(_BASE, many + 1), T._power(_INVERSE, many + 1)
    sums = np.zeros(many + 1, np.uint64)
    np.cumsum(hashes * power[:many], out=sums[1:])
    return T.mix((sums[stop] - sums[begin]) * inverse[begin] + (stop - begin).astype(np.uint64))


def sentences(chunk: T.Chunk, fine: bool = False) -> Sentences:
    """A sentence ends with a word that ends in a full stop or the like, or at the end of its line.

    Long ones are cut; `fine` cuts shorter ones too, and leaves none over `FINE_LONG` words.
    """
    length, every = (FINE_LONG, FINE_CUT) if fine else (LONG, CUT)
    found = T.words(chunk)
    many = len(found.start)
    if not many:
        none = np.zeros(0, np.int64)
        return Sentences(none, none, none, none, np.zeros(0, np.uint64))
    data = T.lower_ascii(chunk.data)
    last = found.end - 1
    closing = _CLOSE[data[last]] & (last > found.start)
    stops = _STOP[data[last - closing]]
    newlines = np.r_[0, np.cumsum(data == 10)]
    line = newlines[found.start]
    hashes = T.word_hashes(data, found)
    ends = np.ones(many, bool)
    ends[:-1] = stops[:-1] | (line[1:] != line[:-1]) | (found.row[1:] != found.row[:-1])

    def bounds(ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        stop = np.flatnonzero(ends) + 1
        return np.r_[0, stop[:-1]], stop

    begin, stop = bounds(ends)
    long = np.repeat(stop - begin > length, stop - begin)
    ends |= long & (hashes % np.uint64(every) == 0)
    begin, stop = bounds(ends)
    if fine:
        since = np.arange(many) - np.repeat(begin, stop - begin)
        begin, stop = bounds(ends | (since % length == length - 1))
    value = _joined(hashes, begin, stop)
    return Sentences(found.row[begin], found.start[begin], found.end[stop - 1], stop - begin, value)


def run_bounds(own: Sentences, size: int, min_words: int, extend: bool) -> tuple[np.ndarray, np.ndarray]:
    """First sentence of each run and the one after its last, within a row: `size` sentences with at least
    `min_words` words or, with `extend`, the fewest that are both, from each sentence on and up to each.

    Any passage that is as long as a run is then covered by the runs within it.
    """
    many = len(own.row)
    words = np.r_[0, np.cumsum(own.words)]
    enough = np.searchsorted(words, words[:-1] + min_words)
    begin = np.arange(many)
    stop = np.maximum(begin + size, enough)
    inside = np.flatnonzero((stop <= many) & (extend | (enough <= begin + size)))
    inside = inside[own.row[stop[inside] - 1] == own.row[inside]]
    if not extend:
        return inside, stop[inside]
    ends = np.arange(1, many + 1)
    back = np.minimum(ends - size, np.searchsorted(words, words[1:] - min_words, "right") - 1)
    # Most of these are runs from their first sentence as well.
    more = np.flatnonzero((back >= 0) & (stop[back] != ends))
    more = more[own.row[back[more]] == own.row[more]]
    return np.r_[inside, back[more]], np.r_[stop[inside], ends[more]]


def _runs(docs: DataFrame, size: int, min_words: int, extend: bool) -> DataFrame:
    """(run, doc_id, place, many): every run with enough words; `place` is its first sentence, `many` its number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.each(batches):
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for chunk in T.chunks(batch.column("text")):
                own = sentences(chunk, extend)
                at, stop = run_bounds(own, size, min_words, extend)
                value = _joined(own.hash, at, stop)
                place = at - np.searchsorted(own.row, own.row[at])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(T.signed(value)),
                        pa.array(ids[chunk.first + own.row[at]].astype(np.int64)),
                        pa.array(place.astype(np.int32)),
                        pa.array((stop - at).astype(np.int32)),
                    ],
                    names=["run", "doc_id", "place", "many"],
                )

    return docs.mapInArrow(run, "run long, doc_id long, place int, many int")


def repeated_runs(
    docs: DataFrame, size: int = RUN, min_words: int = MIN_WORDS, extend: bool = False
) -> DataFrame:
    """(doc_id, place, many) of all runs that an earlier one is equal to; `docs` has ids without nulls.

    Equal runs are one row per task in the count. What is counted is stored before it is joined, as
    adaptive execution splits a hot run in a join of two tables, but not in one with a count beside it.
    """
    runs = stored(_runs(docs, size, min_words, extend), "runs")
    first = runs.groupBy("run").agg(F.min(F.struct("doc_id", "place")).alias("first"), F.count("*").alias("times"))
    first = first.where("times > 1").select("run", F.col("first.doc_id").alias("id"), F.col("first.place").alias("at"))
    first = stored(first, "first")
    return runs.join(first, "run").where("doc_id <> id or place <> at").select("doc_id", "place", "many")


def _cut(text: str | None, places: list[dict[str, int]], fine: bool) -> tuple[str | None, int, int]:
    """The text without the sentences that these runs cover, and how many there are and go."""
    chunk = next(T.chunks(pa.array([text], pa.string())))
    own = sentences(chunk, fine)
    gone = np.zeros(len(own.row), bool)
    for run in places:
        gone[run["place"] : run["place"] + run["many"]] = True
    if not gone.any():
        return text, len(gone), 0
    data = chunk.data.tobytes()
    # What stands between sentences goes with the one before it.
    edges = [0, *own.start[1:].tolist(), len(data)]
    kept = b"".join(data[edges[k] : edges[k + 1]] for k in np.flatnonzero(~gone))
    return kept.decode(), len(gone), int(gone.sum())


def without_repeats(
    docs: DataFrame, size: int = RUN, min_words: int = MIN_WORDS, extend: bool = False
) -> DataFrame:
    """All rows and columns of `docs`, with `text` cut, and n_sentences and n_removed (long).

    Rows that share an id are one document given more than once: they are all cut alike, and none for
    the other's sake. A row with a null id is left as it is and not counted with the others; a null
    or empty text stays. A text all of which is repeated becomes empty. Where `docs` has columns of
    the two added names, these are replaced.
    """
    T.prepare(docs)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    found = stored(repeated_runs(texts, size, min_words, extend), "repeated")
    # The runs of one document, so of bounded number.
    per_doc = found.groupBy(F.col("doc_id").alias("_doc")).agg(F.collect_set(F.struct("place", "many")).alias("_places"))
    rows = docs.select(
        F.struct("*").alias("_row"), F.col("doc_id").cast("long").alias("_id"), F.col("text").alias("_text")
    ).withColumn("_held", IdFilter(found.select("doc_id")).column(F.col("_id")))
    none = F.lit(None).cast("array<struct<place:int,many:int>>").alias("_places")
    clean = rows.where("not _held or _held is null").select("_row", "_text", none)
    held = rows.where("_held").join(per_doc, F.col("_id") == F.col("_doc"), "left").select("_row", "_text", "_places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.each(batches):
            texts, many, gone = batch.column("_text").to_pylist(), [], []
            counts = [T.per_row(sentences(c, extend).row, c.rows) for c in T.chunks(batch.column("_text"))]
            counts = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            for k, places in enumerate(batch.column("_places").to_pylist()):
                if places:
                    texts[k], _, n = _cut(texts[k], places, extend)
                else:
                    n = 0
                gone.append(n)
            many = counts.astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), pa.array(texts, pa.string()), pa.array(many), pa.array(gone, pa.int64())],
                names=["_row", "_text", "_many", "_gone"],
            )

    fields = [
        rows.schema["_row"],
        StructField("_text", StringType()),
        StructField("_many", LongType()),
        StructField("_gone", LongType()),
    ]
    done = clean.unionByName(held).mapInArrow(run, StructType(fields))
    added = {"text": "_text", "n_sentences": "_many", "n_removed": "_gone"}
    columns = [c for c in docs.columns if c not in ("n_sentences", "n_removed")]
    return done.select(
        *[(F.col(added[c]) if c == "text" else F.col("_row").getField(c)).alias(c) for c in columns],
        F.col("_many").alias("n_sentences"),
        F.col("_gone").alias("n_removed"),
    )
