"""Stupid-backoff scores of all documents, as joins on n-gram hashes.

Documents are dealt into chunks, and a chunk's n-grams into buckets by the leading bits of their hash. A
bucket is one part of the count tables: it adds up what the chunks have and gives each chunk the totals of
its own n-grams, which is the join of counts with exploded n-grams. The rows of these tables are packed:
one holds all n-grams that a chunk has in a bucket. Then every word of a document is scored from the
totals, and words are summed per document.

Counts leave out the document itself, since otherwise each of its n-grams would be known from it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repopulse.llm import textops as T

ORDER = 2
BACKOFF = 0.4
#: Bytes of text in a chunk, and those whose n-grams make a bucket, about.
CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 8 << 20


def _size(docs: DataFrame) -> tuple[int, int]:
    """Bytes and words of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = words = 0
        for batch in T.each(batches):
            for chunk in T.chunks(batch.column("text")):
                size += len(chunk.data)
                words += len(T.words(chunk).start)
        yield pa.RecordBatch.from_arrays([pa.array([size]), pa.array([words])], names=["size", "words"])

    row = docs.select("text").mapInArrow(run, "size long, words long").agg(F.sum("size"), F.sum("words")).first()
    return row[0] or 0, row[1] or 0


def _grams(texts: pa.ChunkedArray, order: int) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """For each order the hash of the n-gram that ends at each word, and whether there is one; and the
    row of each word. All n-grams lie within a row."""
    parts, rows = [], []
    for chunk in T.chunks(texts):
        data = T.lower_ascii(chunk.data)
        found = T.words(chunk)
        parts.append(T.word_hashes(data, found))
        rows.append(found.row + chunk.first)
    hashes = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    row = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    values, there = [], []
    for n in range(1, order + 1):
        value, known = np.zeros(len(hashes), np.uint64), np.zeros(len(hashes), bool)
        gram, at = T.ngrams(hashes, row, n)
        value[at + n - 1], known[at + n - 1] = gram, True
        values.append(value)
        there.append(known)
    return values, there, row


def _every(values: list[np.ndarray], there: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([v[t] for v, t in zip(values, there)])


def _packed(values: np.ndarray) -> bytes:
    """Numbers byte by byte: all lowest bytes, then all next ones. Small numbers leave long runs of zeros
    at the end, which Spark's compression takes away."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _unpacked(data: pa.Buffer | bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _steps(grams: np.ndarray) -> np.ndarray:
    """Sorted numbers as the first and the steps between them, which are smaller."""
    return np.diff(grams, prepend=np.uint64(0))


_PACKED = "chunk long, bucket long, grams binary, counts binary"


def _explode(order: int, bits: int):
    def run(table: pa.Table) -> pa.Table:
        T.give_back()
        values, there, _ = _grams(table["text"], order)
        gram, count = np.unique(_every(values, there), return_counts=True)
        bucket = (gram >> np.uint64(64 - bits)).astype(np.int64)
        edges = np.searchsorted(bucket, np.arange((1 << bits) + 1))
        used = np.flatnonzero(np.diff(edges))
        many = count.astype(np.uint32)
        return pa.table(
            {
                "chunk": pa.array(np.full(len(used), table["chunk"][0].as_py(), np.int64)),
                "bucket": pa.array(used),
                "grams": pa.array([_packed(_steps(gram[edges[b] : edges[b + 1]])) for b in used], pa.binary()),
                "counts": pa.array([_packed(many[edges[b] : edges[b + 1]]) for b in used], pa.binary()),
            }
        )

    return run


def _totals(table: pa.Table) -> pa.Table:
    """For each chunk's n-grams of the bucket, in their order, how often all chunks have them."""
    T.give_back()
    grams = [np.cumsum(_unpacked(g.as_buffer(), np.uint64)) for c in table["grams"].chunks for g in c]
    counts = [_unpacked(g.as_buffer(), np.uint32) for c in table["counts"].chunks for g in c]
    _, _, which = T.distinct(np.concatenate(grams))
    sums = np.bincount(which, np.concatenate(counts)).astype(np.uint64)  # whole numbers are exact up to 2**53
    parts = np.split(sums[which], np.cumsum([len(g) for g in grams])[:-1])
    return pa.table({"chunk": table["chunk"], "bucket": table["bucket"], "totals": pa.array([_packed(p) for p in parts], pa.binary())})


def _score(order: int, backoff: float, words: int):
    def run(texts: pa.Table, totals: pa.Table) -> pa.Table:
        T.give_back()
        values, there, row = _grams(texts["text"], order)
        _, _, which = T.distinct(_every(values, there))
        by_bucket = np.argsort(totals["bucket"].to_numpy(), kind="stable")
        packed = totals["totals"].to_pylist()
        total = np.concatenate([_unpacked(packed[k], np.uint64) for k in by_bucket] or [np.zeros(0, np.uint64)])
        owner = np.concatenate([row[t] for t in there]).astype(np.int64)
        # What the word's own document has of each n-gram.
        pair = which.astype(np.int64) * max(1, texts.num_rows) + owner
        _, _, own_of = T.distinct(pair)
        own = np.bincount(own_of)
        others = (total[which].astype(np.int64) - own[own_of]).astype(np.float64)
        counts, at = [], 0
        for t in there:
            full = np.zeros(len(row))
            full[t] = others[at : at + t.sum()]
            at += int(t.sum())
            counts.append(full)
        n = T.per_row(row, texts.num_rows)
        # From the longest n-gram that is known elsewhere, each step down costs a factor.
        value = np.full(len(row), backoff**order / (words + 1))
        known = np.zeros(len(row), bool)
        for k in range(order, 0, -1):
            if k > 1:
                context = np.r_[0.0, counts[k - 2][:-1]]
            else:
                context = np.maximum(words - n[row], 1).astype(np.float64)
            hit = ~known & (counts[k - 1] > 0) & (context > 0)
            value[hit] = backoff ** (order - k) * counts[k - 1][hit] / context[hit]
            known |= hit
        score = T.per_row(row, texts.num_rows, np.log(value))
        return pa.table(
            {
                "doc_id": texts["doc_id"],
                "n_words": pa.array(n.astype(np.int64)),
                "score": pa.array(score),
                "mean_score": pa.array(score / np.maximum(n, 1)),
            }
        )

    return run


def stupid_backoff(docs: DataFrame, order: int = ORDER, backoff: float = BACKOFF) -> DataFrame:
    """(doc_id, n_words, score, mean_score), a row per row of `docs`: the sum and the mean of the
    logarithms of its words' scores, by the counts of all other rows.

    Words are parts between ASCII white space, A-Z in lower case. A word that no other document has
    gets the full backoff over the number of all words. A null or empty text has no words and the
    score 0. Repeated rows and rows without an id are documents like others; other columns are ignored.
    """
    if order < 1:
        raise ValueError("order must be at least 1")
    T.prepare(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    size, words = _size(rows)
    chunks = max(1, -(-size // CHUNK_BYTES))
    bits = max(1, int(np.ceil(np.log2(max(1, size) / BUCKET_BYTES + 1))))
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)))
    packed = dealt.groupBy("chunk").applyInArrow(_explode(order, bits), _PACKED)
    totals = packed.groupBy("bucket").applyInArrow(_totals, "chunk long, bucket long, totals binary")
    schema = "doc_id long, n_words long, score double, mean_score double"
    return dealt.groupBy("chunk").cogroup(totals.groupBy("chunk")).applyInArrow(_score(order, backoff, words), schema)
