"""Quality rules: counts of each text, and a log-likelihood ratio of hashed n-grams.

Words and pairs of words are counted in hashed buckets, over all documents and over all that labels
call good. A document's score is the mean of log(share in good text / share in all text) over its
n-grams; whether it is kept follows from one threshold, the same for every document. The threshold
comes from every labelled document; a good one's own n-grams are left out of the good text then.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repopulse.llm import textops as T
from repopulse.llm.order import ranged, running
from repopulse.llm.store import IdFilter, stored

#: Buckets of n-grams: their counts are the whole model.
BUCKETS = 1 << 16
#: Of the labelled good documents, scored without their own n-grams, this share at least is kept.
KEEP_GOOD = 0.99
#: Bits of the bitmaps of ids, 4 MB each.
GOOD_BITS = 25
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

# Signs that count as symbols.
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True

#: Kinds of bytes in the model's tokens: white space parts them, and so do signs and letters.
_KINDS = T.SPACE.copy()
_KINDS[[b for b in range(33, 127) if not chr(b).isalnum()]] = 2


def _buckets(chunk: T.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of every token and every pair of tokens."""
    found = T.spans(_KINDS[chunk.data], chunk)
    hashes = T.word_hashes(chunk.data, found)
    pairs, at = T.ngrams(hashes, found.row, 2)
    bucket = (np.concatenate([hashes, pairs]) >> np.uint64(48)).astype(np.int64)
    return bucket, np.concatenate([found.row, found.row[at]])


assert BUCKETS == 1 << 16


def counts(texts: pa.Array) -> np.ndarray:
    """Per text, a row of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    out = np.zeros((len(texts), 5), np.int64)
    for chunk in T.chunks(texts):
        n, data = chunk.rows, chunk.data
        own = out[chunk.first : chunk.first + n]
        found = T.words(chunk)
        own[:, 0] = T.per_row(found.row, n)
        # Bytes that begin a code point.
        begins = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
        own[:, 1] = T.per_row(found.row, n, begins[found.end] - begins[found.start])
        symbols = np.r_[0, np.cumsum(_SYMBOLS[data])]
        own[:, 2] = symbols[chunk.offsets[1:]] - symbols[chunk.offsets[:-1]]
        own[:, 3] = _repeated_lines(chunk, found)
        own[:, 4] = _repeated_words(chunk, found)
    return out


def _repeated_lines(chunk: T.Chunk, found: T.Words) -> np.ndarray:
    lines = T.spans((chunk.data == 10).astype(np.uint8), chunk)
    # A line has a word if one starts in it.
    worded = np.searchsorted(found.start, lines.end) > np.searchsorted(found.start, lines.start)
    start, end, row = lines.start[worded], lines.end[worded], lines.row[worded]
    hashes = T.span_hashes(chunk.data, start, end)
    order = np.lexsort((hashes, row))
    same = (hashes[order][1:] == hashes[order][:-1]) & (row[order][1:] == row[order][:-1])
    return T.per_row(row[order][1:][same], chunk.rows)


def _repeated_words(chunk: T.Chunk, found: T.Words) -> np.ndarray:
    hashes = T.word_hashes(chunk.data, found)
    window, at = T.ngrams(hashes, found.row, 3)
    row = found.row[at]
    order = np.lexsort((window, row))
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = (window[order][1:] == window[order][:-1]) & (row[order][1:] == row[order][:-1])
    twice = at[order[same[1:] | same[:-1]]]
    covered = np.zeros(len(hashes) + 2, bool)
    for k in range(3):
        covered[twice + k] = True
    return T.per_row(found.row[covered[: len(hashes)]], chunk.rows)


def labelled_rows(labels: DataFrame) -> DataFrame:
    """(id, good) of every labelled document. Ids with contradicting labels, or none, do not count."""
    return (
        labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("int").alias("_good"))
        .where("_id is not null and _good in (0, 1)")
        .groupBy("_id")
        .agg(F.min("_good").alias("_good"), F.max("_good").alias("_most"))
        .where("_good = _most")
        .select("_id", "_good")
    )


def with_target(texts: DataFrame, known: DataFrame, bits: int = GOOD_BITS) -> DataFrame:
    """(text, target) of all rows: whether their id is labelled good.

    A bitmap of the good ids holds a few others, which an exact join of the ids alone finds; of the texts,
    only those that a second bitmap, of these others, holds as well are shuffled to be told apart.
    """
    good = known.where("_good = 1").select("_id")
    held = IdFilter(good, bits).column(F.col("_id"))
    others = texts.select("_id").where(held).join(good, "_id", "left_anti").distinct()
    mixed = IdFilter(stored(others, "held-others"), bits).column(F.col("_id"))
    rows = texts.withColumn("_held", F.coalesce(held, F.lit(False))).withColumn("_mixed", F.coalesce(mixed, F.lit(False)))
    sure = rows.where("not (_held and _mixed)").select("_text", F.col("_held").alias("_target"))
    target = F.coalesce("_true", F.lit(False)).alias("_target")
    told = rows.where("_held and _mixed").join(good.withColumn("_true", F.lit(True)), "_id", "left")
    return sure.unionByName(told.select("_text", target))


def bucket_counts(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """N-grams per bucket in all rows and in those with `_good`. A task sends a row per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every, good = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in T.each(batches):
            trusted = batch.column("_target").to_numpy(zero_copy_only=False).astype(bool)
            for chunk in T.chunks(batch.column("_text")):
                bucket, row = _buckets(chunk)
                every += np.bincount(bucket, minlength=BUCKETS)
                good += np.bincount(bucket[trusted[chunk.first + row]], minlength=BUCKETS)
        used = np.flatnonzero(every)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(every[used]), pa.array(good[used])], names=["bucket", "n", "good"]
        )

    found = (
        docs.mapInArrow(run, "bucket int, n long, good long")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
        .toArrow()
    )
    out = np.zeros((2, BUCKETS), np.int64)
    for k, name in enumerate(("n", "good")):
        out[k, found["bucket"].to_numpy()] = found[name].to_numpy()
    return out[0], out[1]


def ratios(every: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Per bucket log(share in the target / share in the corpus). Without a target: 0."""
    if not good.sum():
        return np.zeros(BUCKETS, np.float32)
    # The corpus smooths the target: a bucket unseen there has a small part of its share in all text.
    target = (good + every / max(1, every.sum()) * BUCKETS * 0.1) / (good.sum() + BUCKETS * 0.1)
    share = np.maximum(every, 1) / max(1, every.sum())
    target = np.where(every > 0, target, share)
    return np.log(target / share).astype(np.float32)


def mean_ratios(ratio: np.ndarray, texts: pa.Array) -> np.ndarray:
    """Per text, the mean over its n-grams; 0 for a text without any."""
    out = np.zeros(len(texts))
    for chunk in T.chunks(texts):
        bucket, row = _buckets(chunk)
        n = T.per_row(row, chunk.rows)
        out[chunk.first : chunk.first + chunk.rows] = T.per_row(row, chunk.rows, ratio[bucket]) / np.maximum(n, 1)
    return out


def mean_ratios_apart(every: np.ndarray, good: np.ndarray, texts: pa.Array) -> np.ndarray:
    """Per text, the mean that it would have if its own n-grams were not among the good ones."""
    out = np.zeros(len(texts))
    smooth = BUCKETS * 0.1
    share = np.maximum(every, 1) / max(1, every.sum())
    for chunk in T.chunks(texts):
        bucket, row = _buckets(chunk)
        own, times = np.unique(row * BUCKETS + bucket, return_counts=True)
        bucket, row = own % BUCKETS, own // BUCKETS
        n = T.per_row(row, chunk.rows, times)
        left = np.maximum(good[bucket] - times, 0) + share[bucket] * smooth
        total = np.maximum(good.sum() - n, 0) + smooth
        means = T.per_row(row, chunk.rows, times * np.log(left / total[row] / share[bucket])) / np.maximum(n, 1)
        out[chunk.first : chunk.first + chunk.rows] = means
    return out


def threshold(scores: np.ndarray, good: np.ndarray, keep_good: float = KEEP_GOOD) -> float:
    """The score that parts good from bad best, in the balanced share of right verdicts, among those
    that keep enough of the good ones; of equally good scores the lowest. Without both: minus infinity.
    This one is for arrays; `threshold_of` finds the same in a table."""
    if not good.any() or good.all():
        return -np.inf
    order = np.argsort(scores, kind="stable")
    scores, good = scores[order], good[order]
    lost_good = np.r_[0, np.cumsum(good)] / good.sum()
    found_bad = np.r_[0, np.cumsum(~good)] / (~good).sum()
    cut = np.flatnonzero(np.r_[True, scores[1:] > scores[:-1], False])
    cut = cut[lost_good[cut] <= 1 - keep_good]
    best = cut[np.argmax(found_bad[cut] - lost_good[cut])]
    return -np.inf if best == 0 else float((scores[best - 1] + scores[best]) / 2)


def threshold_of(rows: DataFrame, keep_good: float = KEEP_GOOD) -> float:
    """`threshold` of a table (_score, _good) of any size: running sums over ranges of the scores."""
    per_score = rows.groupBy("_score").agg(F.sum("_good").alias("_n_good"), F.sum(1 - F.col("_good")).alias("_n_bad"))
    scores = ranged(per_score, ["_score"], "scores")
    good, bad = scores.agg(F.sum("_n_good"), F.sum("_n_bad")).first()
    if not good or not bad:
        return -np.inf
    summed = running(scores, [], ["_score"], "_n_good", "_upto_good")
    summed = stored(running(summed, [], ["_score"], "_n_bad", "_upto_bad"), "sums")
    # Shares below each score, as the cut before it would lose and find them.
    lost, found = (F.col("_upto_good") - F.col("_n_good")) / F.lit(good), (F.col("_upto_bad") - F.col("_n_bad")) / F.lit(bad)
    best = summed.where(lost <= 1 - keep_good).orderBy((found - lost).desc(), "_score").select("_score").first()[0]
    before = scores.where(F.col("_score") < best).agg(F.max("_score")).first()[0]
    return -np.inf if before is None else (before + best) / 2


def quality(docs: DataFrame, labels: DataFrame, keep_good: float = KEEP_GOOD) -> DataFrame:
    """Per row of `docs`: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, score.

    A null or empty text has no words, fails the base rules and has the score 0. Repeated rows and
    null ids are rows like others; a document counts once per row in the corpus. Other columns of
    `docs` and `labels` are ignored. Without labels of both classes the base rules decide alone.
    """
    T.prepare(docs)
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").alias("_text"))
    known = stored(labelled_rows(labels), "labelled")
    every, good = bucket_counts(with_target(texts, known))
    shared = docs.sparkSession.sparkContext.broadcast((ratios(every, good), every, good))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.each(batches):
            found = counts(batch.column("_text"))
            ratio, every, good = shared.value
            score = mean_ratios(ratio, batch.column("_text"))
            apart = mean_ratios_apart(every, good, batch.column("_text"))
            words, repeated = found[:, 0], found[:, 4]
            failed = (words < MIN_WORDS) | (100 * repeated > MAX_REPEATED_PERCENT * words)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), *[pa.array(x) for x in (*found.T, failed, score, apart)]],
                names=["doc_id", *_COUNTS, "base_failed", "score", "_apart"],
            )

    numbers = "".join(f"{name} long, " for name in _COUNTS)
    judged = texts.mapInArrow(judge, f"doc_id long, {numbers}base_failed boolean, score double, _apart double")
    judged = stored(judged, "judged")
    marked = judged.join(known, F.col("doc_id") == F.col("_id"))
    least = threshold_of(marked.select(F.expr("if(_good = 1, _apart, score)").alias("_score"), "_good"), keep_good)
    kept = ~F.col("base_failed") & (F.col("score") >= F.lit(least))
    return judged.select("doc_id", *_COUNTS, "base_failed", kept.alias("kept"), "score")
