"""Toxicity by class-conditional Kneser-Ney models.

Two bigram models, of toxic and of ordinary text, give each word of a document a log-likelihood
ratio. With n_c(v w) occurrences of a bigram in class c, N_c(v) = sum of n_c(v .), and D = `DISCOUNT`:

    P_c(w | v) = max(n_c(v w) - D, 0) / N_c(v) + D * |{w: n_c(v w) > 0}| / N_c(v) * Q_c(w)
    Q_c(w)     = max(t_c(w) - D, 0) / T_c + D * V_c / T_c * S(w)
    S(w)       = (max(t(w) - D, 0) + D * V / (V + 1)) / T

t_c(w) is the number of different words before w in class c, T_c their sum, V_c the words of the class;
t, T and V are the same over both classes together, with one more word for all that neither knows. A
class without the context goes to Q_c, one without any text to S. So a rare expression of one class has
the other's probability from counts that both share, and says little.

The score is a logistic regression on a few ratios of the toxic to the ordinary likelihood: those of all
words under both orders of the models, by P and by Q, normalised by length; the highest of windows of `WINDOWS`
words, and what is over `LEVELS`, shares of the highest ratio that any word of the model has, per hundred
words and in all, since one insult in a long document is lost in the mean. These take Q alone: after a context that
one class has once, P's ratio says more of the context than of the word.

Every count is kept, those of bigrams seen once too, under 64-bit hashes. The model may be broadcast because its
training texts are bounded: `MAX_BYTES` of each class have at most half as many words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from repopulse.llm import textops as T
from repopulse.llm.store import stored

THRESHOLD = 0.3
#: Labelled documents of each class that train the models, and that fit the regression.
MAX_PER_CLASS = 8000
MAX_CALIBRATION = 4000
#: Bytes of each class's texts in either part, with `ROW_BYTES` for every row.
MAX_BYTES = 1 << 25
ROW_BYTES = 64
WINDOWS = (1, 8)
LEVELS = (0.7, 0.9)
#: Kneser-Ney discount of bigrams and of continuation counts.
DISCOUNT = 0.75
FEATURES = 2 + len(WINDOWS) + 2 * len(LEVELS)
_START = np.uint64(0x5851F42D4C957F2D)


def bucket(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 4, by which labelled rows are dealt out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4


@dataclass(frozen=True)
class Model:
    """Logarithms for both classes, [ordinary, toxic]; the last entry of each is that of an unknown key.

    `words` are sorted hashes, as signed numbers: `own` is Q_c of a word, `total` and `back` are N_c and the weight of Q_c
    after it. `pairs` are sorted hashes of bigrams, `counts` their discounted counts (half floats). `top`
    is the highest ratio of Q_toxic to Q_ordinary.
    """

    words: np.ndarray
    own: np.ndarray
    total: np.ndarray
    back: np.ndarray
    pairs: np.ndarray
    counts: np.ndarray
    top: float


@dataclass(frozen=True)
class Scorer:
    """A model in the executors' memory, and the regression on its figures."""

    model: Broadcast
    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray


def _pairs(chunk: T.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of each word and of the word before it (a fixed one at the start), and the row."""
    data = T.lower_ascii(chunk.data)
    kinds = T.SPACE[data].copy()
    kinds[_PUNCTUATION[data]] = 1
    found = T.spans(kinds, chunk)
    hashes = T.word_hashes(data, found)
    before = np.empty_like(hashes)
    before[1:] = hashes[:-1]
    if len(before):
        before[0] = _START
        before[1:][found.row[1:] != found.row[:-1]] = _START
    return before, hashes, found.row


#: ASCII signs other than letters and digits part words, so that "word." is "word".
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[b for b in range(33, 127) if not chr(b).isalnum()]] = True


def _bigram(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return T.mix(before * np.uint64(3) + word)


def training_rows(labels: DataFrame, per_class: int, calibration: int) -> DataFrame:
    """(id, toxic, fit): a bounded, deterministic sample of labelled rows that are not held out.

    Rows without an id or a label, and ids with contradicting labels, do not count.
    """
    known = (
        labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("_toxic"))
        .where("_id is not null and _toxic in (0, 1)")
        .groupBy("_id")
        .agg(F.min("_toxic").alias("_toxic"), F.max("_toxic").alias("_most"))
        .where("_toxic = _most")
        .select("_id", "_toxic", bucket(F.col("_id")).alias("_bucket"), F.xxhash64("_id").alias("_order"))
    )
    parts = [
        known.where((F.col("_toxic") == toxic) & F.col("_bucket").isin(*buckets)).orderBy("_order", "_id").limit(most)
        for toxic in (0, 1)
        for buckets, most in (((0, 1), per_class), ((3,), calibration))
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.select("_id", "_toxic", (F.col("_bucket") != 3).alias("_fit"))


def _count_bigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in T.each(batches):
        toxic = batch.column("_toxic").to_numpy()
        for chunk in T.chunks(batch.column("_text")):
            before, word, row = _pairs(chunk)
            order = np.lexsort((word, before))
            before, word, kind = before[order], word[order], toxic[chunk.first + row[order]]
            if not len(word):
                continue
            new = np.flatnonzero(np.r_[True, (before[1:] != before[:-1]) | (word[1:] != word[:-1])])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(T.signed(before[new])),
                    pa.array(T.signed(word[new])),
                    pa.array(np.add.reduceat((kind == 0).astype(np.int64), new)),
                    pa.array(np.add.reduceat((kind == 1).astype(np.int64), new)),
                ],
                names=["before", "word", "n0", "n1"],
            )


def within(chosen: DataFrame, most: int) -> DataFrame:
    """The rows of `chosen`, by ids in the order of their hashes, up to `most` bytes of each class and
    part. All rows of an id count; one with more than an eighth of `most` is left out."""
    cost = F.sum(F.coalesce(F.octet_length("_text"), F.lit(0)).cast("long") + ROW_BYTES).alias("_cost")
    sizes = chosen.groupBy("_id", "_toxic", "_fit").agg(cost).where(F.col("_cost") <= most // 8)
    # One row per sampled id, of which there are at most as many as the sample's bounds allow.
    running = F.sum("_cost").over(Window.partitionBy("_toxic", "_fit").orderBy(F.xxhash64("_id"), "_id"))
    kept = sizes.withColumn("_running", running).where(F.col("_running") <= most).select("_id")
    return chosen.join(F.broadcast(kept), "_id")


def _pair_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash of each bigram and its discounted counts, logarithms as the bits of half floats."""
    for batch in T.each(batches):
        before, word = (batch.column(c).to_numpy().view(np.uint64) for c in ("before", "word"))
        with np.errstate(divide="ignore"):
            logs = [np.log(np.maximum(batch.column(c).to_numpy() - DISCOUNT, 0)) for c in ("n0", "n1")]
        codes = [pa.array(x.astype(np.float16).view(np.int16)) for x in logs]
        keys = pa.array(T.signed(_bigram(before, word)))
        yield pa.RecordBatch.from_arrays([keys, *codes], names=["key", "l0", "l1"])


def _log(x: str) -> str:
    return f"float(if({x} > 0, ln({x}), double('-Infinity')))"


def train(docs: DataFrame) -> Model:
    """The model of a bounded table (_text, _toxic)."""
    counts = stored(
        docs.select("_text", "_toxic")
        .mapInArrow(_count_bigrams, "before long, word long, n0 long, n1 long")
        .groupBy("before", "word")
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")),
        "toxic-bigrams",
    )
    seen = [f"int(n{c} > 0)" for c in (0, 1)]
    sides = (
        f"named_struct('key', before, 'n0', n0, 'n1', n1, 'd0', {seen[0]}, 'd1', {seen[1]}, 't0', 0, 't1', 0, 't', 0)",
        f"named_struct('key', word, 'n0', 0L, 'n1', 0L, 'd0', 0, 'd1', 0, 't0', {seen[0]}, 't1', {seen[1]}, 't', 1)",
    )
    rows = counts.selectExpr(f"inline(array({', '.join(sides)}))")
    words = stored(rows.groupBy("key").agg(*[F.sum(c).alias(c) for c in rows.columns[1:]]), "toxic-words")
    sums = [f"sum({t}) as {t}" for t in ("t0", "t1", "t")] + [f"count_if({t} > 0) as v{t[1:]}" for t in ("t0", "t1", "t")]
    every = {k: v or 0 for k, v in words.selectExpr(*sums).first().asDict().items()}

    def discounted(t: str, c: str, lower: str) -> str:
        if not every[f"t{c}"]:
            return lower
        return f"((greatest({t} - {DISCOUNT}D, 0D) + {DISCOUNT * every[f'v{c}']!r}D * {lower}) / {every[f't{c}']}D)"

    shared = {t: discounted(t, "", f"{1 / (every['v'] + 1)!r}D") for t in ("t", "0")}
    own = [discounted(f"t{c}", str(c), shared["t"]) for c in (0, 1)]
    unknown = [discounted("0", str(c), shared["0"]) for c in (0, 1)]
    after = [f"if(n{c} > 0, {_log(f'double(n{c})')}, 0F)" for c in (0, 1)]
    back = [f"if(n{c} > 0, {_log(f'{DISCOUNT}D * d{c} / n{c}')}, 0F)" for c in (0, 1)]
    names = [f"{name}{c}" for name in ("own", "total", "back") for c in (0, 1)]
    values = [_log(own[0]), _log(own[1]), *after, *back]
    spark = docs.sparkSession
    least = [*spark.range(1).selectExpr(*[_log(u) for u in unknown]).first(), 0.0, 0.0, 0.0, 0.0]
    # Spark sorts, so that the driver holds no more than what it fetched and the arrays themselves.
    columns = [f"{v} as {n}" for v, n in zip(values, names, strict=True)]
    found = words.selectExpr("key", *columns).orderBy("key").toArrow()
    keys = found["key"].to_numpy()
    table = {n: np.append(found[n].to_numpy(), np.float32(x)) for n, x in zip(names, least, strict=True)}
    found = counts.mapInArrow(_pair_rows, "key long, l0 short, l1 short").orderBy("key").toArrow()
    pairs = found["key"].to_numpy()
    logs = [np.append(found[n].to_numpy().view(np.float16), np.float16(-np.inf)) for n in ("l0", "l1")]
    del found
    own, total, back = (np.stack([table[f"{n}0"], table[f"{n}1"]]) for n in ("own", "total", "back"))
    return Model(keys, own, total, back, pairs, np.stack(logs), float((own[1] - own[0]).max()))


def _find(keys: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Where each hash is among the sorted keys; -1, the entry of unknown ones, if it is not."""
    if not len(keys):
        return np.full(len(hashes), -1)
    asked, _, which = T.distinct(T.signed(hashes))
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, at, -1)[which]


def log_likelihoods(model: Model, before: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log P_c(word | before) and log Q_c(word) for c of ordinary, toxic. `before` is `word` moved by one, or
    the start."""
    single = _find(model.words, word)
    context = np.empty_like(single)
    context[1:] = single[:-1]
    context[before == _START] = _find(model.words, np.array([_START]))[0]
    pair = _find(model.pairs, _bigram(before, word))
    known = np.flatnonzero(pair >= 0)
    own = model.own[:, single]
    value = own + model.back[:, context]
    more = model.counts[:, pair[known]].astype(np.float32) - model.total[:, context[known]]
    value[:, known] = np.logaddexp(value[:, known], more)
    return value, own


def features(model: Model, texts: pa.Array) -> np.ndarray:
    """Per text: mean ratio by P, and by Q; the highest mean by Q of its windows of each length (the sum
    divided by that length where the text is shorter); the excess by Q over each level, per hundred words and
    in all (as logarithm). All zero for a text without words."""
    out = np.zeros((len(texts), FEATURES))
    for chunk in T.chunks(texts):
        before, word, row = _pairs(chunk)
        if not len(word):
            continue
        after, alone = (x[1].astype(np.float64) - x[0] for x in log_likelihoods(model, before, word))
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        length = np.diff(np.r_[first, len(row)])
        begin = np.repeat(first, length)
        sums = np.r_[0.0, np.cumsum(alone)]
        at = np.arange(len(row))
        found = [np.add.reduceat(ratio, first) / length for ratio in (after, alone)]
        for window in WINDOWS:
            means = (sums[at + 1] - sums[np.maximum(at - window + 1, begin)]) / window
            found.append(np.maximum.reduceat(means, first))
        for level in LEVELS:
            excess = np.add.reduceat(np.maximum(alone - level * model.top, 0), first)
            found += [excess / length * 100, np.log1p(excess)]
        out[chunk.first + row[first]] = np.stack(found, axis=1)
    return out


def _regression(x: np.ndarray, y: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Weights of a logistic regression with a small ridge, the constant last, by Newton steps."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    ridge = np.diag(np.r_[np.full(x.shape[1] - 1, 1.0), 1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + ridge, x.T @ (p - y) + ridge @ w)
        w = w - step
    return w


def fit(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    per_class: int = MAX_PER_CLASS,
    calibration: int = MAX_CALIBRATION,
    most_bytes: int = MAX_BYTES,
) -> Scorer:
    """Train on labelled documents, whole texts, that are not held out: two quarters of the ids
    give the counts and one the regression. `per_class` and `calibration` bound the ids of each
    class, `most_bytes` their texts, also where many rows share an id. Without labels of both classes
    every score is 1/2."""
    T.prepare(docs)
    rows = training_rows(labels, per_class, calibration)
    texts = docs.select(F.col("doc_id").alias("_id"), F.col(text).alias("_text"))
    # At most 2 * (per_class + calibration) rows of two numbers and a flag.
    chosen = stored(within(texts.join(F.broadcast(rows), "_id"), most_bytes), "toxic-sample")
    shared = docs.sparkSession.sparkContext.broadcast(train(chosen.where("_fit")))
    T.give_back()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.each(batches):
            found = features(shared.value, batch.column("_text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_toxic"), *[pa.array(found[:, k]) for k in range(FEATURES)]],
                names=["toxic", *[f"f{k}" for k in range(FEATURES)]],
            )

    schema = "toxic int, " + ", ".join(f"f{k} double" for k in range(FEATURES))
    held = chosen.where("not _fit").select("_text", "_toxic").mapInArrow(measure, schema).toArrow()
    x = np.stack([held[f"f{k}"].to_numpy() for k in range(FEATURES)], axis=1)
    y = held["toxic"].to_numpy().astype(float)
    if len(x) == 0 or y.min() == y.max():
        return Scorer(shared, np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES + 1))
    center, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    return Scorer(shared, center, scale, _regression((x - center) / scale, y))


def score(docs: DataFrame, scorer: Scorer, text: str = "text", column: str = "_score") -> DataFrame:
    """All rows and columns of `docs`, and a score from 0 to 1 of each whole text. A null or empty
    text gets the score of one without any evidence. Nothing but the text goes into it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.each(batches):
            x = (features(scorer.model.value, batch.column(text)) - scorer.center) / scorer.scale
            value = 1 / (1 + np.exp(-np.clip(x @ scorer.weights[:-1] + scorer.weights[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(value)], names=[*batch.schema.names, column])

    schema = StructType([*docs.schema.fields, StructField(column, DoubleType())])
    return docs.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **bounds: int) -> DataFrame:
    """Per row of `docs`: doc_id, held_out, score, predicted.

    Rows that share an id are scored one by one; a row without an id counts as the empty text of
    one. Other columns of `docs` and `labels` are ignored. No labels: every score is 1/2.
    """
    scorer = fit(docs, labels, **bounds)
    rows = docs.select("doc_id", F.col("text").alias("_text"))
    return score(rows, scorer, "_text").select(
        "doc_id",
        (bucket(F.col("doc_id")) == 2).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= threshold).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **bounds: int) -> DataFrame:
    """The rows of `docs` with a score below the threshold, with their columns. A document with
    a null or empty text, or without words, has nothing to be rejected for and stays."""
    scorer = fit(docs, labels, **bounds)
    # The text goes to Python once, beside the other columns.
    others = F.struct(*[T.column(c) for c in docs.columns if c != "text"]).alias("_row")
    scored = score(docs.select(others, F.col("text").alias("_text")), scorer, "_text")
    worded = F.coalesce(F.col("_text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    every = [(F.col("_text") if c == "text" else F.col("_row").getField(c)).alias(c) for c in docs.columns]
    return scored.where((F.col("_score") < threshold) | ~worded).select(*every)
