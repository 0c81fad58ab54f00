import collections
import math

import numpy as np
import pyarrow as pa
import pytest

from repopulse.llm import lm_score as L
from tests.llm.samples import documents, messy_texts, none, prose, seeded


def by_hand(texts, order):
    rows = [(text or "").encode().lower().split() for _, text in texts]

    def grams(words):
        return collections.Counter(tuple(words[k : k + n]) for n in range(1, order + 1) for k in range(len(words) - n + 1))

    every = collections.Counter()
    for words in rows:
        every.update(grams(words))
    total = sum(map(len, rows))
    out = []
    for (doc_id, _), words in zip(texts, rows):
        own, score = grams(words), 0.0
        for k in range(len(words)):
            value = L.BACKOFF**order / (total + 1)
            for n in range(min(order, k + 1), 0, -1):
                gram = tuple(words[k - n + 1 : k + 1])
                context = every[gram[:-1]] - own[gram[:-1]] if n > 1 else max(1, total - len(words))
                if every[gram] > own[gram] and context > 0:
                    value = L.BACKOFF ** (order - n) * (every[gram] - own[gram]) / context
                    break
            score += math.log(value)
        out.append((doc_id, len(words), round(score, 6), round(score / max(1, len(words)), 6)))
    return sorted(out, key=str)


def scored(df):
    return sorted([(r[0], r[1], round(r[2], 6), round(r[3], 6)) for r in df.collect()], key=str)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_those_by_hand(spark, monkeypatch, order):
    monkeypatch.setattr(L, "CHUNK_BYTES", 2000)
    monkeypatch.setattr(L, "BUCKET_BYTES", 1000)
    rng = seeded(order)
    texts = [(k, prose(rng, rng.randrange(60), 12)) for k in range(40)]
    assert scored(L.stupid_backoff(documents(spark, texts), order)) == by_hand(texts, order)


def test_messy_rows(spark):
    texts = messy_texts(seeded(3))
    assert scored(L.stupid_backoff(documents(spark, texts))) == by_hand(texts, L.ORDER)
    assert L.stupid_backoff(none(spark)).count() == 0
    with pytest.raises(ValueError):
        L.stupid_backoff(none(spark), 0)


def test_totals_beyond_32_bits():
    grams = [np.array(g, np.uint64) for g in ([5, 9], [5, 1 << 60])]
    counts = [np.array(c, np.uint32) for c in ([3_000_000_000, 1], [3_000_000_000, 2])]
    table = pa.table(
        {
            "chunk": [0, 1],
            "bucket": [0, 0],
            "grams": pa.array([L._packed(L._steps(g)) for g in grams], pa.binary()),
            "counts": pa.array([L._packed(c) for c in counts], pa.binary()),
        }
    )
    found = [L._unpacked(t, np.uint64).tolist() for t in L._totals(table)["totals"].to_pylist()]
    assert found == [[6_000_000_000, 1], [6_000_000_000, 2]]
