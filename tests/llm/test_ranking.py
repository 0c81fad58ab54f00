import collections
import math
import re

import numpy as np
import pytest

from repopulse.llm import ranking as K
from tests.llm.samples import copies, documents, messy_texts, none, prose, seeded

ITEMS = "item_id long, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def by_hand(docs, items, best=10):
    counted = [(i, collections.Counter(terms(t))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    N, L = len(counted), sum(n for _, _, n in counted)
    df = collections.Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, n in counted:
            m = 100 - 75 + 75 * n * N // L
            score = sum(
                math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m))
                for t in terms(text)
                if t in c
            )
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, k + 1, None if null else i, -s) for k, (s, null, i) in enumerate(sorted(scores)[:best])]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def corpus(rng, many=150):
    texts = [(k, prose(rng, rng.choice([1, 3, 20, 60, 200]))) for k in range(many)]
    texts += [(500 + k, t) for k, (_, t) in enumerate(copies(rng, 40))]
    same = prose(rng, 15)
    texts += [(900 - k, same) for k in range(25)]  # more ties than places
    # A word that nearly all documents have, many times in some.
    return [(i, t + " common" * (i % 7)) for i, t in texts], same


def items(rng, texts, same):
    out = [(k, " ".join(rng.choice(texts)[1].split()[:30])) for k in range(25)]
    out += [(30, same), (31, same + " common common"), (32, "common"), (33, "nowhere to-be_found"), (34, None), (35, " ,;"), (None, "common")]
    return out + [(36, "an an an COMMON"), (36, same)]


@pytest.mark.parametrize("shard,block_terms", [(4096, 1 << 20), (16, 1 << 20), (7, 40)])
def test_ranks_equal_those_by_hand(spark, shard, block_terms):
    rng = seeded(shard)
    docs, same = corpus(rng)
    asked = items(rng, docs, same)
    got = K.search(documents(spark, docs).repartition(3), spark.createDataFrame(asked, ITEMS), shard=shard, block_terms=block_terms)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert found(got) == by_hand(docs, asked)


def test_messy_rows_and_clashing_names(spark):
    docs = messy_texts(seeded(2)) + [(k, "a word or two " + "ha " * k) for k in range(20, 45)]
    asked = [(1, "word"), (2, "it's ha 日本 ÜNÏCÖDÉ Ünïcödé"), (3, docs[5][1]), (4, ""), (None, "ha"), (5, "two " * 400 + docs[5][1])]
    df = documents(spark, docs).selectExpr("*", "1 as shard", "2 as number", "3 as query", "4 as term", "5 as times", "6 as lengths")
    queries = spark.createDataFrame(asked, ITEMS).selectExpr("*", "1 as query", "2 as term", "'x' as doc_id")
    assert found(K.search(df, queries, shard=5)) == by_hand(docs, asked)


def test_fewer_places(spark):
    rng = seeded(8)
    docs, same = corpus(rng, 60)
    asked = items(rng, docs, same)
    got = K.search(documents(spark, docs), spark.createDataFrame(asked, ITEMS), best=3, shard=20)
    assert found(got) == by_hand(docs, asked, 3)


def test_no_rows(spark):
    asked = spark.createDataFrame([(1, "word")], ITEMS)
    assert K.search(none(spark), asked).count() == 0
    docs = documents(spark, [(1, "word here"), (2, "other")])
    assert K.search(docs, spark.createDataFrame([], ITEMS)).count() == 0
    assert K.search(documents(spark, [(1, None), (2, " ")]), asked).count() == 0
    assert found(K.search(docs, asked)) == by_hand([(1, "word here"), (2, "other")], [(1, "word")])


@pytest.mark.parametrize("number", range(60))
def test_intervals_lead_to_the_final_scores(number):
    rng = np.random.default_rng(number)
    documents, best = int(rng.integers(1, 60)), int(rng.integers(1, 6))
    lists, scores = [], np.zeros(documents, np.int64)
    for _ in range(rng.integers(0, 9)):
        docs = rng.permutation(documents)[: rng.integers(1, documents + 1)]
        adds = np.sort(rng.integers(1, rng.choice([3, 50, 10**9]), len(docs)))[::-1].astype(np.int64)
        lists.append(K.Posted(docs.astype(np.int32), adds))
        scores[docs] += adds
    least = int(rng.choice([1, np.median(scores), scores.max()]))
    docs, got = K.resolved(lists, documents, least, best)
    assert (scores[docs] == got).all()
    top = np.sort(scores)[::-1][:best]
    must = np.flatnonzero((scores >= max(1, least)) & (scores >= top[-1]))
    assert set(must) <= set(docs)


def test_reading_stops_when_all_is_final():
    """Twelve documents are far ahead and at the top of a long list. That list names one of them again at its end, as no
    real list does: a score would tell if the end was read."""
    lists = [K.Posted(np.arange(12, dtype=np.int32), np.full(12, 10**6)) for _ in range(5)]
    long = np.r_[np.arange(2000), 3].astype(np.int32)
    lists.append(K.Posted(long, np.sort(np.r_[np.full(12, 1000), np.arange(1, 1990) // 3 + 1])[::-1].astype(np.int64)))
    docs, scores = K.resolved(lists, 2000, 1)
    assert sorted(docs) == list(range(12)) and set(scores) == {5 * 10**6 + 1000}
