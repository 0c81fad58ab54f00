import numpy as np

from repopulse.llm import decontaminate as D
from tests.llm.samples import documents, messy_texts, none, prose, seeded

ITEMS = "item_id long, text string"


def smith_waterman(a, b):
    best, above = 0, [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for k, y in enumerate(b):
            row.append(max(0, above[k] + (D.MATCH if x == y else D.MISMATCH), above[k + 1] + D.GAP, row[k] + D.GAP))
        best, above = max(best, *row), row
    return best


def test_alignment_equals_the_plain_one():
    rng = seeded(1)
    items = [np.array([rng.randrange(6) for _ in range(rng.randrange(1, 25))], np.uint64) for _ in range(300)]
    windows = [np.array([rng.randrange(6) for _ in range(rng.randrange(0, 60))], np.uint64) for _ in range(300)]
    windows[0] = np.r_[items[0], items[0]]
    found, ends = D.align(items, windows)
    assert found.tolist() == [smith_waterman(a.tolist(), b.tolist()) for a, b in zip(items, windows)]
    assert ends[0] == len(items[0])
    assert [x.tolist() for x in D.align([], [])] == [[], []]


def edited(rng, text, every):
    words = text.split()
    for k in range(every - 1, len(words), every):
        words[k] = rng.choice([f"new{k}", "", f"two{k} more{k}"])
    return " ".join(w for w in words if w)


def test_copies_are_found_and_clean_documents_are_not(spark):
    rng = seeded(2)
    items = [(k, prose(rng, 35)) for k in range(20)]
    texts, expected = [], set()
    for k in range(60):
        text = prose(rng, 100)
        if k % 3 == 0:
            item = k % 20
            copy = items[item][1] if k % 2 else edited(rng, items[item][1], 7)
            text = f"{text}\n{copy.upper().replace('É', 'é') if k % 5 == 0 else copy} {prose(rng, 40)}"
            expected.add((k, item))
        texts.append((k, text))
    rows = D.contaminated(documents(spark, texts), spark.createDataFrame(items, ITEMS)).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == expected
    assert all((r.score == 1) == (r.doc_id % 2 == 1) for r in rows)
    kept = D.drop_contaminated(documents(spark, texts), spark.createDataFrame(items, ITEMS))
    assert {r.doc_id for r in kept.collect()} == {k for k, _ in texts} - {k for k, _ in expected}
    assert kept.columns == documents(spark, texts).columns


def test_a_passage_in_very_many_documents_is_still_found(spark):
    rng = seeded(3)
    items = [(1, prose(rng, 30)), (2, prose(rng, 30))]
    texts = [(k, f"{prose(rng, 20)} {items[0][1]} {prose(rng, 20)}") for k in range(150)]
    rows = D.contaminated(documents(spark, texts), spark.createDataFrame(items, ITEMS)).collect()
    assert sorted((r.doc_id, r.item_id, r.score) for r in rows) == [(k, 1, 1.0) for k in range(150)]


def test_messy_rows(spark):
    texts = messy_texts(seeded(4))
    same = dict(texts)[5]
    items = [(1, same), (1, same), (2, None), (3, ""), (4, "too few words"), (None, same), (5, dict(texts)[4])]
    bench = spark.createDataFrame(items, ITEMS).selectExpr("*", "item_id as doc_id", "text as words", "item_id as key")
    rows = D.contaminated(documents(spark, texts), bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in rows) == [(4, 5), (5, 1), (6, 1), (7, 1)]
    assert {r.doc_id: r.end_word for r in rows}[7] == len(same.split())
    assert D.contaminated(none(spark), bench).count() == D.contaminated(documents(spark, texts), bench.limit(0)).count() == 0
    kept = [r.doc_id for r in D.drop_contaminated(documents(spark, texts), bench).collect()]
    assert sorted(k for k in kept if k) == [1, 2, 3, 8, 9, 10, 11, 12, 13] and kept.count(None) == 2


def words_of(text):
    hashes, _ = D._words(next(D.T.chunks(D.pa.array([text], D.pa.string()))))
    return hashes


def grams_of(words, size):
    return [tuple(words[k : k + size].tolist()) for k in range(len(words) - size + 1)]


def by_hand(texts, items):
    """Every document against every item: two shared 4-grams, and the alignment of both as a whole."""
    expected = {}
    held = {i: words_of(t) for i, t in items}
    for doc_id, text in texts:
        words = words_of(text)
        for item_id, item in held.items():
            n = len(item)
            if n < D.SEED:
                if n >= D.LEAST_WORDS and tuple(item.tolist()) in grams_of(words, n):
                    expected[doc_id, item_id] = 1.0
                continue
            shared = [k for k, g in enumerate(grams_of(item, D.SEED)) if g in set(grams_of(words, D.SEED))]
            if len(shared) >= min(D.LEAST_SEEDS, n - D.SEED + 1):
                score = int(D.align([item], [words])[0][0])
                if score >= D.LEAST_SCORE * D.MATCH * n or score >= D.LEAST_ALIGNED:
                    expected[doc_id, item_id] = score / (D.MATCH * n)
    return expected


def test_whole_results_equal_brute_force(spark):
    rng = seeded(5)
    items = [(k, prose(rng, n)) for k, n in enumerate([1, 2, 3, 4, 5, 9, 20, 60, 64, 65, 130, 300, 300, 700])]
    texts = []
    for k in range(90):
        item = items[k % len(items)][1].split()
        part = rng.choice([len(item), len(item), max(1, len(item) // 2), min(len(item), 110), max(1, len(item) // 5)])
        first = rng.randrange(len(item) - part + 1)
        copy = " ".join(item[first : first + part])
        if k % 3 == 0:
            copy = edited(rng, copy, rng.randrange(6, 12))
        texts.append((k, f"{prose(rng, rng.randrange(200))} {copy} {prose(rng, rng.randrange(60))}"))
    texts += [(100 + k, prose(rng, 400)) for k in range(20)]
    rows = D.contaminated(documents(spark, texts), spark.createDataFrame(items, ITEMS), rare=1.0).collect()
    expected = by_hand(texts, items)
    assert {(r.doc_id, r.item_id): r.score for r in rows} == expected
    assert {i for _, i in expected} == set(range(1, len(items))) and not any(d >= 100 for d, _ in expected)
    rare = D.contaminated(documents(spark, texts), spark.createDataFrame(items, ITEMS)).collect()
    found = {(r.doc_id, r.item_id) for r in rare}
    assert found <= set(expected) and len(found) >= 0.95 * len(expected)


def test_unbroken_parts_of_long_items(spark):
    rng = seeded(6)
    item = prose(rng, 300).split()
    part = " ".join(item[90:200])
    # The part is the most frequent of the item's text, and a clean document is as long as it.
    texts = [(k, f"{prose(rng, 50)} {part} {prose(rng, 50)}") for k in range(40)]
    texts += [(100, " ".join(item[90:110])), (101, prose(rng, 3000)), (102, " ".join(item[60:112]))]
    rows = D.contaminated(documents(spark, texts), spark.createDataFrame([(1, " ".join(item))], ITEMS)).collect()
    assert {r.doc_id for r in rows} == {*range(40), 102}
    assert all(abs(r.score - 110 / 300) < 0.05 for r in rows if r.doc_id < 40)


def test_short_items_are_held_where_they_stand_whole(spark):
    rng = seeded(7)
    items = [(1, "zebra"), (2, "Quick zebra"), (3, "The quick, zebra!"), (4, "the quick zebra runs")]
    texts = [(1, prose(rng, 30) + " THE quick zebra " + prose(rng, 30)), (2, "quick zebra"), (3, "the quick red zebra"), (4, "zebra")]
    rows = D.contaminated(documents(spark, texts), spark.createDataFrame(items, ITEMS)).collect()
    assert sorted((r.doc_id, r.item_id, r.score) for r in rows) == [(1, 2, 1.0), (1, 3, 1.0), (2, 2, 1.0)]
    alone = D.contaminated(documents(spark, texts), spark.createDataFrame(items, ITEMS), least_words=1).collect()
    assert {(r.doc_id, r.item_id) for r in alone} == {(1, 2), (1, 3), (2, 2), (1, 1), (2, 1), (3, 1), (4, 1)}


def test_runs_start_where_nothing_reaches_over():
    rng = seeded(8)
    for _ in range(300):
        edges = [0, rng.randrange(1, 60), 60]
        at = np.array(sorted(rng.sample(range(60), rng.randrange(1, 12))))
        reach = np.array([rng.choice([1, 4, 20]) for _ in at])
        low = np.array([edges[0] if a < edges[1] else edges[1] for a in at])
        high = np.array([edges[1] if a < edges[1] else edges[2] for a in at])
        starts = [0]
        for k in range(1, len(at)):
            over = any(
                low[i] == low[j] and at[j] - at[i] <= max(reach[i], reach[j])
                and (reach[i] >= at[j] - at[i] or reach[j] >= at[j] - at[i])
                for i in range(k) for j in range(k, len(at))
                if at[i] + reach[i] >= at[k] or at[j] - reach[j] <= at[k - 1]
            )
            if not over:
                starts.append(k)
        assert D.run_edges(at, reach, low, high).tolist() == starts
