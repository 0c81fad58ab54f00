import collections
import hashlib
import re
from fractions import Fraction

import pytest

from repopulse.llm import mixing as M
from tests.llm.samples import documents, messy_texts, none, prose, seeded

COLUMNS = "doc_id long, source string, text string"


def targets_by_hand(sizes, weights, passes, budget):
    """Share by weight, cap, and share the excess again until none is above."""
    full, share = set(), {}
    while True:
        rest = budget - sum(passes * sizes[s] for s in full)
        open_weight = sum(weights[s] for s in sizes if s not in full)
        share = {s: Fraction(rest * weights[s], open_weight) for s in sizes if s not in full}
        above = {s for s, v in share.items() if v >= passes * sizes[s]}
        if not above:
            return {s: Fraction(passes * sizes[s]) if s in full else share[s] for s in sizes}
        full |= above


def by_hand(rows, weights=M.WEIGHTS, passes=M.PASSES, budget=None):
    sized = [(i, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, s, t in rows]
    names = sorted({s for _, s, _ in sized if s is not None}) + [None] * any(s is None for _, s, _ in sized)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    sizes = {s: sum(n for _, own, n in sized if own == s) for s in names}
    total = sum(sizes.values())
    budget = total if budget is None else budget
    target = targets_by_hand(sizes, weight, passes, budget) if budget else {s: 0 for s in names}
    copies = []
    for place, s in enumerate(names):
        key = lambda e: (hashlib.md5(str("" if sized[e][0] is None else sized[e][0]).encode()).hexdigest()[:16], sized[e][0] or 0, sized[e][2])
        own = sorted((e for e, x in enumerate(sized) if x[1] == s), key=key)
        upto = 0
        for _ in range(passes):
            for e in own:
                upto += sized[e][2]
                if sized[e][2]:
                    copies.append((Fraction(upto, weight[s]), place, e))
    taken, left = collections.Counter(), budget
    for _, _, e in sorted(copies):
        left -= sized[e][2]
        if left < 0:
            break
        taken[e] += sized[e][2]
    out = [(i, n, sizes[s], float(target[s]), taken[e]) for e, (i, s, n) in enumerate(sized)]
    return sorted(out, key=str)


def sources(rng, many, kinds):
    names = [f"s{k}" for k in range(kinds)] + ["Ünï", "", None]
    rows = []
    for k in range(many):
        # One source holds a third of the documents, and some are very small.
        name = names[0] if rng.random() < 0.35 else names[min(int(rng.expovariate(0.4)), len(names) - 1)]
        rows.append((k, name, prose(rng, rng.choice([0, 1, 5, 40, 300]))))
    return rows


def found(df):
    return sorted((tuple(r) for r in M.taken_words(df).collect()), key=str)


@pytest.mark.parametrize("number", range(3))
def test_targets_and_taken_words_equal_those_by_hand(spark, number):
    rows = sources(seeded(number), 160, 4 + number)
    assert found(M.schedule(spark.createDataFrame(rows, COLUMNS))) == by_hand(rows)


@pytest.mark.parametrize("share", [0, 0.4, 1.7, 3, 9])
def test_other_weights_passes_and_budgets(spark, share):
    rows = sources(seeded(5), 120, 5)
    total = sum(len(t.split()) for _, _, t in rows)
    got = found(M.schedule(spark.createDataFrame(rows, COLUMNS), (7, 3), 2, int(share * total)))
    assert got == by_hand(rows, (7, 3), 2, int(share * total))
    if share >= 2:
        assert all(taken == 2 * size and target == 2 * source for _, size, source, target, taken in got)


def test_messy_rows_and_clashing_names(spark):
    texts = messy_texts(seeded(2))
    df = documents(spark, texts).selectExpr("*", "1 as size", "2 as part", "'x' as place", "0 as finish", "1 as copies")
    rows = [(i, "s", t) for i, t in texts]
    assert found(M.schedule(df)) == by_hand(rows)


def test_reruns_and_other_partitions_agree(spark):
    rows = sources(seeded(6), 150, 6)
    df = spark.createDataFrame(rows, COLUMNS)
    first = found(M.schedule(df.repartition(7)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found(M.schedule(df.repartition(3).sort("text"))) == first
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_every_beginning_of_the_mix_has_the_sources_in_proportion(spark):
    rows = [(k, s, "word " * 10) for k, s in enumerate("abc" * 200)]
    planned = M.schedule(spark.createDataFrame(rows, COLUMNS), budget=4000)
    mixed = M.mix(planned).orderBy("finish", "source").collect()
    assert sum(r.size for r in mixed) == 4000
    for part in (80, 160, 240):
        words = collections.Counter(r.source for r in mixed[:part])
        assert abs(words["a"] - part * 5 / 8) <= 2 and abs(words["b"] - part * 2 / 8) <= 2 and abs(words["c"] - part / 8) <= 2
    again = collections.Counter((r.doc_id, r.copy) for r in mixed)
    assert max(again.values()) == 1


def test_another_seed_takes_other_documents(spark):
    df = spark.createDataFrame([(k, "ab"[k % 2], "word " * 10) for k in range(200)], COLUMNS)
    one, other = (found(M.schedule(df, budget=400, seed=s)) for s in ("", "x"))
    assert one != other and sum(r[4] for r in one) == sum(r[4] for r in other) == 400


def test_nothing_to_take(spark):
    assert M.schedule(none(spark)).count() == 0
    empty = M.schedule(spark.createDataFrame([(1, "a", None), (2, None, " \n")], COLUMNS))
    assert found(empty) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    assert M.mix(empty).count() == 0
    with pytest.raises(ValueError):
        M.schedule(none(spark), weights=())
