import numpy as np
import pytest
from pyspark.sql import functions as F

from repopulse.llm import jaccard as J
from repopulse.llm.components import components
from tests.llm.samples import copies, documents, messy_texts, none, prose, seeded


def shingle_set(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if len(words) < J.SHINGLE:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + J.SHINGLE]) for k in range(len(words) - J.SHINGLE + 1)}


def by_hand(texts):
    sets = [(i, shingle_set(t)) for i, t in texts]
    label = {i: i for i, _ in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in sets:
        for k, b in sets:
            if a and b and i is not None and k is not None and 100 * len(a & b) >= J.LEAST * len(a | b):
                low, high = sorted((root(i), root(k)))
                label[high] = low
    return sorted([(i, len(s), None if i is None else root(i)) for i, s in sets], key=str)


def joined(spark, texts, **more):
    return sorted(map(tuple, J.similar_documents(documents(spark, texts), **more).collect()), key=str)


@pytest.mark.parametrize("seed, group", [(1, J.GROUP), (2, 2), (3, 5), (4, 1)])
def test_components_equal_those_by_hand(spark, seed, group):
    texts = copies(seeded(seed))
    assert joined(spark, texts, group=group) == by_hand(texts)


def family(rng, many, words=40, edits=3):
    """Copies of one text with some words replaced: similar, and mostly not linked."""
    base = prose(rng, words).split()
    texts = []
    for k in range(many):
        own = list(base)
        for at in rng.sample(range(words), edits):
            own[at] = f"new{rng.randrange(10**9)}"
        texts.append((k, " ".join(own)))
    return texts


@pytest.mark.parametrize("edits, group", [(1, 8), (2, 64), (3, 16)])
def test_families_that_hardly_link(spark, edits, group):
    texts = family(seeded(edits), 150, edits=edits)
    assert joined(spark, texts, group=group) == by_hand(texts)


def matrix_rows(spark, texts):
    """Rows that the groups of a family make where they meet, and the pairs of groups that are opened."""
    docs = documents(spark, texts).select("doc_id", "text")
    nodes = J.stored(
        J._describe(docs, J.token_ranks(docs.select("text"), J.SHINGLE), J.SHINGLE, J.LEAST).withColumnRenamed("doc_id", "rep")
        .withColumn("node", F.col("rep")), "nodes",
    )
    star = J.stored(J._star_pairs(J._shared_keys(nodes)), "star")
    compared = J.stored(J._compared(docs, nodes, star, J.SHINGLE), "compared")
    dealt, grouped = J._dealt(nodes, compared, nodes.selectExpr("node", "node as grp"), J.GROUP)
    matrix = nodes.select("node", F.explode("tokens").alias("token")).join(dealt, "node").select("token", "part").distinct()
    met = matrix.join(matrix.withColumnRenamed("part", "other"), "token").where("part < other").count()
    return met, J._opened(nodes, dealt, grouped, J.LEAST).count(), dealt.select("part").distinct().count()


def test_a_large_family_meets_in_groups(spark):
    small, large = (matrix_rows(spark, family(seeded(9), many)) for many in (500, 2000))
    # Each document apart would make some 11,000 and 160,000 rows where they meet.
    assert small[0] <= 1000 and large[0] <= 1000
    assert large[1] <= 40 and large[2] <= 800


def test_links_of_two_groups_bring_together_what_is_linked():
    rng = np.random.default_rng(4)
    for case in range(60):
        base = rng.choice(500, 40, replace=False)
        sets = []
        for _ in range(int(rng.integers(1, 30))):
            keep = base[rng.random(40) > rng.choice([0, 0.05, 0.15, 0.5])]
            sets.append(np.unique(np.r_[keep, rng.integers(1000, 10**6, int(rng.integers(1, 4)))]).astype(np.uint64))
        many = len(sets)
        split = many if case % 3 == 0 else int(rng.integers(0, many + 1))
        groups = rng.integers(0, max(1, many // 2), many) * 10 if case % 2 else np.arange(many)
        nodes = (np.arange(many) * 7).tolist()
        label = {i: int(groups[i]) for i in range(many)}

        def merge(a, b):
            low, high = sorted((label[a], label[b]))
            for k, v in label.items():
                if v == high:
                    label[k] = low

        found = J.linked_groups(nodes, sets, np.array(groups, np.int64), split, 80)
        mine = dict(label)
        for a, b in found:
            assert label[a // 7] != label[b // 7]  # none too many
            merge(a // 7, b // 7)
        got, label = label, mine
        for i in range(many):
            for j in range(i + 1, many):
                across = split == many or (i < split <= j)
                common = len(np.intersect1d(sets[i], sets[j]))
                if across and 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                    merge(i, j)
        assert got == label


def test_short_texts_and_chains(spark):
    rng = seeded(5)
    words = prose(rng, 200).split()
    # Each is similar to the next, the ends of the chain are not similar to each other.
    texts = [(k, " ".join(words[3 * k : 3 * k + 60])) for k in range(30, -1, -1)]
    texts += [(100 + k, " ".join(["a", "b", "c", "d", "e", "f"][: k % 7])) for k in range(20)]
    found = joined(spark, texts)
    assert found == by_hand(texts) and {c for i, _, c in found if i <= 30} == {0}


def test_messy_rows(spark):
    texts = messy_texts(seeded(3))
    assert joined(spark, texts) == by_hand(texts)
    assert J.similar_documents(none(spark)).count() == J.keep_one(none(spark)).count() == 0
    docs = documents(spark, texts)
    kept = J.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.select("doc_id").collect()), key=str)
    assert ids == sorted([None, None, 1, 2, 3, 4, 5, 8, 9, 10, 12, 13], key=str)


def test_prefixes_and_needs_lose_no_pair():
    rng = np.random.default_rng(1)
    for _ in range(3000):
        n = int(rng.integers(1, 60))
        a = set(rng.choice(200, n, replace=False).tolist())
        b = set(list(a)[: int(rng.integers(1, n + 1))]) | set(rng.choice(200, int(rng.integers(0, 12))).tolist())
        if 100 * len(a & b) < J.LEAST * len(a | b):
            continue
        (la, lb) = J._prefix_lengths(np.array([len(a), len(b)]), J.LEAST).tolist()
        common = len(set(sorted(a)[:la]) & set(sorted(b)[:lb]))
        whole = -(-J.LEAST * (len(a) + len(b)) // (100 + J.LEAST))
        assert common >= max(1, whole - max(len(a) - la, len(b) - lb))


def test_components(spark):
    rng = seeded(8)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(500, 600)]
    links += [(None, 3), (4, 4)]
    label = {}

    def root(i):
        while label.setdefault(i, i) != i:
            i = label[i]
        return i

    for a, b in links:
        if a is not None and a != b:
            low, high = sorted((root(a), root(b)))
            label[high] = low
    found = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert found == {i: root(i) for i in label}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
