"""A task that has two Python workers at once leaves its executor with twice as many, each with its memory."""

from repopulse.llm import jaccard, pii
from repopulse.llm.store import stored
from tests.llm.samples import copies, documents, seeded

PYTHON = ("MapInArrow", "MapInPandas", "ArrowEvalPython", "BatchEvalPython", "FlatMapGroups", "FlatMapCoGroups")


def workers(df):
    """Python workers that a task of this plan has at once, at most."""
    most = [0]

    def walk(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(node.initialPlan())
        below = [walk(node.children().apply(k)) for k in range(node.children().size())]
        # A task of a union has rows of one side alone.
        here = max(below, default=0) if name.startswith("Union") else sum(below)
        here += name.startswith(PYTHON)
        most[0] = max(most[0], here)
        return 0 if "Exchange" in name else here

    walk(df._jdf.queryExecution().executedPlan())
    return most[0]


def seen(monkeypatch, module):
    found = {}

    def store(df, name):
        found[name] = max(found.get(name, 0), workers(df))
        return stored(df, name)

    monkeypatch.setattr(module, "stored", store)
    return found


def test_the_matrix_of_near_copies_takes_one_worker_a_task(spark, monkeypatch):
    found = seen(monkeypatch, jaccard)
    rows = documents(spark, copies(seeded(11)))
    least = jaccard.keep_one(rows)
    assert 0 < least.count() < rows.count() and workers(least) == 1
    assert found["matrix"] == 1 and max(found.values()) == 1


def test_replacing_personal_data_takes_one_worker_a_task(spark, monkeypatch):
    found = seen(monkeypatch, pii)
    texts = [(k, f"account of user{k}x{k % 7} or user{k}@mail.org here") for k in range(40)] + [(None, "a@b.org"), (41, None)]
    clean = pii.without_personal_data(documents(spark, texts))
    assert workers(clean) == 1 and max(found.values()) == 1
    assert clean.count() == len(texts) and clean.where("text like '%@%'").count() == 0
