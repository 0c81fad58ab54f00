import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from repopulse.llm import jaccard, toxicity
from repopulse.llm.store import stored
from repopulse.llm.textops import table
from tests.llm.samples import documents, messy_texts, seeded

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


def test_stages_and_queries_are_registered():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_copies", "decontamination", "personal_data", "packing",
    ]
    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10 and "pipeline" in names


def test_every_stage_acts_on_what_the_one_before_kept(spark):
    rows = table(spark, SF_DIR, "documents")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        rows = stored(stage(spark, rows, SF_DIR), name)
        kept.append(rows)
    toxic, unique, clean, private, packed = kept
    assert all(df.columns == COLUMNS for df in kept[:4])
    ids = [sorted(r.doc_id for r in df.select("doc_id").collect()) for df in kept[:4]]
    scores = toxicity.toxicity(table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels"))
    assert ids[0] == sorted(r.doc_id for r in scores.where("predicted = 0").collect())
    groups = jaccard.similar_documents(toxic).where("component_id = doc_id")
    assert ids[1] == sorted(r.doc_id for r in groups.collect())
    assert set(ids[2]) < set(ids[1]) and ids[3] == ids[2]
    assert private.where("text rlike '[0-9]@mail'").count() == 0 < clean.where("text rlike '[0-9]@mail'").count()
    assert private.where("n_chars <> length(text)").count() == 0
    assert sorted({r.doc_id for r in packed.collect()}) == ids[3]


def test_messy_documents_go_through(spark):
    texts = messy_texts(seeded(3))
    rows = documents(spark, texts)
    columns = rows.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        rows = stored(stage(spark, rows, SF_DIR), name)
        assert rows.columns == columns or k == 4
    ids = {r.doc_id for r in rows.collect()}
    assert {None, 1, 2, 3} <= ids and 6 not in ids


def test_no_documents(spark):
    rows = documents(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        rows = stored(stage(spark, rows, SF_DIR), name)
    assert rows.count() == 0
