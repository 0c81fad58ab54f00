import pytest
from pyspark.sql import Observation

from repopulse.operators import checks
from repopulse.operators.activity import MEASURES
from tests.records import REPOSITORIES, golden_staged, tuples


def failures(df):
    return {row.key: row.failures for row in df.collect()}


def test_null_keys(spark):
    issues = golden_staged(spark)["issues"]
    found = checks.null_keys(issues, "issues", ["repo_name", "issue_created_at", "issue_title"])
    assert found.columns == ["check", "relation", "key", "severity", "failures"]
    assert tuples(found.where("key = 'repo_name'")) == [("null_keys", "issues", "repo_name", "warn", 1)]
    assert failures(found) == {"repo_name": 1, "issue_created_at": 1, "issue_title": 6}


def test_weights_stand_for_rows(spark):
    counts = spark.createDataFrame([(None, 5), ("a", 2), (None, 1)], "k string, n long")
    assert failures(checks.null_keys(counts, "t", ["k"], counts["n"])) == {"k": 6}
    parents = spark.createDataFrame([("b",)], "name string")
    assert failures(checks.orphans(counts, "t", "k", parents, "name", counts["n"])) == {"k": 2}


def test_duplicate_keys_ignore_nulls(spark):
    rows = [("a", 1), ("a", 1), ("a", 2), (None, 1), (None, 1), ("b", 1), ("b", 1)]
    df = spark.createDataFrame(rows, "k string, n long")
    assert failures(checks.duplicate_keys(df, "t", ["k", "n"])) == {"k,n": 2}
    assert failures(checks.duplicate_keys(df, "t", ["k"])) == {"k": 2}


def test_orphans(spark):
    staged = golden_staged(spark, REPOSITORIES + REPOSITORIES)
    found = checks.orphans(staged["issues"], "issues", "repo_name", staged["repositories"], "repo_full_name")
    assert failures(found) == {"repo_name": 1}


def test_orphans_with_a_null_parent(spark):
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    parents = spark.createDataFrame([("a",), (None,)], "name string")
    assert failures(checks.orphans(df, "t", "k", parents, "name")) == {"k": 1}


def test_bad_measures(spark):
    rows = [(1, 2, 2, 0), (-1, 0, 0, -3), (0, 1, 2, -1)]
    daily = spark.createDataFrame(rows, ", ".join(f"{m} long" for m in MEASURES))
    assert failures(checks.bad_measures(daily, "t")) == {
        "issues_created": 1,
        "prs_created": 0,
        "prs_merged": 0,
        "comments_created": 2,
        "prs_merged<=prs_created": 1,
    }


def test_checks_on_an_empty_table_find_nothing(spark):
    daily = spark.createDataFrame([], "repo_name string, " + ", ".join(f"{m} long" for m in MEASURES))
    parents = spark.createDataFrame([], "name string")
    found = (
        checks.bad_measures(daily, "t")
        .unionByName(checks.null_keys(daily, "t", ["repo_name"]))
        .unionByName(checks.duplicate_keys(daily, "t", ["repo_name"]))
        .unionByName(checks.orphans(daily, "t", "repo_name", parents, "name"))
    )
    assert [row.failures for row in found.collect()] == [0] * 8


def test_gate_raises_on_errors_only(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    warning = checks.null_keys(df, "t", ["k"])
    assert [row.failures for row in checks.gate(warning)] == [1]
    with pytest.raises(checks.ChecksFailed, match="duplicate_keys t.k: 1") as raised:
        checks.gate(warning, checks.duplicate_keys(df, "t", ["k"]))
    assert [row.check for row in raised.value.rows] == ["duplicate_keys"]


def test_checks_are_counted_while_the_rows_are_written(spark, tmp_path):
    rows = [("a", 1, 2, 2, 0), (None, -1, 0, 0, -3), (None, 0, 1, 2, -1)]
    daily = spark.createDataFrame(rows, "k string, " + ", ".join(f"{m} long" for m in MEASURES))
    tested = [checks.null_key_check("t", ["k"], daily["prs_created"]), checks.measures_check("t")]
    expected = tuples(checks.results(daily, *tested))
    observation = Observation("t")
    checks.observed(daily.repartition(3), observation, *tested).write.parquet(str(tmp_path / "t"))
    assert [tuple(r) for r in checks.observed_rows(observation, *tested)] == expected
    assert len(expected) == 6 and expected[0] == ("null_keys", "t", "k", "warn", 1)
    none = Observation("none")
    checks.observed(daily.where("false"), none, *tested).write.parquet(str(tmp_path / "none"))
    assert [r.failures for r in checks.observed_rows(none, *tested)] == [0] * 6


def test_one_look_at_counts_and_names(spark):
    counts = spark.createDataFrame(
        [("a", "2024-01-01", 1, 2), ("a", None, 1, 0), ("x", "2024-01-01", 3, 5), (None, "2024-01-01", 9, 9)],
        "repo_full_name string, day string, issues long, comments long",
    )
    names = spark.createDataFrame([("a", 2, 2), ("b", 3, 1), ("c", 1, 1)], "repo_full_name string, listed long, ids long")
    together, tested = checks.names_checks(counts, names, {"issues": "issues", "comments": "comments"}, "daily", 1)
    assert [(r.check, r.relation, r.failures) for r in checks.results(together, *tested).collect()] == [
        ("orphans", "issues", 3),
        ("orphans", "comments", 5),
        ("duplicate_keys", "repositories", 2),
        ("duplicate_keys", "daily", 1),
        ("crowded_names", "repositories", 1),
    ]
