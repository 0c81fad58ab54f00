import datetime

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from repopulse.functions import json_text
from repopulse.operators import staging
from repopulse.sources.layout import LAYOUT, TABLES, raw_schema
from repopulse.sources.readers import read_raw
from tests.records import raw_frame

FAILED = (PySparkException, Py4JJavaError)


def moment(text):
    return datetime.datetime.fromisoformat(text)


def staged_row(spark, table, record):
    return staging.stage(table, raw_frame(spark, table, [record])).first().asDict()


LOADED = {"_airbyte_extracted_at": "2024-05-06T07:08:09Z", "_airbyte_raw_id": "raw-1"}
LOADED_OUT = {"_airbyte_extracted_at": moment("2024-05-06T07:08:09"), "_airbyte_raw_id": "raw-1"}


def test_comment(spark):
    record = dict(
        id=7, repository="o/a", user_id=70, user='{"login":"ada"}', created_at="2024-01-01T00:00:00Z",
        updated_at="2024-01-02T02:00:00+02:00", html_url="u1", issue_url="u2", body="text",
        author_association="MEMBER", **LOADED,
    )
    assert staged_row(spark, "comments", record) == dict(
        comment_id=7, repo_name="o/a", commenter_user_id=70, commenter_login="ada",
        comment_created_at=moment("2024-01-01T00:00:00"), comment_updated_at=moment("2024-01-02T00:00:00"),
        comment_url="u1", issue_url="u2", comment_body="text", author_association="MEMBER", **LOADED_OUT,
    )


def test_issue(spark):
    record = dict(
        id=1, number=2, repository="o/a", repository_url="ru", user_id=3, user='{"login":"bob","id":3}',
        state="closed", state_reason="completed", title="t", body="b", comments=None,
        created_at="2024-01-01T00:00:00.123456Z", updated_at=None, closed_at="2024-01-03T00:00:00Z",
        html_url="hu", **LOADED,
    )
    assert staged_row(spark, "issues", record) == dict(
        issue_id=1, issue_number=2, repo_name="o/a", repository_url="ru", author_user_id=3, author_login="bob",
        issue_state="closed", issue_state_reason="completed", issue_title="t", issue_body="b",
        issue_comment_count=0, issue_created_at=moment("2024-01-01T00:00:00.123456"), issue_updated_at=None,
        issue_closed_at=moment("2024-01-03T00:00:00"), issue_url="hu", **LOADED_OUT,
    )


def test_pull_request(spark):
    record = dict(
        id=1, number=2, repository="o/a", user='{"login":"eve"}', state="open", title="t", body="b", draft=True,
        created_at="2024-01-01T00:00:00Z", updated_at="2024-01-02T00:00:00Z", closed_at="2024-01-03T00:00:00Z",
        merged_at="2024-01-04T00:00:00Z", html_url="hu", diff_url="du", patch_url="pu", issue_url="iu",
        base='{"repo":{"full_name":"o/a"},"ref":"main"}', head='{"repo":null,"ref":"fix"}',
        merge_commit_sha="abc", author_association="OWNER", **LOADED,
    )
    assert staged_row(spark, "pull_requests", record) == dict(
        pr_id=1, pr_number=2, repo_name="o/a", author_login="eve", pr_state="open", pr_title="t", pr_body="b",
        is_draft=True, pr_created_at=moment("2024-01-01T00:00:00"), pr_updated_at=moment("2024-01-02T00:00:00"),
        pr_closed_at=moment("2024-01-03T00:00:00"), pr_merged_at=moment("2024-01-04T00:00:00"), pr_url="hu",
        diff_url="du", patch_url="pu", issue_url="iu", base_repo_full_name="o/a", base_ref="main",
        head_repo_full_name=None, head_ref="fix", merge_commit_sha="abc", author_association="OWNER", **LOADED_OUT,
    )


def test_repository(spark):
    record = dict(
        id=1, full_name="o/a", name="a", owner='{"login":"o","id":"12"}', html_url="hu", language="C",
        stargazers_count=5, forks_count=None, open_issues_count=6, watchers_count=None, fork=False, private=True,
        archived=False, disabled=True, visibility="public", default_branch="main",
        created_at="2024-01-01T00:00:00Z", updated_at="2024-01-02T00:00:00Z", pushed_at="2024-01-03T00:00:00Z",
        description="d", homepage="hp", **LOADED,
    )
    assert staged_row(spark, "repositories", record) == dict(
        repo_id=1, repo_full_name="o/a", repo_name="a", owner_login="o", owner_id=12, repo_url="hu", language="C",
        stargazers_count=5, forks_count=0, open_issues_count=6, watchers_count=0, is_fork=False, is_private=True,
        is_archived=False, is_disabled=True, visibility="public", default_branch="main",
        repo_created_at=moment("2024-01-01T00:00:00"), repo_updated_at=moment("2024-01-02T00:00:00"),
        repo_pushed_at=moment("2024-01-03T00:00:00"), description="d", homepage="hp", **LOADED_OUT,
    )


def test_user(spark):
    record = dict(
        id=1, login="ada", type="User", site_admin=True, html_url="hu", avatar_url="au", organization="org",
        repos_url="ru", followers_url="fu", following_url="gu", **LOADED,
    )
    assert staged_row(spark, "users", record) == dict(
        user_id=1, user_login="ada", user_type="User", is_site_admin=True, user_url="hu", avatar_url="au",
        organization="org", repos_url="ru", followers_url="fu", following_url="gu", **LOADED_OUT,
    )


def test_column_counts_and_types(spark):
    kinds = {"long": "bigint", "counter": "bigint"}
    total = 0
    for table in TABLES:
        df = staging.stage(table, raw_frame(spark, table, []))
        assert df.dtypes == [(c.name, kinds.get(c.kind, c.kind)) for c in LAYOUT[table]]
        total += len(df.columns)
    assert total == 89


def test_named_functions_stage_their_table(spark):
    for table in TABLES:
        df = getattr(staging, f"stage_{table}")(raw_frame(spark, table, []))
        assert df.columns == [c.name for c in LAYOUT[table]]


@pytest.mark.parametrize(
    "text, path, expected",
    [
        ('{"login":"ada"}', "$.login", "ada"),
        ('{"repo":{"full_name":"o/r"}}', "$.repo.full_name", "o/r"),
        ('{"repo":null}', "$.repo.full_name", None),
        ("{}", "$.login", None),
        ("null", "$.login", None),
        ("[1]", "$.login", None),
        (None, "$.login", None),
        ('{"login":null}', "$.login", None),
        ('{"id":12}', "$.id", "12"),
        ('{"id":"12"}', "$.id", "12"),
        ('{"login":"first","login":"last"}', "$.login", "last"),
    ],
)
def test_json_text(spark, text, path, expected):
    df = spark.createDataFrame([(text,)], "j string")
    assert df.selectExpr(json_text("j", path)).first()[0] == expected


@pytest.mark.parametrize(
    "table, record, column",
    [
        ("comments", {"user": "not json"}, "commenter_login"),
        ("repositories", {"owner": '{"id":"x1"}'}, "owner_id"),
        ("issues", {"created_at": "yesterday"}, "issue_created_at"),
    ],
)
def test_bad_values_raise_when_read(spark, table, record, column):
    df = staging.stage(table, raw_frame(spark, table, [record]))
    with pytest.raises(FAILED):
        df.select(column).collect()
    assert df.count() == 1
    assert df.select("_airbyte_raw_id").collect()[0][0] is None


def test_user_field_is_the_column_even_where_user_is_reserved(spark):
    spark.conf.set("spark.sql.ansi.enforceReservedKeywords", "true")
    try:
        assert staged_row(spark, "issues", {"user": '{"login":"ada"}'})["author_login"] == "ada"
    finally:
        spark.conf.set("spark.sql.ansi.enforceReservedKeywords", "false")


def test_landed_json_reads_like_typed_records(spark, tmp_path):
    (tmp_path / "pull_requests").mkdir()
    (tmp_path / "pull_requests" / "part.json").write_text(
        '{"id":5,"repository":"o/a","user":{"login":"ada","id":1},"draft":false,'
        '"created_at":"2024-01-10T08:00:00Z","merged_at":null,'
        '"base":{"ref":"main","repo":{"full_name":"o/a"}},"head":{"ref":"x","repo":null},"extra":[1]}\n'
    )
    row = staging.stage_pull_requests(read_raw(spark, str(tmp_path), "pull_requests", "json")).first()
    assert (row.pr_id, row.repo_name, row.author_login, row.is_draft) == (5, "o/a", "ada", False)
    assert (row.base_repo_full_name, row.base_ref, row.head_repo_full_name, row.head_ref) == ("o/a", "main", None, "x")
    assert row.pr_created_at == moment("2024-01-10T08:00:00") and row.pr_merged_at is None


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_objects_as_variants(spark, tmp_path, fmt):
    raw = raw_frame(
        spark,
        "pull_requests",
        [
            {"id": 1, "user": '{"login":"ada","id":1}', "base": '{"repo":{"full_name":"o/a"},"ref":"main"}'},
            {"id": 2, "user": None, "base": '{"repo":null}'},
        ],
    )
    parsed = raw.withColumns({name: F.parse_json(name) for name in ("user", "base", "head")})
    times = "timestamp" if fmt == "json" else "string"
    parsed.write.format(fmt).save(str(tmp_path / "pull_requests"))
    read = read_raw(spark, str(tmp_path), "pull_requests", fmt, times, objects="variant")
    assert dict(read.dtypes)["user"] == "variant"
    staged = staging.stage_pull_requests(read)
    assert sorted(staged.collect()) == sorted(staging.stage_pull_requests(raw).collect())
    logins = staged.select("author_login")._jdf.queryExecution().executedPlan().toString()
    assert "parseJson" not in logins
    if fmt == "parquet":
        assert "ReadSchema: struct<user:struct<0:string>>" in logins


def test_malformed_landed_json_raises(spark, tmp_path):
    (tmp_path / "users").mkdir()
    (tmp_path / "users" / "part.json").write_text('{"id":1}\n{"id":\n')
    with pytest.raises(FAILED):
        staging.stage_users(read_raw(spark, str(tmp_path), "users", "json")).collect()


@pytest.mark.parametrize("times", ["timestamp", "string"])
def test_parquet_with_typed_and_with_text_times(spark, tmp_path, times):
    raw = raw_frame(spark, "issues", [{"id": 1, "created_at": "2024-01-10T08:00:00Z"}])
    stored = raw.select(*[raw[f.name].cast(f.dataType).alias(f.name) for f in raw_schema("issues", times)])
    stored.write.parquet(str(tmp_path / "issues"))
    row = staging.stage_issues(read_raw(spark, str(tmp_path), "issues", times=times)).first()
    assert row.issue_created_at == moment("2024-01-10T08:00:00")
