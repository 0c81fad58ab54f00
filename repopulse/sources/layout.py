"""The five raw tables and the staged columns read from them.

One table per record kind lists the staged columns. The raw schema follows from the same list:
nothing is known of a raw table but the fields that staging reads.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql.types import StructType


class Staged(NamedTuple):
    name: str
    field: str
    kind: str  # long, string, boolean, timestamp, or counter (a long, NULL counts as 0)
    path: str | None = None  # where the field is a JSON object


_LOADED = (
    Staged("_airbyte_extracted_at", "_airbyte_extracted_at", "timestamp"),
    Staged("_airbyte_raw_id", "_airbyte_raw_id", "string"),
)

# Staged column, raw field, type, and the JSON path if the field is an object.
COMMENTS = (
    Staged("comment_id", "id", "long"),
    Staged("repo_name", "repository", "string"),
    Staged("commenter_user_id", "user_id", "long"),
    Staged("commenter_login", "user", "string", "$.login"),
    Staged("comment_created_at", "created_at", "timestamp"),
    Staged("comment_updated_at", "updated_at", "timestamp"),
    Staged("comment_url", "html_url", "string"),
    Staged("issue_url", "issue_url", "string"),
    Staged("comment_body", "body", "string"),
    Staged("author_association", "author_association", "string"),
    *_LOADED,
)
ISSUES = (
    Staged("issue_id", "id", "long"),
    Staged("issue_number", "number", "long"),
    Staged("repo_name", "repository", "string"),
    Staged("repository_url", "repository_url", "string"),
    Staged("author_user_id", "user_id", "long"),
    Staged("author_login", "user", "string", "$.login"),
    Staged("issue_state", "state", "string"),
    Staged("issue_state_reason", "state_reason", "string"),
    Staged("issue_title", "title", "string"),
    Staged("issue_body", "body", "string"),
    Staged("issue_comment_count", "comments", "counter"),
    Staged("issue_created_at", "created_at", "timestamp"),
    Staged("issue_updated_at", "updated_at", "timestamp"),
    Staged("issue_closed_at", "closed_at", "timestamp"),
    Staged("issue_url", "html_url", "string"),
    *_LOADED,
)
PULL_REQUESTS = (
    Staged("pr_id", "id", "long"),
    Staged("pr_number", "number", "long"),
    Staged("repo_name", "repository", "string"),
    Staged("author_login", "user", "string", "$.login"),
    Staged("pr_state", "state", "string"),
    Staged("pr_title", "title", "string"),
    Staged("pr_body", "body", "string"),
    Staged("is_draft", "draft", "boolean"),
    Staged("pr_created_at", "created_at", "timestamp"),
    Staged("pr_updated_at", "updated_at", "timestamp"),
    Staged("pr_closed_at", "closed_at", "timestamp"),
    Staged("pr_merged_at", "merged_at", "timestamp"),
    Staged("pr_url", "html_url", "string"),
    Staged("diff_url", "diff_url", "string"),
    Staged("patch_url", "patch_url", "string"),
    Staged("issue_url", "issue_url", "string"),
    Staged("base_repo_full_name", "base", "string", "$.repo.full_name"),
    Staged("base_ref", "base", "string", "$.ref"),
    Staged("head_repo_full_name", "head", "string", "$.repo.full_name"),
    Staged("head_ref", "head", "string", "$.ref"),
    Staged("merge_commit_sha", "merge_commit_sha", "string"),
    Staged("author_association", "author_association", "string"),
    *_LOADED,
)
REPOSITORIES = (
    Staged("repo_id", "id", "long"),
    Staged("repo_full_name", "full_name", "string"),
    Staged("repo_name", "name", "string"),
    Staged("owner_login", "owner", "string", "$.login"),
    Staged("owner_id", "owner", "long", "$.id"),
    Staged("repo_url", "html_url", "string"),
    Staged("language", "language", "string"),
    Staged("stargazers_count", "stargazers_count", "counter"),
    Staged("forks_count", "forks_count", "counter"),
    Staged("open_issues_count", "open_issues_count", "counter"),
    Staged("watchers_count", "watchers_count", "counter"),
    Staged("is_fork", "fork", "boolean"),
    Staged("is_private", "private", "boolean"),
    Staged("is_archived", "archived", "boolean"),
    Staged("is_disabled", "disabled", "boolean"),
    Staged("visibility", "visibility", "string"),
    Staged("default_branch", "default_branch", "string"),
    Staged("repo_created_at", "created_at", "timestamp"),
    Staged("repo_updated_at", "updated_at", "timestamp"),
    Staged("repo_pushed_at", "pushed_at", "timestamp"),
    Staged("description", "description", "string"),
    Staged("homepage", "homepage", "string"),
    *_LOADED,
)
USERS = (
    Staged("user_id", "id", "long"),
    Staged("user_login", "login", "string"),
    Staged("user_type", "type", "string"),
    Staged("is_site_admin", "site_admin", "boolean"),
    Staged("user_url", "html_url", "string"),
    Staged("avatar_url", "avatar_url", "string"),
    Staged("organization", "organization", "string"),
    Staged("repos_url", "repos_url", "string"),
    Staged("followers_url", "followers_url", "string"),
    Staged("following_url", "following_url", "string"),
    *_LOADED,
)

LAYOUT = {
    "comments": COMMENTS,
    "issues": ISSUES,
    "pull_requests": PULL_REQUESTS,
    "repositories": REPOSITORIES,
    "users": USERS,
}
TABLES = tuple(LAYOUT)


def raw_type(column: Staged, times: str, objects: str) -> str:
    """Type of the raw field behind a staged column."""
    if column.path:
        return objects
    return {"counter": "long", "timestamp": times}.get(column.kind, column.kind)


def raw_schema(table: str, times: str = "timestamp", objects: str = "string") -> StructType:
    """Raw schema of a table. `times="string"` is for files that hold timestamps as ISO text,
    `objects="variant"` for files that hold JSON objects as variants instead of text."""
    fields = {column.field: raw_type(column, times, objects) for column in LAYOUT[table]}
    schema = StructType()
    for name, kind in fields.items():
        schema.add(name, kind)
    return schema
