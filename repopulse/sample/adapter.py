"""The supplied order tables in the shape of raw activity records.

Each raw field is an expression that Spark and DuckDB both understand, so the same text serves
the query and its check. `iso(x)` stands for a timestamp: ISO text, or the timestamp itself.
Fields that are not listed are typed NULLs. Every table is read whole. Orders play the issues and
the pull requests, line items the comments, nations or customers the repositories, customers the
users. Every row of a source table is a record.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from repopulse.sources.layout import TABLES, raw_schema

# Columns read, with the types of the files. Stated, so that opening a table starts no job.
SOURCE_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_mktsegment string",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_shipdate timestamp_ntz",
}

_NATION_OF_ORDER = "concat('NATION_', o_custkey % 30)"
_NATION_OF_ITEM = "concat('NATION_', l_suppkey % 30)"
_CUSTOMER_OF_ORDER = "concat('Customer#', lpad(cast(o_custkey as string), 9, '0'))"
_CUSTOMER_OF_ITEM = "concat('Customer#', lpad(cast(l_partkey as string), 9, '0'))"
_EXTRACTED = "iso(timestamp '2024-01-01 00:00:00')"


def _issues(repository: str) -> dict[str, str]:
    return {
        "id": "o_orderkey",
        "number": "o_orderkey % 1000",
        "repository": repository,
        "user_id": "o_custkey",
        "user": """concat('{"login":"user', o_custkey, '"}')""",
        "state": "case when o_orderstatus = 'F' then 'closed' else 'open' end",
        "comments": "case when o_orderkey % 7 = 0 then null else o_orderkey % 5 end",
        "created_at": "iso(o_orderdate)",
        "closed_at": "case when o_orderstatus = 'F' then iso(o_orderdate + interval 5 days) end",
        "_airbyte_extracted_at": _EXTRACTED,
        "_airbyte_raw_id": "concat('i', o_orderkey)",
    }


def _pull_requests(repository: str) -> dict[str, str]:
    return {
        "id": "o_orderkey",
        "number": "o_orderkey % 1000",
        "repository": repository,
        "user": """concat('{"login":"user', o_custkey, '"}')""",
        "draft": "o_orderkey % 2 = 0",
        "created_at": "iso(o_orderdate)",
        "merged_at": "case when o_orderstatus = 'F' then iso(o_orderdate + interval 3 days) end",
        "base": f"""concat('{{"repo":{{"full_name":"', {repository}, '"}},"ref":"main"}}')""",
        "head": """case when o_orderkey % 11 = 0 then '{"repo":null,"ref":"fix"}'
            else concat('{"repo":{"full_name":"fork', o_custkey, '"},"ref":"fix"}') end""",
        "_airbyte_extracted_at": _EXTRACTED,
        "_airbyte_raw_id": "concat('p', o_orderkey)",
    }


def _comments(repository: str) -> dict[str, str]:
    return {
        "id": "l_orderkey * 10 + l_linenumber",
        "repository": repository,
        "user_id": "l_partkey",
        "user": """concat('{"login":"user', l_partkey, '"}')""",
        "created_at": "iso(l_shipdate)",
        "_airbyte_extracted_at": _EXTRACTED,
        "_airbyte_raw_id": "concat('c', l_orderkey, '-', l_linenumber)",
    }


_NATION_REPOSITORIES = {
    "id": "n_nationkey",
    "full_name": "n_name",
    "name": "n_name",
    "owner": """concat('{"login":"region', n_regionkey, '","id":"', n_regionkey, '"}')""",
    "stargazers_count": "case when n_nationkey % 5 = 0 then null else n_nationkey * 10 end",
    "created_at": "iso(timestamp '2020-01-01 00:00:00')",
    "_airbyte_extracted_at": _EXTRACTED,
    "_airbyte_raw_id": "concat('r', n_nationkey)",
}
_CUSTOMER_REPOSITORIES = {
    "id": "c_custkey",
    "full_name": "c_name",
    "name": "concat('customer', c_custkey)",
    "owner": """concat('{"login":"nation', c_nationkey, '","id":', c_nationkey, '}')""",
    "language": "c_mktsegment",
    "stargazers_count": "case when c_custkey % 5 = 0 then null else c_custkey * 10 end",
    "forks_count": "c_custkey % 13",
    "fork": "c_custkey % 2 = 0",
    "created_at": "iso(timestamp '2020-01-01 00:00:00')",
    "_airbyte_extracted_at": _EXTRACTED,
    "_airbyte_raw_id": "concat('r', c_custkey)",
}
_USERS = {
    "id": "c_custkey",
    "login": "concat('user', c_custkey)",
    "type": "'User'",
    "site_admin": "c_custkey % 100 = 0",
    "_airbyte_extracted_at": _EXTRACTED,
    "_airbyte_raw_id": "concat('u', c_custkey)",
}

# view: (raw table, source table, fields)
FEW = {
    "comments": ("comments", "lineitem", _comments(_NATION_OF_ITEM)),
    "issues": ("issues", "orders", _issues(_NATION_OF_ORDER)),
    "pull_requests": ("pull_requests", "orders", _pull_requests(_NATION_OF_ORDER)),
    "repositories": ("repositories", "nation", _NATION_REPOSITORIES),
    "users": ("users", "customer", _USERS),
}
# The same records with a repository per customer, so that the number of keys grows with the data.
MANY = {
    "comments": ("comments", "lineitem", _comments(_CUSTOMER_OF_ITEM)),
    "issues": ("issues", "orders", _issues(_CUSTOMER_OF_ORDER)),
    "pull_requests": ("pull_requests", "orders", _pull_requests(_CUSTOMER_OF_ORDER)),
    "repositories": ("repositories", "customer", _CUSTOMER_REPOSITORIES),
    "users": FEW["users"],
}
# The same records with holes and copies: some without repository or time, one repository without
# a name, three listed twice and two whose name belongs to two repositories.
GAPS = {
    "comments": (
        "comments",
        "lineitem",
        {
            **_comments(f"case when l_orderkey % 10 > 0 then {_NATION_OF_ITEM} end"),
            "created_at": "case when l_orderkey % 11 > 0 then iso(l_shipdate) end",
        },
    ),
    "issues": (
        "issues",
        "orders",
        {
            **_issues(f"case when o_orderkey % 10 > 0 then {_NATION_OF_ORDER} end"),
            "created_at": "case when o_orderkey % 11 > 0 then iso(o_orderdate) end",
        },
    ),
    "pull_requests": (
        "pull_requests",
        "orders",
        {
            **_pull_requests(f"case when o_orderkey % 13 > 0 then {_NATION_OF_ORDER} end"),
            "created_at": "case when o_orderkey % 17 > 0 then iso(o_orderdate) end",
        },
    ),
    "repositories": (
        "repositories",
        "nation",
        {
            **_NATION_REPOSITORIES,
            "id": "case when n_nationkey < 23 then n_nationkey % 20 else n_nationkey end",
            "full_name": "case when n_nationkey <> 7 then concat('NATION_', n_nationkey % 20) end",
        },
    ),
    "users": FEW["users"],
}
# The same records with a value in every raw field, for the staging projections.
FULL = {
    "comments": (
        "comments",
        "lineitem",
        {
            **FEW["comments"][2],
            "updated_at": "iso(l_shipdate + interval 1 hour)",
            "html_url": "concat('https://host.example/comments/', l_orderkey, '/', l_linenumber)",
            "issue_url": "concat('https://host.example/issues/', l_orderkey)",
            "body": "concat('Item ', l_linenumber, ' of \"order\" ', l_orderkey)",
            "author_association": "case when l_partkey % 3 = 0 then 'MEMBER' else 'NONE' end",
        },
    ),
    "issues": (
        "issues",
        "orders",
        {
            **FEW["issues"][2],
            "repository_url": f"concat('https://host.example/repos/', {_NATION_OF_ORDER})",
            "state_reason": "case when o_orderstatus = 'F' then 'completed' end",
            "title": "concat('Order ', o_orderkey)",
            "body": "concat('Priority ', o_orderpriority)",
            "updated_at": "iso(o_orderdate + interval 90 minutes)",
            "html_url": "concat('https://host.example/issues/', o_orderkey)",
        },
    ),
    "pull_requests": (
        "pull_requests",
        "orders",
        {
            **FEW["pull_requests"][2],
            "state": "case when o_orderstatus = 'O' then 'open' else 'closed' end",
            "title": "concat('Order ', o_orderkey)",
            "body": "case when o_orderkey % 4 > 0 then concat('Priority ', o_orderpriority) end",
            "updated_at": "iso(o_orderdate + interval 90 minutes)",
            "closed_at": "case when o_orderstatus <> 'O' then iso(o_orderdate + interval 4 days) end",
            "html_url": "concat('https://host.example/pulls/', o_orderkey)",
            "diff_url": "concat('https://host.example/pulls/', o_orderkey, '.diff')",
            "patch_url": "concat('https://host.example/pulls/', o_orderkey, '.patch')",
            "issue_url": "concat('https://host.example/issues/', o_orderkey)",
            "merge_commit_sha": "case when o_orderstatus = 'F' then md5(cast(o_orderkey as string)) end",
            "author_association": "case when o_custkey % 3 = 0 then 'MEMBER' else 'NONE' end",
        },
    ),
    "repositories": (
        "repositories",
        "customer",
        {
            **_CUSTOMER_REPOSITORIES,
            "html_url": "concat('https://host.example/', c_name)",
            "open_issues_count": "case when c_custkey % 6 > 0 then c_custkey % 17 end",
            "watchers_count": "c_custkey % 19",
            "private": "c_custkey % 3 = 0",
            "archived": "c_custkey % 4 = 0",
            "disabled": "c_custkey % 5 = 0",
            "visibility": "case when c_custkey % 3 = 0 then 'private' else 'public' end",
            "default_branch": "'main'",
            "updated_at": "iso(timestamp '2021-02-03 04:05:06')",
            "pushed_at": "case when c_custkey % 4 > 0 then iso(timestamp '2022-03-04 05:06:07') end",
            "description": "concat('In the segment ', c_mktsegment)",
            "homepage": "concat('https://host.example/', c_custkey)",
        },
    ),
    "users": (
        "users",
        "customer",
        {
            **_USERS,
            "html_url": "concat('https://host.example/user', c_custkey)",
            "avatar_url": "concat('https://host.example/avatars/', c_custkey)",
            "organization": "c_mktsegment",
            "repos_url": "concat('https://host.example/user', c_custkey, '/repos')",
            "followers_url": "concat('https://host.example/user', c_custkey, '/followers')",
            "following_url": "concat('https://host.example/user', c_custkey, '/following')",
        },
    ),
}
# Pull requests whose time to the merge differs from one to the next.
TIMED_PULL_REQUESTS = (
    "pull_requests",
    "orders",
    {
        **_pull_requests(_NATION_OF_ORDER),
        "merged_at": "case when o_orderstatus = 'F' then"
        " iso(o_orderdate + cast(floor(o_totalprice) as int) * interval 1 second) end",
    },
)

# The same with the holes of `GAPS`.
TIMED_GAPS = (
    "pull_requests",
    "orders",
    {**GAPS["pull_requests"][2], "merged_at": TIMED_PULL_REQUESTS[2]["merged_at"]},
)
# Measures that a daily table must not have: a row per order, some below zero, some with more merged
# than created pull requests.
BAD_MEASURES = {
    "issues_created": "o_orderkey % 7 - 1",
    "prs_created": "o_custkey % 5",
    "prs_merged": "o_orderkey % 6",
    "comments_created": "o_custkey % 11 - 2",
}

# The records whose landed lines are cut off.
SPOILT = "id % 97 = 5"

_ISO = re.compile(r"iso\(((?:[^()]|\((?:[^()]|\([^()]*\))*\))*)\)")


def field_expressions(view: tuple, iso: str) -> dict[str, str]:
    """SQL text per raw field; `iso` is a template for timestamps with `{}` for the value."""
    _, _, fields = view
    return {name: _ISO.sub(lambda m: iso.format(m.group(1)), text) for name, text in fields.items()}


def raw_view(spark: SparkSession, sf_dir: str, view: tuple, times: str = "timestamp") -> DataFrame:
    """A raw-shaped table. With `times="string"` timestamps are ISO text, as in landed JSON."""
    table, source, _ = view
    iso = "date_format({}, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")" if times == "string" else "cast({} as timestamp)"
    expressions = field_expressions(view, iso)
    df = spark.read.schema(SOURCE_SCHEMAS[source]).parquet(f"{sf_dir}/{source}.parquet")
    return df.selectExpr(
        *[
            f"cast({expressions.get(field.name, 'null')} as {field.dataType.simpleString()}) as `{field.name}`"
            for field in raw_schema(table, times)
        ]
    )


def bad_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.schema(SOURCE_SCHEMAS["orders"]).parquet(f"{sf_dir}/orders.parquet")
    return orders.selectExpr(*[f"{value} as {name}" for name, value in BAD_MEASURES.items()])


def raw_tables(
    spark: SparkSession, sf_dir: str, views: dict = FEW, names: Sequence[str] = TABLES
) -> dict[str, DataFrame]:
    return {name: raw_view(spark, sf_dir, views[name]) for name in names}
