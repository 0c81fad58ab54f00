"""URL filter: rules on hosts and paths, by hashed expressions.

Every URL is expanded into expressions, each a suffix of its host with a prefix of its path, of just the
lengths that rules have. Expressions meet rules by a short prefix of their hash; the full digest confirms
the match, and of all rules that fit the longest decides. All of it is SQL expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Hexadecimal digits of the hash that the join uses.
SHORT = 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Verdict, host and path of the registered rules.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
DEFAULT = "allow"


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, with A-Z in lower case, and path; both empty without `://`."""
    place = F.instr(url, "://")
    rest = F.coalesce(F.when(place > 0, F.substr(url, place + 3)), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _hashed(rules: DataFrame) -> DataFrame:
    """Rules with their digests. Of rules on the same host and path, `block` holds."""
    clean = rules.where("host is not null and path is not null and verdict is not null")
    clean = clean.withColumn("host", F.translate("host", _UPPER, _LOWER))
    rows = clean.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    digest = F.sha2(F.concat("host", "path"), 256)
    return rows.select(
        F.concat("host", "path").alias("rule"),
        F.length("host").alias("host_length"),
        F.size(F.split("host", "[.]", -1)).alias("labels"),
        F.length("path").alias("path_length"),
        "verdict",
        digest.alias("rule_digest"),
        F.substring(digest, 1, SHORT).alias("rule_short"),
    )


def judged(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """Per row of `pages`: page_id, host, path, rule, verdict.

    A rule fits its host and all subdomains where the path starts with the rule's. The longest fitting
    rule decides, of equally long ones that with the longer host; where none fits, `rule` is null and
    the verdict the default. A null URL, or one without `://`, has an empty host and path. Repeated
    rows and null ids are rows like others; other columns are ignored; rules with a null do not count.
    """
    host, path = host_and_path(F.col("url"))
    hashed = _hashed(rules)
    # The lengths that rules have, of which there are few however many rules there are.
    lengths = hashed.agg(F.collect_set("labels"), F.collect_set("path_length")).first()
    rule_labels, rule_paths = (f"array({', '.join(map(str, sorted(found)))})" for found in lengths)
    rows = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("row", F.monotonically_increasing_id())
    parts = rows.withColumn("parts", F.split("host", "[.]", -1))
    # Both lists in one expression, so that a page is one row until they are opened.
    expressions = f"""explode_outer(flatten(transform(
        filter(cast({rule_labels} as array<int>), k -> k <= size(parts)),
        k -> transform(
            filter(cast({rule_paths} as array<int>), l -> l <= length(path)),
            l -> concat(array_join(slice(parts, size(parts) - k + 1, k), '.'), substr(path, 1, l))))))"""
    expanded = parts.select("row", "page_id", "host", "path", F.expr(expressions).alias("expression"))
    expanded = expanded.withColumn("digest", F.sha2("expression", 256))
    met = expanded.join(hashed, F.substring("digest", 1, SHORT) == F.col("rule_short"), "left")
    confirmed = F.when(F.col("digest") == F.col("rule_digest"), F.struct(F.length("rule"), "host_length", "rule", "verdict"))
    best = met.groupBy("row", "page_id", "host", "path").agg(F.max(confirmed).alias("best"))
    return best.select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )


def oracle(rules: Sequence[tuple[str, str, str]] = RULES, default: str = DEFAULT) -> str:
    """DuckDB SQL for the registered query, by comparing every page with every rule."""
    values = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in rules)
    return f"""
with rules(verdict, host, path) as (values {values}),
rest as (select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as r,
                row_number() over () as n from pages),
split as (select n, page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') as host,
                 regexp_extract(r, '^[^/?#]*([^?#]*)', 1) as path from rest),
fits as (select s.n, r.host || r.path as rule, r.verdict,
                row_number() over (partition by s.n order by length(r.host || r.path) desc, length(r.host) desc) as k
         from split s join rules r on (s.host = r.host or ends_with(s.host, '.' || r.host)) and starts_with(s.path, r.path))
select s.page_id, s.host, s.path, f.rule, coalesce(f.verdict, '{default}') as verdict
from split s left join fits f on s.n = f.n and f.k = 1
"""
