import json
import re

import pytest

import __spark_entry__ as entry
from repopulse import run, sinks
from repopulse.operators.checks import ChecksFailed
from repopulse.plans import layers
from repopulse.sources import landing
from repopulse.sources.layout import TABLES
from tests.records import DAILY, golden_raw, tuples, unordered


def line(number, **more):
    return json.dumps({"id": number, "repository": "o/a", "created_at": "2024-01-10T00:00:00Z", **more})


def put(folder, table, *files):
    (folder / table).mkdir(parents=True)
    for k, lines in enumerate(files):
        (folder / table / f"part-{k}.json").write_text("\n".join(lines) + "\n")


BAD = ['{"id": 3, "repository": "o', '{"id": "three"}', "no record", '{"id": 4, "created_at": "yesterday"}']


def test_a_bad_line_is_counted_and_put_aside(spark, tmp_path):
    put(tmp_path / "in", "issues", [line(1), BAD[0], line(2)], [line(5, user={"login": "ada"}, unknown=[1])])
    landed = landing.land(spark, str(tmp_path / "in"), str(tmp_path / "out"), ["issues"])
    assert [tuple(r) for r in landed.checks] == [("unreadable_records", "issues", "record", "warn", 1)]
    rows = {r.id: r for r in landed.raw["issues"].collect()}
    assert sorted(rows) == [1, 2, 5] and json.loads(rows[5].user) == {"login": "ada"}
    (aside,) = landed.quarantine.collect()
    assert (aside.relation, aside.record) == ("issues", BAD[0]) and aside.source_file.endswith("part-0.json")


def test_every_kind_of_bad_line(spark, tmp_path):
    put(tmp_path / "in", "issues", [line(1), *BAD, "", line(2)])
    landed = landing.land(spark, str(tmp_path / "in"), str(tmp_path / "out"), ["issues"])
    assert sorted(r.record for r in landed.quarantine.collect()) == sorted(BAD)
    assert sorted(r.id for r in landed.raw["issues"].collect()) == [1, 2]
    assert landed.checks[0].failures == len(BAD)
    # What is bad does not depend on the columns that are read.
    assert landed.raw["issues"].select("repository").count() == 2


def test_only_the_asked_part_is_read(spark, tmp_path):
    put(tmp_path / "in", "issues", [line(1), BAD[0]])
    landed = landing.land(spark, str(tmp_path / "in"), str(tmp_path / "out"), ["issues"])
    for df, other in ((landed.raw["issues"], "true"), (landed.quarantine, "false")):
        assert not any(f"quarantined={other}" in f for f in df.inputFiles()) or "PartitionFilters: [" in str(
            df._jdf.queryExecution().executedPlan()
        )


def test_files_without_any_or_with_only_bad_lines(spark, tmp_path):
    put(tmp_path / "in", "issues", [])
    put(tmp_path / "in", "users", BAD[:1] + BAD[2:3])
    put(tmp_path / "in", "comments", [line(1)])
    landed = landing.land(spark, str(tmp_path / "in"), str(tmp_path / "out"), ["issues", "users", "comments"])
    assert [r.failures for r in landed.checks] == [0, 2, 0]
    assert {name: df.count() for name, df in landed.raw.items()} == {"issues": 0, "users": 0, "comments": 1}
    assert landed.quarantine.count() == 2


def test_variants_and_errors(spark, tmp_path):
    put(tmp_path / "in", "issues", [line(1, user={"login": "ada"}), BAD[0]])
    with pytest.raises(ChecksFailed, match="unreadable_records issues.record: 1"):
        landing.land(spark, str(tmp_path / "in"), str(tmp_path / "a"), ["issues"], objects="variant", severity="error")
    assert landing.read_quarantine(spark, str(tmp_path / "a"), ["issues"], objects="variant").count() == 1
    rows = landing.read_landed(spark, str(tmp_path / "a"), "issues", objects="variant")
    assert rows.selectExpr("variant_get(user, '$.login', 'string')").first()[0] == "ada"


def test_command_line_with_bad_lines(spark, tmp_path, capsys):
    for table, df in golden_raw(spark).items():
        df.write.json(str(tmp_path / "in" / table))
    (tmp_path / "in" / "issues" / "part-more.json").write_text(BAD[0] + "\n")
    options = f"--raw {tmp_path}/in --format json --landing {tmp_path}/out --as-of 2024-01-31 --layer l_mart --shuffle-gb 1"
    try:
        run.main(f"{options} --staging l_staging --raw-layer l_raw".split())
        assert re.search(r"warn unreadable_records issues.record: 1", capsys.readouterr().out)
        assert unordered(tuples(spark.table("l_mart.repo_daily_activity"))) == unordered(DAILY)
        assert {r.tableName for r in spark.sql("SHOW TABLES IN l_staging").collect()} == set(TABLES)
        assert spark.table("l_staging.issues").count() == 6
        assert layers.raw_frames(spark, "l_raw")["issues"].count() == 6
    finally:
        for layer in ("l_mart", "l_staging", "l_raw"):
            sinks.drop_layer(spark, layer)
    with pytest.raises(SystemExit):
        run.main(f"--raw {tmp_path}/in --landing {tmp_path}/other".split())


@pytest.fixture
def items(spark, tmp_path, monkeypatch):
    """A folder with line items, and the folders of the queries inside it."""
    monkeypatch.setattr(entry, "_folder", lambda spark, name: str(tmp_path / name))
    columns = ["id as l_orderkey", "id % 7 as l_partkey", "id % 5 as l_suppkey", "1 as l_linenumber"]
    rows = spark.range(200).selectExpr(*columns, "timestamp_ntz '1995-01-02 03:04:05' as l_shipdate")
    rows.coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    return tmp_path


def test_landed_json_is_packed_in_files_of_bounded_length(spark, items, monkeypatch):
    monkeypatch.setitem(entry.PACKED_LINES, "maxRecordsPerFile", 60)
    found = entry._landed_json("comments")(spark, str(items))
    files = sorted(p.name for p in (items / "json-comments" / "comments").glob("part-*"))
    assert len(files) == 4 and all(name.endswith(".json.gz") for name in files)
    assert sorted(found.select("comment_id").collect()) == [(10 * k + 1,) for k in range(200)]
    assert {r.commenter_login for r in found.collect()} == {f"user{k}" for k in range(7)}


def test_lines_are_packed_and_land_without_a_sort(spark, items, monkeypatch):
    monkeypatch.setitem(entry.PACKED_LINES, "maxRecordsPerFile", 60)
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    with landing._both_parts_open(spark):
        assert spark.conf.get(name) == "2"
    landed = entry._landed(spark, str(items), "comments")
    files = sorted(p.name for p in (items / "lines" / "comments").glob("part-*"))
    assert len(files) == 4 and all(f.endswith(".txt.gz") for f in files)
    assert spark.conf.get(name) == before
    spoilt = [k for k in range(200) if (10 * k + 1) % 97 == 5]
    assert landed.checks[0].failures == landed.quarantine.count() == len(spoilt) > 0
    assert sorted(r.id for r in landed.raw["comments"].collect()) == [10 * k + 1 for k in range(200) if k not in spoilt]
