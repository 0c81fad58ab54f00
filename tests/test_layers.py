import re
import threading

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from repopulse import run, sinks
from repopulse.operators.staging import stage_all
from repopulse.plans import layers
from repopulse.plans.refresh import refresh
from repopulse.sources.layout import TABLES, raw_schema
from tests.records import DAILY, golden_raw, tuples, unordered


@pytest.fixture
def names(spark):
    yield {"raw": "t_raw", "staging": "t_staging", "mart": "t_mart"}
    for layer in ("t_mart", "t_staging", "t_raw"):
        sinks.drop_layer(spark, layer)


def land(raw, root, fmt, objects="string"):
    for table, df in raw.items():
        times = "string" if fmt == "json" else "timestamp"
        fields = [(f.name, f.dataType.simpleString()) for f in raw_schema(table, times, objects)]
        typed = df.selectExpr(*[
            f"parse_json(`{name}`) as `{name}`" if kind == "variant" else f"cast(`{name}` as {kind}) as `{name}`"
            for name, kind in fields
        ])
        typed.write.format(fmt).save(f"{root}/{table}")


@pytest.mark.parametrize("fmt, objects", [("parquet", "string"), ("parquet", "variant"), ("json", "string")])
def test_views_over_landed_files(spark, tmp_path, names, fmt, objects):
    raw = golden_raw(spark)
    raw["issues"] = raw["issues"].withColumn("user", F.lit('{"login":"ada"}'))
    land(raw, tmp_path, fmt, objects)
    layers.register_raw(spark, str(tmp_path), names["raw"], fmt, objects=objects)
    layers.create_staging_views(spark, names["staging"], names["raw"])
    staged = stage_all(raw)
    for table in TABLES:
        view = spark.table(f"{names['staging']}.{table}")
        assert view.dtypes == staged[table].dtypes
        assert unordered(tuples(view)) == unordered(tuples(staged[table]))
    done = refresh(spark, layers.raw_frames(spark, names["raw"]), "2024-01-31", names["mart"])
    assert unordered(tuples(done.daily)) == unordered(DAILY)


def test_relations_under_longer_names(spark, tmp_path, names):
    raw = golden_raw(spark)
    land(raw, tmp_path, "parquet")
    layers.register_raw(spark, str(tmp_path), names["raw"], prefix="gh_")
    layers.create_staging_views(spark, names["staging"], names["raw"], prefix="stg_gh_", raw_prefix="gh_")
    assert spark.table(f"{names['staging']}.stg_gh_issues").count() == 6
    refresh(spark, layers.raw_frames(spark, names["raw"], "gh_"), "2024-01-31", names["mart"], prefix="mart_")
    top = spark.sql(
        f"SELECT repo_full_name, sum(prs_created) FROM {names['mart']}.mart_repo_daily_activity"
        " WHERE repo_full_name IS NOT NULL GROUP BY 1 ORDER BY 2 DESC LIMIT 1"
    )
    assert tuples(top) == [("o/a", 3)]
    assert spark.table(f"{names['mart']}.mart_repo_current_stats").count() == 3


def test_command_line(spark, tmp_path, names, capsys):
    land(golden_raw(spark), tmp_path, "parquet")
    options = f"--raw {tmp_path} --as-of 2024-01-31 --layer {names['mart']} --keep 1 --shuffle-gb 1"
    run.main(options.split())
    printed = capsys.readouterr().out
    assert re.match(r"published run \d{20}_20240131_", printed) and "warn orphans issues.repo_full_name: 1" in printed
    assert unordered(tuples(spark.table(f"{names['mart']}.repo_daily_activity"))) == unordered(DAILY)


def test_registering_again_reads_the_new_folder_format_and_types(spark, tmp_path, names):
    raw = golden_raw(spark)
    land(raw, tmp_path / "a 'quoted' place", "parquet")
    few = {name: df.limit(1) for name, df in raw.items()}
    land(few, tmp_path / "b", "json")
    layers.register_raw(spark, str(tmp_path / "a 'quoted' place"), names["raw"])
    assert spark.table(f"{names['raw']}.issues").count() == raw["issues"].count()
    layers.register_raw(spark, str(tmp_path / "b"), names["raw"], "json", objects="variant")
    assert spark.table(f"{names['raw']}.issues").count() == 1
    assert dict(spark.table(f"{names['raw']}.issues").dtypes)["user"] == "variant"


def test_a_stored_table_is_not_replaced_by_a_raw_one(spark, tmp_path, names):
    land(golden_raw(spark), tmp_path, "parquet")
    sinks.ensure_layer(spark, names["raw"])
    spark.range(3).write.saveAsTable(f"{names['raw']}.issues")
    with pytest.raises(ValueError, match="not a raw table"):
        layers.register_raw(spark, str(tmp_path), names["raw"])
    assert spark.table(f"{names['raw']}.issues").count() == 3


def test_a_definition_that_fails_leaves_all_names_as_they_were(spark, tmp_path, names, monkeypatch):
    raw = golden_raw(spark)
    land(raw, tmp_path / "a", "parquet")
    layers.register_raw(spark, str(tmp_path / "a"), names["raw"])
    before = {r.tableName for r in spark.sql(f"SHOW TABLES IN {names['raw']}").collect()}
    whole = layers.raw_schema

    def broken(table, *more):
        if table == "repositories":
            raise RuntimeError("lost")
        return whole(table, *more)

    monkeypatch.setattr(layers, "raw_schema", broken)
    with pytest.raises(RuntimeError):
        layers.register_raw(spark, str(tmp_path / "b"), names["raw"])
    assert {r.tableName for r in spark.sql(f"SHOW TABLES IN {names['raw']}").collect()} == before
    assert spark.table(f"{names['raw']}.comments").count() == raw["comments"].count()


def test_a_reader_finds_a_raw_table_at_any_time(spark, tmp_path, names):
    raw = golden_raw(spark)
    land(raw, tmp_path / "a", "parquet")
    land({name: df.limit(1) for name, df in raw.items()}, tmp_path / "b", "parquet")
    layers.register_raw(spark, str(tmp_path / "a"), names["raw"], tables=["issues"])
    ended, swaps = threading.Event(), []

    def swap():
        while not ended.is_set():
            layers.register_raw(spark, str(tmp_path / "ba"[len(swaps) % 2]), names["raw"], tables=["issues"])
            swaps.append(1)

    writer = threading.Thread(target=swap)
    writer.start()
    try:
        seen = set()
        while len(seen) < 2 or len(swaps) < 20:
            try:
                seen.add(spark.table(f"{names['raw']}.issues").count())
            except AnalysisException as lost:
                # Between the name and the table behind it; never the name itself.
                assert "issues__" in str(lost)
    finally:
        ended.set()
        writer.join()
    assert seen == {1, raw["issues"].count()}


def test_the_same_definition_changes_nothing(spark, tmp_path, names):
    land(golden_raw(spark), tmp_path, "parquet")
    layers.register_raw(spark, str(tmp_path), names["raw"])
    before = sorted(r.tableName for r in spark.sql(f"SHOW TABLES IN {names['raw']}").collect())
    layers.register_raw(spark, str(tmp_path), names["raw"])
    assert sorted(r.tableName for r in spark.sql(f"SHOW TABLES IN {names['raw']}").collect()) == before
    assert len(before) == 2 * len(TABLES)


def test_somebody_elses_view_or_files_are_not_replaced(spark, tmp_path, names):
    land(golden_raw(spark), tmp_path, "parquet")
    sinks.ensure_layer(spark, names["raw"])
    spark.sql(f"CREATE VIEW {names['raw']}.users AS SELECT 1 AS one")
    with pytest.raises(ValueError, match="VIEW, not a raw table"):
        layers.register_raw(spark, str(tmp_path), names["raw"])
    spark.sql(f"DROP VIEW {names['raw']}.users")
    spark.sql(f"CREATE TABLE {names['raw']}.users (id LONG) USING parquet LOCATION '{tmp_path}/users'")
    with pytest.raises(ValueError, match="EXTERNAL, not a raw table"):
        layers.register_raw(spark, str(tmp_path), names["raw"])
    assert [r.tableName for r in spark.sql(f"SHOW TABLES IN {names['raw']}").collect()] == ["users"]


def test_refresh_makes_the_staging_views(spark, tmp_path, names):
    land(golden_raw(spark), tmp_path, "parquet")
    options = f"--raw {tmp_path} --as-of 2024-01-31 --layer {names['mart']} --shuffle-gb 1"
    run.main(f"{options} --staging {names['staging']} --raw-layer {names['raw']}".split())
    found = {r.tableName for r in spark.sql(f"SHOW TABLES IN {names['staging']}").collect()}
    assert found == set(TABLES)
