import datetime
import pathlib
import re
import statistics
import threading

import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from repopulse import sinks
from repopulse.operators import checks
from repopulse.operators.activity import MEASURES
from repopulse.operators.checks import ChecksFailed
from repopulse.plans import marts
from repopulse.plans.refresh import DAILY, STATS, count, daily_order, refresh
from repopulse.session import scratch_dir, shuffle_partitions
from tests.records import DAILY as DAILY_ROWS
from tests.records import REPOSITORIES, golden_raw, golden_staged, tuples, unordered


@pytest.fixture
def layer(spark, request):
    name = f"mart_{request.node.name.split('[')[0]}"
    yield name
    sinks.drop_layer(spark, name)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def work_layers(spark):
    return [d.name for d in spark.catalog.listDatabases("repopulse_work_*")]


def test_refresh_publishes_both_marts(spark, layer):
    done = refresh(spark, golden_raw(spark), "2024-01-31", layer)
    assert unordered(tuples(done.daily)) == unordered(DAILY_ROWS)
    assert unordered(tuples(spark.table(f"{layer}.{DAILY}"))) == unordered(DAILY_ROWS)
    stats = {r.repo_full_name: tuple(r)[8:] for r in spark.table(f"{layer}.{STATS}").collect()}
    assert stats == {"o/a": (2, 2, 1, 2), "o/b": (0, 1, 1, 1), "o/c": (0, 0, 0, 0)}
    found = {(c.check, c.key): c.failures for c in done.checks}
    assert sum(c.failures for c in done.checks if (c.check, c.key) == ("null_keys", "repo_full_name")) == 1
    assert sum(c.failures for c in done.checks if (c.check, c.key) == ("null_keys", "day")) == 1
    assert {c.relation for c in done.checks if c.check == "null_keys"} == {"issues", "pull_requests", "comments"}
    assert sum(c.failures for c in done.checks if c.check == "orphans") == 1
    assert found["duplicate_keys", "repo_full_name,day"] == 0
    assert len(done.checks) == 3 * 3 + 1 + 1 + 5
    assert work_layers(spark) == []


def test_second_refresh_replaces_the_first(spark, layer):
    first = refresh(spark, golden_raw(spark), "2024-01-31", layer)
    raw = golden_raw(spark)
    raw["comments"] = raw["comments"].limit(0)
    second = refresh(spark, raw, datetime.date(2024, 1, 31), layer)
    assert first.run < second.run
    assert sum(r.comments_created for r in spark.table(f"{layer}.{DAILY}").collect()) == 0
    assert sinks.runs(spark, DAILY, layer) == [first.run, second.run]
    refresh(spark, raw, "2024-01-31", layer, keep=1, hold=sinks.NO_HOLD)
    assert len(sinks.runs(spark, DAILY, layer)) == len(sinks.runs(spark, STATS, layer)) == 1
    assert spark.table(f"{layer}.{DAILY}").count() > 0


def test_failed_gate_leaves_the_old_marts(spark, layer):
    first = refresh(spark, golden_raw(spark), "2024-01-31", layer)
    with pytest.raises(ChecksFailed, match="duplicate_keys repositories.repo_full_name: 1"):
        refresh(spark, golden_raw(spark, REPOSITORIES + REPOSITORIES[:1]), "2024-01-31", layer)
    assert sinks.runs(spark, DAILY, layer) == [first.run]
    assert unordered(tuples(spark.table(f"{layer}.{DAILY}"))) == unordered(DAILY_ROWS)
    assert work_layers(spark) == []


def test_checks_that_are_not_enforced_let_the_copies_multiply(spark, layer):
    raw = golden_raw(spark, REPOSITORIES + REPOSITORIES[:1])
    done = refresh(spark, raw, "2024-01-31", layer, enforce=False)
    assert done.daily.count() == 14
    assert {(c.relation, c.failures) for c in done.checks if c.check == "duplicate_keys"} == {
        ("repositories", 1),
        (DAILY, 5 - 1),
    }


def test_published_marts_carry_comments(spark, layer):
    refresh(spark, golden_raw(spark), "2024-01-31", layer)
    described = {r.col_name: r.comment for r in spark.sql(f"DESCRIBE {layer}.{DAILY}").collect()}
    assert "merged at any time since" in described["prs_merged"]
    assert "per repository and day" in spark.catalog.getTable(f"{layer}.{DAILY}").description


def test_failure_while_building_drops_the_new_runs(spark, layer, monkeypatch):
    first = refresh(spark, golden_raw(spark), "2024-01-31", layer)

    def broken(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr("repopulse.plans.refresh.repo_current_stats_from_counts", broken)
    with pytest.raises(RuntimeError):
        refresh(spark, golden_raw(spark), "2024-01-31", layer)
    assert sinks.runs(spark, DAILY, layer) == [first.run]
    assert unordered(tuples(spark.table(f"{layer}.{DAILY}"))) == unordered(DAILY_ROWS)


@pytest.mark.parametrize("step", ["point_to", "_shown"])
def test_failed_publish_leaves_both_old_marts(spark, layer, monkeypatch, step):
    first = refresh(spark, golden_raw(spark), "2024-01-31", layer)
    stats = unordered(tuples(spark.table(f"{layer}.{STATS}")))
    break_publishing(monkeypatch, step)
    raw = golden_raw(spark)
    raw["comments"] = raw["comments"].limit(0)
    with pytest.raises(RuntimeError):
        refresh(spark, raw, "2024-01-31", layer)
    for name in (DAILY, STATS):
        assert sinks.runs(spark, name, layer) == [first.run] and sinks.published_run(spark, name, layer) == first.run
    assert unordered(tuples(spark.table(f"{layer}.{DAILY}"))) == unordered(DAILY_ROWS)
    assert unordered(tuples(spark.table(f"{layer}.{STATS}"))) == stats
    assert work_layers(spark) == []


def break_publishing(monkeypatch, step):
    """Let a step fail: the swap itself, or the definition of the second view."""
    whole = getattr(sinks, step)

    def broken(first, *more):
        if step == "point_to" or (first != "@" and more[0] == STATS):
            raise RuntimeError("lost")
        return whole(first, *more)

    monkeypatch.setattr(sinks, step, broken)


@pytest.mark.parametrize("step", ["point_to", "_shown"])
def test_failed_first_publish_leaves_nothing(spark, layer, monkeypatch, step):
    break_publishing(monkeypatch, step)
    with pytest.raises(RuntimeError):
        refresh(spark, golden_raw(spark), "2024-01-31", layer)
    found = {r.tableName for r in spark.sql(f"SHOW TABLES IN {layer}").collect()}
    assert found <= {sinks.runs_table(name) for name in (DAILY, STATS)}
    assert sinks.runs(spark, DAILY, layer) == sinks.runs(spark, STATS, layer) == []


def test_a_reader_of_both_tables_never_sees_two_runs(spark, layer):
    sinks.ensure_layer(spark, layer)
    names = ["t", "u"]
    for run in ("r1", "r2"):
        for name in names:
            sinks.write_run(spark.range(3).selectExpr("id", f"'{run}' as made"), name, run, layer)
    sinks.publish_all(spark, names, "r1", layer)
    ended = threading.Event()
    swaps = []

    def swap():
        while not ended.is_set():
            run = "r2" if len(swaps) % 2 == 0 else "r1"
            sinks.publish_all(spark, names, run, layer)
            swaps.append(run)

    writer = threading.Thread(target=swap)
    writer.start()
    try:
        seen = set()
        while len(seen) < 2 or len(swaps) < 40:
            both = spark.sql(f"SELECT t.made AS one, u.made AS other FROM {layer}.t JOIN {layer}.u USING (id)").collect()
            assert len(both) == 3 and len({x for row in both for x in row}) == 1
            seen.add(both[0].one)
            frames = sinks.published(spark, names, layer)
            assert len({frames[name].first().made for name in names}) == 1
    finally:
        ended.set()
        writer.join()


def test_a_query_reads_the_published_run_only(spark, layer):
    refresh(spark, golden_raw(spark), "2024-01-31", layer)
    last = refresh(spark, golden_raw(spark), "2024-01-31", layer)
    text = spark.table(f"{layer}.{DAILY}")._jdf.queryExecution().executedPlan().toString()
    assert re.search(rf"PartitionFilters: \[[^\]]*= {last.run}\)\]", text) and "ubquery" not in text  # chosen before files are listed


def test_a_frame_outlives_later_refreshes(spark, layer):
    done = refresh(spark, golden_raw(spark), "2024-01-31", layer, keep=1)
    raw = golden_raw(spark)
    raw["comments"] = raw["comments"].limit(0)
    for _ in range(3):
        refresh(spark, raw, "2024-01-31", layer, keep=1)
    assert unordered(tuples(done.daily)) == unordered(DAILY_ROWS)
    assert len(sinks.runs(spark, DAILY, layer)) == 4
    assert sum(r.comments_created for r in spark.table(f"{layer}.{DAILY}").collect()) == 0


def test_a_run_is_held_from_when_the_next_one_was_published(spark, layer, monkeypatch):
    sinks.ensure_layer(spark, layer)
    now = datetime.datetime.now(datetime.timezone.utc)
    hours = {"r1": 9, "r2": 5, "r3": 1}
    for run in hours:
        sinks.write_run(spark.range(1), "t", run, layer)
        sinks.publish(spark, "t", run, layer)
    for started in (now - datetime.timedelta(hours=h) for h in (50, 2)):  # never published
        sinks.write_run(spark.range(1), "t", f"{started:%Y%m%d%H%M%S%f}_x", layer)
    told = {run: now - datetime.timedelta(hours=h) for run, h in hours.items()}
    known = sinks.publications(spark, f"`{layer}`.`t__{sinks.POINTER}`")
    assert sorted(known, key=known.get) == list(hours)
    monkeypatch.setattr(sinks, "publications", lambda *_: told)

    def kept(hold):
        sinks.retire(spark, "t", "r3", 1, layer, datetime.timedelta(hours=hold))
        return [run[:8] for run in sinks.runs(spark, "t", layer) if run.startswith("r")]

    assert kept(6) == ["r1", "r2", "r3"]  # the next one came five hours ago
    assert len(sinks.runs(spark, "t", layer)) == 4  # but the old one that nobody ever saw went
    assert kept(4) == ["r2", "r3"]
    assert kept(0.5) == ["r3"]


def test_runs_in_a_place_with_odd_signs(spark, layer, tmp_path):
    sinks.ensure_layer(spark, layer, str(tmp_path / "it's 100% here"))
    for run in ("r1", "r.2-b"):
        sinks.write_run(spark.range(3), "t", run, layer, ("id",))
        assert sinks.publish(spark, "t", run, layer).count() == 3
    assert sinks.retire(spark, "t", "r.2-b", 1, layer) == []
    sinks.drop_run(spark, "t", "r1", layer)
    assert sinks.runs(spark, "t", layer) == ["r.2-b"]
    with pytest.raises(ValueError, match="no run name"):
        sinks.write_run(spark.range(3), "t", "r/3", layer)
    with pytest.raises(ValueError, match="has the columns"):
        sinks.write_run(spark.range(3).selectExpr("id as other"), "t", "r3", layer)
    with pytest.raises(ValueError, match="not stored"):
        sinks.publish(spark, "t", "r9", layer)


def test_a_table_belongs_to_one_set(spark, layer):
    sinks.ensure_layer(spark, layer)
    sinks.write_run(spark.range(1), "t", "r1", layer)
    sinks.publish(spark, "t", "r1", layer)
    with pytest.raises(ValueError, match="follows"):
        sinks.publish_all(spark, ["t"], "r1", layer)
    with pytest.raises(ValueError, match="not published together"):
        sinks.published(spark, ["t", "u"], layer)
    spark.range(1).write.saveAsTable(f"{layer}.{sinks.POINTER}")
    with pytest.raises(ValueError, match="no pointer"):
        refresh(spark, golden_raw(spark), "2024-01-31", layer)


def test_a_filter_on_a_repository_or_on_days_reads_a_small_part(spark, layer):
    sinks.ensure_layer(spark, layer)
    days = spark.range(2000 * 140).selectExpr(
        "id % 2000 as repo_id",
        "concat('o/', lpad(id % 2000, 4, '0')) as repo_full_name",
        "date_add(date'2023-01-02', cast(id div 2000 as int)) as day",
        *[f"id as {m}" for m in MEASURES],
    )
    sinks.write_run(days, "t", "r", layer, daily_order(), row_group=32 * 1024)
    place = sinks.described(spark, f"{layer}.{sinks.runs_table('t')}")["Location"].removeprefix("file:")
    groups = []
    for path in pathlib.Path(place).rglob("*.parquet"):
        about = pq.read_metadata(path)
        for k in range(about.num_row_groups):
            own = {c.path_in_schema: c.statistics for c in map(about.row_group(k).column, range(about.num_columns))}
            groups.append([(own[c].min, own[c].max) for c in ("repo_full_name", "day")])
    assert len(groups) > 200
    one = sum(low <= "o/1234" <= high for (low, high), _ in groups)
    last = sum(high >= datetime.date(2023, 5, 15) for _, (low, high) in groups)
    assert one <= 0.15 * len(groups) and last <= 0.15 * len(groups)


def test_checks_read_the_counts_once_and_shuffle_no_table_by_name(spark, layer):
    sinks.ensure_layer(spark, layer)
    done = count(golden_staged(spark), layer, buckets=4)
    names = marts.listed_names(done.repositories)
    together, tested = checks.names_checks(done.counts, names, {"issues": "issues_created"}, DAILY, 10)
    text = plan(checks.results(together, *tested))
    assert text.count("activity_counts") == 1 and "hashpartitioning" not in text
    stats = marts.repo_current_stats_from_counts(done.repositories, done.counts, "2024-01-31")
    daily = marts.daily_from_counts(done.counts, done.repositories)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (stats, daily):
            assert "Exchange" not in plan(df) and "SortMergeJoin" in plan(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {r.repo_full_name: tuple(r)[8:] for r in stats.collect()} == {
        "o/a": (2, 2, 1, 2), "o/b": (0, 1, 1, 1), "o/c": (0, 0, 0, 0),
    }


def test_crowded_names_are_dealt_in_a_refresh(spark, layer):
    sinks.ensure_layer(spark, layer)
    more = [{"id": n, "full_name": "o/a"} for n in (9, 10, 11)] + [{"id": 4, "full_name": None}]
    done = count(golden_staged(spark, REPOSITORIES + more), layer, 3, enforce=False, ids_per_task=2)
    assert [tuple(r) for r in done.crowds.collect()] == [("o/a", 2)]
    dealt = marts.daily_from_counts(done.counts, done.repositories, done.crowds)
    whole = marts.daily_from_counts(done.counts, done.repositories)
    assert unordered(tuples(dealt.drop(marts.SPREAD))) == unordered(tuples(whole.drop(marts.SPREAD)))
    assert [r.repo_id for r in done.unnamed.collect()] == [4]


def test_repositories_without_a_name_stay_in_the_snapshot(spark, layer):
    done = refresh(spark, golden_raw(spark, [*REPOSITORIES, {"id": 7}, {"id": 8}]), "2024-01-31", layer)
    assert [tuple(r)[8:] for r in done.stats.collect() if r.repo_full_name is None] == [(0, 0, 0, 0)] * 2


def test_a_name_taken_by_something_else_stops_the_run_before_it_builds(spark, layer):
    sinks.ensure_layer(spark, layer)
    spark.range(1).write.saveAsTable(f"{layer}.{STATS}")
    with pytest.raises(ValueError, match="no published table"):
        refresh(spark, golden_raw(spark), "2024-01-31", layer)
    assert [r.tableName for r in spark.sql(f"SHOW TABLES IN {layer}").collect()] == [STATS]


def test_unlisted_repositories_of_one_day_make_several_files(spark, layer):
    sinks.ensure_layer(spark, layer)
    counts = spark.range(40_000).selectExpr(
        "concat('unlisted/', id) as repo_full_name",
        "if(id % 10 = 0, date'2024-01-01', date'2024-01-02') as day",
        *[f"1 as {m}" for m in MEASURES],
    )
    repositories = spark.sql("SELECT 1L AS repo_id, 'o/a' AS repo_full_name")
    daily = marts.daily_from_counts(counts, repositories)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        stored = sinks.write_run(daily, "t", "r", layer, ("day", "repo_full_name", "repo_id"), marts.SPREAD)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert marts.SPREAD not in stored.columns
    sizes = [r["count"] for r in stored.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) > 2 and max(sizes) <= 2 * statistics.median(sizes)
    assert stored.where("day = date'2024-01-02'").groupBy(F.input_file_name()).count().count() > 1


def test_layer_at_another_place_is_refused(spark, layer, tmp_path):
    sinks.ensure_layer(spark, layer, str(tmp_path / "it's here"))
    sinks.ensure_layer(spark, layer, str(tmp_path / "it's here"))
    with pytest.raises(ValueError, match="not at"):
        sinks.ensure_layer(spark, layer, str(tmp_path / "there"))


def test_comments_and_names_may_have_quotes(spark, layer):
    sinks.ensure_layer(spark, layer)
    sinks.write_run(spark.range(1), "t", "r1", layer)
    sinks.publish(spark, "t", "r1", layer, "it's a \\ test", {"id": "a 'number'"})
    assert spark.catalog.getTable(f"{layer}.t").description == "it's a \\ test"
    assert sinks.published_run(spark, "t", layer) == "r1"


def test_a_run_is_never_overwritten(spark, layer):
    sinks.ensure_layer(spark, layer)
    sinks.write_run(spark.range(3), "t", "r1", layer, ("id",))
    with pytest.raises(AnalysisException):
        sinks.write_run(spark.range(4), "t", "r1", layer, ("id",))
    assert sinks.publish(spark, "t", "r1", layer).count() == 3
    with pytest.raises(ValueError):
        sinks.retire(spark, "t", "r1", 0, layer)


def test_retire_spares_the_published_run(spark, layer):
    sinks.ensure_layer(spark, layer)
    for run in ("r1", "r2", "r3"):
        sinks.write_run(spark.range(1), "t", run, layer)
    sinks.write_run(spark.range(1), "tt", "r0", layer)
    sinks.publish(spark, "t", "r1", layer)
    assert sinks.retire(spark, "t", "r1", 1, layer) == ["r2"]
    assert sinks.runs(spark, "t", layer) == ["r1", "r3"] and sinks.runs(spark, "tt", layer) == ["r0"]


def test_refresh_for_an_earlier_day_comes_last(spark, layer):
    refresh(spark, golden_raw(spark), "2024-02-10", layer, keep=1)
    back = refresh(spark, golden_raw(spark), "2024-01-31", layer, keep=1, hold=sinks.NO_HOLD)
    assert sinks.runs(spark, STATS, layer) == [back.run]
    assert {r.issues_created_30d for r in spark.table(f"{layer}.{STATS}").collect()} == {0, 2}


def test_layer_names():
    assert sinks.qualified("t", "mart") == "`mart`.`t`"
    assert sinks.qualified("t") == "`default`.`t`"


def test_views_are_not_stored(spark):
    df = sinks.as_view(spark.range(2), "two_rows")
    assert df.count() == 2 and spark.catalog.tableExists("two_rows")
    assert [t.isTemporary for t in spark.catalog.listTables() if t.name == "two_rows"] == [True]
    spark.catalog.dropTempView("two_rows")


def test_scratch_is_below_the_folder_the_cluster_names(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark).startswith(f"{root}/repopulse-")
    assert scratch_dir(spark) != scratch_dir(spark)


def test_a_cluster_without_a_shared_folder_is_refused():
    class Session:
        conf = {"spark.master": "local[2]"}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Session)
    assert scratch_dir(Session, "own", "/shared/") == "/shared/repopulse-own"


def test_shuffle_partitions():
    mb = 1024**2
    assert shuffle_partitions(0, 8) == 8
    assert shuffle_partitions(128 * mb * 100 + 1, 8) == 101
    assert shuffle_partitions(128 * mb * 10**6, 8) == 10**6
