"""Merges, recorded loads, gold by deltas, snapshots, buckets and streams."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Row, functions as F

from build import bronze, values
from lodeworks.contracts import GAMES
from lodeworks.operators.checks import column_report
from lodeworks.plans import gold, gold_state, star
from lodeworks.plans.silver import build_silver
from lodeworks.sources import sinks, snapshots, storage
from lodeworks.sources.files import scan_parquet
from lodeworks.streaming import load_log, streams
from lodeworks.streaming.merge import merge_rows, merge_silver


def files(path):
    return {
        os.path.join(at, name): os.stat(os.path.join(at, name)).st_mtime_ns
        for at, _, names in os.walk(path)
        for name in names
        if name.endswith(".parquet")
    }


# Merges

ROW = "id long, version int, season int, text string"
MERGE = {"keys": ["id"], "newest_by": ["version"], "tie_break": ["text"], "partition_by": ["season"]}


def merge(spark, path, *rows):
    return merge_rows(spark.createDataFrame(rows, ROW), path, **MERGE)


def test_merge_replaces_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "silver")
    merge(spark, path, (1, 1, 2000, "a"), (2, 1, 2001, "b"), (3, 1, None, "c"), (4, 1, 2002, "d"))
    before = files(path)
    done = merge(spark, path, (2, 2, 2001, "b2"), (3, 0, 2001, "late"), (5, 1, 2003, "e"))
    assert values(done.added, "id", "text") == [(2, "b2"), (5, "e")]
    assert values(done.removed, "id", "text") == [(2, "b")]
    after = files(path)
    for season in ("2000", "2002"):
        kept = {k: v for k, v in before.items() if f"season={season}" in k}
        assert kept and kept.items() <= after.items()
    got = values(spark.read.schema(ROW).parquet(path), "id", "version", "season", "text")
    assert got == [(1, 1, 2000, "a"), (2, 2, 2001, "b2"), (3, 1, None, "c"), (4, 1, 2002, "d"), (5, 1, 2003, "e")]


def test_merge_moves_rows_between_partitions(spark, tmp_path):
    path = str(tmp_path / "silver")
    merge(spark, path, (1, 1, 2000, "a"), (2, 1, None, "b"), (3, 1, 2001, "c"))
    merge(spark, path, (1, 2, 2001, "a2"), (2, 2, 2000, "b2"))
    assert values(spark.read.schema(ROW).parquet(path), "id", "season") == [(1, 2001), (2, 2000), (3, 2001)]
    assert not os.path.exists(f"{path}/season=__HIVE_DEFAULT_PARTITION__")


def test_merge_again_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "silver")
    delta = ((1, 1, 2000, "a"), (2, 1, 2001, "b"))
    merge(spark, path, *delta)
    again = merge(spark, path, *delta)
    assert again.added.count() == again.removed.count() == 0
    assert spark.read.schema(ROW).parquet(path).count() == 2
    nothing = merge_rows(spark.createDataFrame([], ROW), path, **MERGE)
    assert nothing.partitions == [] and spark.read.schema(ROW).parquet(path).count() == 2


def test_cut_off_merge_is_mended_by_the_next(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "silver")
    merge(spark, path, (1, 1, 2000, "a"), (2, 1, 2001, "b"))
    remove = storage.remove
    monkeypatch.setattr(sinks.storage, "remove", lambda *a: (_ for _ in ()).throw(OSError("cut off")))
    with pytest.raises(OSError):
        merge(spark, path, (1, 2, 2001, "a2"))
    monkeypatch.setattr(sinks.storage, "remove", remove)
    assert spark.read.schema(ROW).parquet(path).count() == 3  # the old version is still there
    merge(spark, path, (1, 2, 2001, "a2"))
    assert values(spark.read.schema(ROW).parquet(path), "id", "text") == [(1, "a2"), (2, "b")]


def test_partitions_of_two_columns_and_odd_names(spark, tmp_path):
    path, schema = str(tmp_path / "two"), "id long, v int, a string, b int"
    keyed = {"keys": ["id"], "newest_by": ["v"], "tie_break": [], "partition_by": ["a", "b"]}
    rows = [(1, 1, "x y/z=1%", 1), (2, 1, None, 2), (3, 1, "q", None)]
    merge_rows(spark.createDataFrame(rows, schema), path, **keyed)
    moved = [(1, 2, "q", 1), (2, 2, "q", 2)]
    merge_rows(spark.createDataFrame(moved, schema), path, **keyed)
    assert values(spark.read.schema(schema).parquet(path), "id", "a", "b") == [(1, "q", 1), (2, "q", 2), (3, "q", None)]


def test_merged_silver_equals_a_rebuild(spark, tmp_path):
    def game(i, when, home):
        return {"gameid": i, "gamedatetimeest": when, "hometeamid": 1, "awayteamid": 2, "arenaid": 3,
                "homescore": home, "awayscore": 50}

    deltas = [
        [game(1, "2020-01-01", 40), game(2, "2020-02-01", 60), {"gameid": 9}],
        [game(1, "2021-01-01", 70), game(3, "2019-05-05", -1)],
        [game(1, "2020-06-01", 10), game(2, "2020-02-01", 61)],
    ]
    path, rejects = str(tmp_path / "silver"), str(tmp_path / "quarantine")
    dates = {"as_of": datetime(2024, 1, 1).date(), "run_ts": datetime(2024, 1, 1)}
    for _ in range(2):
        for k, rows in enumerate(deltas):
            merge_silver(bronze(spark, GAMES, *rows), GAMES, path, rejects, run=str(k), **dates)
    whole = build_silver(bronze(spark, GAMES, *sum(deltas, [])), GAMES, **dates)
    columns = whole.silver.columns
    assert values(spark.read.schema(whole.silver.schema).parquet(path), *columns) == values(whole.silver, *columns)
    assert spark.read.parquet(rejects).count() == whole.quarantine.count() == 1


# Recorded loads


def events(spark, *rows):
    return spark.createDataFrame(rows, "id long, ts string")


@pytest.mark.parametrize("delimited", (False, True))
def test_a_cut_off_load_is_repeated_without_doubles(spark, tmp_path, delimited):
    target = str(tmp_path / "target")
    first = events(spark, (1, "2024-01-01 00:00:00"), (2, "2024-01-02 00:00:00"), (3, None))
    load_log.logged_append(first, target, "TS", delimited=delimited)
    more = first.union(events(spark, (4, "2024-01-03 00:00:00"), (5, "NA")))
    load_log.write_load(more.filter("id = 4"), target, delimited)
    got = load_log.logged_append(more, target, "ts", delimited=delimited)
    assert values(got, "id") == [(1,), (2,), (4,)]
    log = load_log.entries(spark, target)
    assert [(e.number, e.rows) for e in log] == [(0, 2), (1, 1)]
    assert values(load_log.logged_append(more, target, "ts", delimited=delimited), "id") == [(1,), (2,), (4,)]
    assert len(load_log.entries(spark, target)) == 2  # nothing new, no entry
    assert spark.read.parquet(f"{target}-undated").count() == 2


def test_the_target_is_not_read_for_its_watermark(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "target")
    rows = events(spark, (1, "2024-01-01 00:00:00"))
    load_log.logged_append(rows, target, "ts", delimited=True)
    read = []
    plain = load_log._read
    monkeypatch.setattr(load_log, "_read", lambda s, t, names, d: read.append(list(names)) or plain(s, t, names, d))
    old = load_log.entries(spark, target)[0].files
    load_log.logged_append(rows.union(events(spark, (2, "2024-01-02 00:00:00"))), target, "ts", delimited=True)
    assert read and not any(set(old) & set(names) for names in read)


def test_late_rows_read_only_loads_within_the_window(spark, tmp_path):
    target = str(tmp_path / "target")
    rows = [(i, f"2024-01-0{i} 12:00:00") for i in range(1, 6)]
    for k in (1, 3, 5):
        load_log.logged_append(events(spark, *rows[:k][-1:]), target, "ts")
    log = load_log.entries(spark, target)
    assert len(log) == 3
    window = timedelta(days=2.5)
    source = events(spark, *rows, (9, "2024-01-01 00:00:00"))
    within = load_log._within(source, "ts", log[-1].watermark, window, log)
    assert sorted(within) == sorted(log[1].files + log[2].files)
    got = load_log.logged_append(source, target, "ts", window, keys=["id"])
    assert values(got, "id") == [(1,), (3,), (4,), (5,)]


def test_entries_that_name_all_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(load_log, "WHOLE_EVERY", 3)
    target = str(tmp_path / "target")
    for i in range(1, 9):
        got = load_log.logged_append(events(spark, (i, f"2024-01-0{i} 00:00:00")), target, "ts")
    assert [e.number for e in load_log.entries(spark, target)] == [6, 7]
    assert values(got, "id") == [(i,) for i in range(1, 9)]
    # An entry that was cut off does not count, and its files are orphans.
    storage.write_new(spark, f"{load_log.log_path(target)}/{8:012d}.json", '{"number": 8, "fi')
    load_log.write_load(events(spark, (9, "2024-01-09 00:00:00")), target)
    assert values(load_log.logged_append(events(spark, (9, "2024-01-09 00:00:00")), target, "ts"), "id")[-1] == (9,)
    assert load_log.entries(spark, target)[-1].number == 9 and spark.read.parquet(target).count() == 9


def test_targets_without_a_log_are_taken_over(spark, tmp_path):
    target = str(tmp_path / "target")
    load_log.write_load(events(spark, (1, "2024-01-05 00:00:00")), target)
    got = load_log.logged_append(events(spark, (2, "2024-01-01 00:00:00"), (3, "2024-01-06 00:00:00")), target, "ts")
    assert values(got, "id") == [(1,), (3,)]
    assert load_log.logged_append(events(spark), str(tmp_path / "none"), "ts").count() == 0


# Gold by deltas

STAT = "gameId long, personId long, firstName string, lastName string, game_year int, points double, assists double, reboundstotal double"


def stats(spark, *rows):
    return spark.createDataFrame(rows, STAT)


def test_corrections_take_their_old_share_back(spark, tmp_path):
    path = str(tmp_path / "state")
    rows = [(1, 7, "A", "B", 2000, 10.0, None, 1.0), (2, 7, "A", "B", 2000, 5.0, None, 2.0),
            (3, 8, "C", None, 2001, 0.0, 3.0, None), (4, 9, "D", "E", 2002, 1.0, 1.0, 1.0)]
    gold_state.update_players(path, stats(spark, *rows), stats(spark))
    before = files(path)
    fixed = (2, 7, "A", "B", 2000, 6.0, 4.0, 2.0)
    state = gold_state.update_players(path, stats(spark, fixed), stats(spark, rows[1], rows[2]))
    whole = gold.player_seasons(stats(spark, rows[0], fixed, rows[3]))
    assert values(gold_state.player_seasons_of(state), *whole.columns) == values(whole, *whole.columns)
    kept = {k: v for k, v in before.items() if "game_year=2002" in k}
    assert kept and kept.items() <= files(path).items()
    # What is taken back entirely leaves no total of zero behind.
    state = gold_state.update_players(path, stats(spark), stats(spark, fixed))
    whole = gold.player_seasons(stats(spark, rows[0], rows[3]))
    assert values(gold_state.player_seasons_of(state), *whole.columns) == values(whole, *whole.columns)


def test_state_update_reads_the_touched_seasons_alone(spark, tmp_path):
    path = str(tmp_path / "state")
    gold_state.update_players(path, stats(spark, (1, 7, "A", "B", 2000, 1.0, 1.0, 1.0), (2, 7, "A", "B", 2001, 1.0, 1.0, 1.0)), stats(spark))
    here = scan_parquet(spark, path).filter(sinks.partition_filter([Row(game_year=2001)], ["game_year"]))
    assert "PartitionFilters: [isnotnull(game_year" in here._jdf.queryExecution().toString()
    assert here.count() == 1


# Snapshots


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{os.path.basename(tmp_path).replace('-', '_')}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")
    spark.sql(f"DROP DATABASE IF EXISTS {name}_publication CASCADE")


def numbers(spark, n):
    return {name: spark.range(n).withColumn("x", F.lit(name)) for name in ("a", "b", "c")}


def shown(spark, database):
    return [spark.table(f"{database}.{name}").count() for name in ("a", "b", "c")]


def test_all_names_follow_one_pointer(spark, database, tmp_path):
    base = str(tmp_path / "gold")
    first = snapshots.publish_set(spark, numbers(spark, 3), database, base)
    second = snapshots.publish_set(spark, numbers(spark, 5), database, base)
    assert shown(spark, database) == [5, 5, 5] and snapshots.current(spark, database) == second
    broken = numbers(spark, 7)
    broken["b"] = broken["b"].withColumn("id", F.expr("raise_error('no')").cast("long"))
    with pytest.raises(Exception, match="no"):
        snapshots.publish_set(spark, broken, database, base)
    assert shown(spark, database) == [5, 5, 5]
    assert snapshots.snapshots(spark, base, broken) == [first, second]
    snapshots.point_at(spark, database, first)
    assert shown(spark, database) == [3, 3, 3]
    assert snapshots.read_snapshot(spark, base, "c", second).count() == 5
    plan = spark.table(f"{database}.a")
    plan.collect()
    assert "PartitionFilters" in plan._jdf.queryExecution().toString()


def test_old_snapshots_are_removed(spark, database, tmp_path):
    base = str(tmp_path / "gold")
    done = [snapshots.publish_set(spark, numbers(spark, n), database, base) for n in range(1, 5)]
    assert snapshots.remove_snapshots(spark, database, base, numbers(spark, 1), keep=1) == done[:2]
    assert snapshots.snapshots(spark, base, numbers(spark, 1)) == done[2:]
    assert shown(spark, database) == [4, 4, 4]


def test_other_columns_are_refused_before_anything_is_written(spark, database, tmp_path):
    base = str(tmp_path / "gold")
    snapshots.publish_set(spark, numbers(spark, 2), database, base)
    other = {**numbers(spark, 9), "c": spark.range(9)}
    with pytest.raises(ValueError, match="other columns"):
        snapshots.publish_set(spark, other, database, base)
    assert shown(spark, database) == [2, 2, 2] and len(snapshots.snapshots(spark, base, other)) == 1


# Buckets


def test_bucketed_fact_is_joined_without_an_exchange(spark, database, tmp_path):
    line = "gameId long, personId long, playerteamName string, " + ", ".join(
        f"{c} double" for c in star.FACT_COLUMNS if c not in (*star.FACT_FROM_TEAMS, "gameid", "personid", "teamname", "teamcity", "rebounds")
    ) + ", playerteamcity string, reboundsoffensive double, reboundsdefensive double"
    team = "gameId long, teamName string, " + ", ".join(f"{c} int" for c in star.FACT_FROM_TEAMS)
    rows = {"player_statistics": spark.createDataFrame([], line), "team_statistics": spark.createDataFrame([], team)}
    tables = [
        sinks.write_bucketed(df, f"{database}.{name}", f"{tmp_path}/{name}", star.FACT_KEYS[name], 4)
        for name, df in rows.items()
    ]
    plan = star.fact_stats(*tables, co_located=True)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


# Streams


def test_a_stream_picks_up_new_files_once(spark, tmp_path):
    landing, target, checkpoint = (str(tmp_path / x) for x in ("landing", "target", "checkpoint"))
    schema = spark.createDataFrame([], "id long, ts string").schema

    def arrive(*rows):
        events(spark, *rows).coalesce(1).write.mode("append").parquet(landing)
        feed = streams.without_repeats(streams.read_feed(spark, landing, schema), "ts", ["id"], "2 days")
        streams.append_available(feed, target, checkpoint)
        return values(streams.scan_appended(spark, target, schema), "id", "ts")

    assert len(arrive((1, "2024-01-05 00:00:00"), (1, "2024-01-05 00:00:00"), (2, "2024-01-05 01:00:00"))) == 2
    # A repeat and a new row within the window; one that is too late to be told from a repeat.
    got = arrive((1, "2024-01-05 00:00:00"), (3, "2024-01-04 00:00:00"), (4, "2023-01-01 00:00:00"))
    assert [i for i, _ in got] == [1, 2, 3]


def test_a_merged_stream_bears_repeated_batches(spark, tmp_path):
    landing, silver, rejects = (str(tmp_path / x) for x in ("landing", "silver", "rejects"))
    game = {"gameid": 1, "gamedatetimeest": "2020-01-01", "hometeamid": 1, "awayteamid": 2, "arenaid": 3,
            "homescore": 4, "awayscore": 5}
    bronze(spark, GAMES, game, {"gameid": 2}).coalesce(1).write.parquet(landing)
    for checkpoint in ("c1", "c1", "c2"):  # the last one reads the same files as batch 0 again
        feed = streams.read_feed(spark, landing, GAMES.bronze)
        streams.merge_available(feed, GAMES, silver, str(tmp_path / checkpoint), rejects)
    assert spark.read.parquet(silver).count() == 1 and spark.read.parquet(rejects).count() == 1


# Presence


def test_columns_are_reported_in_any_case(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "Id long, name string")
    got = column_report(df, ["ID", "NAME", "other", "id"])
    assert [tuple(r) for r in got.collect()] == [("ID", True, 2), ("NAME", True, 1), ("other", False, None)]
    assert column_report(df, []).count() == 0
    assert [tuple(r) for r in column_report(df.limit(0), ["id"]).collect()] == [("id", True, 0)]
