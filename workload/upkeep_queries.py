"""Tables kept up to date by deltas: merges, load logs, gold states, snapshots, streams."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, functions as F

from lodeworks.contracts import GAMES, PLAYER_STATISTICS
from lodeworks.operators.checks import column_report
from lodeworks.plans import gold, gold_state, star
from lodeworks.sources.files import scan_parquet
from lodeworks.sources.sinks import write_bucketed, write_parquet
from lodeworks.sources.snapshots import point_at, publish_set, read_snapshot
from lodeworks.sources.staging import fresh_path, released, rounds_for, staged, staged_in_rounds
from lodeworks.sources.tables import ensure_database, scan_table
from lodeworks.streaming import load_log, streams
from lodeworks.streaming.incremental import newer_than
from lodeworks.streaming.merge import merge_silver
from workload import roles
from workload.silver_queries import (
    AS_OF,
    RUN_TS,
    ORACLE as SILVER_SQL,
    silver_player_statistics,
    silver_team_statistics,
)
from workload.star_queries import ORACLE as STAR_SQL

_GAME_COLUMNS = roles.BRONZE_GAMES_COLUMNS
_AUDIT = ("silver_ingest_ts", "source_file")
_DATES = {"as_of": AS_OF, "run_ts": RUN_TS}


# -- silver by merges ------------------------------------------------------


def _game_deltas(spark, sf_dir):
    """Three deliveries of bronze games, with earlier versions of a fifth of the games.

    Outdated versions stand a season back, so that a correction moves a game to another
    partition; the last delivery brings outdated versions once more and repeats rows.
    """
    # Written once, as each delivery is a part of it and the role joins five tables.
    bronze = staged(roles.BRONZE_GAMES.frame(spark, sf_dir, *_GAME_COLUMNS), "bronze-games")
    dated = F.col("gamedatetimeest").rlike("^19[2-9]|^2")
    outdated = bronze.filter(dated & (F.col("gameid") % 5 == 1)).withColumns(
        {
            "gamedatetimeest": F.add_months(F.substring("gamedatetimeest", 1, 10).try_cast("date"), -12).cast("string"),
            "homescore": F.col("homescore") + 1,
        }
    )
    part = F.pmod(F.xxhash64("gameid", "awayteamid", "seriesgamenumber"), F.lit(3))
    thirds = [bronze.filter(part == k) for k in range(3)]
    return [
        outdated.unionByName(thirds[0]),
        thirds[1],
        thirds[2].unionByName(thirds[0]).unionByName(outdated),
    ]


def _line_deltas(spark, sf_dir):
    """Three deliveries of box scores; several lines have one key, in any of them."""
    bronze = staged(roles.BRONZE_PLAYER_STATISTICS.frame(spark, sf_dir), "bronze-lines")
    part = F.pmod(F.xxhash64("gameId", "gameDateTimeEst", "points", "seriesGameNumber"), F.lit(3))
    return [bronze.filter(part == k) for k in range(3)]


def _merged(spark, sf_dir, deltas, contract):
    path = fresh_path(spark, "merged-silver")
    rejects = fresh_path(spark, "merged-quarantine")
    merges = []
    for k, delta in enumerate(deltas(spark, sf_dir)):
        # Only what is in silver and quarantine is read later.
        with released(spark):
            merges.append(merge_silver(delta, contract, path, rejects, run=str(k), **_DATES))
    return path, rejects, merges


def _merge_games(spark, sf_dir):
    path, _, merges = _merged(spark, sf_dir, _game_deltas, GAMES)
    return scan_parquet(spark, path, merges[0].added.schema).drop(*_AUDIT)


def _merge_lines(spark, sf_dir):
    path, _, merges = _merged(spark, sf_dir, _line_deltas, PLAYER_STATISTICS)
    return scan_parquet(spark, path, merges[0].added.schema).drop(*_AUDIT)


def _merge_quarantine(spark, sf_dir):
    _, rejects, _ = _merged(spark, sf_dir, _line_deltas, PLAYER_STATISTICS)
    return scan_parquet(spark, rejects).drop("run", *_AUDIT)


# -- recorded loads --------------------------------------------------------


def _resumed(delimited):
    """Four runs of a recorded load; the second is cut off between append and commit."""

    def query(spark, sf_dir):
        events = roles.load(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
        if delimited:
            events = events.withColumn("ts", F.col("ts").cast("string"))
        target = fresh_path(spark, "logged")
        limits = [F.lit(f"2024-01-0{day} 00:00:00") for day in (2, 3)]
        early, more = (events.filter(F.col("ts").cast("string") <= limit) for limit in limits)
        load_log.logged_append(early.filter("event_id % 7 <> 0"), target, "ts", delimited=delimited)
        log = load_log.entries(spark, target)
        cut = newer_than(more, "ts", log[-1].watermark)
        load_log.write_load(cut, target, delimited)
        load_log.logged_append(more, target, "ts", delimited=delimited)
        # Late rows are found within the window, which reaches back over all earlier runs.
        window = {"lookback": timedelta(days=9999), "keys": ["event_id"]}
        load_log.logged_append(events, target, "ts", delimited=delimited, **window)
        return load_log.logged_append(events, target, "ts", delimited=delimited, **window)

    return query


# -- gold by deltas --------------------------------------------------------


def _states(spark, sf_dir, deltas, contract, update):
    """A state after every delta was merged into silver and its changes applied."""
    silver, state = fresh_path(spark, "state-silver"), fresh_path(spark, "state")
    for delta in deltas(spark, sf_dir):
        done = merge_silver(delta, contract, silver, **_DATES)
        held = update(state, done.added, done.removed)
    return held


def _gold_players(spark, sf_dir):
    state = _states(spark, sf_dir, _line_deltas, PLAYER_STATISTICS, gold_state.update_players)
    return gold_state.player_seasons_of(state)


def _gold_teams(spark, sf_dir):
    state = _states(spark, sf_dir, _game_deltas, GAMES, gold_state.update_teams)
    return gold_state.team_seasons_of(state)


# -- one publication of a set ----------------------------------------------


def _failing(tables: dict[str, DataFrame], at: int) -> dict[str, DataFrame]:
    """The same, but the table of that place fails while it is written."""
    name = list(tables)[at]
    broken = tables[name].withColumn(
        tables[name].columns[0],
        F.expr(f"CASE WHEN rand() >= 0 THEN raise_error('cut off') ELSE `{tables[name].columns[0]}` END").cast(
            tables[name].dtypes[0][1]
        ),
    )
    return {**tables, name: broken}


def _seasons(spark, sf_dir):
    """Player and team seasons, staged: every table of every set is made from these."""
    columns = ("personId", "gameId", "firstName", "lastName", "game_year")
    stats = roles.PLAYER_STATISTICS.frame(spark, sf_dir, *columns, *gold.MEASURES.values())
    games = roles.GAMES.frame(
        spark, sf_dir, "game_year", "homeTeamName", "awayTeamName", "homeScore", "awayScore"
    )
    return (
        staged(gold.player_seasons(stats), "player-seasons"),
        staged(gold.team_seasons(games), "team-seasons"),
    )


def _gold_set(seasons, last):
    return gold.gold_tables_from_seasons(*(rows.filter(F.col("game_year") <= last) for rows in seasons))


_SEASONS = (1996, 1998, 2100)


def _published(spark, sf_dir):
    """Three publications, of which the last fails at its fifth table."""
    database = f"lodeworks_{uuid4().hex[:12]}"
    base = fresh_path(spark, database)
    ensure_database(spark, database, f"{base}/db")
    seasons = _seasons(spark, sf_dir)
    done = [publish_set(spark, _gold_set(seasons, s), database, f"{base}/gold") for s in _SEASONS[:2]]
    last = _failing(_gold_set(seasons, _SEASONS[2]), 4)
    try:
        publish_set(spark, last, database, f"{base}/gold")
    except Exception as failed:
        if "cut off" not in str(failed):
            raise
    return database, f"{base}/gold", done, list(last)


def _facts_of(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and the greatest season, or number of games, of every table."""
    found = []
    for name, table in tables.items():
        top = "game_year" if "game_year" in table.columns else "games_played"
        found.append(
            table.groupBy(F.lit(name).alias("table_name")).agg(
                F.count("*").alias("row_count"), F.max(top).cast("bigint").alias("top")
            )
        )
    return reduce(DataFrame.unionByName, found)


def _snapshot_consistent(spark, sf_dir):
    database, _, _, names = _published(spark, sf_dir)
    return _facts_of({name: scan_table(spark, database, name) for name in names})


def _snapshot_rolled_back(spark, sf_dir):
    """The earlier snapshot, half of it by its id and half by the names after a rollback."""
    database, base, done, names = _published(spark, sf_dir)
    point_at(spark, database, done[0])
    return _facts_of(
        {
            name: read_snapshot(spark, base, name, done[0]) if k % 2 else scan_table(spark, database, name)
            for k, name in enumerate(names)
        }
    )


def _gold_facts_sql(season: int) -> str:
    parts = []
    for measure in gold.MEASURES:
        parts.append(
            f"SELECT '{gold.PER_GAME_TABLE.format(measure)}' AS table_name, count(*) AS row_count, "
            "max(games) AS top FROM (SELECT count(gameId) AS games FROM p GROUP BY personId, firstName, lastName)"
        )
        parts.append(
            f"SELECT '{gold.PER_SEASON_TABLE.format(measure)}', count(DISTINCT (game_year, personId)), "
            "max(game_year)::BIGINT FROM p"
        )
    parts += [
        f"SELECT '{name}', count(DISTINCT (game_year, team)), max(game_year)::BIGINT FROM sides"
        for name in (gold.WIN_TABLE, gold.DOUBLE_DIGIT_TABLE)
    ]
    players = roles.PLAYER_STATISTICS.sql("personId", "gameId", "firstName", "lastName", "game_year")
    games = roles.GAMES.sql("game_year", "homeTeamName", "awayTeamName")
    return f"""
        WITH p AS (SELECT * FROM ({players}) WHERE game_year <= {season}),
        g AS (SELECT * FROM ({games}) WHERE game_year <= {season}),
        sides AS (SELECT game_year, homeTeamName AS team FROM g UNION ALL SELECT game_year, awayTeamName FROM g)
        {" UNION ALL ".join(parts)}"""


# -- bucketed storage ------------------------------------------------------


def _fact_bucketed(spark, sf_dir):
    database = f"lodeworks_{uuid4().hex[:12]}"
    base = fresh_path(spark, database)
    ensure_database(spark, database, f"{base}/db")
    silver = {
        "player_statistics": silver_player_statistics(spark, sf_dir).silver,
        "team_statistics": silver_team_statistics(spark, sf_dir).silver,
    }
    tables = []
    for name, rows in silver.items():
        # Staged between dedup and buckets, so that the files of one shuffle are there at a time.
        with released(spark):
            rounds = rounds_for(spark, rows.inputFiles())
            rows = staged_in_rounds(rows, f"silver-{name}", ["gameId"], rounds)
            tables.append(
                write_bucketed(
                    rows, f"{database}.{name}", f"{base}/{name}", star.FACT_KEYS[name], 8, rounds
                )
            )
    return star.fact_stats(*tables, co_located=True)


# -- streams ---------------------------------------------------------------


def _landing(spark, label, deliveries):
    """A directory into which deliveries are put one after the other."""
    path = fresh_path(spark, label)
    for rows in deliveries:
        yield path, write_parquet(rows, path, mode="append")


def _event_stream(spark, sf_dir):
    """Two deliveries, the second with everything once more, each picked up by a run."""
    events = roles.load(spark, sf_dir, "events")
    target, checkpoint = fresh_path(spark, "stream"), fresh_path(spark, "stream-state")
    early = events.filter(F.col("ts") <= F.lit("2024-01-02 00:00:00").cast("timestamp_ntz"))
    for path, _ in _landing(spark, "landing", (early, events)):
        feed = streams.read_feed(spark, path, events.schema)
        fresh = streams.without_repeats(feed, "ts", ["event_id"], late="9999 days")
        streams.append_available(fresh, target, checkpoint)
    return streams.scan_appended(spark, target, events.schema)


def _silver_stream(spark, sf_dir):
    """Bronze games that arrive as files and are merged into silver."""
    silver, checkpoint = fresh_path(spark, "stream-silver"), fresh_path(spark, "stream-state")
    for path, _ in _landing(spark, "landing", _game_deltas(spark, sf_dir)):
        feed = streams.read_feed(spark, path, roles.BRONZE_GAMES.frame(spark, sf_dir, *_GAME_COLUMNS).schema)
        streams.merge_available(feed, GAMES, silver, checkpoint, **_DATES)
    return scan_parquet(spark, silver).drop(*_AUDIT).withColumn("game_year", F.col("game_year").cast("int"))


# -- presence of columns ---------------------------------------------------

_REQUIRED = ("GAMEID", "gameDateTimeEst", "homescore", "attendance", "referee", "gameid")


def _column_report(spark, sf_dir):
    return column_report(roles.BRONZE_GAMES.frame(spark, sf_dir, *_GAME_COLUMNS), _REQUIRED)


QUERIES = {
    "silver_merge_increments": _merge_games,
    "silver_merge_player_statistics": _merge_lines,
    "silver_merge_quarantine": _merge_quarantine,
    "incremental_resumed": _resumed(False),
    "incremental_resumed_text": _resumed(True),
    "gold_after_corrections": _gold_players,
    "gold_teams_after_corrections": _gold_teams,
    "gold_snapshot_consistent": _snapshot_consistent,
    "gold_snapshot_rolled_back": _snapshot_rolled_back,
    "fact_bucketed": _fact_bucketed,
    "incremental_stream": _event_stream,
    "silver_stream": _silver_stream,
    "column_report": _column_report,
}

_SEASON_SUMS = ", ".join(f"sum({source}) AS total_{name}" for name, source in gold.MEASURES.items())

ORACLE = {
    "silver_merge_increments": SILVER_SQL["silver_games"],
    "silver_merge_player_statistics": SILVER_SQL["silver_player_statistics"],
    "silver_merge_quarantine": SILVER_SQL["quarantine_player_statistics"],
    "incremental_resumed": "SELECT event_id, ts, user_id, event_type FROM events",
    "incremental_resumed_text": """
        SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, event_type FROM events""",
    "gold_after_corrections": f"""
        SELECT game_year, personId, concat_ws(' ', firstName, lastName) AS "playerName", {_SEASON_SUMS},
               count(gameId) AS games_played
        FROM ({SILVER_SQL["silver_player_statistics"]}) AS s GROUP BY 1, 2, 3""",
    "gold_teams_after_corrections": f"""
        WITH g AS ({SILVER_SQL["silver_games"]}), sides AS (
            SELECT game_year, hometeamname AS team, homescore - awayscore AS margin FROM g
            UNION ALL SELECT game_year, awayteamname, awayscore - homescore FROM g
        )
        SELECT game_year, team, sum(CASE WHEN margin > 0 THEN 1 ELSE 0 END)::BIGINT AS wins,
               count(*) AS games_played,
               sum(CASE WHEN margin >= 10 THEN 1 ELSE 0 END)::BIGINT AS double_digit_wins
        FROM sides GROUP BY 1, 2""",
    "gold_snapshot_consistent": _gold_facts_sql(_SEASONS[1]),
    "gold_snapshot_rolled_back": _gold_facts_sql(_SEASONS[0]),
    "fact_bucketed": STAR_SQL["fact_from_silver"],
    "incremental_stream": "SELECT * FROM events",
    "silver_stream": SILVER_SQL["silver_games"],
    "column_report": f"""
        WITH b AS ({roles.BRONZE_GAMES.sql(*_GAME_COLUMNS)})
        SELECT 'GAMEID' AS column_name, true AS present, count(gameid) AS known FROM b
        UNION ALL SELECT 'gameDateTimeEst', true, count(gamedatetimeest) FROM b
        UNION ALL SELECT 'homescore', true, count(homescore) FROM b
        UNION ALL SELECT 'attendance', true, count(attendance) FROM b
        UNION ALL SELECT 'referee', false, NULL""",
}
