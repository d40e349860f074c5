"""Sources, sinks and incremental loads: write to a fresh place and read back."""

from __future__ import annotations

from datetime import timedelta
from uuid import uuid4

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from lodeworks.contracts import GAMES, PLAYERS, TEAM_STATISTICS
from lodeworks.operators.audit import SOURCE_FILE, row_counts
from lodeworks.plans import gold
from lodeworks.sources.files import (
    scan_csv_with_header,
    scan_delimited,
    scan_headerless_csv,
    scan_parquet,
    with_lineage,
)
from lodeworks.sources.sinks import replace_parquet, write_delimited, write_parquet
from lodeworks.sources.staging import fresh_path, staged
from lodeworks.sources.tables import (
    ensure_database,
    overwrite_table,
    publish_table,
    register_delimited,
    register_external,
    scan_table,
)
from lodeworks.streaming.incremental import (
    high_watermark,
    incremental_append,
    since_cutoff,
    undated_default,
)
from workload import roles
from workload.cleansing_queries import cast_sql
from workload.silver_queries import ORACLE as SILVER_SQL, number, silver_games

_SPLIT, _LATE = "2024-01-02 00:00:00", "2024-01-01 20:00:00"
_CUTOFF = "1998-06-01"
_GAME_COLUMNS = roles.BRONZE_GAMES_COLUMNS
_KEEP_SPACES = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
_GAMES, _PLAYERS, _TEAMS = (
    roles.BRONZE_GAMES,
    roles.BRONZE_PLAYERS,
    roles.BRONZE_TEAM_STATISTICS,
)


def _events(spark, sf_dir):
    return roles.load(spark, sf_dir, "events")


def _event_halves(spark, sf_dir):
    events = _events(spark, sf_dir)
    early = F.col("ts") <= F.lit(_SPLIT).cast("timestamp_ntz")
    return events, events.filter(early)


def _cutoff(spark, sf_dir):
    rows = _GAMES.frame(spark, sf_dir, "gameid", "gamedatetimeest")
    return since_cutoff(rows, "gamedatetimeest", _CUTOFF)


def _incremental(spark, sf_dir):
    events, early = _event_halves(spark, sf_dir)
    target = fresh_path(spark, "incremental")
    incremental_append(early, target, "ts")
    return incremental_append(events, target, "ts")


def _incremental_lookback(spark, sf_dir):
    events = _events(spark, sf_dir)
    early = F.col("ts") <= F.lit(_SPLIT).cast("timestamp_ntz")
    # Three runs over the same window, of rows that came late and rows that are there.
    late = F.col("event_id") % 5 == 0
    some = early & ~(late & (F.col("ts") > F.lit(_LATE).cast("timestamp_ntz")))
    target = fresh_path(spark, "lookback")
    window = {"lookback": timedelta(hours=6), "keys": ["event_id"]}
    incremental_append(events.filter(some), target, "ts")
    incremental_append(events.filter(early), target, "ts", **window)
    incremental_append(events, target, "ts", **window)
    return incremental_append(events, target, "ts", **window)


_DIRTY_TIME = (
    "CASE WHEN event_id % 7 = 0 THEN 'Invalid-Time' WHEN event_id % 7 = 1 THEN 'NA' "
    "WHEN event_id % 49 = 2 THEN NULL ELSE CAST(ts AS STRING) END"
)
_DIRTY_EVENTS = f"SELECT event_id, {_DIRTY_TIME} AS ts, user_id FROM events"


def _dirty_text(spark, sf_dir, result="target"):
    """Text times with tokens that sort behind all digits, loaded in two steps."""
    events = _events(spark, sf_dir)
    dirty = events.selectExpr("event_id", f"{_DIRTY_TIME} AS TS", "user_id", "ts AS true_ts")
    target, undated = fresh_path(spark, "dirty"), fresh_path(spark, "undated")
    split = F.lit(_SPLIT).cast("timestamp_ntz")
    for rows in (dirty.filter(F.col("true_ts") <= split), dirty):
        rows = rows.drop("true_ts").withColumnRenamed("TS", "ts")
        loaded = incremental_append(rows, target, "Ts", undated_path=undated)
    return loaded if result == "target" else scan_parquet(spark, undated)


def _undated_default(spark, sf_dir):
    """Deliveries that hold new rows only, some without a time, and no place named for these."""
    events = _events(spark, sf_dir)
    rows = events.selectExpr("event_id", f"{_DIRTY_TIME} AS ts", "user_id")
    target = fresh_path(spark, "undated-default")
    early = F.col("event_id") % 2 == 0
    for delivery in (early, early, ~early):
        loaded = incremental_append(rows.filter(delivery), target, "ts", lookback=timedelta(days=9999))
    return loaded.unionByName(scan_parquet(spark, undated_default(target)))


def _incremental_text(spark, sf_dir):
    events = _events(spark, sf_dir).select("event_id", F.col("ts").cast("string"), "event_type")
    target = fresh_path(spark, "incremental-text")
    incremental_append(events.filter(F.col("ts") <= _SPLIT), target, "ts", delimited=True)
    return incremental_append(events, target, "ts", delimited=True)


def _watermark(spark, sf_dir):
    events = _events(spark, sf_dir)
    top = F.lit(high_watermark(events, "ts")).cast("timestamp_ntz")
    return events.filter(F.col("ts") == top).select("event_id", "ts")


def _delimited_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "bronze-text")
    write_delimited(_GAMES.frame(spark, sf_dir, *_GAME_COLUMNS), path)
    return scan_delimited(spark, path, GAMES.bronze)


def _delimited_unparsable(spark, sf_dir):
    path = fresh_path(spark, "bronze-teams")
    write_delimited(_TEAMS.frame(spark, sf_dir), path)
    return scan_delimited(spark, path, TEAM_STATISTICS.bronze)


def _delimited_table(spark, sf_dir):
    database, base = _database(spark)
    write_delimited(_GAMES.frame(spark, sf_dir, *_GAME_COLUMNS), f"{base}/games")
    return register_delimited(spark, f"{database}.games", f"{base}/games", GAMES.bronze)


def _headerless(spark, sf_dir):
    path = fresh_path(spark, "headerless")
    rows = _GAMES.frame(spark, sf_dir, *_GAME_COLUMNS)
    rows.write.options(nullValue="null", **_KEEP_SPACES).csv(path)
    return scan_headerless_csv(spark, path, GAMES.bronze)


def _with_header(spark, sf_dir):
    """A header in another order than the schema, with one unknown column."""
    path = fresh_path(spark, "header")
    rows = _PLAYERS.frame(spark, sf_dir, "draftNumber", "personId", "country", "height")
    rows.withColumn("remark", F.lit("a, b")).write.options(header=True, **_KEEP_SPACES).csv(path)
    return scan_csv_with_header(spark, path, PLAYERS.bronze)


_UGLY = (
    "CASE l_orderkey % 4 WHEN 0 THEN 'a \"b\", ' || l_linestatus WHEN 1 THEN 'two' || chr(10) || 'lines' "
    "WHEN 2 THEN 'back' || chr(92) || 'slash, ' || l_returnflag ELSE l_returnflag END"
)
_UGLY_LINES = f"""
    SELECT l_orderkey, l_linenumber, {_UGLY} AS remark,
           CAST(l_partkey AS STRING) || CASE WHEN l_partkey % 3 = 0 THEN '.0' ELSE '' END AS partkey
    FROM lineitem"""
_UGLY_SCHEMA = StructType(
    [
        StructField("l_orderkey", LongType()),
        StructField("l_linenumber", IntegerType()),
        StructField("remark", StringType()),
        StructField("partkey", LongType()),
    ]
)


def _ugly_lines(spark, sf_dir):
    lines = roles.load(spark, sf_dir, "lineitem")
    part = "CAST(l_partkey AS STRING) || CASE WHEN l_partkey % 3 = 0 THEN '.0' ELSE '' END"
    return lines.selectExpr("l_orderkey", "l_linenumber", f"{_UGLY} AS remark", f"{part} AS partkey")


def _quoted_fields(spark, sf_dir):
    """Doubled quotes, line breaks, separators and whole numbers with a fraction."""
    path = fresh_path(spark, "quoted")
    _ugly_lines(spark, sf_dir).write.options(header=True, escape='"', **_KEEP_SPACES).csv(path)
    return scan_csv_with_header(spark, path, _UGLY_SCHEMA, multiline=True)


def _header_case(spark, sf_dir):
    """A cutoff load of a file whose header has other capitals than the contract."""
    path = fresh_path(spark, "case")
    rows = _GAMES.frame(spark, sf_dir, "gameid", "gamedatetimeest")
    rows.toDF("GameId", "gameDateTimeEst").write.options(header=True, **_KEEP_SPACES).csv(path)
    return since_cutoff(scan_csv_with_header(spark, path, GAMES.bronze), "gameDateTimeEst", _CUTOFF)


def _delimited_escaped(spark, sf_dir):
    path = fresh_path(spark, "escaped")
    write_delimited(_ugly_lines(spark, sf_dir), path)
    return scan_delimited(spark, path, _UGLY_SCHEMA)


def _registered(spark, sf_dir):
    """Partitioned silver games, registered, then rebuilt with further years and columns."""
    database, base = _database(spark)
    # Written once, or each of the three runs would build silver anew.
    games = staged(silver_games(spark, sf_dir).silver.drop("silver_ingest_ts", "source_file"), "silver-games")
    first = games.filter(F.col("game_year") < 1996).drop("score_diff")
    for rows in (first, games.filter(F.col("game_year") < 1998), games):
        replace_parquet(rows, f"{base}/games", partition_by=["game_year"])
        register_external(spark, f"{database}.games_silver", f"{base}/games")
    return database


def _registered_silver(spark, sf_dir):
    return scan_table(spark, _registered(spark, sf_dir), "games_silver").select(
        "gameid", "game_year", "homescore", "score_diff"
    )


def _gold_from_registered(spark, sf_dir):
    games = scan_table(spark, _registered(spark, sf_dir), "games_silver")
    return gold.team_win_percentage(games)


def _parquet_overwrite(spark, sf_dir):
    path = fresh_path(spark, "overwrite")
    rows = roles.GAMES.frame(spark, sf_dir, "gameid", "game_year", "homeScore")
    write_parquet(rows, path, partition_by=["game_year"])
    write_parquet(rows.filter(F.col("homeScore") > 10), path, partition_by=["game_year"])
    return scan_parquet(spark, path, rows.schema)


def _append_sink(spark, sf_dir):
    path = fresh_path(spark, "append")
    suppliers = roles.load(spark, sf_dir, "supplier")
    write_parquet(suppliers, path, mode="append", num_partitions=2)
    write_parquet(suppliers.filter(F.col("s_acctbal") > 0), path, mode="append")
    return scan_parquet(spark, path)


def _database(spark):
    name = f"lodeworks_{uuid4().hex[:12]}"
    base = fresh_path(spark, name)
    ensure_database(spark, name, f"{base}/db")
    return name, base


def _full_refresh(spark, sf_dir):
    database, base = _database(spark)
    teams = roles.GAMES.frame(spark, sf_dir, "game_year", "homeTeamName", "homeScore")
    publish_table(teams, f"{database}.teams", base)
    best = teams.groupBy("game_year", "homeTeamName").agg(F.max("homeScore").alias("homeScore"))
    publish_table(best, f"{database}.teams", base)
    return scan_table(spark, database, "teams")


def _catalog_overwrite(spark, sf_dir):
    database, base = _database(spark)
    customers = roles.load(spark, sf_dir, "customer")
    overwrite_table(customers, f"{database}.customers", f"{base}/customers")
    overwrite_table(
        customers.select("c_custkey", "c_name"), f"{database}.customers", f"{base}/customers"
    )
    return scan_table(spark, database, "customers")


def _external_table(spark, sf_dir):
    database, base = _database(spark)
    orders = roles.load(spark, sf_dir, "orders")
    write_parquet(orders, f"{base}/orders")
    return register_external(spark, f"{database}.orders", f"{base}/orders")


def _lineage(spark, sf_dir):
    rows = with_lineage(roles.load(spark, sf_dir, "lineitem"))
    return rows.select(
        "l_orderkey", "l_linenumber", F.element_at(F.split(SOURCE_FILE, "/"), -1).alias("file_name")
    )


def _row_count_report(spark, sf_dir):
    tables = silver_games(spark, sf_dir)
    written = {"bronze": _GAMES.frame(spark, sf_dir, "gameid")}
    for layer, rows in (("silver", tables.silver), ("quarantine", tables.quarantine)):
        path = fresh_path(spark, layer)
        write_parquet(rows, path)
        written[layer] = scan_parquet(spark, path)
    return row_counts(written)


QUERIES = {
    "cutoff_load": _cutoff,
    "incremental_append": _incremental,
    "incremental_lookback": _incremental_lookback,
    "incremental_text": _incremental_text,
    "incremental_dirty_text": _dirty_text,
    "incremental_undated": lambda spark, sf_dir: _dirty_text(spark, sf_dir, "undated"),
    "incremental_undated_default": _undated_default,
    "csv_quoted_fields": _quoted_fields,
    "csv_header_case": _header_case,
    "delimited_escaped": _delimited_escaped,
    "silver_registered_partitioned": _registered_silver,
    "gold_from_registered_silver": _gold_from_registered,
    "watermark_rows": _watermark,
    "csv_bronze_roundtrip": _delimited_roundtrip,
    "csv_bronze_unparsable": _delimited_unparsable,
    "csv_bronze_table": _delimited_table,
    "csv_headerless_rename": _headerless,
    "csv_with_header": _with_header,
    "parquet_overwrite": _parquet_overwrite,
    "append_sink": _append_sink,
    "full_refresh": _full_refresh,
    "catalog_overwrite": _catalog_overwrite,
    "external_table": _external_table,
    "scan_lineage": _lineage,
    "row_count_report": _row_count_report,
}


_UGLY_SQL = f"""
    SELECT l_orderkey, l_linenumber, remark, CAST(trunc(CAST(partkey AS DECIMAL(38, 10))) AS BIGINT) AS partkey
    FROM ({_UGLY_LINES}) AS u"""


def _oracle():
    text = [
        field.name for field in GAMES.bronze.fields if field.dataType.simpleString() == "string"
    ]
    emptied = ", ".join(f"nullif({name}, '') AS {name}" for name in text)
    events = "SELECT event_id, ts, user_id, event_type, value, props FROM events"
    return {
        "cutoff_load": f"""
            SELECT gameid, try_cast(gamedatetimeest AS TIMESTAMP) AS gamedatetimeest
            FROM ({_GAMES.sql("gameid", "gamedatetimeest")}) AS b
            WHERE try_cast(gamedatetimeest AS TIMESTAMP) >= TIMESTAMP '{_CUTOFF} 00:00:00'""",
        "incremental_append": events,
        "incremental_lookback": events,
        "incremental_dirty_text": f"""
            SELECT event_id, ts, user_id FROM ({_DIRTY_EVENTS}) AS d
            WHERE try_cast(ts AS TIMESTAMP) IS NOT NULL""",
        "incremental_undated": f"""
            SELECT event_id, ts, user_id FROM ({_DIRTY_EVENTS}) AS d
            WHERE try_cast(ts AS TIMESTAMP) IS NULL""",
        "incremental_undated_default": _DIRTY_EVENTS,
        "incremental_text": "SELECT event_id, CAST(ts AS VARCHAR) AS ts, event_type FROM events",
        "csv_quoted_fields": _UGLY_SQL,
        "delimited_escaped": _UGLY_SQL,
        "csv_header_case": f"""
            SELECT gameid, try_cast(gamedatetimeest AS TIMESTAMP) AS gamedatetimeest
            FROM ({_GAMES.sql("gameid", "gamedatetimeest")}) AS b
            WHERE try_cast(gamedatetimeest AS TIMESTAMP) >= TIMESTAMP '{_CUTOFF} 00:00:00'""",
        "silver_registered_partitioned": f"""
            SELECT gameid, game_year, homescore, score_diff FROM ({SILVER_SQL["silver_games"]}) AS s""",
        "gold_from_registered_silver": f"""
            WITH g AS ({SILVER_SQL["silver_games"]}), sides AS (
                SELECT game_year, hometeamname AS team, homescore - awayscore AS margin FROM g
                UNION ALL SELECT game_year, awayteamname, awayscore - homescore FROM g
            )
            SELECT game_year, team AS "teamId",
                   sum(CASE WHEN margin > 0 THEN 1 ELSE 0 END)::BIGINT AS wins,
                   count(*) AS games_played,
                   sum(CASE WHEN margin > 0 THEN 1 ELSE 0 END)::DOUBLE / count(*) AS win_percentage
            FROM sides GROUP BY 1, 2""",
        "watermark_rows": """
            SELECT event_id, ts FROM events WHERE ts = (SELECT max(ts) FROM events)""",
        "csv_bronze_roundtrip": f"""
            SELECT * REPLACE ({emptied}) FROM ({_GAMES.sql(*_GAME_COLUMNS)}) AS b""",
        "csv_bronze_table": f"""
            SELECT * REPLACE ({emptied}) FROM ({_GAMES.sql(*_GAME_COLUMNS)}) AS b""",
        "csv_bronze_unparsable": cast_sql(TEAM_STATISTICS, _TEAMS),
        "csv_headerless_rename": f"""
            SELECT * REPLACE (nullif(awayteamname, 'null') AS awayteamname)
            FROM ({_GAMES.sql(*_GAME_COLUMNS)}) AS b""",
        "csv_with_header": f"""
            SELECT {number("draftNumber", "INT")} AS draftNumber,
                   try_cast(personId AS BIGINT) AS personId, country,
                   try_cast(height AS DOUBLE) AS height, 'a, b' AS remark
            FROM ({_PLAYERS.sql("draftNumber", "personId", "country", "height")}) AS b""",
        "parquet_overwrite": f"""
            SELECT * FROM ({roles.GAMES.sql("gameid", "game_year", "homeScore")}) AS g
            WHERE homeScore > 10""",
        "append_sink": """
            SELECT * FROM supplier UNION ALL SELECT * FROM supplier WHERE s_acctbal > 0""",
        "full_refresh": f"""
            SELECT game_year, homeTeamName, max(homeScore) AS homeScore
            FROM ({roles.GAMES.sql("game_year", "homeTeamName", "homeScore")}) AS g
            GROUP BY 1, 2""",
        "catalog_overwrite": "SELECT c_custkey, c_name FROM customer",
        "external_table": "SELECT * FROM orders",
        "scan_lineage": """
            SELECT l_orderkey, l_linenumber, 'lineitem.parquet' AS file_name FROM lineitem""",
        "row_count_report": f"""
            SELECT 'bronze' AS layer, count(*) AS row_count FROM lineitem UNION ALL
            SELECT 'silver', count(*) FROM ({SILVER_SQL["silver_games"]}) AS s UNION ALL
            SELECT 'quarantine', count(*) FROM ({SILVER_SQL["quarantine_games"]}) AS q""",
    }


ORACLE = _oracle()
