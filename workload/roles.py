"""The driver tables in the roles of the engine's five entities.

The driver tables are clean, so the bronze roles add dirt by fixed rules. Every
column is one expression in SQL that Spark and the checking database read alike,
which keeps the inputs of both sides the same by construction. A role joins only
the tables that the requested columns need.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

# name -> (driver table, column prefix, key of an already joined table, own key)
_LOOKUPS: dict[str, tuple[str, str, str, str]] = {
    "orders": ("orders", "o_", "l_orderkey", "o_orderkey"),
    "customer": ("customer", "c_", "o_custkey", "c_custkey"),
    "supplier": ("supplier", "s_", "l_suppkey", "s_suppkey"),
    "part": ("part", "p_", "l_partkey", "p_partkey"),
    "home": ("nation", "home_", "s_nationkey", "home_nationkey"),
    "away": ("nation", "away_", "c_nationkey", "away_nationkey"),
    "nation": ("nation", "n_", "c_nationkey", "n_nationkey"),
    "region": ("region", "r_", "n_regionkey", "r_regionkey"),
}
_RENAMED = ("home", "away")


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@dataclass(frozen=True)
class Role:
    base: str
    columns: dict[str, str]

    def _lookups(self, names: Iterable[str]) -> list[str]:
        text = " ".join(self.columns[name] for name in names)
        needed: list[str] = []

        def need(lookup: str) -> None:
            _, _, foreign, _ = _LOOKUPS[lookup]
            for other, (_, prefix, _, _) in _LOOKUPS.items():
                if foreign.startswith(prefix) and not self.base.startswith(other):
                    need(other)
            if lookup not in needed:
                needed.append(lookup)

        for lookup, (table, prefix, _, _) in _LOOKUPS.items():
            if table != self.base and re.search(rf"\b{prefix}", text):
                need(lookup)
        return needed

    def frame(self, spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
        """The role as a DataFrame with the named (default: all) columns."""
        names = names or tuple(self.columns)
        tables = {}
        for lookup in self._lookups(names):
            table, prefix, _, _ = _LOOKUPS[lookup]
            tables[lookup] = load(spark, sf_dir, table)
            if lookup in _RENAMED:
                tables[lookup] = tables[lookup].toDF(
                    *(c.replace("n_", prefix, 1) for c in tables[lookup].columns)
                )

        def joined(left: DataFrame, lookup: str) -> DataFrame:
            _, _, foreign, own = _LOOKUPS[lookup]
            return left.join(tables.pop(lookup), F.col(foreign) == F.col(own))

        # Customers go to their orders first, so that lines are shuffled once for both.
        if "orders" in tables and "customer" in tables:
            tables["orders"] = joined(tables["orders"], "customer")
        df = load(spark, sf_dir, self.base)
        for lookup in list(tables):
            df = joined(df, lookup)
        return df.selectExpr(*(f"{self.columns[name]} AS {name}" for name in names))

    def sql(self, *names: str) -> str:
        """The same as a SELECT statement."""
        names = names or tuple(self.columns)
        joins = []
        for lookup in self._lookups(names):
            table, prefix, foreign, own = _LOOKUPS[lookup]
            source = table
            if lookup in _RENAMED:
                source = (
                    f"(SELECT n_nationkey AS {prefix}nationkey, n_name AS {prefix}name "
                    f"FROM nation) AS {lookup}"
                )
            joins.append(f"JOIN {source} ON {foreign} = {own}")
        listed = ", ".join(f"{self.columns[name]} AS {name}" for name in names)
        return f"SELECT {listed} FROM {self.base} {' '.join(joins)}"


def _counts(names: tuple[str, ...], start: int) -> dict[str, str]:
    """Whole numbers as text, each column with its own spread."""
    return {
        name: f"CAST((l_partkey + {i}) % {7 + i} AS STRING)"
        for i, name in enumerate(names, start)
    }


# -- tidy roles: what the gold and star steps read --------------------------

GAMES = Role(
    "lineitem",
    {
        "gameid": "l_orderkey * 8 + l_linenumber",
        "game_year": "CAST(extract(YEAR FROM l_shipdate) AS INT)",
        "game_date": "CAST(l_shipdate AS DATE)",
        "game_month": "CAST(extract(MONTH FROM l_shipdate) AS INT)",
        "game_ts": "CAST(l_shipdate AS TIMESTAMP)",
        "homeTeamName": "home_name",
        "awayTeamName": "away_name",
        "homeScore": "CAST(l_quantity AS INT)",
        "awayScore": "p_size",
        "gametype": "l_returnflag",
        "attendance": "CAST(floor(l_extendedprice) AS INT)",
        "arenaid": "l_suppkey",
        "home_win": "CASE WHEN CAST(l_quantity AS INT) > p_size THEN 1 ELSE 0 END",
        "away_win": "CASE WHEN p_size > CAST(l_quantity AS INT) THEN 1 ELSE 0 END",
        "winner": (
            "CASE WHEN CAST(l_quantity AS INT) > p_size THEN s_nationkey ELSE c_nationkey END"
        ),
        "partkey": "l_partkey",
        "suppkey": "l_suppkey",
        "price": "l_extendedprice",
    },
)

PLAYER_STATISTICS = Role(
    "lineitem",
    {
        "personId": "o_custkey",
        "gameId": "l_orderkey",
        "firstName": "substring(c_name, 1, 8)",
        "lastName": "substring(c_name, 10, 9)",
        "playerteamName": "home_name",
        "playerteamCity": "lower(home_name)",
        "opponentteamName": "away_name",
        "opponentteamCity": "lower(away_name)",
        "game_date": "CAST(l_shipdate AS DATE)",
        "game_year": "CAST(extract(YEAR FROM l_shipdate) AS INT)",
        "game_month": "CAST(extract(MONTH FROM l_shipdate) AS INT)",
        "home": "l_linenumber % 2",
        "win": "CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END",
        "numMinutes": "CAST(p_size AS DOUBLE)",
        "points": "l_quantity",
        "assists": "CAST(l_linenumber AS DOUBLE)",
        "blocks": "CAST(l_partkey % 4 AS DOUBLE)",
        "steals": "CAST(l_suppkey % 5 AS DOUBLE)",
        "reboundsOffensive": "CAST(l_linenumber % 3 AS DOUBLE)",
        "reboundsDefensive": "CAST(p_size % 10 AS DOUBLE)",
        "reboundstotal": "CAST(l_linenumber % 3 + p_size % 10 AS DOUBLE)",
        "fieldGoalsPercentage": "l_discount * 100",
        "threePointersPercentage": "l_tax * 100",
        "freeThrowsPercentage": "CAST(l_partkey % 101 AS DOUBLE)",
    },
)

# -- bronze roles: untidy text, holes, repeats ------------------------------

BRONZE_GAMES = Role(
    "lineitem",
    {
        "gameid": "CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE l_orderkey * 8 + l_linenumber END",
        "gamedatetimeest": (
            "CASE WHEN l_partkey % 41 = 7 THEN 'Invalid-Time' "
            "WHEN l_partkey % 43 = 5 THEN '1900-05-05 10:00:00' "
            "WHEN l_partkey % 47 = 5 THEN 'NA' ELSE CAST(l_shipdate AS STRING) END"
        ),
        "hometeamcity": (
            "CASE WHEN l_orderkey % 11 = 0 THEN 'NA' WHEN l_orderkey % 11 = 1 THEN '' "
            "WHEN l_orderkey % 11 = 2 THEN ' NULL ' ELSE '  ' || lower(home_name) || ' ' END"
        ),
        "hometeamname": (
            "CASE WHEN l_orderkey % 13 = 0 THEN 'nul' ELSE ' ' || lower(home_name) || ' ' END"
        ),
        "hometeamid": (
            "CASE WHEN l_partkey % 83 = 1 THEN NULL ELSE CAST(s_nationkey AS BIGINT) END"
        ),
        "awayteamcity": "lower(away_name) || '   '",
        "awayteamname": (
            "CASE WHEN l_orderkey % 17 = 0 THEN 'NULL' WHEN l_orderkey % 17 = 1 THEN 'null' "
            "ELSE lower(away_name) END"
        ),
        "awayteamid": "CAST(c_nationkey AS BIGINT)",
        "homescore": (
            "CASE WHEN l_partkey % 61 = 0 THEN -10 WHEN l_partkey % 61 = 1 THEN NULL "
            "ELSE CAST(l_quantity AS INT) END"
        ),
        "awayscore": "p_size",
        "winner": (
            "CASE WHEN l_quantity > p_size THEN s_nationkey ELSE c_nationkey END"
        ),
        "gametype": (
            "CASE l_linenumber % 3 WHEN 0 THEN ' reg ' WHEN 1 THEN 'Playoff' ELSE 'NA' END"
        ),
        "attendance": (
            "CASE WHEN l_partkey % 29 = 0 THEN NULL "
            "ELSE CAST(floor(l_extendedprice) AS INT) % 31000 END"
        ),
        "arenaid": "CASE WHEN l_suppkey % 71 = 3 THEN NULL ELSE l_suppkey END",
        "gamelabel": "l_returnflag",
        "gamesublabel": "CASE WHEN l_linestatus = 'F' THEN '' ELSE l_linestatus END",
        "seriesgamenumber": "l_linenumber",
        "season": (
            "CASE WHEN l_partkey % 37 = 0 THEN NULL WHEN l_partkey % 37 = 1 THEN '19xx' "
            "WHEN l_partkey % 37 = 2 "
            "THEN CAST(CAST(extract(YEAR FROM l_shipdate) AS INT) AS STRING) || '.0' "
            "ELSE CAST(CAST(extract(YEAR FROM l_shipdate) AS INT) AS STRING) END"
        ),
    },
)
BRONZE_GAMES_COLUMNS = tuple(name for name in BRONZE_GAMES.columns if name != "season")

BRONZE_PLAYERS = Role(
    "orders",
    {
        "personId": "CASE WHEN o_orderkey % 53 = 0 THEN '' ELSE CAST(o_custkey AS STRING) END",
        "firstName": "'  ' || lower(substring(c_name, 1, 8)) || ' van '",
        "lastName": (
            "CASE WHEN o_orderkey % 19 = 0 THEN 'NA' "
            "ELSE upper(substring(c_name, 1, 4)) || ' o''neal ' END"
        ),
        "birthdate": (
            "CASE WHEN o_orderkey % 23 = 0 THEN 'unknown' WHEN o_orderkey % 23 = 1 THEN 'nul' "
            "ELSE ' ' || substring(CAST(o_orderdate AS STRING), 1, 10) END"
        ),
        "lastAttended": "CASE WHEN o_orderkey % 7 = 0 THEN 'NA' ELSE ' ' || o_orderpriority END",
        "country": "lower(n_name) || ' '",
        "height": (
            "CASE WHEN o_orderkey % 31 = 0 THEN '5' WHEN o_orderkey % 31 = 1 THEN 'tall' "
            "WHEN o_orderkey % 31 = 2 THEN '280' "
            "ELSE CAST(150 + o_orderkey % 80 AS STRING) || '.5' END"
        ),
        "bodyWeight": (
            "CASE WHEN o_orderkey % 59 = 3 THEN '0' ELSE CAST(60 + o_custkey % 90 AS STRING) END"
        ),
        "guard": (
            "CASE o_orderkey % 5 WHEN 0 THEN ' TRUE ' WHEN 1 THEN 'no' WHEN 2 THEN 'NA' "
            "WHEN 3 THEN '' ELSE 'f' END"
        ),
        "forward": "CASE o_orderkey % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN '0' ELSE 'maybe' END",
        "center": "CASE o_custkey % 4 WHEN 0 THEN '1' WHEN 1 THEN 'T' ELSE NULL END",
        "draftYear": (
            "CASE WHEN o_orderkey % 9 = 0 THEN 'undrafted' "
            "ELSE CAST(1990 + o_orderkey % 30 AS STRING) END"
        ),
        "draftRound": "CASE WHEN o_orderkey % 9 = 0 THEN 'NA' ELSE '1' END",
        "draftNumber": (
            "CASE WHEN o_orderkey % 8 = 3 THEN CAST(o_orderkey % 60 AS STRING) || '.7' "
            "WHEN o_orderkey % 8 = 4 THEN '1e1x' ELSE CAST(o_orderkey % 60 AS STRING) END"
        ),
    },
)

BRONZE_PLAYER_STATISTICS = Role(
    "lineitem",
    {
        "firstName": "' ' || substring(c_name, 1, 8)",
        "lastName": (
            "CASE WHEN l_orderkey % 29 = 0 THEN 'NULL' ELSE substring(c_name, 10, 9) || ' ' END"
        ),
        "personId": "CASE WHEN l_partkey % 67 = 0 THEN NULL ELSE o_custkey END",
        "gameId": "CASE WHEN l_partkey % 71 = 0 THEN NULL ELSE l_orderkey END",
        "gameDateTimeEst": (
            "CASE WHEN l_partkey % 73 = 0 THEN 'soon' ELSE CAST(l_shipdate AS STRING) END"
        ),
        "playerteamCity": "lower(home_name) || ' '",
        "playerteamName": (
            "CASE WHEN l_orderkey % 37 = 0 THEN 'nul' ELSE ' ' || lower(home_name) || ' ' END"
        ),
        "opponentteamCity": "' ' || lower(away_name)",
        "opponentteamName": "lower(away_name)",
        "gameType": "CASE WHEN l_linestatus = 'O' THEN ' regular' ELSE 'NA' END",
        "gameLabel": "l_returnflag",
        "gameSubLabel": "CASE WHEN l_returnflag = 'N' THEN '' ELSE l_linestatus END",
        "seriesGameNumber": "l_linenumber",
        "win": "CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END",
        "home": "l_linenumber % 2",
        "numMinutes": (
            "CASE WHEN l_partkey % 13 = 0 THEN CAST(0 AS DOUBLE) "
            "WHEN l_partkey % 13 = 1 THEN NULL ELSE CAST(p_size AS DOUBLE) END"
        ),
        "points": "CASE WHEN l_partkey % 79 = 0 THEN CAST(-5 AS DOUBLE) ELSE l_quantity END",
        "assists": "CASE WHEN l_partkey % 79 = 1 THEN NULL ELSE CAST(l_linenumber AS DOUBLE) END",
        "blocks": "CAST(l_partkey % 4 AS DOUBLE)",
        "steals": "CAST(l_suppkey % 5 AS DOUBLE)",
        "fieldGoalsAttempted": "CAST(l_partkey % 20 AS DOUBLE)",
        "fieldGoalsMade": "CAST(l_partkey % 10 AS DOUBLE)",
        "fieldGoalsPercentage": "CAST(l_partkey % 104 AS DOUBLE)",
        "threePointersAttempted": "CAST(l_suppkey % 9 AS DOUBLE)",
        "threePointersMade": "CAST(l_suppkey % 4 AS DOUBLE)",
        "threePointersPercentage": (
            "CASE WHEN l_suppkey % 11 = 0 THEN NULL ELSE CAST(l_suppkey % 100 AS DOUBLE) END"
        ),
        "freeThrowsAttempted": "CAST(l_linenumber AS DOUBLE)",
        "freeThrowsMade": "CAST(l_linenumber % 4 AS DOUBLE)",
        "freeThrowsPercentage": "CAST(p_size AS DOUBLE)",
        "reboundsDefensive": "CAST(p_size % 10 AS DOUBLE)",
        "reboundsOffensive": "CAST(l_linenumber % 3 AS DOUBLE)",
        "reboundsTotal": "CAST(l_linenumber % 3 + p_size % 10 AS DOUBLE)",
        "foulsPersonal": "CAST(l_partkey % 6 AS DOUBLE)",
        "turnovers": "CAST(l_suppkey % 6 AS DOUBLE)",
        "plusMinusPoints": "l_quantity - p_size",
    },
)

BRONZE_TEAM_HISTORIES = Role(
    "customer",
    {
        "teamId": (
            "CASE WHEN c_custkey % 41 = 0 THEN 'NULL' ELSE CAST(c_nationkey AS STRING) END"
        ),
        "teamCity": (
            "CASE WHEN c_custkey % 6 = 0 THEN 'NA' "
            "ELSE ' ' || lower(c_mktsegment) || ' ' || lower(r_name) || ' ' END"
        ),
        "teamName": (
            "CASE WHEN c_custkey % 31 = 2 THEN '' "
            "ELSE ' ' || lower(n_name) || '-' || CAST(c_custkey AS STRING) END"
        ),
        "teamAbbrev": "lower(substring(r_name, 1, 3))",
        "seasonFounded": (
            "CASE WHEN c_custkey % 17 = 0 THEN '1800' WHEN c_custkey % 17 = 1 THEN 'long ago' "
            "WHEN c_custkey % 17 = 2 THEN '2031' ELSE CAST(1900 + c_custkey % 120 AS STRING) END"
        ),
        "seasonActiveTill": (
            "CASE WHEN c_custkey % 5 = 0 THEN NULL "
            "WHEN c_custkey % 5 = 1 THEN CAST(1950 + c_custkey % 100 AS STRING) || '.0' "
            "ELSE CAST(1950 + c_custkey % 100 AS STRING) END"
        ),
        "league": "' ' || lower(r_name)",
    },
)

BRONZE_TEAM_STATISTICS = Role(
    "lineitem",
    {
        "gameId": (
            "CASE WHEN l_partkey % 67 = 0 THEN 'x1' "
            "WHEN l_partkey % 67 = 1 THEN CAST(l_orderkey AS STRING) || '.0' "
            "ELSE CAST(l_orderkey AS STRING) END"
        ),
        "gameDateTimeEst": (
            "CASE WHEN l_partkey % 73 = 0 THEN 'nul' ELSE CAST(l_shipdate AS STRING) END"
        ),
        "teamCity": "' ' || lower(home_name)",
        "teamName": "CASE WHEN l_orderkey % 43 = 0 THEN 'NULL' ELSE lower(home_name) || ' ' END",
        "teamId": (
            "CASE WHEN l_partkey % 61 = 0 THEN '' "
            "WHEN l_partkey % 61 = 1 THEN CAST(s_nationkey AS STRING) || '.0' "
            "ELSE CAST(s_nationkey AS STRING) END"
        ),
        "opponentTeamCity": "'opp ' || lower(home_name)",
        "opponentTeamName": "' rival of ' || lower(home_name)",
        "opponentTeamId": "CAST((s_nationkey + 1) % 25 AS STRING)",
        "home": "CAST(l_linenumber % 2 AS STRING)",
        "win": "CASE WHEN l_quantity > p_size THEN '1' ELSE '0' END",
        "teamScore": (
            "CASE WHEN l_partkey % 53 = 0 THEN 'n/a' WHEN l_partkey % 53 = 1 THEN '-7' "
            "ELSE CAST(CAST(l_quantity AS INT) AS STRING) END"
        ),
        "opponentScore": (
            "CASE WHEN l_partkey % 59 = 1 THEN CAST(p_size AS STRING) || '.7' "
            "ELSE CAST(p_size AS STRING) END"
        ),
        **_counts(("assists", "blocks", "steals"), 0),
        "fieldGoalsAttempted": "CAST(l_suppkey % 20 AS STRING)",
        "fieldGoalsMade": "CAST(l_suppkey % 10 AS STRING)",
        "fieldGoalsPercentage": (
            "CASE WHEN l_partkey % 19 = 0 THEN 'half' ELSE CAST(l_partkey % 103 AS STRING) END"
        ),
        **_counts(("threePointersAttempted", "threePointersMade"), 3),
        "threePointersPercentage": "CAST(l_suppkey % 100 AS STRING) || '.5'",
        **_counts(("freeThrowsAttempted", "freeThrowsMade"), 5),
        "freeThrowsPercentage": "CAST(l_linenumber * 10 AS STRING)",
        **_counts(
            (
                "reboundsDefensive",
                "reboundsOffensive",
                "reboundsTotal",
                "foulsPersonal",
                "turnovers",
                "plusMinusPoints",
                "numMinutes",
                "q1Points",
                "q2Points",
                "q3Points",
                "q4Points",
                "benchPoints",
                "biggestLead",
                "biggestScoringRun",
                "leadChanges",
                "pointsFastBreak",
                "pointsFromTurnovers",
                "pointsInThePaint",
                "pointsSecondChance",
                "timesTied",
                "timeoutsRemaining",
                "seasonWins",
                "seasonLosses",
                "coachId",
            ),
            7,
        ),
    },
)
