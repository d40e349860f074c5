"""Gold aggregates, dimensions and fact on small inputs."""

from datetime import date

import pytest

from build import values
from lodeworks.operators.checks import assert_tables_equal
from lodeworks.plans import gold, star

STATS = [
    # game, year, person, first, last, team, points, assists, rebounds, blocks, steals
    ("g1", 2020, 1, "Ann", "Low", "OWLS", 10, 4, 6, 1, 0),
    ("g2", 2020, 1, "Ann", "Low", "OWLS", 20, 5, 5, 0, 2),
    ("g3", 2021, 1, "Ann", "Low", "BEES", 31, 7, 9, 2, 2),
    ("g1", 2020, 2, "Bo", None, "OWLS", 8, 1, 2, 0, 0),
    (None, 2020, 3, "Cy", "Tan", "OWLS", 5, 1, 1, 0, 0),
    ("g4", None, 2, "Bo", None, "BEES", None, 2, None, 0, 0),
]
STATS_SCHEMA = (
    "gameId string, game_year int, personId int, firstName string, lastName string, "
    "playerteamName string, points int, assists int, reboundstotal int, blocks int, steals int"
)
GAMES = [
    ("g1", 2020, "OWLS", "BEES", 100, 90),
    ("g2", 2020, "BEES", "OWLS", 80, 89),
    ("g3", 2021, "OWLS", "CATS", 70, 70),
    ("g4", 2021, "CATS", "CATS", 95, 60),
    ("g5", 2021, "OWLS", "BEES", None, 60),
]
GAMES_SCHEMA = (
    "gameId string, game_year int, homeTeamName string, awayTeamName string, "
    "homeScore int, awayScore int"
)


@pytest.fixture(scope="module")
def stats(spark):
    return spark.createDataFrame(STATS, STATS_SCHEMA)


@pytest.fixture(scope="module")
def games(spark):
    return spark.createDataFrame(GAMES, GAMES_SCHEMA)


def test_points_per_game(stats):
    df = gold.player_per_game(stats, "points")
    assert df.columns == [
        "personId", "playerName", "total_points", "games_played", "points_per_game",
    ]
    assert values(df, *df.columns) == [(1, "Ann Low", 61, 3, 61 / 3), (2, "Bo", 8, 2, 4.0)]


def test_season_totals_keep_missing_years_and_sums(stats):
    df = gold.player_season_totals(stats, "points")
    assert values(df, "game_year", "personId", "total_points") == [
        (2020, 1, 30), (2020, 2, 8), (2020, 3, 5), (2021, 1, 31), (None, 2, None),
    ]


def test_rebounds_per_season_are_ordered(stats):
    rows = gold.player_season_totals(stats, "rebounds").collect()
    assert [(r.game_year, r.total_rebounds) for r in rows] == [
        (None, None), (2020, 11), (2020, 2), (2020, 1), (2021, 9),
    ]


def test_win_percentage_counts_both_sides(games):
    df = gold.team_win_percentage(games)
    assert values(df, *df.columns) == [
        (2020, "BEES", 0, 2, 0.0),
        (2020, "OWLS", 2, 2, 1.0),
        (2021, "BEES", 0, 1, 0.0),
        (2021, "CATS", 1, 3, 1 / 3),
        (2021, "OWLS", 0, 2, 0.0),
    ]


def test_double_digit_wins_keep_zeros_and_order(games):
    rows = gold.team_double_digit_wins(games).collect()
    assert [tuple(r) for r in rows] == [
        (2020, "OWLS", 1), (2020, "BEES", 0), (2021, "CATS", 1), (2021, "BEES", 0),
        (2021, "OWLS", 0),
    ]


def test_shared_aggregates_give_the_same_tables(stats, games):
    direct = gold.gold_tables(stats, games)
    shared = gold.gold_tables_from_seasons(
        gold.player_seasons(stats), gold.team_seasons(games)
    )
    assert list(direct) == list(shared) and len(direct) == 8
    for name in direct:
        assert_tables_equal(shared[name], direct[name])


def test_slice_of_one_team_and_season(stats):
    df = gold.slice_summary(stats, "OWLS", 2020)
    columns = ("personId", "total_points_2020", "games_played_2020", "blocks_per_game_2020")
    assert values(df, *columns) == [(1, 30, 2, 0.5), (2, 8, 1, 0.0)]
    points = gold.slice_points(stats, "OWLS", 2020)
    assert points.columns == [
        "personid", "playerName", "points", "gameid", "points_per_game_2020",
    ]
    assert values(points, *points.columns)[0] == (1, "Ann Low", 30, 2, 15.0)


LINES = [
    # game, person, team, offensive, defensive
    (1, 1, "OWLS", 2.0, 3.0),
    (1, 2, "OWLS", None, 3.0),
    (1, 3, None, 1.0, 1.0),
    (2, 1, "BEES", 1.0, 1.0),
]


def _lines(spark):
    names = [
        "playerteamcity", "opponentteamname", "opponentteamcity", "game_date", "game_year",
        "game_month", "home", "win", "points", "assists", "steals", "blocks", "numminutes",
        "fieldgoalspercentage", "threepointerspercentage", "freethrowspercentage",
    ]
    schema = (
        "gameId long, personId long, playerteamName string, reboundsOffensive double, "
        "reboundsDefensive double"
    )
    return spark.createDataFrame(LINES, schema).selectExpr("*", *(f"1 AS {n}" for n in names))


def _teams(spark, rows):
    others = [name for name in star.FACT_FROM_TEAMS if name != "score_diff"]
    df = spark.createDataFrame(rows, "gameId long, teamName string, score_diff int")
    return df.selectExpr("*", *(f"1 AS {n}" for n in others))


def test_fact_keeps_unmatched_lines(spark):
    fact = star.fact_stats(_lines(spark), _teams(spark, [(1, "OWLS", 9), (2, "CATS", 4)]))
    assert fact.columns == list(star.FACT_COLUMNS) and len(fact.columns) == 28
    assert values(fact, "gameid", "personid", "rebounds", "score_diff") == [
        (1, 1, 5.0, 9), (1, 2, None, 9), (1, 3, 2.0, None), (2, 1, 2.0, None),
    ]


def test_fact_fans_out_on_repeated_team_names(spark):
    fact = star.fact_stats(_lines(spark), _teams(spark, [(2, "BEES", 1), (2, "BEES", 2)]))
    assert fact.count() == 5


def test_fact_with_games_multiplies_only_repeated_ids(spark):
    teams = _teams(spark, [(1, "OWLS", 9)])
    unique = spark.createDataFrame([(1,), (3,)], "gameid long")
    assert_tables_equal(
        star.fact_stats(_lines(spark), teams, unique), star.fact_stats(_lines(spark), teams)
    )
    repeated = spark.createDataFrame([(2,), (2,)], "gameid long")
    assert star.fact_stats(_lines(spark), teams, repeated).count() == 5


def test_dates_repeat_unless_distinct(spark):
    day = date(2021, 1, 3)
    games = spark.createDataFrame(
        [(day, 2021, 1), (day, 2021, 1)], "game_date date, game_year int, game_month int"
    )
    assert values(star.dim_dates(games), "game_date", "week", "quarter_of_year") == [
        (day, 53, 1), (day, 53, 1),
    ]
    assert star.dim_dates(games, distinct=True).count() == 1
