"""The rules of each entity on small inputs."""

from datetime import date, datetime

import pytest

from build import bronze, silver, values
from lodeworks.contracts import (
    GAMES,
    GAMES_BY_SEASON,
    PLAYER_STATISTICS,
    PLAYERS,
    TEAM_HISTORIES,
    TEAM_STATISTICS,
)
from lodeworks.contracts.team_statistics import NOT_IN_SILVER
from lodeworks.plans.silver import build_silver


def game(game_id, **other):
    return {
        "gameid": game_id,
        "gamedatetimeest": "2021-03-04 19:30:00",
        "hometeamid": 10,
        "awayteamid": 20,
        "arenaid": 5,
        "homescore": 101,
        "awayscore": 99,
        **other,
    }


def line(person, game_id, **other):
    stamp = "2022-11-05 18:00:00"
    return {"personId": person, "gameId": game_id, "gameDateTimeEst": stamp, **other}


def team(game_id, team_id, **other):
    base = {"gameDateTimeEst": "2022-11-05 18:00:00", "teamScore": 90, "opponentScore": 80}
    return {"gameId": game_id, "teamId": team_id, **base, **other}


# -- games -----------------------------------------------------------------


def test_games_null_tokens_and_bad_time(spark):
    out = silver(
        spark,
        GAMES,
        game(1, hometeamname="nul", awayteamname="NULL", hometeamcity="", gametype="NA"),
        game(2, gamedatetimeest="not a time"),
        game(3, hometeamname="null", awayteamname=" NULL "),
    )
    assert values(out.silver, "gameid", "hometeamname", "awayteamname", "hometeamcity") == [
        (1, None, None, None),
        (3, "NULL", " NULL ", None),
    ]
    assert out.quarantine.count() == 0


def test_games_missing_keys_keep_their_raw_text(spark):
    out = silver(
        spark,
        GAMES,
        game(1),
        game(2, hometeamid=None, hometeamcity=" Rome "),
        game(3, arenaid=None),
        game(None),
    )
    assert values(out.silver, "gameid") == [(1,)]
    assert values(out.quarantine, "gameid", "hometeamcity", "quarantine_reason") == [
        (2, " Rome ", "MISSING_KEY_FIELDS"),
        (3, None, "MISSING_KEY_FIELDS"),
        (None, None, "MISSING_KEY_FIELDS"),
    ]
    assert "silver_ingest_ts" not in out.quarantine.columns


def test_games_trim_and_case(spark):
    out = silver(
        spark, GAMES, game(1, hometeamcity="  Rome ", hometeamname=" wolves ", gametype=" cup ")
    )
    assert values(out.silver, "hometeamcity", "hometeamname", "gametype") == [
        ("Rome", " WOLVES ", "CUP")
    ]


def test_games_outcome(spark):
    out = silver(
        spark,
        GAMES,
        game(1, homescore=90, awayscore=70),
        game(2, homescore=70, awayscore=85),
        game(3, homescore=77, awayscore=77),
    )
    assert values(out.silver, "gameid", "home_win", "away_win", "score_diff") == [
        (1, 1, 0, 20),
        (2, 0, 1, -15),
        (3, 0, 0, 0),
    ]


IMPLAUSIBLE = (
    game(2, homescore=-1),
    game(3, awayscore=None),
    game(4, attendance=30001),
    game(5, gamedatetimeest="1945-12-31 20:00:00"),
    game(6, gamedatetimeest="2101-01-01 20:00:00"),
)


def test_games_implausible_rows_vanish(spark):
    out = silver(spark, GAMES, game(1, attendance=30000), *IMPLAUSIBLE)
    assert values(out.silver, "gameid") == [(1,)]
    assert out.quarantine.count() == 0


def test_games_implausible_rows_can_be_kept(spark):
    out = silver(
        spark, GAMES, game(1), *IMPLAUSIBLE, on_invalid="quarantine", on_unknown="quarantine"
    )
    assert values(out.silver, "gameid") == [(1,)]
    assert values(out.quarantine, "gameid", "quarantine_reason") == [
        (i, "INVALID_NUMERIC_RANGE") for i in range(2, 7)
    ]


def test_games_latest_wins_and_ties_are_settled(spark):
    rows = (
        game(1, gamedatetimeest="2021-03-04 10:00:00", homescore=1),
        game(1, gamedatetimeest="2021-03-04 12:00:00", homescore=2),
        game(2, homescore=7),
        game(2, homescore=8),
    )
    for order in (rows, rows[::-1]):
        assert values(silver(spark, GAMES, *order).silver, "gameid", "homescore") == [
            (1, 2),
            (2, 8),
        ]


def test_games_columns_in_order(spark):
    out = silver(spark, GAMES, game(1))
    dates = ["game_ts", "game_date", "game_year", "game_month"]
    derived = ["home_win", "away_win", "score_diff", "silver_ingest_ts", "source_file"]
    assert out.silver.columns == GAMES.bronze.fieldNames() + dates + derived
    assert out.quarantine.columns == GAMES.bronze.fieldNames() + dates + ["quarantine_reason"]
    assert values(out.silver, *dates) == [
        (datetime(2021, 3, 4, 19, 30), date(2021, 3, 4), 2021, 3)
    ]


def test_games_by_season_judges_the_season(spark):
    old = {"gamedatetimeest": "1900-01-01 00:00:00"}
    out = silver(
        spark,
        GAMES_BY_SEASON,
        game(1, season=2020, **old),
        game(2, season=1900),
        game(3, season=None),
    )
    assert values(out.silver, "gameid", "season") == [(1, 2020)]


def test_columns_are_found_in_any_case(spark):
    rows = bronze(spark, GAMES, game(1, gametype=" cup "))
    upper = rows.toDF(*(name.upper() for name in rows.columns))
    assert values(build_silver(upper, GAMES).silver, "gameid", "gametype") == [(1, "CUP")]


def test_missing_input_column_is_named(spark):
    rows = bronze(spark, GAMES, game(1)).drop("arenaid")
    with pytest.raises(ValueError, match="arenaid"):
        build_silver(rows, GAMES)


# -- players ---------------------------------------------------------------


def test_players_text_dates_and_age(spark):
    out = silver(
        spark,
        PLAYERS,
        {
            "personId": 1,
            "firstName": "  mARY ann ",
            "lastName": "o'neil",
            "birthdate": " 1994-06-30 ",
            "country": "peru ",
            "lastAttended": " lima u",
        },
        {"personId": 2, "birthdate": "30/06/1994"},
    )
    names = ("personId", "firstName", "lastName", "country", "lastAttended")
    assert values(out.silver, *names) == [
        (1, "Mary Ann", "O'neil", "PERU", "LIMA U"),
        (2, None, None, None, None),
    ]
    dates = values(out.silver, "personId", "birth_date", "birth_year", "age_years")
    assert dates[0][:3] == (1, date(1994, 6, 30), 1994)
    assert dates[0][3] == pytest.approx(10958 / 365.25)
    assert dates[1] == (2, None, None, None)


@pytest.mark.parametrize(
    ("guard", "forward", "center", "expected"),
    [
        ("true", "true", None, (1, 1, 0, "G")),
        ("no", " YES ", "1", (0, 1, 1, "F")),
        ("maybe", "", "T", (0, 0, 1, "C")),
        (None, "NA", "0", (0, 0, 0, None)),
    ],
)
def test_players_position(spark, guard, forward, center, expected):
    out = silver(
        spark, PLAYERS, {"personId": 1, "guard": guard, "forward": forward, "center": center}
    )
    columns = ("guard_flag", "forward_flag", "center_flag", "primary_position")
    assert values(out.silver, *columns) == [expected]


def test_players_position_text_keeps_tokens(spark):
    out = silver(spark, PLAYERS, {"personId": 1, "guard": "NA", "forward": "", "country": "NA"})
    assert values(out.silver, "guard", "forward", "country") == [("NA", "", None)]


def test_players_routing_and_tags(spark):
    out = silver(
        spark,
        PLAYERS,
        {"personId": 1, "height": 200.0, "bodyWeight": 99.0},
        {"personId": 2, "height": 10.0},
        {"personId": 3, "height": 280.0},
        {"personId": 4, "bodyWeight": 0.0},
        {"personId": None, "height": 5.0},
    )
    assert values(out.silver, "personId", "record_source") == [(1, "NBA_PLAYERS_BRONZE")]
    assert values(out.quarantine, "personId", "quarantine_reason", "record_source") == [
        (2, "INVALID_NUMERIC_RANGE", "NBA_PLAYERS_BRONZE"),
        (3, "INVALID_NUMERIC_RANGE", "NBA_PLAYERS_BRONZE"),
        (4, "INVALID_NUMERIC_RANGE", "NBA_PLAYERS_BRONZE"),
        (None, "MISSING_PERSON_ID", "NBA_PLAYERS_BRONZE"),
    ]
    audit = ["record_source", "silver_ingest_ts", "source_file"]
    assert out.silver.columns[-3:] == audit
    assert out.quarantine.columns[-4:] == ["quarantine_reason", *audit]


def test_players_youngest_then_latest_draft(spark):
    out = silver(
        spark,
        PLAYERS,
        {"personId": 1, "birthdate": "1980-01-01", "draftYear": 2005},
        {"personId": 1, "birthdate": "1990-01-01", "draftYear": 2010},
        {"personId": 1, "birthdate": "1990-01-01", "draftYear": 2012},
        {"personId": 1, "birthdate": None, "draftYear": 2020},
    )
    assert values(out.silver, "birth_year", "draftYear") == [(1990, 2012)]


# -- player statistics -----------------------------------------------------


def test_lines_text_and_dates(spark):
    out = silver(
        spark,
        PLAYER_STATISTICS,
        line(1, 7, firstName=" ann ", playerteamName=" wolves", gameType="cup ",
             opponentteamCity=" oslo "),
    )
    columns = ("firstName", "playerteamName", "gameType", "opponentteamCity")
    assert values(out.silver, *columns) == [("ann", "WOLVES", "CUP", "oslo")]
    assert values(out.silver, "gameDateTimeEst", "game_date", "game_year", "game_month") == [
        (datetime(2022, 11, 5, 18), date(2022, 11, 5), 2022, 11)
    ]


def test_lines_routing(spark):
    out = silver(
        spark,
        PLAYER_STATISTICS,
        line(1, 7, fieldGoalsPercentage=100.0, points=0.0),
        line(None, 7),
        line(1, None, points=-1.0),
        line(2, 7, points=-1.0),
        line(3, 7, threePointersPercentage=100.5),
        line(4, 7, gameDateTimeEst="bad"),
    )
    assert values(out.silver, "personId") == [(1,), (4,)]
    assert values(out.quarantine, "personId", "gameId", "quarantine_reason") == [
        (1, None, "MISSING_KEYS"),
        (2, 7, "INVALID_NUMERIC_RANGE"),
        (3, 7, "INVALID_NUMERIC_RANGE"),
        (None, 7, "MISSING_KEYS"),
    ]
    assert out.quarantine.columns[-2:] == ["silver_ingest_ts", "source_file"]


def test_lines_latest_and_rate(spark):
    out = silver(
        spark,
        PLAYER_STATISTICS,
        line(1, 7, points=9.0, numMinutes=10.0),
        line(1, 7, points=12.0, numMinutes=24.0, gameDateTimeEst="2022-11-05 20:00:00"),
        line(2, 7, points=4.0, numMinutes=0.0),
        line(3, 7, points=4.0),
    )
    assert values(out.silver, "personId", "points_per_minute") == [(1, 0.5), (2, None), (3, None)]


# -- team histories --------------------------------------------------------


def test_histories_names_and_activity(spark):
    out = silver(
        spark,
        TEAM_HISTORIES,
        {"teamId": 1, "teamCity": " new  haven ", "teamName": " owls ", "league": "abc "},
        {"teamId": 2, "teamName": "bees", "seasonActiveTill": 2024},
        {"teamId": 3, "teamCity": "bonn", "teamName": "cats", "seasonActiveTill": 2023},
    )
    assert values(out.silver, "teamId", "team_full_name", "active_flag", "league") == [
        (1, "New  Haven OWLS", 1, "ABC"),
        (2, "BEES", 1, None),
        (3, "Bonn CATS", 0, None),
    ]


def test_histories_range_is_judged_before_keys(spark):
    out = silver(
        spark,
        TEAM_HISTORIES,
        {"teamId": 1, "teamName": "a", "seasonFounded": 1899},
        {"teamId": 2, "teamName": "a", "seasonFounded": 2025},
        {"teamId": 3, "teamName": "a", "seasonFounded": 1990, "seasonActiveTill": 1980},
        {"teamId": None, "teamName": "a", "seasonFounded": 1800},
        {"teamId": 5, "teamName": None},
        {"teamId": 6, "teamName": "a", "seasonFounded": 1900, "seasonActiveTill": 1900},
    )
    assert values(out.silver, "teamId") == [(6,)]
    assert values(out.quarantine, "teamId", "quarantine_reason") == [
        (1, "INVALID_SEASON_RANGE"),
        (2, "INVALID_SEASON_RANGE"),
        (3, "INVALID_SEASON_RANGE"),
        (5, "MISSING_KEYS"),
        (None, "INVALID_SEASON_RANGE"),
    ]
    assert out.quarantine.columns[-2:] == ["quarantine_ts", "source_file"]


def test_histories_dated_row_beats_the_open_one(spark):
    out = silver(
        spark,
        TEAM_HISTORIES,
        {"teamId": 1, "teamName": "old", "seasonActiveTill": 1990},
        {"teamId": 1, "teamName": "new", "seasonActiveTill": 2010},
        {"teamId": 1, "teamName": "open", "seasonActiveTill": None},
    )
    assert values(out.silver, "teamName") == [("NEW",)]


# -- team statistics -------------------------------------------------------


def test_teams_text_dates_and_metrics(spark):
    out = silver(
        spark,
        TEAM_STATISTICS,
        team(1, 2, teamName=" owls ", opponentTeamCity=" bonn", fieldGoalsMade=30,
             fieldGoalsAttempted=60),
        team(1, 3, fieldGoalsMade=1, fieldGoalsAttempted=0),
    )
    assert values(
        out.silver, "teamId", "teamName", "opponentTeamCity", "score_diff", "shooting_efficiency"
    ) == [(2, "OWLS", "BONN", 10, 0.5), (3, None, None, 10, None)]
    assert values(out.silver, "game_year", "game_month") == [(2022, 11)] * 2


def test_teams_columns_left_out(spark):
    out = silver(spark, TEAM_STATISTICS, team(1, 2))
    assert not set(NOT_IN_SILVER) & set(out.silver.columns)
    assert set(NOT_IN_SILVER) <= set(out.quarantine.columns)
    assert len(out.silver.columns) == 48 - 14 + 8
    assert out.quarantine.columns[-2:] == ["quarantine_reason", "quarantine_ts"]


UNDECIDED = (
    team(1, 1),
    team(None, 1),
    team(2, None),
    team(3, 1, teamScore=-1),
    team(4, 1, freeThrowsPercentage=101.0),
    team(5, 1, teamScore=None),
    team(6, 1, teamScore=None, freeThrowsPercentage=101.0),
)


def test_teams_unknown_score_is_in_neither_output(spark):
    out = silver(spark, TEAM_STATISTICS, *UNDECIDED)
    assert values(out.silver, "gameId") == [(1,)]
    assert values(out.quarantine, "gameId", "quarantine_reason") == [
        (2, "MISSING_KEYS"),
        (3, "INVALID_NUMERIC_RANGE"),
        (4, "INVALID_NUMERIC_RANGE"),
        (6, "INVALID_NUMERIC_RANGE"),
        (None, "MISSING_KEYS"),
    ]


def test_teams_unknown_score_can_be_quarantined(spark):
    out = silver(spark, TEAM_STATISTICS, *UNDECIDED, on_unknown="quarantine")
    assert out.silver.count() + out.quarantine.count() == len(UNDECIDED)


def test_teams_unusable_numbers_become_null(spark):
    text = spark.createDataFrame(
        [("7", "8", "x", "many")], "gameId string, teamId string, teamScore string, win string"
    )
    names = {n.lower() for n in text.columns}
    for field in TEAM_STATISTICS.bronze.fields:
        if field.name.lower() not in names:
            text = text.selectExpr("*", f"'12' AS {field.name}")
    out = build_silver(text, TEAM_STATISTICS, on_unknown="quarantine").quarantine
    assert values(out, "gameId", "teamScore", "win", "assists") == [(7, None, None, 12)]


def test_unknown_policy_is_refused(spark):
    with pytest.raises(ValueError):
        silver(spark, GAMES, game(1), on_invalid="ignore")
