"""The command-line jobs from CSV files to gold tables and star schema."""

import json

import pytest

from build import values
from lodeworks import jobs
from lodeworks.contracts import CONTRACTS
from lodeworks.plans import gold

TEAM = {"teamCity": "rome", "teamName": "owls", "opponentTeamName": "bees"}
RECORDS = {
    "games": [
        {"gameid": 1, "gamedatetimeest": "2020-02-03 19:00:00", "hometeamname": "owls",
         "hometeamid": 1, "awayteamname": "bees", "awayteamid": 2, "homescore": 110,
         "awayscore": 95, "arenaid": 4},
        {"gameid": 2, "gamedatetimeest": "2017-02-03 19:00:00", "hometeamname": "owls",
         "hometeamid": 1, "awayteamname": "bees", "awayteamid": 2, "homescore": 1,
         "awayscore": 2, "arenaid": 4},
        {"gameid": 3, "gamedatetimeest": "2020-02-04 19:00:00", "hometeamid": 1},
    ],
    "players": [{"personId": 7, "firstName": "ann", "lastName": "low", "guard": "true"}],
    "player_statistics": [
        {"personId": 7, "gameId": 1, "firstName": "Ann", "lastName": "Low",
         "gameDateTimeEst": "2020-02-03 19:00:00", "playerteamName": "owls", "points": 21,
         "assists": 3, "reboundsTotal": 5, "reboundsOffensive": 2, "reboundsDefensive": 3},
    ],
    "team_histories": [{"teamId": 1, "teamCity": "rome", "teamName": "owls"}],
    "team_statistics": [
        {"gameId": 1, "teamId": 1, "gameDateTimeEst": "2020-02-03 19:00:00", "teamScore": 110,
         "opponentScore": 95, "q1Points": 30, **TEAM},
    ],
}


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("pipeline")
    for entity, records in RECORDS.items():
        names = CONTRACTS[entity].bronze.fieldNames()
        lines = [",".join(names)]
        lines += [",".join(str(r.get(n, "")) for n in names) for r in records]
        (root / f"{entity}.csv").write_text("\n".join(lines) + "\n")
    return root


@pytest.fixture(scope="module")
def silver(spark, folders):
    for entity in CONTRACTS:
        bronze = f"{folders}/bronze/{entity}"
        jobs.main(["load", f"{folders}/{entity}.csv", bronze, "--entity", entity])
        jobs.main([
            "silver", entity, "--parquet", bronze, "--silver", f"{folders}/silver/{entity}",
            "--quarantine", f"{folders}/quarantine/{entity}", "--as-of", "2024-06-30",
            "--register", f"job_silver.{entity}_silver",
        ])
    return folders


def test_load_applies_the_cutoff(spark, silver):
    bronze = spark.read.parquet(f"{silver}/bronze/games")
    assert values(bronze, "gameid") == [(1,), (3,)]


def test_silver_and_quarantine_are_written(spark, silver):
    good = spark.read.parquet(f"{silver}/silver/games")
    assert values(good, "gameid", "hometeamname", "home_win") == [(1, "OWLS", 1)]
    assert good.first()["source_file"].endswith(".parquet")
    bad = spark.read.parquet(f"{silver}/quarantine/games")
    assert values(bad, "gameid", "quarantine_reason") == [(3, "MISSING_KEY_FIELDS")]


def test_gold_tables_are_published_twice(spark, silver):
    arguments = ["gold", "--silver-db", "job_silver", "--gold-db", "job_gold"]
    for _ in range(2):
        jobs.main([*arguments, "--base-path", f"{silver}/gold"])
    tables = {t.name for t in spark.catalog.listTables("job_gold")}
    assert {gold.WIN_TABLE, gold.PER_GAME_TABLE.format("points")} <= tables and len(tables) == 8
    wins = spark.table(f"job_gold.{gold.WIN_TABLE}")
    assert values(wins, "teamId", "wins", "win_percentage") == [("BEES", 0, 0.0), ("OWLS", 1, 1.0)]


def test_star_schema_is_written(spark, silver):
    jobs.main(["star", "--silver-root", f"{silver}/silver", "--gold-root", f"{silver}/star"])
    fact = spark.read.parquet(f"{silver}/star/fact_nba_stats")
    assert values(fact, "personid", "teamname", "rebounds", "q1points", "score_diff") == [
        (7, "OWLS", 5.0, 30, 15)
    ]
    players = spark.read.parquet(f"{silver}/star/dim_players")
    assert values(players, "personid", "primary_position") == [(7, "G")]
    for name in ("dim_teams", "dim_games", "dim_dates"):
        assert spark.read.parquet(f"{silver}/star/{name}").count() == 1


def test_silver_layout_options(spark, silver):
    target = f"{silver}/by_year"
    counts = jobs.run_silver(
        spark.read.parquet(f"{silver}/bronze/games"), CONTRACTS["games"], target,
        partition_by=["game_year"],
    )
    assert values(counts, "layer", "row_count") == [("bronze", 2), ("silver", 1)]
    assert spark.read.parquet(target).filter("game_year = 2020").count() == 1


def test_bench_prints_one_json_line(spark, capsys, monkeypatch):
    import bench

    monkeypatch.setenv("BENCH_SF_DIR", "/root/testdata/sf0.001")
    monkeypatch.setenv("BENCH_RUNS", "1")
    monkeypatch.setattr(bench, "_session", lambda cpus: spark)
    monkeypatch.setattr(bench, "HEADLINE", ("team_win_percentage",))
    monkeypatch.setattr("sys.argv", ["bench.py"])
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    bench.main()
    line = json.loads(capsys.readouterr().out.strip())
    assert line["unit"] == "sec" and set(line["queries"]) == {"team_win_percentage"}
