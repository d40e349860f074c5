"""The five entities and their rules."""

from lodeworks.contract import Contract
from lodeworks.contracts.games import GAMES, GAMES_BY_SEASON
from lodeworks.contracts.player_statistics import PLAYER_STATISTICS
from lodeworks.contracts.players import PLAYERS
from lodeworks.contracts.team_histories import TEAM_HISTORIES
from lodeworks.contracts.team_statistics import TEAM_STATISTICS

CONTRACTS: dict[str, Contract] = {
    contract.entity: contract
    for contract in (GAMES, PLAYERS, PLAYER_STATISTICS, TEAM_HISTORIES, TEAM_STATISTICS)
}

__all__ = [
    "CONTRACTS",
    "GAMES",
    "GAMES_BY_SEASON",
    "PLAYERS",
    "PLAYER_STATISTICS",
    "TEAM_HISTORIES",
    "TEAM_STATISTICS",
]
