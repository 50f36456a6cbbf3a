"""Fact builders. Pass dimensions through ``small_side`` first to earn a broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame

from touchline.operators.joins import look_up, require
from touchline.operators.keys import number_rows
from touchline.plans.staging import MATCH_COUNTS, MATCH_TOTALS

UNKNOWN_REFEREE = 0

MEASURES = [
    "minutes", "total_points", "goals_scored", "assists", "clean_sheets", "goals_conceded",
    "yellow_cards", "red_cards", "saves", "bonus", "bps", "influence", "creativity", "threat",
    "ict_index", "price_m", "selected", "transfers_in", "transfers_out",
]


def fact_match(matches: DataFrame, seasons: DataFrame, dates: DataFrame, teams: DataFrame,
               referees: DataFrame) -> DataFrame:
    """One row per completed fixture; a row unknown to season, date or club dimension drops."""
    df = require(matches, seasons, {"season_code": "season_code"}, {"season_id": "season_id"})
    df = require(df, dates, {"match_date": "full_date"}, {"date_id": "date_id"})
    df = require(df, teams, {"home_team": "team_name"}, {"team_id": "home_team_id"})
    df = require(df, teams, {"away_team": "team_name"}, {"team_id": "away_team_id"})
    df = look_up(df, referees, {"referee": "referee_name"}, {"referee_id": "referee_id"},
                 default=UNKNOWN_REFEREE, spread_missing=True)
    goals, rest = MATCH_COUNTS[:2], MATCH_COUNTS[4:]
    return df.select("match_id", "season_id", "date_id", "home_team_id", "away_team_id", "referee_id",
                     "kickoff_time", *goals, "ft_result", *MATCH_COUNTS[2:4], "ht_result", *rest,
                     *MATCH_TOTALS)


def fact_player_fixture(history: DataFrame, players: DataFrame, teams: DataFrame,
                        dates: DataFrame) -> DataFrame:
    """One row per player and fixture; unknown players drop, unknown opponents and days stay."""
    # The dimension's price is today's; the fact keeps the price of its gameweek.
    df = require(history, players, {"fpl_element_id": "fpl_element_id"}, {"player_id": "player_id"})
    df = look_up(df, teams, {"opponent_name": "team_name"}, {"team_id": "opponent_team_id"})
    df = look_up(df, dates, {"match_date": "full_date"}, {"date_id": "date_id"})
    return df.select("player_fixture_id", "player_id", "gameweek_id", "date_id", "opponent_team_id",
                     "fpl_fixture_id", "was_home", *MEASURES)


def fact_team_fixture(fixtures: DataFrame, teams: DataFrame,
                      order: tuple[str, ...] = ("team_name", "fpl_fixture_id")) -> DataFrame:
    """One row per team and fixture with a known team, numbered by ``order``."""
    known = require(fixtures.drop("team_id"), teams, {"team_name": "team_name"}, {"team_id": "team_id"})
    df = number_rows(known, list(order), "team_fixture_id")
    df = look_up(df.drop("opponent_team_id"), teams, {"opponent_name": "team_name"},
                 {"team_id": "opponent_team_id"})
    return df.select("team_fixture_id", "team_id", "opponent_team_id", "gameweek_id",
                     "fpl_fixture_id", "is_home", "difficulty", "finished")


