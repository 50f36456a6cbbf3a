"""Staging: rename and cast, nothing else."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The column names and types of the staged tables, which existing queries rely on.
MATCH_COUNTS = [
    "ft_home_goals", "ft_away_goals", "ht_home_goals", "ht_away_goals",
    "home_shots", "away_shots", "home_shots_on_target", "away_shots_on_target",
    "home_fouls", "away_fouls", "home_corners", "away_corners",
    "home_yellows", "away_yellows", "home_reds", "away_reds",
]
MATCH_TOTALS = ["home_points", "away_points", "total_goals", "goal_difference"]

# Fixed values, as above; None keeps a column's type.
SCHEMAS = {
    "stg_matches": {
        "match_id": None, "season_code": None, "season_label": None, "match_date": "date",
        "home_team": None, "away_team": None, "referee": None, "kickoff_time": None,
        "ft_result": None, "ht_result": None,
        **dict.fromkeys(MATCH_COUNTS + MATCH_TOTALS, "int"),
    },
    "stg_players": {
        "fpl_element_id": None, "fpl_player_code": None, "web_name": None, "first_name": None,
        "second_name": None, "team_name": None, "position_id": "int", "price_m": "double",
        "selected_by_percent": "double", "status": None, "total_points": "int", "minutes": "int",
        "form": "double", "points_per_game": "double",
    },
    "stg_positions": {
        "position_id": "int", "position_name": None, "position_short": None,
        "squad_select": "int", "squad_min_play": "int", "squad_max_play": "int",
    },
    "stg_gameweeks": {
        "gameweek_id": "int", "gameweek_name": None, "deadline_time": None,
        "finished": "boolean", "is_current": "boolean", "is_next": "boolean",
        "average_score": "int", "highest_score": "int",
    },
    "stg_fixtures": {
        "team_name": None, "opponent_name": None, "gameweek_id": "int", "fpl_fixture_id": "int",
        "is_home": "boolean", "difficulty": "int", "finished": "boolean",
    },
    "stg_player_fixture": {
        "player_fixture_id": "int", "fpl_element_id": None, "opponent_name": None,
        "match_date": "date", "gameweek_id": "int", "fpl_fixture_id": "int", "was_home": "boolean",
        **dict.fromkeys(["minutes", "total_points", "goals_scored", "assists", "clean_sheets",
                         "goals_conceded", "yellow_cards", "red_cards", "saves", "bonus", "bps"], "int"),
        **dict.fromkeys(["influence", "creativity", "threat", "ict_index", "price_m"], "double"),
        **dict.fromkeys(["selected", "transfers_in", "transfers_out"], "int"),
    },
}

SOURCES = {
    "stg_matches": "raw_matches", "stg_players": "raw_players", "stg_positions": "raw_positions",
    "stg_gameweeks": "raw_gameweeks", "stg_fixtures": "raw_fixtures",
    "stg_player_fixture": "raw_player_fixture",
}


def staged(df: DataFrame, schema: dict[str, str | None]) -> DataFrame:
    return df.select(*[F.col(c) if kind is None else F.col(c).cast(kind).alias(c)
                       for c, kind in schema.items()])


def stage_all(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: staged(raw[source], SCHEMAS[name]) for name, source in SOURCES.items()}
