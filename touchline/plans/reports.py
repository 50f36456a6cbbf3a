"""Report tables built on the facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.expressions import percent, safe_ratio
from touchline.operators.aggregates import count_where, latest
from touchline.operators.joins import look_up, require
from touchline.operators.reshape import two_sided
from touchline.params import Params


def team_match(matches: DataFrame) -> DataFrame:
    """One row per team per match."""
    def side(us: str, them: str, venue: str) -> dict:
        return {
            "team_id": F.col(f"{us}_team_id"), "opponent_id": F.col(f"{them}_team_id"),
            "venue": F.lit(venue),
            "goals_for": F.col(f"ft_{us}_goals"), "goals_against": F.col(f"ft_{them}_goals"),
            "points": F.col(f"{us}_points"), "shots": F.col(f"{us}_shots"),
            "shots_on_target": F.col(f"{us}_shots_on_target"),
            "yellows": F.col(f"{us}_yellows"), "reds": F.col(f"{us}_reds"),
        }
    return two_sided(matches, side("home", "away", "H"), side("away", "home", "A"),
                     ["match_id", "season_id", "date_id"])


def player_season(players: DataFrame, teams: DataFrame, positions: DataFrame,
                  facts: DataFrame) -> DataFrame:
    """Season totals per player with the current price. Players without facts stay: no
    fixtures and appearances, other totals NULL.

    Facts are summed to one row per player before the join, so neither a hot player nor the
    width of the dimension reaches the big shuffle.
    """
    totals = facts.groupBy(F.col("player_id").alias("_player")).agg(
        F.count("player_fixture_id").alias("_fixtures"),
        count_where(F.col("minutes") > 0).alias("_appearances"),
        *[F.sum(c).alias(f"_{n}") for n, c in {
            "minutes": "minutes", "points": "total_points", "goals": "goals_scored",
            "assists": "assists", "clean_sheets": "clean_sheets", "bonus": "bonus"}.items()])
    df = require(players, teams, {"team_id": "team_id"}, {"team_name": "team_name"})
    df = require(df, positions, {"position_id": "position_id"},
                 {"position_short": "position_short", "position_name": "position_name"})
    none = F.lit(0).cast("bigint")
    return df.join(totals, F.col("player_id") == F.col("_player"), "left").select(
        "player_id", "web_name", "full_name", "price_m", "selected_by_percent", "status",
        "team_name", "position_short", "position_name",
        F.coalesce("_fixtures", none).alias("fixtures"),
        F.coalesce("_appearances", none).alias("appearances"),
        F.col("_minutes").alias("minutes"), F.col("_points").alias("points"),
        F.col("_goals").alias("goals"), F.col("_assists").alias("assists"),
        F.col("_clean_sheets").alias("clean_sheets"), F.col("_bonus").alias("bonus"),
        safe_ratio(F.col("_points"), F.col("price_m"), 2).alias("points_per_million"))


def player_value(players: DataFrame, teams: DataFrame, positions: DataFrame, facts: DataFrame,
                 params: Params = Params(),
                 latest_by: tuple[str, ...] = ("gameweek_id", "date_id", "fpl_fixture_id")) -> DataFrame:
    """Value at the player's latest price; only players that have facts."""
    totals = facts.groupBy("player_id").agg(
        F.count(F.lit(1)).alias("squad_games"),
        count_where(F.col("minutes") >= params.full_game_minutes).alias("full_games"),
        count_where(F.col("minutes") == 0).alias("unused"),
        F.sum("minutes").alias("minutes"), F.sum("total_points").alias("total_points"),
        latest("price_m", *latest_by).alias("latest_price_m"),
        latest("selected", *latest_by).alias("owners"))
    df = require(totals, players, {"player_id": "player_id"},
                 {"web_name": "web_name", "team_id": "_team_id", "position_id": "_position_id"})
    df = look_up(df, teams, {"_team_id": "team_id"}, {"team_name": "team_name"})
    df = look_up(df, positions, {"_position_id": "position_id"}, {"position_short": "position"})
    return df.select(
        "player_id", "web_name", "position", "team_name", "squad_games", "full_games", "unused",
        "minutes", "total_points", "latest_price_m", "owners",
        safe_ratio(F.col("total_points"), F.col("latest_price_m"), 2).alias("points_per_million"),
        percent(F.col("full_games"), F.col("squad_games"), 0).alias("start_rate_pct"))
