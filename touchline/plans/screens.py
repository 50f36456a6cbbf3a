"""Data steps behind the dashboard and the exploration reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.expressions import fixture_label, player_label, shorten
from touchline.operators.aggregates import most_frequent, repeated, top, value_split
from touchline.operators.joins import look_up, require
from touchline.operators.reshape import pivot_mean
from touchline.operators.stats import correlation_with, headline, with_residuals
from touchline.params import Params


def facet_view(player_season: DataFrame, positions: list[str], max_price: float, min_minutes: int) -> DataFrame:
    """Players in the chosen positions, not above the price, at or above the minutes."""
    return player_season.filter(
        F.col("position_short").isin(positions) & (F.col("price_m") <= max_price)
        & (F.col("minutes") >= min_minutes))


def view_headline(view: DataFrame) -> DataFrame:
    return headline(view, "points_per_million", "price_m")


def expected_points(view: DataFrame) -> DataFrame:
    """Points against the line through price and points; no line below ten players."""
    return with_residuals(view, "price_m", "points", min_rows=10)


def top_residuals(view: DataFrame, n: int = 10) -> DataFrame:
    return top(expected_points(view), n, F.desc_nulls_last("residual"), F.asc("player_id"))


def shortlist(view: DataFrame, n: int = 15) -> DataFrame:
    return top(view, n, F.desc_nulls_last("points_per_million"), F.asc("player_id")).select(
        "web_name", "team_name", "position_short", "price_m", "points", "points_per_million")


def concentration(view: DataFrame, n: int = 15, at_least: int = 4) -> DataFrame:
    """The club with most players on the shortlist and whether that is a lot."""
    return most_frequent(shortlist(view, n), "team_name", at_least)


def outlook_panel(outlook: DataFrame, n: int = 10, width: int = 34) -> DataFrame:
    rows = top(outlook, n, F.asc_nulls_last("avg_difficulty"), F.asc("team_name"))
    return rows.select("team_name", "fixtures_in_window", "avg_difficulty",
                       shorten("opponents", width).alias("opponents"))


def player_choices(view: DataFrame) -> DataFrame:
    return view.orderBy(F.desc_nulls_last("points"), "player_id").select(
        "player_id", player_label("web_name", "team_name").alias("label"))


def player_detail(facts: DataFrame, teams: DataFrame, player_id: int | Column) -> DataFrame:
    """A player's fixtures in order, each with its display label."""
    rows = facts.filter(F.col("player_id") == player_id)
    named = look_up(rows, teams, {"opponent_team_id": "team_id"}, {"team_name": "opponent"})
    return named.orderBy("gameweek_id", "fpl_fixture_id").select(
        "gameweek_id", "total_points", "minutes", "bonus", "price_m", "opponent", "was_home",
        fixture_label("gameweek_id", "opponent", "was_home").alias("fixture"))


def goals_and_results(matches: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Goals histogram, mean and variance of goals, and the H/D/A split."""
    histogram = matches.groupBy("total_goals").agg(F.count(F.lit(1)).alias("matches")).orderBy("total_goals")
    moments = matches.agg(F.avg("total_goals").alias("mean"), F.var_samp("total_goals").alias("variance"))
    return histogram, moments, value_split(matches, "ft_result", ["H", "D", "A"])


def season_totals(facts: DataFrame, players: DataFrame, min_minutes: int) -> DataFrame:
    """Per-player totals with today's price, for the correlation report."""
    totals = facts.groupBy("player_id").agg(
        F.sum("total_points").alias("points"), F.sum("minutes").alias("minutes"), F.sum("bps").alias("bps"),
        F.avg("ict_index").alias("ict_index"), F.sum("goals_scored").alias("goals"),
        F.sum("assists").alias("assists")).filter(F.col("minutes") >= min_minutes)
    return require(totals, players, {"player_id": "player_id"}, {"price_m": "price_m"})


def what_tracks_points(facts: DataFrame, players: DataFrame, params: Params = Params()) -> DataFrame:
    return correlation_with(season_totals(facts, players, params.trend_minutes), "points",
                            ["minutes", "bps", "ict_index", "goals", "assists", "price_m"])


def difficulty_matrix(fixtures: DataFrame, teams: DataFrame, periods: list[int]) -> DataFrame:
    """Mean difficulty per team and period, hardest-first-period last, with the row mean."""
    named = require(fixtures.filter(~F.col("finished")), teams, {"team_id": "team_id"}, {"team_name": "team_name"})
    wide = pivot_mean(named, "team_name", "gameweek_id", periods, "difficulty", "gw")
    return wide.orderBy(F.col(f"gw{periods[0]}").asc_nulls_last(), "team_name")


def double_periods(facts: DataFrame) -> DataFrame:
    """Player and gameweek pairs with more than one fixture."""
    return repeated(facts, ["player_id", "gameweek_id"], "fixtures")
