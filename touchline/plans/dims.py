"""Dimension builders. Surrogate keys are dense ranks in sort order, valid within a build."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.expressions import calendar_columns, full_name, has_text, label_for, season_year
from touchline.operators.joins import look_up, with_one_row
from touchline.operators.keys import number_members
from touchline.operators.reshape import distinct_union, spine, with_unknown_member
from touchline.params import Params
from touchline.session import known_rows, with_known_rows


def dim_team(*name_columns: DataFrame) -> DataFrame:
    """One row per club named by any of the one-column inputs."""
    return number_members(distinct_union(list(name_columns), "team_name"), ["team_name"], "team_id")


def dim_season(matches: DataFrame, params: Params = Params()) -> DataFrame:
    seasons = number_members(matches.select("season_code", "season_label").distinct(),
                             ["season_code", "season_label"], "season_id")
    live = F.col("season_code") == params.current_season
    rows = known_rows(seasons)
    return with_known_rows(seasons.select(
        "season_id", "season_code", "season_label",
        season_year("season_code", 1, params.century).alias("start_year"),
        season_year("season_code", 3, params.century).alias("end_year"),
        label_for("season_code", params.season_notes, "normal").alias("crowd_status"),
        F.when(live, "in_progress").otherwise("completed").alias("status")), rows, seasons)


def dim_date(matches: DataFrame, gameweeks: DataFrame, params: Params = Params()) -> DataFrame:
    """Every day from the first match to the later of the last match and a week past the last
    deadline."""
    played = matches.agg(F.min("match_date").alias("first_day"), F.max("match_date").alias("last_match"))
    planned = gameweeks.agg(
        F.date_add(F.to_date(F.max("deadline_time")), params.calendar_tail_days).alias("last_planned"))
    bounds = with_one_row(played, planned).select(
        "first_day",
        F.greatest("last_match", F.coalesce("last_planned", "last_match")).alias("last_day"))
    return spine(bounds, "first_day", "last_day", "full_date").select(*calendar_columns("full_date"))


def dim_player(players: DataFrame, teams: DataFrame) -> DataFrame:
    clubs = look_up(players, teams, {"team_name": "team_name"}, {"team_id": "team_id"})
    named = clubs.select(
        "fpl_element_id", "fpl_player_code", "web_name",
        full_name("first_name", "second_name").alias("full_name"), "team_id", "position_id", "price_m",
        "selected_by_percent", "status", "total_points", "minutes", "form", "points_per_game")
    return number_members(named, ["fpl_element_id"], "player_id")


def dim_referee(matches: DataFrame, column: str = "referee") -> DataFrame:
    """Referees by name, after the Unknown member with key 0."""
    names = matches.filter(has_text(column)).select(F.col(column).alias("referee_name")).distinct()
    known = number_members(names, ["referee_name"], "referee_id")
    return with_known_rows(with_unknown_member(known, {"referee_id": 0, "referee_name": "Unknown"}),
                           known_rows(known) + 1, known)


def dim_gameweek(gameweeks: DataFrame) -> DataFrame:
    return gameweeks


def dim_position(positions: DataFrame) -> DataFrame:
    return positions
