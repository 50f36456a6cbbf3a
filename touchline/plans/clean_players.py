"""Game documents to tidy player tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.expressions import from_tenths, to_number, utc_timestamp
from touchline.operators.joins import canonical, strict_look_up
from touchline.operators.keys import number_rows
from touchline.operators.rejects import keep_first
from touchline.operators.reshape import two_sided
from touchline.params import GAME_NAMES

HISTORY_COUNTS = ["minutes", "total_points", "goals_scored", "assists", "clean_sheets", "goals_conceded",
                  "yellow_cards", "red_cards", "saves", "bonus", "bps"]
HISTORY_RATINGS = ["influence", "creativity", "threat", "ict_index"]


def clubs(teams: DataFrame, names: dict[str, str] = GAME_NAMES) -> DataFrame:
    """Club id of the documents -> canonical name; fails on an unmapped name."""
    return teams.select("id", canonical("name", names, "game").alias("team_name"), "short_name")


def positions(element_types: DataFrame) -> DataFrame:
    return element_types.select(
        F.col("id").alias("position_id"), F.col("singular_name").alias("position_name"),
        F.col("singular_name_short").alias("position_short"),
        "squad_select", "squad_min_play", "squad_max_play")


def gameweeks(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("id").alias("gameweek_id"), F.col("name").alias("gameweek_name"),
        utc_timestamp("deadline_time").alias("deadline_time"), "finished", "is_current", "is_next",
        F.col("average_entry_score").alias("average_score"), "highest_score")


def players(elements: DataFrame, club_names: DataFrame) -> DataFrame:
    named = strict_look_up(elements, club_names, {"team": "id"}, {"team_name": "team_name"}, "club id")
    return named.select(
        F.col("id").alias("fpl_element_id"), F.col("code").alias("fpl_player_code"),
        "first_name", "second_name", "web_name", F.col("element_type").alias("position_id"),
        to_number("selected_by_percent").alias("selected_by_percent"), "status", "total_points",
        "minutes", to_number("form").alias("form"), to_number("points_per_game").alias("points_per_game"),
        "team_name", from_tenths("now_cost").alias("price_m"))


def team_fixtures(fixtures: DataFrame, club_names: DataFrame) -> DataFrame:
    """Two rows per scheduled fixture, each side with its own difficulty."""
    scheduled = fixtures.filter(F.col("event").isNotNull()).select(
        F.col("event").alias("gameweek_id"), F.col("id").alias("fpl_fixture_id"), "team_h", "team_a",
        "team_h_difficulty", "team_a_difficulty", F.coalesce("finished", F.lit(False)).alias("finished"))

    def side(us, them, at_home):
        return {"_team": F.col(f"team_{us}"), "_opponent": F.col(f"team_{them}"),
                "is_home": F.lit(at_home), "difficulty": F.col(f"team_{us}_difficulty")}

    sides = two_sided(scheduled, side("h", "a", True), side("a", "h", False),
                      ["gameweek_id", "fpl_fixture_id", "finished"])
    named = strict_look_up(sides, club_names, {"_team": "id"}, {"team_name": "team_name"}, "club id")
    named = strict_look_up(named, club_names, {"_opponent": "id"}, {"team_name": "opponent_name"}, "club id")
    return named.select("gameweek_id", "fpl_fixture_id", "team_name", "opponent_name", "is_home",
                        "difficulty", "finished")


def history(entries: DataFrame, club_names: DataFrame) -> DataFrame:
    """One row per player and fixture, the first in its file, numbered by gameweek, player and
    fixture."""
    named = strict_look_up(entries, club_names, {"opponent_team": "id"}, {"team_name": "opponent_name"}, "club id")
    df = named.select(
        "fpl_element_id", F.col("round").alias("gameweek_id"), F.col("fixture").alias("fpl_fixture_id"),
        "opponent_name", utc_timestamp("kickoff_time").alias("kickoff_time"), "was_home",
        *HISTORY_COUNTS, *[to_number(c).alias(c) for c in HISTORY_RATINGS],
        from_tenths("value").alias("price_m"), "selected", "transfers_in", "transfers_out",
        F.to_date(utc_timestamp("kickoff_time")).alias("match_date"), "_place")
    once = keep_first(df, ["fpl_element_id", "fpl_fixture_id"], ["_place"]).drop("_place")
    return number_rows(once, ["gameweek_id", "fpl_element_id", "fpl_fixture_id"], "player_fixture_id")
