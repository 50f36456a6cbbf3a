"""The ten questions, as functions of warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.expressions import percent, round_half_away
from touchline.operators.aggregates import count_where, ordered_list, top
from touchline.operators.joins import look_up, require, with_one_row
from touchline.operators.keys import competition_rank
from touchline.operators.windows import HOT_ROWS, islands, running, trailing_sum
from touchline.params import Params

IN_PROGRESS = "in_progress"


def live_rows(facts: DataFrame, seasons: DataFrame, status: str = IN_PROGRESS) -> DataFrame:
    live = seasons.filter(F.col("status") == status)
    return facts.join(live.select(F.col("season_id").alias("_season")),
                      F.col("season_id") == F.col("_season")).select(*facts.columns)


def league_table(team_match: DataFrame, teams: DataFrame, seasons: DataFrame) -> DataFrame:
    """Standings of the live season: points, then goal difference, then goals."""
    points = F.col("points")
    totals = live_rows(team_match, seasons).groupBy("team_id").agg(
        F.count(F.lit(1)).alias("played"), count_where(points == 3).alias("won"),
        count_where(points == 1).alias("drawn"), count_where(points == 0).alias("lost"),
        F.sum("goals_for").alias("gf"), F.sum("goals_against").alias("ga"),
        (F.sum("goals_for") - F.sum("goals_against")).alias("gd"), F.sum("points").alias("points"))
    named = require(totals, teams, {"team_id": "team_id"}, {"team_name": "team_name"})
    # Two ids of one name form one row, as the question groups by name.
    rows = named.groupBy("team_name").agg(
        *[F.sum(c).alias(c) for c in ("played", "won", "drawn", "lost", "gf", "ga", "gd", "points")])
    return competition_rank(rows, ["points", "gd", "gf"], "position").select(
        "position", *rows.columns).orderBy("position", "team_name")


def best_value(player_season: DataFrame, params: Params = Params(), n: int = 30) -> DataFrame:
    rows = player_season.filter(F.col("minutes") >= params.value_minutes)
    return top(rows, n, F.desc_nulls_last("points_per_million"), F.asc("player_id")).select(
        "web_name", "team_name", "position_short", "price_m", "points",
        "points_per_million", "appearances", "minutes", "selected_by_percent")


def differentials(player_season: DataFrame, params: Params = Params(), n: int = 25) -> DataFrame:
    rows = player_season.filter(
        (F.col("selected_by_percent") < params.differential_ownership)
        & (F.col("minutes") >= params.value_minutes) & (F.col("points") > 0))
    return top(rows, n, F.desc_nulls_last("points_per_million"), F.asc("player_id")).select(
        "web_name", "team_name", "position_short", "price_m", "points",
        "points_per_million", "selected_by_percent", "minutes")


def rolling_form(facts: DataFrame, players: DataFrame, teams: DataFrame, positions: DataFrame,
                 params: Params = Params()) -> DataFrame:
    """Points and minutes over the last five gameweek numbers, per player and gameweek."""
    form = trailing_sum(facts, ["player_id"], "gameweek_id",
                        {"points_last_5": "total_points", "minutes_last_5": "minutes"}, params.form_span)
    return named_players(form, players, teams, positions).orderBy(
        F.desc("gameweek_id"), F.desc_nulls_last("points_last_5"), "player_id").select(
        "web_name", "team_name", "position_short", "price_m", "gameweek_id",
        "points_last_5", "minutes_last_5")


def named_players(df: DataFrame, players: DataFrame, teams: DataFrame, positions: DataFrame) -> DataFrame:
    df = require(df, players, {"player_id": "player_id"},
                 {"web_name": "web_name", "team_id": "_team", "position_id": "_position", "price_m": "price_m"})
    df = require(df, teams, {"_team": "team_id"}, {"team_name": "team_name"})
    return require(df, positions, {"_position": "position_id"}, {"position_short": "position_short"})


def next_periods(fixtures: DataFrame, gameweeks: DataFrame, span: int = 4) -> DataFrame:
    """Unfinished fixtures of the next period and the ``span`` after it; none when all are done."""
    upcoming = gameweeks.filter(~F.col("finished")).agg(F.min("gameweek_id").alias("_next"))
    return with_one_row(fixtures.filter(~F.col("finished")), upcoming).filter(
        F.col("gameweek_id").between(F.col("_next"), F.col("_next") + span)).drop("_next")


def fixture_outlook(fixtures: DataFrame, teams: DataFrame, gameweeks: DataFrame,
                    params: Params = Params()) -> DataFrame:
    """How hard each team's next fixtures are; opponents are listed by name."""
    df = next_periods(fixtures, gameweeks, params.form_span)
    df = require(df, teams, {"team_id": "team_id"}, {"team_name": "team_name"})
    df = require(df, teams, {"opponent_team_id": "team_id"}, {"team_name": "_opponent"})
    return df.groupBy("team_name").agg(
        F.count(F.lit(1)).alias("fixtures_in_window"),
        round_half_away(F.avg("difficulty"), 2).alias("avg_difficulty"),
        F.sum(F.col("is_home").cast("int")).alias("home_fixtures"),
        ordered_list("_opponent").alias("opponents")).orderBy("avg_difficulty", "team_name")


def points_race(team_match: DataFrame, order: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Game number and running points per team, in ``order`` (unique within a team)."""
    return running(team_match, ["team_id"], order, {"cumulative_points": F.col("points")},
                   number="played", hot_rows=hot_rows)


def dated(team_match: DataFrame, dates: DataFrame) -> DataFrame:
    return require(team_match, dates, {"date_id": "date_id"}, {"full_date": "full_date"})


def title_race(dated_rows: DataFrame, teams: DataFrame, seasons: DataFrame,
               hot_rows: int = HOT_ROWS) -> DataFrame:
    """Running points of the live season by team, in date order."""
    race = points_race(live_rows(dated_rows, seasons), ["full_date", "match_id"], hot_rows)
    return require(race, teams, {"team_id": "team_id"}, {"team_name": "team_name"}).select(
        "team_name", "played", "cumulative_points").orderBy("team_name", "played")


def unbeaten_runs(team_match: DataFrame, order: list[str], at: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Runs without a loss per team and season; a run does not cross seasons."""
    return islands(team_match, ["team_id", "season_id"], order, F.col("points") > 0, at, hot_rows)


def longest_unbeaten(dated_rows: DataFrame, teams: DataFrame, seasons: DataFrame, n: int = 15,
                     hot_rows: int = HOT_ROWS) -> DataFrame:
    """The longest runs; names are looked up for the few rows that remain."""
    runs = unbeaten_runs(dated_rows, ["full_date", "match_id"], "full_date", hot_rows)
    order = F.desc("streak_length"), F.asc("started"), F.asc("team_id")
    best = top(runs, n, *order)
    best = require(best, teams, {"team_id": "team_id"}, {"team_name": "team_name"})
    best = require(best, seasons, {"season_id": "season_id"}, {"season_label": "season_label"})
    return best.orderBy(*order).select("team_name", "season_label", "streak_length", "started", "ended")


def position_returns(player_season: DataFrame, positions: DataFrame, params: Params = Params()) -> DataFrame:
    """What each position returns at what price, over players past the minutes floor."""
    rows = player_season.filter(F.col("minutes") >= params.value_minutes)
    per_name = rows.groupBy(F.col("position_name").alias("_name")).agg(
        F.count(F.lit(1)).alias("players"),
        round_half_away(F.avg("price_m"), 2).alias("avg_price"),
        round_half_away(F.avg("points"), 1).alias("avg_points"),
        round_half_away(F.avg("points_per_million"), 2).alias("avg_ppm"),
        F.max("points").alias("best_points"))
    return require(per_name, positions, {"_name": "position_name"},
                   {"position_name": "position_name", "squad_select": "squad_slots"}).select(
        "position_name", "players", "avg_price", "avg_points", "avg_ppm", "best_points", "squad_slots",
    ).orderBy(F.desc_nulls_last("avg_ppm"), "position_name")


def season_vs_baseline(matches: DataFrame, seasons: DataFrame) -> DataFrame:
    """Home-win rate and goals per game of each season against the mean of the completed ones."""
    totals = matches.groupBy("season_id").agg(
        F.count(F.lit(1)).alias("matches"), count_where(F.col("ft_result") == "H").alias("_wins"),
        F.sum("total_goals").alias("_goals"), F.count("total_goals").alias("_scored"))
    labelled = require(totals, seasons, {"season_id": "season_id"},
                       {"season_label": "season_label", "status": "status"})
    by_season = labelled.groupBy("season_label", "status").agg(
        F.sum("matches").alias("matches"),
        (F.sum("_wins").cast("double") / F.sum("matches")).alias("_rate"),
        F.try_divide(F.sum("_goals").cast("double"), F.sum("_scored")).alias("_gpg"))
    baseline = by_season.filter(F.col("status") == "completed").agg(
        F.avg("_rate").alias("_base_rate"), F.avg("_gpg").alias("_base_gpg"))
    return with_one_row(by_season, baseline).select(
        "season_label", "status", "matches",
        round_half_away(100 * F.col("_rate"), 1).alias("home_win_pct"),
        round_half_away(100 * (F.col("_rate") - F.col("_base_rate")), 1).alias("vs_baseline_pts"),
        round_half_away(F.col("_gpg"), 2).alias("goals_per_game"),
        round_half_away(F.col("_gpg") - F.col("_base_gpg"), 2).alias("goals_vs_baseline"),
    ).orderBy("season_label")


def bonus_share(facts: DataFrame, players: DataFrame, teams: DataFrame, positions: DataFrame,
                params: Params = Params(), n: int = 25) -> DataFrame:
    """Players by bonus points; appearances only, past the minutes floor."""
    totals = (facts.filter(F.col("minutes") > 0).groupBy("player_id")
              .agg(F.sum("bonus").alias("bonus_points"), F.sum("total_points").alias("total_points"),
                   F.avg("bps").alias("_bps"), F.sum("minutes").alias("_minutes"))
              .filter(F.col("_minutes") >= params.value_minutes))
    rows = named_players(totals, players, teams, positions)
    return top(rows, n, F.desc_nulls_last("bonus_points"), F.asc("player_id")).select(
        "web_name", "team_name", "position_short", "price_m", "bonus_points", "total_points",
        percent(F.col("bonus_points"), F.col("total_points"), 1).alias("pct_from_bonus"),
        round_half_away(F.col("_bps"), 1).alias("avg_bps"))
