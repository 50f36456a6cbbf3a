"""The contract suite: completed seasons, live season, player data, and both sources together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.operators import checks
from touchline.operators.reshape import stack_columns
from touchline.params import Params
from touchline.plans.clean_matches import NATURAL_KEY

REQUIRED = ["match_date", "home_team", "away_team", "ft_home_goals", "ft_away_goals", "ft_result"]


RECONCILED = "game clubs all appear in match data"


def failing_members(matches: DataFrame, players: DataFrame, positions: DataFrame, params: Params = Params()) -> DataFrame:
    """(check, member, value): every member behind the contracts whose details name some of them."""
    completed, live = matches.filter(~F.col("is_current_season")), matches.filter(F.col("is_current_season"))
    return checks.quarantined({
        checks.count_name(params.matches_per_completed_season):
            checks.wrong_counts(completed, "season_code", params.matches_per_completed_season),
        checks.SQUAD: checks.short_categories(players, positions, "position_id", "squad_select"),
        RECONCILED: checks.unknown_members(stack_columns(live, [], ["home_team", "away_team"], "team_name"), players.select("team_name")),
    })


def contract_results(matches: DataFrame, players: DataFrame, positions: DataFrame, history: DataFrame,
                     as_of: Column, params: Params = Params()) -> DataFrame:
    """One row per contract. Checks that read single rows share one pass per table."""
    completed = matches.filter(~F.col("is_current_season"))
    live = matches.filter(F.col("is_current_season"))
    prices = f"player prices between {params.min_price} and {params.max_price}"
    minutes = f"minutes between 0 and {params.max_minutes}"
    live_clubs = stack_columns(live, [], ["home_team", "away_team"], "team_name")
    return checks.union_results([
        checks.run_row_checks(matches, [
            checks.no_nulls(REQUIRED),
            checks.result_agrees("ft_home_goals", "ft_away_goals", "ft_result"),
            checks.none_after("match_date", as_of)]),
        checks.unique_key(matches, NATURAL_KEY),
        checks.group_counts(completed, "season_code", params.matches_per_completed_season),
        checks.member_counts(completed, "season_code", ["home_team", "away_team"],
                             params.matches_per_team_per_season),
        checks.run_row_checks(live, [checks.row_count_within(params.matches_per_completed_season)]),
        checks.count_spread(live, ["home_team", "away_team"], params.max_matches_played_spread),
        checks.run_row_checks(players, [
            checks.in_range(prices, "price_m", params.min_price, params.max_price, "implausible")]),
        checks.category_minimum(players, positions, "position_id", "squad_select"),
        checks.run_row_checks(history, [checks.in_range(minutes, "minutes", 0, params.max_minutes, "outside")]),
        checks.unique_key(history, ["fpl_element_id", "fpl_fixture_id"], "one row per player per fixture"),
        checks.members_reconcile(live_clubs, players.select("team_name"),
                                 RECONCILED, "aligned", "game-only"),
    ])
