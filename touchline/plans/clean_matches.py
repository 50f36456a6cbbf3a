"""Raw match rows (all text) to one validated dataset and its rejects."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.expressions import code, day_first_date, points_for, to_whole
from touchline.operators.joins import fail_unless_mapped, respelled
from touchline.operators.keys import number_rows
from touchline.operators.rejects import count_rejects, flag_rejects, kept, rejected
from touchline.params import MATCH_NAMES, Params
from touchline.plans.staging import MATCH_COUNTS

NATURAL_KEY = ["season_code", "match_date", "home_team", "away_team"]
UNMAPPED = "unmapped club"
DUPLICATE = "duplicate on natural key"


@dataclass(frozen=True)
class CleanedMatches:
    kept: DataFrame
    rejects: DataFrame


def rules(params: Params, names: dict[str, str] | None) -> list:
    """Reject rules in the order in which they are tried.

    The club rule rejects nothing: a row that reaches it with an unknown club fails the job.
    """
    home, away = F.col("ft_home_goals"), F.col("ft_away_goals")
    goals = F.greatest(home, away) > params.max_plausible_goals
    bad_goals = home.isNull() | away.isNull() | goals | (F.least(home, away) < 0)
    half_over = (F.col("ht_home_goals") > home) | (F.col("ht_away_goals") > away)
    out = [
        ("empty row", F.col("_raw_date").isNull() & F.col("_raw_home").isNull()),
        ("fixture not yet played", F.coalesce(F.trim("_raw_result"), F.lit("")) == ""),
        ("unparseable date", F.col("match_date").isNull()),
    ]
    if names is not None:
        for club in ("_raw_home", "_raw_away"):
            out.append((UNMAPPED, fail_unless_mapped(club, names, "match")))
    return out + [
        ("goals outside plausible range", bad_goals),
        ("half-time goals exceed full-time", F.coalesce(half_over, F.lit(False))),
        ("result not in H/D/A", ~F.coalesce(F.col("ft_result").isin("H", "D", "A"), F.lit(False))),
    ]


def parsed(raw: DataFrame, names: dict[str, str] | None) -> DataFrame:
    """Typed columns beside the raw text the first rules look at. Absent columns become NULL."""
    def text(column):
        return F.col(column).cast("string") if column in raw.columns else F.lit(None).cast("string")

    counts = {c: to_whole(text(c)) for c in MATCH_COUNTS}
    clubs = {"home_team": text("home_team"), "away_team": text("away_team")}
    df = raw.withColumns({
        "_raw_date": text("match_date"), "_raw_home": text("home_team"),
        "_raw_away": text("away_team"), "_raw_result": text("ft_result"), "kickoff_time": text("kickoff_time"),
        "match_date": day_first_date(text("match_date")),
        "ft_result": code(text("ft_result")), "ht_result": code(text("ht_result")),
        "referee": F.trim(text("referee")), **counts})
    if names is None:
        return df
    return df.withColumns({c: respelled(v, names) for c, v in clubs.items()})


def flag_matches(raw: DataFrame, order: list[str], names: dict[str, str] | None = MATCH_NAMES,
                 params: Params = Params()) -> DataFrame:
    """Every row with its reject reason or NULL. ``order`` says which copy of a match is first
    (file order) and must be unique."""
    return flag_rejects(parsed(raw, names), rules(params, names), NATURAL_KEY, order,
                        DUPLICATE)


def match_reject_counts(raw: DataFrame, names: dict[str, str] | None = MATCH_NAMES, params: Params = Params()) -> DataFrame:
    """Rows per reject reason, for a look at a delivery before it is cleaned."""
    return count_rejects(parsed(raw, names), rules(params, names), NATURAL_KEY, DUPLICATE)


def with_totals(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "total_goals": F.col("ft_home_goals") + F.col("ft_away_goals"),
        "goal_difference": F.col("ft_home_goals") - F.col("ft_away_goals"),
        "home_points": points_for("ft_result", "H"),
        "away_points": points_for("ft_result", "A")})


def clean_matches(raw: DataFrame, order: list[str], names: dict[str, str] | None = MATCH_NAMES,
                  params: Params = Params()) -> CleanedMatches:
    flagged = flag_matches(raw, order, names, params)
    scratch = [c for c in flagged.columns if c.startswith("_")]
    numbered = number_rows(with_totals(kept(flagged)), ["match_date", "home_team", *order], "match_id")
    return CleanedMatches(numbered.drop(*scratch, *order),
                          as_delivered(rejected(flagged), raw.columns).drop(*scratch, *order))


def as_delivered(rejects: DataFrame, columns: list[str]) -> DataFrame:
    """Rejected rows show the date and result text as they came."""
    shown = {"match_date": F.coalesce(F.col("match_date").cast("string"), F.col("_raw_date")),
             "ft_result": F.coalesce(F.col("ft_result"), F.col("_raw_result"))}
    return rejects.withColumns({c: v for c, v in shown.items() if c in columns})
