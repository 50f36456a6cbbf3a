"""The ordered reject channel on hand-written rows."""

import datetime as dt

import pytest

from touchline.operators.rejects import kept, reject_counts
from touchline.plans.clean_matches import clean_matches, flag_matches
from touchline.plans.staging import MATCH_COUNTS

COLUMNS = ["match_date", "kickoff_time", "home_team", "away_team", "ft_result", "ht_result", "referee",
           *MATCH_COUNTS, "season_code", "season_label"]


def row(**overrides):
    base = {"match_date": "12/08/2026", "kickoff_time": "15:00", "home_team": "Arsenal", "away_team": "Coventry",
            "ft_result": "H", "ht_result": "H", "referee": " M Oliver ", **dict.fromkeys(MATCH_COUNTS, "5"),
            "ft_home_goals": "2", "ft_away_goals": "1", "ht_home_goals": "1", "ht_away_goals": "0",
            "season_code": "2627", "season_label": "2026/27"}
    return base | overrides


def frame(spark, *rows):
    schema = ", ".join(f"{c} string" for c in COLUMNS) + ", line int"
    return spark.createDataFrame([tuple(r[c] for c in COLUMNS) + (i,) for i, r in enumerate(rows)], schema)


@pytest.mark.parametrize("overrides, reason", [
    ({}, None),
    ({"match_date": None, "home_team": None}, "empty row"),
    ({"ft_result": None}, "fixture not yet played"),
    ({"ft_result": "  "}, "fixture not yet played"),
    ({"match_date": "garbage"}, "unparseable date"),
    ({"match_date": None}, "unparseable date"),
    ({"ft_home_goals": "13"}, "goals outside plausible range"),
    ({"ft_away_goals": "-1"}, "goals outside plausible range"),
    ({"ft_home_goals": None}, "goals outside plausible range"),
    ({"ft_home_goals": "12", "ft_result": "H"}, None),
    ({"ht_home_goals": "3"}, "half-time goals exceed full-time"),
    ({"ht_home_goals": None, "ht_away_goals": None}, None),
    ({"ht_home_goals": None, "ht_away_goals": "2"}, "half-time goals exceed full-time"),
    ({"ft_result": " h "}, None),
    ({"ft_result": "X"}, "result not in H/D/A"),
    ({"ft_result": "X", "ft_home_goals": "40"}, "goals outside plausible range"),
    # A club nobody knows does not matter to a row that was rejected before.
    ({"ft_result": None, "home_team": "Real Madrid"}, "fixture not yet played"),
])
def test_first_rule_in_order(spark, overrides, reason):
    assert flag_matches(frame(spark, row(**overrides)), ["line"]).first().reject_reason == reason


def test_unknown_club_fails_the_job_even_if_a_later_rule_rejects(spark):
    for overrides in ({}, {"ft_home_goals": "40"}):
        with pytest.raises(Exception, match="Unmapped match name: Real Madrid"):
            flag_matches(frame(spark, row(away_team="Real Madrid", **overrides)), ["line"]).collect()


def test_kept_row(spark):
    got = clean_matches(frame(spark, row(ft_result=" h ")), ["line"]).kept.first()
    assert (got.match_date, got.home_team, got.away_team) == (dt.date(2026, 8, 12), "Arsenal", "Coventry City")
    assert (got.ft_result, got.referee, got.home_points, got.away_points) == ("H", "M Oliver", 3, 0)
    assert (got.match_id, got.total_goals, got.goal_difference) == (1, 3, 1)
    assert not [c for c in got.asDict() if c.startswith("_") or c == "line"]


def test_first_copy_stays_and_spellings_agree(spark):
    rows = [row(away_team="Sheffield Utd", referee="first"), row(away_team="Sheffield United", referee="second"),
            row(away_team="Sheffield United", match_date="13/08/26")]
    out = clean_matches(frame(spark, *rows), ["line"])
    assert sorted((r.referee, r.match_date.day) for r in out.kept.collect()) == [("M Oliver", 13), ("first", 12)]
    bad = out.rejects.collect()
    assert [(r.referee, r.reject_reason) for r in bad] == [("second", "duplicate on natural key")]


def test_a_rejected_first_copy_does_not_count(spark):
    flagged = flag_matches(frame(spark, row(ft_home_goals="99"), row()), ["line"])
    assert [r.line for r in kept(flagged).collect()] == [1]


def test_hot_key_counts(spark):
    rows = [row() for _ in range(40)] + [row(match_date=f"{d:02d}/09/2026") for d in range(1, 21)]
    flagged = flag_matches(frame(spark, *rows), ["line"])
    assert kept(flagged).count() == 21
    assert [(r.reject_reason, r.rows) for r in reject_counts(flagged).collect()] == [("duplicate on natural key", 39)]


def test_ids_follow_date_and_home_club(spark):
    rows = [row(match_date="14/08/2026"), row(home_team="Wolves"), row(home_team="Everton")]
    got = clean_matches(frame(spark, *rows), ["line"]).kept.orderBy("match_id").collect()
    assert [(r.match_id, r.home_team) for r in got] == [(1, "Everton"), (2, "Wolverhampton Wanderers"), (3, "Arsenal")]


def test_absent_optional_columns_become_null(spark):
    raw = frame(spark, row()).drop("kickoff_time", "home_shots")
    got = clean_matches(raw, ["line"]).kept.first()
    assert got.kickoff_time is None and got.home_shots is None
