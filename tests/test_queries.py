"""Every registered query against its SQL on the small tables, and the shape of the plans."""

import re

import pytest

import compare
from touchline.bindings import inputs as b
from touchline.bindings.all_queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return compare.duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    text = plan(df)
    assert "CartesianProduct" not in text and "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    assert compare.compare(df, duck, ORACLES[name]) is None


def test_facts_are_never_moved_to_one_task(spark):
    for name in ("surrogate_key", "points_race", "unbeaten_runs", "two_sided", "player_season", "reject_rows",
                 "dedup_first", "latest_value", "rolling_form"):
        text = plan(QUERIES[name](spark, SF))
        # The one-row-per-partition offsets of the dense key are the only single-task step.
        assert text.count("SinglePartition") <= (1 if name == "surrogate_key" else 0), name


def test_season_filter_and_columns_reach_the_scan(spark):
    text = plan(b.keyed_matches(spark, SF, b.LIVE_START).select("season_id", "home_team_id"))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate", text)
    assert "o_totalprice" not in text and "l_extendedprice" not in text
    text = plan(QUERIES["repeated_dates"](spark, SF))
    assert re.search(r"ReadSchema: struct<o_custkey:bigint,o_orderdate:\w+>", text)


def test_texts_are_not_shuffled(spark):
    text = plan(QUERIES["dedup_first"](spark, SF))
    assert not [line for line in text.splitlines() if "Exchange hashpartitioning(text" in line]
    assert "sha2" in text


def test_two_sides_come_from_one_scan(spark):
    text = plan(QUERIES["two_sided"](spark, SF))
    assert text.count("lineitem.parquet") == 1 and "Union" not in text
