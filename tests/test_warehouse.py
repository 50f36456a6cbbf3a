"""The whole pipeline on the synthetic league, against plain Python."""

import datetime as dt
import json
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from touchline.operators.checks import ContractFailure, stop_on_failure
from touchline.operators.warehouse_tests import run_tests
from touchline.params import Params
from touchline.plans import analyses, screens, warehouse
from touchline.plans import clean_players as cp
from touchline.plans.contracts import contract_results
from touchline.plans.warehouse import ALL_TESTS
from touchline.sources import game_documents as docs
from touchline.sources import sinks

AT = "2026-10-01"


@pytest.fixture(scope="module")
def built(spark, world, tmp_path_factory):
    work = str(tmp_path_factory.mktemp("work"))
    at = F.lit(AT).cast("timestamp")
    build = warehouse.refresh(spark, str(world.matches_dir), str(world.game_dir), work, at)
    build.work = work
    return build


def test_row_counts(built, world):
    live = 10 * world.live_rounds
    assert built.landed["dim_team"] == 20 and built.landed["dim_season"] == 2
    assert built.landed["fact_match"] == 380 + live and built.landed["team_match"] == 2 * (380 + live)
    assert built.landed["fact_team_fixture"] == 2 * 379  # one fixture has no gameweek yet
    assert built.landed["fact_player_fixture"] == len(world.facts())
    assert built.landed["player_season"] == 300 and built.landed["player_value"] == 299


def test_all_51_tests_pass_and_notice_damage(built):
    assert len(ALL_TESTS) == 51
    assert run_tests(ALL_TESTS, built.models).filter("failures > 0").count() == 0
    null = F.lit(None)
    damaged = dict(built.models)
    for name, df in built.models.items():
        twice = df.unionByName(df)
        if name == "dim_season":
            twice = twice.withColumn("status", F.lit("over"))
        if name == "fact_match":
            twice = twice.withColumns({"ft_result": F.lit("X"), "home_team_id": F.lit(999), "away_team_id": F.lit(999)})
        if name == "fact_player_fixture":
            twice = twice.filter("gameweek_id <> 3").withColumns(
                {"minutes": F.lit(200), "price_m": F.lit(55.0), "bonus": F.lit(4), "player_id": F.lit(-1)})
            twice = twice.withColumn("gameweek_id", F.when(F.col("gameweek_id") == 1, 0).otherwise(F.col("gameweek_id")))
        if name == "fact_team_fixture":
            twice = twice.withColumn("difficulty", F.lit(6))
        if name == "dim_date":
            twice = df.filter("date_id NOT IN (20260101, 20260102)").unionByName(df.limit(1))
        damaged[name] = twice
    quiet = {(r.model, r.column_name, r.test) for r in run_tests(ALL_TESTS, damaged).filter("failures = 0").collect()}
    assert {t for _, _, t in quiet} == {"not_null"}
    for t in ALL_TESTS:
        if t.kind == "not_null":
            damaged[t.model] = damaged[t.model].withColumn(t.column, null.cast(dict(damaged[t.model].dtypes)[t.column]))
    left = run_tests([t for t in ALL_TESTS if t.kind == "not_null"], damaged).filter("failures = 0").count()
    assert left == 0


def test_unknown_referee_and_names(built, world):
    marts = built.marts
    names = {r.referee_id: r.referee_name for r in marts["dim_referee"].collect()}
    assert names == {0: "Unknown", 1: "A Taylor", 2: "J Müller", 3: "M Oliver"}
    unknown = sum(1 for m in world.matches if not m["Referee"])
    assert marts["fact_match"].filter("referee_id = 0").count() == unknown > 0


def test_calendar(built):
    span = built.marts["dim_date"].agg(F.min("full_date"), F.max("full_date"), F.count(F.lit(1))).first()
    first, last = dt.date(2025, 8, 16), dt.date(2026, 8, 14) + dt.timedelta(days=7 * 37 + 7)
    assert (span[0], span[1], span[2]) == (first, last, (last - first).days + 1)


def test_league_table(built, world):
    m = built.marts
    table = analyses.league_table(m["team_match"], m["dim_team"], m["dim_season"]).collect()
    want = defaultdict(Counter)
    for g in (g for g in world.matches if g["season"] == "2627"):
        for us, them, club in (("H", "A", g["home"]), ("A", "H", g["away"])):
            t, mine, other = want[club], g[f"FT{us}G"], g[f"FT{them}G"]
            t.update(played=1, gf=mine, ga=other, won=mine > other, drawn=mine == other, lost=mine < other,
                     points=3 * (mine > other) + (mine == other))
    assert len(table) == 20
    for r in table:
        t = want[r.team_name]
        assert (r.played, r.won, r.drawn, r.lost, r.gf, r.ga, r.points) == tuple(
            t[k] for k in ("played", "won", "drawn", "lost", "gf", "ga", "points"))
        better = sum((o["points"], o["gf"] - o["ga"], o["gf"]) > (r.points, r.gd, r.gf) for o in want.values())
        assert r.position == better + 1


def test_player_reports(built, world):
    season = {r.fpl_element_id: r for r in built.marts["player_season"].join(
        built.marts["dim_player"].select("player_id", "fpl_element_id"), "player_id").collect()}
    value = {r.fpl_element_id: r for r in built.marts["player_value"].join(
        built.marts["dim_player"].select("player_id", "fpl_element_id"), "player_id").collect()}
    assert (season[1].fixtures, season[1].appearances, season[1].minutes, season[1].points_per_million) == (0, 0, None, None)
    assert 1 not in value
    for player in (2, 77, 150, 299):
        rows = world.history[player]
        last = max(rows, key=lambda e: (e["round"], e["kickoff_time"], e["fixture"]))
        points, price = sum(e["total_points"] for e in rows), world.elements[player - 1]["now_cost"] / 10
        assert season[player].points == points and season[player].price_m == price
        assert season[player].points_per_million == pytest.approx(points / price, abs=0.0051)
        assert season[player].appearances == sum(e["minutes"] > 0 for e in rows)
        assert (value[player].latest_price_m, value[player].owners) == (last["value"] / 10, last["selected"])
        assert value[player].full_games == sum(e["minutes"] >= 60 for e in rows)


def test_double_gameweek_and_rolling_form(built, world):
    m = built.marts
    doubled = screens.double_periods(m["fact_player_fixture"])
    assert doubled.agg(F.min("gameweek_id"), F.max("gameweek_id"), F.max("fixtures")).first()[:] == (5, 5, 2)
    form = analyses.rolling_form(m["fact_player_fixture"], m["dim_player"], m["dim_team"], m["dim_position"])
    got = {(r.web_name, r.gameweek_id): r.points_last_5 for r in form.collect()}
    want = {}
    for player, rows in world.history.items():
        for gw in {e["round"] for e in rows or []}:
            want[f"P{player}", gw] = sum(e["total_points"] for e in rows if gw - 4 <= e["round"] <= gw)
    assert got == want


def test_races_and_streaks(built, world):
    m = built.marts
    games = analyses.dated(m["team_match"], m["dim_date"])
    for hot in (0, 10**6):
        race = analyses.title_race(games, m["dim_team"], m["dim_season"], hot_rows=hot).collect()
        table = {r.team_name: r.points for r in analyses.league_table(m["team_match"], m["dim_team"], m["dim_season"]).collect()}
        assert {r.team_name: r.cumulative_points for r in race if r.played == world.live_rounds} == table
        runs = analyses.longest_unbeaten(games, m["dim_team"], m["dim_season"], hot_rows=hot).collect()
        best = 0
        for season in ("2526", "2627"):
            for club in {g["home"] for g in world.matches}:
                run = 0
                for g in (g for g in world.matches if g["season"] == season and club in (g["home"], g["away"])):
                    run = 0 if g["FTR"] == ("A" if g["home"] == club else "H") else run + 1
                    best = max(best, run)
        assert runs[0].streak_length == best and len(runs) == 15


def test_fixture_questions(built, world, spark):
    m = built.marts
    outlook = analyses.fixture_outlook(m["fact_team_fixture"], m["dim_team"], m["dim_gameweek"])
    rows = outlook.collect()
    assert len(rows) == 20 and all(r.fixtures_in_window == 5 and len(r.opponents.split(", ")) == 5 for r in rows)
    assert screens.outlook_panel(outlook).count() == 10
    done = m["dim_gameweek"].withColumn("finished", F.lit(True))
    assert analyses.fixture_outlook(m["fact_team_fixture"], m["dim_team"], done).count() == 0
    first = world.live_rounds + 1
    wide = screens.difficulty_matrix(m["fact_team_fixture"], m["dim_team"], list(range(first, first + 5)))
    assert wide.count() == 20


def test_other_analyses_answer(built):
    m = built.marts
    report, params = m["player_season"], Params(value_minutes=90)
    assert analyses.best_value(report, params).count() == 30
    assert all(r.selected_by_percent < 5 for r in analyses.differentials(report, params).collect())
    assert analyses.position_returns(report, m["dim_position"], params).count() == 4
    seasons = analyses.season_vs_baseline(m["fact_match"], m["dim_season"]).collect()
    assert [r.status for r in seasons] == ["completed", "in_progress"] and seasons[0].vs_baseline_pts == 0
    shares = analyses.bonus_share(m["fact_player_fixture"], m["dim_player"], m["dim_team"], m["dim_position"], params)
    assert shares.count() == 25
    assert screens.what_tracks_points(m["fact_player_fixture"], m["dim_player"]).count() == 6
    view = screens.facet_view(report, ["MID", "FWD"], 12.0, 90)
    assert screens.view_headline(view).first().shown == view.count()
    assert screens.concentration(view).count() == 1 and screens.top_residuals(view).count() == 10
    pick = screens.player_choices(view).first()
    assert " · " in pick.label
    detail = screens.player_detail(m["fact_player_fixture"], m["dim_team"], pick.player_id).collect()
    assert [r.gameweek_id for r in detail] == sorted(r.gameweek_id for r in detail) and detail[0].fixture.endswith(")")
    histogram, moments, split = screens.goals_and_results(m["fact_match"])
    assert histogram.agg(F.sum("matches")).first()[0] == m["fact_match"].count()
    assert split.agg(F.sum("share_pct")).first()[0] == pytest.approx(100, abs=1e-4)


def test_rejects_log_and_export(built, spark, world):
    got = {r.reject_reason: r.rows for r in warehouse.reject_report(spark, f"{built.work}/interim").collect()}
    assert got == {"fixture not yet played": 1, "duplicate on natural key": 1}
    log = spark.read.parquet(f"{built.work}/warehouse/refresh_log").collect()
    assert [(r.refreshed_at, r.live_matches, r.latest_gameweek) for r in log] == [
        ("2026-10-01T00:00:00+00:00", 10 * world.live_rounds, world.live_rounds)]
    assert log[0].latest_match_date == "2026-09-19"
    import glob
    part = sorted(glob.glob(f"{built.work}/export/dim_gameweek/*.csv"))[0]
    text = open(part, "rb").read()
    assert text.startswith(b"\xef\xbb\xbfgameweek_id,") and b"2026-08-14 23:30:00+00:00,1,0,0," in text
    back = sinks.read_export(spark, f"{built.work}/export/dim_team")
    assert back.columns == ["team_id", "team_name"] and back.count() == 20


def test_second_load_appends_to_the_log(built, spark):
    warehouse.load(spark, f"{built.work}/interim", f"{built.work}/warehouse", F.lit("2026-10-02").cast("timestamp"))
    assert spark.read.parquet(f"{built.work}/warehouse/refresh_log").count() == 2


def test_contracts_hold_and_break(built, spark):
    tables = [spark.read.parquet(f"{built.work}/interim/{n}") for n in ("matches_clean", "players", "positions", "history")]
    matches, players, positions, history = tables
    at = F.lit(AT).cast("date")
    results = contract_results(*tables, as_of=at).collect()
    assert len(results) == 13 and all(r.passed for r in results)
    live = F.col("is_current_season")
    broken = contract_results(
        matches.withColumn("ft_result", F.when(live, F.lit(None)).otherwise(F.lit("D"))).filter(live | (F.col("match_id") > 5))
        .unionByName(matches.filter("match_id = 7")),
        players.withColumn("price_m", F.col("price_m") * 10).withColumn("team_name", F.lit("Real Madrid")).filter("position_id <> 1"),
        positions, history.withColumn("minutes", F.lit(200)).unionByName(history.limit(1)), F.lit("2026-01-01").cast("date"),
        Params(max_matches_played_spread=-1, matches_per_completed_season=50))
    rows = {r.name: r for r in broken.collect()}
    assert not any(r.passed for r in rows.values())
    assert rows["game clubs all appear in match data"].detail == "game-only: ['Real Madrid']"
    assert rows["enough players per position for a legal squad"].detail == "short: {1: 2}"
    assert rows["no nulls in required columns"].detail == "nulls: {'ft_result': 60}"
    assert rows["completed seasons have 50 matches"].detail == "off: {'2526': 376}"
    with pytest.raises(ContractFailure, match="13 data quality"):
        stop_on_failure(broken)


def test_unknown_club_id_fails(spark, world, tmp_path):
    boot = json.loads(json.dumps(world.bootstrap))
    boot["elements"][0]["team"] = 77
    (tmp_path / "bootstrap.json").write_text(json.dumps(boot))
    tables = docs.bootstrap_tables(spark, str(tmp_path))
    with pytest.raises(Exception, match="Unknown club id: 77"):
        cp.players(tables["elements"], cp.clubs(tables["teams"])).collect()


def test_documents(spark, world):
    boot = docs.bootstrap_tables(spark, str(world.game_dir))
    manifest = docs.sweep_manifest(boot["elements"], boot["events"], F.lit("now")).first()
    assert (manifest.players, manifest.current_gameweek) == (300, world.live_rounds)
    entries = docs.histories(spark, str(world.game_dir), boot["elements"])
    assert entries.count() == len(world.facts())  # the departed player's file is left out
    twice = cp.history(entries.unionByName(entries), cp.clubs(boot["teams"]))
    assert twice.count() == len(world.facts())
    assert docs.member_files(spark, str(world.game_dir)).count() == 300


def test_sql_over_the_landed_tables(built, spark):
    warehouse.open_views(spark, f"{built.work}/warehouse", ["fact_player_fixture", "dim_team"])
    rows = warehouse.ask(spark, """
        SELECT f.gameweek_id, f.total_points, o.team_name AS opponent FROM fact_player_fixture f
        LEFT JOIN dim_team o ON o.team_id = f.opponent_team_id
        WHERE f.player_id = :player ORDER BY f.gameweek_id""", player=7).collect()
    want = screens.player_detail(built.marts["fact_player_fixture"], built.marts["dim_team"], 7).collect()
    assert [(r.gameweek_id, r.total_points) for r in rows] == [(r.gameweek_id, r.total_points) for r in want] != []


def test_first_copy_in_the_file_is_kept(spark, world, tmp_path):
    entry = world.history[2][0]
    copies = [entry | {"minutes": 90, "total_points": 9}, entry | {"minutes": 1, "total_points": 0}]
    (tmp_path / "bootstrap.json").write_text(json.dumps(world.bootstrap))
    (tmp_path / "player_2.json").write_text(json.dumps({"history": copies}))
    boot = docs.bootstrap_tables(spark, str(tmp_path))
    rows = cp.history(docs.histories(spark, str(tmp_path), boot["elements"]), cp.clubs(boot["teams"])).collect()
    assert [(r.player_fixture_id, r.minutes) for r in rows] == [(1, 90)] and "_place" not in rows[0].asDict()


def test_a_refresh_without_new_data_does_nothing(spark, world, tmp_path):
    folders, work, at = (str(world.matches_dir), str(world.game_dir)), str(tmp_path / "work"), F.lit(AT).cast("timestamp")
    first = warehouse.refresh_if_due(spark, *folders, work, at)
    finalised = max(e["id"] for e in world.bootstrap["events"] if e["finished"] and e["data_checked"])
    assert first is not None and warehouse.stored_mark(spark, work) == finalised
    assert warehouse.refresh_if_due(spark, *folders, work, at) is None
    assert spark.read.parquet(f"{work}/warehouse/refresh_log").count() == 1
    runs = sinks.read_runs(spark, f"{work}/runs").collect()
    assert [(r.stage, r.status) for r in sorted(runs, key=lambda r: r.finished_at)].count(("export", "ok")) == 1 and len(runs) == 6
    assert {r.stage for r in spark.read.parquet(f"{work}/warehouse/pipeline_run").collect()} == {"clean", "contracts"}
    with pytest.raises(FileNotFoundError):
        warehouse.refresh(spark, *folders, work, at, Params(seasons=("9999",)))
    failed = sinks.read_runs(spark, f"{work}/runs").filter("status = 'failed'").collect()
    assert [(r.stage, "9999" in r.message) for r in failed] == [("clean", True)]
    match = first.marts["fact_match"]
    assert "PartitionFilters: [isnotnull(season_id" in match.filter("season_id = 2")._jdf.queryExecution().toString()
