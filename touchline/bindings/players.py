"""Registered queries on players, their fixtures and season reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.bindings import inputs as b
from touchline.bindings.registry import query
from touchline.functions.expressions import round_half_away
from touchline.operators.joins import look_up, small_side
from touchline.operators.stats import correlation_matrix as matrix
from touchline.operators.stats import fit_line, usage_share
from touchline.operators.windows import trailing_sum
from touchline.plans import analyses, reports, screens

ctes = b.with_ctes
REPORT = ctes(b.PLAYERS_SQL, b.FACTS_SQL, b.SEASON_REPORT_SQL)
FACTS = ctes(b.PLAYERS_SQL, b.FACTS_SQL)
VIEW = "WHERE position_short IN ('ECO', 'LAR', 'PRO') AND price_m <= 9.9 AND minutes >= 900"


def dims(spark, sf):
    """Players, and the two dimensions whose size is checked before they are broadcast."""
    return (b.parts_as_players(spark, sf), small_side(b.brands_as_teams(spark, sf)),
            small_side(b.types_as_positions(spark, sf)))


def season_report(spark, sf):
    return reports.player_season(*dims(spark, sf), b.lines_as_facts(spark, sf))


def view(spark, sf):
    return screens.facet_view(season_report(spark, sf), ["ECO", "LAR", "PRO"], 9.9, 900)


@query("player_season", REPORT + "SELECT * FROM player_season")
def player_season(spark, sf):
    return season_report(spark, sf)


@query("zero_fact_entities", """
WITH used AS (SELECT l_orderkey, count(*) AS n, count(*) FILTER (WHERE l_returnflag <> 'N') AS played,
  sum(if(l_returnflag = 'N', 0, l_quantity::INTEGER * 2))::BIGINT AS m, sum(l_linenumber)::BIGINT AS tp,
  sum(round(l_discount * 100))::BIGINT AS g, sum(round(l_tax * 100))::BIGINT AS a,
  count(*) FILTER (WHERE l_linestatus = 'F') AS cs, sum(l_linenumber % 4)::BIGINT AS b FROM lineitem GROUP BY 1)
SELECT o_orderkey AS player_id, o_orderstatus AS web_name, o_orderpriority AS full_name, o_totalprice AS price_m,
  0.0::DOUBLE AS selected_by_percent, 'a' AS status, o_orderpriority AS team_name, o_orderstatus AS position_short,
  o_orderstatus AS position_name, ifnull(n, 0) AS fixtures, ifnull(played, 0) AS appearances, m AS minutes, tp AS points,
  g AS goals, a AS assists, cs AS clean_sheets, b AS bonus, round(tp / o_totalprice, 2) AS points_per_million
FROM orders LEFT JOIN used ON l_orderkey = o_orderkey""")
def zero_fact_entities(spark, sf):
    """Orders as players whose lines are their fixtures: those without lines keep a row."""
    orders = b.table(spark, sf, "orders")
    team, position = F.col("o_orderpriority"), F.col("o_orderstatus")
    players = orders.select(
        F.col("o_orderkey").alias("player_id"), position.alias("web_name"), team.alias("full_name"), team.alias("team_id"),
        position.alias("position_id"), F.col("o_totalprice").alias("price_m"), F.lit(0.0).alias("selected_by_percent"),
        F.lit("a").alias("status"))
    teams = orders.select(team.alias("team_id"), team.alias("team_name")).distinct()
    positions = orders.select(position.alias("position_id"), position.alias("position_name"), position.alias("position_short")).distinct()
    lines = b.lines_as_facts(spark, sf).withColumn("player_id", F.col("player_fixture_id"))
    return reports.player_season(players, small_side(teams), small_side(positions), lines)


@query("value_top30", REPORT + """
SELECT web_name, team_name, position_short, price_m, points, points_per_million, appearances, minutes,
  selected_by_percent
FROM player_season WHERE minutes >= 270 ORDER BY points_per_million DESC NULLS LAST, player_id LIMIT 30""")
def value_top30(spark, sf):
    return analyses.best_value(season_report(spark, sf))


@query("differentials", REPORT + """
SELECT web_name, team_name, position_short, price_m, points, points_per_million, selected_by_percent, minutes
FROM player_season WHERE selected_by_percent < 5.0 AND minutes >= 270 AND points > 0
ORDER BY points_per_million DESC NULLS LAST, player_id LIMIT 25""")
def differentials(spark, sf):
    return analyses.differentials(season_report(spark, sf))


@query("category_returns", REPORT.rstrip() + """, regulars AS (
  SELECT position_name, list(price_m) AS prices, list(points) AS totals, list(points_per_million) AS rates
  FROM player_season WHERE minutes >= 270 GROUP BY 1)
SELECT position_name, len(totals)::BIGINT AS players, list_max(totals) AS best_points, round(list_avg(totals), 1) AS avg_points,
  round(list_avg(prices), 2) AS avg_price, round(list_avg(rates), 2) AS avg_ppm,
  (SELECT squad_select FROM positions p WHERE p.position_name = regulars.position_name) AS squad_slots FROM regulars""")
def category_returns(spark, sf):
    return analyses.position_returns(season_report(spark, sf), b.types_as_positions(spark, sf))


FORM_SQL = FACTS.rstrip() + """, slots AS (SELECT DISTINCT player_id, gameweek_id FROM facts)
SELECT web_name, team_name, position_short, price_m, gameweek_id, points_last_5, minutes_last_5
FROM (
  SELECT s.player_id, s.gameweek_id, sum(f.total_points)::BIGINT AS points_last_5, sum(f.minutes)::BIGINT AS minutes_last_5
  FROM slots s JOIN facts f ON f.player_id = s.player_id AND s.gameweek_id - f.gameweek_id IN (0, 1, 2, 3, 4)
  GROUP BY s.player_id, s.gameweek_id)
NATURAL JOIN (SELECT * EXCLUDE (full_name, selected_by_percent, status) FROM players)
NATURAL JOIN teams NATURAL JOIN (SELECT position_id, position_short FROM positions)"""


@query("rolling_form", FORM_SQL)
def rolling_form(spark, sf):
    return analyses.rolling_form(b.lines_as_facts(spark, sf), *dims(spark, sf))


@query("rolling_user_form", ctes(b.USER_DAYS_SQL, """
d AS (SELECT player_id, gameweek_id, CAST(sum(minutes) AS BIGINT) AS mi, sum(value) AS v FROM user_days GROUP BY ALL)""") + """
SELECT player_id, gameweek_id, CAST(sum(mi) OVER w AS BIGINT) AS minutes_last_5, round(sum(v) OVER w, 4) AS value_last_5
FROM d WINDOW w AS (PARTITION BY player_id ORDER BY gameweek_id RANGE BETWEEN 4 PRECEDING AND CURRENT ROW)""")
def rolling_user_form(spark, sf):
    form = trailing_sum(b.user_days(spark, sf), ["player_id"], "gameweek_id",
                        {"minutes_last_5": "minutes", "value_last_5": "value"})
    return form.withColumn("value_last_5", round_half_away(F.col("value_last_5"), 4))


@query("bonus_share", FACTS.rstrip() + """, outings AS (
  SELECT player_id, list(bps) AS ratings, sum(minutes) AS m, sum(bonus)::BIGINT AS b, sum(total_points)::BIGINT AS t
  FROM facts WHERE minutes > 0 GROUP BY 1),
placed AS (SELECT *, row_number() OVER (ORDER BY b DESC, player_id) AS place FROM outings WHERE m >= 270)
SELECT web_name, (SELECT team_name FROM teams WHERE teams.team_id = players.team_id) AS team_name,
  (SELECT position_short FROM positions WHERE positions.position_id = players.position_id) AS position_short, price_m,
  b AS bonus_points, t AS total_points, CASE WHEN t <> 0 THEN round(b / t * 100.0::DOUBLE, 1) END AS pct_from_bonus,
  round(list_avg(ratings), 1) AS avg_bps
FROM players JOIN placed USING (player_id) WHERE place <= 25""")
def bonus_share(spark, sf):
    return analyses.bonus_share(b.lines_as_facts(spark, sf), *dims(spark, sf))


LATEST_BY = ("gameweek_id", "date_id", "fpl_fixture_id", "price_m", "selected", "transfers_in",
             "transfers_out", "assists")


@query("latest_value", FACTS.rstrip() + f""",
newest AS (
  SELECT DISTINCT ON (player_id) player_id, price_m AS latest_price_m, selected AS owners FROM facts
  ORDER BY player_id, {', '.join(c + ' DESC' for c in LATEST_BY)}),
games AS (
  SELECT player_id, count(*) AS squad_games, count(*) FILTER (WHERE minutes >= 60) AS full_games,
    count(*) FILTER (WHERE minutes = 0) AS unused, sum(minutes)::BIGINT AS minutes, sum(total_points)::BIGINT AS total_points
  FROM facts GROUP BY player_id)
SELECT player_id, web_name, (SELECT position_short FROM positions q WHERE q.position_id = players.position_id) AS position,
  (SELECT team_name FROM teams t WHERE t.team_id = players.team_id) AS team_name, squad_games, full_games, unused, minutes,
  total_points, latest_price_m, owners,
  CASE WHEN latest_price_m <> 0 THEN round(total_points / latest_price_m, 2) END AS points_per_million,
  round(100.0::DOUBLE * full_games / squad_games, 0) AS start_rate_pct
FROM newest JOIN games USING (player_id) JOIN players USING (player_id)""")
def latest_value(spark, sf):
    return reports.player_value(*dims(spark, sf), b.lines_as_facts(spark, sf), latest_by=LATEST_BY)


@query("facet_screen", REPORT + f"SELECT * FROM player_season {VIEW}")
def facet_screen(spark, sf):
    return view(spark, sf)


@query("headline_metrics", REPORT + f"""
SELECT count(*) AS shown, max(points_per_million) AS best, round(median(price_m), 6) AS median
FROM player_season {VIEW}""")
def headline_metrics(spark, sf):
    return screens.view_headline(view(spark, sf)).withColumn("median", round_half_away(F.col("median"), 6))


@query("shortlist", REPORT + f"""
SELECT web_name, team_name, position_short, price_m, points, points_per_million FROM player_season {VIEW}
ORDER BY points_per_million DESC, player_id LIMIT 15""")
def shortlist(spark, sf):
    return screens.shortlist(view(spark, sf))


@query("top_concentration", REPORT + f"""
SELECT team_name, count(*) AS rows, count(*) >= 4 AS concentrated FROM (
  SELECT team_name FROM player_season {VIEW} ORDER BY points_per_million DESC, player_id LIMIT 15)
GROUP BY 1 ORDER BY rows DESC, team_name LIMIT 1""")
def top_concentration(spark, sf):
    return screens.concentration(view(spark, sf))


FIT = f"""
fit AS (SELECT count(*) AS n, regr_slope(points, price_m) AS slope, regr_intercept(points, price_m) AS intercept,
  corr(points, price_m) AS r FROM player_season {VIEW})"""


@query("line_fit", REPORT.rstrip() + "," + FIT + """
SELECT n, round(slope, 6) AS slope, round(intercept, 6) AS intercept, round(r, 6) AS r, round(r * r, 6) AS r_squared
FROM fit""")
def line_fit(spark, sf):
    line = fit_line(view(spark, sf), "price_m", "points")
    return line.select("n", *[round_half_away(F.col(c), 6).alias(c) for c in line.columns[1:]])


RESIDUALS = REPORT.rstrip() + "," + FIT + f"""
SELECT player_id, web_name, points, round(intercept + slope * price_m, 5) AS expected,
  round(points - (intercept + slope * price_m), 5) AS residual
FROM player_season CROSS JOIN fit {VIEW}"""


def rounded_residuals(df):
    return df.select("player_id", "web_name", "points",
                     *[round_half_away(F.col(c), 5).alias(c) for c in ("expected", "residual")])


@query("line_fit_residuals", RESIDUALS)
def line_fit_residuals(spark, sf):
    return rounded_residuals(screens.expected_points(view(spark, sf)))


@query("top_residuals", f"SELECT * FROM ({RESIDUALS}) ORDER BY residual DESC, player_id LIMIT 10")
def top_residuals(spark, sf):
    return rounded_residuals(screens.top_residuals(view(spark, sf)))


@query("player_choices", REPORT + f"""
SELECT player_id, web_name || ' · ' || team_name AS label FROM player_season {VIEW}""")
def player_choices(spark, sf):
    return screens.player_choices(view(spark, sf))


@query("entity_detail", REPORT + """
SELECT gameweek_id, total_points, minutes, bonus, price_m, team_name AS opponent, was_home,
  CAST(gameweek_id AS VARCHAR) || ' ' || coalesce(team_name, '?') || CASE WHEN was_home THEN ' (H)' ELSE ' (A)' END AS fixture
FROM facts LEFT JOIN teams ON team_name = opponent_name
WHERE player_id = (SELECT player_id FROM player_season ORDER BY points DESC NULLS LAST, player_id LIMIT 1)""")
def entity_detail(spark, sf):
    teams = small_side(b.brands_as_teams(spark, sf))
    named = look_up(b.lines_as_facts(spark, sf), teams, {"opponent_name": "team_name"},
                             {"team_id": "opponent_team_id"})
    first_choice = screens.player_choices(season_report(spark, sf)).limit(1).select("player_id")
    return screens.player_detail(named, teams, first_choice.scalar())


@query("what_tracks_points", FACTS.rstrip() + """, t AS (
  SELECT player_id, sum(total_points) AS points, sum(f.minutes) AS minutes, sum(bps) AS bps, avg(ict_index) AS ict_index,
    sum(goals_scored) AS goals, sum(assists) AS assists, any_value(p.price_m) AS price_m
  FROM facts f JOIN players p USING (player_id) GROUP BY player_id HAVING sum(f.minutes) >= 180)
SELECT measure, round(r, 6) AS r FROM (
  SELECT corr(points, minutes) AS minutes, corr(points, bps) AS bps, corr(points, ict_index) AS ict_index,
    corr(points, goals) AS goals, corr(points, assists) AS assists, corr(points, price_m) AS price_m FROM t)
UNPIVOT (r FOR measure IN (minutes, bps, ict_index, goals, assists, price_m))""")
def what_tracks_points(spark, sf):
    return screens.what_tracks_points(b.lines_as_facts(spark, sf), b.parts_as_players(spark, sf))


MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
PAIRS = [(x, y) for i, x in enumerate(MEASURES) for y in MEASURES[i:]]


@query("correlation_matrix", " UNION ALL ".join(
    f"SELECT '{x}' AS first, '{y}' AS second, round(corr({x}, {y}), 6) AS r FROM lineitem" for x, y in PAIRS))
def correlation_matrix(spark, sf):
    return matrix(b.table(spark, sf, "lineitem"), MEASURES)


@query("usage_share", """
SELECT o_orderpriority, count(*) AS members,
  CAST(sum(CASE WHEN used IS NULL OR used = 0 THEN 1 ELSE 0 END) AS BIGINT) AS never_used,
  CAST(sum(CASE WHEN coalesce(used, 0) < 90 THEN 1 ELSE 0 END) AS BIGINT) AS under_floor,
  round(100.0::DOUBLE * sum(CASE WHEN coalesce(used, 0) < 90 THEN 1 ELSE 0 END) / count(*), 0) AS pct_under
FROM orders LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS used FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
GROUP BY 1""")
def order_usage(spark, sf):
    return usage_share(b.table(spark, sf, "orders"), b.table(spark, sf, "lineitem"), "l_orderkey", "o_orderkey",
                       "o_orderpriority", "l_quantity")


@query("above_average", """
SELECT p_partkey, p_retailprice FROM part WHERE p_retailprice >= (SELECT avg(p_retailprice) FROM part)""")
def above_average(spark, sf):
    parts = b.table(spark, sf, "part")
    bound = parts.agg(F.avg("p_retailprice").alias("_mean"))
    return parts.join(F.broadcast(bound), F.col("p_retailprice") >= F.col("_mean")).select("p_partkey", "p_retailprice")
