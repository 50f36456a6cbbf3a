"""Registered queries on matches, fixtures and running results."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.bindings import inputs as b
from touchline.bindings.registry import query
from touchline.functions.expressions import round_half_away
from touchline.operators.aggregates import mean_of_means, repeated, value_split
from touchline.operators.reshape import both_differences, set_difference
from touchline.operators.stats import describe, mean_interval
from touchline.plans import analyses, reports, screens

ctes = b.with_ctes


def seasons(spark, sf):
    """A row per year: what Spark sees of the aggregate's size at run time decides how it is joined."""
    return b.years_as_seasons(spark, sf)


@query("league_table", ctes(b.MATCHES_SQL, """
live AS (SELECT home_team_id AS h, away_team_id AS a, ft_home_goals AS x, ft_away_goals AS y FROM matches WHERE season_id = 2001),
halves AS (
  SELECT h AS team, count(*) AS n, count(*) FILTER (x > y) AS w, count(*) FILTER (x = y) AS d, sum(x) AS f, sum(y) AS g FROM live GROUP BY h
  UNION ALL
  SELECT a, count(*), count(*) FILTER (y > x), count(*) FILTER (x = y), sum(y), sum(x) FROM live GROUP BY a),
totals AS (
  SELECT team, sum(n)::BIGINT AS n, sum(w)::BIGINT AS w, sum(d)::BIGINT AS d, sum(f)::BIGINT AS f, sum(g)::BIGINT AS g,
    (sum(3 * w + d), sum(f - g), sum(f)) AS strength FROM halves GROUP BY team)""") + """
SELECT (SELECT count(*) + 1 FROM totals other WHERE other.strength > t.strength) AS position,
  (SELECT n_name FROM nation WHERE n_nationkey = team) AS team_name, n AS played, w AS won, d AS drawn, n - w - d AS lost,
  f AS gf, g AS ga, f - g AS gd, 3 * w + d AS points FROM totals t""")
def league_table(spark, sf):
    rows = reports.team_match(b.keyed_matches(spark, sf))
    return analyses.league_table(rows, b.nations_as_teams(spark, sf), seasons(spark, sf))


@query("season_vs_baseline", ctes(b.MATCHES_SQL, """
years AS (
  SELECT season_id AS y, count(*) AS matches, avg((ft_home_goals > ft_away_goals)::INTEGER) AS wins,
    avg(ft_home_goals + ft_away_goals) AS goals FROM matches GROUP BY 1)""") + """
SELECT y::VARCHAR AS season_label, if(y = 2001, 'in_progress', 'completed') AS status, matches,
  round(wins * 100, 1) AS home_win_pct, round(goals, 2) AS goals_per_game,
  round((wins - avg(wins) FILTER (y <> 2001) OVER ()) * 100, 1) AS vs_baseline_pts,
  round(goals - avg(goals) FILTER (y <> 2001) OVER (), 2) AS goals_vs_baseline
FROM years""")
def season_vs_baseline(spark, sf):
    return analyses.season_vs_baseline(b.keyed_matches(spark, sf), seasons(spark, sf))


@query("baseline_means", ctes(b.MATCHES_SQL, """
per AS (SELECT season_id, avg(total_goals) AS g, avg(goal_difference) AS d FROM matches GROUP BY 1)""") + """
SELECT round(avg(g), 6) AS total_goals, round(avg(d), 6) AS goal_difference FROM per""")
def baseline_means(spark, sf):
    means = mean_of_means(b.keyed_matches(spark, sf), ["season_id"], ["total_goals", "goal_difference"])
    return means.select(*[round_half_away(F.col(c), 6).alias(c) for c in means.columns])


OUTLOOK_SQL = ctes(b.MATCHES_SQL, b.FIXTURES_SQL, b.GAMEWEEKS_SQL, """
coming AS (SELECT unnest(range(g, g + 5)) AS gameweek_id FROM (SELECT min(gameweek_id) FILTER (NOT finished) AS g FROM gameweeks)),
names AS (SELECT map(list(n_nationkey), list(n_name)) AS of FROM nation),
cards AS (
  SELECT team_id, list(difficulty) AS hard, count(*) FILTER (is_home) AS at_home, list(of[opponent_team_id]) AS against
  FROM fixtures SEMI JOIN coming USING (gameweek_id) CROSS JOIN names WHERE NOT finished GROUP BY team_id),
outlook AS (
  SELECT of[team_id] AS team_name, len(hard)::BIGINT AS fixtures_in_window, round(list_avg(hard), 2) AS avg_difficulty,
    at_home AS home_fixtures, array_to_string(list_sort(against), ', ') AS opponents FROM cards CROSS JOIN names)""")


def outlook(spark, sf):
    return analyses.fixture_outlook(b.nation_fixtures(spark, sf),
                                    b.nations_as_teams(spark, sf), b.months_as_gameweeks(spark, sf))


@query("fixture_outlook", OUTLOOK_SQL + "SELECT * FROM outlook")
def fixture_outlook(spark, sf):
    return outlook(spark, sf)


@query("outlook_panel", OUTLOOK_SQL + """
SELECT team_name, fixtures_in_window, avg_difficulty,
  CASE WHEN length(opponents) > 34 THEN substr(opponents, 1, 34) || '…' ELSE opponents END AS opponents
FROM outlook ORDER BY avg_difficulty, team_name LIMIT 10""")
def outlook_panel(spark, sf):
    return screens.outlook_panel(outlook(spark, sf))


@query("pivot_outlook", ctes(b.MATCHES_SQL, b.FIXTURES_SQL, """
means AS (SELECT n_name AS team_name, gameweek_id, avg(difficulty) AS m FROM fixtures
  JOIN nation ON n_nationkey = team_id WHERE NOT finished AND gameweek_id BETWEEN 66 AND 70 GROUP BY ALL)""") + """
SELECT team_name, max(CASE WHEN gameweek_id = 66 THEN round(m, 6) END) AS gw66,
  max(CASE WHEN gameweek_id = 67 THEN round(m, 6) END) AS gw67,
  max(CASE WHEN gameweek_id = 68 THEN round(m, 6) END) AS gw68,
  max(CASE WHEN gameweek_id = 69 THEN round(m, 6) END) AS gw69,
  max(CASE WHEN gameweek_id = 70 THEN round(m, 6) END) AS gw70, round(avg(m), 6) AS mean
FROM means GROUP BY team_name""")
def pivot_outlook(spark, sf):
    wide = screens.difficulty_matrix(b.nation_fixtures(spark, sf),
                                     b.nations_as_teams(spark, sf), [66, 67, 68, 69, 70])
    return wide.select("team_name", *[round_half_away(F.col(c), 6).alias(c) for c in wide.columns[1:]])


RUNS_SQL = ctes(b.GAMES_SQL, """
defeats AS (
  SELECT team_id, season_id, list((full_date, match_id)) AS lost FROM games WHERE points = 0 GROUP BY ALL),
runs AS (
  SELECT team_id, season_id, count(*) AS streak_length, min(full_date) AS started, max(full_date) AS ended
  FROM games LEFT JOIN defeats USING (team_id, season_id)
  WHERE points <> 0
  GROUP BY team_id, season_id, coalesce(len(list_filter(lost, lambda x: x < (full_date, match_id))), 0))""")


@query("points_race", ctes(b.GAMES_SQL) + """
SELECT team_id, season_id, full_date, match_id, points,
  row_number() OVER w AS played, CAST(sum(points) OVER w AS BIGINT) AS cumulative_points
FROM games WINDOW w AS (PARTITION BY team_id ORDER BY full_date, match_id
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def points_race(spark, sf):
    return analyses.points_race(b.customer_games(spark, sf), ["full_date", "match_id"])


@query("points_race_chunked", ctes(b.GAMES_SQL) + """
SELECT team_id, season_id, full_date, match_id, nullif(points, 0) AS points,
  count(*) OVER w AS played, CAST(sum(nullif(points, 0)) OVER w AS BIGINT) AS cumulative_points
FROM games WINDOW w AS (PARTITION BY team_id ORDER BY full_date, match_id
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def points_race_chunked(spark, sf):
    """Every team counts as hot, and defeats have NULL points: the cut groups carry totals and NULLs on."""
    games = b.customer_games(spark, sf).withColumn("points", F.nullif("points", F.lit(0)))
    return analyses.points_race(games, ["full_date", "match_id"], hot_rows=0)


@query("unbeaten_runs_chunked", RUNS_SQL + "SELECT * FROM runs")
def unbeaten_runs_chunked(spark, sf):
    """The runs again, every group taken for a hot one."""
    return analyses.unbeaten_runs(b.customer_games(spark, sf), ["full_date", "match_id"], "full_date", hot_rows=0)


@query("title_race", ctes(b.GAMES_SQL) + """
SELECT c_name AS team_name, row_number() OVER w AS played, CAST(sum(points) OVER w AS BIGINT) AS cumulative_points
FROM games JOIN customer ON c_custkey = team_id WHERE season_id = 2001
WINDOW w AS (PARTITION BY team_id ORDER BY full_date, match_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def title_race(spark, sf):
    return analyses.title_race(b.customer_games(spark, sf), customers_as_teams(spark, sf), seasons(spark, sf))


def customers_as_teams(spark, sf):
    return b.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("team_id"), F.col("c_name").alias("team_name"))


@query("unbeaten_runs", RUNS_SQL + "SELECT * FROM runs")
def unbeaten_runs(spark, sf):
    return analyses.unbeaten_runs(b.customer_games(spark, sf), ["full_date", "match_id"], "full_date")


@query("unbeaten_streaks", RUNS_SQL + """
SELECT c_name AS team_name, CAST(season_id AS VARCHAR) AS season_label, streak_length, started, ended
FROM runs JOIN customer ON c_custkey = team_id ORDER BY streak_length DESC, started, team_id LIMIT 15""")
def unbeaten_streaks(spark, sf):
    return analyses.longest_unbeaten(b.customer_games(spark, sf), customers_as_teams(spark, sf),
                                     seasons(spark, sf))


@query("two_sided", ctes(b.MATCHES_SQL, b.TEAM_MATCH_SQL) + "SELECT * FROM team_match")
def two_sided(spark, sf):
    return reports.team_match(b.keyed_matches(spark, sf))


@query("goals_histogram", ctes(b.MATCHES_SQL) + "SELECT total_goals, count(*) AS matches FROM matches GROUP BY 1")
def goals_histogram(spark, sf):
    return screens.goals_and_results(b.keyed_matches(spark, sf))[0]


@query("value_split", ctes(b.MATCHES_SQL) + """
SELECT CAST(v.position AS INTEGER) AS position, v.ft_result, c.n AS rows,
  round(100.0 * c.n / (SELECT count(*) FROM matches), 6) AS share_pct
FROM (VALUES (1, 'H'), (2, 'D'), (3, 'A')) v(position, ft_result)
LEFT JOIN (SELECT ft_result, count(*) AS n FROM matches GROUP BY 1) c USING (ft_result)""")
def result_split(spark, sf):
    return value_split(b.keyed_matches(spark, sf), "ft_result", ["H", "D", "A"])


@query("mean_interval", ctes(b.MATCHES_SQL, """
s AS (SELECT season_id, count(total_goals) AS n, avg(total_goals) AS m, stddev_samp(total_goals) AS sd,
  var_samp(total_goals) AS v FROM matches GROUP BY 1)""") + """
SELECT season_id, n, round(m, 6) AS mean, round(v, 6) AS variance, round(sd, 6) AS sd,
  round(m - 1.96 * sd / sqrt(n), 6) AS low, round(m + 1.96 * sd / sqrt(n), 6) AS high, n < 60 AS small_sample
FROM s""")
def goal_interval(spark, sf):
    return mean_interval(b.keyed_matches(spark, sf), ["season_id"], "total_goals")


@query("group_describe", """
SELECT p_type, count(p_retailprice) AS count, round(avg(p_retailprice), 6) AS mean,
  round(stddev_samp(p_retailprice), 6) AS std, round(quantile_cont(p_retailprice, 0.25), 6) AS q25,
  round(quantile_cont(p_retailprice, 0.5), 6) AS median, round(quantile_cont(p_retailprice, 0.75), 6) AS q75,
  max(p_retailprice) AS max FROM part GROUP BY p_type""")
def group_describe(spark, sf):
    return describe(b.table(spark, sf, "part"), ["p_type"], "p_retailprice")


@query("exact_median", """
SELECT l_returnflag, count(l_extendedprice) AS count, round(avg(l_extendedprice), 4) AS mean,
  round(stddev_samp(l_extendedprice), 4) AS std, round(quantile_cont(l_extendedprice, 0.25), 4) AS q25,
  round(median(l_extendedprice), 4) AS median, round(quantile_cont(l_extendedprice, 0.75), 4) AS q75,
  max(l_extendedprice) AS max FROM lineitem GROUP BY 1""")
def exact_median(spark, sf):
    return describe(b.table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice", digits=4)


@query("multi_row_periods", ctes(b.USER_DAYS_SQL) + """
SELECT player_id, gameweek_id, count(*) AS fixtures FROM user_days GROUP BY ALL HAVING count(*) > 1""")
def multi_row_periods(spark, sf):
    return screens.double_periods(b.user_days(spark, sf))


@query("repeated_dates", """
SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, count(*) AS rows FROM orders GROUP BY ALL HAVING count(*) > 1""")
def repeated_dates(spark, sf):
    rows = b.table(spark, sf, "orders").select("o_custkey", F.to_date("o_orderdate").alias("day"))
    return repeated(rows, ["o_custkey", "day"])


@query("set_difference", """
SELECT DISTINCT o_orderkey AS orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def orders_without_lines(spark, sf):
    orders = b.table(spark, sf, "orders").select(F.col("o_orderkey").alias("orderkey"))
    return set_difference(orders, b.table(spark, sf, "lineitem").select("l_orderkey"))


@query("two_way_difference", """
SELECT d, 'ordered' AS only_in FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders
  EXCEPT SELECT CAST(l_shipdate AS DATE) FROM lineitem)
UNION ALL
SELECT d, 'shipped' FROM (SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem
  EXCEPT SELECT CAST(o_orderdate AS DATE) FROM orders)""")
def two_way_difference(spark, sf):
    ordered = b.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d"))
    shipped = b.table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("d"))
    return both_differences(ordered, shipped, "ordered", "shipped")
