"""Registered queries on dimensions, facts, keys and warehouse tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.bindings import inputs as b
from touchline.bindings.registry import query
from touchline.operators import warehouse_tests as wt
from touchline.operators.joins import dropped_keys, look_up, require, small_side
from touchline.operators.keys import competition_rank, number_members, number_rows
from touchline.plans import dims, facts
from touchline.plans.staging import SCHEMAS, staged

ctes = b.with_ctes


@query("conformed_dim", """
SELECT row_number() OVER (ORDER BY team_name) AS team_id, team_name FROM (
  SELECT n_name AS team_name FROM nation UNION SELECT s_name FROM supplier UNION SELECT c_name FROM customer
  UNION SELECT p_brand FROM part UNION SELECT r_name FROM region)""")
def conformed_dim(spark, sf):
    names = {"nation": "n_name", "supplier": "s_name", "customer": "c_name", "part": "p_brand", "region": "r_name"}
    return dims.dim_team(*[b.table(spark, sf, t).select(c) for t, c in names.items()])


SEASON_ROWS_SQL = """
season_rows AS (
  SELECT o_orderdate::DATE AS match_date, year(o_orderdate) AS y,
    printf('%02d%02d', year(o_orderdate) % 100, (year(o_orderdate) + 1) % 100) AS season_code,
    printf('%d/%02d', year(o_orderdate), (year(o_orderdate) + 1) % 100) AS season_label,
    CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END AS referee FROM orders)"""
SEASON_DIM_SQL = SEASON_ROWS_SQL + """,
years AS (SELECT y, any_value(season_code) AS code, any_value(season_label) AS label FROM season_rows GROUP BY y),
notes(code, note) AS (VALUES ('9900', 'partial_behind_closed_doors'), ('0001', 'behind_closed_doors')),
dim_season AS (
  SELECT (SELECT count(*) FROM years e WHERE e.code <= years.code) AS season_id, code AS season_code,
    label AS season_label, (2000 + y % 100)::INTEGER AS start_year, (2000 + (y + 1) % 100)::INTEGER AS end_year,
    ifnull(note, 'normal') AS crowd_status, if(code = '0102', 'in_progress', 'completed') AS status
  FROM years LEFT JOIN notes USING (code))"""
DATE_DIM_SQL = """
span AS (
  SELECT min(match_date) AS lo, max(match_date) AS last_match,
    (SELECT max(deadline_time)::DATE + 7 FROM gameweeks) AS last_deadline FROM season_rows),
days AS (
  SELECT lo + i::INTEGER AS d FROM span, range(0, 20000) r(i)
  WHERE lo + i::INTEGER <= CASE WHEN last_match > last_deadline THEN last_match ELSE last_deadline END),
dim_date AS (
  SELECT (10000 * date_part('year', d) + 100 * date_part('month', d) + date_part('day', d))::INTEGER AS date_id,
    d AS full_date, date_part('year', d)::INTEGER AS year, date_part('month', d)::INTEGER AS month,
    monthname(d) AS month_name, date_part('day', d)::INTEGER AS day_of_month, dayname(d) AS day_of_week,
    date_part('week', d)::INTEGER AS iso_week, if(isodow(d) >= 6, 1, 0)::INTEGER AS is_weekend FROM days)"""
REFEREE_DIM_SQL = """
named AS (SELECT referee FROM season_rows WHERE length(trim(referee)) > 0 GROUP BY referee),
dim_referee AS (
  SELECT n.referee AS referee_name, count(*) AS referee_id FROM named n JOIN named e ON e.referee <= n.referee GROUP BY 1
  UNION ALL SELECT 'Unknown', 0)"""


@query("season_dim", ctes(SEASON_DIM_SQL) + "SELECT * FROM dim_season")
def season_dim(spark, sf):
    return dims.dim_season(b.order_seasons(spark, sf), b.LIVE)


@query("date_dim", ctes(SEASON_ROWS_SQL, b.GAMEWEEKS_SQL, DATE_DIM_SQL) + "SELECT * FROM dim_date")
def date_dim(spark, sf):
    return dims.dim_date(b.order_seasons(spark, sf), b.months_as_gameweeks(spark, sf))


@query("gameweek_dim", ctes(b.GAMEWEEKS_SQL) + "SELECT * FROM gameweeks")
def gameweek_dim(spark, sf):
    return dims.dim_gameweek(staged(b.months_as_gameweeks(spark, sf), SCHEMAS["stg_gameweeks"]))


@query("position_dim", ctes(b.PLAYERS_SQL) + "SELECT * FROM positions WHERE position_name IN (SELECT p_type FROM part)")
def position_dim(spark, sf):
    return dims.dim_position(staged(b.types_as_positions(spark, sf), SCHEMAS["stg_positions"]))


@query("player_dim", ctes(b.PLAYERS_SQL) + """
SELECT row_number() OVER (ORDER BY p_partkey) AS player_id, p_partkey AS fpl_element_id,
  p_partkey + 100000 AS fpl_player_code, web_name, full_name, tid AS team_id, players.position_id, price_m,
  selected_by_percent, status, p_size AS total_points, p_size * 2 AS minutes,
  p_size / 10.0::DOUBLE AS form, p_size / 4.0::DOUBLE AS points_per_game
FROM part JOIN players ON player_id = p_partkey
JOIN (SELECT team_name, row_number() OVER (ORDER BY team_name) AS tid FROM teams) n ON n.team_name = p_brand""")
def player_dim(spark, sf):
    players = staged(b.parts_as_staged_players(spark, sf), SCHEMAS["stg_players"])
    return dims.dim_player(players, small_side(dims.dim_team(players.select("team_name"))))


@query("unknown_member_dim", ctes(SEASON_ROWS_SQL, REFEREE_DIM_SQL) + "SELECT * FROM dim_referee")
def unknown_member_dim(spark, sf):
    return dims.dim_referee(b.order_seasons(spark, sf))


@query("unknown_member_lookup", ctes(SEASON_ROWS_SQL, REFEREE_DIM_SQL) + """
SELECT o.o_orderkey, o.o_totalprice, coalesce(r.referee_id, 0) AS referee_id
FROM orders o LEFT JOIN dim_referee r ON r.referee_name = nullif(o.o_orderpriority, '4-NOT SPECIFIED')""")
def unknown_member_lookup(spark, sf):
    referees = small_side(dims.dim_referee(b.order_seasons(spark, sf)))
    orders = b.table(spark, sf, "orders").withColumn("referee", F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")))
    return look_up(orders, referees, {"referee": "referee_name"}, {"referee_id": "referee_id"}, default=0,
                   spread_missing=True).select("o_orderkey", "o_totalprice", "referee_id")


STAR_COLUMNS = ("match_id, home_team_id, away_team_id, season_id, date_id, referee_id, ft_home_goals, "
                "ft_away_goals, ft_result, ht_home_goals, ht_away_goals, home_shots, away_shots, "
                "home_points, away_points, total_goals, goal_difference").split(", ")


@query("star_fact", ctes(b.MATCHES_SQL, SEASON_DIM_SQL, b.GAMEWEEKS_SQL, DATE_DIM_SQL, REFEREE_DIM_SQL, """
names AS (SELECT n_nationkey, row_number() OVER (ORDER BY n_name) AS team_id FROM nation)""") + """
SELECT match_id, h.team_id AS home_team_id, a.team_id AS away_team_id, s.season_id, d.date_id,
  coalesce(r.referee_id, 0) AS referee_id, ft_home_goals, ft_away_goals, ft_result, ht_home_goals, ht_away_goals,
  home_shots, away_shots, home_points, away_points, total_goals, goal_difference
FROM matches m
JOIN dim_season s ON s.season_label = printf('%d/%02d', year(m.match_date), (year(m.match_date) + 1) % 100)
JOIN dim_date d ON d.full_date = m.match_date
JOIN names h ON h.n_nationkey = m.home_team_id JOIN names a ON a.n_nationkey = m.away_team_id
LEFT JOIN dim_referee r ON r.referee_name = m.referee""")
def star_fact(spark, sf):
    """Names are resolved to surrogate keys of dimensions built from the same tables."""
    seasons = b.order_seasons(spark, sf)
    built = [dims.dim_season(seasons, b.LIVE), dims.dim_date(seasons, b.months_as_gameweeks(spark, sf)),
             dims.dim_team(b.table(spark, sf, "nation").select("n_name")), dims.dim_referee(seasons)]
    return facts.fact_match(staged_matches(spark, sf), *map(small_side, built)).select(*STAR_COLUMNS)


def staged_matches(spark, sf):
    nations = b.nations_as_teams(spark, sf)
    named = require(b.keyed_matches(spark, sf), nations, {"home_team_id": "team_id"}, {"team_name": "home_team"})
    named = require(named, nations, {"away_team_id": "team_id"}, {"team_name": "away_team"})
    text, count = F.lit(None).cast("string"), F.lit(None).cast("int")
    named = named.withColumn("season_code", b.season_code(F.col("match_date")))
    missing = {c: text if kind is None else count for c, kind in SCHEMAS["stg_matches"].items() if c not in named.columns}
    return staged(named.withColumns(missing), SCHEMAS["stg_matches"])


@query("left_lookup_fact", ctes(b.PLAYERS_SQL, b.FACTS_SQL, SEASON_ROWS_SQL, b.GAMEWEEKS_SQL, DATE_DIM_SQL) + """
SELECT player_fixture_id, f.player_id, gameweek_id, d.date_id, o.team_id AS opponent_team_id, fpl_fixture_id, was_home,
  f.minutes, f.total_points, goals_scored, assists, clean_sheets, goals_conceded, yellow_cards, red_cards, saves,
  bonus, bps, influence, creativity, threat, ict_index, f.price_m, selected, transfers_in, transfers_out
FROM facts f JOIN part ON p_partkey = f.player_id AND p_size <= 25
LEFT JOIN (SELECT team_name, CAST(team_id AS INTEGER) AS team_id FROM teams) o ON o.team_name = f.opponent_name
LEFT JOIN dim_date d ON d.full_date = f.match_date""")
def left_lookup_fact(spark, sf):
    """Large parts are not in the player dimension, so their lines drop; five of thirty
    opponent names are unknown and days after the calendar have no key."""
    known = b.table(spark, sf, "part").filter("p_size <= 25").select(
        F.col("p_partkey").alias("fpl_element_id"), F.col("p_partkey").alias("player_id"))
    calendar = small_side(dims.dim_date(b.order_seasons(spark, sf), b.months_as_gameweeks(spark, sf)))
    return facts.fact_player_fixture(b.lines_as_staged_history(spark, sf), known,
                                     small_side(b.brands_as_teams(spark, sf)), calendar)


@query("dropped_keys", """
SELECT l_partkey, count(*) AS rows FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 25)
GROUP BY 1""")
def inner_lookup_losses(spark, sf):
    known = b.table(spark, sf, "part").filter("p_size <= 25")
    return dropped_keys(b.table(spark, sf, "lineitem"), known, {"l_partkey": "p_partkey"})


@query("team_fixture_fact", ctes(b.MATCHES_SQL, b.FIXTURES_SQL, """
named AS (SELECT f.*, t.n_name AS team_name FROM fixtures f JOIN nation t ON t.n_nationkey = f.team_id)""") + """
SELECT row_number() OVER (ORDER BY team_name, fpl_fixture_id, is_home) AS team_fixture_id, t.n AS team_id,
  o.n AS opponent_team_id, gameweek_id, fpl_fixture_id, is_home, difficulty, finished
FROM named JOIN (SELECT n_nationkey, row_number() OVER (ORDER BY n_name) AS n FROM nation) t ON t.n_nationkey = named.team_id
JOIN (SELECT n_nationkey, row_number() OVER (ORDER BY n_name) AS n FROM nation) o ON o.n_nationkey = opponent_team_id""")
def team_fixture_fact(spark, sf):
    nations = b.nations_as_teams(spark, sf)
    named = require(b.nation_fixtures(spark, sf), nations, {"team_id": "team_id"}, {"team_name": "team_name"})
    named = require(named, nations, {"opponent_team_id": "team_id"}, {"team_name": "opponent_name"})
    teams = small_side(dims.dim_team(nations.select("team_name")))
    # A nation can meet itself, so the venue completes the order.
    return facts.fact_team_fixture(named, teams, ["team_name", "fpl_fixture_id", "is_home"])


@query("surrogate_key", """
SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS order_id, o_orderkey, o_custkey, o_orderdate FROM orders""")
def surrogate_key(spark, sf):
    orders = b.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return number_rows(orders, ["o_orderdate", "o_orderkey"], "order_id")


@query("distributed_rank", """
SELECT rank() OVER (ORDER BY o_totalprice DESC) AS place, o_orderkey, o_totalprice FROM orders""")
def distributed_rank(spark, sf):
    """No row count is small enough here for the one-task window."""
    orders = b.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return competition_rank(orders, ["o_totalprice"], "place", small_rows=0)


@query("distributed_rank_ties", """
SELECT 1 + (SELECT count(*) FROM lineitem h WHERE h.l_quantity > q.l_quantity) AS place, l_orderkey, l_linenumber, l_quantity
FROM lineitem JOIN (SELECT DISTINCT l_quantity FROM lineitem) q USING (l_quantity)""")
def distributed_rank_ties(spark, sf):
    """Fifty quantities rank all lines, so each tie is spread over range partitions."""
    lines = b.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return competition_rank(lines, ["l_quantity"], "place", small_rows=0)


@query("numbered_large_dim", """
SELECT row_number() OVER (ORDER BY c_name) AS customer_id, c_name FROM (SELECT DISTINCT c_name FROM customer)""")
def numbered_large_dim(spark, sf):
    """A dimension numbered the way a large one is."""
    return number_members(b.table(spark, sf, "customer").select("c_name").distinct(), ["c_name"], "customer_id", small_rows=0)


@query("gap_dates", """
SELECT days, first_day, last_day FROM (
  SELECT count(DISTINCT CAST(o_orderdate AS DATE)) AS days, CAST(min(o_orderdate) AS DATE) AS first_day,
    CAST(max(o_orderdate) AS DATE) AS last_day FROM orders)
WHERE days <> date_diff('day', first_day, last_day) + 1""")
def gap_dates(spark, sf):
    days = b.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("full_date")).distinct()
    return wt.calendar_gaps(days, "full_date")


@query("missing_dates", """
SELECT CAST(d AS DATE) AS day FROM (SELECT unnest(generate_series(min(CAST(o_orderdate AS DATE)),
  max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS d FROM orders)
EXCEPT SELECT CAST(o_orderdate AS DATE) FROM orders""")
def missing_dates(spark, sf):
    return wt.missing_periods(b.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day")), "day")


@query("missing_periods", ctes(b.USER_DAYS_SQL) + """
SELECT u.player_id, CAST(g.p AS INTEGER) AS gameweek_id
FROM (SELECT DISTINCT player_id FROM user_days) u
CROSS JOIN (SELECT unnest(generate_series(min(gameweek_id), max(gameweek_id))) AS p FROM user_days) g
WHERE NOT EXISTS (SELECT 1 FROM user_days x WHERE x.player_id = u.player_id AND x.gameweek_id = g.p)""")
def missing_periods(spark, sf):
    return wt.missing_periods_by(b.user_days(spark, sf), "player_id", "gameweek_id")


TESTS = [
    wt.Test("orders", "o_orderkey", "unique"), wt.Test("orders", "o_custkey", "unique"),
    wt.Test("orders", "o_orderdate", "not_null"),
    wt.Test("lineitem", "l_orderkey", "relationships", ("orders", "o_orderkey")),
    wt.Test("orders", "o_orderkey", "relationships", ("lineitem", "l_orderkey")),
    wt.Test("orders", "o_orderstatus", "accepted_values", ("F", "P")),
    wt.Test("lineitem", "l_quantity", "accepted_range", (5, 45)),
    wt.Test("lineitem", "l_discount", "accepted_range", (0.0, None)),
    wt.Test("lineitem", "l_orderkey, l_linenumber", "unique_combination", ("l_orderkey", "l_linenumber")),
    wt.Test("dates", "full_date", "no_gaps"), wt.Test("dates", "period", "contiguous"),
]


@query("warehouse_tests", """
SELECT 'orders' AS model, 'o_orderkey' AS column_name, 'unique' AS test, count(*) AS failures
  FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
UNION ALL SELECT 'orders', 'o_custkey', 'unique', count(*) FROM (SELECT 1 FROM orders GROUP BY o_custkey HAVING count(*) > 1)
UNION ALL SELECT 'orders', 'o_orderdate', 'not_null', count(*) FROM orders WHERE o_orderdate IS NULL
UNION ALL SELECT 'lineitem', 'l_orderkey', 'relationships', count(DISTINCT l_orderkey) FROM lineitem
  WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'orders', 'o_orderkey', 'relationships', count(DISTINCT o_orderkey) FROM orders
  WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT 'orders', 'o_orderstatus', 'accepted_values', count(DISTINCT o_orderstatus) FROM orders
  WHERE o_orderstatus NOT IN ('F', 'P')
UNION ALL SELECT 'lineitem', 'l_quantity', 'accepted_range', count(*) FROM lineitem WHERE l_quantity < 5 OR l_quantity > 45
UNION ALL SELECT 'lineitem', 'l_discount', 'accepted_range', count(*) FROM lineitem WHERE l_discount < 0
UNION ALL SELECT 'lineitem', 'l_orderkey, l_linenumber', 'unique_combination', count(*)
  FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'dates', 'full_date', 'no_gaps', CAST(count(DISTINCT CAST(o_orderdate AS DATE))
  <> date_diff('day', CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE)) + 1 AS BIGINT) FROM orders
UNION ALL SELECT 'dates', 'period', 'contiguous', max(p) - min(p) + 1 - count(DISTINCT p)
  FROM (SELECT (year(o_orderdate) - 1995) * 12 + month(o_orderdate) AS p FROM orders)""")
def warehouse_tests(spark, sf):
    orders = b.table(spark, sf, "orders")
    days = orders.select(F.to_date("o_orderdate").alias("full_date")).distinct()
    dates = days.withColumn("period", b.period_of(F.col("full_date")))
    return wt.run_tests(TESTS, {"orders": orders, "lineitem": b.table(spark, sf, "lineitem"), "dates": dates})


@query("not_unique_keys", """
SELECT o_custkey, count(*) AS n_records FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1""")
def not_unique_keys(spark, sf):
    return wt.not_unique(b.table(spark, sf, "orders"), "o_custkey")


@query("orphan_keys", """
SELECT o_orderkey, count(*) AS n_records FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) GROUP BY 1""")
def orphan_keys(spark, sf):
    return wt.orphans(b.table(spark, sf, "orders"), "o_orderkey", b.table(spark, sf, "lineitem"), "l_orderkey")
