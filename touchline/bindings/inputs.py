"""The given tables, bound to the shapes the analytics work on.

A line item plays a match between the nations of its supplier and its customer on the order
date; a part plays a player of the club its brand names, with its line items as fixtures;
an order plays a customer's game. Every binding reads its whole table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions.expressions import date_key, points_for, score_result
from touchline.operators.reshape import two_sided
from touchline.params import Params

FIRST_YEAR = 1995
LIVE_YEAR = 2001
LIVE_START = dt.date(LIVE_YEAR, 1, 1)
LAST_FINISHED = 65  # period number of May 2000; orders go on for more than a year after it
TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
LIVE = Params(current_season="0102", century="20",
              season_notes={"9900": "partial_behind_closed_doors", "0001": "behind_closed_doors"})


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def hundredths(column: str):
    return F.round(F.col(column) * 100).cast("int")


def period_of(day):
    return ((F.year(day) - FIRST_YEAR) * 12 + F.month(day)).cast("int")


def season_code(day):
    return F.concat(*[F.substring((F.year(day) + n).cast("string"), 3, 2) for n in (0, 1)])


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out when the scan has fewer tasks than there are cores, as with a table stored
    as one row group. For work that is heavy per row; at scale the scan has plenty of tasks."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def keyed_matches(spark: SparkSession, sf: str, since: dt.date | None = None) -> DataFrame:
    """Matches with the tables' own keys. ``since`` reaches the scan of orders."""
    orders = table(spark, sf, "orders")
    if since:
        orders = orders.filter(F.col("o_orderdate") >= F.lit(since).cast("timestamp"))
    orders = orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("match_date"),
                           "o_orderpriority")
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    visits = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    rows = (lines.join(visits, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")))
    home, away = F.col("l_linenumber"), hundredths("l_discount")
    played = rows.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("match_id"),
        F.year("match_date").alias("season_id"),
        date_key("match_date").alias("date_id"), "match_date",
        F.col("s_nationkey").alias("home_team_id"), F.col("c_nationkey").alias("away_team_id"),
        F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("referee"),
        home.alias("ft_home_goals"), away.alias("ft_away_goals"), score_result(home, away).alias("ft_result"),
        F.floor(home / 2).cast("int").alias("ht_home_goals"), F.floor(away / 2).cast("int").alias("ht_away_goals"),
        F.col("l_quantity").cast("int").alias("home_shots"), hundredths("l_tax").alias("away_shots"),
        F.floor(F.col("l_quantity") / 2).cast("int").alias("home_shots_on_target"),
        F.floor(hundredths("l_tax") / 2).cast("int").alias("away_shots_on_target"),
        (F.col("l_linenumber") % 4).alias("home_yellows"), (hundredths("l_tax") % 3).alias("away_yellows"),
        (F.col("l_linenumber") % 2).alias("home_reds"), (hundredths("l_tax") % 2).alias("away_reds"))
    return played.withColumns({
        "home_points": points_for("ft_result", "H"), "away_points": points_for("ft_result", "A"),
        "total_goals": F.col("ft_home_goals") + F.col("ft_away_goals"),
        "goal_difference": F.col("ft_home_goals") - F.col("ft_away_goals")})


MATCHES_SQL = """
matches AS (
  SELECT m.*,
    CASE ft_result WHEN 'H' THEN 3 WHEN 'D' THEN 1 ELSE 0 END AS home_points,
    CASE ft_result WHEN 'A' THEN 3 WHEN 'D' THEN 1 ELSE 0 END AS away_points,
    ft_home_goals + ft_away_goals AS total_goals, ft_home_goals - ft_away_goals AS goal_difference
  FROM (
    SELECT l_orderkey * 10 + l_linenumber AS match_id, CAST(year(o_orderdate) AS INTEGER) AS season_id,
      CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_id, CAST(o_orderdate AS DATE) AS match_date,
      s_nationkey AS home_team_id, c_nationkey AS away_team_id,
      nullif(o_orderpriority, '4-NOT SPECIFIED') AS referee,
      l_linenumber AS ft_home_goals, CAST(round(l_discount * 100) AS INTEGER) AS ft_away_goals,
      CASE WHEN l_linenumber > CAST(round(l_discount * 100) AS INTEGER) THEN 'H'
           WHEN l_linenumber < CAST(round(l_discount * 100) AS INTEGER) THEN 'A' ELSE 'D' END AS ft_result,
      l_linenumber // 2 AS ht_home_goals, CAST(round(l_discount * 100) AS INTEGER) // 2 AS ht_away_goals,
      CAST(l_quantity AS INTEGER) AS home_shots, CAST(round(l_tax * 100) AS INTEGER) AS away_shots,
      CAST(floor(l_quantity / 2) AS INTEGER) AS home_shots_on_target,
      CAST(round(l_tax * 100) AS INTEGER) // 2 AS away_shots_on_target,
      l_linenumber % 4 AS home_yellows, CAST(round(l_tax * 100) AS INTEGER) % 3 AS away_yellows,
      l_linenumber % 2 AS home_reds, CAST(round(l_tax * 100) AS INTEGER) % 2 AS away_reds
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey) m)"""

TEAM_MATCH_SQL = """
team_match AS (
  SELECT match_id, season_id, date_id, home_team_id AS team_id, away_team_id AS opponent_id, 'H' AS venue,
    ft_home_goals AS goals_for, ft_away_goals AS goals_against, home_points AS points, home_shots AS shots,
    home_shots_on_target AS shots_on_target, home_yellows AS yellows, home_reds AS reds FROM matches
  UNION ALL
  SELECT match_id, season_id, date_id, away_team_id, home_team_id, 'A', ft_away_goals, ft_home_goals,
    away_points, away_shots, away_shots_on_target, away_yellows, away_reds FROM matches)"""


def nations_as_teams(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").select(F.col("n_nationkey").alias("team_id"), F.col("n_name").alias("team_name"))


def years_as_seasons(spark: SparkSession, sf: str) -> DataFrame:
    years = table(spark, sf, "orders").select(F.year("o_orderdate").alias("season_id")).distinct()
    return years.select(
        "season_id", F.col("season_id").cast("string").alias("season_label"),
        F.when(F.col("season_id") == LIVE_YEAR, "in_progress").otherwise("completed").alias("status"))


SEASONS_SQL = """
seasons AS (
  SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS season_id, CAST(year(o_orderdate) AS VARCHAR) AS season_label,
    CASE WHEN year(o_orderdate) = 2001 THEN 'in_progress' ELSE 'completed' END AS status FROM orders)"""


def customer_games(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as games of a customer: three points when filled, one when partly filled."""
    status = F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("team_id"), F.year("o_orderdate").alias("season_id"),
        F.to_date("o_orderdate").alias("full_date"), F.col("o_orderkey").alias("match_id"),
        F.when(status == "F", 3).when(status == "P", 1).otherwise(0).alias("points"))


GAMES_SQL = """
games AS (
  SELECT o_custkey AS team_id, CAST(year(o_orderdate) AS INTEGER) AS season_id,
    CAST(o_orderdate AS DATE) AS full_date, o_orderkey AS match_id,
    CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'P' THEN 1 ELSE 0 END AS points FROM orders)"""


def brands_as_teams(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.substring_index("p_brand", "#", -1).cast("int").alias("team_id"),
        F.col("p_brand").alias("team_name")).distinct()


def type_id():
    return F.array_position(F.array(*[F.lit(t) for t in TYPES]), F.col("p_type")).cast("int")


def types_as_positions(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_type").distinct().select(
        type_id().alias("position_id"), F.col("p_type").alias("position_name"),
        F.substring("p_type", 1, 3).alias("position_short"), (type_id() + 1).alias("squad_select"),
        F.lit(1).alias("squad_min_play"), type_id().alias("squad_max_play"))


def parts_as_staged_players(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("fpl_element_id"), (F.col("p_partkey") + 100000).alias("fpl_player_code"),
        F.col("p_name").alias("web_name"), F.substring_index("p_name", " ", 1).alias("first_name"),
        F.substring_index("p_name", " ", -1).alias("second_name"), F.col("p_brand").alias("team_name"),
        type_id().alias("position_id"), (F.col("p_retailprice") / 100.0).alias("price_m"),
        F.col("p_size").cast("double").alias("selected_by_percent"), F.lit("a").alias("status"),
        F.col("p_size").alias("total_points"), (F.col("p_size") * 2).alias("minutes"),
        (F.col("p_size") / 10.0).alias("form"), (F.col("p_size") / 4.0).alias("points_per_game"))


def parts_as_players(spark: SparkSession, sf: str) -> DataFrame:
    return parts_as_staged_players(spark, sf).select(
        F.col("fpl_element_id").alias("player_id"), "web_name",
        F.concat("first_name", F.lit(" "), "second_name").alias("full_name"),
        F.substring_index("team_name", "#", -1).cast("int").alias("team_id"), "position_id", "price_m",
        "selected_by_percent", "status")


PLAYERS_SQL = """
teams AS (SELECT DISTINCT CAST(substr(p_brand, 7) AS INTEGER) AS team_id, p_brand AS team_name FROM part),
positions AS (
  SELECT position_id, position_name, substr(position_name, 1, 3) AS position_short,
    position_id + 1 AS squad_select, 1 AS squad_min_play, position_id AS squad_max_play
  FROM (VALUES (1, 'ECONOMY'), (2, 'LARGE'), (3, 'MEDIUM'), (4, 'PROMO'), (5, 'SMALL'), (6, 'STANDARD'))
    v(position_id, position_name)),
players AS (
  SELECT p_partkey AS player_id, p_name AS web_name, p_name AS full_name,
    CAST(substr(p_brand, 7) AS INTEGER) AS team_id, position_id, p_retailprice / 100.0::DOUBLE AS price_m,
    CAST(p_size AS DOUBLE) AS selected_by_percent, 'a' AS status
  FROM part JOIN positions ON position_name = p_type)"""


def lines_as_staged_history(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as a part's fixtures; a line flagged N was on the bench."""
    day = F.to_date("l_shipdate")
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("player_fixture_id"), F.col("l_partkey").alias("fpl_element_id"),
        F.concat(F.lit("Brand#"), (F.col("l_suppkey") % 30 + 1).cast("string")).alias("opponent_name"),
        day.alias("match_date"), period_of(day).alias("gameweek_id"),
        F.col("l_orderkey").alias("fpl_fixture_id"), (F.col("l_linestatus") == "F").alias("was_home"),
        F.when(F.col("l_returnflag") == "N", 0).otherwise(F.col("l_quantity").cast("int") * 2).alias("minutes"),
        F.col("l_linenumber").alias("total_points"), hundredths("l_discount").alias("goals_scored"),
        hundredths("l_tax").alias("assists"), (F.col("l_linestatus") == "F").cast("int").alias("clean_sheets"),
        (hundredths("l_tax") % 4).alias("goals_conceded"), (F.col("l_linenumber") % 2).alias("yellow_cards"),
        F.lit(0).alias("red_cards"), (F.col("l_linenumber") % 5).alias("saves"),
        (F.col("l_linenumber") % 4).alias("bonus"), F.col("l_quantity").cast("int").alias("bps"),
        (F.col("l_extendedprice") / 1000.0).alias("influence"), F.col("l_quantity").alias("creativity"),
        (F.col("l_extendedprice") / 2000.0).alias("threat"),
        (F.col("l_quantity") / 10.0).alias("ict_index"), (F.col("l_extendedprice") / 10000.0).alias("price_m"),
        F.col("l_suppkey").cast("int").alias("selected"), F.col("l_quantity").cast("int").alias("transfers_in"),
        F.col("l_linenumber").alias("transfers_out"))


def lines_as_facts(spark: SparkSession, sf: str) -> DataFrame:
    return lines_as_staged_history(spark, sf).withColumnRenamed("fpl_element_id", "player_id").withColumn(
        "date_id", date_key("match_date"))


FACTS_SQL = """
facts AS (
  SELECT l_orderkey AS player_fixture_id, l_partkey AS player_id,
    'Brand#' || CAST(l_suppkey % 30 + 1 AS VARCHAR) AS opponent_name, CAST(l_shipdate AS DATE) AS match_date,
    CAST((year(l_shipdate) - 1995) * 12 + month(l_shipdate) AS INTEGER) AS gameweek_id,
    CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS date_id,
    l_orderkey AS fpl_fixture_id, l_linestatus = 'F' AS was_home,
    CASE WHEN l_returnflag = 'N' THEN 0 ELSE CAST(l_quantity AS INTEGER) * 2 END AS minutes,
    l_linenumber AS total_points, CAST(round(l_discount * 100) AS INTEGER) AS goals_scored,
    CAST(round(l_tax * 100) AS INTEGER) AS assists, CAST(l_linestatus = 'F' AS INTEGER) AS clean_sheets,
    CAST(round(l_tax * 100) AS INTEGER) % 4 AS goals_conceded, l_linenumber % 2 AS yellow_cards,
    0 AS red_cards, l_linenumber % 5 AS saves, l_linenumber % 4 AS bonus, CAST(l_quantity AS INTEGER) AS bps,
    l_extendedprice / 1000.0::DOUBLE AS influence, l_quantity AS creativity,
    l_extendedprice / 2000.0::DOUBLE AS threat, l_quantity / 10.0::DOUBLE AS ict_index,
    l_extendedprice / 10000.0::DOUBLE AS price_m, CAST(l_suppkey AS INTEGER) AS selected,
    CAST(l_quantity AS INTEGER) AS transfers_in, l_linenumber AS transfers_out
  FROM lineitem)"""

SEASON_REPORT_SQL = """
tallies AS (
  SELECT player_id, count(*) AS n, count(*) FILTER (WHERE minutes > 0) AS played,
    sum(minutes)::BIGINT AS m, sum(total_points)::BIGINT AS tp, sum(goals_scored)::BIGINT AS g,
    sum(assists)::BIGINT AS a, sum(clean_sheets)::BIGINT AS cs, sum(bonus)::BIGINT AS b
  FROM facts GROUP BY player_id),
described AS (
  SELECT players.*, team_name, position_short, position_name
  FROM players, teams, positions
  WHERE players.team_id = teams.team_id AND players.position_id = positions.position_id),
player_season AS (
  SELECT d.* EXCLUDE (team_id, position_id), ifnull(n, 0) AS fixtures, ifnull(played, 0) AS appearances, m AS minutes,
    tp AS points, g AS goals, a AS assists, cs AS clean_sheets, b AS bonus,
    CASE WHEN price_m <> 0 THEN round(tp / price_m, 2) END AS points_per_million
  FROM described d LEFT JOIN tallies t ON t.player_id = d.player_id)"""


def nation_fixtures(spark: SparkSession, sf: str) -> DataFrame:
    """One fixture per pair of nations and month with orders, two rows each."""
    pairs = keyed_matches(spark, sf).groupBy(
        period_of(F.col("match_date")).alias("gameweek_id"), "home_team_id", "away_team_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("ft_home_goals").alias("goals"))
    fixtures = pairs.withColumns({
        "fpl_fixture_id": (F.col("gameweek_id") * 100 + F.col("home_team_id")) * 100 + F.col("away_team_id"),
        "finished": F.col("gameweek_id") <= LAST_FINISHED})

    def side(us, them, at_home, measure):
        return {"team_id": F.col(f"{us}_team_id"), "opponent_team_id": F.col(f"{them}_team_id"),
                "is_home": F.lit(at_home), "difficulty": (F.col(measure) % 5 + 1).cast("int")}

    return two_sided(fixtures, side("home", "away", True, "n"), side("away", "home", False, "goals"),
                     ["gameweek_id", "fpl_fixture_id", "finished"])


FIXTURES_SQL = """
pairs AS (
  SELECT CAST((year(match_date) - 1995) * 12 + month(match_date) AS INTEGER) AS gameweek_id,
    home_team_id, away_team_id, count(*) AS n, CAST(sum(ft_home_goals) AS BIGINT) AS goals
  FROM matches GROUP BY ALL),
fixtures AS (
  SELECT gameweek_id, (gameweek_id * 100 + home_team_id) * 100 + away_team_id AS fpl_fixture_id,
    gameweek_id <= 65 AS finished, home_team_id AS team_id, away_team_id AS opponent_team_id,
    TRUE AS is_home, CAST(n % 5 + 1 AS INTEGER) AS difficulty FROM pairs
  UNION ALL
  SELECT gameweek_id, (gameweek_id * 100 + home_team_id) * 100 + away_team_id, gameweek_id <= 65,
    away_team_id, home_team_id, FALSE, CAST(goals % 5 + 1 AS INTEGER) FROM pairs)"""


def months_as_gameweeks(spark: SparkSession, sf: str) -> DataFrame:
    months = table(spark, sf, "orders").groupBy(period_of(F.col("o_orderdate")).alias("gameweek_id")).agg(
        F.min("o_orderdate").alias("deadline_time"), F.count(F.lit(1)).cast("int").alias("average_score"),
        F.floor(F.max("o_totalprice")).cast("int").alias("highest_score"))
    return months.select(
        "gameweek_id", F.concat(F.lit("Gameweek "), F.col("gameweek_id").cast("string")).alias("gameweek_name"),
        "deadline_time", (F.col("gameweek_id") <= LAST_FINISHED).alias("finished"),
        (F.col("gameweek_id") == LAST_FINISHED).alias("is_current"),
        (F.col("gameweek_id") == LAST_FINISHED + 1).alias("is_next"), "average_score", "highest_score")


GAMEWEEKS_SQL = """
gameweeks AS (
  SELECT gameweek_id, 'Gameweek ' || CAST(gameweek_id AS VARCHAR) AS gameweek_name, deadline_time,
    gameweek_id <= 65 AS finished, gameweek_id = 65 AS is_current, gameweek_id = 66 AS is_next,
    average_score, highest_score
  FROM (SELECT CAST((year(o_orderdate) - 1995) * 12 + month(o_orderdate) AS INTEGER) AS gameweek_id,
          min(o_orderdate) AS deadline_time, CAST(count(*) AS INTEGER) AS average_score,
          CAST(floor(max(o_totalprice)) AS INTEGER) AS highest_score
        FROM orders GROUP BY 1))"""


def order_seasons(spark: SparkSession, sf: str) -> DataFrame:
    """Order dates and priorities under their season codes, as staged match columns."""
    day = F.to_date("o_orderdate")
    return table(spark, sf, "orders").select(
        day.alias("match_date"), season_code(day).alias("season_code"),
        F.concat(F.year(day).cast("string"), F.lit("/"),
                 F.substring((F.year(day) + 1).cast("string"), 3, 2)).alias("season_label"),
        F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("referee"))


def user_days(spark: SparkSession, sf: str) -> DataFrame:
    """Events as a user's fixtures: the day of the month is the gameweek."""
    return table(spark, sf, "events").select(
        F.col("user_id").alias("player_id"), F.dayofmonth("ts").alias("gameweek_id"),
        F.to_date("ts").alias("match_date"), F.col("event_id").alias("fpl_fixture_id"),
        F.col("event_type").alias("position"), F.get_json_object("props", "$.k").cast("int").alias("minutes"),
        "value")


USER_DAYS_SQL = """
user_days AS (
  SELECT user_id AS player_id, CAST(day(ts) AS INTEGER) AS gameweek_id, CAST(ts AS DATE) AS match_date,
    event_id AS fpl_fixture_id, event_type AS position,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS minutes, value FROM events)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip() for c in ctes) + "\n"
