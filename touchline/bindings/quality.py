"""Registered queries on row validation, duplicates, strict lookups and contracts."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.bindings import inputs as b
from touchline.bindings.registry import query
from touchline.functions.expressions import day_first_date, to_number, to_whole
from touchline.operators import checks
from touchline.operators.joins import UnmappedName, canonical, is_mapped, require_mapped, strict_look_up, unmapped
from touchline.operators.keys import number_rows
from touchline.operators.rejects import REASON, keep_first, kept, later_copies, rejected
from touchline.operators.reshape import stack_columns
from touchline.params import Params
from touchline.plans.clean_matches import flag_matches, match_reject_counts, with_totals

ctes = b.with_ctes
CLUBS = {"RF": "Rovers", "RO": "Royals", "AF": "Athletic", "AO": "Albion", "NF": "North End", "NO": "Northern",
         "T1": "Town", "T2": "Thistle", "T3": "Trinity", "T4": "Tigers", "T5": "Tower", "T6": "Terriers", "T7": "Toffees"}
ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
         "l_discount", "l_tax", "l_shipdate"]
SHOWN = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def raw_matches(spark, sf):
    """Line items as raw match text: three date spellings, padded names, missing and bad values."""
    flag, tax, discount = F.col("l_returnflag"), b.hundredths("l_tax"), b.hundredths("l_discount")
    home = F.when(discount == 10, F.col("l_quantity").cast("int")).otherwise(F.col("l_linenumber"))
    empty = (tax == 0) & (discount == 0)
    written = (F.when(flag == "R", F.date_format("l_shipdate", "dd/MM/yyyy"))
               .when(flag == "A", F.date_format("l_shipdate", "dd/MM/yy"))
               .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")))
    result = (F.when((flag == "N") & (F.col("l_linestatus") == "O"), "  ")
              .when(F.col("l_quantity") == 50, "X")
              .when(home > discount, " h ").when(home < discount, "a").otherwise("D"))
    return b.spread(b.table(spark, sf, "lineitem")).select(
        *ORDER,
        F.when(~empty, F.when(tax == 8, "to be arranged").otherwise(written)).alias("match_date"),
        F.when(~empty, F.concat(F.lit(" "), flag, F.col("l_linestatus"))).alias("home_team"),
        F.concat(F.lit("T"), F.col("l_linenumber").cast("string")).alias("away_team"),
        F.when(tax == 7, "n/a").otherwise(home.cast("string")).alias("ft_home_goals"),
        F.concat(discount.cast("string"), F.lit(".0")).alias("ft_away_goals"), result.alias("ft_result"),
        F.when(F.col("l_linenumber") < 4, tax.cast("string")).alias("ht_home_goals"),
        b.season_code(F.to_date("l_shipdate")).alias("season_code"))


FLAGGED_SQL = f"""
typed AS (
  SELECT *, CAST(round(l_tax * 100) AS INTEGER) AS tax, CAST(round(l_discount * 100) AS INTEGER) AS away,
    CASE WHEN CAST(round(l_discount * 100) AS INTEGER) = 10 THEN CAST(l_quantity AS INTEGER) ELSE l_linenumber END AS home0,
    CAST(l_shipdate AS DATE) AS match_date, l_returnflag || l_linestatus AS home_code, 'T' || l_linenumber AS away_code,
    strftime(l_shipdate, '%y') || strftime(l_shipdate + INTERVAL 12 MONTH, '%y') AS season_code
  FROM lineitem),
valued AS (
  SELECT *, CASE WHEN tax = 7 THEN NULL ELSE home0 END AS home, CASE WHEN l_linenumber < 4 THEN tax END AS ht,
    CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN '' WHEN l_quantity = 50 THEN 'X'
      WHEN home0 > away THEN 'H' WHEN home0 < away THEN 'A' ELSE 'D' END AS result FROM typed),
first_rules AS (
  SELECT *, CASE
    WHEN tax = 0 AND away = 0 THEN 'empty row'
    WHEN result = '' THEN 'fixture not yet played'
    WHEN tax = 8 THEN 'unparseable date'
    WHEN home IS NULL OR home > 12 OR away > 12 OR home < 0 OR away < 0 THEN 'goals outside plausible range'
    WHEN coalesce(ht > home, FALSE) THEN 'half-time goals exceed full-time'
    WHEN result NOT IN ('H', 'D', 'A') THEN 'result not in H/D/A' END AS reason0 FROM valued),
flagged AS (
  SELECT *, CASE WHEN reason0 IS NULL AND row_number() OVER (
      PARTITION BY reason0 IS NULL, season_code, match_date, home_code, away_code ORDER BY {', '.join(ORDER)}) > 1
    THEN 'duplicate on natural key' ELSE reason0 END AS reject_reason FROM first_rules)"""


@query("reject_rows", ctes(FLAGGED_SQL) + f"""
SELECT {', '.join(SHOWN)}, reject_reason FROM flagged WHERE reject_reason IS NOT NULL""")
def reject_rows(spark, sf):
    return rejected(flag_matches(raw_matches(spark, sf), ORDER, CLUBS)).select(*SHOWN, REASON)


@query("reject_counts", ctes(FLAGGED_SQL) + """
SELECT reject_reason, count(*) AS rows FROM flagged WHERE reject_reason IS NOT NULL GROUP BY 1""")
def counts_by_reason(spark, sf):
    return match_reject_counts(raw_matches(spark, sf), CLUBS)


@query("flagged_counts", ctes(FLAGGED_SQL) + """
SELECT coalesce(reject_reason, 'none') AS reason, count(*) AS rows, min(l_orderkey) AS first_order FROM flagged GROUP BY 1""")
def flagged_counts(spark, sf):
    """Every row under the reason that the flagging gives it, kept ones included."""
    flagged = flag_matches(raw_matches(spark, sf), ORDER, CLUBS)
    return flagged.groupBy(F.coalesce(REASON, F.lit("none")).alias("reason")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("l_orderkey").alias("first_order"))


@query("unmapped_names", """
SELECT coalesce(trim(l_returnflag || l_linestatus), 'NULL') AS name, count(*) AS rows FROM lineitem
WHERE l_returnflag || l_linestatus NOT IN ('AF', 'RF', 'NO') GROUP BY 1""")
def unmapped_names(spark, sf):
    """The failure path of the name mapping: a strict lookup over names of which some have no canonical spelling
    fails and names the first; what it would fail on is listed with its rows."""
    names = b.table(spark, sf, "lineitem").select(F.concat(F.lit(" "), "l_returnflag", "l_linestatus").alias("name"))
    known = {n: n for n in ("AF", "RF", "NO")}
    missed = unmapped(names, "name", known)
    first = missed.agg(F.min("name")).first()[0]
    try:
        require_mapped(names, "name", known, "club")
    except UnmappedName as failure:
        if first is None or repr(first)[1:-1] not in str(failure):
            raise AssertionError(f"{failure} does not name {first}") from failure
    else:
        if first is not None:
            raise AssertionError(f"{first} has no canonical spelling and passed")
    return names.filter(~is_mapped("name", known)).groupBy(F.coalesce(F.trim("name"), F.lit("NULL")).alias("name")).agg(
        F.count(F.lit(1)).alias("rows"))


CLUB_SQL = "CASE {} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CLUBS.items()) + " END"


@query("kept_rows", ctes(FLAGGED_SQL, f"""
named AS (SELECT *, {CLUB_SQL.format('home_code')} AS home_team, {CLUB_SQL.format('away_code')} AS away_team
  FROM flagged WHERE reject_reason IS NULL)""") + f"""
SELECT row_number() OVER (ORDER BY match_date, home_team, {', '.join(ORDER)}) AS match_id, match_date, season_code,
  home_team, away_team, home AS ft_home_goals, away AS ft_away_goals, ht AS ht_home_goals, result AS ft_result,
  home + away AS total_goals, home - away AS goal_difference,
  CASE result WHEN 'H' THEN 3 WHEN 'D' THEN 1 ELSE 0 END AS home_points,
  CASE result WHEN 'A' THEN 3 WHEN 'D' THEN 1 ELSE 0 END AS away_points
FROM named""")
def kept_rows(spark, sf):
    good = with_totals(kept(flag_matches(raw_matches(spark, sf), ORDER, CLUBS)))
    return number_rows(good, ["match_date", "home_team", *ORDER], "match_id").select(
        "match_id", "match_date", "season_code", "home_team", "away_team", "ft_home_goals", "ft_away_goals",
        "ht_home_goals", "ft_result", "total_goals", "goal_difference", "home_points", "away_points")


def digests(spark, sf):
    """Whole texts are compared by digest, so no text is shuffled."""
    return b.table(spark, sf, "documents").select("doc_id", "lang", "source", F.sha2("text", 256).alias("digest"))


@query("dedup_first", """
SELECT doc_id, lang, source FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""")
def dedup_first(spark, sf):
    return keep_first(digests(spark, sf), ["digest"], ["doc_id"]).drop("digest")


@query("dedup_later", """
SELECT doc_id, lang, source FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) > 1""")
def dedup_later(spark, sf):
    return later_copies(digests(spark, sf), ["digest"], ["doc_id"]).drop("digest")


@query("dedup_composite", """
SELECT player, fixture, qty FROM (
  SELECT l_partkey AS player, l_suppkey AS fixture, l_quantity AS qty, row_number() OVER (
    PARTITION BY l_partkey, l_suppkey ORDER BY l_orderkey, l_linenumber, l_extendedprice, l_quantity, l_shipdate) AS n
  FROM lineitem) WHERE n = 1""")
def dedup_composite(spark, sf):
    rows = b.table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("player"), F.col("l_suppkey").alias("fixture"), "l_orderkey", "l_linenumber",
        "l_extendedprice", F.col("l_quantity").alias("qty"), "l_shipdate")
    order = ["l_orderkey", "l_linenumber", "l_extendedprice", "qty", "l_shipdate"]
    return keep_first(rows, ["player", "fixture"], order).select("player", "fixture", "qty")


NAMED = {"R": "Returned", "A": "Accepted", "N": "None"}


@query("strict_lookup", """
SELECT CASE l_returnflag WHEN 'R' THEN 'Returned' WHEN 'A' THEN 'Accepted' ELSE 'None' END AS flag,
  n_name AS nation, count(*) AS rows, CAST(sum(l_quantity) AS DOUBLE) AS quantity
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey GROUP BY ALL""")
def strict_lookup(spark, sf):
    """Unknown flags or suppliers would fail the job. Lines are summed before the lookup."""
    lines = b.table(spark, sf, "lineitem").groupBy("l_returnflag", "l_suppkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q"))
    known = strict_look_up(lines, b.table(spark, sf, "supplier"), {"l_suppkey": "s_suppkey"},
                           {"s_nationkey": "nation_id"}, "supplier")
    named = strict_look_up(known, b.table(spark, sf, "nation"), {"nation_id": "n_nationkey"},
                           {"n_name": "nation"}, "nation")
    return named.groupBy(canonical("l_returnflag", NAMED, "flag").alias("flag"), "nation").agg(
        F.sum("n").alias("rows"), F.sum("q").alias("quantity"))


@query("parsed_dates", """
SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day FROM orders""")
def parsed_dates(spark, sf):
    written = (F.when(F.col("o_orderpriority") == "1-URGENT", F.date_format("o_orderdate", "dd/MM/yyyy"))
               .when(F.col("o_orderpriority") == "2-HIGH", F.date_format("o_orderdate", "d/M/yy"))
               .when(F.col("o_orderpriority") == "3-MEDIUM", F.date_format("o_orderdate", " yyyy-MM-dd "))
               .when(F.col("o_orderpriority") == "5-LOW", F.date_format("o_orderdate", "yyyy MMMM dd"))
               .otherwise(F.date_format("o_orderdate", "dd/MM/yy")))
    return b.table(spark, sf, "orders").select("o_orderkey", day_first_date(written).alias("day"))


@query("parsed_numbers", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS whole,
  CASE WHEN event_type = 'error' THEN NULL ELSE value END AS number,
  CASE WHEN value = floor(value) THEN CAST(value AS INTEGER) END AS exact FROM events""")
def parsed_numbers(spark, sf):
    events = b.table(spark, sf, "events")
    text = F.when(F.col("event_type") == "error", F.concat("event_type", F.col("value").cast("string"))) \
        .otherwise(F.concat(F.lit(" "), F.col("value").cast("string"), F.lit(" ")))
    return events.select("event_id", to_whole(F.get_json_object("props", "$.k")).alias("whole"),
                         to_number(text).alias("number"), to_whole("value").alias("exact"))


LIMITS = Params(matches_per_completed_season=200, matches_per_team_per_season=20, max_matches_played_spread=2,
                min_price=9.0, max_price=9.5, max_minutes=90)


@query("contract_suite", f"""
WITH m AS (
  SELECT *, strftime(o_orderdate, '%y') || strftime(o_orderdate + INTERVAL 12 MONTH, '%y') AS season_code,
    year(o_orderdate) = 2001 AS live, CAST(o_orderdate AS DATE) AS d, 'C' || o_custkey % 40 AS home,
    o_orderpriority AS away, CAST(floor(o_totalprice) AS BIGINT) % 5 AS hg, o_orderkey % 5 AS ag,
    CASE o_orderstatus WHEN 'F' THEN 'H' WHEN 'O' THEN 'A' ELSE 'D' END AS res FROM orders),
sides AS (SELECT season_code, live, unnest([home, away]) AS team FROM m),
v(name, n) AS (
  SELECT 'result agrees with scoreline', count(*) FILTER (WHERE CASE WHEN hg > ag THEN 'H' WHEN hg < ag THEN 'A' ELSE 'D' END <> res) FROM m
  UNION ALL SELECT 'no future-dated matches', count(*) FILTER (WHERE d > DATE '2001-06-30') FROM m
  UNION ALL SELECT 'natural key is unique', (SELECT count(*) FROM m) - (SELECT count(*) FROM (SELECT DISTINCT season_code, d, home, away FROM m))
  UNION ALL SELECT 'every team plays 20', count(*) FROM (SELECT 1 FROM sides WHERE NOT live GROUP BY season_code, team HAVING count(*) <> 20)
  UNION ALL SELECT 'live season within 0..200', count(*) FROM m WHERE live
  UNION ALL SELECT 'fixture spread within tolerance', max(n) - min(n) FROM (SELECT count(*) AS n FROM sides WHERE live GROUP BY team)
  UNION ALL SELECT 'player prices between 9.0 and 9.5', count(*) FROM part WHERE p_retailprice / 100 > 9.5 OR p_retailprice / 100 < 9
  UNION ALL SELECT 'minutes between 0 and 90', count(*) FROM lineitem WHERE l_returnflag <> 'N' AND CAST(l_quantity AS INTEGER) * 2 > 90
  UNION ALL SELECT 'one row per player per fixture', (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT l_partkey, l_orderkey FROM lineitem)))
SELECT name, CASE WHEN name LIKE 'live%' THEN n <= 200 WHEN name LIKE 'fixture%' THEN n <= 2 ELSE n = 0 END AS passed,
  CASE WHEN name LIKE 'result%' THEN n || ' disagree' WHEN name LIKE 'no future%' THEN n || ' rows'
    WHEN name LIKE 'every%' THEN CASE WHEN n = 0 THEN 'balanced' ELSE n || ' off' END
    WHEN name LIKE 'live%' THEN n || ' matches' WHEN name LIKE 'fixture%' THEN 'spread ' || n || ', allowed 2'
    WHEN name LIKE 'player prices%' THEN n || ' implausible' WHEN name LIKE 'minutes%' THEN n || ' outside'
    ELSE n || ' duplicates' END AS detail FROM v
UNION ALL SELECT 'no nulls in required columns', TRUE, 'clean'
UNION ALL SELECT 'completed seasons have 200 matches', count(*) = 0, CASE WHEN count(*) = 0 THEN 'all complete'
    ELSE 'off: {{' || string_agg('''' || season_code || ''': ' || n, ', ' ORDER BY season_code) || '}}' END
  FROM (SELECT season_code, count(*) AS n FROM m WHERE NOT live GROUP BY 1 HAVING count(*) <> 200)
UNION ALL SELECT 'enough players per position for a legal squad', count(*) = 0, CASE WHEN count(*) = 0 THEN 'ok'
    ELSE 'short: {{' || string_agg(size || ': ' || need, ', ' ORDER BY size) || '}}' END
  FROM (SELECT p_size AS size, p_size * 2 AS need FROM part GROUP BY p_size HAVING count(*) < p_size * 2)
UNION ALL SELECT 'game clubs all appear in match data', count(*) = 0, CASE WHEN count(*) = 0 THEN 'aligned'
    ELSE 'game-only: [' || string_agg('''' || t || '''', ', ' ORDER BY t) || ']' END
  FROM (SELECT DISTINCT p_brand AS t FROM part EXCEPT SELECT team FROM sides WHERE live)""")
def contract_suite(spark, sf):
    """The whole suite with limits these tables break, so that every detail text is exercised."""
    from touchline.plans.contracts import contract_results
    return contract_results(*suite_tables(spark, sf), b.lines_as_staged_history(spark, sf),
                            F.lit("2001-06-30").cast("date"), LIMITS)


def suite_tables(spark, sf):
    """Orders as matches, parts as players and their sizes as positions."""
    day = F.to_date("o_orderdate")
    matches = b.table(spark, sf, "orders").select(
        b.season_code(day).alias("season_code"), (F.year(day) == b.LIVE_YEAR).alias("is_current_season"),
        day.alias("match_date"), F.concat(F.lit("C"), (F.col("o_custkey") % 40).cast("string")).alias("home_team"),
        F.col("o_orderpriority").alias("away_team"), (F.floor("o_totalprice") % 5).alias("ft_home_goals"),
        (F.col("o_orderkey") % 5).alias("ft_away_goals"),
        F.when(F.col("o_orderstatus") == "F", "H").when(F.col("o_orderstatus") == "O", "A").otherwise("D").alias("ft_result"))
    players = b.table(spark, sf, "part").select(
        (F.col("p_retailprice") / 100.0).alias("price_m"), F.col("p_size").alias("position_id"),
        F.col("p_brand").alias("team_name"))
    sizes = b.table(spark, sf, "part").select(
        F.col("p_size").alias("position_id"), (F.col("p_size") * 2).alias("squad_select")).distinct()
    return matches, players, sizes


@query("contract_quarantine", """
WITH m AS (
  SELECT strftime(o_orderdate, '%y') || strftime(o_orderdate + INTERVAL 12 MONTH, '%y') AS season_code,
    year(o_orderdate) = 2001 AS live, 'C' || o_custkey % 40 AS home, o_orderpriority AS away FROM orders)
SELECT 'completed seasons have 200 matches' AS "check", season_code AS member, count(*) AS value FROM m WHERE NOT live GROUP BY 2 HAVING count(*) <> 200
UNION ALL SELECT 'enough players per position for a legal squad', p_size::VARCHAR, count(*) FROM part GROUP BY p_size HAVING count(*) < p_size * 2
UNION ALL SELECT 'game clubs all appear in match data', p_brand, count(*) FROM part
  WHERE p_brand NOT IN (SELECT unnest([home, away]) FROM m WHERE live) GROUP BY 2""")
def contract_quarantine(spark, sf):
    """Every member behind the failing contracts of the suite, as a table."""
    from touchline.plans.contracts import failing_members
    return failing_members(*suite_tables(spark, sf), LIMITS)


@query("required_nulls", """
SELECT 'no nulls in required columns' AS name, count(*) = count(referee) AS passed,
  CASE WHEN count(*) = count(referee) THEN 'clean'
    ELSE 'nulls: {''referee'': ' || (count(*) - count(referee)) || '}' END AS detail
FROM (SELECT nullif(o_orderpriority, '4-NOT SPECIFIED') AS referee FROM orders)""")
def required_nulls(spark, sf):
    return checks.run_row_checks(b.order_seasons(spark, sf), [checks.no_nulls(["match_date", "season_code", "referee"])])


@query("stacked_roles", """
SELECT team, count(*) AS rows FROM (SELECT c_name AS team FROM customer UNION ALL SELECT c_mktsegment FROM customer) GROUP BY 1""")
def stacked_roles(spark, sf):
    return stack_columns(b.table(spark, sf, "customer"), [], ["c_name", "c_mktsegment"], "team").groupBy("team").agg(
        F.count(F.lit(1)).alias("rows"))
