"""Registered queries on change detection, loads and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.bindings import inputs as b
from touchline.bindings.registry import query
from touchline.functions import expressions as e
from touchline.operators.aggregates import length_histogram, ordered_text
from touchline.operators.incremental import (high_water_mark, latest_entry, load_summary, needing_refresh,
                                             reconcile, replace_by_key, signatures)
from touchline.operators.joins import with_one_row
from touchline.sources.game_documents import sweep_manifest
from touchline.sources.sinks import flat, stamped

ctes = b.with_ctes


def line_totals(spark, sf, until=None):
    lines = b.table(spark, sf, "lineitem")
    if until:
        lines = lines.filter(F.col("l_shipdate") < F.lit(until).cast("timestamp"))
    return lines.groupBy("l_partkey").agg(F.sum("l_linenumber").alias("points"),
                                          F.sum(F.col("l_quantity").cast("int")).alias("minutes"))


@query("row_signatures", """
SELECT l_partkey, CAST(sum(l_linenumber) AS BIGINT) || ':' || CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS signature
FROM lineitem GROUP BY 1""")
def row_signatures(spark, sf):
    return signatures(line_totals(spark, sf), "l_partkey", ["points", "minutes"])


@query("snapshot_diff", """
WITH now AS (SELECT l_partkey, sum(l_linenumber) || ':' || sum(CAST(l_quantity AS INTEGER)) AS s FROM lineitem GROUP BY 1),
before AS (SELECT l_partkey, sum(l_linenumber) || ':' || sum(CAST(l_quantity AS INTEGER)) AS s FROM lineitem
  WHERE l_shipdate < DATE '2001-06-01' GROUP BY 1)
SELECT n.l_partkey FROM now n LEFT JOIN before b ON b.l_partkey = n.l_partkey
LEFT JOIN (SELECT p_partkey FROM part WHERE p_size <= 45) h ON h.p_partkey = n.l_partkey
WHERE b.s IS NULL OR n.s <> b.s OR h.p_partkey IS NULL""")
def snapshot_diff(spark, sf):
    """Parts whose totals moved since June 2001, that are new, or that have no stored history
    (histories of large parts were never stored)."""
    columns = ["points", "minutes"]
    stored = b.table(spark, sf, "part").filter("p_size <= 45").select(F.col("p_partkey").alias("l_partkey"))
    return needing_refresh(signatures(line_totals(spark, sf), "l_partkey", columns),
                           signatures(line_totals(spark, sf, "2001-06-01"), "l_partkey", columns), "l_partkey", stored)


@query("high_water_mark", ctes(b.GAMEWEEKS_SQL) + """
SELECT CAST(max(gameweek_id) AS BIGINT) AS latest, CAST(70 AS BIGINT) AS last_processed, max(gameweek_id) > 70 AS should_refresh
FROM gameweeks WHERE finished AND average_score > 0""")
def new_period(spark, sf):
    return high_water_mark(b.months_as_gameweeks(spark, sf), "gameweek_id",
                           F.col("finished") & (F.col("average_score") > 0), F.lit(70))


@query("load_summary", """
SELECT '2001-08-02T00:00:00+00:00' AS refreshed_at, count(*) AS total_matches,
  count(*) FILTER (WHERE year(o_orderdate) = 2001) AS live_matches,
  (SELECT count(*) FROM lineitem) AS player_fixture_rows,
  (SELECT CAST(max((year(l_shipdate) - 1995) * 12 + month(l_shipdate)) AS INTEGER) FROM lineitem) AS latest_gameweek,
  strftime(max(o_orderdate) FILTER (WHERE year(o_orderdate) = 2001), '%Y-%m-%d') AS latest_match_date
FROM orders""")
def summary_row(spark, sf):
    matches = b.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("match_date"))
    return load_summary(matches, F.year("match_date") == b.LIVE_YEAR, "match_date",
                        b.lines_as_staged_history(spark, sf), "gameweek_id",
                        stamped(F.lit("2001-08-02").cast("timestamp")))


@query("latest_log_row", "SELECT event_id, user_id, event_type, ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 1")
def latest_log_row(spark, sf):
    return latest_entry(b.table(spark, sf, "events"), "ts", "event_id").select("event_id", "user_id", "event_type", "ts")


@query("replace_by_key", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CASE WHEN year(o_orderdate) = 2001
  THEN round(o_totalprice * 2, 2) ELSE o_totalprice END AS price FROM orders""")
def replaced_year(spark, sf):
    """The orders of 2001 are loaded again with doubled prices."""
    stored = b.table(spark, sf, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("y"), F.col("o_totalprice").alias("price"))
    batch = stored.filter(F.col("y") == b.LIVE_YEAR).withColumn("price", e.round_half_away(F.col("price") * 2, 2))
    return replace_by_key(stored, batch, "y")


@query("reconcile_counts", ctes(b.GAMEWEEKS_SQL) + """
SELECT (SELECT count(*) FROM gameweeks WHERE finished) AS left_rows,
  count(DISTINCT strftime(l_shipdate, '%Y-%m')) AS right_rows, CAST(min(l_shipdate) AS DATE) AS first_day,
  CAST(max(l_shipdate) AS DATE) AS last_day,
  (SELECT count(*) FROM gameweeks WHERE finished) = count(DISTINCT strftime(l_shipdate, '%Y-%m')) AS agree FROM lineitem""")
def reconcile_counts(spark, sf):
    left = b.months_as_gameweeks(spark, sf).filter("finished").agg(F.count(F.lit(1)).alias("left_rows"))
    days = b.table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("d")).distinct()
    right = days.agg(F.count_distinct(F.date_format("d", "yyyy-MM")).alias("right_rows"),
                     F.min("d").alias("first_day"), F.max("d").alias("last_day"))
    return reconcile(left, right)


@query("sweep_manifest", ctes(b.GAMEWEEKS_SQL) + """
SELECT 'now' AS fetched_at, (SELECT count(*) FROM part) AS players, min(gameweek_id) FILTER (WHERE is_current) AS current_gameweek
FROM gameweeks""")
def sweep(spark, sf):
    events = b.months_as_gameweeks(spark, sf).withColumnRenamed("gameweek_id", "id")
    return sweep_manifest(b.table(spark, sf, "part"), events, F.lit("now"))


@query("length_histogram", "SELECT length(text) AS length, count(*) AS rows FROM documents GROUP BY 1")
def text_lengths(spark, sf):
    return length_histogram(b.table(spark, sf, "documents"), "text")


@query("date_spellings", """
SELECT length(CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%d/%m/%y') ELSE strftime(o_orderdate, '%d/%m/%Y') END)
  AS length, count(*) AS rows FROM orders GROUP BY 1""")
def date_spellings(spark, sf):
    written = F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "dd/MM/yy")) \
        .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    return length_histogram(b.table(spark, sf, "orders").select(written.alias("written")), F.col("written"))


@query("ordered_text", """
SELECT p_brand, string_agg(p_type, ', ' ORDER BY p_type) AS types FROM (SELECT DISTINCT p_brand, p_type FROM part) GROUP BY 1""")
def types_per_brand(spark, sf):
    return ordered_text(b.table(spark, sf, "part").select("p_brand", "p_type").distinct(), ["p_brand"], "p_type", "types")


@query("flag_export", """
SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS finished, CAST(o_totalprice > 200000 AS INTEGER) AS large,
  o_orderdate AS deadline_time FROM orders""")
def flag_export(spark, sf):
    return flat(b.table(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_orderstatus") == "F").alias("finished"), (F.col("o_totalprice") > 200000).alias("large"),
        F.col("o_orderdate").alias("deadline_time")))


@query("order_scalars", """
SELECT o_orderkey, strftime(o_orderdate, '%d %b %Y %H:%M') AS stamp,
  '20' || substr(code, 1, 2) || '/' || substr(code, 3, 2) AS label, code = '0102' AS is_live,
  CAST('20' || substr(code, 1, 2) AS INTEGER) AS start_year,
  CASE code WHEN '9900' THEN 'restricted' ELSE 'normal' END AS note,
  upper(trim('  ' || lower(o_orderstatus) || ' ')) AS status_code,
  CASE o_orderstatus WHEN 'F' THEN 'F' ELSE NULL END || ' ' || o_orderpriority AS joined,
  CAST(o_orderdate + INTERVAL 7 DAY AS DATE) AS padded, date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS days,
  greatest(CAST(o_orderdate AS DATE), CASE WHEN o_orderstatus = 'P' THEN NULL ELSE DATE '1998-01-01' END) AS later,
  CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS parsed_at, o_custkey / 10.0::DOUBLE AS tenths
FROM (SELECT *, strftime(o_orderdate, '%y') || strftime(o_orderdate + INTERVAL 12 MONTH, '%y') AS code FROM orders)""")
def order_scalars(spark, sf):
    code, day, status = F.col("code"), F.to_date("o_orderdate"), F.col("o_orderstatus")
    orders = b.table(spark, sf, "orders").withColumn("code", b.season_code(day))
    iso = F.when(status == "F", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise("unknown")
    return orders.select(
        "o_orderkey", e.stamp("o_orderdate").alias("stamp"), e.season_label(code).alias("label"),
        (code == "0102").alias("is_live"), e.season_year(code, 1).alias("start_year"),
        e.label_for(code, {"9900": "restricted"}, "normal").alias("note"),
        e.code(F.concat(F.lit("  "), F.lower(status), F.lit(" "))).alias("status_code"),
        e.full_name(F.when(status == "F", status), "o_orderpriority").alias("joined"),
        F.date_add(day, 7).alias("padded"), F.datediff(day, F.lit("1995-01-01").cast("date")).cast("bigint").alias("days"),
        F.greatest(day, F.when(status != "P", F.lit("1998-01-01").cast("date"))).alias("later"),
        e.utc_timestamp(iso).cast("timestamp_ntz").alias("parsed_at"), e.from_tenths("o_custkey").alias("tenths"))


@query("line_scalars", """
SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice / nullif(round(l_discount * 100), 0), 2) AS ratio,
  round(100.0::DOUBLE * l_linenumber / nullif(CAST(l_quantity AS INTEGER) - 1, 0), 1) AS share,
  CAST(l_linestatus = 'F' AS INTEGER) AS flag, round(l_extendedprice, 1) AS rounded,
  CASE WHEN l_returnflag = 'R' THEN 3 WHEN l_returnflag = 'N' THEN 1 ELSE 0 END AS points,
  CAST(l_linenumber AS VARCHAR) || ' ' || coalesce(nullif(l_returnflag, 'N'), '?')
    || CASE l_linestatus WHEN 'F' THEN ' (H)' ELSE ' (A)' END AS label FROM lineitem""")
def line_scalars(spark, sf):
    quantity = F.col("l_quantity").cast("int")
    result = F.when(F.col("l_returnflag") == "R", "H").when(F.col("l_returnflag") == "N", "D").otherwise("A")
    home = F.col("l_linestatus") == "F"
    return b.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        e.safe_ratio(F.col("l_extendedprice"), F.round(F.col("l_discount") * 100), 2).alias("ratio"),
        e.percent(F.col("l_linenumber"), quantity - 1, 1).alias("share"), home.cast("int").alias("flag"),
        e.round_half_away(F.col("l_extendedprice"), 1).alias("rounded"), e.points_for(result, "H").alias("points"),
        e.fixture_label("l_linenumber", F.nullif("l_returnflag", F.lit("N")), home).alias("label"))


@query("shortened_text", """
SELECT doc_id, CASE WHEN length(text) > 34 THEN substr(text, 1, 34) || '…' ELSE text END AS shown FROM documents""")
def shortened_text(spark, sf):
    return b.table(spark, sf, "documents").select("doc_id", e.shorten("text").alias("shown"))


@query("within_bounds", ctes(b.USER_DAYS_SQL) + """
SELECT fpl_fixture_id, gameweek_id, minutes FROM user_days, (SELECT min(gameweek_id) AS lo FROM user_days WHERE minutes > 98)
WHERE gameweek_id BETWEEN lo AND lo + 4""")
def within_bounds(spark, sf):
    days = b.user_days(spark, sf)
    low = days.filter("minutes > 98").agg(F.min("gameweek_id").alias("lo"))
    return with_one_row(days, low).filter(F.col("gameweek_id").between(F.col("lo"), F.col("lo") + 4)).select(
        "fpl_fixture_id", "gameweek_id", "minutes")


@query("rounded_large", """
SELECT l_orderkey, l_linenumber, l_orderkey * 1e14::DOUBLE AS big, -l_orderkey * 1e16::DOUBLE AS negative,
  round(l_extendedprice / 7, 3) AS small FROM lineitem""")
def rounded_large(spark, sf):
    """Totals past 1e14 have no digits left to round; they must come back as they are."""
    rows = b.table(spark, sf, "lineitem")
    key = F.col("l_orderkey").cast("double")
    return rows.select("l_orderkey", "l_linenumber", e.round_half_away(key * 1e14, 6).alias("big"),
                       e.round_half_away(-key * 1e16, 2).alias("negative"),
                       e.round_half_away(F.col("l_extendedprice") / 7, 3).alias("small"))
