"""Registered queries that write the given tables in the pipeline's file formats and read them
back through its sources. Files go to fresh folders in the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.bindings import inputs as b
from touchline.bindings.registry import query
from touchline.functions import expressions as e
from touchline.functions.expressions import calendar_columns, day_first_date, to_number, to_whole
from touchline.operators.incremental import commit_snapshot, load_summary, needing_refresh, signatures
from touchline.operators.joins import small_side
from touchline.operators.reshape import column_presence, missing_columns
from touchline.params import GAME_NAMES, Params
from touchline.plans import clean_players as cp
from touchline.plans.warehouse import changed_files, keep_manifest, land_runs
from touchline.sources import game_documents as docs
from touchline.sources import match_files, member_store, sinks, versions
from touchline.session import materialize, new_folder
from touchline.streaming.arrivals import on_arrival

ctes = b.with_ctes
HEADERS = {"Date": "match_date", "Key": "match_id", "Price": "price", "Status": "status", "Time": "kickoff_time"}


def write_seasons(spark, sf, folder=None, where="true"):
    """Orders as season folders of CSV whose headers differ: later seasons carry a time and
    list their columns in another order. Orders can arrive in several goes."""
    folder = folder or new_folder(spark, "seasons")
    orders = b.table(spark, sf, "orders").filter(where).select(
        F.year("o_orderdate").alias("y"), F.date_format("o_orderdate", "dd/MM/yyyy").alias("Date"),
        F.col("o_orderkey").alias("Key"), F.col("o_totalprice").alias("Price"),
        F.col("o_orderstatus").alias("Status"), F.date_format("o_orderdate", "HH:mm").alias("Time"))
    early, late = ["Date", "Key", "Price", "Status"], ["Key", "Time", "Date", "Status", "Price"]
    for era, columns, rows in (("early", early, orders.filter("y < 1998")), ("late", late, orders.filter("y >= 1998"))):
        rows.select("y", *columns).write.mode("append").partitionBy("y").option("header", True).csv(f"{folder}/{era}")
    return folder


SEASON_FILES_SQL = """
SELECT CAST(o_orderdate AS DATE) AS match_date, o_orderkey AS match_id, o_totalprice AS price, o_orderstatus AS status,
  CASE WHEN year(o_orderdate) >= 1998 THEN '00:00' END AS kickoff_time FROM orders"""


@query("season_files", SEASON_FILES_SQL)
def season_files(spark, sf):
    """Header drift: folders are grouped by header signature, each group read by its own header."""
    return match_files.read_by_header(spark, write_seasons(spark, sf), HEADERS).select(
        day_first_date("match_date").alias("match_date"), to_whole("match_id", "bigint").alias("match_id"),
        to_number("price").alias("price"), "status", "kickoff_time")


PRESENCE_SQL = """
WITH held AS (SELECT DISTINCT year(o_orderdate) AS y FROM orders),
columns(name, since) AS (VALUES ('Date', 0), ('Key', 0), ('Price', 0), ('Status', 0), ('Time', 1998))"""


def season_headers(spark, sf):
    """One row per season and column of its files."""
    headers = match_files.file_headers(spark, write_seasons(spark, sf))
    return headers.select(F.regexp_extract("path", "/y=([0-9]+)/", 1).cast("int").alias("y"), "column").distinct()


@query("column_presence", PRESENCE_SQL + """
SELECT name AS "column", count(*) AS present, (SELECT count(*) FROM held) AS files,
  count(*) = (SELECT count(*) FROM held) AS stable
FROM columns JOIN held ON y >= since GROUP BY name""")
def presence(spark, sf):
    return column_presence(season_headers(spark, sf), "y", "column")


@query("missing_columns", PRESENCE_SQL + 'SELECT CAST(y AS INTEGER) AS y, name AS "column" FROM columns JOIN held ON y < since')
def absence(spark, sf):
    return missing_columns(season_headers(spark, sf), "y", "column")


@query("file_manifest", """
SELECT era, count(*) AS rows, TRUE AS changed FROM (SELECT CASE WHEN year(o_orderdate) < 1998 THEN 'early' ELSE 'late' END AS era
FROM orders) GROUP BY 1""")
def file_manifest(spark, sf):
    """Line counts per file, without the header, add up to the rows that were written."""
    files = match_files.manifest(spark, write_seasons(spark, sf), F.lit("2001-08-02").cast("timestamp"))
    return files.groupBy(F.regexp_extract("path", "/(early|late)/", 1).alias("era")).agg(
        F.sum("rows").alias("rows"), F.bool_and("changed").alias("changed"))


def write_histories(spark, sf):
    """JSON lines: a document nests a part's lines of one order, so that none can grow large."""
    folder = new_folder(spark, "documents")
    lines = b.table(spark, sf, "lineitem")
    entry = F.struct(F.col("l_orderkey").cast("int").alias("fixture"), F.col("l_linenumber").alias("total_points"),
                     F.col("l_quantity").cast("int").alias("minutes"), F.col("l_tax").cast("string").alias("influence"))
    lines.groupBy("l_partkey", "l_orderkey").agg(
        F.collect_list(entry).alias("history")).write.json(f"{folder}/histories")
    return folder


HISTORY_ENTRY = "array<struct<fixture: int, total_points: int, minutes: int, influence: string>>"


@query("document_histories", """
SELECT l_partkey AS player, CAST(l_orderkey AS INTEGER) AS fixture, l_linenumber AS total_points,
  CAST(l_quantity AS INTEGER) AS minutes, l_tax AS influence FROM lineitem JOIN part ON p_partkey = l_partkey""")
def document_histories(spark, sf):
    """Nested histories flattened, entries of unknown members left out."""
    document = docs.read_lines(spark, f"{write_histories(spark, sf)}/histories",
                               f"l_partkey bigint, history {HISTORY_ENTRY}")
    rows = document.select(F.col("l_partkey").alias("player"), F.explode("history").alias("e")).select("player", "e.*")
    known = b.table(spark, sf, "part").select(F.col("p_partkey").alias("player"))
    return rows.join(known, "player", "left_semi").withColumn("influence", to_number("influence"))


DOCUMENT_LINES = 5_000  # about so many lines of a supplier make a document
TASK_DOCUMENTS = 250  # about so many documents are written by a task


def write_member_files(spark, sf, folder=None, where="true"):
    """Suppliers' lines in ``player_<supplier>.json``, a folder of the parts of one file. A part is a document of its own; a
    supplier of more than DOCUMENT_LINES has several, its lines dealt evenly. Suppliers' files can be written anew.

    There are as many files as members. The committer's version 2, which moves them in its tasks, makes every member's
    folder a second time and leaves the driver the first one to delete, so the usual version is the faster one here.
    Writing takes time by the files, not by their bytes, so documents are dealt to tasks by their number. By their
    bytes they were in about as many tasks as cores, of which one more made a second wave."""
    lines = b.table(spark, sf, "lineitem").filter(where).withColumn("_line", F.monotonically_increasing_id())
    parts = F.ceil(F.col("_n") / DOCUMENT_LINES).cast("long")
    sizes = materialize(lines.groupBy(F.col("l_suppkey").alias("_supplier")).agg(F.count(F.lit(1)).alias("_n")))
    large = sizes.filter(F.col("_n") > DOCUMENT_LINES).select("_supplier", parts.alias("_parts"))
    tasks = max(-(-(sizes.agg(F.sum(parts)).first()[0] or 0) // TASK_DOCUMENTS), spark.sparkContext.defaultParallelism)
    entry = F.struct(F.col("l_orderkey").cast("int").alias("fixture"), F.col("l_linenumber").alias("total_points"),
                     F.col("l_quantity").cast("int").alias("minutes"), F.col("l_tax").cast("string").alias("influence"))
    dealt = lines.join(small_side(large), F.col("l_suppkey").eqNullSafe(F.col("_supplier")), "left").withColumn(
        "_part", F.pmod("_line", F.coalesce("_parts", F.lit(1))))
    documents = dealt.repartition(tasks, "l_suppkey", "_part").groupBy("l_suppkey", "_part").agg(F.collect_list(entry).alias("history"))
    name = F.concat(F.lit("player_"), F.col("l_suppkey"), F.lit(".json"))
    writer = documents.select("history", name.alias("file")).write.option("maxRecordsPerFile", 1).partitionBy("file")
    if folder:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    folder = folder or new_folder(spark, "members")
    writer.json(folder)
    return folder


def supplier_members(spark, sf, where="true"):
    """Suppliers, but for those of nation 3, with the totals of their lines as signature."""
    totals = b.table(spark, sf, "lineitem").filter(where).groupBy(F.col("l_suppkey").alias("id")).agg(
        F.sum("l_linenumber").alias("total_points"), F.sum(F.col("l_quantity").cast("int")).alias("minutes"))
    known = b.table(spark, sf, "supplier").filter("s_nationkey <> 3").select(F.col("s_suppkey").alias("id"))
    return known.join(totals, "id", "left")


MEMBER_SQL = """
SELECT l_suppkey AS fpl_element_id, CAST(l_orderkey AS INTEGER) AS fixture, l_linenumber AS total_points,
  CAST(l_quantity AS INTEGER) AS minutes, l_tax AS influence FROM lineitem JOIN supplier ON s_suppkey = l_suppkey AND s_nationkey <> 3"""


@query("player_histories", MEMBER_SQL)
def player_histories(spark, sf):
    """Every member's history files through the reader of the pipeline, the id from the file's name; files of
    members that are not known are left out."""
    rows = docs.histories(spark, write_member_files(spark, sf), supplier_members(spark, sf), schema=HISTORY_ENTRY)
    return rows.drop("_place").withColumn("influence", to_number("influence"))


FIRST_SWEEP = "l_shipdate < timestamp'1999-01-01'"


@query("refreshed_histories", MEMBER_SQL + " WHERE l_shipdate < DATE '1999-01-01' OR l_suppkey % 10 = 0")
def refreshed_histories(spark, sf):
    """A first sweep stores what was shipped before 1999; then a tenth of the suppliers ship on. The second sweep
    reads and rewrites only theirs."""
    store, again = new_folder(spark, "store"), f"({FIRST_SWEEP}) OR l_suppkey % 10 = 0"
    folder, columns = write_member_files(spark, sf, where=FIRST_SWEEP), ["total_points", "minutes"]
    member_store.refresh_histories(spark, folder, store, supplier_members(spark, sf, FIRST_SWEEP), columns, schema=HISTORY_ENTRY)
    write_member_files(spark, sf, folder, "l_suppkey % 10 = 0")
    rows = member_store.refresh_histories(spark, folder, store, supplier_members(spark, sf, again), columns, schema=HISTORY_ENTRY)
    return rows.drop("_place").withColumn("influence", to_number("influence"))


@query("json_fields", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def json_fields(spark, sf):
    return b.table(spark, sf, "events").select("event_id", F.from_json("props", "k int").alias("p")).select("event_id", "p.k")


@query("landed_tables", """
SELECT 'orders' AS name, count(*) AS rows FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem
UNION ALL SELECT 'customer', count(*) FROM customer""")
def landed_tables(spark, sf):
    """Row counts observed while the tables are landed, next to what is read back."""
    folder = new_folder(spark, "landed")
    counts = sinks.land_all({t: b.table(spark, sf, t) for t in ("orders", "lineitem", "customer")}, folder)
    back = None
    for name, rows in counts.items():
        part = spark.read.parquet(f"{folder}/{name}").agg(F.count(F.lit(1)).alias("read")).select(
            F.lit(name).alias("name"), F.lit(rows).cast("bigint").alias("rows"), "read")
        back = part if back is None else back.unionByName(part)
    return back.filter(F.col("rows") == F.col("read")).drop("read")


@query("landed_partitions", """
SELECT o_orderkey, CASE WHEN year(o_orderdate) = 2001 THEN o_totalprice + 1 ELSE o_totalprice END AS price,
  CAST(year(o_orderdate) AS INTEGER) AS y FROM orders""")
def landed_partitions(spark, sf):
    """The live year's partition is landed again; the others stay as they were."""
    folder = new_folder(spark, "partitions")
    orders = b.table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_totalprice").alias("price"), F.year("o_orderdate").alias("y"))
    sinks.land_partitions(orders, folder, "y")
    sinks.land_partitions(orders.filter(F.col("y") == b.LIVE_YEAR).withColumn("price", F.col("price") + 1), folder, "y")
    return spark.read.parquet(folder)


@query("landed_replaced", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders WHERE year(o_orderdate) <> 2001""")
def landed_replaced(spark, sf):
    """A table landed again without one of its partitions does not keep that partition."""
    folder = new_folder(spark, "replaced")
    orders = b.table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"))
    versions.replace(orders, folder, "orders", ["y"])
    versions.replace(orders.filter(F.col("y") != b.LIVE_YEAR), folder, "orders", ["y"])
    return versions.read(spark, folder, "orders")


@query("published_together", """
SELECT name, y, count(*) AS rows FROM (
  SELECT 'orders' AS name, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders WHERE o_orderstatus <> 'P'
  UNION ALL SELECT 'lines', CAST(year(l_shipdate) AS INTEGER) FROM lineitem WHERE l_returnflag <> 'N' OR year(l_shipdate) < 2000)
GROUP BY 1, 2""")
def published_together(spark, sf):
    """Two tables change in one step: one is replaced whole, of the other only the partitions from 2000 on. A third
    version that is written and never published is not seen."""
    folder = new_folder(spark, "published")
    orders = b.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("y"))
    lines = b.table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", F.year("l_shipdate").alias("y"))
    versions.publish(spark, folder, versions.stage(orders, folder, "orders", ["y"]), versions.stage(lines, folder, "lines", ["y"]))
    late = sorted(r["y"] for r in lines.filter("y >= 2000").select("y").distinct().collect())
    part = versions.stage_parts(lines.filter("y >= 2000 AND l_returnflag <> 'N'"), folder, "lines", "y", late)
    versions.publish(spark, folder, versions.stage(orders.filter("o_orderstatus <> 'P'"), folder, "orders"), part)
    versions.stage(orders.limit(1), folder, "orders")
    versions.vacuum(spark, folder, ["orders", "lines"])
    both = [versions.read(spark, folder, n).select(F.lit(n).alias("name"), "y") for n in ("orders", "lines")]
    return both[0].unionByName(both[1]).groupBy("name", "y").agg(F.count(F.lit(1)).alias("rows"))


@query("landed_version", """
SELECT event_type AS run_id, user_id AS stage, CASE event_type WHEN 'purchase' THEN value + 1 ELSE value END AS duration_s
FROM events""")
def landed_version(spark, sf):
    """Replace by key without partitions: the runs of one kind are loaded again with other times; the rest stays."""
    runs = b.table(spark, sf, "events").select(F.col("event_type").alias("run_id"), F.col("user_id").alias("stage"),
                                               F.col("value").alias("duration_s"))
    batch = runs.filter("run_id = 'purchase'").withColumn("duration_s", F.col("duration_s") + 1)
    first = sinks.land_new_version(spark, runs, "run_id", None, new_folder(spark, "runs"))
    again = sinks.land_new_version(spark, batch, "run_id", first, new_folder(spark, "runs"))
    return spark.read.parquet(again)


@query("load_log", """
SELECT CAST(year(o_orderdate) AS VARCHAR) AS refreshed_at, count(*) AS total_matches,
  count(*) FILTER (WHERE o_orderstatus = 'F') AS live_matches, (SELECT count(*) FROM lineitem) AS player_fixture_rows,
  (SELECT max((year(l_shipdate) - 1995) * 12 + month(l_shipdate))::INTEGER FROM lineitem) AS latest_gameweek,
  strftime(max(o_orderdate) FILTER (WHERE o_orderstatus = 'F'), '%Y-%m-%d') AS latest_match_date
FROM orders GROUP BY year(o_orderdate)""")
def load_log(spark, sf):
    """One load per year appends one row each; nothing is replaced."""
    folder, orders = new_folder(spark, "log"), b.table(spark, sf, "orders")
    facts = b.lines_as_staged_history(spark, sf)
    years = sorted(r["y"] for r in orders.select(F.year("o_orderdate").alias("y")).distinct().collect())
    for year in years:
        matches = orders.filter(F.year("o_orderdate") == year).select(F.to_date("o_orderdate").alias("match_date"), "o_orderstatus")
        row = load_summary(matches, F.col("o_orderstatus") == "F", "match_date", facts, "gameweek_id", F.lit(str(year)))
        sinks.append_log(row, folder)
    return spark.read.parquet(folder)


@query("run_log", """
SELECT CAST(event_id AS VARCHAR) AS run_id, event_type AS stage, 'ok' AS status, round(value, 2) AS duration_s,
  user_id AS rows, event_type || ' ' || props AS message FROM events""")
def run_log(spark, sf):
    folder = new_folder(spark, "runlog")
    runs = b.table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("run_id"), F.col("event_type").alias("stage"), F.lit("ok").alias("status"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("finished_at"), F.col("value").alias("duration_s"),
        F.col("user_id").alias("rows"), F.concat_ws(" ", "event_type", "props").alias("message"))
    sinks.record_runs(runs, folder)
    return sinks.read_runs(spark, folder).drop("finished_at")


@query("cut_messages", "SELECT doc_id AS rows, substr(text, 1, 500) AS message FROM documents")
def cut_messages(spark, sf):
    """Whole texts are logged; the log keeps 500 characters of a message, as its format says."""
    folder = new_folder(spark, "runlog")
    runs = b.table(spark, sf, "documents").select(
        F.lit("run").alias("run_id"), F.lit("load").alias("stage"), F.lit("ok").alias("status"),
        F.lit("2001-08-02").alias("finished_at"), F.lit(0.0).alias("duration_s"), F.col("doc_id").alias("rows"),
        F.col("text").alias("message"))
    sinks.record_runs(runs, folder)
    return sinks.read_runs(spark, folder).select("rows", "message")


@query("csv_export", """
SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS finished, o_totalprice,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '+00:00' AS deadline_time FROM orders""")
def csv_export(spark, sf):
    """Booleans as 0/1, timestamps in UTC and a byte-order mark, read back as text."""
    folder = new_folder(spark, "export")
    orders = b.table(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_orderstatus") == "F").alias("finished"), "o_totalprice",
        F.col("o_orderdate").cast("timestamp").alias("deadline_time"))
    sinks.export_csv({"orders": orders}, folder)
    back = sinks.read_export(spark, f"{folder}/orders")
    return back.select(F.col("o_orderkey").cast("bigint"), F.col("finished").cast("int"),
                       F.col("o_totalprice").cast("double"), "deadline_time")


@query("written_rejects", """
SELECT CASE WHEN l_quantity > 45 THEN 'too many' ELSE 'free' END AS reject_reason, count(*) AS rows FROM lineitem
WHERE l_quantity > 45 OR round(l_discount * 100) = 0 GROUP BY 1""")
def written_rejects(spark, sf):
    from touchline.operators.rejects import REASON, flag_rejects, reject_counts, rejected
    folder = new_folder(spark, "rejects")
    rules = [("too many", F.col("l_quantity") > 45), ("free", F.round(F.col("l_discount") * 100) == 0)]
    sinks.write_rejects(rejected(flag_rejects(b.table(spark, sf, "lineitem"), rules)), folder)
    return reject_counts(sinks.read_export(spark, folder)).select(REASON, "rows")


@query("seasons_to_fetch", """
SELECT strftime(o_orderdate, '%y') || strftime(o_orderdate + INTERVAL 12 MONTH, '%y') AS season FROM orders
WHERE year(o_orderdate) >= 2000 GROUP BY 1""")
def seasons_to_fetch(spark, sf):
    """Seasons shipped before 2000 are stored; 2000/01 is missing and the live one is always due."""
    ordered = b.order_seasons(spark, sf).select(F.col("season_code").alias("season")).distinct()
    lines = b.table(spark, sf, "lineitem").filter(F.col("l_shipdate") < F.lit("2000-01-01").cast("timestamp"))
    stored = lines.select(b.season_code(F.to_date("l_shipdate")).alias("season")).distinct()
    return match_files.seasons_to_fetch(ordered, stored, b.LIVE.current_season)


@query("arrived_files", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS y, count(*) AS orders FROM orders GROUP BY 1""")
def arrived_files(spark, sf):
    """Each season's files arrive in two goes. New files drive a stream that rebuilds their season from all of its
    files; a third run finds nothing new."""
    source, work = new_folder(spark, "seasons"), new_folder(spark, "arrivals")

    def land(batch, number):
        seasons = batch.select(F.regexp_extract("path", "/((?:early|late)/y=[0-9]+)/", 1).alias("s")).distinct().collect()
        rows = match_files.read_by_header(spark, [f"{source}/{r['s']}" for r in seasons], HEADERS)
        sinks.land_partitions(rows.select("match_id", F.year(day_first_date("match_date")).alias("y")), f"{work}/landed", "y")

    for half in ("month(o_orderdate) <= 6", "month(o_orderdate) > 6"):
        write_seasons(spark, sf, source, half)
        on_arrival(spark, f"{source}/*/*", f"{work}/state", land)
    if on_arrival(spark, f"{source}/*/*", f"{work}/state", land):
        raise AssertionError("a processed file arrived again")
    return spark.read.parquet(f"{work}/landed").groupBy("y").agg(F.count(F.lit(1)).alias("orders"))


@query("calendar_attributes", """
SELECT DISTINCT CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS date_id, CAST(l_shipdate AS DATE) AS full_date,
  CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
  strftime(l_shipdate, '%B') AS month_name, CAST(day(l_shipdate) AS INTEGER) AS day_of_month,
  strftime(l_shipdate, '%A') AS day_of_week, CAST(week(l_shipdate) AS INTEGER) AS iso_week,
  CAST(dayofweek(l_shipdate) IN (0, 6) AS INTEGER) AS is_weekend FROM lineitem""")
def calendar_attributes(spark, sf):
    days = b.table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("d")).distinct()
    return days.select(*calendar_columns("d"))


def write_match_files(spark, sf, folder=None, where="true"):
    """Matches in the season files' own columns, a folder of parts for each season. One season is Latin-1 with an
    umlaut in its referees, one has a byte-order mark, and the first ones know no kickoff time. Matches can arrive
    in several goes."""
    folder, nations = folder or new_folder(spark, "matches"), b.nations_as_teams(spark, sf)
    rows = b.keyed_matches(spark, sf).withColumn("season", b.season_code(F.col("match_date"))).filter(where)
    for side in ("home", "away"):
        rows = rows.join(nations.select(F.col("team_id").alias(f"{side}_team_id"), F.col("team_name").alias(f"{side}_team")), f"{side}_team_id")
    referee = F.when(F.col("season") == "9697", F.concat(F.lit("J Müller "), "referee")).otherwise(F.col("referee"))
    rows = rows.select(
        "season", F.date_format("match_date", "dd/MM/yyyy").alias("Date"), F.col("home_team").alias("HomeTeam"),
        F.col("away_team").alias("AwayTeam"), F.col("ft_home_goals").alias("FTHG"), F.col("ft_away_goals").alias("FTAG"),
        F.col("ft_result").alias("FTR"), referee.alias("Referee"), F.col("home_shots").alias("HS"), F.lit("15:00").alias("Time"))
    # Matches are joined once and dealt by season; a season's files are written from its own rows alone.
    dealt = new_folder(spark, "dealt")
    rows.write.partitionBy("season").parquet(dealt)
    rows = spark.read.schema(rows.schema).parquet(dealt)
    seasons = sorted(r["season"] for r in rows.select("season").distinct().collect())
    for season in seasons:
        own = rows.filter(F.col("season") == season).drop("season", *(["Time"] if season < "1" or season >= "98" else []))
        if season == "9798":
            own = own.withColumnRenamed("Date", sinks.BYTE_ORDER_MARK + "Date")
        encoding = "ISO-8859-1" if season == "9697" else "UTF-8"
        own.write.mode("append").option("header", True).option("encoding", encoding).csv(f"{folder}/E0_{season}.csv")
    return folder


def ranked_seasons(spark, folder):
    return match_files.load_matches(spark, folder, Params(current_season="0102"))


LOADED_SQL = ctes(b.MATCHES_SQL, """
lines AS (SELECT m.*, printf('%02d%02d', season_id % 100, (season_id + 1) % 100) AS code, h.n_name AS home, a.n_name AS away
  FROM matches m JOIN nation h ON h.n_nationkey = home_team_id JOIN nation a ON a.n_nationkey = away_team_id)""")


@query("loaded_matches", LOADED_SQL + """
SELECT strftime(match_date, '%d/%m/%Y') AS match_date, home AS home_team, away AS away_team, ft_home_goals::VARCHAR AS ft_home_goals,
  ft_away_goals::VARCHAR AS ft_away_goals, ft_result, CASE WHEN code = '9697' THEN 'J Müller ' || referee ELSE referee END AS referee,
  home_shots::VARCHAR AS home_shots, CASE WHEN code BETWEEN '1' AND '98' THEN '15:00' END AS kickoff_time, code AS season_code,
  '20' || code[1:2] || '/' || code[3:4] AS season_label, code = '0102' AS is_current_season FROM lines""")
def loaded_matches(spark, sf):
    """Every season file through the reader of the pipeline: encodings, byte-order mark and absent columns."""
    folder = write_match_files(spark, sf)
    return ranked_seasons(spark, folder).drop(*match_files.FILE_ORDER)


@query("refreshed_seasons", LOADED_SQL + """
SELECT code AS season_code, home AS home_team, ft_result, count(*) AS matches,
  code IN ('9697', '0102') AS rebuilt FROM lines GROUP BY ALL""")
def refreshed_seasons(spark, sf):
    """Half of one season's matches and all of the last season arrive after the first refresh. Arrivals and digests
    say which seasons are read again; the other seasons' partitions keep their files. A third refresh finds nothing."""
    folder, work, at, found = None, new_folder(spark, "work"), F.lit("2001-08-02").cast("timestamp"), []
    for go in ("season <> '0102' AND (season <> '9697' OR month(match_date) <= 6)", "season = '0102' OR (season = '9697' AND month(match_date) > 6)", None):
        if go:
            folder = write_match_files(spark, sf, folder, go)
        files, seasons = changed_files(spark, folder, work, at)
        found.append(seasons)
        if seasons != []:
            raw = match_files.load_matches(spark, folder, Params(current_season="0102"), only=seasons)
            table = versions.stage(raw, work, "matches", ["season_code"]) if seasons is None \
                else versions.stage_parts(raw, work, "matches", "season_code", seasons)
            versions.publish(spark, work, table)
            keep_manifest(files, work)
    if found != [None, ["0102", "9697"], []]:
        raise AssertionError(f"seasons read again: {found}")
    rows = versions.read(spark, work, "matches").groupBy("season_code", "home_team", "ft_result").agg(F.count(F.lit(1)).alias("matches"))
    return rows.withColumn("rebuilt", F.col("season_code").isin(found[1]))


@query("file_digests", """
SELECT y, count(*) AS rows, sha256(string_agg(line || chr(10), '' ORDER BY o_orderkey)) AS sha256, sum(length(line) + 1)::BIGINT AS bytes
FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS y, o_orderkey, o_orderkey || '|' || o_orderpriority || '|' || o_orderstatus AS line
  FROM orders) GROUP BY y""")
def file_digests(spark, sf):
    """Digest, size and lines of a text file a year, each read in pieces; the files have no header."""
    folder = new_folder(spark, "digested")
    orders = b.table(spark, sf, "orders").withColumn("y", F.year("o_orderdate"))
    line = F.concat_ws("|", "o_orderkey", "o_orderpriority", "o_orderstatus")
    (orders.repartition("y").sortWithinPartitions("y", "o_orderkey").select("y", line.alias("value"))
     .write.partitionBy("y").text(folder))
    files = match_files.manifest(spark, folder, F.lit("2001-08-02").cast("timestamp"), pattern="*.txt")
    return files.select(F.regexp_extract("path", "/y=([0-9]+)/", 1).cast("int").alias("y"), (F.col("rows") + 1).alias("rows"),
                        "sha256", "bytes")


@query("file_changes", LOADED_SQL + "SELECT code AS season, code = '0001' AS changed FROM lines GROUP BY 1")
def file_changes(spark, sf):
    """The manifest against one in which the digest of a season's files is another."""
    folder, at = write_match_files(spark, sf), F.lit("2001-08-02").cast("timestamp")
    before = match_files.manifest(spark, folder, at)
    before = before.withColumn("sha256", F.when(F.col("season") == "0001", F.sha2("sha256", 256)).otherwise(F.col("sha256")))
    return match_files.manifest(spark, folder, at, before).groupBy("season").agg(F.bool_or("changed").alias("changed"))


def write_game_documents(spark, sf):
    """Brands by type as players in ``bootstrap.json`` and nation fixtures in ``fixtures.json``; those of every fifth
    month have no gameweek yet. Neither document grows with the tables."""
    folder, clubs = new_folder(spark, "game"), sorted(GAME_NAMES)
    names, brand = F.array(*[F.lit(n) for n in clubs]), F.substring_index("p_brand", "#", -1).cast("int")
    kinds = b.table(spark, sf, "part").groupBy(brand.alias("brand"), b.type_id().alias("type")).agg(
        F.count(F.lit(1)).cast("int").alias("n"), F.max("p_size").alias("size"), F.max("p_retailprice").alias("price"))
    number = F.col("brand") * 100 + F.col("type")
    elements = kinds.agg(F.collect_list(F.struct(
        number.alias("id"), (number + 100000).alias("code"), F.lit("First").alias("first_name"), F.lit("Second").alias("second_name"),
        F.concat(F.lit("P"), number).alias("web_name"), F.pmod("brand", F.lit(len(clubs))).alias("team"), F.col("type").alias("element_type"),
        F.col("size").alias("now_cost"), F.col("price").cast("string").alias("selected_by_percent"), F.lit("a").alias("status"),
        F.col("n").alias("total_points"), F.col("size").alias("minutes"), F.lit("1.5").alias("form"),
        F.lit("x").alias("points_per_game"))).alias("elements"))
    teams = F.transform(names, lambda n, i: F.struct(i.alias("id"), n.alias("name"), F.substring(n, 1, 3).alias("short_name")))
    elements.withColumn("teams", teams).coalesce(1).write.json(f"{folder}/bootstrap.json")
    rows = b.nation_fixtures(spark, sf).filter("is_home").select(
        F.col("fpl_fixture_id").alias("id"), F.when(F.col("gameweek_id") % 5 != 0, F.col("gameweek_id")).alias("event"),
        F.pmod("team_id", F.lit(len(clubs))).alias("team_h"), F.pmod("opponent_team_id", F.lit(len(clubs))).alias("team_a"),
        F.col("difficulty").alias("team_h_difficulty"), F.lit(3).alias("team_a_difficulty"), F.when(F.col("finished"), True).alias("finished"))
    rows.agg(F.to_json(F.collect_list(F.struct("*"))).alias("value")).coalesce(1).write.text(f"{folder}/fixtures.json")
    return folder


CLUBS_SQL = "WITH clubs(id, name) AS (VALUES " + ", ".join(
    "({}, '{}')".format(i, GAME_NAMES[n].replace("'", "''")) for i, n in enumerate(sorted(GAME_NAMES))) + ")\n"


@query("cleaned_players", CLUBS_SQL.rstrip() + f""", kinds AS (
  SELECT CAST(substr(p_brand, 7) AS INTEGER) AS brand, list_position({b.TYPES!r}, p_type)::INTEGER AS type,
    count(*)::INTEGER AS n, max(p_size) AS size, max(p_retailprice) AS price FROM part GROUP BY ALL)
SELECT (brand * 100 + type)::BIGINT AS fpl_element_id, (brand * 100 + type + 100000)::BIGINT AS fpl_player_code,
  'First' AS first_name, 'Second' AS second_name, 'P' || (brand * 100 + type) AS web_name, type AS position_id,
  price AS selected_by_percent, 'a' AS status, n AS total_points, size AS minutes, 1.5::DOUBLE AS form,
  NULL::DOUBLE AS points_per_game, name AS team_name, size / 10.0::DOUBLE AS price_m
FROM kinds JOIN clubs ON id = brand % {len(GAME_NAMES)}""")
def cleaned_players(spark, sf):
    """Players of the nested document: club names, prices in tenths, numbers as text, one of them no number."""
    tables = docs.bootstrap_tables(spark, write_game_documents(spark, sf))
    return cp.players(tables["elements"], cp.clubs(tables["teams"]))


@query("cleaned_fixtures", ctes(b.MATCHES_SQL, b.FIXTURES_SQL, CLUBS_SQL.removeprefix("WITH ")) + f"""
SELECT h.gameweek_id, h.fpl_fixture_id::INTEGER AS fpl_fixture_id, us.name AS team_name, them.name AS opponent_name, side.home AS is_home,
  CASE WHEN side.home THEN h.difficulty ELSE 3 END AS difficulty, h.finished
FROM fixtures h CROSS JOIN (VALUES (TRUE), (FALSE)) side(home)
JOIN clubs us ON us.id = CASE WHEN side.home THEN h.team_id ELSE h.opponent_team_id END % {len(GAME_NAMES)}
JOIN clubs them ON them.id = CASE WHEN side.home THEN h.opponent_team_id ELSE h.team_id END % {len(GAME_NAMES)}
WHERE h.is_home AND h.gameweek_id % 5 <> 0""")
def cleaned_fixtures(spark, sf):
    """Two rows per scheduled fixture of the document; those without a gameweek are left out."""
    folder = write_game_documents(spark, sf)
    clubs = cp.clubs(docs.bootstrap_tables(spark, folder)["teams"])
    return cp.team_fixtures(docs.fixtures(spark, folder), clubs)


@query("pipeline_run", """
SELECT event_type AS run_id, CAST(event_id AS VARCHAR) AS stage, 'ok' AS status,
  round(value, 2) + CASE event_type WHEN 'error' THEN 1 ELSE 0 END AS duration_s, user_id AS rows FROM events""")
def pipeline_run(spark, sf):
    """Stage records landed twice: the second log holds one run only, with other times. It replaces that run and
    leaves the others."""
    work, events = new_folder(spark, "work"), b.table(spark, sf, "events")
    entries = events.select(
        F.col("event_type").alias("run_id"), F.col("event_id").cast("string").alias("stage"), F.lit("ok").alias("status"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("finished_at"), e.round_half_away(F.col("value"), 2).alias("duration_s"),
        F.col("user_id").alias("rows"), F.lit("").alias("message"))
    sinks.record_runs(entries, f"{work}/first")
    land_runs(spark, f"{work}/first", work)
    again = entries.filter("run_id = 'error'").withColumn("duration_s", F.col("duration_s") + 1)
    sinks.record_runs(again, f"{work}/second")
    return land_runs(spark, f"{work}/second", work).drop("finished_at", "message")


@query("committed_snapshot", "SELECT p_partkey, concat_ws(':', p_size, p_retailprice) AS signature FROM part")
def committed_snapshot(spark, sf):
    """The snapshot is stored after the fetch, and is what the next comparison reads."""
    folder, fetched = new_folder(spark, "snapshot"), []
    current = signatures(b.table(spark, sf, "part"), "p_partkey", ["p_size", "p_retailprice"])
    commit_snapshot(current, folder, lambda: fetched.append(sinks.exists(spark, folder)))
    if fetched != [False]:
        raise AssertionError("the snapshot was stored before the fetch")
    stored = spark.read.parquet(folder)
    if needing_refresh(current, stored, "p_partkey").limit(1).count():
        raise AssertionError("an unchanged member is due again")
    return stored
