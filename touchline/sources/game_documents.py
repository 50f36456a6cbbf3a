"""The game's JSON documents, read with explicit schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.operators.joins import small_side
from touchline.session import listing_in_few_tasks

TEAMS = "array<struct<id: int, name: string, short_name: string>>"
ELEMENT_TYPES = ("array<struct<id: int, singular_name: string, singular_name_short: string, "
                 "squad_select: int, squad_min_play: int, squad_max_play: int>>")
EVENTS = ("array<struct<id: int, name: string, deadline_time: string, finished: boolean, "
          "data_checked: boolean, is_current: boolean, is_next: boolean, "
          "average_entry_score: int, highest_score: int>>")
ELEMENTS = ("array<struct<id: bigint, code: bigint, first_name: string, second_name: string, "
            "web_name: string, team: int, element_type: int, now_cost: int, "
            "selected_by_percent: string, status: string, total_points: int, minutes: int, "
            "form: string, points_per_game: string>>")
BOOTSTRAP = f"teams {TEAMS}, element_types {ELEMENT_TYPES}, events {EVENTS}, elements {ELEMENTS}"
FIXTURES = ("id int, event int, team_h int, team_a int, team_h_difficulty int, "
            "team_a_difficulty int, finished boolean, kickoff_time string")
HISTORY = ("array<struct<round: int, fixture: int, opponent_team: int, kickoff_time: string, "
           "was_home: boolean, minutes: int, total_points: int, goals_scored: int, assists: int, "
           "clean_sheets: int, goals_conceded: int, yellow_cards: int, red_cards: int, saves: int, "
           "bonus: int, bps: int, influence: string, creativity: string, threat: string, "
           "ict_index: string, value: int, selected: int, transfers_in: int, transfers_out: int>>")


def read_document(spark: SparkSession, path: str, schema: str, **options) -> DataFrame:
    """Whole-file JSON; a broken document fails the job."""
    return (spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST")
            .options(**options).json(path))


def read_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Documents stored one per line, which lets a file be split between tasks."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def flatten(document: DataFrame, array: str) -> DataFrame:
    """Rows of one array of a document, keeping the other arrays unread."""
    return document.select(F.explode(array).alias("_e")).select("_e.*")


def bootstrap_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    document = read_document(spark, f"{folder}/bootstrap.json", BOOTSTRAP)
    return {name: flatten(document, name) for name in ("teams", "element_types", "events", "elements")}


def fixtures(spark: SparkSession, folder: str) -> DataFrame:
    return read_document(spark, f"{folder}/fixtures.json", FIXTURES)


def member_files(spark: SparkSession, folder: str, prefix: str = "player_", paths: bool = False) -> DataFrame:
    """Ids for which a history file, or a folder of the parts of one, is stored; with ``paths``, where. The listing
    reads no content."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", file_glob(prefix)).option("recursiveFileLookup", "true")
    with listing_in_few_tasks(spark):
        found = reader.load(folder)
    files = found.select(file_id(F.col("path"), prefix).alias("id"), "path").filter("id IS NOT NULL")
    return files if paths else files.select("id").distinct()


def file_glob(prefix: str) -> str:
    return f"{{{prefix}[0-9]*.json,part-*.json}}"


def file_id(path: Column, prefix: str) -> Column:
    """The id in the name of a member's file, NULL for any other file."""
    name = F.regexp_extract(path, rf"[/=]{prefix}([0-9]+)\.json(?:/|$)", 1)
    return F.when(name != "", name.cast("bigint"))


def history_documents(spark: SparkSession, paths: str | list[str], prefix: str = "player_", entry: str = "history",
                      schema: str = HISTORY) -> DataFrame:
    """(id, _place, _e) for the entries of member files, a row with a NULL entry where a file has none."""
    if not paths:
        return spark.createDataFrame([], f"id bigint, _place int, _e {schema.removeprefix('array<').removesuffix('>')}")
    reader = (spark.read.schema(f"{entry} {schema}").option("multiLine", True).option("mode", "FAILFAST")
              .option("pathGlobFilter", file_glob(prefix)).option("recursiveFileLookup", "true"))
    with listing_in_few_tasks(spark):
        document = reader.json(paths)
    # The filter on the path alone is applied to the listing: other files are not opened.
    named = document.filter(F.col("_metadata.file_path").rlike(f"[/=]{prefix}[0-9]+[.]json(/|$)")).select(
        file_id(F.col("_metadata.file_path"), prefix).alias("id"), entry)
    return named.select("id", F.posexplode_outer(entry).alias("_place", "_e"))


def histories(spark: SparkSession, folder: str, members: DataFrame, prefix: str = "player_",
              entry: str = "history", schema: str = HISTORY) -> DataFrame:
    """Entries of every stored history file of a known member, with the member's id and the
    entry's place in its file."""
    rows = history_documents(spark, folder, prefix, entry, schema).filter("_e IS NOT NULL")
    known = small_side(members.select(F.col("id").alias("_id")))
    rows = rows.join(known, F.col("id") == F.col("_id"), "left_semi")
    return rows.select(F.col("id").alias("fpl_element_id"), "_place", "_e.*")


def sweep_manifest(elements: DataFrame, events: DataFrame, fetched_at: Column) -> DataFrame:
    """One row: when, how many players, and the current gameweek (NULL between seasons)."""
    counted = elements.agg(F.count(F.lit(1)).alias("players"))
    current = events.agg(F.min(F.when(F.col("is_current"), F.col("id"))).alias("current_gameweek"))
    return counted.join(F.broadcast(current)).select(fetched_at.alias("fetched_at"), "players", "current_gameweek")
