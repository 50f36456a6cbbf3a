"""Raw inputs to a tested star schema, its reports and exports."""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.operators.checks import ContractFailure, stop_on_failure
from touchline.operators.incremental import high_water_mark, load_summary, replace_by_key
from touchline.operators.joins import small_side
from touchline.operators.rejects import REASON
from touchline.operators.warehouse_tests import Test, run_tests
from touchline.params import Params
from touchline.plans import clean_players as cp
from touchline.plans import dims, facts, reports
from touchline.plans.clean_matches import clean_matches
from touchline.plans.contracts import contract_results, failing_members
from touchline.plans.staging import stage_all
from touchline.sources import game_documents as docs
from touchline.session import exists, materialize, remove_folder
from touchline.sources import match_files, member_store, sinks, versions
from touchline.streaming.arrivals import on_arrival

# The exported tables.
EXPORTED = ["dim_team", "dim_season", "dim_date", "dim_position", "dim_gameweek", "dim_player",
            "fact_match", "fact_player_fixture", "fact_team_fixture", "team_match", "player_season",
            "refresh_log"]


def keyed(model: str, column: str) -> list[Test]:
    return [Test(model, column, "unique"), Test(model, column, "not_null")]


# The declared tests of every model.
STAGING_TESTS = [
    *keyed("stg_matches", "match_id"), *keyed("stg_players", "fpl_element_id"),
    *keyed("stg_positions", "position_id"), *keyed("stg_gameweeks", "gameweek_id"),
    Test("stg_fixtures", "fpl_fixture_id", "not_null"),
    *keyed("stg_player_fixture", "player_fixture_id"),
]
MART_TESTS = [
    *keyed("dim_team", "team_id"), *keyed("dim_team", "team_name"),
    *keyed("dim_date", "date_id"), *keyed("dim_date", "full_date"),
    *keyed("dim_season", "season_id"),
    Test("dim_season", "status", "accepted_values", ("completed", "in_progress")),
    *keyed("dim_player", "player_id"), *keyed("dim_player", "fpl_element_id"),
    *keyed("fact_match", "match_id"),
    Test("fact_match", "ft_result", "accepted_values", ("H", "D", "A")),
    Test("fact_match", "home_team_id", "not_null"),
    Test("fact_match", "home_team_id", "relationships", ("dim_team", "team_id")),
    Test("fact_match", "away_team_id", "not_null"),
    Test("fact_match", "away_team_id", "relationships", ("dim_team", "team_id")),
    Test("fact_match", "season_id, date_id, home_team_id, away_team_id", "unique_combination",
         ("season_id", "date_id", "home_team_id", "away_team_id")),
    *keyed("fact_player_fixture", "player_fixture_id"),
    Test("fact_player_fixture", "player_id", "not_null"),
    Test("fact_player_fixture", "player_id", "relationships", ("dim_player", "player_id")),
    Test("fact_player_fixture", "gameweek_id", "not_null"),
    Test("fact_player_fixture", "gameweek_id", "relationships", ("dim_gameweek", "gameweek_id")),
    Test("fact_player_fixture", "minutes", "not_null"),
    Test("fact_player_fixture", "minutes", "accepted_range", (0, 120)),
    Test("fact_player_fixture", "price_m", "not_null"),
    Test("fact_player_fixture", "price_m", "accepted_range", (3.0, 20.0)),
    Test("fact_player_fixture", "bonus", "not_null"),
    Test("fact_player_fixture", "bonus", "accepted_range", (0, 3)),
    *keyed("fact_team_fixture", "team_fixture_id"),
    Test("fact_team_fixture", "difficulty", "accepted_range", (1, 5)),
]
SINGULAR_TESTS = [
    Test("dim_date", "full_date", "no_gaps"),
    Test("fact_player_fixture", "gameweek_id", "contiguous"),
]
ALL_TESTS = STAGING_TESTS + MART_TESTS + SINGULAR_TESTS


class WarehouseTestFailure(Exception):
    """At least one warehouse test returned rows."""


@dataclass
class Build:
    raw: dict[str, DataFrame]
    staging: dict[str, DataFrame]
    marts: dict[str, DataFrame]
    rejects: dict[str, int] = field(default_factory=dict)
    landed: dict[str, int] = field(default_factory=dict)
    staged: list[versions.Table] = field(default_factory=list)  # written, not shown yet

    @property
    def models(self) -> dict[str, DataFrame]:
        return {**self.staging, **self.marts}


# What makes a player's signature.
PLAYER_SIGNATURE = ["total_points", "minutes"]


def clean(spark: SparkSession, match_folder: str, game_folder: str, interim: str, params: Params = Params(),
          store: str | None = None, seasons: list[str] | None = None) -> dict[str, int]:
    """Clean both sources into typed tables in ``interim``; returns rows per table.

    With a ``store``, only files of players whose signature moved are read, and rejects are kept by season. With
    ``seasons``, only their match files are read, and ``matches_clean`` holds those seasons alone, numbered from 1.
    """
    boot = docs.bootstrap_tables(spark, game_folder)
    club_names = cp.clubs(boot["teams"])
    tables = {}
    if seasons != []:
        raw = match_files.load_matches(spark, match_folder, params, only=seasons)
        matches = clean_matches(raw, match_files.FILE_ORDER, params=params)
        rejects, tables["matches_clean"] = matches.rejects, matches.kept
        if store:
            kept = versions.stage(rejects, store, "rejects", ["season_code"]) if seasons is None \
                else versions.stage_parts(rejects, store, "rejects", "season_code", seasons)
            versions.publish(spark, store, kept)
            versions.vacuum(spark, store, ["rejects"])
            rejects = versions.open_table(spark, store, kept)
        sinks.write_rejects(rejects, f"{interim}/rejects")
    entries = member_store.refresh_histories(spark, game_folder, store, boot["elements"], PLAYER_SIGNATURE) if store \
        else docs.histories(spark, game_folder, boot["elements"])
    return sinks.land_all({
        **tables,
        "players": cp.players(boot["elements"], club_names),
        "positions": cp.positions(boot["element_types"]),
        "gameweeks": cp.gameweeks(boot["events"]),
        "team_fixtures": cp.team_fixtures(docs.fixtures(spark, game_folder), club_names),
        "history": cp.history(entries, club_names),
    }, interim)


RAW_TABLES = {
    "raw_matches": "matches_clean", "raw_players": "players", "raw_positions": "positions",
    "raw_gameweeks": "gameweeks", "raw_fixtures": "team_fixtures", "raw_player_fixture": "history",
}


@contextmanager
def stage(spark: SparkSession, runs: str, run_id: str, name: str) -> Iterator[dict]:
    """Record how a stage went, also when it fails; the caller may put its ``rows`` into the yielded dict."""
    started, told = time.monotonic(), {}

    def record(status: str, message: str) -> None:
        now = dt.datetime.now(dt.timezone.utc).isoformat(timespec="seconds")
        row = (run_id, name, status, now, time.monotonic() - started, told.get("rows"), message)
        sinks.record_runs(spark.createDataFrame([row], sinks.RUN_LOG), runs)

    try:
        yield told
    except Exception as error:
        record("failed", str(error))
        raise
    record("ok", "")


def land_runs(spark: SparkSession, runs: str, warehouse: str) -> DataFrame:
    """``pipeline_run``: every recorded stage. The runs in the log replace what is stored of them; stored runs that
    the log no longer holds stay."""
    entries, stored = sinks.read_runs(spark, runs), versions.published(spark, warehouse).get("pipeline_run")
    if stored:
        entries = replace_by_key(versions.open_table(spark, warehouse, stored), entries, "run_id")
    versions.replace(entries, warehouse, "pipeline_run")
    return versions.read(spark, warehouse, "pipeline_run")


class SeasonsOverlap(Exception):
    """Seasons share days, so that the matches of one cannot be numbered without those of another."""


def spans(matches: DataFrame) -> list[dict]:
    """Rows, days and first number of every season; a row a season comes to the driver."""
    rows = matches.groupBy("season_code").agg(
        F.count(F.lit(1)).alias("rows"), F.min("match_date").alias("first"), F.max("match_date").alias("last"),
        F.min("match_id").alias("number"))
    return [r.asDict() for r in rows.collect()]


def renumbered(stored: DataFrame, changed: DataFrame, seasons: list[str]) -> tuple[DataFrame, list[str]]:
    """The rows of every season that has to be written anew, and those seasons: the changed ones, and stored
    ones whose matches get other numbers because an earlier season has more or fewer now.

    Matches are numbered by day first. As long as no two seasons share a day, a season's numbers are its own order
    plus the rows of the seasons before it.
    """
    others = stored.filter(~F.col("season_code").isin(seasons))
    old, new = spans(others), spans(changed)
    order = sorted(old + new, key=lambda s: s["first"])
    if any(a["last"] >= b["first"] for a, b in zip(order, order[1:])):
        raise SeasonsOverlap
    shifts, before = {}, 0
    for s in order:
        # A changed season's own numbers begin with the smallest of its rows; a stored one's as well.
        shifts[s["season_code"]] = before + 1 - s["number"]
        before += s["rows"]
    moved = sorted(s["season_code"] for s in old if shifts[s["season_code"]])
    written = sorted({*seasons, *moved})
    rows = changed.unionByName(others.filter(F.col("season_code").isin(moved)).select(changed.columns))
    if not shifts:
        return rows, written
    shift = F.create_map(*[F.lit(x) for pair in shifts.items() for x in pair])
    return rows.withColumn("match_id", F.col("match_id") + shift[F.col("season_code")]), written


def load(spark: SparkSession, interim: str, warehouse: str, refreshed_at, runs: str | None = None,
         matches: DataFrame | None = None, seasons: list[str] | None = None) -> dict[str, DataFrame]:
    """Land the raw tables one to one and show them together, append a row to the refresh log and bring
    ``pipeline_run`` up to the run log. With ``seasons``, ``matches`` holds their rows, and the other seasons of
    ``raw_matches`` keep their files."""
    tables = {}
    for name, source in RAW_TABLES.items():
        if name == "raw_matches" and seasons == []:
            tables[name] = versions.published(spark, warehouse)[name]
        elif name == "raw_matches" and seasons is not None:
            tables[name] = versions.stage_parts(matches, warehouse, name, "season_code", seasons)
        else:
            split = ["season_code"] if name == "raw_matches" else None
            tables[name] = versions.stage(spark.read.parquet(f"{interim}/{source}"), warehouse, name, split)
    versions.publish(spark, warehouse, *tables.values())
    versions.vacuum(spark, warehouse, list(tables))
    raw = {name: versions.open_table(spark, warehouse, table) for name, table in tables.items()}
    row = load_summary(raw["raw_matches"], F.col("is_current_season"), "match_date",
                       raw["raw_player_fixture"], "gameweek_id", sinks.stamped(refreshed_at))
    sinks.append_log(row, f"{warehouse}/refresh_log")
    if runs:
        land_runs(spark, runs, warehouse)
    return raw


def same_keys(spark: SparkSession, warehouse: str, tables: dict[str, versions.Table], name: str, now: DataFrame, *columns: str) -> bool:
    """Whether every member a dimension had before still has its key."""
    if name not in tables:
        return False
    before = versions.open_table(spark, warehouse, tables[name]).select(*columns)
    return not before.join(now.select(*columns), list(columns), "left_anti").limit(1).count()


def build_marts(spark: SparkSession, raw: dict[str, DataFrame], warehouse: str,
                params: Params = Params(), seasons: list[str] | None = None) -> Build:
    """Build and write every mart; each is read back, so later models see its real size. Nothing is shown to
    readers before the caller publishes ``staged``.

    With ``seasons``, only their partitions of the match facts are built, if every club, season and referee
    still has the key it had; else all are.
    """
    stg = stage_all(raw)
    matches, fixtures, players = stg["stg_matches"], stg["stg_fixtures"], stg["stg_players"]
    build, before = Build(raw, stg, {}), versions.published(spark, warehouse)

    def write(table: versions.Table) -> DataFrame:
        build.staged.append(table)
        build.marts[table.name] = versions.open_table(spark, warehouse, table)
        build.landed[table.name] = table.rows
        return build.marts[table.name]

    def land(name: str, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        return write(versions.stage(df, warehouse, name, partition_by))

    teams = land("dim_team", dims.dim_team(
        matches.select("home_team"), matches.select("away_team"), players.select("team_name"),
        fixtures.select("team_name"), fixtures.select("opponent_name")))
    seasons_dim = land("dim_season", dims.dim_season(matches, params))
    dates = land("dim_date", dims.dim_date(matches, stg["stg_gameweeks"], params))
    land("dim_gameweek", dims.dim_gameweek(stg["stg_gameweeks"]))
    positions = land("dim_position", dims.dim_position(stg["stg_positions"]))
    referees = land("dim_referee", dims.dim_referee(matches))
    stable = seasons is not None and "fact_match" in before and "team_match" in before and all([
        same_keys(spark, warehouse, before, "dim_team", teams, "team_id", "team_name"),
        same_keys(spark, warehouse, before, "dim_season", seasons_dim, "season_id", "season_code"),
        same_keys(spark, warehouse, before, "dim_referee", referees, "referee_id", "referee_name")])
    changed = [r["season_id"] for r in seasons_dim.filter(F.col("season_code").isin(seasons)).select("season_id").collect()] if stable else None
    teams, seasons_dim, dates, referees = map(small_side, (teams, seasons_dim, dates, referees))
    player = land("dim_player", dims.dim_player(players, teams))

    if stable and not changed:
        match = write(before["fact_match"])
        write(before["team_match"])
    elif stable:
        own = facts.fact_match(matches.filter(F.col("season_code").isin(seasons)), seasons_dim, dates, teams, referees)
        part = versions.stage_parts(own, warehouse, "fact_match", "season_id", changed)
        match = write(part)
        sides = reports.team_match(match.filter(F.col("season_id").isin(changed)))
        write(versions.stage_parts(sides, warehouse, "team_match", "season_id", changed))
    else:
        match = land("fact_match", facts.fact_match(matches, seasons_dim, dates, teams, referees), ["season_id"])
        land("team_match", reports.team_match(match), ["season_id"])
    played = land("fact_player_fixture", facts.fact_player_fixture(
        stg["stg_player_fixture"], small_side(player), teams, dates))
    land("fact_team_fixture", facts.fact_team_fixture(fixtures, teams))
    land("player_season", reports.player_season(player, teams, positions, played))
    land("player_value", reports.player_value(player, teams, positions, played, params))
    return build


def show(spark: SparkSession, build: Build, warehouse: str) -> None:
    """Publish all marts of a build in one step."""
    versions.publish(spark, warehouse, *build.staged)
    versions.vacuum(spark, warehouse, [t.name for t in build.staged])


def verify_build(build: Build, tests: list[Test] = ALL_TESTS) -> DataFrame:
    """Run the declared tests; raise when one returns rows."""
    results = run_tests(tests, build.models)
    failed = results.filter("failures > 0").collect()
    if failed:
        raise WarehouseTestFailure("; ".join(
            f"{r['model']}.{r['column_name']} {r['test']}: {r['failures']}" for r in failed))
    return results


def reject_report(spark: SparkSession, interim: str) -> DataFrame:
    rejects = sinks.read_export(spark, f"{interim}/rejects")
    return rejects.groupBy(REASON).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), REASON)


def seasons_to_read(stored: DataFrame | None, seasons: list[str] | None, params: Params) -> list[str] | None:
    """The seasons whose files a refresh reads: those that changed and are configured, and those stored as live that
    are not, or the other way round. None, which is all, where nothing is stored or a configured season is not."""
    if stored is None or seasons is None:
        return None
    live = F.bool_or(F.col("is_current_season") != (F.col("season_code") == params.current_season))
    flags = {r["season_code"]: r["wrong"] for r in stored.groupBy("season_code").agg(live.alias("wrong")).collect()}
    wanted = {*seasons, *(code for code, wrong in flags.items() if wrong)}
    if params.seasons is None:
        return sorted(wanted)
    if set(params.seasons) - {*flags, *seasons} or set(flags) - set(params.seasons):
        return None
    return sorted(wanted & set(params.seasons))


def refresh(spark: SparkSession, match_folder: str, game_folder: str, work: str, refreshed_at,
            params: Params = Params(), seasons: list[str] | None = None) -> Build:
    """The whole pipeline: clean, check, load, model, test, export. Stops at the first stage
    that fails, before anything downstream is replaced; marts are shown together once their tests pass. Every stage is
    recorded in ``runs``; a load's own record reaches ``pipeline_run`` with the next load, as it is written when the stage
    ends.

    ``seasons`` says whose match files changed; then only those are read, and only their partitions of the matches and
    match facts are written anew, with those of later seasons whose numbers move. Without it, or before anything is
    stored, all are. Player histories are always brought up from the files of changed players alone.
    """
    interim, warehouse, runs, run_id = f"{work}/interim", f"{work}/warehouse", f"{work}/runs", uuid.uuid4().hex
    stored = versions.published(spark, warehouse).get("raw_matches")
    kept = versions.open_table(spark, warehouse, stored) if stored else None
    seasons = seasons_to_read(kept, seasons, params)
    with stage(spark, runs, run_id, "clean") as told:
        told["rows"] = sum(clean(spark, match_folder, game_folder, interim, params, f"{work}/store", seasons).values())
        matches, rows, written = kept, None, seasons
        if seasons != []:
            matches = spark.read.parquet(f"{interim}/matches_clean")
        if seasons:
            try:
                rows, written = renumbered(kept, matches, seasons)
                matches = kept.filter(~F.col("season_code").isin(written)).unionByName(rows)
            except SeasonsOverlap:
                written = None
                told["rows"] = sum(clean(spark, match_folder, game_folder, interim, params, f"{work}/store").values())
                matches = spark.read.parquet(f"{interim}/matches_clean")
    tables = [spark.read.parquet(f"{interim}/{n}") for n in ("players", "positions", "history")]
    with stage(spark, runs, run_id, "contracts"):
        try:
            stop_on_failure(contract_results(matches, *tables, as_of=refreshed_at, params=params))
        except ContractFailure:
            versions.replace(failing_members(matches, *tables[:2], params), f"{work}/store", "quarantine")
            raise
    with stage(spark, runs, run_id, "load"):
        raw = load(spark, interim, warehouse, refreshed_at, runs, rows, written)
    with stage(spark, runs, run_id, "model") as told:
        build = build_marts(spark, raw, warehouse, params, written)
        told["rows"] = sum(build.landed.values())
    with stage(spark, runs, run_id, "test"):
        verify_build(build)
        show(spark, build, warehouse)
    with stage(spark, runs, run_id, "export"):
        log = spark.read.parquet(f"{warehouse}/refresh_log")
        sinks.export_csv({n: log if n == "refresh_log" else build.marts[n] for n in EXPORTED}, f"{work}/export")
    return build


MARK = "last_finished_gw bigint"


def stored_mark(spark: SparkSession, work: str) -> int | None:
    """The newest finished gameweek that was processed, None before the first."""
    folder = f"{work}/state/mark"
    return spark.read.schema(MARK).json(folder).agg(F.max("last_finished_gw")).first()[0] if exists(spark, folder) else None


PENDING = "path string"


def note_arrivals(spark: SparkSession, match_folder: str, work: str) -> DataFrame | None:
    """Paths of match files that arrived and are not processed yet. The stream's checkpoint names each path
    once; what it names is noted before it moves on, and stays noted until a refresh has succeeded."""
    noted = f"{work}/state/pending"

    def note(batch: DataFrame, number: int) -> None:
        batch.select("path").write.mode("append").json(noted)

    on_arrival(spark, match_folder, f"{work}/state/arrivals", note, nested=True)
    return spark.read.schema(PENDING).json(noted).distinct() if exists(spark, noted) else None


def changed_files(spark: SparkSession, match_folder: str, work: str, at: Column) -> tuple[DataFrame, list[str] | None]:
    """The manifest as it is now, and the seasons whose files differ from the last refresh. A digest tells, and is
    taken only of files that arrived or whose size or time is another one. None stands for all seasons, before the first
    refresh and where a file was taken away."""
    arrived, before = note_arrivals(spark, match_folder, work), versions.published(spark, f"{work}/state").get("manifest")
    if before is None:
        return materialize(match_files.manifest(spark, match_folder, at)), None
    known = versions.open_table(spark, f"{work}/state", before)
    listed = match_files.file_names(spark, match_folder).select("path", F.col("length").alias("bytes"), "modified")
    if known.join(listed, "path", "left_anti").limit(1).count():
        return materialize(match_files.manifest(spark, match_folder, at, known)), None
    other = listed.join(known, ["path", "bytes", "modified"], "left_anti").select("path")
    due = [r["path"] for r in (other if arrived is None else other.unionByName(arrived)).distinct().collect()]
    if not due:
        return known.withColumn("changed", F.lit(False)), []
    now = materialize(match_files.manifest(spark, sorted(due), at, known))
    seasons = sorted(r["season"] for r in now.filter("changed").select("season").distinct().collect())
    rest = known.join(now.select("path"), "path", "left_anti").withColumn("changed", F.lit(False))
    return rest.unionByName(now.select(rest.columns)), seasons


def keep_manifest(files: DataFrame, work: str) -> None:
    """Record what was processed; what had arrived needs no note any more."""
    versions.replace(files.drop("changed"), f"{work}/state", "manifest")
    remove_folder(files.sparkSession, f"{work}/state/pending")


def refresh_if_due(spark: SparkSession, match_folder: str, game_folder: str, work: str, refreshed_at,
                   params: Params = Params()) -> Build | None:
    """Refresh if a gameweek was finished and finalised since the last time, or a match file arrived with other
    content; else do nothing. Only the seasons of such files are rebuilt. What was processed is recorded last, so a
    refresh that fails is due again."""
    events = docs.bootstrap_tables(spark, game_folder)["events"]
    done = F.col("finished") & F.col("data_checked")
    mark = high_water_mark(events, "id", done, F.lit(stored_mark(spark, work))).first()
    files, seasons = changed_files(spark, match_folder, work, refreshed_at)
    if not mark["should_refresh"] and seasons == []:
        if exists(spark, f"{work}/state/pending"):
            keep_manifest(files, work)
        return None
    build = refresh(spark, match_folder, game_folder, work, refreshed_at, params, seasons)
    keep_manifest(files, work)
    state = spark.createDataFrame([(mark["latest"],)], MARK)
    state.write.mode("overwrite").option("ignoreNullFields", False).json(f"{work}/state/mark")
    return build


def open_views(spark: SparkSession, warehouse: str, names: list[str]) -> None:
    """Make landed tables available to SQL under their names."""
    tables = versions.published(spark, warehouse)
    for name in names:
        df = versions.open_table(spark, warehouse, tables[name]) if name in tables else spark.read.parquet(f"{warehouse}/{name}")
        df.createOrReplaceTempView(name)


def ask(spark: SparkSession, sql: str, **parameters) -> DataFrame:
    """A SQL question with bound parameters (``:name``) over the opened views."""
    return spark.sql(sql, args=parameters)
