"""Tables replaced in one step, stored histories, and refreshes that rebuild only what changed."""

import glob
import hashlib
import json
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.football import World
from touchline.params import Params
from touchline.plans import warehouse
from touchline.sources import game_documents as docs
from touchline.sources import match_files, member_store, versions

def at():
    return F.lit("2028-10-01").cast("timestamp")


def files(folder, under=""):
    return sorted(os.path.relpath(p, folder) for p in glob.glob(f"{folder}/{under}/**/*.parquet", recursive=True))


def rows(df):
    return sorted(map(str, df.collect()))


def test_a_landing_that_dies_leaves_the_old_rows(spark, tmp_path):
    folder = str(tmp_path)
    old = spark.range(100).withColumn("k", F.col("id") % 3)
    assert versions.replace(old, folder, "t", ["k"]) == 100
    dies = spark.range(0, 1_000, 1, 8).select("id", (F.col("id") % 3).alias("k"), F.when(
        F.col("id") == 900, F.raise_error(F.lit("killed"))).alias("_")).drop("_").filter(
        F.when(F.col("id") == 900, F.raise_error(F.lit("killed")).cast("boolean")).otherwise(True))
    with pytest.raises(Exception, match="killed"):
        versions.replace(dies, folder, "t", ["k"])
    assert rows(versions.read(spark, folder, "t")) == rows(old)
    # One that is written whole and whose pointer is not changes nothing either.
    versions.stage(spark.range(5), folder, "t")
    assert rows(versions.read(spark, folder, "t")) == rows(old)
    versions.replace(spark.range(7).withColumn("k", F.lit(1)), folder, "t", ["k"])
    left = os.listdir(f"{folder}/t")
    assert versions.read(spark, folder, "t").count() == 7 and len(left) == 2  # this version and the one before


def test_readers_keep_what_they_resolved(spark, tmp_path):
    folder = str(tmp_path)
    versions.replace(spark.range(3), folder, "t")
    before = versions.read(spark, folder, "t")
    versions.replace(spark.range(4), folder, "t")
    assert (before.count(), versions.read(spark, folder, "t").count()) == (3, 4)
    with pytest.raises(FileNotFoundError):
        versions.read(spark, folder, "u")
    assert versions.published(spark, str(tmp_path / "none")) == {}


def test_parts_are_replaced_alone(spark, tmp_path):
    folder, schema = str(tmp_path), "k string, version int, _v int"
    versions.replace(spark.createDataFrame([("01", 1, 0), ("02", 2, 0), (None, 3, 0)], schema), folder, "t", ["k"])
    first = versions.published(spark, folder)["t"].parts
    assert sorted(first) == ["k=01", "k=02", f"k={versions.NO_VALUE}"]
    part = versions.stage_parts(spark.createDataFrame([("02", 9, 1), ("03", 4, 1)], schema), folder, "t", "k", ["02", "03"])
    versions.publish(spark, folder, part)
    now = versions.published(spark, folder)["t"].parts
    assert now["k=01"] == first["k=01"] and now["k=02"] != first["k=02"]
    assert rows(versions.read(spark, folder, "t")) == rows(spark.createDataFrame([("01", 1, 0), ("02", 9, 1), ("03", 4, 1), (None, 3, 0)], schema))
    with pytest.raises(ValueError, match="k=07"):
        versions.stage_parts(spark.createDataFrame([("07", 1, 1)], schema), folder, "t", "k", ["02"])
    with pytest.raises(ValueError, match="plain"):
        versions.part_name("k", "a/b")
    versions.publish(spark, folder, versions.stage_parts(part_of_none(spark, schema), folder, "t", "k", ["01", "02", "03", None]))
    empty = versions.read(spark, folder, "t")
    assert empty.count() == 0 and empty.dtypes == [("k", "string"), ("version", "int"), ("_v", "int")]


def part_of_none(spark, schema):
    return spark.createDataFrame([], schema)


def test_several_tables_change_together(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    versions.publish(spark, folder, versions.stage(spark.range(1), folder, "a"), versions.stage(spark.range(1), folder, "b"))
    with pytest.raises(RuntimeError):
        one = versions.stage(spark.range(2), folder, "a")
        raise RuntimeError(f"died after {one.rows} rows, before b")
    assert versions.read(spark, folder, "a").count() == versions.read(spark, folder, "b").count() == 1
    versions.publish(spark, folder, versions.stage(spark.range(2), folder, "a"), versions.stage(spark.range(2), folder, "b"))
    assert versions.read(spark, folder, "a").count() == versions.read(spark, folder, "b").count() == 2


COLUMNS = ["total_points", "minutes"]


@pytest.fixture
def league(tmp_path):
    folder = tmp_path / "league"
    folder.mkdir()
    return World(folder)


def sweep(spark, league, store):
    members = docs.bootstrap_tables(spark, str(league.game_dir))["elements"]
    return member_store.refresh_histories(spark, str(league.game_dir), store, members, COLUMNS)


def moved(league, players):
    """The players play on: their signature moves and their file gains an entry."""
    for p in players:
        league.elements[p - 1]["total_points"] += 5
        league.history[p] = [*(league.history[p] or []), league.history[2][0] | {"fixture": 9_000 + p, "element": p}]
        (league.game_dir / f"player_{p}.json").write_text(json.dumps({"history": league.history[p]}))
    (league.game_dir / "bootstrap.json").write_text(json.dumps(league.bootstrap))


def test_a_sweep_rewrites_only_buckets_of_changed_members(spark, league, tmp_path):
    store, game = str(tmp_path / "store"), str(league.game_dir)
    members = docs.bootstrap_tables(spark, game)["elements"]
    assert rows(sweep(spark, league, store)) == rows(docs.histories(spark, game, members))
    before = versions.published(spark, store)["member_histories"].parts
    kept = files(store, "member_histories")
    assert rows(sweep(spark, league, store)) == rows(docs.histories(spark, game, members))
    assert versions.published(spark, store)["member_histories"].parts == before  # nothing moved, nothing is written
    moved(league, [7, 150])
    # A file that changes without its signature is not read.
    (league.game_dir / "player_9.json").write_text(json.dumps({"history": []}))
    got = sweep(spark, league, store)
    assert got.count() == len(league.facts()) and got.filter("fixture = 9007 AND fpl_element_id = 7").count() == 1
    after = versions.published(spark, store)["member_histories"].parts
    ids = spark.createDataFrame([(7,), (150,)], "id bigint").select(member_store.bucket_of(F.col("id")).alias("b"))
    assert {p for p in after if after[p] != before[p]} == {f"bucket={r.b}" for r in ids.collect()}
    assert set(kept) <= set(files(store, "member_histories"))


def test_a_sweep_that_dies_marks_nobody(spark, league, tmp_path):
    store = str(tmp_path / "store")
    sweep(spark, league, store)
    moved(league, [7, 8])
    good = (league.game_dir / "player_8.json").read_text()
    (league.game_dir / "player_8.json").write_text("{broken")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        sweep(spark, league, store)
    members = docs.bootstrap_tables(spark, str(league.game_dir))["elements"]
    due = member_store.due_members(spark, store, members, COLUMNS)[0]
    assert sorted(r.id for r in due.collect()) == [1, 7, 8]  # player 1 has no file
    (league.game_dir / "player_8.json").write_text(good)
    assert sweep(spark, league, store).count() == len(league.facts())
    assert [r.id for r in member_store.due_members(spark, store, members, COLUMNS)[0].collect()] == [1]
    # A due member whose file is gone keeps the entries it has, and stays due.
    league.elements[6]["total_points"] += 1
    (league.game_dir / "bootstrap.json").write_text(json.dumps(league.bootstrap))
    os.remove(league.game_dir / "player_7.json")
    assert sweep(spark, league, store).filter("fpl_element_id = 7").count() == len(league.history[7])
    members = docs.bootstrap_tables(spark, str(league.game_dir))["elements"]
    assert sorted(r.id for r in member_store.due_members(spark, store, members, COLUMNS)[0].collect()) == [1, 7]


def test_many_due_files_are_read_without_a_list(spark, league, tmp_path, monkeypatch):
    monkeypatch.setattr(member_store, "LISTED_FILES", 3)
    store = str(tmp_path / "store")
    assert sweep(spark, league, store).count() == len(league.facts())
    moved(league, [7, 8, 9, 10])
    assert sweep(spark, league, store).count() == len(league.facts())


FACTS = ["raw_matches", "fact_match", "team_match"]


def same_as_from_scratch(spark, league, build, tmp_path, params=Params()):
    fresh = warehouse.refresh(spark, str(league.matches_dir), str(league.game_dir), str(tmp_path), at(), params)
    for name, df in fresh.marts.items():
        assert rows(build.marts[name]) == rows(df), name
    assert rows(build.raw["raw_matches"]) == rows(fresh.raw["raw_matches"].select(build.raw["raw_matches"].columns))


def test_a_refresh_rewrites_only_the_seasons_that_changed(spark, league, tmp_path):
    folders, work = (str(league.matches_dir), str(league.game_dir)), str(tmp_path / "work")
    store = f"{work}/warehouse"
    assert warehouse.refresh_if_due(spark, *folders, work, at()) is not None
    first = {n: versions.published(spark, store)[n].parts for n in FACTS}
    assert sorted(first["fact_match"]) == ["season_id=1", "season_id=2"]
    assert warehouse.refresh_if_due(spark, *folders, work, at()) is None

    # One new season file: one new partition of each fact, the others keep their files.
    league._season("2728", date(2027, 8, 14), 38)
    build = warehouse.refresh_if_due(spark, *folders, work, at())
    second = {n: versions.published(spark, store)[n].parts for n in FACTS}
    for n in FACTS:
        assert len(second[n]) == 3 and set(second[n].items()) >= set(first[n].items())
    assert build.marts["fact_match"].count() == 2 * 380 + 60

    # The live season's file comes again with one match more: its partition and those numbered after it are written.
    path = league.matches_dir / "E0_2627.csv"
    text = path.read_text(encoding="utf-8-sig").splitlines()
    h, a = (c for c in text[1].split(",")[1:3])
    swapped = text[1].replace(f",{h},{a},", f",{a},{h},", 1).replace("15/08/2026", "25/09/2026")
    path.write_bytes("\n".join([*text, swapped]).encode("utf-8-sig"))
    os.utime(path, (path.stat().st_mtime + 5,) * 2)
    build = warehouse.refresh_if_due(spark, *folders, work, at())
    third = {n: versions.published(spark, store)[n].parts for n in FACTS}
    for n, kept in (("raw_matches", "season_code=2526"), ("fact_match", "season_id=1"), ("team_match", "season_id=1")):
        assert {p for p in third[n] if third[n][p] == second[n][p]} == {kept}
    same_as_from_scratch(spark, league, build, tmp_path / "scratch2")

    # Touched without other content: nothing to do. A file that goes takes its season with it.
    os.utime(path, (path.stat().st_mtime + 9,) * 2)
    assert warehouse.refresh_if_due(spark, *folders, work, at()) is None
    os.remove(league.matches_dir / "E0_2728.csv")
    build = warehouse.refresh_if_due(spark, *folders, work, at())
    assert build.marts["dim_season"].count() == 2 and build.marts["fact_match"].count() == 380 + 61


def test_a_failing_model_shows_nothing(spark, league, tmp_path, monkeypatch):
    folders, work = (str(league.matches_dir), str(league.game_dir)), str(tmp_path / "work")
    warehouse.refresh_if_due(spark, *folders, work, at())
    before = versions.published(spark, f"{work}/warehouse")
    league._season("2728", date(2027, 8, 14), 38)

    def fails(build):
        raise warehouse.WarehouseTestFailure("fact_match.match_id unique: 1")

    with monkeypatch.context() as m:
        m.setattr(warehouse, "verify_build", fails)
        with pytest.raises(warehouse.WarehouseTestFailure):
            warehouse.refresh_if_due(spark, *folders, work, at())
    after = versions.published(spark, f"{work}/warehouse")
    assert {n: after[n].parts for n in ("dim_season", "fact_match", "team_match")} == {
        n: before[n].parts for n in ("dim_season", "fact_match", "team_match")}
    # What arrived is still noted, so the next run makes up for it.
    assert warehouse.changed_files(spark, folders[0], work, at())[1] == ["2728"]


def test_numbers_of_seasons(spark):
    schema = "season_code string, match_date date, home_team string, match_id bigint"
    make = lambda code, year, first, n: [(code, date(year, 1, 1 + i), "x", first + i) for i in range(n)]
    stored = spark.createDataFrame([*make("a", 2001, 1, 3), *make("b", 2002, 4, 3), *make("d", 2004, 7, 2)], schema)
    changed = spark.createDataFrame([*make("b", 2002, 1, 5), *make("c", 2003, 6, 1)], schema)
    new, written = warehouse.renumbered(stored, changed, ["b", "c"])
    assert written == ["b", "c", "d"]
    got = sorted((r.season_code, r.match_id) for r in new.collect())
    assert got == [*(("b", i) for i in range(4, 9)), ("c", 9), ("d", 10), ("d", 11)]
    same, written = warehouse.renumbered(stored, spark.createDataFrame(make("b", 2002, 1, 3), schema), ["b"])
    assert written == ["b"] and sorted(r.match_id for r in same.collect()) == [4, 5, 6]
    with pytest.raises(warehouse.SeasonsOverlap):
        warehouse.renumbered(stored, spark.createDataFrame(make("e", 2001, 1, 2), schema), ["e"])
    none, written = warehouse.renumbered(stored, changed.limit(0), ["b"])
    assert written == ["b", "d"] and [r.match_id for r in none.orderBy("match_id").collect()] == [4, 5]


def test_seasons_to_read(spark):
    stored = spark.createDataFrame([("2526", False), ("2627", True)], "season_code string, is_current_season boolean")
    read = warehouse.seasons_to_read
    assert read(None, ["2526"], Params()) is None and read(stored, None, Params()) is None
    assert read(stored, ["2728"], Params()) == ["2728"] and read(stored, [], Params()) == []
    assert read(stored, ["2728"], Params(current_season="2728")) == ["2627", "2728"]  # the live one changed
    assert read(stored, ["2425"], Params(seasons=("2526", "2627"))) == []
    assert read(stored, [], Params(seasons=("2526", "2627", "9999"))) is None


CONTENTS = {
    "mark.csv": b"\xef\xbb\xbf", "feed.csv": b"\n", "feeds.csv": b"\n\n\n", "plain.csv": b"a,b\n1,2\n3,4\n",
    "open.csv": b"a,b\n1,2\n3,4", "marked.csv": b"\xef\xbb\xbfa,b\n1,2\n", "marked_open.csv": b"\xef\xbb\xbfa",
    "crlf.csv": b"a,b\r\n1,2\r\n\r\n", "latin.csv": "Müller,1\n".encode("latin-1") * 40, "utf.csv": "Müller,1\n".encode() * 40,
    "long.csv": b"".join(b"%d,%d\n" % (i, i * i) for i in range(5_000)), "late.csv": b"a\n" * 500 + b"\xff\n" + b"a\n" * 500,
}


@pytest.mark.parametrize("piece", ["64", "128m"])
def test_files_are_read_in_pieces(spark, tmp_path, piece):
    """Digest, line count and encoding from the lines that any number of tasks read. A listing leaves empty files out."""
    (tmp_path / "empty.csv").write_bytes(b"")
    for name, content in CONTENTS.items():
        (tmp_path / name).write_bytes(content)
    conf = {"spark.sql.files.maxPartitionBytes": piece, "spark.sql.files.openCostInBytes": "1" if piece == "64" else "4m"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        if piece == "64":
            # Spark's own minimum number of tasks bounds how small pieces get.
            assert match_files.file_lines(spark, str(tmp_path), "long.csv").rdd.getNumPartitions() > 500
        found = {r.file: r for r in match_files.manifest(spark, str(tmp_path), at()).collect()}
        kinds = {p.rsplit("/", 1)[-1]: k for p, k in match_files.encodings(spark, str(tmp_path)).items()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert set(found) == set(CONTENTS)
    for name, content in CONTENTS.items():
        r = found[name]
        assert (r.sha256, r.bytes, r.rows) == (hashlib.sha256(content).hexdigest(), len(content), content.count(b"\n") - 1), name
    assert {n for n, k in kinds.items() if k != "UTF-8"} == {"latin.csv", "late.csv"}


def test_a_live_question_reads_one_season(spark, league, tmp_path):
    """The season's status is on the dimension; the partitions to read are found when the question runs."""
    build = warehouse.refresh(spark, str(league.matches_dir), str(league.game_dir), str(tmp_path), at())
    warehouse.open_views(spark, f"{tmp_path}/warehouse", ["team_match", "dim_season"])
    live = warehouse.ask(spark, """
        SELECT team_id, sum(points) AS points FROM team_match JOIN dim_season USING (season_id)
        WHERE status = :status GROUP BY team_id""", status="in_progress")
    plan = live._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(season_id" in plan and "dynamicpruning" in plan
    assert live.count() == 20 and build.marts["team_match"].count() == 2 * (380 + 60)
