import json

import pytest
from pyspark.sql import functions as F

from touchline.operators.reshape import column_presence, missing_columns
from touchline.params import Params
from touchline.sources import match_files, sinks
from touchline.streaming.arrivals import on_arrival, seasons_in


def test_encodings_and_header_drift(spark, world):
    kinds = {p.rsplit("_", 1)[-1]: k for p, k in match_files.encodings(spark, str(world.matches_dir)).items()}
    assert kinds == {"2526.csv": "ISO-8859-1", "2627.csv": "UTF-8"}
    df = match_files.load_matches(spark, str(world.matches_dir))
    assert df.filter("season_code = '2526'").count() == 380 and df.filter("is_current_season").count() == 62
    assert df.filter("season_code = '2526' AND kickoff_time IS NOT NULL").count() == 0
    assert df.filter("is_current_season AND kickoff_time = '15:00'").count() == 61
    assert "B365H" not in df.columns and "J Müller" in {r.referee for r in df.select("referee").distinct().collect()}
    assert {r.season_label for r in df.select("season_label").distinct().collect()} == {"2025/26", "2026/27"}
    homes = [m["home"] for m in world.matches if m["season"] == "2627"]
    from tests.football import MATCH_SPELLING
    in_order = df.filter("is_current_season").orderBy(*match_files.FILE_ORDER).collect()
    assert [r.home_team for r in in_order[:60]] == [MATCH_SPELLING[h] for h in homes]
    for seasons in (["9999"], ["2526", "9999"]):
        with pytest.raises(FileNotFoundError, match="9999"):
            match_files.load_matches(spark, str(world.matches_dir), only=seasons)
        with pytest.raises(FileNotFoundError, match="9999"):
            match_files.load_matches(spark, str(world.matches_dir), Params(seasons=tuple(seasons)))


def test_by_header_reader_takes_both_encodings(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("Referee,\"Home, away\"\nJ Müller,1\n".encode("latin-1"))
    (tmp_path / "b.csv").write_bytes("\ufeffReferee,\"Home, away\"\nJ Mül,2\n".encode())
    rows = match_files.read_by_header(spark, str(tmp_path), {"Referee": "r", "Home, away": "h"}).collect()
    assert {(r.r, r.h) for r in rows} == {("J Müller", "1"), ("J Mül", "2")}
    columns = match_files.file_headers(spark, str(tmp_path)).select("column").distinct().collect()
    assert {r.column for r in columns} == {"Referee", "Home, away"}


def test_column_presence(spark, world):
    headers = match_files.file_headers(spark, str(world.matches_dir))
    rows = {r.column: r for r in column_presence(headers, "file", "column").collect()}
    assert rows["Date"].stable and not rows["Time"].stable and (rows["Time"].present, rows["Time"].files) == (1, 2)
    assert rows["Div"].present == 2
    lacking = {(r.file, r.column) for r in missing_columns(headers, "file", "column").collect()}
    assert ("E0_2526.csv", "Time") in lacking and not [f for f, c in lacking if c in ("Div", "Date")]


def test_manifest_and_cache(spark, world):
    at = F.lit("2026-10-01").cast("timestamp")
    first = match_files.manifest(spark, str(world.matches_dir), at)
    rows = {r.season: r for r in first.collect()}
    assert rows["2526"].rows == 380 and rows["2627"].rows == 62 and rows["2526"].changed
    assert rows["2526"].fetched_at == "2026-10-01T00:00:00+00:00"
    before = first.withColumn("sha256", F.when(F.col("season") == "2627", "old").otherwise(F.col("sha256")))
    again = match_files.manifest(spark, str(world.matches_dir), at, before)
    assert {r.season: r.changed for r in again.collect()} == {"2526": False, "2627": True}
    seasons = spark.createDataFrame([("2425",), ("2526",), ("2627",)], "season string")
    due = match_files.seasons_to_fetch(seasons, first, "2627")
    assert sorted(r.season for r in due.collect()) == ["2425", "2627"]
    assert match_files.seasons_to_fetch(seasons, first, "2627", force=True).count() == 3


def test_run_log(spark, tmp_path):
    folder = str(tmp_path / "runs")
    assert sinks.read_runs(spark, folder).count() == 0
    for run in ("a", "b"):
        rows = [(run, "load", "ok", "2026-10-01T00:00:00", 1.236, None, "x" * 900)]
        sinks.record_runs(spark.createDataFrame(rows, sinks.RUN_LOG), folder)
    with open(f"{folder}/extra.json", "w") as f:
        f.write("\n" + json.dumps({"run_id": "c", "stage": "s", "status": "failed", "duration_s": 0.5}) + "\n\n")
    rows = {r.run_id: r for r in sinks.read_runs(spark, folder).collect()}
    assert set(rows) == {"a", "b", "c"} and len(rows["a"].message) == 500 and rows["a"].duration_s == 1.24


def test_replace_by_run(spark, tmp_path):
    log = spark.createDataFrame([("a", 1), ("b", 2)], "run_id string, v int")
    first = sinks.land_new_version(spark, log, "run_id", None, str(tmp_path / "v1"))
    batch = spark.createDataFrame([("b", 3), ("c", 4)], "run_id string, v int")
    second = sinks.land_new_version(spark, batch, "run_id", first, str(tmp_path / "v2"))
    third = sinks.land_new_version(spark, batch, "run_id", second, str(tmp_path / "v3"))
    assert sorted((r.run_id, r.v) for r in spark.read.parquet(third).collect()) == [("a", 1), ("b", 3), ("c", 4)]


def test_partition_replacement_keeps_the_others(spark, tmp_path):
    folder = str(tmp_path / "p")
    sinks.land_partitions(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"), folder, "k")
    sinks.land_partitions(spark.createDataFrame([("b", 9)], "k string, v int"), folder, "k")
    assert sorted((r.k, r.v) for r in spark.read.parquet(folder).collect()) == [("a", 1), ("b", 9)]


def test_landing_replaces_every_partition(spark, tmp_path):
    folder = str(tmp_path / "p")
    sinks.land(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"), folder, ["k"])
    sinks.land(spark.createDataFrame([("b", 9)], "k string, v int"), folder, ["k"])
    assert [(r.k, r.v) for r in spark.read.parquet(folder).collect()] == [("b", 9)]
    assert sinks.exists(spark, folder) and not sinks.exists(spark, str(tmp_path / "none"))


def test_landing_counts_while_writing(spark, tmp_path):
    assert sinks.land_all({"t": spark.range(7), "u": spark.range(0)}, str(tmp_path)) == {"t": 7, "u": 0}


def test_arrivals_are_seen_once(spark, world, tmp_path):
    folder, seen = tmp_path / "in", []
    folder.mkdir()
    source = {p.name: p.read_bytes() for p in world.matches_dir.glob("*.csv")}

    def handle(batch, number):
        seen.extend(sorted(r.season for r in seasons_in(batch).collect()))

    (folder / "E0_2526.csv").write_bytes(source["E0_2526.csv"])
    on_arrival(spark, str(folder), str(tmp_path / "state"), handle)
    (folder / "E0_2627.csv").write_bytes(source["E0_2627.csv"])
    on_arrival(spark, str(folder), str(tmp_path / "state"), handle)
    on_arrival(spark, str(folder), str(tmp_path / "state"), handle)
    assert seen == ["2526", "2627"]


def test_shared_folder_needs_a_name_on_a_cluster(monkeypatch):
    from touchline.session import shared_folder

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": staticmethod(lambda key, default=None: default)})

    with pytest.raises(ValueError, match="shared folder"):
        shared_folder(Session())
