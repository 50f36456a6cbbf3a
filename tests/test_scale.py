"""Steps whose files, scans or shuffles once grew faster than they had to."""

import pathlib
import uuid

from pyspark.sql import functions as F

from touchline.bindings import files
from touchline.bindings import inputs as b
from touchline.operators import rejects
from touchline.session import LISTING, LISTING_TASKS
from touchline.sources import match_files


def test_a_member_has_a_file_and_a_large_one_several(spark, tmp_path):
    """One supplier has 600 lines of four years, one a row that comes 12,000 times, one has no number."""
    few = spark.range(600).select(F.lit(1).cast("long").alias("l_suppkey"), F.col("id").alias("l_orderkey"), (1996 + F.col("id") % 4).alias("y"))
    many = spark.range(12_000).select(F.lit(2).cast("long").alias("l_suppkey"), F.lit(7).cast("long").alias("l_orderkey"), F.lit(1996).cast("long").alias("y"))
    none = few.limit(5).withColumn("l_suppkey", F.lit(None).cast("long"))
    rows = few.unionByName(many).unionByName(none).select(
        "l_suppkey", "l_orderkey", F.make_date("y", F.lit(1), F.lit(1)).cast("timestamp").alias("l_shipdate"),
        F.lit(1).alias("l_linenumber"), F.lit(2.0).alias("l_quantity"), F.lit(0.5).alias("l_tax"))
    rows.write.parquet(str(tmp_path / "lineitem.parquet"))
    folder = files.write_member_files(spark, str(tmp_path))
    found = {n: list(pathlib.Path(folder.removeprefix("file:")).glob(f"file=player_{n}.json/*.json")) for n in (1, 2)}
    assert len(found[1]) == 1 and len(found[2]) == 3
    entries = files.docs.history_documents(spark, folder, schema=files.HISTORY_ENTRY)
    sizes = {r.id: r.n for r in entries.groupBy("id").agg(F.count("_e").alias("n")).collect()}
    assert sizes == {1: 600, 2: 12_000}
    assert entries.filter("id = 2").agg(F.max("_place")).first()[0] < files.DOCUMENT_LINES
    files.write_member_files(spark, str(tmp_path), folder, "l_suppkey = 1 AND l_orderkey < 10")
    sizes = {r.id: r.n for r in files.docs.history_documents(spark, folder, schema=files.HISTORY_ENTRY).groupBy("id").agg(F.count("_e").alias("n")).collect()}
    assert sizes == {1: 10, 2: 12_000}


def test_season_files_of_one_header_are_one_scan(spark, tmp_path, monkeypatch):
    """Twelve parts of a season, two of them with another order of columns, and a season of its own encoding."""
    for i in range(12):
        head, line = ("Date,HomeTeam,FTHG", f"01/08/2025,H{i:02d},{i}") if i % 6 else ("FTHG,Date,HomeTeam", f"{i},01/08/2025,H{i:02d}")
        (tmp_path / "E0_2526.csv").mkdir(exist_ok=True)
        (tmp_path / "E0_2526.csv" / f"part-{i:05d}.csv").write_text(f"{head}\n{line}\n{line}\n")
    (tmp_path / "E0_2627.csv").write_bytes("Date,HomeTeam,Referee\n01/08/2026,H99,J Müller\n".encode("latin-1"))
    reads, read = [], match_files.read_match_file
    monkeypatch.setattr(match_files, "read_match_file", lambda s, paths, *a: reads.append(paths) or read(s, paths, *a))
    rows = match_files.load_matches(spark, str(tmp_path)).orderBy(*match_files.FILE_ORDER).collect()
    assert len(reads) == 3
    assert [(r.home_team, r.ft_home_goals, r._file_no) for r in rows[:24]] == [(f"H{i:02d}", str(i), i) for i in range(12) for _ in range(2)]
    assert (rows[24].referee, rows[24]._file_no, rows[24].season_code, len(rows)) == ("J Müller", 12, "2627", 25)


def test_matches_are_made_once_for_all_season_files(spark, tmp_path, monkeypatch):
    made, keyed = tmp_path / "made", b.keyed_matches
    made.mkdir()

    def counted(batches):
        for batch in batches:
            (made / uuid.uuid4().hex).write_text(str(batch.num_rows))
            yield batch

    def watched(*args):
        rows = keyed(*args)
        return rows.mapInArrow(counted, rows.schema)

    monkeypatch.setattr(b, "keyed_matches", watched)
    sf = "/root/testdata/sf0.001"
    folder = files.write_match_files(spark, sf)
    assert sum(int(f.read_text()) for f in made.iterdir()) == keyed(spark, sf).count()
    assert len(match_files.encodings(spark, folder)) >= 7


def test_many_copies_of_few_keys_move_no_row(spark, monkeypatch):
    """6,000 copies of 300 keys and 300 rejected rows of the same keys: more later copies than are broadcast."""
    monkeypatch.setattr(rejects.small_side, "__defaults__", (1_000, rejects.SMALL_BYTES))
    rows = spark.range(6_300, numPartitions=4).select(
        F.when(F.col("id") % 300 > 0, F.col("id") % 300).alias("k"), (6_300 - F.col("id")).alias("o"), (F.col("id") >= 6_000).alias("bad"))
    for fit in (True, False):
        if not fit:
            monkeypatch.setattr(rejects, "KEYS_BROADCAST", 10)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        flagged = rejects.flag_rejects(rows, [("bad", F.col("bad"))], ["k"], ["o"], "copy")
        plan = flagged._jdf.queryExecution().executedPlan().toString()
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert ("SortMergeJoin" not in plan) == fit
        found = {(r.k, r.o): r.reject_reason for r in flagged.collect()}
        assert sum(v == "bad" for v in found.values()) == 300 and sum(v == "copy" for v in found.values()) == 5_700
        assert {k for k, v in found.items() if v is None} == {(i or None, 6_300 - 5_700 - i) for i in range(300)}


def test_stages_hand_small_batches_to_python(spark, tmp_path):
    import corpus_pipeline as pipeline
    before = spark.conf.get(pipeline.BATCHES)
    try:
        spark.conf.set(pipeline.BATCHES, "10000")
        rows = spark.range(5_000, numPartitions=1).select(F.col("id").alias("doc_id"), F.lit("some words").alias("text"))
        seen = dict(pipeline.STAGES)["token-ID / binary output"](spark, rows, "")
        assert seen.count() == 5_000 and int(spark.conf.get(pipeline.BATCHES)) == pipeline.BATCH_ROWS
        spark.conf.set(pipeline.BATCHES, "10")
        dict(pipeline.STAGES)["token-ID / binary output"](spark, rows.limit(3), "")
        assert spark.conf.get(pipeline.BATCHES) == "10"
    finally:
        spark.conf.set(pipeline.BATCHES, before)


def test_member_files_are_listed_in_few_tasks(spark, tmp_path):
    """60 member folders took 60 tasks to list, whether all are read, ids are looked up or a list of files is read."""
    for n in range(60):
        (tmp_path / f"file=player_{n}.json").mkdir()
        (tmp_path / f"file=player_{n}.json" / "part-0.json").write_text('{"history": [{"fixture": %d}]}' % n)
    sc, before = spark.sparkContext, spark.conf.get(LISTING)
    paths = [str(p) for p in tmp_path.glob("*/*.json")]
    for i, read in enumerate([lambda: files.docs.history_documents(spark, str(tmp_path), schema=files.HISTORY_ENTRY),
                              lambda: files.docs.member_files(spark, str(tmp_path)),
                              lambda: files.docs.history_documents(spark, paths, schema=files.HISTORY_ENTRY)]):
        sc.setJobGroup(f"listing-{i}", "listing")
        try:
            found = read()
        finally:
            sc._jsc.clearJobGroup()
        jobs = [sc.statusTracker().getJobInfo(j) for j in sc.statusTracker().getJobIdsForGroup(f"listing-{i}")]
        tasks = [sc.statusTracker().getStageInfo(s).numTasks for j in jobs for s in j.stageIds]
        assert tasks and max(tasks) <= LISTING_TASKS * sc.defaultParallelism < 60
        assert sorted(r.id for r in found.select("id").collect()) == list(range(60))
    assert spark.conf.get(LISTING) == before


def test_small_member_files_are_written_by_every_core(spark, tmp_path, monkeypatch):
    """200 files of two lines are few bytes, which once put them all into one task."""
    rows = spark.range(400).select(
        (F.col("id") % 200).alias("l_suppkey"), F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"),
        F.lit(2.0).alias("l_quantity"), F.lit(0.5).alias("l_tax"))
    rows.write.parquet(str(tmp_path / "lineitem.parquet"))

    def tasks_of(folder):
        found = list(pathlib.Path(folder.removeprefix("file:")).glob("file=player_*.json/part-*.json"))
        assert len(found) == 200
        return len({p.name.split("-")[1] for p in found})

    assert tasks_of(files.write_member_files(spark, str(tmp_path))) == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(files, "TASK_DOCUMENTS", 10)
    folder = files.write_member_files(spark, str(tmp_path))
    assert 15 <= tasks_of(folder) <= 20
    entries = files.docs.history_documents(spark, folder, schema=files.HISTORY_ENTRY)
    assert sorted((r.id, r.fixture) for r in entries.select("id", "_e.fixture").collect()) == sorted((n % 200, n) for n in range(400))
