import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from touchline.operators import aggregates, checks, incremental, joins, keys, rejects, reshape, stats, windows
from touchline.operators import warehouse_tests as wt
from touchline.session import known_rows, materialize


def skewed(spark, n=3000, seed=3):
    """A third of all rows belong to one key."""
    r = random.Random(seed)
    rows = [(1 if r.random() < 0.34 else r.randint(2, 60), r.randint(1, 90), i, r.randint(0, 3), r.randint(1990, 1992))
            for i in range(n)]
    return spark.createDataFrame(rows, "team int, day int, id int, points int, season int"), \
        pd.DataFrame(rows, columns=["team", "day", "id", "points", "season"])


@pytest.mark.parametrize("hot_rows", [0, 200, 10**9])
def test_running_totals_match_for_hot_and_cold_groups(spark, hot_rows):
    df, pdf = skewed(spark)
    got = windows.running(df, ["team"], ["day", "id"], {"total": F.col("points")}, "n", hot_rows).toPandas()
    pdf = pdf.sort_values(["team", "day", "id"])
    pdf["total"] = pdf.groupby("team")["points"].cumsum()
    pdf["n"] = pdf.groupby("team").cumcount() + 1
    merged = got.merge(pdf, on="id", suffixes=("", "_w"))
    assert len(got) == len(pdf) and (merged.total == merged.total_w).all() and (merged.n == merged.n_w).all()


def test_running_keeps_a_null_group(spark):
    df = spark.createDataFrame([(None, 1, 5), (None, 2, 6), ("a", 1, 1)], "k string, t int, v int")
    for hot in (0, 10):
        rows = windows.running(df, ["k"], ["t"], {"s": F.col("v")}, hot_rows=hot).collect()
        assert sorted((r.k or "", r.t, r.s) for r in rows) == [("", 1, 5), ("", 2, 11), ("a", 1, 1)]


@pytest.mark.parametrize("hot_rows", [0, 5, 10**9])
def test_running_totals_of_null_measures(spark, hot_rows):
    rows = [(k, i, None if i < 18 or i % 7 == 0 else i) for k in ("a", "b") for i in range(40)]
    df = spark.createDataFrame(rows, "k string, t int, v int").repartition(5)
    got = {(r.k, r.t): r.s for r in windows.running(df, ["k"], ["t"], {"s": F.col("v")}, hot_rows=hot_rows).collect()}
    for k, t, _ in rows:
        seen = [v for q, i, v in rows if q == k and i <= t and v is not None]
        assert got[k, t] == (sum(seen) if seen else None)


@pytest.mark.parametrize("hot_rows", [0, 150, 10**9])
def test_islands_match_brute_force(spark, hot_rows):
    df, pdf = skewed(spark, seed=4)
    got = windows.islands(df, ["team", "season"], ["day", "id"], F.col("points") > 0, "id", hot_rows)
    want = []
    for (team, season), g in pdf.sort_values(["day", "id"]).groupby(["team", "season"]):
        run = []
        for row in [*g.itertuples(), None]:
            if row is not None and row.points > 0:
                run.append(row.id)
            elif run:
                want.append((team, season, len(run), min(run), max(run)))
                run = []
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_trailing_sum_counts_blank_and_double_periods(spark):
    rows = [(1, 1, 2), (1, 2, 3), (1, 2, 4), (1, 5, 1), (1, 6, 1), (1, 7, 10)]
    df = spark.createDataFrame(rows, "p int, gw int, v int")
    got = windows.trailing_sum(df, ["p"], "gw", {"s": "v"}).orderBy("gw").collect()
    assert [(r.gw, r.s) for r in got] == [(1, 2), (2, 9), (5, 10), (6, 9), (7, 12)]


def test_dense_keys_with_a_hot_leading_value(spark):
    rows = [("hot" if i % 3 else f"k{i}", i) for i in range(2000)]
    df = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), "k string, i int").repartition(7)
    got = keys.number_rows(df, ["k", "i"], "id").orderBy("id").collect()
    assert [(r.k, r.i) for r in got] == sorted(rows) and [r.id for r in got] == list(range(1, 2001))
    for small in (0, 10**6):
        members = keys.number_members(df, ["k", "i"], "id", small).orderBy("id").collect()
        assert [(r.id, r.k, r.i) for r in members] == [(r.id, r.k, r.i) for r in got]


def test_empty_input_is_numbered(spark):
    df = spark.createDataFrame([], "k string")
    assert keys.number_rows(df, ["k"], "id").count() == 0


def test_rank_shares_ties_and_skips(spark):
    df = spark.createDataFrame([("a", 9, 1), ("b", 9, 1), ("c", 9, 0), ("d", None, 5), ("e", 3, 3)], "n string, p int, g int")
    for small in (0, 100):
        got = {r.n: r.place for r in keys.competition_rank(df, ["p", "g"], "place", small).collect()}
        assert got == {"a": 1, "b": 1, "c": 3, "e": 4, "d": 5}
    tied = spark.range(9000).withColumn("p", F.lit(1)).repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # it would merge such small ranges
    try:
        ranked = keys.competition_rank(tied, ["p"], "place", 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert ranked.agg(F.min("place"), F.max("place"), F.count("id")).first()[:] == (1, 1, 9000)
    assert ranked.filter("place = 1").inputFiles().__len__() > 1


def test_lookups(spark):
    facts = spark.createDataFrame([(1, "x"), (2, None), (3, "zz"), (4, None)], "id int, name string")
    dim = spark.createDataFrame([("x", 10), ("y", 20)], "name string, key int")
    on, take = {"name": "name"}, {"key": "key"}
    assert [(r.id, r.key) for r in joins.require(facts, dim, on, take).collect()] == [(1, 10)]
    for spread in (False, True):
        got = joins.look_up(facts, dim, on, take, default=0, spread_missing=spread)
        assert sorted((r.id, r.key) for r in got.collect()) == [(1, 10), (2, 0), (3, 0), (4, 0)]
    assert sorted((r.id, r.key) for r in joins.look_up(facts, dim, on, take).collect()) == [
        (1, 10), (2, None), (3, None), (4, None)]
    assert [r.name for r in joins.dropped_keys(facts.filter("name is not null"), dim, on).collect()] == ["zz"]
    with pytest.raises(Exception, match="Unknown club: zz"):
        joins.strict_look_up(facts.filter("id = 3"), dim, on, take, "club").collect()
    with pytest.raises(Exception, match="Unknown club: NULL"):
        joins.strict_look_up(facts.filter("id = 2"), dim, on, take, "club").collect()


def test_broadcast_only_when_small(spark):
    side = spark.range(50).withColumnRenamed("id", "key")
    def hinted(df):
        return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(joins.small_side(side, 50)) and not hinted(joins.small_side(side, 49))
    assert known_rows(materialize(side)) == 50
    wide = spark.createDataFrame([("x" * 1000,), (None,)], "name string")
    assert hinted(joins.small_side(wide, 50, 2100)) and not hinted(joins.small_side(wide, 50, 2000))


def test_names(spark):
    df = spark.createDataFrame([(" Man United ",)], "n string")
    from touchline.params import GAME_NAMES, MATCH_NAMES
    assert df.select(joins.canonical("n", MATCH_NAMES, "match").alias("x")).first().x == "Manchester United"
    assert MATCH_NAMES["Tottenham"] == GAME_NAMES["Spurs"] and MATCH_NAMES["Man United"] == GAME_NAMES["Man Utd"]
    other = spark.createDataFrame([("Real Madrid",)], "n string")
    with pytest.raises(Exception, match="Unmapped match name: Real Madrid"):
        other.select(joins.canonical("n", MATCH_NAMES, "match")).collect()
    with pytest.raises(joins.UnmappedName, match="1 unmapped match names, the first: Real Madrid"):
        joins.require_mapped(other, "n", MATCH_NAMES, "match")


def test_keep_first_with_a_hot_key(spark):
    rows = [("hot" if i % 3 == 0 else f"k{i % 50}", i) for i in range(600)] + [(None, 1000), (None, 1001)]
    df = spark.createDataFrame(rows, "k string, i int")
    first = rejects.keep_first(df, ["k"], ["i"]).collect()
    later = rejects.later_copies(df, ["k"], ["i"]).collect()
    want = {}
    for k, i in rows:
        want[k] = min(i, want.get(k, i))
    assert {r.k: r.i for r in first} == want and len(first) == len(want)
    assert len(later) == len(rows) - len(want)


def test_first_failing_rule_names_the_row(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 50)], "id int, v int")
    rules = [("big", F.col("v") > 10), ("odd", F.col("v") % 2 == 1), ("huge", F.col("v") > 40)]
    flagged = rejects.flag_rejects(df, rules)
    assert {r.id: r.reject_reason for r in flagged.collect()} == {1: "odd", 2: None, 3: "big"}
    assert [(r.reject_reason, r.rows) for r in rejects.reject_counts(flagged).collect()] == [("big", 1), ("odd", 1)]


def test_quantiles_match_numpy(spark):
    r = np.random.default_rng(5)
    pdf = pd.DataFrame({"g": r.integers(0, 4, 3000), "v": np.where(r.random(3000) < 0.34, 7.0, r.normal(50, 20, 3000))})
    pdf.loc[pdf.g == 3, "v"] = 5.0
    df = spark.createDataFrame(pdf)
    qs = {"a": 0.0, "q25": 0.25, "m": 0.5, "q9": 0.9, "z": 1.0}
    for row in stats.exact_quantiles(df, ["g"], "v", qs).collect():
        want = np.quantile(pdf[pdf.g == row.g].v, list(qs.values()))
        assert np.allclose([row[n] for n in qs], want)
    total = stats.exact_quantiles(df, [], "v", qs).first()
    assert np.allclose([total[n] for n in qs], np.quantile(pdf.v, list(qs.values())))


def test_median_of_one_row_and_of_none(spark):
    df = spark.createDataFrame([(1, 4.0), (2, None)], "g int, v double")
    assert [(r.g, r.m) for r in stats.exact_quantiles(df, ["g"], "v", {"m": 0.5}).collect()] == [(1, 4.0)]
    row = stats.headline(df.filter("v > 100"), "v", "v").first()
    assert (row.shown, row.best, row.median) == (0, None, None)


def test_line_fit_and_constant_predictor(spark):
    pdf = pd.DataFrame({"x": [1.0, 2.0, 3.0, 4.0], "y": [2.0, 4.1, 5.9, 8.2], "k": [1.0] * 4})
    df = spark.createDataFrame(pdf)
    fit, (b, a) = stats.fit_line(df, "x", "y").first(), np.polyfit(pdf.x, pdf.y, 1)
    assert np.allclose([fit.slope, fit.intercept, fit.r], [b, a, np.corrcoef(pdf.x, pdf.y)[0, 1]])
    flat = stats.fit_line(df, "k", "y").first()
    assert flat.slope is None and flat.intercept is None and flat.r is None
    assert stats.with_residuals(df, "x", "y", min_rows=10).first().expected is None
    assert [(r.measure, r.r) for r in stats.correlation_with(df, "y", ["k", "x"]).collect()][1] == ("k", None)


def test_interval_and_usage(spark):
    df = spark.createDataFrame([("a", v) for v in (1, 2, 3, 4)], "g string, v int")
    row = stats.mean_interval(df, ["g"], "v").first()
    sd = np.std([1, 2, 3, 4], ddof=1)
    assert np.allclose([row["mean"], row.low, row.high], [2.5, 2.5 - 1.96 * sd / 2, 2.5 + 1.96 * sd / 2], atol=1e-6) and row.small_sample
    members = spark.createDataFrame([(1, "G"), (2, "G"), (3, "D")], "id int, pos string")
    facts = spark.createDataFrame([(1, 90), (1, 10), (3, 0)], "p int, m int")
    got = {r.pos: (r.members, r.never_used, r.under_floor, r.pct_under)
           for r in stats.usage_share(members, facts, "p", "id", "pos", "m").collect()}
    assert got == {"G": (2, 1, 1, 50.0), "D": (1, 1, 1, 100.0)}


def test_latest_skips_missing_values(spark):
    df = spark.createDataFrame([(1, 1, 5.0), (1, 2, 6.0), (1, 3, None)], "p int, gw int, v double")
    assert df.groupBy("p").agg(aggregates.latest("v", "gw").alias("x")).first().x == 6.0


def test_split_keeps_the_listed_order(spark):
    df = spark.createDataFrame([("A",), ("H",), ("H",)], "r string")
    got = aggregates.value_split(df, "r", ["H", "D", "A"]).orderBy("position").collect()
    assert [(r.r, r.rows) for r in got] == [("H", 2), ("D", None), ("A", 1)]


def test_reshape(spark):
    df = spark.createDataFrame([(1, "a", "b"), (2, None, "a")], "id int, h string, w string")
    assert sorted(r.n for r in reshape.distinct_union([df.select("h"), df.select("w")], "n").collect()) == ["a", "b"]
    empty = spark.createDataFrame([(5, 3), (None, 4)], "lo int, hi int")
    assert reshape.spine(empty, "lo", "hi", "n").count() == 0
    points = spark.createDataFrame([("t", 1, 2), ("t", 1, 4), ("t", 3, 5), ("u", 2, 1)], "t string, gw int, d int")
    got = {r.t: (r.gw1, r.gw2, r.gw3, r["mean"]) for r in reshape.pivot_mean(points, "t", "gw", [1, 2, 3], "d", "gw").collect()}
    assert got == {"t": (3.0, None, 5.0, 4.0), "u": (None, 1.0, None, 1.0)}


def test_set_differences(spark):
    a = spark.createDataFrame([(1,), (2,), (2,), (None,)], "x int")
    b = spark.createDataFrame([(2,), (3,), (None,)], "x int")
    assert [r.x for r in reshape.set_difference(a, b).collect()] == [1]
    assert sorted((r.x, r.only_in) for r in reshape.both_differences(a, b, "a", "b").collect()) == [(1, "a"), (3, "b")]


def test_snapshot_diff_selects_new_changed_and_unstored(spark):
    now = incremental.signatures(spark.createDataFrame(
        [(1, 5, 90), (2, 6, 90), (3, 1, 1), (4, 2, 2)], "id int, p int, m int"), "id", ["p", "m"])
    before = incremental.signatures(spark.createDataFrame(
        [(1, 5, 90), (2, 5, 90), (4, 2, 2)], "id int, p int, m int"), "id", ["p", "m"])
    stored = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    assert sorted(r.id for r in incremental.needing_refresh(now, before, "id", stored).collect()) == [2, 3, 4]
    assert sorted(r.id for r in incremental.needing_refresh(now, before, "id").collect()) == [2, 3]


@pytest.mark.parametrize("done, last, go", [([1, 2], 1, True), ([1, 2], 2, False), ([], 1, False), ([1], None, True), ([], None, False)])
def test_high_water_mark(spark, done, last, go):
    df = spark.createDataFrame([(i, i in done) for i in range(1, 5)], "id int, ok boolean")
    row = incremental.high_water_mark(df, "id", F.col("ok"), F.lit(last)).first()
    assert row.should_refresh is go and row.latest == max(done, default=None)


def test_a_failed_fetch_keeps_the_old_snapshot(spark, tmp_path):
    folder = str(tmp_path / "snapshot")
    incremental.commit_snapshot(spark.range(1), folder, lambda: None)
    def fail():
        raise OSError("lost")
    with pytest.raises(OSError):
        incremental.commit_snapshot(spark.range(9), folder, fail)
    assert spark.read.parquet(folder).count() == 1


def test_contracts(spark):
    def passed(df):
        return [r.passed for r in df.collect()]
    prices = spark.createDataFrame([(5.5,), (None,)], "price_m double")
    check = checks.in_range("prices", "price_m", 3.0, 20.0, "implausible")
    assert passed(checks.run_row_checks(prices, [check])) == [True]
    wrong = checks.run_row_checks(prices.union(spark.createDataFrame([(55.0,)], "p double")), [check]).first()
    assert not wrong.passed and wrong.detail == "1 implausible"
    minutes = spark.createDataFrame([(0,), (90,), (120,)], "m int")
    assert passed(checks.run_row_checks(minutes, [checks.in_range("m", "m", 0, 120, "outside")])) == [True]
    double = spark.createDataFrame([(1, 10), (1, 11)], "p int, f int")
    assert passed(checks.unique_key(double, ["p", "f"])) == [True]
    assert passed(checks.unique_key(double.union(double), ["p", "f"])) == [False]
    none = spark.createDataFrame([], "home string, away string")
    row = checks.count_spread(none, ["home", "away"], 2).first()
    assert row.passed and row.detail == "no matches yet"
    nulls = checks.run_row_checks(spark.createDataFrame([(1, None), (None, None)], "a int, b int"), [checks.no_nulls(["a", "b"])])
    assert nulls.first().detail == "nulls: {'a': 1, 'b': 2}"
    need = spark.createDataFrame([(1, 2), (9, 1)], "pos int, squad int")
    have = spark.createDataFrame([(1,), (1,)], "pos int")
    assert checks.category_minimum(have, need, "pos", "squad").first().detail == "short: {9: 1}"
    with pytest.raises(checks.ContractFailure, match="1 duplicates|2 duplicates"):
        checks.stop_on_failure(checks.unique_key(double.union(double), ["p", "f"]))


def test_warehouse_tests_return_failing_rows(spark):
    import datetime as dt
    days = [dt.date(2026, 1, 1) + dt.timedelta(days=i) for i in range(5)]
    full = spark.createDataFrame([(d,) for d in days], "d date")
    assert wt.calendar_gaps(full, "d").count() == 0
    row = wt.calendar_gaps(full.filter(F.col("d") != days[2]), "d").first()
    assert row.days == 4 and row.first_day == days[0]
    periods = spark.createDataFrame([(1,), (2,), (4,), (4,)], "gw int")
    assert [r.gw for r in wt.missing_periods(periods, "gw").collect()] == [3]
    assert [r.gw for r in wt.not_unique(periods, "gw").collect()] == [4]
    keys_ = spark.createDataFrame([(1,), (7,), (None,)], "k int")
    assert [r.k for r in wt.orphans(keys_, "k", periods, "gw").collect()] == [7]
    assert wt.is_null(keys_, "k").count() == 1
    assert [r.k for r in wt.not_accepted(keys_, "k", [1]).collect()] == [7]
    assert wt.out_of_range(keys_, "k", 1, 5).count() == 1


def test_gaps_of_each_member(spark):
    rows = [("a", 2), ("a", 5), ("a", 5), ("b", 1), ("b", 6), ("c", 3), ("d", None), ("e", None), ("e", 6), ("f", 1), ("f", 2), ("f", 3), ("f", 4),
            ("f", 5), ("f", 6)]
    got = sorted(tuple(r) for r in wt.missing_periods_by(spark.createDataFrame(rows, "g string, p int"), "g", "p").collect())
    want = sorted((g, p) for g in "abcdef" for p in range(1, 7) if (g, p) not in rows)
    assert got == want
    assert wt.missing_periods_by(spark.createDataFrame([], "g string, p int"), "g", "p").count() == 0
    assert wt.missing_periods_by(spark.createDataFrame([("a", None)], "g string, p int"), "g", "p").count() == 0
    plan = wt.missing_periods_by(spark.createDataFrame(rows, "g string, p int"), "g", "p")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftAnti" not in plan


def test_details_name_a_bounded_number_of_members(spark, monkeypatch):
    rows = spark.createDataFrame([(f"s{i:02}", None) for i in range(30)] + [(None, None), ("ok", 1), ("ok", 2)], "s string, x int")
    all_named = checks.group_counts(rows, "s", 2).first()
    assert not all_named.passed and all_named.detail.startswith("off: {NULL: 1, 's00': 1, 's01': 1")
    monkeypatch.setattr(checks, "SHOWN", 3)
    few = checks.group_counts(rows, "s", 2).first()
    assert few.detail == "off: {NULL: 1, 's00': 1, 's01': 1, and 28 more}"
    assert checks.wrong_counts(rows, "s", 2).count() == 31
    known, members = spark.createDataFrame([("a",)], "k string"), spark.createDataFrame([("b",), ("a",), ("c",), ("b",), (None,)], "m string")
    assert checks.members_reconcile(known, members, "n", "ok", "only").first().detail == "only: ['b', 'c']"
    everything = checks.quarantined({"n": checks.unknown_members(known, members), "g": checks.wrong_counts(rows, "s", 2)})
    assert everything.count() == 33 and everything.filter("member IS NULL").first()["value"] == 1


def test_counted_rejects_equal_flagged_ones(spark):
    rng = np.random.default_rng(3)
    rows = [(i, int(k) if k else None, int(v)) for i, (k, v) in enumerate(zip(rng.integers(0, 6, 300), rng.integers(0, 12, 300)))]
    df = spark.createDataFrame(rows, "i int, k int, v int")
    rules = [("low", F.col("v") < 2), ("high", F.col("v") > 9)]
    flagged = rejects.reject_counts(rejects.flag_rejects(df, rules, ["k", "v"], ["i"], "again"))
    assert rejects.count_rejects(df, rules, ["k", "v"], "again").collect() == flagged.collect()
    assert rejects.count_rejects(df.limit(0), rules, ["k"], "again").count() == 0


def test_a_written_side_is_not_written_again(spark):
    flat = materialize(spark.range(10).withColumn("name", F.lit("x")))
    nested = materialize(spark.range(10).withColumn("names", F.array(F.lit("x"))))
    assert joins.small_side(nested) is nested
    assert joins.small_side(flat).inputFiles() == flat.inputFiles()
    hinted = [side._jdf.queryExecution().analyzed().toString() for side in (joins.small_side(flat), joins.small_side(nested))]
    assert ["strategy=broadcast" in text for text in hinted] == [True, False]
