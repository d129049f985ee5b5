"""Hand-worked cases."""

from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from rainspark.functions import kernels
from rainspark.functions import scalars as S
from rainspark.operators import gapfill, ingest, interpolate, merge, metrics, monthly, quality, spatial
from rainspark.plans import table_queries
from rainspark.sources import tables

T0 = datetime(2024, 1, 2, 10)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def one(spark, expr, **values):
    df = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items()))
    return df.select(expr.alias("x")).first().x


def test_local_time_closes_the_day(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 2, 10),), (datetime(2024, 1, 2, 10, 5),)], "ts timestamp_ntz")
    got = [r.date for r in ingest.with_day(df).collect()]
    assert got == [date(2024, 1, 1), date(2024, 1, 2)]


def gauge(spark, values, minutes=60, start=T0):
    data = [(1, datetime.fromtimestamp(start.timestamp() + 60 * minutes * i), float(v), i) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "station long, ts timestamp_ntz, value double, seq long")


def test_accumulator_reset(spark):
    got = ingest.increments(gauge(spark, [10, 12, 1, 3])).orderBy("ts").collect()
    assert [r["diff"] for r in got] == [None, 2, None, 2]
    days = ingest.daily_totals(ingest.hourly_totals(ingest.with_day(ingest.increments(gauge(spark, [10, 12, 1, 3]))), "diff"))
    assert sum(r.rf for r in days.collect()) == 4


def test_first_reading_wins(spark):
    df = spark.createDataFrame([(1, T0, 9.0, 2), (1, T0, 5.0, 1)], "station long, ts timestamp_ntz, value double, seq long")
    assert rows(ingest.first_per_instant(df), "value", "seq") == [(5.0, 1)]


def test_modal_interval_tie_takes_the_first_seen(spark):
    at = [0, 15, 75, 90, 150]
    data = [(1, datetime.fromtimestamp(T0.timestamp() + 60 * m), 0.0, m) for m in at]
    df = spark.createDataFrame(data, "station long, ts timestamp_ntz, value double, seq long")
    assert rows(ingest.interval_mode(ingest.increments(df)), "obs_int_mins") == [(15.0,)]


def test_completeness_and_null_hours(spark):
    days = spark.createDataFrame([(1, 23), (2, 22)], "station long, n_obs long").withColumn("data_per", F.col("n_obs") * 60 / 1440)
    assert rows(ingest.complete_days(days), "station") == [(1,)]
    df = spark.createDataFrame([(1, T0, None), (1, datetime(2024, 1, 2, 12), 2.0)], "station long, ts timestamp_ntz, value double")
    got = ingest.daily_totals(ingest.hourly_totals(ingest.with_day(df)))
    assert sum(r.rf for r in got.collect()) == 2


def test_24_hour_accumulators(spark):
    schema = "station long, ts timestamp_ntz, value double"
    mid = [datetime(2024, 1, d, 10) for d in (1, 2)]
    df = spark.createDataFrame([(1, mid[0], 100.0), (1, mid[1], 107.5), (2, mid[0], 5.0), (2, mid[1], 4.0)], schema)
    assert rows(ingest.accumulator_24h(df), "station", "date", "rf") == [(1, date(2024, 1, 1), 7.5)]
    near = [(1, datetime(2024, 1, 1, 9, 58), 3.0), (1, datetime(2024, 1, 1, 10, 2), 5.0)]
    near += [(1, datetime(2024, 1, 2, 9, 56), 9.0), (1, datetime(2024, 1, 2, 10, 4), 8.0)]
    got = ingest.accumulator_24h_rounded(spark.createDataFrame(near, schema))
    assert rows(got, "date", "rf") == [(date(2024, 1, 1), 6.0)]


def test_method_precedence(spark):
    def t(rf):
        return spark.createDataFrame([(1, date(2024, 1, 1), rf)] if rf is not None else [], "station long, date date, rf double")

    assert rows(ingest.prefer([t(None), t(5.0), t(4.0), t(6.0)]), "rf") == [(5.0,)]
    assert rows(ingest.prefer([t(4.0), t(5.0)]), "rf") == [(4.0,)]


def test_network_priority_and_counts(spark):
    data = [("a", "hads", 3.0), ("a", "nws", 4.0), ("a", "uhmeso", 2.0)]
    df = spark.createDataFrame([(1, date(2024, 1, 1), *x) for x in data], "skn long, date date, source_id string, network string, rf double")
    assert rows(merge.dedup(df), "rf", "source") == [(2.0, "uhmeso")]
    before = spark.createDataFrame([("hads",), ("hads",), ("nws",)], "network string")
    after = spark.createDataFrame([("hads",), ("hads",)], "source string")
    got = rows(merge.count_log(before, after), "network", "is_unique", "n")
    assert got == [("SUBTOTAL", False, 3), ("TOTAL", True, 2), ("hads", False, 2), ("hads", True, 2), ("nws", False, 1)]


def test_hourly_feed_and_ids(spark):
    data = [("HNL", "n", date(2024, 1, 1), 1.0)] * 23 + [("X", "n", date(2024, 1, 1), 1.0)] * 22 + [("OGG", "n", date(2024, 1, 1), 1.0)] * 24
    got = ingest.hourly_feed_to_daily(spark.createDataFrame(data, "id string, name string, date date, rf double"))
    assert rows(got.withColumn("id", ingest.airport_id("id")), "id", "rf", "hour_count") == [("OGG", 24.0, 24), ("PHNL", 23.0, 23)]


def test_cap_and_probability(spark):
    df = spark.createDataFrame([(500.0,), (500.1,), (None,)], "rf double")
    assert rows(quality.cap(df), "rf") == [(500.0,), (None,), (None,)]
    p = S.rain_probability(F.col("rf"), F.lit(0.0), F.lit(1.0), F.lit(0.4))
    assert one(spark, p, rf=0.0) == pytest.approx(0.6)
    assert one(spark, p, rf=1.0) == pytest.approx(0.8, abs=1e-6)


def test_gap_fill(spark):
    day = date(2024, 1, 1)
    # station 9 is the target
    pairs = spark.createDataFrame([(9, i, 0.99 - i / 100, r) for i, r in enumerate([2.0, 1.0, 1.0, 0.5, 1.0])], "target_skn long, skn long, spear double, ratio double")
    cells = spark.createDataFrame([(9, "BI", day, None), (1, "BI", day, 7.0)], "skn long, county string, date date, rf double")

    def est(rain):
        days = spark.createDataFrame([(i, "BI", day, x) for i, x in enumerate(rain)], "skn long, county string, date date, rf double")
        return rows(gapfill.estimates(cells, days, pairs), "skn", "est", "n")

    assert est([3.0, None, 4.0, 10.0, 100.0]) == [(9, 5.0, 3)]
    assert est([3.0, None, None, None, None]) == [(9, 6.0, 1)]
    assert est([None] * 5) == []
    filled = spark.createDataFrame([(9, day, 5.0), (1, day, 0.0)], "skn long, date date, est double")
    assert rows(gapfill.fill(cells, filled), "skn", "rf", "is_fill") == [(1, 7.0, False), (9, 5.0, True)]


def test_month_totals_and_active(spark):
    schema = "skn long, date date, rf double"
    df = spark.createDataFrame([(1, date(2024, 1, d), v) for d, v in ((1, 1.0), (2, 2.0), (3, None))], schema)
    assert rows(monthly.month_total(df), "rf") == [(None,)]
    assert rows(monthly.month_total(df.fillna(3.0)), "rf") == [(6.0,)]
    seen = spark.createDataFrame([(1, date(2022, 6, 2)), (2, date(2022, 6, 1))], "skn long, last_date date")
    assert rows(gapfill.active(seen, "2024-06-01"), "skn") == [(1,)]


def test_dropped_station_still_drops_others(spark):
    data = [("BI", date(2024, 1, 1), i + 1, i, 0.002 * i, 0.0) for i in range(3)]
    df = spark.createDataFrame(data, "county string, date date, rank int, skn long, lon double, lat double")
    assert rows(spatial.drop_near(df), "skn") == [(0,)]


def test_idw(spark):
    cell = spark.createDataFrame([("BI", 0, 0, 0.0, 0.0), ("BI", 0, 1, 1.0, 0.0)], "county string, row long, col long, lon double, lat double")
    data = [("BI", 1, 1.0, 0.0, 10.0), ("BI", 1, 0.0, 2.0, 20.0)]
    pts = spark.createDataFrame(data, "county string, month int, lon double, lat double, rf double")
    assert rows(interpolate.idw(cell, pts, ["county"], ["month"]), "col", "value") == [(0, 12.0), (1, 10.0)]


def test_metrics(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 2.0, 2.0), ("a", 3.0, 2.0), ("dry", 0.0, 1.0)], "g string, obs double, pred double")
    got = {r.g: r for r in metrics.scores(df, ["g"]).collect()}
    a = got["a"]
    assert (a.rmse, a.mae) == (pytest.approx((2 / 3) ** 0.5), pytest.approx(2 / 3))
    assert (a.bias, a.nse) == (pytest.approx(0), pytest.approx(0)) and a.r2 is None and a.kge is None
    assert got["dry"].no_rain and got["dry"].mae is None


def test_best_run_rejects_a_flat_free_variogram(spark):
    data = [("a", 2, True, 0.5, 1.0, 1.0, 1.0), ("a", 1, False, 0.5, 1.0, 1.0, 2.0)]
    df = spark.createDataFrame(data, "g string, run int, is_free boolean, nugget double, range double, sill double, mae double")
    assert rows(metrics.best_run(df, ["g"]), "run") == [(1,)]


def test_replacement_is_idempotent(spark):
    old = spark.createDataFrame([(1, 1, 5.0), (2, 1, 6.0), (1, 2, 7.0)], "skn long, date int, rf double")
    new = spark.createDataFrame([(1, 1, 8.0)], "skn long, date int, rf double")
    once = merge.replace_days(old, new)
    assert rows(once, "skn", "date", "rf") == rows(merge.replace_days(once, new), "skn", "date", "rf") == [(1, 1, 8.0), (1, 2, 7.0)]


def test_partition_overwrite_is_idempotent(spark):
    path = tables.scratch(spark, "test")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, day string")
    for _ in range(2):
        tables.overwrite_partitions(df, path, "day")
    tables.overwrite_partitions(spark.createDataFrame([(9, "b")], "x int, day string"), path, "day")
    assert rows(spark.read.parquet(path), "x", "day") == [(1, "a"), (9, "b")]


def test_wide_round_trip(spark):
    long = spark.createDataFrame([(1, date(2024, 1, 1), 2.0), (2, date(2024, 1, 2), 3.0)], "skn long, date date, value double")
    wide = tables.to_wide(long.withColumn("n", S.wide_name("date")), ["skn"], "n", "value", ["X2024.01.01", "X2024.01.02"])
    assert rows(tables.melt_wide(wide, ["skn"]), "skn", "date", "value") == rows(long, "skn", "date", "value")


def test_leave_one_out_equals_brute_force():
    rng = np.random.default_rng(0)
    xy, y = rng.random((12, 2)), rng.random(12)
    for model in ("exp", "matern32", "matern52"):
        cov = kernels.covariance(model, 0.05, 0.3, 1.0)
        got = kernels.leave_one_out(xy, y, cov)
        for i in range(12):
            keep = np.arange(12) != i
            w, inverse = kernels.solve_kriging(xy[keep], y[keep], cov)
            pred, _ = kernels.predict(xy[keep], w, inverse, xy[i : i + 1], cov)
            assert got[i] == pytest.approx(pred[0], abs=1e-6)


def test_kriging_is_exact_at_stations_without_nugget():
    rng = np.random.default_rng(1)
    xy, y = rng.random((10, 2)), rng.random(10)
    cov = kernels.covariance("exp", 0.0, 0.5, 1.0)
    w, inverse = kernels.solve_kriging(xy, y, cov)
    pred, var = kernels.predict(xy, w, inverse, xy, cov)
    assert np.allclose(pred, y, atol=1e-5) and np.all(var < 1e-5)


def test_fit_finds_a_known_variogram():
    h = np.linspace(0.1, 3, 12)
    gamma = 0.2 + 0.8 * (1 - np.exp(-h / 0.7))
    nugget, range_, sill, sse = kernels.fit_variogram(h, gamma, np.full(12, 50))
    assert (nugget, range_, sill) == (pytest.approx(0.2, abs=0.03), pytest.approx(0.7, rel=0.1), pytest.approx(1.0, abs=0.03))


def test_screen_removes_one_station_a_round(spark):
    data = [("BI", date(2024, 1, 1), i, 100.0 if i in (3, 5) else 1.0) for i in range(8)]
    df = spark.createDataFrame(data, "county string, date date, skn long, rf double")

    def score(x):
        return x.withColumn("prob_bad", F.col("rf") / 100).withColumn("bad_class", F.col("rf") > 50)

    got = rows(quality.screen(df, score, least=2).filter("status = 'fail'"), "skn", "round")
    assert got == [(3, 0), (5, 1)]
    assert quality.screen(df, score, least=8).filter("status = 'fail'").count() == 0


def test_screen_goes_on_after_twenty_rounds(spark):
    data = [("BI", date(2024, 1, 1), i, 100.0 + i if i < 23 else 1.0) for i in range(30)]
    df = spark.createDataFrame(data, "county string, date date, skn long, rf double")

    def score(x):
        return x.withColumn("prob_bad", F.col("rf") / 200).withColumn("bad_class", F.col("rf") > 50)

    got = rows(quality.screen(df, score, least=2).filter("status = 'fail'"), "skn", "round")
    assert sorted(got) == [(i, 22 - i) for i in range(23)]


def test_wide_years_come_from_the_dates(spark, monkeypatch):
    data = [(1, date(y, 3, 5), float(y)) for y in (1988, 1995, 2004)]
    days = spark.createDataFrame(data, "skn long, date date, rf double")
    monkeypatch.setattr(table_queries.D, "station_day", lambda *_: days)
    assert rows(table_queries.a4_wide_to_long(spark, ""), "skn", "date", "value") == data


def test_relations_against_brute_force(spark):
    """Overlap, Spearman with ties and ratio of every pair, over several blocks of stations."""
    rng = np.random.default_rng(6)
    base = rng.gamma(0.5, 10, 60)
    rain = {i: np.where(rng.random(60) < 0.3, np.nan, np.round(base * (0.4 + 0.2 * i) + rng.random(60) * 4)) for i in range(9)}
    data = [(i, "BI" if i < 7 else "KA", date.fromordinal(738000 + d), None if np.isnan(x) else float(x)) for i, v in rain.items() for d, x in enumerate(v)]
    days = spark.createDataFrame(data, "skn long, county string, date date, rf double")
    want = {}
    for a in rain:
        for b in rain:
            both = ~np.isnan(rain[a]) & ~np.isnan(rain[b])
            if a == b or (a < 7) != (b < 7) or both.sum() < 20:
                continue
            y, x = rain[a][both], rain[b][both]
            rank = [np.array([(v < z).sum() + ((v == z).sum() + 1) / 2 for z in v]) for v in (y, x)]
            spear, ratio = np.corrcoef(*rank)[0, 1], y.sum() / x.sum()
            if spear > 0.6 and 0.3 < ratio < 2.7:
                want[a, b] = (int(both.sum()), round(spear, 9), round(ratio, 9))
    for block in (2, 48):
        got = gapfill.relations(days, 0.6, 20, block_stations=block).collect()
        assert {(r.target_skn, r.skn): (r.n, round(r.spear, 9), round(r.ratio, 9)) for r in got} == want and len(got) == len(want) > 10


def test_nearest_reporting_ties_and_small_groups(spark):
    day = date(2024, 1, 1)
    data = [("BI", day, 1, 0.0, 0.0, 5.0), ("BI", day, 2, 0.1, 0.0, 6.0), ("BI", day, 3, -0.1, 0.0, 7.0), ("KA", day, 4, 0.0, 0.0, 8.0)]
    df = spark.createDataFrame(data, "county string, date date, skn long, lon double, lat double, rf double")
    got = rows(spatial.nearest_reporting(df, 2), "skn", "place", "skn_obs", "rf_obs")
    assert got == [(1, 1, 2, 6.0), (1, 2, 3, 7.0), (2, 1, 1, 5.0), (2, 2, 3, 7.0), (3, 1, 1, 5.0), (3, 2, 2, 6.0)]
    assert [r.dist_1 for r in spatial.spread_ranks(spatial.nearest_lists(df, 2), ["dist"], 2).filter("skn = 4").collect()] == [None]


@pytest.mark.parametrize("fixed", [{"nugget": 0.3}, {"range_": 0.5}, {"sill": 0.9}, {"nugget": 0.1, "range_": 0.5}, {"nugget": 0.1, "sill": 0.8}])
def test_fixed_variogram_parameters_stay(fixed):
    """What is given stays; the error is no larger than that of any point on a grid of the free ones."""
    h = np.linspace(0.1, 3, 12)
    gamma = 0.2 + 0.8 * (1 - np.exp(-h / 0.7)) + 0.05 * np.sin(9 * h)
    nugget, range_, sill, sse = kernels.fit_variogram(h, gamma, np.full(12, 50), **fixed)
    for k, v in fixed.items():
        assert {"nugget": nugget, "range_": range_, "sill": sill}[k] == pytest.approx(v)
    w = 50 / h**2
    grid = {"nugget": np.linspace(0, 1, 11), "range_": np.geomspace(0.05, 5, 30), "sill": np.linspace(0, 2, 21)}
    grid = {k: [fixed[k]] if k in fixed else v for k, v in grid.items()}
    best = min(
        (w * (n + (s - n) * (1 - np.exp(-h / r)) - gamma) ** 2).sum() for n in grid["nugget"] for r in grid["range_"] for s in grid["sill"] if s >= n
    )
    assert sse <= best * 1.02 + 1e-9


def test_all_fixed_needs_no_fit(spark):
    bins = spark.createDataFrame([("a", 0.5, 1.0, 3), ("a", 1.0, 2.0, 4)], "g string, h double, gamma double, n_pairs long")
    fixed = spark.createDataFrame([("a", 0.1, 0.4, 0.9)], "g string, nugget double, range double, sill double")
    assert rows(interpolate.fit(bins, ["g"], fixed=fixed), "nugget", "range", "sill") == [(0.1, 0.4, 0.9)]


def stations(spark, n=14, dry=False):
    rng = np.random.default_rng(4)
    data = []
    for d in (1, 2):
        for i in range(n):
            rain = 0.0 if dry or d == 2 else float(rng.gamma(2, 5))
            data.append(("BI", date(2024, 1, d), i, float(rng.random()), float(rng.random()), rain, 10.0 + i, i % 5 == 0))
    return data, spark.createDataFrame(data, "county string, date date, skn long, lon double, lat double, rf double, mean_mm double, is_fill boolean")


def test_candidate_sweep_against_brute_force(spark):
    """Every candidate's leave-one-out predictions, by leaving each station out of a kriging system of its own."""
    data, df = stations(spark)
    listed = [("BI", 1, a, 0.05, 0.4, 0.8) for a in interpolate.ADDED if a != 10000]
    params = spark.createDataFrame(listed, "county string, month int, added int, nugget double, range double, sill double")
    got = {(r.run, r.skn): r for r in interpolate.sweep(df, params).collect()}
    assert {r.date for r in got.values()} == {date(2024, 1, 1)}  # the dry day's target doesn't vary
    assert len({run for run, _ in got}) == 13 and not any(r.skn % 5 == 0 for r in got.values())
    here = [x for x in data if x[1].day == 1]
    xy, rf, mean = np.array([x[3:5] for x in here]), np.array([x[5] for x in here]), np.array([x[6] for x in here])
    for (_, skn), r in got.items():
        base = 1.0 if r.added < 0 else mean + r.added
        y = np.log(rf + 1) if r.added < 0 else np.log((rf + base) / base)
        keep = np.arange(len(rf)) != skn
        cov = kernels.covariance("exp", r.nugget, r.range, r.sill)
        w, inverse = kernels.solve_kriging(xy[keep], y[keep], cov)
        z, _ = kernels.predict(xy[keep], w, inverse, xy[skn : skn + 1], cov)
        mm = max(float((np.exp(z[0]) - 1) * (1.0 if r.added < 0 else base[skn])), 0.0)
        assert r.obs == rf[skn] and r.pred == pytest.approx(mm, rel=1e-4, abs=1e-4)


def test_daily_map_takes_each_way(spark):
    data, df = stations(spark)
    few = spark.createDataFrame([("KA", date(2024, 1, 1), 90 + i, 0.1 * i, 0.0, 3.0, 5.0, False) for i in range(4)], df.schema)
    two = spark.createDataFrame([("OA", date(2024, 1, 1), 80 + i, 0.1 * i, 0.0, 3.0 + i, 5.0, False) for i in range(2)], df.schema)
    cells = [(c, 0, i, 0.1 * i, 0.5, 4.0) for c in ("BI", "KA", "OA") for i in range(5)]
    grid = spark.createDataFrame(cells, "county string, row long, col long, lon double, lat double, mean_mm double")
    params = spark.createDataFrame([("BI", 1, a, 0.05, 0.4, 0.8) for a in interpolate.ADDED], "county string, month int, added int, nugget double, range double, sill double")
    validation, maps = interpolate.daily_map(df.unionByName(few).unionByName(two), grid, params)
    ways = {(r.county, r.date.day): r for r in validation.collect()}
    assert {k: r.method for k, r in ways.items()} == {("BI", 1): "krige", ("BI", 2): "no_rain", ("KA", 1): "idw", ("OA", 1): None}
    assert ways["OA", 1].status == "too_few" and ways["BI", 1].mae is not None
    cells_of = {}
    for r in maps.collect():
        cells_of.setdefault((r.county, r.date.day), []).append(r)
    assert {k: len(v) for k, v in cells_of.items()} == {("BI", 1): 5, ("BI", 2): 5, ("KA", 1): 5}
    assert all(r.value == 0 and r.se_backtransformed_var == -9999 for r in cells_of["BI", 2])
    assert all(r.value == pytest.approx(3.0) and r.se_anomaly == -9999 for r in cells_of["KA", 1])
    assert all(r.value >= 0 and r.se_backtransformed_var >= 0 and r.anomaly == pytest.approx(r.value / 4) for r in cells_of["BI", 1])


def test_least_bad_map_goes_by_ugliness_first(spark):
    data = [("g", "a", 0, 0.5, 2.0, 3.0, 50.0, 0.9), ("g", "b", 1, 0.5, 2.0, 3.0, 50.0, 0.7), ("h", "a", 0, 0.5, 2.0, 3.0, 50.0, 0.9), ("h", "b", 1, 0.1, 2.0, 3.0, 50.0, 0.2)]
    df = spark.createDataFrame(data, "g string, vario string, level long, r2 double, mae double, rmse double, rf_max double, prob_ugly double")
    assert rows(metrics.best_variogram(df, ["g"]), "g", "vario") == [("g", "b"), ("h", "b")]


def test_scores_round_halves_as_doubles(spark):
    """0.285 as a double lies below the half: 28 percent, as SQL's round gives, not 29."""
    df = spark.createDataFrame([("g", "a", 0, 0.285, 90.0, 80.0, 100.0, 0.5)], "g string, vario string, level long, r2 double, mae double, rmse double, rf_max double, prob_ugly double")
    assert metrics.best_variogram(df, ["g"]).first().score == pytest.approx(24.0)
    assert [one(spark, S.round_scaled("x", 2), x=x) for x in (0.285, 0.495, -0.375, 0.284)] == [0.28, 0.5, -0.38, 0.28]


def test_left_out_means_and_variograms_of_large_networks_stay_in_tiles(spark, monkeypatch):
    """Groups of more stations than a tile has equal the plain kernels, and no matrix of all pairs is asked for."""
    rng = np.random.default_rng(5)
    xy, y = np.round(rng.random((600, 2)) * 3, 2), rng.random((600, 3))
    xy[7] = xy[300]  # two stations at one place
    y[rng.random(y.shape) < 0.2] = np.nan
    monkeypatch.setattr(kernels, "TILE", (64, 100))
    asked = []
    squared = kernels._squared
    monkeypatch.setattr(kernels, "_squared", lambda a, b: asked.append(len(a) * len(b)) or squared(a, b))
    pred = kernels.left_out_means(xy, y, 2.0)
    pairs, far, gamma = kernels.semivariances_over_times(xy, y, 0.5, 4, (64, 100))
    assert max(asked) <= 6400
    for t in range(3):
        at = np.flatnonzero(~np.isnan(y[:, t]))
        d = kernels.distances(xy[at], xy[at])
        np.fill_diagonal(d, np.inf)
        assert np.allclose(pred[at, t], kernels.inverse_distance(d, y[at, t], 2.0))
        bins, n, h, g = kernels.semivariances(xy[at], y[at, t], 0.5, 4)
        assert (pairs[t, bins] == n).all() and pairs[t].sum() == n.sum()
        assert np.allclose(far[t, bins] / n, h) and np.allclose(gamma[t, bins] / n, g)


def test_neighbours_of_large_networks_come_from_lists(monkeypatch):
    """Stations of many equal places: lists that all times share give what all distances give, and few distances are worked out."""
    skn = np.arange(2000)
    lon, lat = -160 + (skn * 37 % 50) / 10, 18.9 + (skn * 53 % 33) / 10
    want = kernels._all_nearest(skn, lon, lat, 10, 3)
    lists = kernels.lists_of(lon, lat, 0.5, 10, 3)
    monkeypatch.setattr(kernels, "great_circle", None)
    got = kernels.nearest(skn, lon, lat, 10, 3)
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()
    monkeypatch.undo()
    present = np.flatnonzero(np.random.default_rng(1).random(2000) < 0.5)
    starts, place, dist = kernels.nearest_present(lists, present, lon, lat, 10, 3)
    want = kernels._all_nearest(np.arange(len(present)), lon[present], lat[present], 10, 3)
    assert (place == present[want[0]].ravel()).all() and (dist == want[1].ravel()).all() and (np.diff(starts) == 10).all()


def test_pairs_of_one_county_are_dealt_over_tasks(spark):
    places = spark.createDataFrame([("MN", i, -156 + i / 100, 20.0) for i in range(60)], "county string, skn long, lon double, lat double").coalesce(1)
    got = spatial.pair_distances(places).withColumn("task", F.spark_partition_id())
    assert got.count() == 60 * 59 and got.select("task").distinct().count() > 1


def test_nearest_station_is_looked_up_and_not_tried_for_every_cell(spark):
    rng = np.random.default_rng(3)
    lon, lat = -160 + rng.random(700) * 5, 19 + rng.random(700) * 3
    points = spark.createDataFrame([("MN", float(x), float(y)) for x, y in zip(lon, lat, strict=True)], "county string, lon double, lat double")
    cells = [("MN", i, i % 20, -160 + i % 20 / 4, 19 + i // 20 % 10 / 4) for i in range(400)]  # two layers of 200 places
    got = spatial.nearest_distance(spark.createDataFrame(cells, "county string, row long, col long, lon double, lat double"), points)
    assert "collect_list" not in got._jdf.queryExecution().toString()
    want = {c[1]: kernels.great_circle(np.array([c[3]]), np.array([c[4]]), lon, lat).min() for c in cells}
    assert {r.row: r.dist for r in got.collect()} == pytest.approx(want)


def test_layers_of_a_grid_share_the_maps_of_their_places(spark):
    data, df = stations(spark)
    rows_ = df.filter("county = 'BI'")
    cells = [("BI", t, i, 0.1 * i, 0.5) for t in range(6) for i in range(5)]
    layers = spark.createDataFrame(cells, "county string, row long, col long, lon double, lat double")
    got = interpolate.idw(layers, rows_, ["county"], ["date"])
    assert "_place" in got._jdf.queryExecution().toString()
    one_layer = {(r.date, r.col): r.value for r in interpolate.idw(layers.filter("row = 0"), rows_, ["county"], ["date"]).collect()}
    found = got.collect()
    assert len(found) == 6 * len(one_layer) and all(r.value == pytest.approx(one_layer[r.date, r.col]) for r in found)


def test_correlation_flags_of_maps(spark):
    rng = np.random.default_rng(2)
    d = np.sort(rng.random(200) * 3000)
    cells = [("m", float(v), float(0.01 * x + v), 1.0, float(i % 2), float(-x), float(x)) for i, (x, v) in enumerate(zip(d, rng.random(200) * 4 - 1, strict=True))]
    df = spark.createDataFrame(cells, "g string, value double, slope double, roughness double, tri double, curvature double, dist double")
    r = quality.map_features(df, ["g"]).first()
    assert r.negative and r.n_cells == 200 and r.n_near == int((d < 1000).sum())
    assert r.slope_p and r.curvature_cor == pytest.approx(-1) and r.roughness_cor is None
    n, cor = 200, np.corrcoef([c[2] for c in cells], d)[0, 1]
    assert r.slope_r2 == pytest.approx(1 - (1 - cor**2) * (n - 1) / (n - 2))
    assert abs(np.corrcoef([c[4] for c in cells], d)[0, 1]) < 0.14 and not r.tri_p


def test_month_check_counts_accumulator_totals(spark):
    days = [(i, "BI", date(2024, 2, d), 1.0 if i or d > 3 else None) for i in range(5) for d in range(1, 30)]
    df = spark.createDataFrame(days, "skn long, county string, date date, rf double")
    months = spark.createDataFrame([(i, "BI", date(2024, 2, 1), 30.0) for i in range(6)], "skn long, county string, month date, rf double")
    names = ("county", "n_stations", "n_complete", "n_accumulated", "n_total", "qc", "enough", "n_missing", "missing")
    assert rows(monthly.completeness(df, months), *names) == [(c, 5, 4, 2, 6, False, True, 0, "") for c in ("All", "BI")]
    gone = monthly.completeness(df.filter("dayofmonth(date) <> 9"), months)
    assert rows(gone, *names) == [(c, 5, 0, 2, 2, False, False, 1, "2024-02-09") for c in ("All", "BI")]


def test_network_feeds_by_name(spark, tmp_path):
    (tmp_path / "20240102_hads_parsed.csv").write_text("random,staID,NWS_sid,var,obs_time,value\n,a1,X,PC,2024-01-02 10:05,2\nR,a1,X,PC,2024-01-02 10:10,3\n ,a1,X,TA,2024-01-02 10:15,4\n,a1,X,PP,bad,4\n")
    got = tables.rain_of_feed(tables.read_network_feed(spark, f"file://{tmp_path}", "hads"), "hads").collect()
    assert [(r.station, r.name, r["var"], r.ts, round(r.value, 3), r.file_day) for r in got] == [("a1", "X", "PC", datetime(2024, 1, 2, 10, 5), 50.8, date(2024, 1, 2))]
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "20240103_madis_parsed.csv").write_text("stationId,dataProvider,varname,time,value\nS,RAWS,rawPrecip,2024-01-03 00:00,1.5\nS,HF-METAR,rawPrecip,2024-01-03 00:00,1.5\n")
    rows_ = tables.rain_of_feed(tables.read_network_feed(spark, f"file://{tmp_path}/m", "madis"), "madis").collect()
    assert [(r.provider, r.value) for r in rows_] == [("RAWS", 1.5)]


def test_batches_of_a_day_are_merged(spark):
    from rainspark.streaming import stream

    schema = "station long, ts timestamp_ntz, seq long, value double, date date"
    source, path = tables.scratch(spark, "source"), tables.scratch(spark, "sink")
    for seq in (1, 2):
        spark.createDataFrame([(1, T0, seq, float(seq), date(2024, 1, 2))], schema).coalesce(1).write.mode("append").parquet(source)
    for _ in range(2):
        df = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        stream.upsert_sink(df, path, tables.scratch(spark, "check")).awaitTermination()
    assert rows(spark.read.parquet(path), "seq", "value") == [(1, 1.0), (2, 2.0)]
