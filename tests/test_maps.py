"""Grids: terrain by blocks, maps of large grids, and the monthly maps, each against plain loops."""

import re
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from rainspark.functions import kernels
from rainspark.operators import interpolate, spatial


def slope_at(v, r, c, dx, dy):
    cells = [v.get((r + i, c + j)) for i in (-1, 0, 1) for j in (-1, 0, 1)]
    if any(x is None for x in cells):
        return None
    a, b, cc, d, _, f, g, h, i = cells
    east = (cc + 2 * f + i - a - 2 * d - g) / (8 * dx)
    south = (g + 2 * h + i - a - 2 * b - cc) / (8 * dy)
    return float(np.degrees(np.arctan(np.hypot(east, south))))


@pytest.mark.parametrize("block", [3, 5, 64])
def test_terrain_in_blocks_against_cell_by_cell(spark, block):
    rng = np.random.default_rng(4)
    v = {(r, c): float(rng.random() * 50) for r in range(-7, 9) for c in range(11) if rng.random() > 0.04}
    rows = [("m", r, c, x, r * 100 + c) for (r, c), x in v.items()] + [("n", 0, 0, 1.0, 5), ("m", 3, 3, None, 1), ("m", 0, 0, v.get((0, 0), 1.0) - 1, 2)]
    v.setdefault((0, 0), 0.0)
    df = spark.createDataFrame(rows, "k string, row long, col long, value double, tag int")
    got = {(r.row, r.col): r for r in spatial.terrain(df, 0.5, 0.7, ("k",), ("tag",), block).collect()}
    slopes = {(r, c): slope_at(v, r, c, 0.5, 0.7) for r, c in v}
    assert set(got) == {k for k, s in slopes.items() if s is not None} and len(got) > 30
    for (r, c), g in got.items():
        near = [v[r + i, c + j] for i in (-1, 0, 1) for j in (-1, 0, 1)]
        want = slopes[r, c], max(near) - min(near), sum(abs(x - v[r, c]) for x in near) / 8
        assert (g.k, g.value) == ("m", v[r, c]) and (g.slope, g.roughness, g.tri) == pytest.approx(want)
        assert g.curvature == pytest.approx(slope_at({k: s for k, s in slopes.items() if s is not None}, r, c, 0.5, 0.7))
        assert g.tag == r * 100 + c
    assert any(g.curvature is None for g in got.values()) and any(g.curvature is not None for g in got.values())


def test_a_cell_of_terrain_is_shuffled_once(spark):
    df = spark.range(10000).select(F.lit("m").alias("k"), (F.col("id") / 100).cast("long").alias("row"), (F.col("id") % 100).alias("col"), F.col("id").cast("double").alias("value"))
    plan = spatial.terrain(df, 1.0, 1.0, ("k",))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    flat = spatial.terrain(df, 1.0, 1.0, ("k",)).agg(F.count("*"), F.min("roughness"), F.max("roughness")).first()
    assert tuple(flat) == (98 * 98, 202.0, 202.0)


def stations_and_cells(spark, counties=("BI", "OA"), n=9, side=6, months=3):
    rng = np.random.default_rng(5)
    points = [(c, date(2024, m + 1, 1), 10 * i + k, float(rng.random()), float(rng.random()), float(rng.gamma(2, 4)), 3.0 + i) for i, c in enumerate(counties) for m in range(months) for k in range(n)]
    cells = [(c, r, q, r / side, q / side, 2.0 + r) for c in counties for r in range(side) for q in range(side)]
    return (
        points, spark.createDataFrame(points, "county string, month date, skn long, lon double, lat double, rf double, mean_mm double"),
        cells, spark.createDataFrame(cells, "county string, row long, col long, lon double, lat double, mean_mm double"),
    )


def test_large_grids_have_no_county_as_their_only_key(spark, monkeypatch):
    _, points, _, cells = stations_and_cells(spark, n=7, side=9, months=5)
    fitted = points.withColumns({"y": F.col("rf"), "nugget": F.lit(0.1), "range": F.lit(0.5), "sill": F.lit(2.0)})

    def maps():
        a = interpolate.idw(cells, points, ["county"], ["month"], block_cells=10, carry=("mean_mm",))
        return a, interpolate.krige(fitted, cells, ["county"], ["month"], block_cells=10, carry=("mean_mm",))

    small = [sorted(tuple(r) for r in m.collect()) for m in maps()]
    assert len(small[0]) == 2 * 5 * 81 and all("Broadcast" in m._jdf.queryExecution().executedPlan().toString() for m in maps())
    monkeypatch.setattr(interpolate, "BROADCAST_CELLS", 10)
    monkeypatch.setattr(interpolate, "SPAN_TILES", 2)
    for m, want in zip(maps(), small, strict=True):
        plan = m._jdf.queryExecution().executedPlan().toString()
        keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
        assert keys and all(len(re.findall(r"#\d+", k)) > 1 for k in keys), keys
        got = sorted(tuple(r) for r in m.collect())
        assert [r[:4] for r in got] == [r[:4] for r in want]
        assert np.allclose([r[4:] for r in got], [r[4:] for r in want], atol=1e-9)


def plain_kriging(xy, y, cov, to):
    """Prediction and variance at one place, from a system of its own."""
    n = len(xy)
    k = np.ones((n + 1, n + 1))
    k[:n, :n] = cov(kernels.distances(xy, xy)) + 1e-9 * np.eye(n)
    k[n, n] = 0
    right = np.append(cov(kernels.distances(to[None, :], xy))[0], 1.0)
    w = np.linalg.solve(k, right)
    return float(w[:n] @ y), max(float(cov(np.zeros(1))[0] - w @ right), 0.0)


def test_monthly_maps_by_hand(spark):
    """Three counties: one has a good map at the first level, one at the second only, one at none."""
    counties = ("BI", "KA", "OA")
    data, df, _, _ = stations_and_cells(spark, counties, n=8, months=1)
    data += [("MN", date(2024, 1, 1), 90, 0.1, 0.1, 3.0, 4.0), ("MN", date(2024, 1, 1), 91, 0.2, 0.1, 3.0, 4.0)]
    points = interpolate.monthly_points(spark.createDataFrame(data, df.schema))
    cells = [(c, m, r, q, 0.3 * r, 0.4 * q, 0.0 if r == 0 and q == 0 else 5.0 * m + r) for c in counties for m in (1, 2) for r in range(3) for q in range(2)]
    grid = spark.createDataFrame(cells, "county string, moy int, row long, col long, lon double, lat double, mean_mm double")
    params = spark.createDataFrame([(c, lv, 0.02 * (lv + 1), 0.3 * (lv + 1)) for c in (*counties, "MN") for lv in (0, 1, 2)], "county string, level long, nug double, rng double")
    seen = []

    def classify(maps):
        keys = ["county", "month", "vario", "level"]
        seen.append({(r.county, r.level) for r in maps.select("county", "level").distinct().collect()})
        ugly = F.when(F.col("county") == "BI", 0.1).when((F.col("county") == "KA") & (F.col("level") == 1), 0.2).when(F.col("vario") == "vari_fix_rng_2", 0.7).otherwise(0.9)
        return maps.select(*keys).distinct().withColumn("prob_ugly", ugly)

    grids, validation, loo = interpolate.monthly_map(points, params, grid, classify, bins=4, width=0.4)
    assert seen == [{("BI", 0), ("KA", 0), ("OA", 0)}, {("KA", 1), ("OA", 1)}, {("OA", 2)}]
    tried = {(r.county, r.vario): r for r in validation.collect()}
    assert {c: sum(k[0] == c for k in tried) for c in (*counties, "MN")} == {"BI": 4, "KA": 7, "OA": 10, "MN": 0}
    best = {c: r for (c, _), r in tried.items() if r.chosen}
    assert set(best) == set(counties) and best["KA"].level == 1 and best["BI"].level == 0
    stations = {c: [x for x in data if x[0] == c] for c in counties}
    made = {}
    for r in grids.collect():
        made[r.county, r.row, r.col] = r
        assert r.vario == best[r.county].vario
    assert len(made) == 3 * 6  # cells of January only
    for c, moy, row, col, lon, lat, mean in cells:
        if moy != 1:
            continue
        p = best[c]
        cov = kernels.covariance("matern32", p.nugget, p.range, p.sill)
        xy, m = np.array([x[3:5] for x in stations[c]]), np.array([x[6] for x in stations[c]])
        y = np.log(np.array([x[5] for x in stations[c]]) / m + 1)
        z, var = plain_kriging(xy, y, cov, np.array([lon, lat]))
        g, mm, se = made[c, row, col], (np.exp(z) - 1) * mean, (np.exp(var) - 1) * mean
        assert (g.value, g.se_backtransformed_var) == pytest.approx((max(mm, 0.0), se), rel=1e-5, abs=1e-5)
        assert (g.anomaly, g.se_anomaly) == pytest.approx((mm / (mean + 1e-8), se / (mean + 1e-8)), rel=1e-5, abs=1e-5)
    left_out = loo.collect()
    assert len(left_out) == 3 * 8
    for r in left_out:
        xy, m = np.array([x[3:5] for x in stations[r.county]]), np.array([x[6] for x in stations[r.county]])
        y = np.log(np.array([x[5] for x in stations[r.county]]) / m + 1)
        i = [x[2] for x in stations[r.county]].index(r.skn)
        keep = np.arange(8) != i
        p = best[r.county]
        z, _ = plain_kriging(xy[keep], y[keep], kernels.covariance("matern32", p.nugget, p.range, p.sill), xy[i])
        mm = (np.exp(z) - 1) * m[i]
        assert r.pred == pytest.approx(max(mm, 0.0), rel=1e-4, abs=1e-4) and r.was_negative == (round(mm, 10) < 0)
        assert r.obs_anomaly == pytest.approx(stations[r.county][i][5] / m[i]) and r.pred_anomaly == pytest.approx(mm / (m[i] + 1e-8), rel=1e-4, abs=1e-4)
    for c in counties:
        mine = [r for r in left_out if r.county == c]
        assert best[c].mae == pytest.approx(np.mean([abs(r.obs - r.pred) for r in mine])) and best[c].n == 8
        assert best[c].bias_anomaly == pytest.approx(np.mean([r.obs_anomaly - r.pred_anomaly for r in mine]))
    state = spatial.mosaic(grids, ("month", "row", "col")).collect()
    assert len(state) == 6 and all(s.value == max(made[c, s.row, s.col].value for c in counties) for s in state)


def test_stacked_systems_equal_single_ones():
    rng = np.random.default_rng(6)
    for n in (2, 5, 12):
        xy = rng.random((9, n, 2))
        xy[3, 1] = xy[3, 0]  # two stations at one place, and no nugget: a singular system
        y = rng.random((9, n))
        params = np.stack([rng.random(9) / 5, rng.random(9) + 0.1, rng.random(9) + 0.5], 1)
        params[3, 0] = 0.0
        d = np.sqrt(((xy[:, :, None] - xy[:, None, :]) ** 2).sum(-1))
        got = kernels.stacked_leave_one_out(d, y, params, "matern52")
        for i in range(9):
            if i != 3:
                want = kernels.leave_one_out(xy[i], y[i], kernels.covariance("matern52", *params[i]))
                assert np.allclose(got[i], want, atol=1e-6)
        pairs, h, gamma = kernels.stacked_semivariances(d, np.stack([y, 2 * y], 1), 0.2, 4)
        for i in range(9):
            some, count, mean, half = kernels.semivariances(xy[i], y[i], 0.2, 4)
            assert np.flatnonzero(pairs[i]).tolist() == some.tolist() and np.allclose(pairs[i][some], count) and np.allclose(h[i][some], mean)
            assert np.allclose(gamma[i, 0][some], half) and np.allclose(gamma[i, 1], 4 * gamma[i, 0])
            if len(some) and i != 3:
                for model in ("exp", "matern32"):
                    fit = kernels.stacked_fits(h[i : i + 1], gamma[i, :1], pairs[i : i + 1], model)[0]
                    single = kernels.fit_variogram(mean, half, count, model)
                    shape = 1 - kernels.SHAPES[model](mean / fit[1])
                    error = (count / mean**2 * (fit[0] + (fit[2] - fit[0]) * shape - half) ** 2).sum()
                    assert error == pytest.approx(single[3], rel=1e-6, abs=1e-12)  # a few bins can be met in many ways
                    assert single[3] < 1e-9 or np.allclose(fit, single[:3], rtol=1e-4, atol=1e-6)
    none = kernels.stacked_fits(np.zeros((1, 4)), np.zeros((1, 4)), np.zeros((1, 4)), "exp")
    assert np.isnan(none).all()
