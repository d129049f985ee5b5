"""Forests as arrays, and screening of station-days against removal in lock step with everything worked out anew."""

from datetime import date

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from rainspark.functions import kernels
from rainspark.operators import quality

VALUES = ("rf", "prob", "prob_year")


def station_days(spark, seed=3, n=70, days=3):
    """Two counties; a third of the stations of BI have rain far from their neighbours'."""
    rng = np.random.default_rng(seed)
    data = []
    for c, county in enumerate(("BI", "OA")):
        lon, lat = -156 + rng.random(n), 19 + rng.random(n)
        for d in range(1, days + 1):
            rain = 10 + 5 * np.sin(3 * lon) + rng.random(n)
            bad = (rng.random(n) < (0.9 if county == "BI" else 0.1)) & (np.arange(n) % 2 == 0)
            rain = np.where(bad, rain + 40 + 100 * rng.random(n), rain)
            rain[rng.random(n) < 0.1] = 0.0
            for i in range(n):
                data.append((county, date(2024, 1, d), 1000 * c + i, float(lon[i]), float(lat[i]), float(rain[i]), float(rng.random()), None if i == 4 else 0.5, bool(bad[i] and rain[i] > 0)))
    data += [("KA", date(2024, 1, 1), 5000 + i, -155.0 + i / 50, 20.0, 500.0, 0.1, 0.2, False) for i in range(9)]
    return spark.createDataFrame(data, "county string, date date, skn long, lon double, lat double, rf double, prob double, prob_year double, bad boolean")


@pytest.fixture(scope="module")
def trained(spark):
    df = station_days(spark)
    rows = quality.features(df.drop("bad"), VALUES).join(df.select("county", "date", "skn", "bad"), ["county", "date", "skn"])
    cols = quality.feature_columns(VALUES)
    return df.drop("bad"), cols, quality.train_bad_value(rows, cols, trees=7), rows


def test_flat_forest_equals_the_fitted_one(spark, trained):
    _, cols, _, rows = trained
    ready = quality._assembled(rows, cols).withColumn("label", F.col("bad").cast("double"))
    model = RandomForestClassifier(numTrees=9, maxDepth=6, seed=3, labelCol="label", featuresCol="features").fit(ready)
    got = model.transform(ready).select(vector_to_array("features").alias("x"), vector_to_array("probability")[1].alias("p")).collect()
    flat = quality.flat_forest(model)
    assert len(flat.roots) == 9 and np.allclose(flat.probability(np.array([r.x for r in got])), [r.p for r in got])
    assert len({round(r.p, 6) for r in got}) > 5


def test_scores_of_all_counties_in_one_pass(spark, trained):
    df, cols, forests, rows = trained
    assert {k for k in forests} == {("BI", True), ("OA", True)}
    scored = quality.score_bad_value(rows.withColumn("_extra", F.lit(1)), forests, cols)
    assert scored._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    for r in scored.collect():
        x = np.array([[-1.0 if r[c] is None else float(r[c]) for c in cols]])
        want = forests[r.county, True].probability(x)[0] if r.rf > 0 and r.county != "KA" else 0.0
        assert r.prob_bad == pytest.approx(want) and r.bad_class == (want > 0.5)


@pytest.mark.parametrize("least", [11, 40])
def test_screening_equals_rounds_in_lock_step(spark, trained, least):
    df, cols, forests, _ = trained
    places = df.select("county", "date", "skn", "lon", "lat", "prob", "prob_year")

    def score(live):
        again = quality.features(live.join(places, ["county", "date", "skn"]), VALUES)
        return quality.score_bad_value(again, forests, cols).select("county", "date", "skn", "rf", "prob_bad", "bad_class")

    want = {(r.county, r.date, r.skn): r for r in quality.screen(df, score, least=least).collect()}
    made = quality.screen_days(df, forests, VALUES, least=least)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FlatMapGroupsInArrow") == 1 and plan.count("Exchange hashpartitioning") == 1
    got = {(r.county, r.date, r.skn): r for r in made.collect()}
    assert set(got) == set(want)
    for key, r in got.items():
        assert (r.rf, r.status, r["round"]) == (want[key].rf, want[key].status, want[key]["round"]), key
        if r.status == "fail":
            assert r.prob_bad == pytest.approx(want[key].prob_bad)
    removed = [r for r in got.values() if r.status == "fail"]
    assert max(sum(r.county == "BI" and r.date == d for r in removed) for d in {r.date for r in removed}) > 20 or least == 40
    assert all(r.status == "pass" and r.prob_bad is None for k, r in got.items() if k[0] == "KA")


def test_lists_of_candidates_are_made_again():
    """With hardly any spare neighbours the lists run out; the result is that of full lists."""
    rng = np.random.default_rng(8)
    n = 60
    lon, lat, values = rng.random(n), rng.random(n), rng.random((n, 2))
    calls = []

    def score(rows, x):
        calls.append(len(rows))
        return np.where(values[rows, 0] > 0.35, 0.5 + values[rows, 0] / 4 + np.abs(x[:, 2:5]).sum(1) % 1 / 100, 0.1)

    one = kernels.screen_group(np.arange(n), lon, lat, values, score, 3, 10, 3, spare=0)
    few = sum(calls)
    calls.clear()
    two = kernels.screen_group(np.arange(n), lon, lat, values, score, 3, 10, 3, spare=n)
    assert one[0].tolist() == two[0].tolist() and np.allclose(one[1], two[1])
    assert one[0].max() > 20 and few == sum(calls) < n * (one[0].max() + 1) / 4
