"""Every registered query against its SQL on the smallest tables."""

import math

import duckdb
import pytest

from rainspark.plans import catalog

SF = "/root/testdata/sf0.001"
#: Queries whose maps need more cells or stations than the smallest tables have.
LARGER = {"k5_candidate_sweep", "k9_daily_maps", "k11_bad_value_classifier", "k12_iterative_removal", "k16_map_class", "k17_monthly_kriging", "k17_monthly_state_maps"}
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}" if v else "0"
    return str(v)[:19].replace(" 00:00:00", "") if hasattr(v, "isoformat") else str(v)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_its_sql(spark, con, name):
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    result = con.execute(catalog.ORACLES[name])
    names = [x[0] for x in result.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    want = sorted(tuple(plain(r[i]) for i in at) for r in result.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES) - LARGER))
def test_query_runs(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_forests_find_errors_that_they_have_not_seen(spark):
    """Of the injected errors on days kept out of the training most are flagged, and hardly any good value."""
    rows = catalog.QUERIES["k11_bad_value_classifier"](spark, SF.replace("0.001", "0.01")).collect()
    n = {bad: [sum(r[c] for r in rows if r.bad == bad) for c in ("n", "flagged")] for bad in (True, False)}
    assert n[True][0] > 100 and n[True][1] > 0.75 * n[True][0]
    assert n[False][1] < 0.01 * n[False][0]


def test_forest_tells_chequered_maps_from_others(spark):
    """Maps of months kept out of the training."""
    rows = catalog.QUERIES["k16_map_class"](spark, SF.replace("0.001", "0.01")).collect()
    right = sum((r.ugly_class == "ugly") == r.ugly for r in rows)
    assert len(rows) > 100 and {r.ugly for r in rows} == {True, False} and right > 0.9 * len(rows)


def test_daily_and_monthly_drivers_on_larger_tables(spark):
    """Every county and time comes out, with a run that was tried and figures that fit each other."""
    d = SF.replace("0.001", "0.01")
    best = catalog.QUERIES["k5_candidate_sweep"](spark, d).collect()
    assert len(best) > 5000 and len({r.run for r in best}) == 14 and all(r.mae >= 0 for r in best)
    daily = catalog.QUERIES["k9_daily_maps"](spark, d).collect()
    assert {r.method for r in daily} >= {"krige", "no_rain"} and all((r.n_cells is None) == (r.method is None) for r in daily)
    assert {(r.county, r.date, r.mae) for r in best} == {(r.county, r.date, r.mae) for r in daily if r.method == "krige"}
    removed = catalog.QUERIES["k12_iterative_removal"](spark, d).filter("status = 'fail'").collect()
    assert len(removed) > 50 and all(r.prob_bad > 0.5 for r in removed)
    monthly = catalog.QUERIES["k17_monthly_kriging"](spark, d).collect()
    chosen = [r for r in monthly if r.chosen]
    assert len({(r.county, r.month) for r in monthly}) == len(chosen) > 300
    assert all(r.n_negative == 0 or r.rf_min < 0 for r in monthly)
    assert {r.level for r in monthly} == {0} or any(r.prob_ugly > 0.5 for r in monthly)
