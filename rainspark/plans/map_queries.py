"""Queries over space: distances, neighbours, grids, interpolation, metrics, choices, quality control and models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainspark.functions import scalars as S
from rainspark.operators import interpolate as I
from rainspark.operators import metrics as M
from rainspark.operators import quality as Q
from rainspark.operators import spatial as P
from rainspark.plans import testdata as D
from rainspark.plans.registry import query
from rainspark.plans.testdata import sql
from rainspark.sources import tables

HAV = ("2 * 6371008.8 * asin(sqrt(least(pow(sin(radians({b}lat - {a}lat) / 2), 2) + cos(radians({a}lat)) * cos(radians({b}lat)) "
       "* pow(sin(radians({b}lon - {a}lon) / 2), 2), 1.0)))")  # fmt: skip
CELL = ("tile", "row", "col")
PLANAR = "sqrt(({b}lon - {a}lon) * ({b}lon - {a}lon) + ({b}lat - {a}lat) * ({b}lat - {a}lat))"


def hav(a: str, b: str) -> str:
    return HAV.format(a=a, b=b)


def planar(a: str, b: str) -> str:
    return PLANAR.format(a=a, b=b)


def places(spark, d) -> DataFrame:
    return D.meta(spark, d).select("skn", "county", "lon", "lat")


def month_points(spark, d) -> DataFrame:
    """Station-months with place and fill flag (every seventh station counts as filled)."""
    return D.station_month(spark, d).withColumn("is_fill", F.col("skn") % 7 == 0)


POINTS = "pts AS (SELECT *, skn % 7 = 0 AS is_fill FROM station_month)"


@query(sql("station_day", "SELECT s.skn, s.date, s.rf, r.skn IS NULL AS is_fill FROM station_day s LEFT JOIN "
           "(SELECT DISTINCT l_suppkey AS skn, CAST(l_shipdate AS DATE) AS date FROM lineitem WHERE l_linenumber <= 4) r "
           "ON r.skn = s.skn AND r.date = s.date"))  # fmt: skip
def c10_real_or_filled(spark, d):
    raw = D.table(spark, d, "lineitem").filter("l_linenumber <= 4")
    raw = raw.select(F.col("l_suppkey").alias("skn"), F.to_date("l_shipdate").alias("date"))
    return I.flag_real(D.station_day(spark, d), raw).select("skn", "date", "rf", "is_fill")


@query(sql("meta", f"SELECT a.county, a.skn, b.skn AS skn_obs, round({hav('a.', 'b.')}, 3) AS dist FROM meta a JOIN meta b "
           "ON a.county = b.county AND a.skn <> b.skn"))  # fmt: skip
def c11_h6_pair_distances(spark, d):
    return P.pair_distances(places(spark, d)).withColumn("dist", F.floor(F.col("dist") * 1000 + 0.5) / 1000)  # Spark's round goes by way of decimals


NEAR = f"""pr AS (SELECT a.skn, b.skn AS skn_obs, round({hav('a.', 'b.')}, 3) AS dist FROM meta a JOIN meta b ON a.county = b.county AND a.skn <> b.skn),
near AS (SELECT x.date, x.skn, pr.skn_obs, dist, y.rf AS rf_obs, row_number() OVER (PARTITION BY x.date, x.skn ORDER BY dist, pr.skn_obs) AS place
FROM station_day x JOIN pr ON pr.skn = x.skn JOIN station_day y ON y.skn = pr.skn_obs AND y.date = x.date QUALIFY place <= 10)"""  # fmt: skip


@query(sql("station_day meta", f"WITH {NEAR} SELECT date, skn, skn_obs, place, dist, rf_obs FROM near"))
def e8_c12_nearest_ten(spark, d):
    got = P.nearest_reporting(D.placed_days(spark, d))
    return got.select("date", "skn", "skn_obs", F.col("place").cast("long").alias("place"), "dist", "rf_obs")


NEAR_PROB = NEAR.replace("y.rf AS rf_obs", "y.rf AS rf_obs, y.prob AS prob_obs, y.prob_year AS prob_year_obs").replace("station_day", "prob_day")
WIDE = ", ".join(
    f"round(max(CASE WHEN place = {i} THEN {v} END), 6) AS {v}_{i}" for v in ("dist", "rf_obs", "prob_obs", "prob_year_obs") for i in range(1, 11)
)


def _qc_days(spark, d) -> DataFrame:
    """Station-days with place and both probabilities."""
    return Q.probabilities(D.in_cell(D.placed_days(spark, d)), D.rain_params(spark, d)).drop("row", "col")


@query(sql("prob_day", f"WITH {NEAR_PROB} SELECT s.date, s.skn, s.rf, round(s.prob, 6) AS prob, round(s.prob_year, 6) AS prob_year, "
           f"w.* EXCLUDE (date, skn) FROM prob_day s LEFT JOIN (SELECT date, skn, {WIDE} FROM near GROUP BY 1, 2) w ON w.date = s.date AND w.skn = s.skn"))  # fmt: skip
def k10_qc_features(spark, d):
    days = _qc_days(spark, d).withColumns({c: F.round(c, 6) for c in ("prob", "prob_year")})  # once, not in every neighbour's column
    return Q.features(days).drop("county")


@query(sql("station_month", f"WITH {POINTS} SELECT county, month, skn, row_number() OVER (PARTITION BY county, month ORDER BY is_fill, "
           "CASE WHEN skn % 3 = 0 THEN 1 WHEN skn % 3 = 1 THEN 2 ELSE 2147483647 END, skn) AS rank FROM pts"))  # fmt: skip
def e14_source_rank(spark, d):
    return _ranked(spark, d).select("county", F.col("date").alias("month"), "skn", F.col("rank").cast("long").alias("rank"))


def _ranked(spark, d):
    names = F.array(*(F.lit(x) for x in ("uhmeso", "hads", "x")))
    pts = month_points(spark, d).withColumnRenamed("month", "date").withColumn("network", F.get(names, (F.col("skn") % 3).cast("int")))
    return P.source_rank(pts, ["uhmeso", "hads"])


@query(sql("station_month", f"""WITH {POINTS}, r AS (SELECT *, row_number() OVER (PARTITION BY county, month ORDER BY is_fill,
  CASE WHEN skn % 3 = 0 THEN 1 WHEN skn % 3 = 1 THEN 2 ELSE 2147483647 END, skn) AS rank FROM pts)
SELECT county, month, skn FROM r WHERE NOT EXISTS (SELECT 1 FROM r b WHERE b.county = r.county AND b.month = r.month AND b.rank < r.rank
  AND {planar('r.', 'b.')} <= 0.333)"""))  # fmt: skip
def c13_h7_near_duplicates(spark, d):
    return P.drop_near(_ranked(spark, d), 0.333).select("county", F.col("date").alias("month"), "skn")


@query(sql("cells meta", "SELECT m.skn, c.tile, c.value FROM (SELECT *, CAST(floor((22.2 - lat) / 0.1) AS BIGINT) AS row, "
           "CAST(floor((lon + 160.0) / 0.1) AS BIGINT) AS col FROM meta) m JOIN cells c ON c.row = m.row AND c.col = m.col"))  # fmt: skip
def c14_extract_at_stations(spark, d):
    at = P.cell_of(places(spark, d).select("skn", "lon", "lat"), D.WEST, D.NORTH, D.STEP)
    return P.extract(at.select("skn", "row", "col"), D.cells(spark, d)).select("skn", "tile", "value")


@query(sql("station_day vario_params", "SELECT g.county, date, a.added, nugget, range, sill FROM (SELECT DISTINCT county, date FROM station_day) g "
           "CROSS JOIN (VALUES (-1), (0), (1), (10), (100), (1000), (10000)) a(added) LEFT JOIN vario_params p ON p.county = g.county "
           "AND p.month = month(date) AND p.added = a.added"))  # fmt: skip
def c15_variogram_parameters(spark, d):
    groups = D.station_day(spark, d).select("county", "date").distinct()
    runs = groups.select("county", "date", F.month("date").alias("month"), F.explode(F.array(*(F.lit(x) for x in I.ADDED))).alias("added"))
    return I.lookup_params(runs, D.vario_params(spark, d)).drop("month")


IDW = f"""w AS (SELECT c.county, s.month, c.tile, c.row, c.col, s.rf, {planar('c.', 's.')} AS dd FROM cells c JOIN station_month s ON s.county = c.county),
  idw AS (SELECT county, month, tile, row, col, coalesce(min(CASE WHEN dd = 0 THEN rf END),
  sum(CASE WHEN dd > 0 THEN rf / pow(dd, 2) END) / sum(CASE WHEN dd > 0 THEN 1 / pow(dd, 2) END)) AS value FROM w GROUP BY 1, 2, 3, 4, 5)"""  # fmt: skip


def _idw(spark, d):
    """Maps of every county and month on all cells."""
    grid = D.cells(spark, d).select("county", *CELL, "lon", "lat")
    return I.idw(grid, D.station_month(spark, d), ["county"], ["month"], cell=CELL)


@query(sql("cells station_month", f"WITH {IDW} SELECT county, month, tile, row, col, round(value, 5) AS value FROM idw"))
def k6_c16_idw_map(spark, d):
    return _idw(spark, d).withColumn("value", F.round("value", 5))


LOO = f"""loo AS (SELECT a.county, a.month, a.skn, a.rf AS obs, sum(b.rf / pow({planar('a.', 'b.')}, 2)) / sum(1 / pow({planar('a.', 'b.')}, 2)) AS pred
  FROM pts a JOIN pts b ON a.county = b.county AND a.month = b.month AND a.skn <> b.skn WHERE NOT a.is_fill GROUP BY 1, 2, 3, 4)"""  # fmt: skip


def _points_apart(spark, d):
    """Points at distinct places (stations repeat places every 500 numbers)."""
    return month_points(spark, d).withColumn("lon", F.col("lon") + F.col("skn") / 1e5)


APART = "pts AS (SELECT skn, month, rf, county, lon + skn / 1e5 AS lon, lat, skn % 7 = 0 AS is_fill FROM station_month)"


@query(sql("station_month", f"WITH {APART}, {LOO} SELECT county, month, skn, obs, round(pred, 5) AS pred FROM loo"))
def k7_idw_leave_one_out(spark, d):
    got = I.idw_loo(_points_apart(spark, d), ["county", "month"])
    return got.withColumn("pred", F.round("pred", 5))


STATUS = """st AS (SELECT county, date, count(*) AS n, max(CASE WHEN skn % 7 <> 0 THEN rf END) AS top_real, max(rf) AS top, var_samp(rf) AS v FROM station_day GROUP BY 1, 2),
ways AS (SELECT county, date, n, CASE WHEN coalesce(top_real, 0) = 0 OR top = 0 THEN 'no_rain' WHEN n < 3 THEN 'too_few'
  WHEN coalesce(v, 0) < 1e-10 THEN 'flat' ELSE 'krige' END AS status FROM st)"""  # fmt: skip


def _ways(spark, d):
    return I.methods(D.station_day(spark, d).withColumn("is_fill", F.col("skn") % 7 == 0), ["county", "date"])


@query(sql("station_day", f"WITH {STATUS} SELECT county, date, n, status FROM ways"))
def k9_map_method(spark, d):
    return _ways(spark, d).select("county", "date", "n", "status")


@query(sql("station_day cells", f"WITH {STATUS} SELECT w.county, w.date, count(*) AS n_cells, max(0.0::DOUBLE) AS value, min((-9999.0)::DOUBLE) AS se FROM ways w "
           "JOIN cells c ON c.county = w.county WHERE status = 'no_rain' GROUP BY 1, 2"))  # fmt: skip
def k8_no_rain_maps(spark, d):
    got = I.no_rain(D.cells(spark, d), _ways(spark, d).select("county", "date", "n", "top_real", "status"), ["county"])
    return got.groupBy("county", "date").agg(F.count("*").alias("n_cells"), F.max("value").alias("value"), F.min("se").alias("se"))


@query(sql("cells", "SELECT row, col, max(value) AS value FROM cells GROUP BY 1, 2"))
def d15_mosaic(spark, d):
    return P.mosaic(D.cells(spark, d))


#: Terrain of all cells with eight neighbours, and curvature as the slope of the slope.
SHAPE = """s AS (SELECT a.tile, a.county, a.row, a.col, a.value AS v, b.row - a.row AS i, b.col - a.col AS j, b.value AS b FROM cells a JOIN cells b
  ON {same} AND abs(a.row - b.row) <= 1 AND abs(a.col - b.col) <= 1),
g AS (SELECT tile, county, row, col, v AS value, count(*) AS n, max(b) - min(b) AS roughness, sum(abs(b - v)) / 8 AS tri,
  sum(CASE WHEN j <> 0 THEN b * j * (2 - abs(i)) END) / (8 * 0.1) AS e, sum(CASE WHEN i <> 0 THEN b * i * (2 - abs(j)) END) / (8 * 0.1) AS s FROM s GROUP BY ALL),
h AS (SELECT tile, county, row, col, value, degrees(atan(sqrt(e * e + s * s))) AS slope, roughness, tri FROM g WHERE n = 9),
t AS (SELECT a.tile, a.county, a.row, a.col, b.row - a.row AS i, b.col - a.col AS j, b.slope AS b FROM h a JOIN h b ON {same} AND abs(a.row - b.row) <= 1 AND abs(a.col - b.col) <= 1),
c AS (SELECT tile, county, row, col, count(*) AS n, sum(CASE WHEN j <> 0 THEN b * j * (2 - abs(i)) END) / (8 * 0.1) AS e,
  sum(CASE WHEN i <> 0 THEN b * i * (2 - abs(j)) END) / (8 * 0.1) AS s FROM t GROUP BY ALL),
shape AS (SELECT h.*, CASE WHEN n = 9 THEN degrees(atan(sqrt(e * e + s * s))) END AS curvature FROM h JOIN c ON c.tile = h.tile AND c.county = h.county AND c.row = h.row AND c.col = h.col)"""


@query(sql("cells", f"WITH {SHAPE.format(same='a.tile = b.tile')} SELECT tile, row, col, round(slope, 4) AS slope, round(roughness, 4) AS roughness, "
           "round(tri, 4) AS tri, round(curvature, 4) AS curvature FROM shape"))  # fmt: skip
def e16_terrain(spark, d):
    got = P.terrain(D.cells(spark, d), 0.1, 0.1)
    return got.select("tile", "row", "col", *(F.round(c, 4).alias(c) for c in ("slope", "roughness", "tri", "curvature")))


VARIO = f"""z AS (SELECT county, month, skn, lon, lat, ln(rf + 1) AS y FROM pts),
vg AS (SELECT a.county, a.month, CAST(floor({planar('a.', 'b.')} / 0.5) AS BIGINT) AS bin, {planar('a.', 'b.')} AS h, 0.5 * pow(a.y - b.y, 2) AS g
  FROM z a JOIN z b ON a.county = b.county AND a.month = b.month AND a.skn < b.skn)"""  # fmt: skip


def _target(spark, d):
    return I.transform(_points_apart(spark, d).withColumn("mean_mm", F.lit(20.0)), -1)


@query(sql("station_month", f"WITH {APART}, {VARIO} SELECT county, month, bin, count(*) AS n_pairs, round(avg(h), 6) AS h, round(avg(g), 6) AS gamma "
           "FROM vg WHERE bin < 6 GROUP BY 1, 2, 3"))  # fmt: skip
def k1_variogram(spark, d):
    got = I.variogram(_target(spark, d), ["county", "month"], 0.5, 6)
    return got.select("county", "month", "bin", "n_pairs", F.round("h", 6).alias("h"), F.round("gamma", 6).alias("gamma"))


def _fitted(spark, d, keys=("county", "month")):
    return I.fit(I.variogram(_target(spark, d), list(keys), 0.5, 6), list(keys))


@query()
def k2_variogram_fit(spark, d):
    return _fitted(spark, d)


def _with_params(spark, d):
    """Targets with the listed variogram of their county and month of the year (no climate aid)."""
    params = D.vario_params(spark, d).filter("added = -1").select("county", F.col("month").alias("moy"), "nugget", "range", "sill")
    return _target(spark, d).withColumn("moy", F.month("month")).join(params, ["county", "moy"])


#: Kriging systems in SQL: covariances and the row of ones as a list of lists for each county and month, inverted in place by
#: Gauss-Jordan steps, one for each pivot. iv holds the inverse, ys the targets with a zero at the end.
SOLVED = f"""fp AS (SELECT s.county, s.month, skn, lon + skn / 1e5 AS lon, lat, ln(rf + 1) AS y, nugget, range, sill,
  row_number() OVER (PARTITION BY s.county, s.month ORDER BY skn) AS i FROM station_month s JOIN vario_params p ON p.county = s.county AND p.month = month(s.month) AND p.added = -1),
pr AS (SELECT a.county, a.month, a.i, b.i AS j, CASE WHEN {planar('a.', 'b.')} = 0 THEN a.sill ELSE (a.sill - a.nugget) * exp(-{planar('a.', 'b.')} / a.range) END
  + CASE WHEN a.i = b.i THEN 1e-9 ELSE 0 END AS c FROM fp a JOIN fp b ON b.county = a.county AND b.month = a.month),
rw AS (SELECT county, month, i, list_append(list(c ORDER BY j), 1.0::DOUBLE) AS r FROM pr GROUP BY ALL),
kr AS (SELECT county, month, list_append(list(r ORDER BY i), list_append(list_transform(range(count(*)), lambda x: 1.0::DOUBLE), 0.0::DOUBLE)) AS a FROM rw GROUP BY ALL),
gj AS (SELECT county, month, 1 AS k, a FROM kr UNION ALL
  SELECT county, month, k + 1, list_transform(a, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda x, j: CASE WHEN j = k THEN 1 / x ELSE x / a[k][k] END)
    ELSE list_transform(r, lambda x, j: CASE WHEN j = k THEN -x / a[k][k] ELSE x - r[k] * a[k][j] / a[k][k] END) END) FROM gj WHERE k <= len(a)),
iv AS MATERIALIZED (SELECT county, month, a FROM gj WHERE k = len(a) + 1),
ys AS (SELECT county, month, any_value(sill) AS sill, list_append(list(y ORDER BY i), 0.0) AS ys FROM fp GROUP BY ALL)"""


@query(sql("station_month vario_params", f"""WITH RECURSIVE {SOLVED}
SELECT fp.county, fp.month, skn, round(y, 6) AS y, round(CASE WHEN len(a) > 2 THEN y - list_dot_product(a[i], ys) / a[i][i] END, 5) AS y_pred
FROM fp JOIN iv ON iv.county = fp.county AND iv.month = fp.month JOIN ys ON ys.county = fp.county AND ys.month = fp.month"""))  # fmt: skip
def k4_kriging_leave_one_out(spark, d):
    got = I.krige_loo(_with_params(spark, d), ["county", "month"])
    return got.select("county", "month", "skn", F.round("y", 6).alias("y"), F.round("y_pred", 5).alias("y_pred"))


@query(sql("station_month vario_params cells", f"""WITH RECURSIVE {SOLVED},
du AS (SELECT iv.county, iv.month, a, sill, list_transform(a, lambda x: list_dot_product(x, ys)) AS w FROM iv JOIN ys ON ys.county = iv.county AND ys.month = iv.month),
cl AS (SELECT c.county, s.month, tile, row, col, list_append(list((s.sill - s.nugget) * exp(-{planar('c.', 's.')} / s.range) ORDER BY i), 1.0::DOUBLE) AS r
  FROM cells c JOIN fp s ON s.county = c.county GROUP BY ALL)
SELECT cl.county, cl.month, tile, row, col, round(list_dot_product(w, r), 5) AS pred,
  round(greatest(sill - list_dot_product(list_transform(a, lambda x: list_dot_product(x, r)), r), 0), 5) AS var
FROM cl JOIN du ON du.county = cl.county AND du.month = cl.month"""))  # fmt: skip
def k3_kriging_map(spark, d):
    grid = D.cells(spark, d).select("county", *CELL, "lon", "lat")
    got = I.krige(_with_params(spark, d), grid, ["county"], ["month"], cell=CELL)
    return got.withColumns({c: F.round(c, 5) for c in ("pred", "var")})


def _daily_points(spark, d) -> DataFrame:
    """Station-days on the grid with the mean of their cell; every seventh station counts as filled, near-duplicates are gone."""
    names = F.array(*(F.lit(x) for x in P.STATION_NETWORKS))
    network = F.get(names, (F.col("skn") % len(P.STATION_NETWORKS)).cast("int"))
    rows = D.in_cell(D.placed_days(spark, d)).withColumn("is_fill", F.col("skn") % 7 == 0).withColumn("network", network)
    means = D.cells(spark, d).groupBy("row", "col").agg((F.avg("value") / 100).alias("value"))
    on_grid = P.extract(rows, means).withColumnRenamed("value", "mean_mm")
    return P.drop_near(P.source_rank(on_grid, P.STATION_NETWORKS)).drop("rank", "network", "row", "col")


@query()
def k5_candidate_sweep(spark, d):
    """The best of the 14 candidates of every county-day."""
    swept = I.sweep(_daily_points(spark, d), D.vario_params(spark, d))
    keys = ["county", "date", "run", "added", "is_free", "nugget", "range", "sill"]
    return M.best_run(M.scores(swept, keys).filter("mae is not null"), ["county", "date"])


@query(sql("station_month", f"""WITH {APART}, {LOO}, m AS (SELECT county, month, count(*) AS n, max(obs) AS top, sqrt(avg(pow(obs - pred, 2))) AS rmse,
  avg(abs(obs - pred)) AS mae, avg(obs - pred) AS bias, sum(pow(obs - pred, 2)) AS sse, var_pop(obs) * count(*) AS sst,
  CASE WHEN count(*) > 1 AND stddev_samp(obs) > 1e-9 AND stddev_samp(pred) > 1e-9 THEN corr(obs, pred) END AS r,
  stddev_samp(pred) / nullif(stddev_samp(obs), 0) AS a, avg(pred) / nullif(avg(obs), 0) AS b FROM loo GROUP BY 1, 2)
SELECT county, month, n, CASE WHEN top > 0 THEN round(r * r, 5) END AS r2, CASE WHEN top > 0 THEN round(rmse, 5) END AS rmse,
  CASE WHEN top > 0 THEN round(mae, 5) END AS mae, CASE WHEN top > 0 THEN round(bias, 5) END AS bias,
  CASE WHEN top > 0 AND sst > 1e-9 THEN round(1 - sse / sst, 5) END AS nse,
  CASE WHEN top > 0 THEN round(1 - sqrt(pow(r - 1, 2) + pow(a - 1, 2) + pow(b - 1, 2)), 5) END AS kge, NOT top > 0 AS no_rain FROM m"""))  # fmt: skip
def d14_error_metrics(spark, d):
    got = M.scores(I.idw_loo(_points_apart(spark, d), ["county", "month"]), ["county", "month"])
    cols = ("r2", "rmse", "mae", "bias", "nse", "kge")
    return got.select("county", "month", "n", *(F.round(c, 5).alias(c) for c in cols), "no_rain")


@query(sql("station_month", "SELECT county, month, count(rf) AS n, min(rf) AS low, round(avg(rf), 6) AS mean, round(median(rf), 6) AS median, max(rf) AS high, "
           "round(stddev_samp(rf), 6) AS sd, round(stddev_samp(rf) / sqrt(count(rf)), 6) AS se FROM station_month GROUP BY 1, 2"))  # fmt: skip
def d12_summary(spark, d):
    got = M.summary(D.station_month(spark, d), ["county", "month"], "rf")
    return got.select("county", "month", "n", "low", "high", *(F.round(c, 6).alias(c) for c in ("mean", "median", "sd", "se")))


@query(sql("cells", "SELECT tile, county, count(*) AS n_cells, count(*) FILTER (value < 1000) AS n_negative, count(*) FILTER (value < 1000) > 0 AS any_negative, "
           "round(min(value) - 1000, 4) AS low, round(max(value) - 1000, 4) AS high FROM cells GROUP BY 1, 2"))  # fmt: skip
def d13_grid_negatives(spark, d):
    got = M.grid_negatives(D.cells(spark, d).withColumn("value", F.col("value") - 1000), ["tile", "county"])
    return got.withColumn("low", F.round("low", 4)).withColumn("high", F.round("high", 4))


@query(sql("station_month", """WITH c AS (SELECT county, month, count(*) AS n, round(min(rf), 3) AS low, count(*) < 10 AS few FROM station_month GROUP BY 1, 2)
SELECT month, string_agg(county, ',' ORDER BY county) AS county_list, string_agg(CAST(n AS VARCHAR), ',' ORDER BY county) AS n_list,
sum(n)::BIGINT AS n_total, min(low) AS low_min, string_agg(CAST(few AS VARCHAR), ',' ORDER BY county) AS few_list, bool_or(few) AS few_any FROM c GROUP BY 1"""))  # fmt: skip
def d16_joined_rows(spark, d):
    per = D.station_month(spark, d).groupBy("county", "month").agg(
        F.count("*").alias("n"), F.round(F.min("rf"), 3).alias("low"), (F.count("*") < 10).alias("few")
    )
    return M.joined_rows(per, ["month"], "county", {"n": "%d"}, ("low",), ("few",))


RUNS = """runs AS (SELECT l_suppkey AS grp, l_linenumber AS run, l_linenumber % 2 = 0 AS is_free, sum(l_tax) / count(*) AS nugget, avg(l_discount) * 2 AS range,
  0.2 AS sill, round(avg(l_quantity), 6) AS mae FROM lineitem GROUP BY 1, 2)"""  # fmt: skip


@query(f"WITH {RUNS} SELECT grp, run, is_free, mae FROM runs WHERE NOT is_free OR (nugget / sill < 0.3 AND range > 0.04) "
       "QUALIFY row_number() OVER (PARTITION BY grp ORDER BY mae, run) = 1")  # fmt: skip
def e10_best_run(spark, d):
    g = D.table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("grp"), F.col("l_linenumber").alias("run"))
    runs = g.agg((F.sum("l_tax") / F.count("*")).alias("nugget"), (F.avg("l_discount") * 2).alias("range"), F.round(F.avg("l_quantity"), 6).alias("mae"))
    runs = runs.withColumn("is_free", F.col("run") % 2 == 0).withColumn("sill", F.lit(0.2))
    return M.best_run(runs, ["grp"]).select("grp", "run", "is_free", "mae")


@query("""WITH m AS (SELECT l_suppkey AS grp, 'v' || l_linenumber AS vario, CAST((l_linenumber - 1) // 3 AS BIGINT) AS level, round(avg(l_discount) * 10, 6) AS r2,
  round(avg(l_quantity), 6) AS mae, round(avg(l_extendedprice) / 1000, 6) AS rmse, round(avg(l_tax) * 12.6, 6) AS prob_ugly,
  CAST(200 + l_suppkey % 7 AS DOUBLE) AS rf_max FROM lineitem GROUP BY 1, 2, l_linenumber),
f AS (SELECT *, min(CASE WHEN prob_ugly <= 0.5 THEN level END) OVER (PARTITION BY grp) AS first FROM m),
k AS (SELECT * FROM f WHERE first IS NULL OR (level = first AND prob_ugly <= 0.5)),
p AS (SELECT *, list_sort([round(r2, 2) * 100, 100 - round(mae) / round(rf_max) * 100, 100 - round(rmse) / round(rf_max) * 100, round(1 - prob_ugly, 2) * 100]) AS four FROM k)
SELECT grp, vario, level, round((four[2] + four[3]) / 2, 4) AS score FROM p QUALIFY row_number() OVER (PARTITION BY grp ORDER BY (four[2] + four[3]) / 2 DESC,
  CASE WHEN first IS NULL THEN round(prob_ugly, 2) END, round(r2, 2) DESC, round(mae) DESC, round(rmse) DESC, vario) = 1""")
def e11_e12_best_variogram(spark, d):
    line = F.col("l_linenumber")
    g = D.table(spark, d, "lineitem").groupBy(
        F.col("l_suppkey").alias("grp"), F.concat(F.lit("v"), line.cast("string")).alias("vario"), F.floor((line - 1) / 3).alias("level")
    )
    maps = g.agg(
        F.round(F.avg("l_discount") * 10, 6).alias("r2"), F.round(F.avg("l_quantity"), 6).alias("mae"),
        F.round(F.avg("l_extendedprice") / 1000, 6).alias("rmse"), F.round(F.avg("l_tax") * 12.6, 6).alias("prob_ugly"),
    ).withColumn("rf_max", (200 + F.col("grp") % 7).cast("double"))
    return M.best_variogram(maps, ["grp"]).withColumn("score", F.round("score", 4))


@query(sql("station_month", "SELECT skn, month, round((rf - min(rf) OVER w) / nullif(max(rf) OVER w - min(rf) OVER w, 0), 6) AS rf_scaled FROM station_month "
           "WINDOW w AS (PARTITION BY county, month)"))  # fmt: skip
def e15_minmax(spark, d):
    got = M.minmax(D.station_month(spark, d), ["county", "month"], ["rf"])
    return got.select("skn", "month", F.round("rf_scaled", 6).alias("rf_scaled"))


@query(sql("prob_day", "SELECT skn, date, round(prob, 6) AS prob, round(prob_year, 6) AS prob_year FROM prob_day"))
def h8_rain_probability(spark, d):
    got = _qc_days(spark, d)
    return got.select("skn", "date", F.round("prob", 6).alias("prob"), F.round("prob_year", 6).alias("prob_year"))


@query(sql("station_day", "SELECT skn, date, round(ln(rf + 1), 8) AS y, round(ln((rf + m) / m), 8) AS z, round(rf / m, 8) AS anomaly, "
           "greatest(rf - 5, 0) AS clamped FROM (SELECT *, CASE WHEN skn % 4 = 0 THEN 0.001 ELSE skn % 4 END AS m FROM station_day)"))  # fmt: skip
def h9_h10_b14_transforms(spark, d):
    m = S.guarded_mean((F.col("skn") % 4).cast("double"))
    rf = F.col("rf")
    got = D.station_day(spark, d).select("skn", "date", "rf", m.alias("m"))
    return got.select(
        "skn", "date", F.round(S.log_plain(rf), 8).alias("y"), F.round(S.log_ratio(rf, F.col("m")), 8).alias("z"),
        F.round(rf / F.col("m"), 8).alias("anomaly"), F.greatest(rf - 5, F.lit(0.0)).alias("clamped"),
    )


LABEL = "CASE WHEN {x} <= 0.02 THEN 'high' WHEN {x} <= 0.04 THEN 'good' WHEN {x} <= 0.06 THEN 'moderate' WHEN {x} <= 0.08 THEN 'low' ELSE 'lowest' END"


@query("SELECT l_tax AS share, " + LABEL.format(x="l_tax") + " AS daily, CASE WHEN l_tax * 12 >= 0.8 THEN 'high' WHEN l_tax * 12 >= 0.6 THEN 'good' "
       "WHEN l_tax * 12 >= 0.4 THEN 'moderate' WHEN l_tax * 12 >= 0.2 THEN 'low' ELSE 'lowest' END AS monthly, count(*) AS n FROM lineitem GROUP BY 1, 2, 3")  # fmt: skip
def h11_quality_labels(spark, d):
    x = F.col("l_tax")
    g = D.table(spark, d, "lineitem").groupBy(x.alias("share"), S.daily_label(x).alias("daily"), S.monthly_label(x * 12).alias("monthly"))
    return g.agg(F.count("*").alias("n"))


NAMES = "CASE county WHEN 'KA' THEN 'Kauai County' WHEN 'OA' THEN 'Honolulu County (Oahu)' WHEN 'BI' THEN 'Hawaii county' " \
    "WHEN 'MN' THEN 'Maui County (Maui, Lanai, Molokai & Kahoolawe)' END"
ERRORS = "' Leave-one-out: mean absolute error ' || CAST(round(mae, 3) AS VARCHAR) || ' mm, largest observed rain ' || CAST(round(top, 3) AS VARCHAR) || ' mm'"
BEGIN = f"'Rainfall map of ' || {NAMES} || ' for ' || strftime(date, '%Y-%m-%d') || ', in millimetres from midnight to midnight. '"


@query(sql("station_day", f"""WITH v AS (SELECT county, date, count(*) AS n, max(rf) AS top, round(avg(rf) / 20, 6) AS mae FROM station_day GROUP BY 1, 2),
m AS (SELECT *, strftime(date, '%Y%m%d') || county AS key, CASE WHEN top = 0 THEN 'no_rain' WHEN n < 8 THEN 'idw' ELSE 'krige' END AS method FROM v),
t AS (SELECT *, {BEGIN} || CASE method WHEN 'no_rain' THEN 'None of the ' || n || ' stations had rain, so every cell is 0; there are no errors to report and no standard errors.'
  WHEN 'idw' THEN 'No variogram could be used, so it comes from inverse distances (power 2) of ' || n || ' stations; standard errors are -9999.' || {ERRORS} || '.'
  ELSE 'Kriged from ' || n || ' stations.' || {ERRORS} || '; quality: ' || {LABEL.format(x='(mae / top)')} || '.' END AS description FROM m)
SELECT key, 'n' AS attribute, CAST(n AS VARCHAR) AS value FROM t UNION ALL SELECT key, 'method', method FROM t UNION ALL SELECT key, 'description', description FROM t"""))  # fmt: skip
def h12_a12_metadata_sheet(spark, d):
    got = D.station_day(spark, d).groupBy("county", "date").agg(
        F.count("*").alias("n"), F.max("rf").alias("top"), F.round(F.avg("rf") / 20, 6).alias("mae")
    )
    method = F.when(F.col("top") == 0, "no_rain").when(F.col("n") < 8, "idw").otherwise("krige")
    got = got.withColumn("key", F.concat(F.date_format("date", "yyyyMMdd"), "county")).withColumn("method", method)
    words = got.select("key", "n", "method", M.map_sentence(F.col("date")).alias("words"))
    path = tables.scratch(spark, "sheet")
    tables.write_sheet(M.sheet(words, "key", F.col("words")).filter("attribute <> 'words'"), path)
    return spark.read.schema("key string, attribute string, value string").option("sep", "\t").option("header", True).csv(path)


@query(sql("station_day", """WITH v AS (SELECT county, date, count(*) AS n, max(rf) AS top, round(avg(rf) / 20, 3) AS mae FROM station_day GROUP BY 1, 2),
s AS (SELECT date, sum(n)::BIGINT AS n_total, max(top) AS top, max(mae) AS mae, string_agg(printf('%.3f', mae), ',' ORDER BY county) AS mae_list,
  coalesce(string_agg(county, ',' ORDER BY county) FILTER (n < 8), '') AS idw_list FROM v GROUP BY 1)
SELECT date, 'Mosaic rainfall map of all counties for ' || strftime(date, '%Y-%m-%d') || '.' || CASE WHEN idw_list <> '' THEN
  ' Inverse distances (standard errors -9999) stand in for: ' || idw_list || '.' ELSE '' END || ' It used ' || n_total || ' stations. Mean absolute errors by county: ' ||
  mae_list || '; overall ' || CAST(round(mae, 3) AS VARCHAR) || ' mm, largest observed rain ' || CAST(round(top, 3) AS VARCHAR) || ' mm; quality: ' ||
  """ + LABEL.format(x="(mae / nullif(top, 0))") + """ || '.' AS description FROM s"""))  # fmt: skip
def h12_d16_state_sentence(spark, d):
    per = D.station_day(spark, d).groupBy("county", "date").agg(
        F.count("*").alias("n"), F.max("rf").alias("top"), F.round(F.avg("rf") / 20, 3).alias("mae")
    )
    rolled = M.joined_rows(per, ["date"], "county", {"n": "%d", "mae": "%.3f"})
    more = per.groupBy("date").agg(
        F.max("top").alias("top_state"), F.max("mae").alias("mae_state"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("n") < 8, F.col("county")))), ",").alias("idw_list"),
    )
    return rolled.join(more, "date").select("date", M.state_sentence(F.col("date")).alias("description"))


MONTH_LOO = f"""{APART}, {LOO}, m AS (SELECT county, month, count(*) AS n, max(obs) AS top, sqrt(avg(pow(obs - pred, 2))) AS rmse, avg(abs(obs - pred)) AS mae, avg(obs - pred) AS bias,
  pow(CASE WHEN count(*) > 1 AND stddev_samp(obs) > 1e-9 AND stddev_samp(pred) > 1e-9 THEN corr(obs, pred) END, 2) AS r2 FROM loo GROUP BY GROUPING SETS ((county, month), (month))),
f AS (SELECT county, month, n, CASE WHEN top > 0 THEN r2 END AS r2, CASE WHEN top > 0 THEN rmse END AS rmse, CASE WHEN top > 0 THEN mae END AS mae, CASE WHEN top > 0 THEN bias END AS bias FROM m)"""


def _month_loo(spark, d):
    """Left-out predictions of every county and month, and their scores."""
    loo = tables.written(I.idw_loo(_points_apart(spark, d), ["county", "month"]), "loo")
    return loo, M.scores(loo, ["county", "month"])


TEXT5 = "coalesce(printf('%.5f', round({c}, 5)), 'NA')"
MONTH_LABEL = "CASE WHEN r2 >= 0.8 THEN 'high' WHEN r2 >= 0.6 THEN 'good' WHEN r2 >= 0.4 THEN 'moderate' WHEN r2 >= 0.2 THEN 'low' ELSE 'lowest' END"


@query(sql("station_month", f"""WITH {MONTH_LOO}, t AS (SELECT *, strftime(month, '%Y%m') || county AS key, 'Rainfall map of ' || {NAMES} || ' for ' || strftime(month, '%B %Y') || ' ('
  || strftime(month, '%Y-%m-%d') || ' to ' || strftime(last_day(month), '%Y-%m-%d') || '), in millimetres. It was kriged from ' || n
  || ' stations as the logarithm of their ratio to the month''s climate mean. Leave-one-out R squared: ' || coalesce(printf('%.3f', round(r2, 3)), 'NA') || '; quality: ' || {MONTH_LABEL}
  || '. Errors vary over space; see the standard errors.' AS description FROM f WHERE county IS NOT NULL)
SELECT key, unnest(['county', 'month', 'first_day', 'last_day', 'n', 'r2', 'rmse', 'mae', 'bias', 'description']) AS attribute, unnest([county, strftime(month, '%Y-%m'),
  strftime(month, '%Y-%m-%d'), strftime(last_day(month), '%Y-%m-%d'), CAST(n AS VARCHAR), {', '.join(TEXT5.format(c=c) for c in M.MONTH_SCORES)}, description]) AS value FROM t"""))  # fmt: skip
def h12_month_sheet(spark, d):
    """The sheet of every county and month, from the scores of its left-out predictions."""
    return M.month_sheet(_month_loo(spark, d)[1])


@query(sql("station_month", f"""WITH {MONTH_LOO}, c AS (SELECT month, string_agg(county, ',' ORDER BY county) AS county_list, string_agg(CAST(n AS VARCHAR), ',' ORDER BY county) AS n_list,
  {', '.join(f"string_agg({TEXT5.format(c=c)}, ',' ORDER BY county) AS {c}_list" for c in M.MONTH_SCORES)}, sum(n)::BIGINT AS n_total FROM f WHERE county IS NOT NULL GROUP BY 1)
SELECT c.*, {', '.join(f'round(f.{c}, 5) AS {c}' for c in M.MONTH_SCORES)} FROM c JOIN f ON f.month = c.month AND f.county IS NULL"""))  # fmt: skip
def h12_month_state(spark, d):
    """All counties of a month in one row."""
    loo, scored = _month_loo(spark, d)
    return M.month_state(scored, loo)


def _bad():
    """Which station-days carry an injected error: about one in 97."""
    return (F.pmod(F.xxhash64("skn", "date"), F.lit(97)) == 0) & (F.col("rf") > 0)


def _spoilt_days(spark, d) -> DataFrame:
    """Placed station-days with injected errors: every 97th value is twenty times too high."""
    return D.placed_days(spark, d).withColumn("rf", F.when(_bad(), F.col("rf") * 20).otherwise(F.col("rf")))


def _qc_features(days, params) -> DataFrame:
    return Q.features(Q.probabilities(D.in_cell(days), params))


def _is_training():
    """Days that the forests learn from: two of three, by a hash of the date."""
    return F.pmod(F.xxhash64(F.lit("train"), "date"), F.lit(3)) > 0


@query()
def k11_bad_value_classifier(spark, d):
    """Injected errors found among days that the forests haven't seen."""
    rows = tables.written(_qc_features(_spoilt_days(spark, d), D.rain_params(spark, d)).withColumn("bad", _bad()), "labelled")
    cols = Q.feature_columns()
    models = Q.train_bad_value(rows.filter(_is_training()), cols, trees=10)
    got = Q.score_bad_value(rows.filter(~_is_training()), models, cols)
    return got.groupBy("county", "bad").agg(F.count("*").alias("n"), F.count_if("bad_class").alias("flagged"))


@query()
def k12_iterative_removal(spark, d):
    """Every county-day screened by forests that learned from the other half of the days."""
    days = tables.written(Q.probabilities(D.in_cell(_spoilt_days(spark, d)), D.rain_params(spark, d)), "days")
    cols = Q.feature_columns()
    half = F.pmod(F.xxhash64(F.lit("half"), "date"), F.lit(2))
    labelled = tables.written(Q.features(days).withColumn("bad", _bad()), "labelled")
    out = [Q.screen_days(days.filter(half == h), Q.train_bad_value(labelled.filter(half != h), cols, trees=10), least=11) for h in (0, 1)]
    return out[0].unionByName(out[1])


@query(sql("station_day", "SELECT county, date, arg_max(skn, {'p': rf, 's': -skn}) AS skn, max(rf) AS prob_bad FROM station_day WHERE rf > 25 GROUP BY 1, 2"))
def e13_worst_flagged(spark, d):
    days = D.station_day(spark, d).withColumn("prob_bad", F.col("rf")).withColumn("bad_class", F.col("rf") > 25)
    return Q.worst(days)


def _near_grid(spark, d) -> DataFrame:
    """All cells with the metres to the nearest station of their county; it has no dates and is worked out once."""
    grid = D.cells(spark, d)
    dist = P.nearest_distance(grid, places(spark, d), cell=CELL, carry=("lon", "lat", "value"))
    return tables.written(dist, "grid")


@query(sql("cells meta", f"""WITH near AS (SELECT c.tile, c.row, c.col, min({hav('c.', 'm.')}) AS dist FROM cells c JOIN meta m ON m.county = c.county GROUP BY 1, 2, 3)
SELECT tile, row, col, round(dist, 3) AS dist FROM near"""))  # fmt: skip
def k15_nearest_station(spark, d):
    got = P.nearest_distance(D.cells(spark, d), places(spark, d), cell=CELL)
    return got.select(*CELL, F.round("dist", 3).alias("dist"))


def _features_sql() -> str:
    """The statistics of K15 of every tile and county, in SQL; near cells are those within 20 km of a station."""
    cols = ["count(*) AS n_cells", "count(*) FILTER (near) AS n_near", "bool_or(value < 0) AS negative"]
    for where, only in (("", ""), ("_near", " FILTER (near)")):
        for c in ("value", *Q.SHAPES):
            named = {"min": "min", "max": "max", "mean": "avg", "median": "median", "sd": "stddev_samp", "var": "var_samp"}
            cols += [f"{f}({c}){only} AS {c}_{k}{where}" for k, f in named.items()]
        cols += [f"covar_pop({c}, dist){only} AS {c}_cov{where}" for c in Q.SHAPES]
        cols += [f"var_pop({c}){only} AS {c}_vp{where}" for c in (*Q.SHAPES, "dist")]
    z = 1.959963984540054
    terms = (z, (z**3 + z) / 4, (5 * z**5 + 16 * z**3 + 3 * z) / 96, (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384)
    out = ["tile", "county", "n_cells", "n_near", "negative"]
    for where, n in (("", "n_cells"), ("_near", "n_near")):
        out += [f"round({c}_{s}{where}, 3) AS {c}_{s}{where}" for c in ("value", *Q.SHAPES) for s in ("min", "max", "mean", "median", "sd", "var")]
        for c in Q.SHAPES:
            both = f"{c}_vp{where} * dist_vp{where}"
            r = f"(CASE WHEN {c}_vp{where} > {Q.FLAT} AND dist_vp{where} > {Q.FLAT} AND {n} > 2 THEN greatest(least({c}_cov{where} / sqrt({both}), 1.0), -1.0) END)"
            out += [f"round({r}, 4) AS {c}_cor{where}", f"round(1 - (1 - {r} * {r}) * ({n} - 1) / ({n} - 2), 4) AS {c}_r2{where}"]
            limit = " + ".join(f"{t!r} / pow({n} - 2, {i})" for i, t in enumerate(terms))
            out += [f"{r} * {r} * ({n} - 2) > (1 - {r} * {r}) * pow({limit}, 2) AS {c}_p{where}"]
    shape = SHAPE.format(same="a.tile = b.tile AND a.county = b.county")
    near = f"SELECT c.tile, c.row, c.col, c.county, min({hav('c.', 'm.')}) AS dist FROM cells c JOIN meta m ON m.county = c.county GROUP BY ALL"
    return sql("cells meta", f"""WITH {shape}, near AS ({near}),
      w AS (SELECT shape.*, dist, dist < 20000 AS near FROM shape JOIN near n ON n.tile = shape.tile AND n.county = shape.county AND n.row = shape.row AND n.col = shape.col WHERE curvature IS NOT NULL),
      st AS (SELECT tile, county, {", ".join(cols)} FROM w GROUP BY 1, 2) SELECT {", ".join(out)} FROM st""")  # fmt: skip


@query(_features_sql())
def k15_map_features(spark, d):
    shape = P.terrain(_near_grid(spark, d), 0.1, 0.1, ("county", "tile"), ("dist",))
    got = Q.map_features(shape, ["tile", "county"], 20_000.0)
    numbers = [c for c, kind in got.dtypes if kind == "double"]
    return got.withColumns({c: F.round(c, 4 if c.split("_")[1] in ("cor", "r2") else 3) for c in numbers})


MAP_KEYS = ["county", "tile", "month"]


def _spoilt_maps(spark, d, grid: DataFrame) -> DataFrame:
    """Features of the maps of all county-months; one in three has a chequered pattern added and is ugly."""
    maps = I.idw(grid, D.station_month(spark, d), ["county"], ["month"], cell=CELL, carry=("dist",))
    ugly = F.pmod(F.xxhash64("county", "month"), F.lit(3)) == 0
    step = F.when(ugly & ((F.col("row") + F.col("col")) % 2 == 0), 6.0).otherwise(0.0)
    shape = P.terrain(maps.withColumn("value", F.col("value") + step), 0.1, 0.1, tuple(MAP_KEYS), ("dist",))
    rows = Q.map_features(shape, MAP_KEYS, 20_000.0)
    return tables.written(rows.withColumn("ugly", ugly), "features")


def _train_month():
    return F.month("month") % 2 == 1


@query()
def k16_map_class(spark, d):
    """A forest on the shapes of the maps of odd months, tried on the maps of even ones."""
    rows, cols = _spoilt_maps(spark, d, _near_grid(spark, d)), Q.map_feature_columns()
    model = Q.train_map_class(rows.filter(_train_month()), cols)
    return Q.score_map_class(rows.filter(~_train_month()), model, cols).select(*MAP_KEYS, "ugly", "prob_ugly", "ugly_class")


def _level_params(spark, d) -> DataFrame:
    """Nugget and range of the levels low, med and high by county."""
    counties = D.meta(spark, d).select("county").distinct()
    rows = F.array(*(F.struct(F.lit(i).cast("long").alias("level"), F.lit(n).alias("nug"), F.lit(r).alias("rng")) for i, (n, r) in enumerate(((0.02, 0.3), (0.05, 0.6), (0.1, 1.2)))))
    return counties.select("county", F.inline(rows))


def _monthly(spark, d):
    """Stations with the climate mean of their cell, grid with the mean of each cell and month of the year, and what classes maps."""
    near = _near_grid(spark, d)
    season = 1 + F.col("moy") / 20
    grid = near.select("*", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("moy")).withColumn("mean_mm", F.col("value") / 60 * season).drop("value")
    stations = D.in_cell(_points_apart(spark, d)).withColumn("moy", F.month("month"))
    means = D.cells(spark, d).groupBy("row", "col").agg((F.avg("value") / 60).alias("mean"))
    stations = stations.join(means, ["row", "col"]).withColumn("mean_mm", F.col("mean") * season).drop("row", "col", "moy", "mean")
    model = Q.train_map_class(_spoilt_maps(spark, d, near), Q.map_feature_columns())
    keys = ["county", "tile", "month", "vario", "level"]

    def classify(maps: DataFrame) -> DataFrame:
        shapes = Q.map_features(P.terrain(maps, 0.1, 0.1, tuple(keys), ("dist",)), keys, 20_000.0)
        return Q.score_map_class(shapes, model, Q.map_feature_columns()).groupBy("county", "month", "vario", "level").agg(F.max("prob_ugly").alias("prob_ugly"))

    return I.monthly_map(I.monthly_points(stations), _level_params(spark, d), grid, classify, CELL, carry=("dist",))


@query()
def k17_monthly_kriging(spark, d):
    """Per county and month the runs tried over three levels, with class, errors and negative cells, and which was chosen."""
    return _monthly(spark, d)[1]


@query()
def k17_monthly_state_maps(spark, d):
    """The chosen maps of all counties as one mosaic a month: cells and the range of its four grids."""
    grids = _monthly(spark, d)[0]
    names = ("value", "se_backtransformed_var", "anomaly", "se_anomaly")
    state = grids.groupBy("month", *CELL).agg(*(F.max(c).alias(c) for c in names))
    return state.groupBy("month").agg(F.count("*").alias("n_cells"), *(f(c).alias(f"{c}_{n}") for c in names for n, f in (("low", F.min), ("mean", F.avg), ("high", F.max))))


@query()
def k9_daily_maps(spark, d):
    """The driver on days: way, chosen candidate and errors of every county-day, and its grids in figures."""
    grid = D.cells(spark, d).select("county", *CELL, "lon", "lat", (F.col("value") / 100).alias("mean_mm"))
    validation, maps = I.daily_map(_daily_points(spark, d), grid, D.vario_params(spark, d), CELL)
    figures = [f(c).alias(f"{c}_{n}") for c in ("value", "anomaly", "se_backtransformed_var") for n, f in (("low", F.min), ("mean", F.avg), ("high", F.max))]
    grids = maps.groupBy("county", "date", "method").agg(F.count("*").alias("n_cells"), *figures)
    return validation.join(grids, ["county", "date", "method"], "left")
