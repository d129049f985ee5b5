"""Queries over station-days: merging networks, logs, upserts, months, gap filling and wide tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from rainspark.functions import scalars as S
from rainspark.operators import gapfill, merge, monthly, quality, util
from rainspark.plans import testdata as D
from rainspark.plans.registry import query
from rainspark.plans.testdata import sql
from rainspark.sources import tables

@query(sql("station_day", "SELECT skn, date, rf AS value FROM station_day"))
def a4_wide_to_long(spark, d):
    days = D.station_day(spark, d).select("skn", F.year("date").alias("year"), F.date_format("date", "MM.dd").alias("name"), "rf")
    names = [f"{m:02d}.{k:02d}" for m in range(1, 13) for k in range(1, 32)]
    wide = tables.written(tables.to_wide(days, ["skn", "year"], "name", "rf", names), "wide")  # a file holds a year of a station
    first, last = wide.agg(F.min("year"), F.max("year")).first()
    long = []
    for year in range(first, last + 1):
        named = [F.col(f"`{n}`").alias(f"X{year}.{n}") for n in names]
        long.append(tables.melt_wide(wide.filter(F.col("year") == year).select("skn", *named), ["skn"]))
    return merge.union_networks(long)


@query(sql("station_month", f"SELECT skn, year(month) AS year, {', '.join(f'max(CASE WHEN month(month) = {m} THEN rf END) AS x{m:02d}' for m in range(1, 13))} "
           "FROM station_month GROUP BY 1, 2"))  # fmt: skip
def a5_long_to_wide(spark, d):
    """A row for each station and year, a column for each month."""
    names = [f"x{m:02d}" for m in range(1, 13)]
    m = D.station_month(spark, d).select("skn", F.year("month").cast("long").alias("year"), F.concat(F.lit("x"), F.date_format("month", "MM")).alias("name"), "rf")
    return tables.to_wide(m, ["skn", "year"], "name", "rf", names)


@query(sql("station_day", "SELECT strftime(date, '%Y_%m') AS month, count(*) AS n, round(sum(rf), 2) AS rf FROM station_day GROUP BY 1"))
def a6_append_month(spark, d):
    """Two batches are appended, and the first of them again: the table holds every row once."""
    path = tables.scratch(spark, "months")
    days = D.station_day(spark, d).repartition(S.file_key("date"))
    for half in (0, 1, 0):
        tables.append_month(days.filter(F.pmod(F.dayofmonth("date"), F.lit(2)) == half), path, f"half {half}")
    got = tables.read_months(spark, path, "skn long, county string, date date, rf double")
    return got.groupBy("month").agg(F.count("*").alias("n"), F.round(F.sum("rf"), 2).alias("rf"))


@query(sql("station_day", "SELECT skn, date, CASE WHEN day(date) <= 10 THEN rf + 1000 ELSE rf END AS rf FROM station_day"))
def a7_day_replacement(spark, d):
    days = D.station_day(spark, d).select("skn", "date", "rf")
    new = days.filter(F.dayofmonth("date") <= 10).withColumn("rf", F.col("rf") + 1000)
    return merge.replace_days(merge.replace_days(days, new), new)


@query(sql("station_day", "SELECT skn, date, CASE WHEN skn % 2 = 0 AND day(date) = 1 THEN -1.0 ELSE rf END AS rf FROM station_day"))
def a8_upsert(spark, d):
    days = D.station_day(spark, d).select("skn", "date", "rf")
    new = days.filter((F.col("skn") % 2 == 0) & (F.dayofmonth("date") == 1)).withColumn("rf", F.lit(-1.0))
    return merge.upsert(days, new, ["skn", "date"])


@query(sql("station_month", "SELECT coalesce(a.skn, b.skn) AS skn, round(a.v, 6) AS x1, round(b.v, 6) AS x2 FROM (SELECT skn, sum(rf) AS v FROM station_month "
           "WHERE rf > 30 GROUP BY 1) a FULL JOIN (SELECT skn, sum(rf) AS v FROM station_month WHERE rf < 8 GROUP BY 1) b ON a.skn = b.skn"))  # fmt: skip
def c7_full_outer_columns(spark, d):
    """Sums of wet and of dry months; a station may lack either."""
    m = D.station_month(spark, d)
    a = m.filter("rf > 30").groupBy("skn").agg(F.sum("rf").alias("x1"))
    b = m.filter("rf < 8").groupBy("skn").agg(F.sum("rf").alias("x2"))
    old = a.withColumn("x2", F.lit(0.0))  # a column to be replaced
    return merge.outer_columns(old, b).select("skn", F.round("x1", 6).alias("x1"), F.round("x2", 6).alias("x2"))


@query(sql("station_day", "SELECT county, count(*) AS n, round(sum(rf), 2) AS rf FROM station_day GROUP BY 1"))
def a9_county_split(spark, d):
    path = tables.scratch(spark, "counties")
    tables.write_counties(D.station_day(spark, d), path)
    return spark.read.parquet(path).groupBy("county").agg(F.count("*").alias("n"), F.round(F.sum("rf"), 2).alias("rf"))


@query("SELECT s_suppkey AS skn, s_acctbal / 1000 AS spear, CAST(s_nationkey AS BIGINT) AS target_skn FROM supplier")
def a10_parameter_tables(spark, d):
    path = tables.scratch(spark, "params")
    s = D.table(spark, d, "supplier").select(
        F.col("s_nationkey").cast("long").alias("target_skn"), F.col("s_suppkey").alias("skn"), (F.col("s_acctbal") / 1000).alias("spear")
    )
    s.write.option("header", True).csv(path)
    return tables.read_params(spark, path, "target_skn long, skn long, spear double")


@query(sql("cells", "SELECT tile, county, count(*) AS n, round(sum(value), 2) AS total FROM cells GROUP BY 1, 2"))
def a11_grid_tables(spark, d):
    path = tables.scratch(spark, "grid")
    tables.write_counties(D.cells(spark, d), path, ("county", "tile"))
    grid = tables.read_grid(spark, path, "row long, col long, value double, county string, tile long")
    return grid.groupBy("tile", "county").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query(sql("station_day", "SELECT skn, date, CASE WHEN rf * 20 <= 500 THEN rf * 20 END AS rf FROM station_day"))
def b10_outlier_cap(spark, d):
    days = D.station_day(spark, d).withColumn("rf", F.col("rf") * 20)
    return quality.cap(days, 500).select("skn", "date", "rf")


@query(sql("meta", "SELECT skn, island, county FROM meta"))
def b11_county_from_island(spark, d):
    return D.meta(spark, d).select("skn", "island", S.county_of("island").alias("county"))


@query("SELECT l_suppkey AS skn, CAST(max(l_shipdate) AS DATE) AS last_date FROM lineitem WHERE l_quantity > 47 AND l_discount > 0.07 GROUP BY 1 "
       "HAVING date_diff('day', CAST(max(l_shipdate) AS DATE), (SELECT CAST(max(l_shipdate) AS DATE) + 700 FROM lineitem)) < 730.5")  # fmt: skip
def b12_active_stations(spark, d):
    """Stations seen in the last month of the table, on a run date 700 days later; days of little rain don't count as seen."""
    rows = D.table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("skn"), F.to_date("l_shipdate").alias("date"),
        F.when((F.col("l_quantity") > 47) & (F.col("l_discount") > 0.07), F.col("l_quantity")).alias("rf"),
    )
    run = rows.agg(F.date_add(F.max("date"), 700)).first()[0]
    return gapfill.active(merge.last_obs(rows), run)


@query(sql("station_day", "SELECT skn, count(CASE WHEN rf > 20 AND skn % 5 <> 0 THEN 1 END) AS n FROM station_day GROUP BY 1 HAVING n > 0"))
def b13_drop_empty_stations(spark, d):
    days = D.station_day(spark, d).withColumn("rf", F.when((F.col("rf") > 20) & (F.col("skn") % 5 != 0), F.col("rf")))
    wide = monthly.stations_with_values(days)
    return monthly.drop_empty(wide, ["n"])


@query(sql("station_day", "SELECT CASE WHEN month(date) BETWEEN 5 AND 10 THEN 'warm' ELSE 'cool' END AS season, count(*) AS n FROM station_day GROUP BY 1"))
def b15_season(spark, d):
    return D.station_day(spark, d).groupBy(quality.season("date").alias("season")).agg(F.count("*").alias("n"))


@query(sql("network_day meta", "SELECT source_id, network, n.rf, skn, island FROM network_day n LEFT JOIN meta ON source_id = nws_id"))
def c4_attach_master(spark, d):
    got = merge.attach(D.network_day(spark, d), D.meta(spark, d), "nws_id")
    return got.select("source_id", "network", "rf", "skn", "island")


@query(sql("network_day meta", "SELECT network, source_id, count(*) AS n FROM network_day WHERE source_id NOT IN (SELECT nws_id FROM meta "
           "WHERE nws_id IS NOT NULL) GROUP BY 1, 2"))  # fmt: skip
def c5_unknown_stations(spark, d):
    got = merge.unknown(D.network_day(spark, d), D.meta(spark, d), "nws_id")
    return got.groupBy("network", "source_id").agg(F.count("*").alias("n"))


@query(sql("network_day meta", "SELECT skn, name, count(*) AS n FROM network_day JOIN meta ON source_id = nws_id GROUP BY 1, 2"))
def c6_known_stations(spark, d):
    return merge.attach(D.network_day(spark, d), D.meta(spark, d), "nws_id", "inner").groupBy("skn", "name").agg(F.count("*").alias("n"))


def _known(spark, d):
    return merge.attach(D.network_day(spark, d), D.meta(spark, d), "nws_id", "inner")


MERGED = """merged AS (SELECT skn, date, arg_min(rf, {'p': p, 'o': l_orderkey, 'k': l_partkey, 'r': rf}) AS rf,
  arg_min(network, {'p': p, 'o': l_orderkey, 'k': l_partkey, 'r': rf}) AS source FROM (SELECT *, coalesce(list_position(
  ['uhmeso', 'synoptic', 'hads', 'nws', 'madis', 'scan'], network), 2147483647) AS p FROM network_day JOIN meta ON source_id = nws_id)
  GROUP BY 1, 2)"""  # fmt: skip


def _merged(spark, d):
    return merge.dedup(_known(spark, d), order=("l_orderkey", "l_partkey", "rf"))


@query(sql("network_day meta", f"WITH {MERGED} SELECT skn, date, rf, source FROM merged"))
def e6_k18_network_priority(spark, d):
    return _merged(spark, d)


@query(sql("network_day meta", f"WITH {MERGED} SELECT skn, date, source FROM merged"))
def k18_source_table(spark, d):
    return _merged(spark, d).select("skn", "date", "source")


@query(sql("network_day meta", "SELECT network, source_id, CAST(date_trunc('month', date) AS DATE) AS month, max(date) AS last_date, count(*) AS n "
           "FROM network_day WHERE source_id NOT IN (SELECT nws_id FROM meta WHERE nws_id IS NOT NULL) GROUP BY 1, 2, 3"))  # fmt: skip
def e7_unknown_latest(spark, d):
    return merge.unknown_latest(merge.unknown(D.network_day(spark, d), D.meta(spark, d), "nws_id"))


@query(sql("network_day meta", f"""WITH {MERGED}
SELECT coalesce(network, 'SUBTOTAL') AS network, false AS is_unique, count(*) AS n FROM network_day JOIN meta ON source_id = nws_id GROUP BY ROLLUP(network)
UNION ALL SELECT coalesce(source, 'TOTAL'), true, count(*) FROM merged GROUP BY ROLLUP(source)"""))  # fmt: skip
def d6_network_counts(spark, d):
    return merge.count_log(_known(spark, d).select("network"), _merged(spark, d))


@query(sql("station_day", "SELECT skn, max(date) AS last_date FROM (SELECT skn, date FROM station_day WHERE rf > 0 UNION ALL "
           "SELECT s_suppkey, DATE '2000-06-01' FROM supplier) GROUP BY 1"))  # fmt: skip
def d7_last_observation(spark, d):
    days = D.station_day(spark, d).withColumn("rf", F.when(F.col("rf") > 0, F.col("rf")))
    history = D.table(spark, d, "supplier").select(F.col("s_suppkey").alias("skn"), F.lit("2000-06-01").cast("date").alias("last_date"))
    return merge.last_obs(days, history)


@query(sql("station_day", "SELECT skn, CAST(date_trunc('month', date) AS DATE) AS month, CASE WHEN count(CASE WHEN rf < 40 THEN 1 END) = count(*) "
           "THEN sum(rf) END AS rf, count(*) AS n_days FROM station_day GROUP BY 1, 2"))  # fmt: skip
def d8_month_total(spark, d):
    return monthly.month_total(D.station_day(spark, d).withColumn("rf", F.when(F.col("rf") < 40, F.col("rf"))))


@query(sql("station_day", """WITH s AS (SELECT county, skn, CAST(date_trunc('month', date) AS DATE) AS month, count(rf) AS n, sum(rf) AS total FROM station_day GROUP BY 1, 2, 3),
h AS (SELECT CAST(date_trunc('month', date) AS DATE) AS month, count(DISTINCT date) AS days FROM station_day GROUP BY 1),
c AS (SELECT county, s.month, count(*) AS n_stations, count(*) FILTER (n = days) AS f, any_value(days) AS days, count(*) FILTER (total > 100) AS listed
  FROM s JOIN h ON h.month = s.month GROUP BY 1, 2),
o AS (SELECT county, month, n_stations, CASE WHEN days = day(last_day(month)) THEN f ELSE 0 END AS n_complete, listed - f AS n_accumulated, listed = f AS qc FROM c),
a AS (FROM o UNION ALL SELECT 'All', month, sum(n_stations)::BIGINT, sum(n_complete)::BIGINT, sum(n_accumulated)::BIGINT, bool_and(qc) FROM o GROUP BY month),
e AS (SELECT month, CAST(unnest(generate_series(month, last_day(month), INTERVAL 1 DAY)) AS DATE) AS date FROM h),
g AS (SELECT e.month, count(*) FILTER (d.date IS NULL) AS n_missing, coalesce(string_agg(strftime(e.date, '%Y-%m-%d'), ',' ORDER BY e.date) FILTER (d.date IS NULL), '') AS missing
  FROM e LEFT JOIN (SELECT DISTINCT date FROM station_day) d ON d.date = e.date GROUP BY 1)
SELECT a.*, n_complete + n_accumulated AS n_total, n_complete > 3 AS enough, n_missing, missing FROM a JOIN g ON g.month = a.month"""))  # fmt: skip
def d9_month_completeness(spark, d):
    days = tables.written(D.station_day(spark, d), "days")
    months = days.groupBy("county", "skn", S.month_start("date").alias("month")).agg(F.sum("rf").alias("rf"))
    return monthly.completeness(days, months.withColumn("rf", F.when(F.col("rf") > 100, F.col("rf"))))


@query(sql("station_day", """WITH h AS (SELECT DISTINCT skn, date FROM station_day), m AS (SELECT DISTINCT skn, CAST(date_trunc('month', date) AS DATE) AS month FROM h),
e AS (SELECT skn, month, CAST(unnest(generate_series(month, last_day(month), INTERVAL 1 DAY)) AS DATE) AS date FROM m),
g AS (SELECT e.* FROM e LEFT JOIN h ON e.skn = h.skn AND e.date = h.date WHERE h.skn IS NULL)
SELECT m.skn, m.month, count(g.date) AS n_missing, coalesce(string_agg(strftime(g.date, '%Y-%m-%d'), ',' ORDER BY g.date), '') AS missing
FROM m LEFT JOIN g ON m.skn = g.skn AND m.month = g.month GROUP BY 1, 2"""))  # fmt: skip
def c17_missing_days(spark, d):
    return monthly.missing_days(D.station_day(spark, d), ("skn",))


STOP = """WITH t AS (SELECT skn, county, CAST(date_trunc('month', date) AS DATE) AS month, sum(rf) AS rf FROM station_day GROUP BY 1, 2, 3),
good AS (SELECT * FROM t WHERE rf % 3 <> 0), c AS (SELECT county, month, count(*) AS n FROM good GROUP BY 1, 2),
acc AS (SELECT skn, county, month, rf + 0.5 AS rf FROM t)
SELECT skn, county, month, rf, false AS stop_gap FROM good UNION ALL
SELECT a.skn, a.county, a.month, a.rf, true FROM acc a LEFT JOIN c ON a.county = c.county AND a.month = c.month
LEFT JOIN good g ON g.skn = a.skn AND g.month = a.month WHERE coalesce(n, 0) < 10 AND g.skn IS NULL"""


@query(sql("station_day", STOP))
def g4_c3_stop_gap(spark, d):
    days = D.station_day(spark, d)
    months = days.groupBy("skn", "county", S.month_start("date").alias("month")).agg(F.sum("rf").alias("rf"))
    good = months.withColumn("rf", F.when(F.col("rf") % 3 != 0, F.col("rf")))
    return monthly.stop_gap(good, months.withColumn("rf", F.col("rf") + 0.5))


@query(sql("network_day meta", "SELECT network, count(*) AS n, count(skn) AS n_skn FROM (SELECT network, skn FROM network_day JOIN meta ON source_id = nws_id "
           "UNION ALL SELECT network, NULL FROM network_day) GROUP BY 1"))  # fmt: skip
def g1_g2_union_networks(spark, d):
    both = merge.union_networks([_known(spark, d).select("network", "skn"), D.network_day(spark, d).select("network", "source_id")])
    return both.groupBy("network").agg(F.count("*").alias("n"), F.count("skn").alias("n_skn"))


@query("SELECT s_suppkey AS skn FROM supplier EXCEPT SELECT l_suppkey FROM lineitem WHERE l_quantity > 49.5 AND l_linenumber = 1")
def g3_set_difference(spark, d):
    have = D.table(spark, d, "lineitem").filter("l_quantity > 49.5 and l_linenumber = 1").select(F.col("l_suppkey").alias("skn"))
    return util.minus(D.table(spark, d, "supplier").select(F.col("s_suppkey").alias("skn")), have, ["skn"])


SCAFFOLD = """cells_ AS MATERIALIZED (SELECT s.skn, s.county, t.date, d.rf FROM (SELECT skn, county FROM meta) s JOIN (SELECT DISTINCT county, date FROM station_day) t
ON s.county = t.county LEFT JOIN station_day d ON d.skn = s.skn AND d.date = t.date)"""  # fmt: skip
PAIRS = """p AS MATERIALIZED (SELECT a.skn AS target_skn, b.skn AS skn, a.rf AS y, b.rf AS x FROM station_day a JOIN station_day b
  ON a.county = b.county AND a.date = b.date AND a.skn <> b.skn),
r AS MATERIALIZED (SELECT target_skn, skn, x, y, rank() OVER (PARTITION BY target_skn, skn ORDER BY x) + (count(*) OVER (PARTITION BY target_skn, skn, x) - 1) / 2 AS rx,
  rank() OVER (PARTITION BY target_skn, skn ORDER BY y) + (count(*) OVER (PARTITION BY target_skn, skn, y) - 1) / 2 AS ry FROM p),
rel AS MATERIALIZED (SELECT target_skn, skn, count(*) AS n, corr(rx, ry) AS spear, CASE WHEN sum(x) <> 0 THEN sum(y) / sum(x) END AS ratio FROM r GROUP BY 1, 2
  HAVING count(*) >= 20 AND corr(rx, ry) > 0.0005 AND sum(x) <> 0 AND sum(y) / sum(x) BETWEEN 0.3 AND 2.7)"""  # fmt: skip


@query(sql("station_day meta", f"WITH {SCAFFOLD} SELECT skn, county, date, rf FROM cells_"))
def c8_scaffold(spark, d):
    return gapfill.scaffold(D.meta(spark, d).select("skn", "county"), D.station_day(spark, d))


@query(sql("station_day meta", f"WITH {PAIRS} SELECT target_skn, skn, n, round(spear, 5) AS spear, round(ratio, 5) AS ratio FROM rel"))
def k14_relations(spark, d):
    return gapfill.relations(D.station_day(spark, d), 0.0005, 20).select("target_skn", "skn", "n", F.round("spear", 5).alias("spear"), F.round("ratio", 5).alias("ratio"))


FILLED = f"""WITH {SCAFFOLD}, {PAIRS}, ranked AS (SELECT h.skn, h.date, s.rf * rel.ratio AS est, row_number() OVER (PARTITION BY h.skn, h.date
  ORDER BY round(spear, 9) DESC, rel.skn) AS place FROM cells_ h JOIN rel ON rel.target_skn = h.skn JOIN station_day s ON s.skn = rel.skn AND s.date = h.date
  WHERE h.rf IS NULL), est AS (SELECT skn, date, avg(est) AS est, count(*) AS n FROM ranked WHERE place <= 3 GROUP BY 1, 2)"""  # fmt: skip


def _cells_and_estimates(spark, d):
    """The scaffold and the estimates for its holes; days, scaffold and relations are each written once."""
    days = tables.written(D.station_day(spark, d), "days")
    cells = tables.written(gapfill.scaffold(D.meta(spark, d).select("skn", "county"), days), "cells")
    pairs = tables.written(gapfill.relations(days, 0.0005, 20).withColumn("spear", F.round("spear", 9)), "relations")
    return cells, gapfill.estimates(cells, days, pairs)


@query(sql("station_day meta", FILLED + " SELECT skn, date, round(est, 8) AS est, n FROM est"))
def c9_e9_h13_predictor_estimates(spark, d):
    return _cells_and_estimates(spark, d)[1].select("skn", "date", F.round("est", 8).alias("est"), "n")


@query(sql("station_day meta", FILLED + " SELECT c.skn, c.county, c.date, round(coalesce(c.rf, est), 8) AS rf, c.rf IS NULL AND est IS NOT NULL AS is_fill "
           "FROM cells_ c LEFT JOIN est ON est.skn = c.skn AND est.date = c.date"))  # fmt: skip
def k13_gap_fill(spark, d):
    return gapfill.fill(*_cells_and_estimates(spark, d)).withColumn("rf", F.round("rf", 8))


@query(sql("station_day meta", FILLED + """, f AS (SELECT c.date, c.rf AS a, coalesce(c.rf, est) AS b FROM cells_ c LEFT JOIN est ON est.skn = c.skn AND est.date = c.date)
SELECT date, count(*) AS n, count(*) - count(a) AS empty_before, count(*) - count(b) AS empty_after,
CASE WHEN count(*) > count(a) THEN round((count(b) - count(a)) * 100.0 / (count(*) - count(a)), 3) END AS filled_percent FROM f GROUP BY 1"""))  # fmt: skip
def d11_fill_tally(spark, d):
    cells, found = _cells_and_estimates(spark, d)
    return gapfill.tally(cells, gapfill.fill(cells, found))


@query(sql("station_day", "SELECT date, count(*) AS n_raw, count(*) FILTER (rf < 45) AS n_passed, count(*) - count(*) FILTER (rf < 45) AS n_removed, "
           "round((count(*) - count(*) FILTER (rf < 45)) / count(*), 3) AS fraction FROM station_day GROUP BY 1"))  # fmt: skip
def d10_qc_tally(spark, d):
    days = D.station_day(spark, d)
    return quality.tally(days, days.filter("rf < 45"))


@query(sql("station_day", "SELECT county, date, count(*) AS n, count(*) >= 11 AS qc, count(*) >= 3 AS map FROM station_day GROUP BY 1, 2"))
def b16_group_guards(spark, d):
    got = D.station_day(spark, d).groupBy("county", "date").agg(F.count("*").alias("n"))
    return got.select("*", (F.col("n") >= 11).alias("qc"), (F.col("n") >= 3).alias("map"))


@query(sql("station_month", "SELECT skn, month, rf, row_number() OVER (ORDER BY rf DESC, skn, month) AS place FROM station_month QUALIFY place <= 100"))
def f1_sorted_report(spark, d):
    """The 100 wettest station-months in order: a top-k report, so Spark keeps 100 rows a task."""
    top = util.numbered(D.station_month(spark, d).select("skn", "month", "rf"), 100, F.col("rf").desc(), "skn", "month")
    return util.sort_for_output(top.withColumn("place", F.col("place").cast("long")), "place")


@query(sql("station_month", "SELECT county, month, skn, rf FROM station_month QUALIFY row_number() OVER (PARTITION BY county, month ORDER BY rf DESC, skn) <= 3"))
def f2_top_k_per_group(spark, d):
    m = D.station_month(spark, d).select("county", "month", "skn", "rf")
    return util.top_k(m, ["county", "month"], 3, F.col("rf").desc(), "skn")


@query("SELECT l_linenumber, coalesce(list_position(['uhmeso', 'synoptic', 'hads', 'nws', 'madis', 'scan'], network), 2147483647)::BIGINT AS rank "
       "FROM (SELECT DISTINCT l_linenumber, ['scan', 'madis', 'nws', 'hads', 'synoptic', 'uhmeso', 'other'][l_linenumber] AS network FROM lineitem)")  # fmt: skip
def f3_custom_order(spark, d):
    lines = D.table(spark, d, "lineitem").select("l_linenumber").distinct()
    names = F.array(*(F.lit(x) for x in D.NETWORKS))
    return lines.select("l_linenumber", S.rank_in(F.get(names, F.col("l_linenumber") - 1), merge.PRIORITY).alias("rank"))
