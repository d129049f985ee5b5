"""Queries over readings: feeds, filters, increments, totals, accumulators and precedence."""

from __future__ import annotations

from pyspark.sql import functions as F

from rainspark.functions import scalars as S
from rainspark.operators import ingest, merge
from rainspark.plans import testdata as D
from rainspark.plans.registry import query
from rainspark.plans.testdata import sql
from rainspark.sources import tables

LEAST = 0.1


@query(sql("gauge_days", "SELECT station, date, round(rf, 4) AS rf, n_obs, obs_int_mins, round(data_per, 6) AS data_per "
           "FROM gauge_days WHERE data_per >= 0.1"))  # fmt: skip
def slice_station_days(spark, d):
    """The minimum slice: accumulating gauges to complete station-days."""
    got = ingest.station_days(D.gauge(spark, d), LEAST)
    return got.select("station", "date", F.round("rf", 4).alias("rf"), "n_obs", "obs_int_mins", F.round("data_per", 6).alias("data_per"))


@query("SELECT event_id AS seq, event_type AS var, value, date_trunc('minute', ts) AS ts, CAST(ts AS DATE) AS file_day FROM events")
def a1_read_feed(spark, d):
    path = tables.scratch(spark, "feed")
    e = D.table(spark, d, "events")
    feed = e.select(
        F.col("user_id").cast("string").alias("station"),
        F.col("event_type").alias("var"),
        F.date_format("ts", "yyyy-MM-dd HH:mm").alias("ts_text"),
        "value",
        F.lit("HADS").alias("provider"),
        F.col("event_id").alias("seq"),
        F.to_date("ts").alias("file_day"),
    )
    tables.write_feed(feed, path)
    return tables.read_feed(spark, path).select("seq", "var", "value", "ts", "file_day")


@query("SELECT event_type AS var, count(*) AS n FROM events GROUP BY 1")
def a2_tolerant_read(spark, d):
    have = spark.read.parquet(f"{d}/events.parquet")
    missing = tables.read_or_empty(spark, tables.scratch(spark, "absent"), have.schema)
    return have.unionByName(missing).groupBy(F.col("event_type").alias("var")).agg(F.count("*").alias("n"))


@query(sql("meta", "SELECT skn, name, island, lat, lon, nws_id, lpad(CAST(skn AS VARCHAR), 8, '0') AS nesdis_id FROM meta"))
def a3_read_meta(spark, d):
    path = tables.scratch(spark, "meta")
    m = D.meta(spark, d).select(
        "skn", "name", "island", F.lit(None).cast("string").alias("network"), F.lit(0.0).alias("elev"), "lat", "lon",
        F.lpad(F.col("skn").cast("string"), 8, "0").alias("nesdis_id"), "nws_id", F.lit(None).cast("string").alias("scan_id"),
    )
    m.write.option("header", True).csv(path)
    return tables.read_meta(spark, path).select("skn", "name", "island", "lat", "lon", "nws_id", "nesdis_id")


@query("SELECT event_id AS seq, value FROM events WHERE event_type IN ('click', 'view')")
def b1_keep_rain_variables(spark, d):
    e = D.table(spark, d, "events").withColumnRenamed("event_id", "seq")
    return ingest.keep_rain(e, ("click", "view"), "event_type").select("seq", "value")


@query("SELECT event_id AS seq FROM events WHERE event_id % 3 <> 0 OR event_id % 2 = 0")
def b2_drop_random_samples(spark, d):
    seq = F.col("event_id")
    flag = F.when(seq % 3 != 0, F.lit(" ")).when(seq % 2 == 1, F.lit("R"))
    return ingest.drop_random(D.table(spark, d, "events").select(seq.alias("seq"), flag.alias("random")), "random")


@query("SELECT event_id AS seq, value FROM events WHERE event_id % 7 <> 0 AND value > 1")
def b3_complete_cases(spark, d):
    e = D.table(spark, d, "events")
    rows = e.select(F.when(F.col("event_id") % 7 != 0, F.col("event_id")).alias("seq"), F.when(F.col("value") > 1, F.col("value")).alias("value"))
    return ingest.complete_cases(rows)


@query("SELECT l_shipmode AS provider, count(*) AS n FROM (SELECT ['HADS','RAWS','MesoWest','HF-METAR','X'][user_id % 5 + 1] AS l_shipmode "
       "FROM events) WHERE l_shipmode IN ('HADS','RAWS','MesoWest') GROUP BY 1")  # fmt: skip
def b4_provider_lists(spark, d):
    names = F.array(*(F.lit(x) for x in ("HADS", "RAWS", "MesoWest", "HF-METAR", "X")))
    e = D.table(spark, d, "events").select(F.get(names, (F.col("user_id") % 5).cast("int")).alias("provider"))
    kept = ingest.allow(e, "provider", ["HADS", "RAWS", "MesoWest", "HF-METAR"], ["HF-METAR"])
    return kept.groupBy("provider").agg(F.count("*").alias("n"))


@query("SELECT event_id AS seq, round(value * 25.4, 4) AS mm, event_id % 100 AS number FROM events")
def b5_units_casts_rounding(spark, d):
    text = F.when(F.col("event_id") >= 0, (F.col("event_id") % 100).cast("string"))
    return D.table(spark, d, "events").select(
        F.col("event_id").alias("seq"), F.round(S.inches_to_mm("value"), 4).alias("mm"), text.try_cast("long").alias("number")
    )


@query(sql("gauge_days", "SELECT station, date, round(data_per, 6) AS data_per FROM gauge_days "
           "WHERE data_per >= 0.2 AND date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'"))  # fmt: skip
def b6_complete_days(spark, d):
    rows = D.gauge_rows(spark, d)
    days = ingest.daily_totals(ingest.hourly_totals(rows, "diff"), ingest.interval_mode(rows))
    got = ingest.complete_days(days, 0.2, F.lit("2024-01-05").cast("date"), F.lit("2024-01-20").cast("date"))
    return got.select("station", "date", F.round("data_per", 6).alias("data_per"))


@query(sql("gauge_rows", "SELECT station, date AS file_day, count(*) AS n FROM gauge_rows GROUP BY 1, 2 HAVING count(DISTINCT ts) >= 6"))
def b7_enough_readings(spark, d):
    rows = D.gauge_rows(spark, d).withColumnRenamed("date", "file_day")
    return ingest.enough_readings(rows, 6).groupBy("station", "file_day").agg(F.count("*").alias("n"))


@query("SELECT CASE WHEN user_id % 10 = 0 THEN 'PHNL' WHEN user_id % 10 = 1 THEN 'PHTO' ELSE 'S' || user_id % 10 END AS id, CAST(ts AS DATE) AS date, "
       "round(sum(value), 4) AS rf, count(*) AS hour_count FROM events GROUP BY 1, 2 HAVING count(*) >= 23")  # fmt: skip
def d5_b8_b9_hourly_feed(spark, d):
    user = F.col("user_id") % 10
    e = D.table(spark, d, "events").select(
        F.when(user == 0, "HNL").when(user == 1, "HTO").otherwise(F.concat(F.lit("S"), user.cast("string"))).alias("id"),
        F.lit("n").alias("name"), F.to_date("ts").alias("date"), F.col("value").alias("rf"),
    )
    got = ingest.hourly_feed_to_daily(e, 23)
    return got.select(ingest.airport_id("id").alias("id"), "date", F.round("rf", 4).alias("rf"), "hour_count")


ACC = """WITH mid AS (SELECT station, CAST(ts - INTERVAL 10 HOUR AS DATE) AS day, value AS v FROM gauge_first
  WHERE date_trunc('day', ts - INTERVAL 10 HOUR) = ts - INTERVAL 10 HOUR)
SELECT a.station, a.day AS date, round(b.v - a.v, 4) AS rf FROM mid a JOIN mid b ON a.station = b.station AND b.day = a.day + 1
WHERE b.v - a.v >= 0"""


@query(sql("gauge_first", ACC))
def c1_accumulator_24h(spark, d):
    got = ingest.accumulator_24h(ingest.first_per_instant(D.gauge(spark, d)))
    return got.select("station", "date", F.round("rf", 4).alias("rf"))


@query(sql("gauge_first", """WITH r AS (SELECT station, value,
  make_timestamp(CAST(floor((epoch(ts) - 36000 + 10800) / 21600) AS BIGINT) * 21600000000) AS clock FROM gauge_first),
mid AS (SELECT station, CAST(clock AS DATE) AS day, min(value) AS low, max(value) AS high FROM r
  WHERE date_trunc('day', clock) = clock GROUP BY 1, 2)
SELECT a.station, a.day AS date, round(b.high - a.low, 4) AS rf FROM mid a JOIN mid b ON a.station = b.station AND b.day = a.day + 1
WHERE round(b.high - a.low, 4) >= 0"""))  # fmt: skip
def c2_accumulator_24h_rounded(spark, d):
    return ingest.accumulator_24h_rounded(ingest.first_per_instant(D.gauge(spark, d)), minutes=360)


MONTH = """WITH r AS (SELECT o_custkey % 20 AS station, o_orderdate AS ts, max(o_totalprice) AS value FROM orders GROUP BY 1, 2),
mid AS (SELECT station, CAST(ts AS DATE) AS month, value AS v FROM r WHERE day(ts) = 1)
SELECT a.station, a.month, round(b.v - a.v, 2) AS rf FROM mid a JOIN mid b ON a.station = b.station AND b.month = a.month + INTERVAL 1 MONTH
WHERE b.v - a.v >= 0"""


@query(MONTH)
def c3_accumulator_month(spark, d):
    o = D.table(spark, d, "orders")
    rows = o.groupBy((F.col("o_custkey") % 20).alias("station"), F.col("o_orderdate").alias("day")).agg(F.max("o_totalprice").alias("value"))
    rows = rows.withColumn("ts", F.col("day") + F.expr("INTERVAL 10 HOURS"))  # local midnight
    return ingest.accumulator_month(rows).select("station", "month", F.round("rf", 2).alias("rf"))


@query(sql("readings", "SELECT station, date_trunc('hour', ts - INTERVAL 10 HOUR - INTERVAL 1 SECOND) AS hour, round(sum(value), 4) AS rf, "
           "count(*) AS n_obs FROM readings GROUP BY 1, 2"))  # fmt: skip
def d1_hourly_totals(spark, d):
    got = ingest.hourly_totals(ingest.with_day(D.readings(spark, d)))
    return got.select("station", "hour", F.round("rf", 4).alias("rf"), "n_obs")


@query(sql("gauge_days", "SELECT station, date, round(rf, 4) AS rf, n_obs FROM gauge_days"))
def d2_accumulated_daily(spark, d):
    got = ingest.daily_totals(ingest.hourly_totals(D.gauge_rows(spark, d), "diff"))
    return got.select("station", "date", F.round("rf", 4).alias("rf"), "n_obs")


@query(sql("gauge_days", "SELECT station, date, n_obs, round(data_per, 6) AS data_per FROM gauge_days"))
def d3_completeness(spark, d):
    rows = D.gauge_rows(spark, d)
    got = ingest.daily_totals(ingest.hourly_totals(rows, "diff"), ingest.interval_mode(rows))
    return got.select("station", "date", "n_obs", F.round("data_per", 6).alias("data_per"))


@query(sql("modes", "SELECT station, obs_int_mins FROM modes"))
def d4_modal_interval(spark, d):
    return ingest.interval_mode(D.gauge_rows(spark, d))


@query(sql("gauge_rows", "SELECT station, ts, round(diff, 4) AS diff FROM gauge_rows"))
def e1_lag_difference(spark, d):
    return D.gauge_rows(spark, d).select("station", "ts", F.round("diff", 4).alias("diff"))


@query(sql("gauge_rows", "SELECT station, ts, intv AS minutes FROM gauge_rows"))
def e2_lag_interval(spark, d):
    return D.gauge_rows(spark, d).select("station", "ts", F.col("interval").alias("minutes"))


@query(sql("readings", "SELECT station, ts, min(seq) AS seq, arg_min(value, seq) AS value, arg_min(var, seq) AS var FROM readings GROUP BY 1, 2"))
def e3_first_per_instant(spark, d):
    return ingest.first_per_instant(D.readings(spark, d)).select("station", "ts", "seq", "value", "var")


PREFER = """WITH mid AS (SELECT station, CAST(ts - INTERVAL 10 HOUR AS DATE) AS day, value AS v FROM gauge_first
  WHERE date_trunc('day', ts - INTERVAL 10 HOUR) = ts - INTERVAL 10 HOUR),
acc AS (SELECT a.station, a.day AS date, b.v - a.v AS rf FROM mid a JOIN mid b ON a.station = b.station AND b.day = a.day + 1
  WHERE b.v - a.v >= 0),
pp AS (SELECT station, CAST(ts - INTERVAL 10 HOUR - INTERVAL 1 SECOND AS DATE) AS date, sum(value) AS rf FROM readings GROUP BY 1, 2),
every AS (SELECT station, date, rf, 0 AS method FROM gauge_days WHERE data_per >= 0.3
  UNION ALL SELECT station, date, rf, 1 FROM acc
  UNION ALL SELECT station, date, rf, 2 FROM gauge_days WHERE data_per >= 0.2 AND data_per < 0.3
  UNION ALL SELECT station, date, rf, 3 FROM pp)
SELECT station, date, min(method) AS method, round(arg_min(rf, method), 4) AS rf FROM every GROUP BY 1, 2"""


@query(sql("readings gauge_days gauge_first", PREFER))
def e4_method_precedence(spark, d):
    rows = D.gauge_rows(spark, d)
    days = ingest.daily_totals(ingest.hourly_totals(rows, "diff"), ingest.interval_mode(rows))
    plain = ingest.daily_totals(ingest.hourly_totals(ingest.with_day(D.readings(spark, d))))
    cols = ["station", "date", "rf"]
    whole, part = days.filter("data_per >= 0.3"), days.filter("data_per >= 0.2 and data_per < 0.3")
    got = ingest.prefer([x.select(*cols) for x in (whole, ingest.accumulator_24h(rows), part, plain)])
    return got.select("station", "date", "method", F.round("rf", 4).alias("rf"))


@query(sql("readings gauge_days gauge_first", PREFER.replace("data_per >= 0.3", "data_per >= 0.2").replace(
    "  UNION ALL SELECT station, date, rf, 2 FROM gauge_days WHERE data_per >= 0.2 AND data_per < 0.3\n", "").replace(
    "\n  UNION ALL SELECT station, date, rf, 3 FROM pp", "")))
def e5_lag_before_24h(spark, d):
    rows = D.gauge_rows(spark, d)
    days = ingest.daily_totals(ingest.hourly_totals(rows, "diff"), ingest.interval_mode(rows)).filter("data_per >= 0.2")
    got = ingest.prefer([days.select("station", "date", "rf"), ingest.accumulator_24h(rows)])
    return got.select("station", "date", "method", F.round("rf", 4).alias("rf"))


@query("SELECT event_id AS seq, date_trunc('minute', ts) AS minute, date_trunc('second', ts) AS second, date_trunc('second', ts) AS iso FROM events")
def h1_parse_utc(spark, d):
    forms = {"minute": "yyyy-MM-dd HH:mm", "second": "yyyy-MM-dd HH:mm:ss", "iso": "yyyy-MM-dd'T'HH:mm:ss'Z'"}
    e = D.table(spark, d, "events").select(F.col("event_id").alias("seq"), *(F.date_format("ts", f).alias(k) for k, f in forms.items()))
    return e.select("seq", *(S.parse_utc(k, k).alias(k) for k in forms))


@query("SELECT event_id AS seq, ts - INTERVAL 10 HOUR - INTERVAL 1 SECOND AS local, "
       "CAST(ts - INTERVAL 10 HOUR - INTERVAL 1 SECOND AS DATE) AS date FROM events")  # fmt: skip
def h2_local_time(spark, d):
    return ingest.with_day(D.table(spark, d, "events")).select(F.col("event_id").alias("seq"), "local", "date")


@query("SELECT event_id AS seq, date_trunc('hour', ts) AS hour, "
       "make_timestamp(CAST(floor((floor(epoch(ts)) + 300) / 600) AS BIGINT) * 600000000) AS ten FROM events")  # fmt: skip
def h3_truncate_and_round(spark, d):
    return D.table(spark, d, "events").select(
        F.col("event_id").alias("seq"), S.floor_time("ts", 3600).alias("hour"), S.round_time("ts", 600).alias("ten")
    )


@query("SELECT DISTINCT CAST(o_orderdate AS DATE) AS date, strftime(o_orderdate, '%Y_%m') AS key, CAST(date_trunc('month', o_orderdate) AS DATE) "
       "AS first, last_day(CAST(o_orderdate AS DATE)) AS last, day(last_day(CAST(o_orderdate AS DATE))) AS n_days, "
       "strftime(o_orderdate, 'X%Y.%m.%d') AS wide FROM orders")  # fmt: skip
def h4_date_keys(spark, d):
    o = D.table(spark, d, "orders").select(F.to_date("o_orderdate").alias("date")).distinct()
    return o.select(
        "date", S.file_key("date").alias("key"), S.month_start("date").alias("first"), F.last_day("date").alias("last"),
        F.size(S.days_of_month("date")).cast("long").alias("n_days"), S.wide_name("date").alias("wide"),
    )


@query("SELECT s_suppkey AS skn, upper(trim('  ' || s_name || ' ')) AS up, right(s_name, 3) AS tail, replace(s_name, '#', '-') AS dashed, "
       "lower(s_name) || '_' || s_suppkey AS pasted FROM supplier")  # fmt: skip
def h5_text(spark, d):
    n = F.col("s_name")
    return D.table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("skn"), F.upper(F.trim(F.concat(F.lit("  "), n, F.lit(" ")))).alias("up"),
        F.right(n, F.lit(3)).alias("tail"), F.regexp_replace(n, "#", "-").alias("dashed"),
        F.concat_ws("_", F.lower(n), F.col("s_suppkey").cast("string")).alias("pasted"),
    )


@query(sql("gauge_rows", "SELECT station, ts, round(diff, 4) AS diff, round(intv, 4) AS intv FROM gauge_rows"))
def e1_e2_long_backfill(spark, d):
    got = ingest.increments_long(ingest.first_per_instant(D.gauge(spark, d)))
    return got.select("station", "ts", F.round("diff", 4).alias("diff"), F.round("interval", 4).alias("intv"))


#: Column names of each network's feed in a1_network_feeds, in the order of files of even days; odd days have them reversed.
LAYOUT = {
    "hads": ["staID", "NWS_sid", "var", "obs_time", "value", "random"],
    "madis": ["varname", "stationId", "dataProvider", "time", "value"],
    "uhmeso": ["nws_id", "variable", "timestamp", "value"],
    "synoptic": ["Station_ID", "Date_Time", "var", "value"],
    "nws": ["nwsli", "NWS_name", "date", "prec_mm_1hr"],
}


@query("""WITH e AS (SELECT *, event_id % 7 AS k, CAST(ts AS DATE) AS day FROM events),
u AS (SELECT 'hads' AS network, user_id, day, value * 25.4 AS mm FROM e WHERE k IN (0, 1) AND event_id % 3 <> 0
UNION ALL SELECT 'madis', user_id, day, value FROM e WHERE k IN (0, 1) AND event_id % 5 <> 0
UNION ALL SELECT 'uhmeso', user_id, day, value FROM e WHERE k IN (0, 1)
UNION ALL SELECT 'synoptic', user_id, day, value FROM e WHERE k IN (0, 1)
UNION ALL SELECT 'nws', user_id, day, value FROM e)
SELECT network, 'S' || user_id AS station, day AS file_day, count(*) AS n, round(sum(mm), 3) AS mm FROM u GROUP BY 1, 2, 3""")
def a1_network_feeds(spark, d):
    """Every event as a row of each network's own file, with names of columns of its own and two orders of them, read back as
    rain; one day of the list has no file."""
    e = D.table(spark, d, "events")
    out = []
    for network, columns in LAYOUT.items():
        feed, rain = tables.FEEDS[network], tables.FEED_RAIN[network]
        formats = {"minute": "yyyy-MM-dd HH:mm", "second": "yyyy-MM-dd HH:mm:ss", "iso": "yyyy-MM-dd'T'HH:mm:ss'Z'", "day": "yyyy-MM-dd"}
        cells = {
            feed.station: F.concat(F.lit("S"), F.col("user_id").cast("string")),
            feed.variable: F.when(F.col("event_id") % 7 < 2, F.get(F.array(*(F.lit(x) for x in (rain * 2)[:2])), (F.col("event_id") % 7).cast("int"))).otherwise("T") if rain else None,
            feed.time: F.date_format("ts", formats[feed.kind]),
            feed.value: F.col("value").cast("string"),
            feed.sample_flag: F.when(F.col("event_id") % 3 == 0, "R").otherwise(" "),
            feed.provider: F.when(F.col("event_id") % 5 == 0, "HF-METAR").otherwise("HADS"),
            feed.name: F.lit("n"),
        }
        path = tables.scratch(spark, network)
        odd = F.dayofmonth("ts") % 2 == 1
        for part, order in ((~odd, columns), (odd, columns[::-1])):
            rows = e.filter(part).select(*(cells[c].alias(c) for c in order), F.date_format("ts", "yyyyMMdd").alias("file_day"))
            tables.write_feed(rows, path)
        got = tables.rain_of_feed(tables.read_network_feed(spark, [path, f"{path}/file_day=19000101"], network), network)
        out.append(got.select(F.lit(network).alias("network"), "station", "file_day", "value"))
    every = merge.union_networks(out)
    return every.groupBy("network", "station", "file_day").agg(F.count("*").alias("n"), F.round(F.sum("value"), 3).alias("mm"))
