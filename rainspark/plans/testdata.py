"""Views of the supplied tables in the roles of gauge data, in Spark and in SQL.

readings      events: 50 stations, times to 10 minutes (so instants repeat), event_id as order of arrival
gauge         readings as an accumulating gauge: running sum in hundredths, modulo 1000, so that it resets
station_day   lineitem: supplier and ship date, least quantity less 1 (zeros occur, days are missing)
network_day   lineitem: line number as network, 7 unknown
meta          supplier, nation and region: islands by nation, places by arithmetic
cells         part: grid cells of 33 x 50 a tile, price as value
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rainspark.functions import scalars as S
from rainspark.operators import ingest

ISLANDS = ["BI", "OA", "KA", "MA", "KO", "LA", "MO"]
NETWORKS = ["scan", "madis", "nws", "hads", "synoptic", "uhmeso", "other"]
WEST, NORTH, STEP = -160.0, 22.2, 0.1


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def readings(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(
        (F.col("user_id") % 50).alias("station"),
        F.col("event_type").alias("var"),
        S.floor_time("ts", 600).alias("ts"),
        "value",
        F.col("event_id").alias("seq"),
    )


def gauge(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("station").orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum(S.cents("value")).over(w) % 100_000
    return readings(spark, d).select("station", "ts", (total / 100.0).alias("value"), "seq")


def gauge_rows(spark: SparkSession, d: str) -> DataFrame:
    """gauge, first reading of each instant, with local time, date, diff and interval."""
    return ingest.increments_long(ingest.with_day(ingest.first_per_instant(gauge(spark, d))))


def station_day(spark: SparkSession, d: str) -> DataFrame:
    """One shuffle, by station: its days, its county and what is made of its months stay in the task that has the station."""
    lines = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("skn"), F.to_date("l_shipdate").alias("date"), "l_quantity")
    days = lines.repartition("skn").groupBy("skn", "date").agg((F.min("l_quantity") - 1).alias("rf"))
    return days.join(meta(spark, d).select("skn", "county").hint("shuffle_hash"), "skn").select("skn", "county", "date", "rf")


def network_day(spark: SparkSession, d: str) -> DataFrame:
    names = F.array(*(F.lit(x) for x in NETWORKS))
    return table(spark, d, "lineitem").select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("source_id"),
        F.to_date("l_shipdate").alias("date"),
        F.get(names, F.col("l_linenumber") - 1).alias("network"),
        F.col("l_quantity").alias("rf"),
        "l_orderkey",
        "l_partkey",
    )


def meta(spark: SparkSession, d: str) -> DataFrame:
    """Stations whose number ends in 9 have no network id, so that unknown rows exist."""
    key = F.col("s_suppkey")
    island = F.get(F.array(*(F.lit(x) for x in ISLANDS)), F.col("s_nationkey") % 7)
    return table(spark, d, "supplier").select(
        key.alias("skn"),
        F.col("s_name").alias("name"),
        island.alias("island"),
        S.county_of(island).alias("county"),
        (-160 + (key * 37 % 500) / 100.0).alias("lon"),
        (18.9 + (key * 53 % 330) / 100.0).alias("lat"),
        F.when(key % 10 != 9, F.concat(F.lit("S"), key.cast("string"))).alias("nws_id"),
    )


def cells(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    row, col = F.floor(k / 50) % 33, k % 50
    county = F.when(col < 13, "BI").when(col < 26, "MN").when(col < 38, "OA").otherwise("KA")
    return table(spark, d, "part").select(
        F.floor(k / 1650).alias("tile"),
        row.alias("row"),
        col.alias("col"),
        (WEST + (col + 0.5) * STEP).alias("lon"),
        (NORTH - (row + 0.5) * STEP).alias("lat"),
        F.col("p_retailprice").alias("value"),
        county.alias("county"),
    )


def placed_days(spark: SparkSession, d: str) -> DataFrame:
    """station_day with the station's place."""
    return station_day(spark, d).join(meta(spark, d).select("skn", "lon", "lat").hint("shuffle_hash"), "skn")


def in_cell(df: DataFrame) -> DataFrame:
    """Adds row and col of the grid cell."""
    return df.withColumn("row", F.floor((NORTH - F.col("lat")) / STEP)).withColumn("col", F.floor((F.col("lon") - WEST) / STEP))


def rain_params(spark: SparkSession, d: str) -> DataFrame:
    """Log-normal parameters of each cell (from its mean over all tiles) by season."""
    shift = F.when(F.col("season") == "warm", -0.2).when(F.col("season") == "cool", 0.2).otherwise(0.0)
    seasons = F.explode(F.array(*(F.lit(x) for x in ("warm", "cool", "year")))).alias("season")
    grid = cells(spark, d).groupBy("row", "col").agg(F.round(F.avg("value"), 6).alias("value")).select("row", "col", "value", seasons)
    return grid.select(
        "row", "col", "season", (1 + F.col("value") / 2000 + shift).alias("meanlog"),
        (1 + F.col("row") % 3 / 10).alias("sdlog"), (0.3 + F.col("col") % 5 / 10).alias("pop"),
    )


ADDED = (-1, 0, 1, 10, 100, 1000, 10000)


def vario_params(spark: SparkSession, d: str) -> DataFrame:
    """Variogram parameters by county, month of the year and added constant; those of December and 10000 are missing."""
    rows = meta(spark, d).select("county").distinct().select("county", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month"))
    rows = rows.select("county", "month", F.explode(F.array(*(F.lit(x) for x in ADDED))).alias("added"))
    rows = rows.filter("not (month = 12 and added = 10000)")
    return rows.select(
        "county", "month", "added", (0.05 + F.col("month") / 100).alias("nugget"), (0.3 + F.col("month") / 50).alias("range"),
        (0.6 + F.abs("added") % 7 / 10).alias("sill"),
    )


def station_month(spark: SparkSession, d: str) -> DataFrame:
    """Mean rain of each station and month, with its place."""
    days = station_day(spark, d).groupBy("skn", S.month_start("date").alias("month")).agg(F.round(F.avg("rf"), 6).alias("rf"))
    return days.join(meta(spark, d).select("skn", "county", "lon", "lat").hint("shuffle_hash"), "skn")


def _prob_sql(mu: str, sd: str, pop: str) -> str:
    """Zero-inflated log-normal probability of s.rf, with the normal distribution by the same approximation."""
    z = f"((ln(CASE WHEN s.rf > 0 THEN s.rf ELSE 1 END) - {mu}) / {sd})"
    k = f"(1 / (1 + 0.2316419 * abs({z})))"
    u = (f"(exp(-{z} * {z} / 2) * 0.3989422804014327 * {k} * (0.319381530 + {k} * (-0.356563782 + {k} * (1.781477937 + {k} * "
         f"(-1.821255978 + {k} * 1.330274429)))))")  # fmt: skip
    return f"CASE WHEN s.rf > 0 THEN (1 - {pop}) + {pop} * (CASE WHEN {z} >= 0 THEN 1 - {u} ELSE {u} END) ELSE 1 - {pop} END"


_NAMES = "[" + ", ".join(f"'{x}'" for x in NETWORKS) + "]"
_ISLES = "[" + ", ".join(f"'{x}'" for x in ISLANDS) + "]"
VIEWS = {
    "readings": """SELECT user_id % 50 AS station, event_type AS var,
        make_timestamp(CAST(floor(epoch(ts) / 600) AS BIGINT) * 600000000) AS ts, value, event_id AS seq FROM events""",
    "gauge": """SELECT station, ts, CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY station ORDER BY ts, seq
        ROWS UNBOUNDED PRECEDING) AS BIGINT) % 100000 / 100.0 AS value, seq FROM readings""",
    "gauge_first": "SELECT station, ts, min(seq) AS seq, arg_min(value, seq) AS value FROM gauge GROUP BY station, ts",
    "gauge_rows": """SELECT *, CAST(ts - INTERVAL 10 HOUR - INTERVAL 1 SECOND AS DATE) AS date,
        ts - INTERVAL 10 HOUR - INTERVAL 1 SECOND AS local,
        CASE WHEN value - lag(value) OVER w >= 0 THEN value - lag(value) OVER w END AS diff,
        (epoch(ts) - epoch(lag(ts) OVER w)) / 60 AS intv
        FROM gauge_first WINDOW w AS (PARTITION BY station ORDER BY ts)""",
    "modes": """SELECT station, arg_max(intv, {'n': n, 's': -epoch(seen)}) AS obs_int_mins FROM (
        SELECT station, intv, count(*) AS n, min(ts) AS seen FROM gauge_rows WHERE intv IS NOT NULL GROUP BY station, intv)
        GROUP BY station""",
    "gauge_days": """SELECT d.*, obs_int_mins, n_obs * obs_int_mins / 1440 AS data_per FROM (
        SELECT station, date, coalesce(sum(diff), 0) AS rf, count(*) AS n_obs FROM gauge_rows GROUP BY station, date) d
        LEFT JOIN modes USING (station)""",
    "meta": f"""SELECT s_suppkey AS skn, s_name AS name, {_ISLES}[s_nationkey % 7 + 1] AS island,
        CASE {_ISLES}[s_nationkey % 7 + 1] WHEN 'BI' THEN 'BI' WHEN 'OA' THEN 'OA' WHEN 'KA' THEN 'KA' ELSE 'MN' END AS county,
        -160 + (s_suppkey * 37 % 500) / 100.0 AS lon, 18.9 + (s_suppkey * 53 % 330) / 100.0 AS lat,
        CASE WHEN s_suppkey % 10 <> 9 THEN 'S' || s_suppkey END AS nws_id FROM supplier""",
    "station_day": """SELECT l_suppkey AS skn, county, CAST(l_shipdate AS DATE) AS date, min(l_quantity) - 1 AS rf
        FROM lineitem JOIN meta ON skn = l_suppkey GROUP BY 1, 2, 3""",
    "network_day": f"""SELECT 'S' || l_suppkey AS source_id, CAST(l_shipdate AS DATE) AS date, {_NAMES}[l_linenumber] AS network,
        l_quantity AS rf, l_orderkey, l_partkey FROM lineitem""",
    "cells": """SELECT p_partkey // 1650 AS tile, p_partkey // 50 % 33 AS row, p_partkey % 50 AS col,
        -160.0 + (p_partkey % 50 + 0.5) * 0.1 AS lon, 22.2 - (p_partkey // 50 % 33 + 0.5) * 0.1 AS lat, p_retailprice AS value,
        CASE WHEN p_partkey % 50 < 13 THEN 'BI' WHEN p_partkey % 50 < 26 THEN 'MN' WHEN p_partkey % 50 < 38 THEN 'OA' ELSE 'KA' END
        AS county FROM part""",
    "rain_params": """SELECT row, col, season, 1 + value / 2000 + CASE season WHEN 'warm' THEN -0.2 WHEN 'cool' THEN 0.2 ELSE 0 END AS meanlog,
        1 + row % 3 / 10 AS sdlog, 0.3 + col % 5 / 10 AS pop FROM (SELECT row, col, round(avg(value), 6) AS value FROM cells GROUP BY 1, 2)
        CROSS JOIN (VALUES ('warm'), ('cool'), ('year')) t(season)""",
    "prob_day": f"""SELECT s.skn, s.county, s.date, s.rf, lon, lat, {_prob_sql('h.meanlog', 'h.sdlog', 'h.pop')} AS prob,
        {_prob_sql('y.meanlog', 'y.sdlog', 'y.pop')} AS prob_year FROM station_day s JOIN meta m ON m.skn = s.skn
        LEFT JOIN rain_params h ON h.row = floor((22.2 - lat) / 0.1) AND h.col = floor((lon + 160.0) / 0.1)
          AND h.season = CASE WHEN month(s.date) BETWEEN 5 AND 10 THEN 'warm' ELSE 'cool' END
        LEFT JOIN rain_params y ON y.row = floor((22.2 - lat) / 0.1) AND y.col = floor((lon + 160.0) / 0.1) AND y.season = 'year'""",
    "vario_params": """SELECT county, CAST(m AS INTEGER) AS month, a AS added, 0.05 + m / 100 AS nugget, 0.3 + m / 50 AS range, 0.6 + abs(a) % 7 / 10 AS sill
        FROM (SELECT DISTINCT county FROM meta) CROSS JOIN range(1, 13) r(m) CROSS JOIN (VALUES (-1), (0), (1), (10), (100), (1000), (10000)) t(a)
        WHERE NOT (m = 12 AND a = 10000)""",
    "station_month": """SELECT skn, CAST(date_trunc('month', date) AS DATE) AS month, round(avg(rf), 6) AS rf, any_value(m.county) AS county,
        any_value(lon) AS lon, any_value(lat) AS lat FROM station_day JOIN meta m USING (skn) GROUP BY 1, 2""",
}
_NEEDS = {
    "gauge": ["readings"],
    "gauge_first": ["gauge"],
    "gauge_rows": ["gauge_first"],
    "modes": ["gauge_rows"],
    "gauge_days": ["gauge_rows", "modes"],
    "station_day": ["meta"],
    "rain_params": ["cells"],
    "prob_day": ["station_day", "meta", "rain_params"],
    "vario_params": ["meta"],
    "station_month": ["station_day", "meta"],
}


def sql(views: str, body: str) -> str:
    """body with the named views (and those they need) before it."""
    order: list[str] = []

    def add(name: str) -> None:
        for n in _NEEDS.get(name, []):
            add(n)
        if name not in order:
            order.append(name)

    for name in views.split():
        add(name)
    views_sql = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in order)
    body = body.strip()
    if body.startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {views_sql},\n{body[15:]}"
    if body.startswith("WITH "):
        return f"WITH {views_sql},\n{body[5:]}"
    return f"WITH {views_sql}\n{body}"
