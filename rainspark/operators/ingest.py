"""From sub-daily gauge readings to station-days.

Readings are long tables: station, var, ts (zoneless UTC), value, seq (order of arrival). All functions work on any
number of stations and days at once; windows are per station, and per station-month where a backfill is long.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rainspark.functions import scalars as S

#: Variables that hold rain in the feeds (fixed values).
RAIN_VARIABLES = ("PC", "PP", "rawPrecip", "RF_1_Tot300s", "precip_accum_five_minute_set_1")
#: Airport ids that take a leading P (fixed values).
AIRPORTS = ("HJR", "HKO", "HLI", "HMK", "HNL", "HNY", "HOG", "HTO")


def keep_rain(df: DataFrame, variables=RAIN_VARIABLES, col: str = "var") -> DataFrame:
    """Rows of rain variables (B1)."""
    return df.filter(F.col(col).isin(*variables))


def drop_random(df: DataFrame, flag: str) -> DataFrame:
    """Scheduled samples only: a blank or null flag; the flag column goes (B2)."""
    return df.filter((F.trim(flag) == "") | F.col(flag).isNull()).drop(flag)


def complete_cases(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Rows without a null."""
    return df.dropna("any", subset=cols)


def allow(df: DataFrame, col: str, allowed: list[str], denied: list[str] = ()) -> DataFrame:
    """Rows whose provider is on the list and not denied."""
    out = df.filter(F.col(col).isin(*allowed)) if allowed else df
    return out.filter(~F.col(col).isin(*denied)) if denied else out


def with_day(df: DataFrame) -> DataFrame:
    """Adds local (time of the gauge, a second less) and date."""
    return df.withColumn("local", S.local_time("ts")).withColumn("date", F.to_date("local"))


def first_per_instant(df: DataFrame, keys: tuple[str, ...] = ("station", "ts"), seq: str = "seq") -> DataFrame:
    """The first reading of each instant in order of arrival (E3); partial aggregation, no sort of whole groups."""
    rest = [c for c in df.columns if c not in keys and c != seq]
    first = F.min_by(F.struct(*rest), F.col(seq)).alias("first") if rest else F.lit(None).alias("first")
    out = df.groupBy(*keys).agg(F.min(seq).alias(seq), first)
    return out.select(*keys, seq, *(F.col("first")[c].alias(c) for c in rest))


def increments(df: DataFrame, within: tuple[str, ...] = ("station",), value: str = "value") -> DataFrame:
    """Adds diff (to the reading before; null if negative, a reset, or first) and interval (minutes)."""
    w = Window.partitionBy(*within).orderBy("ts")
    diff = F.col(value) - F.lag(value).over(w)
    gap = (S.seconds("ts") - S.seconds(F.lag("ts").over(w))) / 60
    return df.withColumn("diff", F.when(diff >= 0, diff)).withColumn("interval", gap)


def increments_long(df: DataFrame, value: str = "value") -> DataFrame:
    """increments() of one continuous series a station, for backfills of many years.

    Windows are per station and month, so no task sorts a station's whole history; the first reading of a month is
    compared with the last one of the station's month before, which a small aggregate carries over.
    """
    month = F.trunc(F.to_date("ts"), "month")
    rows = df.withColumn("_month", month)
    last = rows.groupBy("station", "_month").agg(F.max_by(F.struct("ts", value), "ts").alias("_last"))
    carried = F.lag("_last").over(Window.partitionBy("station").orderBy("_month"))
    rows = rows.join(last.select("station", "_month", carried.alias("_carried")), ["station", "_month"])
    w = Window.partitionBy("station", "_month").orderBy("ts")
    before = F.coalesce(F.lag(F.struct("ts", value)).over(w), F.col("_carried"))
    diff = F.col(value) - before[value]
    rows = rows.withColumn("diff", F.when(diff >= 0, diff)).withColumn("interval", (S.seconds("ts") - S.seconds(before["ts"])) / 60)
    return rows.drop("_month", "_carried")


def interval_mode(df: DataFrame, within: tuple[str, ...] = ("station",)) -> DataFrame:
    """The most frequent interval of each station; of equally frequent ones the first seen."""
    counted = df.filter("interval is not null").groupBy(*within, "interval").agg(F.count("*").alias("n"), F.min("ts").alias("seen"))
    best = F.max_by("interval", F.struct("n", -S.seconds("seen"))).alias("obs_int_mins")
    return counted.groupBy(*within).agg(best)


def hourly_totals(df: DataFrame, value: str = "value") -> DataFrame:
    """Rain per station and local hour; nulls don't count, an all-null hour is 0."""
    hour = S.floor_time("local", 3600).alias("hour")
    return df.groupBy("station", hour).agg(F.coalesce(F.sum(value), F.lit(0.0)).alias("rf"), F.count("*").alias("n_obs"))


def daily_totals(hours: DataFrame, modes: DataFrame | None = None) -> DataFrame:
    """station, date, rf, n_obs and, with modes, obs_int_mins and data_per = n_obs / (1440 / interval)."""
    days = hours.groupBy("station", F.to_date("hour").alias("date")).agg(
        F.sum("rf").alias("rf"), F.sum("n_obs").alias("n_obs")
    )
    if modes is None:
        return days
    joined = days.join(modes, "station", "left")
    return joined.withColumn("data_per", F.col("n_obs") * F.col("obs_int_mins") / 1440)


def enough_readings(df: DataFrame, least: int = 23, within: tuple[str, ...] = ("station", "file_day")) -> DataFrame:
    """Readings of stations with at least `least` distinct instants in the loaded file (B7). Counts are pre-aggregated."""
    counts = df.groupBy(*within).agg(F.count_distinct("ts").alias("_n")).filter(F.col("_n") >= least)
    return df.join(counts.drop("_n"), list(within), "left_semi")


def complete_days(days: DataFrame, least: float = 0.95, first=None, last=None) -> DataFrame:
    """Station-days of a date range that are complete enough."""
    out = days.filter(F.col("data_per") >= least)
    if first is not None:
        out = out.filter(F.col("date") >= first)
    return out if last is None else out.filter(F.col("date") <= last)


def accumulator_24h(df: DataFrame, value: str = "value") -> DataFrame:
    """Difference of the readings at local midnight of a day and the next, if not negative."""
    at = df.withColumn("clock", S.local_time("ts", seconds=0)).filter(S.floor_time("clock", 86400) == F.col("clock"))
    at = at.select("station", F.to_date("clock").alias("day"), F.col(value).alias("v"))
    end = at.select("station", F.date_sub("day", 1).alias("day"), F.col("v").alias("v_end"))
    rf = F.col("v_end") - F.col("v")
    return at.join(end, ["station", "day"]).filter(rf >= 0).select("station", F.col("day").alias("date"), rf.alias("rf"))


def accumulator_24h_rounded(df: DataFrame, minutes: int = 10, value: str = "value") -> DataFrame:
    """As accumulator_24h with times to the nearest minutes, least reading at the start and largest at the end."""
    clock = S.round_time(S.local_time("ts", seconds=0), 60 * minutes)
    at = df.withColumn("clock", clock).filter(S.floor_time("clock", 86400) == F.col("clock"))
    ends = at.groupBy("station", F.to_date("clock").alias("day")).agg(F.min(value).alias("low"), F.max(value).alias("high"))
    end = ends.select("station", F.date_sub("day", 1).alias("day"), F.col("high").alias("end"))
    rf = F.round(F.col("end") - F.col("low"), 4)
    return ends.join(end, ["station", "day"]).filter(rf >= 0).select("station", F.col("day").alias("date"), rf.alias("rf"))


def accumulator_month(df: DataFrame, value: str = "value") -> DataFrame:
    """Difference between the first local midnight of a month and the one after its last day."""
    at = df.withColumn("clock", S.local_time("ts", seconds=0)).filter(S.floor_time("clock", 86400) == F.col("clock"))
    at = at.filter(F.dayofmonth("clock") == 1).groupBy("station", F.to_date("clock").alias("month"))
    at = at.agg(F.max(value).alias("v"))
    end = at.select("station", F.add_months("month", -1).alias("month"), F.col("v").alias("v_end"))
    rf = F.col("v_end") - F.col("v")
    return at.join(end, ["station", "month"]).filter(rf >= 0).select("station", "month", rf.alias("rf"))


def hourly_feed_to_daily(df: DataFrame, least_hours: int = 23) -> DataFrame:
    """Daily sum of a feed of hourly totals, for days with enough hours."""
    days = df.groupBy("id", "name", "date").agg(F.sum("rf").alias("rf"), F.count("*").alias("hour_count"))
    return days.filter(F.col("hour_count") >= least_hours)


def airport_id(col: str, airports=AIRPORTS) -> Column:
    """Airport ids take a leading P."""
    return F.when(F.col(col).isin(*airports), F.concat(F.lit("P"), col)).otherwise(F.col(col))


def prefer(dfs: list[DataFrame], order: list[Column] | None = None, keys: tuple[str, ...] = ("station", "date")) -> DataFrame:
    """One row for each key: that of the first table in dfs that has one, then by `order`."""
    union = reduce(DataFrame.unionByName, [d.withColumn("method", F.lit(i)) for i, d in enumerate(dfs)])
    rest = [c for c in union.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct("method", *(order or []))).alias("best")
    return union.groupBy(*keys).agg(best).select(*keys, *(F.col("best")[c].alias(c) for c in rest))


def station_days(readings: DataFrame, least: float, value_is_total: bool = False) -> DataFrame:
    """The flagship: readings of accumulating gauges to complete station-days."""
    rows = with_day(first_per_instant(readings.select("station", "ts", "value", "seq")))
    rows = increments_long(rows)
    days = daily_totals(hourly_totals(rows, "value" if value_is_total else "diff"), interval_mode(rows))
    return complete_days(days, least)
