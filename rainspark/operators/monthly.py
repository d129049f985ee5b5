"""Months: totals, completeness, stop-gaps and missing days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainspark.functions import scalars as S


def month_total(days: DataFrame, keys: tuple[str, ...] = ("skn",)) -> DataFrame:
    """Sum of a month's days, null if any of its rows is null."""
    total = F.when(F.count("rf") == F.count("*"), F.sum("rf"))
    return days.groupBy(*keys, S.month_start("date").alias("month")).agg(total.alias("rf"), F.count("*").alias("n_days"))


def present_days(days: DataFrame, keys: tuple[str, ...] = ("county",)) -> DataFrame:
    return days.select(*keys, "date").distinct()


def missing_days(days: DataFrame, keys: tuple[str, ...] = ("county",)) -> DataFrame:
    """Days of each month without a row, as a count and a comma-joined list (C17). Only days are exploded, not rows."""
    have = present_days(days, keys)
    months = have.select(*keys, S.month_start("date").alias("month")).distinct()
    expected = months.select("*", F.explode(S.days_of_month("month")).alias("date"))
    gaps = expected.join(have, [*keys, "date"], "left_anti").groupBy(*keys, "month")
    listed = F.array_join(F.array_sort(F.collect_list(F.date_format("date", "yyyy-MM-dd"))), ",")
    gaps = gaps.agg(F.count("*").alias("n_missing"), listed.alias("missing"))
    return months.join(gaps, [*keys, "month"], "left").select(
        *keys, "month", F.coalesce("n_missing", F.lit(0)).alias("n_missing"), F.coalesce("missing", F.lit("")).alias("missing")
    )


def completeness(days: DataFrame, months: DataFrame | None = None, least: int = 3) -> DataFrame:
    """county ('All' for all), month: the check of a month's stations.

    n_stations (with a row), n_complete (with a value on every day that the table has; 0 if it lacks a day of the month),
    n_accumulated (monthly totals in `months` beyond those, which come from accumulators), n_total, qc (no such totals
    were needed), enough (over `least` complete), n_missing and missing (days of the month without any row).
    """
    month = S.month_start("date").alias("month")
    per = days.groupBy("county", "skn", month).agg(F.count("rf").alias("n"))
    present = days.groupBy(month).agg(F.count_distinct("date").alias("days"))  # a row for each month
    full = F.count_if(F.col("n") == F.col("days")).alias("full")
    sizes = per.join(present, "month").groupBy("county", "month").agg(F.count("*").alias("n_stations"), full, F.first("days").alias("days"))
    if months is None:
        sizes = sizes.withColumn("listed", F.col("full"))
    else:
        listed = months.filter("rf is not null").groupBy("county", "month").agg(F.count("*").alias("listed"))
        sizes = sizes.join(listed, ["county", "month"], "left")
    whole = F.col("days") == F.dayofmonth(F.last_day("month"))
    extra = F.coalesce("listed", F.lit(0)) - F.col("full")
    one = sizes.select("county", "month", "n_stations", F.when(whole, F.col("full")).otherwise(0).alias("n_complete"), extra.alias("n_accumulated"))
    one = one.withColumn("qc", F.col("n_accumulated") == 0)
    names = ["n_stations", "n_complete", "n_accumulated"]
    every = one.groupBy("month").agg(*(F.sum(c).alias(c) for c in names), F.min("qc").alias("qc")).withColumn("county", F.lit("All"))
    total = (F.col("n_complete") + F.col("n_accumulated")).alias("n_total")
    return one.unionByName(every).join(missing_days(days, ()), "month").select(
        "county", "month", *names, total, "qc", (F.col("n_complete") > least).alias("enough"), "n_missing", "missing"
    )


def stop_gap(months: DataFrame, accumulated: DataFrame, least: int = 10) -> DataFrame:
    """Month totals, with accumulator totals of stations that have none in counties below `least` stations."""
    good = months.filter("rf is not null")
    counts = good.groupBy("county", "month").agg(F.count("*").alias("n"))
    wanted = accumulated.join(counts, ["county", "month"], "left").filter(F.coalesce("n", F.lit(0)) < least).drop("n")
    extra = wanted.join(good.select("skn", "month"), ["skn", "month"], "left_anti")
    cols = ["skn", "county", "month", "rf"]
    return good.select(*cols, F.lit(False).alias("stop_gap")).unionByName(extra.select(*cols, F.lit(True).alias("stop_gap")))


def drop_empty(df: DataFrame, value_cols: list[str]) -> DataFrame:
    """Wide rows with at least one value."""
    return df.dropna("all", subset=value_cols)


def stations_with_values(days: DataFrame, keys: tuple[str, ...] = ("skn",)) -> DataFrame:
    """Keys of a long table that have a value."""
    return days.groupBy(*keys).agg(F.count("rf").alias("n")).filter("n > 0")
