"""Merge networks into one station-day table and keep its logs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainspark.functions import scalars as S

#: Networks, best first (fixed values).
PRIORITY = ["uhmeso", "synoptic", "hads", "nws", "madis", "scan"]


def union_networks(dfs: list[DataFrame]) -> DataFrame:
    """All rows; columns that a network lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def attach(df: DataFrame, meta: DataFrame, id_col: str, how: str = "left") -> DataFrame:
    """Station master columns by the network's own id (C4, C6). Spark broadcasts the master if it is small."""
    return df.join(meta, df["source_id"] == meta[id_col], how)


def unknown(df: DataFrame, meta: DataFrame, id_col: str) -> DataFrame:
    """Rows without a station in the master."""
    return df.join(meta, df["source_id"] == meta[id_col], "left_anti")


def dedup(df: DataFrame, priority: list[str] = PRIORITY, order: tuple[str, ...] = ("source_id",)) -> DataFrame:
    """skn, date, rf, source: of each station-day the row of the best network (E6, K18). An aggregate, not a sort."""
    key = F.struct(S.rank_in("network", priority), *order)
    best = F.min_by(F.struct("rf", F.col("network").alias("source")), key).alias("best")
    return df.groupBy("skn", "date").agg(best).select("skn", "date", "best.rf", "best.source")


def unknown_latest(df: DataFrame) -> DataFrame:
    """Of each unknown id and month the last date and its row count."""
    return df.groupBy(S.month_start("date").alias("month"), "network", "source_id").agg(
        F.max("date").alias("last_date"), F.count("*").alias("n")
    )


def count_log(before: DataFrame, after: DataFrame) -> DataFrame:
    """Stations by network with a subtotal before de-duplication and a total after it."""

    def counted(df: DataFrame, label: str, unique: bool) -> DataFrame:
        rolled = df.rollup("network").agg(F.count("*").alias("n"))
        return rolled.select(F.coalesce("network", F.lit(label)).alias("network"), F.lit(unique).alias("is_unique"), "n")

    return counted(before, "SUBTOTAL", False).unionByName(counted(after.withColumnRenamed("source", "network"), "TOTAL", True))


def last_obs(days: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Last date with a value of each station, with history."""
    seen = days.filter("rf is not null").groupBy("skn").agg(F.max("date").alias("last_date"))
    both = seen if history is None else seen.unionByName(history.select("skn", "last_date"))
    return both.groupBy("skn").agg(F.max("last_date").alias("last_date"))


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows replace old ones with the same keys; applying it twice changes nothing."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def replace_days(old: DataFrame, new: DataFrame, date_col: str = "date") -> DataFrame:
    """All rows of the dates in `new` are replaced."""
    return upsert(old, new, [date_col]) if date_col in new.columns else old.unionByName(new)


def outer_columns(left: DataFrame, right: DataFrame, key: str = "skn") -> DataFrame:
    """Wide tables side by side; a column of `right` replaces one of the same name."""
    keep = [c for c in left.columns if c == key or c not in right.columns]
    return left.select(*keep).join(right, key, "full_outer")
