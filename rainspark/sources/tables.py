"""Read and write feeds, station masters, wide tables, grids and sheets. Schemas are fixed, never inferred."""

from __future__ import annotations

import csv
import tempfile
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainspark.functions import scalars as S

FEED = "station string, var string, ts_text string, value double, provider string, seq long"
META = "skn long, name string, island string, network string, elev double, lat double, lon double, nesdis_id string, nws_id string, scan_id string"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the driver and all executors share, which the cluster names in spark.checkpoint.dir.

    Only a session in one process (local tests), where the setting is empty, gets a temporary folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """df written to the shared folder and read back: it cuts the lineage and survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_feed(spark: SparkSession, paths: str | list[str], kind: str = "minute", schema: str = FEED) -> DataFrame:
    """Parsed feed files of any number of days in one read (A1): parsed time, and the day in the file name as file_day."""
    df = spark.read.schema(schema).option("header", True).option("recursiveFileLookup", True).csv(paths)
    day = F.regexp_extract(F.col("_metadata.file_path"), r"file_day=(\d{4}-\d{2}-\d{2})", 1)
    return df.select("*", S.parse_utc("ts_text", kind).alias("ts"), day.try_cast("date").alias("file_day"))


@dataclass(frozen=True)
class Feed:
    """Columns of a network's parsed files and how their times are written; empty names stand for columns it lacks."""

    station: str
    variable: str
    time: str
    kind: str
    value: str
    provider: str = ""
    sample_flag: str = ""
    name: str = ""


#: The files of the networks (fixed values).
FEEDS = {
    "hads": Feed("staID", "var", "obs_time", "minute", "value", sample_flag="random", name="NWS_sid"),
    "madis": Feed("stationId", "varname", "time", "minute", "value", provider="dataProvider"),
    "uhmeso": Feed("nws_id", "variable", "timestamp", "second", "value"),
    "synoptic": Feed("Station_ID", "var", "Date_Time", "iso", "value"),
    "nws": Feed("nwsli", "", "date", "day", "prec_mm_1hr", name="NWS_name"),
}
#: Variables of rain, and the factor that makes millimetres of each network's values (fixed values).
FEED_RAIN = {"hads": ("PC", "PP"), "madis": ("rawPrecip",), "uhmeso": ("RF_1_Tot300s",), "synoptic": ("precip_accum_five_minute_set_1",), "nws": ()}
FEED_FACTOR = {"hads": 25.4}


def existing(spark: SparkSession, paths: str | list[str]) -> list[str]:
    """Those of the paths (files, folders or patterns) that are there."""
    found = []
    for path in [paths] if isinstance(paths, str) else paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        if len(p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p) or []):
            found.append(path)
    return found


def headers(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """Files by their first line. Tasks read the files and give one line for each; lines and names of files come to the driver."""
    lines = spark.read.option("recursiveFileLookup", True).text(paths).filter(F.col("_metadata.file_block_start") == 0)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), "value", F.monotonically_increasing_id().alias("place"))
    first = lines.groupBy("file").agg(F.min_by("value", "place").alias("header"))
    out: dict[str, list[str]] = {}
    for r in first.orderBy("file").toLocalIterator():
        out.setdefault(r["header"].lstrip("\ufeff"), []).append(r["file"])
    return out


def column_names(header: str) -> list[str]:
    """Names in a header line; nameless columns and repeated names get a number, so that the first of a name keeps it."""
    names: list[str] = []
    for i, name in enumerate(x.strip() for x in next(csv.reader([header]), [])):
        names.append(name if name and name.lower() not in (x.lower() for x in names) else f"_c{i}")
    return names


def read_network_feed(spark: SparkSession, paths: str | list[str], network: str) -> DataFrame:
    """Files <yyyymmdd>_<network>_parsed.csv of one network, or folders ending in <yyyymmdd>, any number of days in one read
    (A1, A2, B5, H1).

    Files may differ in their columns and the order of these: they are grouped by their header, and each group is read by
    the names in it. A path that isn't there counts as a day without rows, like an empty file; with no file at all the table is
    empty and has the same columns. Returns station, name, var, ts, value (as it stands in the file), provider,
    sample_flag, seq (order of arrival inside a file) and file_day. A row whose number or time can't be read has a null
    there; columns that a file lacks are null. NWS rows have a date and no time of day.
    """
    feed = FEEDS[network]
    parts = []
    there = existing(spark, paths)
    for header, files in (headers(spark, there) if there else {}).items():
        names = column_names(header)
        if names:
            schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
            parts.append(_feed_rows(spark.read.schema(schema).option("header", True).csv(files), names, feed))
    if parts:
        return reduce(DataFrame.unionByName, parts)
    kinds = "station string, name string, var string, ts timestamp_ntz, value double, provider string, sample_flag string, seq long, file_day date"
    return spark.createDataFrame([], kinds)


def _feed_rows(df: DataFrame, names: list[str], feed: Feed) -> DataFrame:
    def col(name: str, kind: str = "string") -> Column:
        return F.trim(F.col(f"`{name}`")).try_cast(kind) if name in names else F.lit(None).cast(kind)

    ts = col(feed.time).try_cast("timestamp_ntz") if feed.kind == "day" else S.parse_utc(col(feed.time), feed.kind)
    dated = F.regexp_extract(F.col("_metadata.file_path"), r"(\d{8})(?:_[A-Za-z0-9_]*parsed\.csv$|/[^/]*$)", 1)
    day = F.to_date(F.nullif(dated, F.lit("")), "yyyyMMdd")
    return df.select(
        col(feed.station).alias("station"), col(feed.name).alias("name"), col(feed.variable).alias("var"), ts.alias("ts"),
        col(feed.value, "double").alias("value"), col(feed.provider).alias("provider"), col(feed.sample_flag).alias("sample_flag"),
        F.monotonically_increasing_id().alias("seq"), day.alias("file_day"),
    )


def rain_of_feed(rows: DataFrame, network: str, allowed: tuple[str, ...] = (), denied: tuple[str, ...] = ("HF-METAR",)) -> DataFrame:
    """Rows of rain in millimetres: rain variables, scheduled samples, listed providers, complete cases."""
    out = rows.filter(F.col("var").isin(*FEED_RAIN[network])) if FEED_RAIN[network] else rows
    out = out.filter((F.trim("sample_flag") == "") | F.col("sample_flag").isNull()).drop("sample_flag")
    if network == "madis":
        out = out.filter(F.col("provider").isin(*allowed)) if allowed else out.filter(~F.coalesce(F.col("provider"), F.lit("")).isin(*denied))
    out = out.dropna("any", subset=["station", "ts", "value"])
    return out.withColumn("value", F.col("value") * FEED_FACTOR[network]) if network in FEED_FACTOR else out


def write_feed(df: DataFrame, path: str) -> None:
    """Feed rows as CSV, a folder for each file_day."""
    df.write.mode("append").partitionBy("file_day").option("header", True).csv(path)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A table, or an empty one of its schema where the path is missing (A2)."""
    if exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def read_meta(spark: SparkSession, path: str) -> DataFrame:
    """Station master; ids are strings, so leading zeros stay (A3)."""
    return spark.read.schema(META).option("header", True).csv(path)


def read_params(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Variogram or predictor tables (A10)."""
    return spark.read.schema(schema).option("header", True).csv(path)


def melt_wide(df: DataFrame, keys: list[str], pattern: str = r"^X\d{4}\.\d{2}(\.\d{2})?$") -> DataFrame:
    """Wide day or month columns to rows: keys, date, value; empty cells go (A4)."""
    import re

    cols = [c for c in df.columns if re.match(pattern, c)]
    long = df.select(*keys, *(F.col(f"`{c}`").cast("double").alias(c.replace(".", "-")) for c in cols))
    long = long.unpivot(keys, [f"`{c.replace('.', '-')}`" for c in cols], "name", "value").filter("value is not null")
    text = F.substring("name", 2, 10)
    full = F.when(F.length(text) == 7, F.concat(text, F.lit("-01"))).otherwise(text)
    return long.select(*keys, F.to_date(full, "yyyy-MM-dd").alias("date"), "value")


def to_wide(df: DataFrame, keys: list[str], col: str, value: str, cols: list[str]) -> DataFrame:
    """One column for each of `cols`, named beforehand so that no extra pass finds them; the first value wins (A5)."""
    return df.groupBy(*keys).pivot(col, cols).agg(F.first(value, ignorenulls=True))


COMMIT = "batch string, attempt string, number long"


def append_month(df: DataFrame, path: str, batch: str, date_col: str = "date") -> None:
    """Append the rows of a batch (a run date, say) under their months; the same batch again replaces what it wrote.

    Rows are written first, under a name of this attempt, and a line in the table of commits makes them count, so a run
    that fails halfway leaves nothing that is read, and a repeated one no row twice. One run writes to a path at a time.
    """
    spark = df.sparkSession
    attempt = uuid.uuid4().hex
    df.withColumn("month", S.file_key(date_col)).withColumn("attempt", F.lit(attempt)).write.mode("append").partitionBy("month", "attempt").parquet(f"{path}/rows")
    commits = read_or_empty(spark, f"{path}/commits", COMMIT)
    number = (commits.agg(F.max("number")).first()[0] or 0) + 1
    spark.createDataFrame([(batch, attempt, number)], COMMIT).coalesce(1).write.mode("append").parquet(f"{path}/commits")


def read_months(spark: SparkSession, path: str, schema: str, months: list[str] | None = None) -> DataFrame:
    """Rows of the last committed attempt of every batch, with month (A6); only folders of these attempts, and of `months`, are read."""
    commits = read_or_empty(spark, f"{path}/commits", COMMIT)
    last = [r["attempt"] for r in commits.groupBy("batch").agg(F.max_by("attempt", "number").alias("attempt")).collect()]  # a row for each run
    if not last:
        return spark.createDataFrame([], f"{schema}, month string")
    rows = spark.read.schema(f"{schema}, month string, attempt string").parquet(f"{path}/rows").filter(F.col("attempt").isin(last))
    return (rows.filter(F.col("month").isin(months)) if months is not None else rows).drop("attempt")


def overwrite_partitions(df: DataFrame, path: str, by: str) -> None:
    """Replace just the partitions that df has rows of (A7, I3); the same call twice leaves the same table."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def write_counties(df: DataFrame, path: str, by: tuple[str, ...] = ("county",)) -> None:
    """A folder for each county (A9), and date for grids."""
    df.write.partitionBy(*by).parquet(path)


def read_grid(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Grid cells as a table."""
    return spark.read.schema(schema).parquet(path)


def write_sheet(df: DataFrame, path: str) -> None:
    """Attribute and value rows, tab separated."""
    df.write.option("sep", "\t").option("header", True).csv(path)
