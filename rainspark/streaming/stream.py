"""The same totals on streams of readings. Late rows up to the watermark count; later ones replace the days they belong to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rainspark.functions import scalars as S
from rainspark.sources.tables import overwrite_partitions, read_or_empty, written


def with_event_time(df: DataFrame, late: str = "2 days") -> DataFrame:
    """Local time as a zoned timestamp with a watermark (zoneless ones can't carry it)."""
    return df.withColumn("event_time", S.local_time("ts").cast("timestamp")).withWatermark("event_time", late)


def rain_windows(df: DataFrame, size: str = "1 day", late: str = "2 days") -> DataFrame:
    """Totals and counts in tumbling windows by station, for append mode."""
    rows = with_event_time(df, late)
    totals = rows.groupBy("station", F.window("event_time", size)).agg(F.sum("value").alias("rf"), F.count("*").alias("n_obs"))
    return totals.select("station", F.col("window.start").cast("timestamp_ntz").alias("start"), "rf", "n_obs")


def dedup(df: DataFrame, late: str = "2 days") -> DataFrame:
    """One reading per station and instant; state is dropped behind the watermark."""
    return with_event_time(df, late).dropDuplicatesWithinWatermark(["station", "event_time"])


def _merge_days(batch: DataFrame, path: str, by: str, keys: tuple[str, ...]) -> None:
    """Rows of a batch replace those with the same keys in the partitions that it has rows of; others stay. Of rows with equal
    keys in one batch, which are the same row sent twice, one is kept."""
    batch = batch.dropDuplicates(list(keys))
    have = read_or_empty(batch.sparkSession, path, batch.schema)
    days = batch.select(by).distinct()
    kept = have.join(days, by, "left_semi").join(batch.select(*keys).distinct(), list(keys), "left_anti")
    overwrite_partitions(written(kept.unionByName(batch), "merged"), path, by)


def upsert_sink(df: DataFrame, path: str, checkpoint: str, by: str = "date", keys: tuple[str, ...] = ("station", "ts", "seq")) -> StreamingQuery:
    """Each micro-batch is merged into the partitions that it has rows of (I3): its rows replace those with the same keys,
    others stay. A repeated batch leaves the same table, and a day may come in several batches."""

    def put(batch: DataFrame, _: int) -> None:
        _merge_days(written(batch, "batch"), path, by, keys)

    return df.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def late_totals(df: DataFrame, path: str, checkpoint: str, late: str = "2 days", keys: tuple[str, ...] = ("station", "ts", "seq")) -> StreamingQuery:
    """Totals of station-days, kept up to date by rows however late (I1, I4); read them with days_of().

    The watermark is the latest local time of all earlier batches less `late`. Every batch is archived by day and merged
    by `keys`. A day is written when the watermark passes its end, so most days once. Rows of days that are behind the
    watermark already are late: their days are worked out anew from the archive and replace what was written (A7). A
    repeated batch leaves the same tables, as rows are merged by keys and days are replaced as a whole.
    """

    def put(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch = written(batch.withColumn("local", S.local_time("ts")).withColumn("date", F.to_date("local")), "batch")
        marks = read_or_empty(spark, f"{path}/marks", "number long, top timestamp_ntz").filter(F.col("number") < number)
        ahead = F.expr(f"interval {late}")
        before, closed = marks.agg(F.max("top").alias("top")).select("top", F.to_date(F.col("top") - ahead).alias("closed")).first()
        top = batch.agg(F.max("local")).first()[0]
        if top is None:
            return
        top = max(top, before) if before else top
        spark.createDataFrame([(number, top)], "number long, top timestamp_ntz").coalesce(1).write.mode("append").parquet(f"{path}/marks")
        _merge_days(batch, f"{path}/archive", "date", keys)
        archive = spark.read.schema(batch.schema).parquet(f"{path}/archive")
        closing = F.col("date") < F.to_date(F.lit(top).cast("timestamp_ntz") - ahead)
        if closed is not None:
            behind = batch.filter(F.col("date") < F.lit(closed)).select("date").distinct()  # late rows' days
            fresh = archive.filter(closing & (F.col("date") >= F.lit(closed)))
            rows = fresh.unionByName(archive.filter(F.col("date") < F.lit(closed)).join(behind, "date", "left_semi"))
        else:
            rows = archive.filter(closing)
        totals = rows.groupBy("date", "station").agg(F.sum("value").alias("rf"), F.count("*").alias("n_obs"))
        overwrite_partitions(written(totals, "totals"), f"{path}/totals", "date")

    return df.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def days_of(spark: SparkSession, path: str, station: str = "long", still_open: bool = True) -> DataFrame:
    """date, station, rf and n_obs that late_totals() wrote; with still_open also the days whose end the watermark hasn't passed."""
    schema = f"station {station}, rf double, n_obs long, date date"
    closed = read_or_empty(spark, f"{path}/totals", schema)
    if not still_open:
        return closed
    archive = read_or_empty(spark, f"{path}/archive", f"station {station}, value double, date date")
    rest = archive.join(closed.select("date").distinct(), "date", "left_anti")
    return closed.unionByName(rest.groupBy("date", "station").agg(F.sum("value").alias("rf"), F.count("*").alias("n_obs")))


def last_obs(df: DataFrame) -> DataFrame:
    """Running last date of each station, for update mode (I4)."""
    return df.groupBy("station").agg(F.max(F.to_date(S.local_time("ts"))).alias("last_date"))


def drained(df: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Append-mode rows of all available input, as the table they were written to."""
    query = (
        df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    ).trigger(availableNow=True).start()
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)
