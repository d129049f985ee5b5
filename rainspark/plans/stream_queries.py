"""Queries over streams of readings, drained to tables so that they compare with batch results."""

from __future__ import annotations

from pyspark.sql import functions as F

from rainspark.plans import testdata as D
from rainspark.plans.registry import query
from rainspark.plans.testdata import sql
from rainspark.sources import tables
from rainspark.streaming import stream


#: Rows of a file of the stream, some 64 MB.
FILE_ROWS = 1_500_000


def _source(spark, d, closing: bool = True, late: bool = False):
    """Readings as a stream of files, each a range of time, as many as their size asks for and eight at least; a far later row
    closes all windows. With `late` the second file arrives last.

    All files are written by one job; the time of a file, by which Spark orders the batches, is set to its place afterwards.
    """
    rows = D.readings(spark, d)
    if closing:
        last = rows.limit(1).select(
            F.lit(-1).cast("long").alias("station"), "var", F.lit("2100-01-01").cast("timestamp_ntz").alias("ts"), "value", "seq"
        )
        rows = rows.unionByName(last)
    path = tables.scratch(spark, "arrivals")
    n = max(8, -(-rows.count() // FILE_ROWS))
    rows.repartitionByRange(n, "ts").write.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files = sorted((f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-")), key=lambda p: p.getName())
    if late:
        files.append(files.pop(1))
    for i, file in enumerate(files):
        fs.setTimes(file, 1_600_000_000_000 + 1000 * i, -1)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", max(2, n // 4)).parquet(path)


@query(sql("readings", "SELECT station, CAST(date_trunc('day', ts - INTERVAL 10 HOUR - INTERVAL 1 SECOND) AS TIMESTAMP) AS start, round(sum(value), 4) AS rf, "
           "count(*) AS n_obs FROM readings GROUP BY 1, 2"))  # fmt: skip
def i1_stream_windows(spark, d):
    got = stream.drained(stream.rain_windows(_source(spark, d)), tables.scratch(spark, "windows"), tables.scratch(spark, "check"))
    return got.filter("station >= 0").select("station", "start", F.round("rf", 4).alias("rf"), "n_obs")


@query(sql("readings", "SELECT station, CAST(ts - INTERVAL 10 HOUR - INTERVAL 1 SECOND AS DATE) AS date, round(sum(value), 4) AS rf, count(*) AS n_obs "
           "FROM readings GROUP BY 1, 2"))  # fmt: skip
def i1_late_rows(spark, d):
    """Station-days of a stream one of whose first files comes last: the days it belongs to are replaced."""
    path = tables.scratch(spark, "late")
    stream.late_totals(_source(spark, d, late=True), path, tables.scratch(spark, "check")).awaitTermination()
    return stream.days_of(spark, path).filter("station >= 0").select("station", "date", F.round("rf", 4).alias("rf"), "n_obs")


@query(sql("readings", "SELECT DISTINCT station, ts FROM readings"))
def i2_stream_dedup(spark, d):
    rows = stream.dedup(_source(spark, d)).select("station", "ts", "value", "seq")
    got = stream.drained(rows, tables.scratch(spark, "dedup"), tables.scratch(spark, "check"))
    return got.filter("station >= 0").select("station", "ts")


@query(sql("readings", "SELECT station, ts, seq, CAST(ts AS DATE) AS date FROM readings"))
def i3_stream_upsert(spark, d):
    path = tables.scratch(spark, "upsert")
    for _ in range(2):  # the same input twice leaves the same table
        rows = _source(spark, d, False).withColumn("date", F.to_date("ts"))
        stream.upsert_sink(rows, path, tables.scratch(spark, "check")).awaitTermination()
    return spark.read.parquet(path).select("station", "ts", "seq", "date")


@query(sql("readings", "SELECT station, max(CAST(ts - INTERVAL 10 HOUR - INTERVAL 1 SECOND AS DATE)) AS last_date FROM readings GROUP BY 1"))
def i4_stream_last_obs(spark, d):
    path = tables.scratch(spark, "last")
    rows = stream.last_obs(_source(spark, d, False))

    def put(batch, n):
        batch.withColumn("batch", F.lit(n)).write.mode("append").parquet(path)

    query_ = rows.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", tables.scratch(spark, "check"))
    query_.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(path).groupBy("station").agg(F.max("last_date").alias("last_date"))
