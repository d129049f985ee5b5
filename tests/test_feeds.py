"""Files as they come: headers that differ, days that are missing, batches that are repeated, rows that are late."""

from datetime import date, datetime, timedelta

import pytest

from rainspark.sources import tables
from rainspark.streaming import stream


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def test_feeds_with_headers_of_all_kinds(spark, tmp_path):
    for name, text in {
        "20240101_madis_parsed.csv": "stationId,dataProvider,varname,time,value\nS1,RAWS,rawPrecip,2024-01-01 00:00,1.5\nS1,HADS,rawPrecip,2024-01-01 01:00,2\n",
        "20240102_madis_parsed.csv": "value,time,varname,dataProvider,stationId\n2.5,2024-01-02 10:00,rawPrecip,HADS,S2\n",
        "20240103_madis_parsed.csv": '"","stationId","time","value","more","varname","more"\n"1","S3","2024-01-03 10:00",3.5,"x, y","rawPrecip","z"\n',
        "20240104_madis_parsed.csv": "stationId,dataProvider,varname,time,value\n",
        "20240105_madis_parsed.csv": "",
        "20240106_madis_parsed.csv": "﻿stationId,dataProvider,varname,time,value\nS6,RAWS,rawPrecip,bad,x\n",
    }.items():
        (tmp_path / name).write_text(text)
    listed = [f"file://{tmp_path}/2024010{i}_madis_parsed.csv" for i in range(1, 9)]  # days 7 and 8 have no file
    want = [
        ("S1", "RAWS", "rawPrecip", datetime(2024, 1, 1), 1.5, date(2024, 1, 1)),
        ("S1", "HADS", "rawPrecip", datetime(2024, 1, 1, 1), 2.0, date(2024, 1, 1)),
        ("S2", "HADS", "rawPrecip", datetime(2024, 1, 2, 10), 2.5, date(2024, 1, 2)),
        ("S3", None, "rawPrecip", datetime(2024, 1, 3, 10), 3.5, date(2024, 1, 3)),
        ("S6", "RAWS", "rawPrecip", None, None, date(2024, 1, 6)),
    ]
    for paths in (listed, f"file://{tmp_path}", [f"file://{tmp_path}/2024*_madis_parsed.csv"]):
        got = tables.read_network_feed(spark, paths, "madis")
        assert rows(got, "station", "provider", "var", "ts", "value", "file_day") == sorted(want, key=str)
    first = tables.read_network_feed(spark, listed[0], "madis").orderBy("seq").collect()
    assert [r.value for r in first] == [1.5, 2.0]


@pytest.mark.parametrize("network", sorted(tables.FEEDS))
def test_a_feed_without_files_is_empty_and_typed(spark, tmp_path, network):
    (tmp_path / "20240105_x_parsed.csv").write_text("")
    (tmp_path / "20240106_x_parsed.csv").write_text("nothing,that,is,known\n1,2,3,4\n")
    some = tables.read_network_feed(spark, f"file://{tmp_path}/20240106_x_parsed.csv", network)
    assert [tuple(r[:7]) for r in some.collect()] == [(None,) * 7]
    for paths in (f"file://{tmp_path}/none", [], f"file://{tmp_path}/20240105_x_parsed.csv"):
        got = tables.read_network_feed(spark, paths, network)
        assert got.count() == 0 and got.dtypes == some.dtypes
        assert tables.rain_of_feed(got, network).count() == 0


def test_header_names():
    assert tables.column_names('"",a, b ,"c,d",A,b') == ["_c0", "a", "b", "c,d", "_c4", "_c5"]
    assert tables.column_names("") == []


def test_a_repeated_batch_counts_once(spark):
    path, kind = tables.scratch(spark, "months"), "skn long, date date, rf double"
    assert tables.read_months(spark, path, kind).count() == 0
    one = spark.createDataFrame([(1, date(2024, 1, 31), 1.0), (1, date(2024, 2, 1), 2.0)], kind)
    two = spark.createDataFrame([(1, date(2024, 2, 2), 3.0)], kind)
    for df, batch in ((one, "a"), (two, "b"), (one, "a")):
        tables.append_month(df, path, batch)
    every = [(1, date(2024, 1, 31), 1.0, "2024_01"), (1, date(2024, 2, 1), 2.0, "2024_02"), (1, date(2024, 2, 2), 3.0, "2024_02")]
    assert rows(tables.read_months(spark, path, kind), "skn", "date", "rf", "month") == every
    tables.append_month(one.filter("rf > 1"), path, "a")  # a batch that has fewer months the second time
    assert rows(tables.read_months(spark, path, kind), "skn", "date", "rf", "month") == every[1:]
    one.selectExpr("*", "'2024_09' as month", "'unfinished' as attempt").write.mode("append").partitionBy("month", "attempt").parquet(f"{path}/rows")
    assert rows(tables.read_months(spark, path, kind), "skn", "date", "rf", "month") == every[1:]
    assert rows(tables.read_months(spark, path, kind, ["2024_01"]), "rf") == []


def test_late_rows_replace_their_days(spark):
    """Files of readings, one of them late by a week, one by hours; days are right after every batch."""
    kind = "station long, ts timestamp_ntz, seq long, value double"
    noon = datetime(2024, 1, 1, 22)  # local noon
    days = {i: [(s, noon + timedelta(days=i, minutes=m), 100 * i + 10 * s + m, float(i + 1)) for s in (1, 2) for m in (0, 5)] for i in range(10)}
    extra = [(1, noon + timedelta(days=1, minutes=30), 999, 50.0)]
    files = [days[0], days[1], days[2], days[4], days[3], days[5] + days[6], days[9], extra, days[7][:2], days[8] + days[9]]
    source, path, check = (tables.scratch(spark, x) for x in ("source", "late", "check"))
    sent: dict[tuple, tuple] = {}
    for file in files:
        spark.createDataFrame(file, kind).coalesce(1).write.mode("append").parquet(source)
        sent.update({(r[0], r[1], r[2]): r for r in file})
        stream.late_totals(spark.readStream.schema(kind).parquet(source), path, check).awaitTermination()
        want: dict[tuple, list] = {}
        for s, ts, _, v in sent.values():
            want.setdefault(((ts - timedelta(hours=10, seconds=1)).date(), s), []).append(v)
        totals = sorted((d, s, sum(v), len(v)) for (d, s), v in want.items())
        assert rows(stream.days_of(spark, path), "date", "station", "rf", "n_obs") == sorted(totals, key=str)
        top = max(r[1] for r in sent.values()) - timedelta(hours=10, seconds=1)
        closed = rows(stream.days_of(spark, path, still_open=False), "date", "station", "rf", "n_obs")
        assert closed == [t for t in sorted(totals, key=str) if t[0] < (top - timedelta(days=2)).date()]
    assert (date(2024, 1, 2), 1, 54.0, 3) in closed
    whole = tables.scratch(spark, "late")  # all files in one batch
    stream.late_totals(spark.readStream.schema(kind).parquet(source), whole, tables.scratch(spark, "check")).awaitTermination()
    assert rows(stream.days_of(spark, whole), "date", "station", "rf", "n_obs") == sorted(totals, key=str)
