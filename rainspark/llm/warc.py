"""Write web archives, and read them back with verified record boundaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rainspark.llm.common import stage

MAGIC = "WARC/1.0\r\n"
BREAK = "\r\n\r\n"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8" + BREAK
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def records(df: DataFrame, id_col: str, url_col: str, payload_col: str, least_bytes: int = 1000) -> DataFrame:
    """page_id, url, payload, digest, type and refers_to of every row.

    Among rows with equal payloads of least_bytes or more, those with the largest id are responses and the others
    revisit it (rows that repeat the largest id are all responses; a null id is below any other). The groups of equal
    payloads are found from digests; only groups of two or more are kept, and Spark broadcasts them if they are small.
    """
    rows = df.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("payload")
    ).withColumn("digest", F.sha1(F.col("payload").cast("binary")))
    rows = rows.withColumn("shared", F.when(F.octet_length("payload") >= least_bytes, F.col("digest")))
    groups = rows.filter("shared is not null").groupBy("shared").agg(F.max("page_id").alias("top"), F.count("*").alias("n"))
    groups = stage(groups.filter("n > 1").select("shared", "top"), "equal-payloads")
    again = F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top"))
    return rows.join(groups, "shared", "left").select(
        "page_id",
        "url",
        "payload",
        "digest",
        F.when(again, "revisit").otherwise("response").alias("type"),
        F.when(again, F.col("top")).alias("refers_to"),
    )


def record_text(date: str) -> Column:
    """A record up to its payload's end; the writer's line separator closes it. Line breaks in urls are escaped."""
    url = F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), r"[\x00-\x20]", "%20")
    body = F.when(F.col("type") == "revisit", F.lit(HTTP_HEAD)).otherwise(F.concat(F.lit(HTTP_HEAD), "payload"))
    refers = F.concat(
        F.lit("WARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(f">\r\nWARC-Profile: {PROFILE}\r\n")
    )
    return F.concat(
        F.lit(MAGIC + "WARC-Type: "),
        "type",
        F.lit("\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Date: " + date + "\r\nWARC-Target-URI: "),
        url,
        F.lit("\r\nWARC-Payload-Digest: sha1:"),
        "digest",
        F.lit("\r\n"),
        F.coalesce(refers, F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit(BREAK),
        body,
    )


def write_archives(
    rows: DataFrame, path: str, date: str = "2000-01-01T00:00:00Z", compression: str = "gzip", most_records: int = 20_000
) -> None:
    """Archives of at most most_records records from each partition of rows (as records() gives them).

    Spark's text writer closes every record. An archive is packed as one gzip stream, so it is one split when it is read;
    the number of records bounds it.
    """
    text = rows.select(record_text(date).alias("value")).write.option("lineSep", BREAK).option("compression", compression)
    text.option("maxRecordsPerFile", most_records).text(path)


def fragments(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(values, places) of what stands between two magics, both by file, split and line.

    values has the text of each fragment, written once to the shared folder. places is narrow: start (its byte offset in
    the unpacked file), size, head (bytes of the header with its break, null without one) and length (as the header says).
    Files are cut at the magic by Spark's reader, in as many tasks as there are splits. An offset is the sum of what stands
    before it in its split, plus the splits before; only narrow rows are put in order for that.
    """
    n = len(MAGIC)
    lines = spark.read.option("lineSep", MAGIC).text(path)
    values = stage(
        lines.select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("line"),
            "value",
        ),
        "fragments",
        "zstd",
    )
    head = F.when(F.contains("value", F.lit(BREAK)), F.octet_length(_head()) + len(BREAK))
    size = F.octet_length("value").cast("long")
    lines = values.select("file", "split", "line", size.alias("size"), head.alias("head"), F.when(head.isNotNull(), _length()).alias("length"))
    lines = stage(lines, "sizes")
    before = Window.partitionBy("file", "split").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(F.col("size") + n).over(before), F.lit(0))
    splits = lines.groupBy("file", "split").agg(F.sum(F.col("size") + n).alias("whole"))
    ahead = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file", "split", F.coalesce(F.sum("whole").over(ahead), F.lit(0)).alias("base"))
    places = lines.withColumn("inside", inside).join(splits, ["file", "split"])
    return values, places.select("file", "split", "line", (F.col("base") + F.col("inside")).alias("start"), "size", "head", "length")


def _head() -> Column:
    return F.substring_index("value", BREAK, 1)


def _length() -> Column:
    return F.regexp_extract(_head(), r"(?im)^Content-Length:[ \t]*([0-9]{1,18})[ \t]*\r?$", 1).try_cast("long")


def reachable(edges: DataFrame) -> DataFrame:
    """(file, at) of the records that chains of successors reach from offset 0 of their file, by pointer jumping.

    edges: file, at, next. Round k extends what is reached by jumps over 2^k records, then doubles the jumps, so a
    file of n records takes about log2(n) rounds. Both tables are narrow and written to the shared folder each round.
    """
    reached = stage(edges.filter("at = 0").select("file", "at"), "reached")
    jumps = stage(edges.select("file", "at", "next"), "jumps")
    ends = jumps.select("file", F.col("at").alias("next"))
    jumps = stage(jumps.join(ends, ["file", "next"], "left_semi"), "jumps")  # a successor must be a candidate itself
    while not jumps.isEmpty():
        far = reached.join(jumps, ["file", "at"]).select("file", F.col("next").alias("at"))
        reached = stage(reached.union(far).distinct(), "reached")
        then = jumps.select("file", F.col("at").alias("next"), F.col("next").alias("after"))
        jumps = stage(jumps.join(then, ["file", "next"]).select("file", "at", F.col("after").alias("next")), "jumps")
    return reached


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """file, head and block (bytes) of every record of the archives under path.

    Every magic is a candidate: the Content-Length after it gives its successor. Only candidates that the chain from
    the file's start reaches are records, so a magic inside a payload is rejected, and the pieces it cut are put
    together again. Most records are one fragment and go straight through; a narrow table of exceptions (rejected or cut
    ones, and what stands before a file's first magic) takes the others out, and Spark broadcasts it if it is small. A file without a record at offset 0 gives no rows.
    """
    n = len(MAGIC)
    values, parts = fragments(spark, path)
    keys = ["file", "split", "line"]
    at, start = F.col("start") - n, F.col("start")
    fields = parts.filter("start > 0").select(
        *keys, at.alias("at"), (start + F.col("head") + F.col("length") + len(BREAK)).alias("next"), (start + F.col("size")).alias("end")
    )
    fields = stage(fields, "candidates")
    good = reachable(fields.filter("next is not null").select("file", "at", "next")).withColumn("good", F.lit(True))
    marked = stage(fields.join(good, ["file", "at"], "left"), "marked")
    odd = marked.filter("good is null or next <> end")  # rejected, or with payload beyond its fragment
    cut = odd.select("file").distinct()
    before = Window.partitionBy("file").orderBy("at")
    owner = F.last(F.when(F.col("good"), F.struct("at", "next")), ignorenulls=True).over(before)
    owner = F.when(F.col("at") < owner["next"], owner["at"])
    owned = marked.join(cut, "file", "left_semi").select(*keys, "at", "good", "next", "end", owner.alias("owner"))
    owned = stage(owned.filter("good is null or next <> end").select(*keys, "at", "owner"), "exceptions")
    others = owned.select(*keys).unionByName(parts.filter("start = 0").select(*keys))
    single = values.join(stage(others, "others"), keys, "left_anti").select("file", "value")
    pieces = values.join(owned.filter("owner is not null").select(*keys, "at", "owner"), keys)
    joined = (
        pieces.groupBy("file", F.col("owner").alias("at"))
        .agg(F.array_sort(F.collect_list(F.struct(F.col("at").alias("piece"), "value"))).alias("x"))
        .select("file", F.array_join(F.transform("x", lambda s: s["value"]), MAGIC).alias("value"))
    )
    data = F.col("value").cast("binary")
    size = _length().cast("int")
    return (
        single.union(joined)
        .select("file", _head().alias("head"), F.substring(data, F.octet_length(_head()) + len(BREAK) + 1, size).alias("block"))
    )


def header(name: str) -> Column:
    """A header of a record, null if it has none."""
    return F.nullif(F.regexp_extract("head", rf"(?im)^{name}:[ \t]*(.*?)[ \t]*\r?$", 1), F.lit(""))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """page_id, url, type, digest (as written), refers_to, payload (bytes; null for a revisit) of every record."""
    number = r"^<urn:page:(-?[0-9]+)>$"
    end = F.instr(F.col("block").cast("string"), BREAK) + len(BREAK)
    return read_archives(spark, path).select(
        F.regexp_extract(F.coalesce(header("WARC-Record-ID"), F.lit("")), number, 1).try_cast("long").alias("page_id"),
        header("WARC-Target-URI").alias("url"),
        header("WARC-Type").alias("type"),
        header("WARC-Payload-Digest").alias("digest"),
        F.regexp_extract(F.coalesce(header("WARC-Refers-To"), F.lit("")), number, 1).try_cast("long").alias("refers_to"),
        F.when(
            header("WARC-Type") == "response", F.substring(F.col("block"), end, F.octet_length("block"))
        ).alias("payload"),
    )
