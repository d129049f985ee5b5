import hashlib


from rainspark.llm import queries, warc
from rainspark.llm.common import new_path
from tests.llm.helpers import SF, table

SCHEMA = "page_id long, url string, html string, type string"


def write(spark, rows, **options):
    path = new_path(spark, "test-archives")
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    warc.write_archives(warc.records(df, "page_id", "url", "html"), path, **options)
    return path


FAKE = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n"


def test_query(spark):
    pages = table(spark, "pages").collect()
    rows = {r.page_id: r for r in queries.op3_warc_round_trip(spark, SF).collect()}
    assert len(rows) == len(pages)
    for p in pages:
        data = p.html.encode()
        assert (rows[p.page_id].payload_bytes, rows[p.page_id].payload_digest) == (len(data), hashlib.sha1(data).hexdigest())


def test_magic_inside_payloads_is_rejected(spark):
    rows = [(1, "u", FAKE), (2, "u", "x" * 50 + FAKE * 3 + "tail"), (3, "u", "WARC/1.0\r\n"), (4, "u\r\n" + FAKE, "plain")]
    rows += [(5, "u", "WARC/1.0\r\nContent-Length: 99999999999999999999999\r\n\r\n"), (6, None, None), (7, "", "é😀\r\n\r\n")]
    rows += [(8, "u", "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\n" + "WARC/1.0\r\n" * 4)]
    for options in ({"compression": "none"}, {"compression": "gzip"}):
        got = {r.page_id: r for r in warc.read_pages(spark, write(spark, rows, **options)).collect()}
        assert {k: bytes(r.payload).decode() for k, r in got.items()} == {r[0]: r[2] or "" for r in rows}


def test_splits_inside_files(spark):
    rows = [(i, "u", (f"{i} " * (i % 90)) + (FAKE if i % 7 == 0 else "")) for i in range(300)]
    path = new_path(spark, "test-archives")
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).coalesce(1)
    warc.write_archives(warc.records(df, "page_id", "url", "html"), path, compression="none")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        got = warc.read_pages(spark, path).collect()
        assert {r.page_id: bytes(r.payload).decode() for r in got} == {r[0]: r[2] for r in rows}
        assert len(got) == len(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_revisits(spark):
    big, small = "b" * 1000, "s" * 999
    rows = [(1, "u", big), (2, "u", big), (9, "u", big), (3, "u", small), (4, "u", small), (None, "u", big), (9, "u", big)]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    got = [(r.page_id, r.type, r.refers_to) for r in warc.records(df, "page_id", "url", "html").collect()]
    want = [(1, "revisit", 9), (2, "revisit", 9), (9, "response", None), (3, "response", None), (4, "response", None)]
    assert sorted(got, key=str) == sorted([*want, (None, "revisit", 9), (9, "response", None)], key=str)


def test_empty(spark):
    assert warc.read_pages(spark, write(spark, [])).count() == 0


def test_pointer_jumping(spark):
    chain = [("f", i, i + 1) for i in range(50)] + [("f", 100, 101), ("f", 101, 7), ("g", 1, 2)]
    edges = spark.createDataFrame(chain, "file string, at long, next long")
    assert {(r.file, r["at"]) for r in warc.reachable(edges).collect()} == {("f", i) for i in range(50)}
