import zlib

import numpy as np

from rainspark.llm import queries, sharding
from tests.llm.helpers import SF, edge, nothing, table


def brute(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2**31 / ((key >> 33) + 1)))
    return b


def test_jump_hash_is_the_published_one():
    keys = np.random.default_rng(1).integers(0, 2**63, 500).astype(np.uint64)
    for n in (1, 2, 8, 100):
        assert sharding.jump_hash(keys, n).tolist() == [brute(int(k), n) for k in keys]


def test_query(spark):
    docs = {r.doc_id: r.text or "" for r in table(spark, "documents").collect()}
    rows = queries.op7_jump_sharding(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        data = docs[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data))
        assert r.grown_shard in (r.shard, 8)
    assert any(r.grown_shard == 8 for r in rows)
    for s in range(8):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))


def test_edges(spark):
    rows = sharding.shard_rows(edge(spark), "doc_id", "text", 3).collect()
    assert len(rows) == 10
    for s in range(3):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert {(r["size"], r.text_crc32) for r in rows if r.doc_id in (1, 2)} == {(1, 0)}
    assert len({r.shard for r in rows if r.doc_id == 6}) == 1
    assert sharding.shard_rows(nothing(spark), "doc_id", "text").count() == 0


def test_null_ids_share_a_shard(spark):
    docs = spark.createDataFrame([(None, "a"), (None, "b"), (None, "a"), (3, None)], "doc_id long, text string")
    rows = sharding.shard_rows(docs, "doc_id", "text", 4).collect()
    assert len({r.shard for r in rows if r.doc_id is None}) == 1
    for shard in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
