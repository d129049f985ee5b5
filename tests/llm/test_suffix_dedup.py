import hashlib

import numpy as np
from pyspark.sql import functions as F

from rainspark.llm import queries, suffix_dedup
from tests.llm.helpers import SF, edge, nothing, table


def brute(docs, length=50):
    """Removed byte masks of (id, text) rows."""
    first = {}
    data = [(suffix_dedup.LAST if i is None else i, (t or "").encode()) for i, t in docs]
    for i, b in data:
        for p in range(len(b) - length + 1):
            s = b[p : p + length]
            first[s] = min(first.get(s, i), i)
    out = []
    for i, b in data:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < i:
                gone[p : p + length] = True
        out.append((b, gone))
    return out


def same(rows, docs, length=50):
    want = {}
    for (i, _), (b, gone) in zip(docs, brute(docs, length), strict=True):
        step = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        spans = list(zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist(), strict=True))
        want.setdefault(i, []).append((len(b), np.frombuffer(b, np.uint8)[~gone].tobytes(), spans))
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.n_bytes, bytes(r.kept), [(s["first"], s["end"]) for s in r.spans]) in want[r.doc_id]


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, "documents").collect()]
    rows = {r.doc_id: r for r in queries.op4_suffix_dedup(spark, SF).collect()}
    assert len(rows) == len(docs)
    for (i, _), (b, gone) in zip(docs, brute(docs), strict=True):
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        r = rows[i]
        got = (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
        assert got == (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())


def test_hostile_texts_in_small_blocks(spark):
    rng = np.random.default_rng(7)
    letters = np.array(list("ab"))
    base = "".join(rng.choice(letters, 400))
    docs = []
    for i in rng.permutation(60).tolist():
        a, b = sorted(rng.integers(0, 400, 2).tolist())
        text = base[a:b] + "".join(rng.choice(letters, rng.integers(0, 60))) + base[b : b + 70]
        if i % 7 == 0:
            text = "z" * int(rng.integers(40, 200))
        if i % 11 == 0:
            text = "é😀" * int(rng.integers(5, 40))
        docs.append((i, text))
    docs += [(None, base), (None, base), (3, base), (3, base), (61, None), (62, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for options in ({"block_bytes": 3000, "part_bytes": 300}, {}):
        same(suffix_dedup.remove_repeats(df, **options).collect(), docs)
    same(suffix_dedup.remove_repeats(df, length=30, block_bytes=2000).collect(), docs, 30)


def test_edges(spark):
    docs = [(r.doc_id, r.text) for r in edge(spark).collect()]
    same(suffix_dedup.remove_repeats(edge(spark)).collect(), docs)
    carried = suffix_dedup.remove_repeats(edge(spark).withColumn("n", F.col("doc_id") * 2), carry_col="n").collect()
    assert all(r.carried == str(2 * r.doc_id) for r in carried)
    assert suffix_dedup.remove_repeats(nothing(spark)).count() == 0


def test_loser_tree_merges_front_coded_runs():
    rng = np.random.default_rng(2)
    for k in (1, 2, 3, 5, 8, 13):
        runs, everything = [], []
        for r in range(k):
            rows = np.sort(rng.integers(0, 3, (int(rng.integers(0, 40)), 6)).astype(np.uint8).view("S6").ravel())
            table_ = np.frombuffer(rows.tobytes(), np.uint8).reshape(-1, 6)
            everything += [(bytes(x), r) for x in table_]
            shared, rest = suffix_dedup.front_code(table_)
            assert [bytes(x) for x in table_] == [x for _, x in suffix_dedup.front_decode(shared, rest, 6)]
            runs.append(suffix_dedup.front_decode(shared, rest, 6))
        got = list(suffix_dedup.merge_runs(runs))
        assert [(x, r) for _, x, r in got] == sorted(everything)
        for (_, x, _), (shared, y, _) in zip(got, got[1:], strict=False):
            assert shared == next((i for i in range(6) if x[i] != y[i]), 6)


def test_frequent_phrase_with_different_text_around(spark):
    """A phrase of one k-mer's length in all texts is no group in memory: its windows go by their own hash."""
    rng = np.random.default_rng(4)
    phrase, words = "x" * 12 + "0123456789abcdefgh" + "y" * 12, [f"w{i} " for i in range(50)]
    docs = []
    for i in rng.permutation(400).tolist():
        around = ["".join(rng.choice(words, 30)) for _ in range(2)]
        docs.append((i, around[0] + phrase + around[1] if i % 5 else "the same text around it " + phrase + " and the same behind it"))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    same(suffix_dedup.remove_repeats(df, block_bytes=6000, part_bytes=600, group_places=50).collect(), docs)
    same(suffix_dedup.remove_repeats(df, block_bytes=6000, part_bytes=600, group_places=1).collect(), docs)


def test_front_coding_of_long_rows():
    """Rows of more than 255 bytes, as lengths from 139 give."""
    rng = np.random.default_rng(9)
    for length in (139, 170, 200):
        width = 2 * length - suffix_dedup.KMER + 2
        rows = rng.integers(0, 2, (60, width)).astype(np.uint8)
        rows[:, : width - 20] = rows[0, : width - 20]
        runs = []
        for part in (rows[:30], rows[30:]):
            part = sorted(map(bytes, part))
            shared, rest = suffix_dedup.front_code(np.frombuffer(b"".join(part), np.uint8).reshape(-1, width))
            runs.append(suffix_dedup.front_decode(shared, rest, width))
        assert [x for _, x, _ in suffix_dedup.merge_runs(runs)] == sorted(map(bytes, rows))


def test_long_windows(spark):
    rng = np.random.default_rng(1)
    base = "".join(rng.choice(list("abc "), 700))
    docs = [(i, base[a : a + int(rng.integers(100, 500))]) for i, a in enumerate(rng.integers(0, 400, 40).tolist())]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for length in (139, 200):
        same(suffix_dedup.remove_repeats(df, length=length, block_bytes=3000, part_bytes=300).collect(), docs, length)


def test_keys_fill_all_ranges_alike():
    data = bytes(np.random.default_rng(3).integers(97, 123, 400_000).astype(np.uint8))
    key = suffix_dedup.anchors(data, np.array([len(data)]), 50)[3]
    share = np.bincount((key >> np.uint64(60)).astype(np.int64), minlength=16) / len(key)
    assert 0.05 < share.min() and share.max() < 0.08


def test_a_prefix_in_most_texts_is_split():
    cuts, times = np.array([5, 9], np.uint64), np.array([1, 4])
    rows = np.random.default_rng(0).integers(0, 255, (400, 76)).astype(np.uint8)
    rows[:, :8] = np.frombuffer((18).to_bytes(8, "big"), np.uint8)
    part = suffix_dedup.range_of(rows, cuts, times)
    assert set(part.tolist()) == {4, 5, 6, 7}
    rows[:, 8:24] = 1
    assert len(set(suffix_dedup.range_of(rows, cuts, times).tolist())) == 1


def test_requests_never_outnumber_keys():
    """However many ranges there are, a block sends no empty pieces: rows grow with the keys, not with blocks x ranges."""
    data = bytes(np.random.default_rng(3).integers(97, 123, 3000).astype(np.uint8))
    row = {"block": 0, "doc_ids": [1], "sizes": suffix_dedup.dump_small(np.array([3000])), "data": suffix_dedup.squeeze(data)}
    batch = suffix_dedup.pa.RecordBatch.from_pylist([row])
    keys = len(np.unique(suffix_dedup.anchors(data, np.array([3000]), 50)[3]))
    for ranges in (4, 100_000):
        assert len(list(suffix_dedup._ask(ranges, 64, 50)(iter([batch])))) <= min(ranges, keys)
