import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from rainspark.llm import blobs, lm_score, queries
from tests.llm.helpers import SF, edge, nothing, table


def tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def brute(docs, rounds=12):
    """The model in plain Python: counts, the deleted section's evidence, expectation-maximisation, scores."""
    part = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 for i, _ in docs}
    one, two, one_d, two_d = Counter(), Counter(), Counter(), Counter()
    for i, text in docs:
        t = tokens(text)
        if part[i] != 2:
            one.update(t)
            two.update(zip([None, *t], t))
            if part[i] == 3:
                one_d.update(t)
                two_d.update(zip([None, *t], t))
    n, v, n_d = sum(one.values()), len(one), sum(one_d.values())

    def bucket(c):
        return c.bit_length()

    lam = np.full((66, 3), 1 / 3)
    rows = []
    for (a, b), times in two_d.items():
        c = one[a] - one_d[a]
        rows.append((bucket(c), times, (two[a, b] - two_d[a, b]) / max(c, 1), (one[b] - one_d[b]) / max(n - n_d, 1), 1 / (v + 1)))
    for _ in range(rounds if rows else 0):
        sums = np.zeros((66, 3))
        for k, times, *p in rows:
            x = lam[k] * p
            sums[k] += times * x / x.sum()
        lam = (sums + 1e-3) / (sums + 1e-3).sum(1, keepdims=True)
    lam[0] = [0, *(lam[0, 1:] / lam[0, 1:].sum())]
    out = []
    for i, text in docs:
        t = tokens(text)
        base = sum(math.log10((one[w] + 1) / (n + v + 1)) for w in t)
        full = sum(
            math.log10(lam[bucket(one[a])] @ [two[a, b] / max(one[a], 1), one[b] / max(n, 1), 1 / (v + 1)])
            for a, b in zip([None, *t], t)
        )
        out.append((i, part[i] == 2, len(t), sum(one[w] > 0 for w in t), n, base, full))
    return out


def same(rows, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    got, want = sorted(map(tuple, rows), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want, strict=True):
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=1e-5)


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, "documents").collect()]
    rows = queries.op1_deleted_interpolation(spark, SF).collect()
    same(rows, brute(docs))
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)  # it predicts unseen texts better than the base


def test_small_blocks_give_the_same_scores(spark):
    docs = table(spark, "documents")
    want = {r.doc_id: r.score for r in lm_score.score(docs).collect()}
    for r in lm_score.score(docs, block_bytes=5000).collect():
        assert r.score == pytest.approx(want[r.doc_id], rel=1e-6)


def test_edges(spark):
    docs = [(r.doc_id, r.text) for r in edge(spark).collect()]
    same(lm_score.score(edge(spark)).collect(), brute(docs))
    assert lm_score.score(nothing(spark)).count() == 0
    alone = spark.createDataFrame([(None, "a b a")], "doc_id long, text string")
    same(lm_score.score(alone).collect(), brute([(None, "a b a")]))


def test_blobs():
    rng = np.random.default_rng(0)
    keys = np.sort(rng.integers(0, 2**63, 1000).astype(np.uint64) * np.uint64(2))
    assert (blobs.load_sorted(blobs.dump_sorted(keys)) == keys).all()
    cuts = blobs.range_cuts(keys, 7)
    assert cuts[0] == 0 and cuts[-1] == 1000 and (np.diff(cuts) >= 0).all() and len(cuts) == 8
    for top in (1, 300, 70000, 2**40):
        x = rng.integers(0, top + 1, 50)
        assert (blobs.load(blobs.dump_small(x)) == x).all()
    assert len(blobs.load(blobs.dump(np.zeros(0, np.uint32)))) == 0


def test_requests_never_outnumber_keys():
    """However many ranges there are, a block sends no empty pieces: rows grow with the keys, not with blocks x ranges."""
    rng = np.random.default_rng(5)
    words = np.concatenate([[lm_score.END_KEY], rng.integers(1, 2**63, 200).astype(np.uint64)])
    ids = np.append(rng.integers(0, 201, 999), 0).astype(np.uint32)
    row = {"block": 0, "deleted": False, "doc_ids": [1], "held": [False], "sizes": blobs.dump_small(np.array([1000])), "words": blobs.dump(words), "ids": blobs.dump(ids)}
    batch = lm_score.pa.RecordBatch.from_pylist([row])
    keys = len(words) + len(lm_score.bigrams(words, ids)[0])
    for ranges in (4, 100_000):
        assert len(list(lm_score._requests(ranges)(iter([batch])))) <= min(ranges, keys)
