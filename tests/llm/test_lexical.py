import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from rainspark.llm import lexical, queries
from tests.llm.helpers import SF, edge, nothing, table


def terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, items, k=20):
    """(item, rank, doc, score) from the formula, document by document."""
    counted = [(d, Counter(terms(t))) for d, t in docs]
    counted = [(d, c, sum(c.values())) for d, c in counted if c]
    rows, total = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c, n in counted:
            m = 75 + (25 * n * rows) // total
            score = sum(math.floor(1000 * math.log((2 * rows + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms(text) if c[t])
            if score:
                scores.append((-score, d is None, d))
        scores.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, r + 1, d, -s) for r, (s, _, d) in enumerate(scores[:k])]
    return sorted(out, key=str)


def ranked(spark, docs, items, **more):
    return sorted((tuple(r) for r in lexical.rank(docs, items, **more).collect()), key=str)


def pairs(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_query_against_brute_force(spark):
    want = brute(pairs(table(spark, "documents"), "doc_id", "text"), pairs(table(spark, "benchmark"), "item_id", "text"))
    got = sorted((tuple(r) for r in queries.op12_blocked_search(spark, SF).select("item_id", "rank", "doc_id", "score").collect()), key=str)
    assert len(want) > 100 and got == want


def test_small_shards_groups_and_blocks_of_queries(spark):
    docs, items = table(spark, "documents"), table(spark, "benchmark")
    want = brute(pairs(docs, "doc_id", "text"), pairs(items, "item_id", "text"), 7)
    for more in ({"cells": 2000}, {"width": 40}, {"query_bytes": 900}, {"block": 3, "cells": 9000, "width": 1}):
        assert ranked(spark, docs.repartition(3), items, k=7, **more) == want, more


def test_edges(spark):
    items = [(1, "a b C two two three"), (2, None), (3, "..."), (None, "wörds AND é́"), (5, "absent"), (1, "a b C two two three"), (6, "w5 w29999")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("score", F.lit("x"))
    docs = edge(spark).withColumn("rank", F.lit("x"))
    extra = spark.createDataFrame([(None, "one two three"), (None, "a b c"), (11, "one two three")], "doc_id long, text string")
    docs = docs.unionByName(extra, allowMissingColumns=True)
    want = brute(pairs(docs, "doc_id", "text"), list(dict.fromkeys(items)))
    assert len(want) == 9 and ranked(spark, docs, bench) == want
    assert ranked(spark, nothing(spark), bench) == [] and ranked(spark, docs, bench.filter("false")) == []
    named = docs.select(F.concat(F.lit("d"), "doc_id").alias("doc_id"), "text")
    got = ranked(spark, named, bench.filter("item_id = 6"))
    assert [(r[2], r[3]) for r in got] == [(f"d{d}", s) for i, _, d, s in want if i == 6]


def test_ties_go_to_the_smaller_id(spark):
    docs = spark.createDataFrame([(i, "same words here" if i % 3 else "other text") for i in range(200, 0, -1)], "doc_id long, text string").repartition(5)
    items = spark.createDataFrame([("q", "words")], "item_id string, text string")
    got = ranked(spark, docs, items, cells=30)
    assert sorted(got, key=lambda r: r[1]) == [("q", r + 1, d, got[0][3]) for r, d in enumerate([i for i in range(1, 201) if i % 3][:20])]


def shard_of(seed, docs, width, kinds):
    rng = np.random.default_rng(seed)
    centres = rng.random((kinds, width)) < 0.15
    parts = np.where(centres[rng.integers(kinds, size=docs)] ^ (rng.random((docs, width)) < 0.02), rng.integers(1, 10**6, (docs, width)), 0).astype(np.int32)
    return lexical.Shard(parts, rng.integers(1, 9000, width), 16)


def test_summaries_bound_their_blocks_and_hold_every_posting():
    shard = shard_of(1, 400, 60, 12)
    for t in range(60):
        docs, begin, summary = shard.blocked(t)
        assert sorted(docs.tolist()) == np.flatnonzero(shard.parts[:, t]).tolist()
        for b in range(len(summary)):
            assert (summary[b] == shard.parts[docs[begin[b] : begin[b + 1]]].max(0)).all()


def test_search_is_exact_and_skips_blocks():
    met = skipped = 0
    for seed in range(6):
        shard = shard_of(seed, 600, 60, 30)
        names = list(range(600))
        rng = np.random.default_rng(seed)
        for _ in range(10):
            q = np.sort(rng.choice(60, 8, replace=False))
            times = rng.integers(1, 3, 8)
            top = lexical.Top(10)
            a, b = lexical.search_shard(shard, names, q, times, top)
            met, skipped = met + a, skipped + b
            scores = (shard.parts[:, q].astype(np.int64) * (times * shard.weights[q])).sum(1)
            order = np.lexsort((names, -scores))[:10]
            assert top.scores.tolist() == scores[order].tolist() and top.docs == order.tolist()
    assert skipped > met / 4  # clear groups: a fair part of all blocks is never opened


def test_sums_beyond_doubles_are_exact():
    parts = np.array([[999_999, 1], [999_998, 7]], np.int32)
    factors = np.array([2**40 + 1, 3], np.int64)
    assert lexical.exact_sums(parts, factors).tolist() == [999_999 * (2**40 + 1) + 3, 999_998 * (2**40 + 1) + 21]
