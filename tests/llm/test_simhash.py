import itertools
import re

import numpy as np
import xxhash

from rainspark.llm import queries, simhash
from rainspark.llm.graph import components
from tests.llm.helpers import SF, edge, nothing, table


def brute_fp(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    k = min(4, len(words))
    hs = [xxhash.xxh64_intdigest(" ".join(words[i : i + k]).encode(), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps):
    parent = {i: i for i in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(fps, 2):
        if (fps[a] ^ fps[b]).bit_count() <= 4:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {i: find(i) for i in fps}


def test_query_against_brute_force(spark):
    docs = {r.doc_id: r.text for r in table(spark, "documents").collect()}
    fps = {i: brute_fp(t) for i, t in docs.items()}
    rows = queries.op5_simhash_pigeonring(spark, SF).collect()
    assert {r.doc_id: r.fingerprint for r in rows} == {i: f"{f:016x}" for i, f in fps.items()}
    assert {r.doc_id: r.component_id for r in rows} == brute_components(fps)


def test_no_link_is_lost(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 40).astype(np.uint64) * np.uint64(2)
    found = set()
    for x in base.tolist():
        found.add(x)
        for n in range(0, 8):
            for _ in range(3):
                y = x
                for b in rng.choice(64, n, replace=False).tolist():
                    y ^= 1 << b
                found.add(y)
    values = [int(np.array(v, np.uint64).view(np.int64)) for v in found]
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    for errors in (1, 4, 6):
        got = {(r.a, r.b) for r in simhash.links(df, errors).select("a", "b").distinct().collect()}
        want = {(a, b) for a, b in itertools.combinations(sorted(values), 2) if ((a ^ b) & (2**64 - 1)).bit_count() <= errors}
        assert got == want


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_edges(spark):
    rows = simhash.near_duplicates(edge(spark)).collect()
    assert len(rows) == 10
    by = {r.doc_id: r for r in rows}
    assert by[1].fp == by[2].fp == by[9].fp == 0
    assert by[1].component_id == by[2].component_id == by[9].component_id == 1
    assert by[4].component_id == 3 and by[6].component_id == 6
    assert simhash.near_duplicates(nothing(spark)).count() == 0


def test_null_ids_name_no_other_group(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(None, text), (7, text), (None, "one two three four five six"), (None, None)], "doc_id long, text string")
    rows = simhash.near_duplicates(docs).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in rows) == [("7", "7"), ("None", "7"), ("None", "None"), ("None", "None")]
