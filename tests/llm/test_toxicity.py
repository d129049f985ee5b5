import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from rainspark.llm import queries, toxicity
from tests.llm.helpers import SF, edge, nothing, table

S = toxicity.Settings()


def brute(vectors, cols, vals, k, width, prior, without=None):
    """Votes from the cosines with every example, worked out on dense vectors, one example at a time."""
    dense = np.zeros((len(vectors), width + 1))
    for i, (_, _, c, v) in enumerate(vectors):
        dense[i, c] = v
    query = np.zeros(width + 1)
    query[cols] = vals
    cosine = np.round(dense @ query, 9)
    label = np.array([v[1] for v in vectors], float)
    if without is not None:
        cosine, label = np.delete(cosine, without), np.delete(label, without)
    weight, bad, free = 1 / (1 + S.near), prior / (1 + S.near), float(k)
    for c in sorted(set(cosine.tolist()), reverse=True):
        at = cosine == c
        part = min(1.0, free / at.sum())
        w = 1 / (1 - min(c, 1.0) + S.near)
        weight += w * part * at.sum()
        bad += w * part * label[at].sum()
        free -= part * at.sum()
        if free <= 1e-12:
            break
    return bad / weight


def some_vectors(seed, n, width, kinds):
    rng = np.random.default_rng(seed)
    base = []
    for _ in range(kinds):
        cols = np.sort(rng.choice(width + 1, rng.integers(0, 6), replace=False))
        vals = rng.random(len(cols)) + 0.1
        base.append((cols, vals / math.sqrt(vals @ vals) if len(cols) else vals))
    return [(i, int(rng.random() < 0.3), *base[rng.integers(kinds)]) for i in range(n)]


def test_search_is_exact():
    for seed, n, width, kinds, block in [(1, 300, 12, 80, 4), (2, 40, 30, 40, 32), (3, 500, 5, 7, 3), (4, 5, 4, 5, 2), (5, 400, 40, 400, 8)]:
        vectors = some_vectors(seed, n, width, kinds)
        index = toxicity.build_index(vectors, width, block)
        for k in (1, 15):
            for i, (_, bad, cols, vals) in enumerate(vectors[:60]):
                found = toxicity.nearest(index, cols, vals, k)
                assert math.isclose(sum(f[2] for f in found), min(k, n))
                assert math.isclose(toxicity.vote(found, 0.2, S), brute(vectors, cols, vals, k, width, 0.2), abs_tol=1e-7)
                own = index.known[cols.tobytes(), np.round(vals, 9).tobytes()]
                found = toxicity.nearest(index, cols, vals, k, own if bad else -1 - own)
                assert math.isclose(toxicity.vote(found, 0.2, S), brute(vectors, cols, vals, k, width, 0.2, i), abs_tol=1e-7)


def test_blocks_are_skipped():
    """Most blocks of an index of clear groups are never opened."""
    vectors = [(i, i % 2, np.array([i // 64, 64]), np.array([math.cos(i % 64 / 99), math.sin(i % 64 / 99)])) for i in range(64 * 64)]
    index = toxicity.build_index(vectors, 64, 32)
    opened = []
    plain = index.products
    index.products = lambda blocks, query: (opened.extend(blocks), plain(blocks, query))[1]
    toxicity.nearest(index, np.array([5]), np.array([1.0]), 15)
    assert 1 <= len(opened) <= 8 and len(index.first) - 1 == 128


def test_bounds_hold():
    vectors = some_vectors(7, 300, 20, 200)
    index = toxicity.build_index(vectors, 20, 8)
    for _, _, cols, vals in vectors[:50]:
        query = np.zeros(22)
        query[cols] = vals
        bounds = index.bounds(cols, vals)
        for b in range(len(bounds)):
            assert index.products([b], query)[1].max() <= bounds[b] + 1e-12


def test_query_learns_from_its_part_only_and_finds_held_out_ones(spark):
    sf = SF.replace("0.001", "0.01")
    rows = {r.doc_id: r for r in queries.op13_toxic_neighbours(spark, sf).collect()}
    docs = {r.doc_id: r.text or "" for r in table(spark, "documents", sf).collect()}
    assert set(rows) == set(docs)
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
        assert all(zlib.crc32(str(j).encode()) % 5 for j in r.nearest_ids)
    insults = "idiot moron stupid trash scum loser pathetic worthless clown disgusting".split()
    said = {i: sum(f" {x}" in t.lower() for x in insults) for i, t in docs.items()}
    assert all(rows[i].predicted for i, n in said.items() if n > 1) and sum(n > 1 for n in said.values()) > 50
    labels = {r.doc_id: r.toxic for r in table(spark, "labels", sf).collect()}
    clean = [i for i, y in labels.items() if y == 0 and rows[i].held_out]
    assert len(clean) > 40 and sum(rows[i].predicted for i in clean) <= 1


def test_evidence_and_edges(spark):
    bad, good = "you are a worthless idiot", "what a lovely morning it was"
    texts = [f"{bad if i % 2 else good} {'x' * (i % 7)}" for i in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(i, t) for i, t in enumerate(texts[:9])], "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (3, None), (5, 1)], "doc_id long, toxic int")
    rows = toxicity.score(docs.withColumn("score", F.lit("x")), marks.withColumn("ids", F.lit(1))).collect()
    assert len(rows) == 69 and all(r.predicted == r.doc_id % 2 for r in rows)
    one = next(r for r in rows if r.doc_id == 1)
    assert [e.toxic for e in one.evidence] == [1.0] * len(one.evidence) and all(e.example % 2 for e in one.evidence)
    assert {e.term for e in one.evidence} <= {t for w in bad.split() for t in toxicity.terms_of(w.encode(), S.prefixes)}
    rows = toxicity.score(edge(spark), marks).collect()
    assert len(rows) == 10 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1 and len({r.score for r in rows if r.doc_id == 6}) == 1
    assert toxicity.score(nothing(spark), marks).count() == 0
    assert {r.score for r in toxicity.score(edge(spark), marks.filter("false")).collect()} == {0.25}
    named = docs.select(F.concat(F.lit("d"), "doc_id").alias("doc_id"), "text")
    got = toxicity.score(named, marks.select(F.concat(F.lit("d"), "doc_id").alias("doc_id"), "toxic")).collect()
    assert len(got) == 69 and {type(e.example) for r in got for e in r.evidence} == {str}


def test_examples_stay_within_their_bound(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), F.col("id").cast("string")).alias("text"))
    marks = spark.range(500).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    for bound in (0, 100, 1000):
        n = toxicity.pick_examples(docs.unionAll(docs), marks.unionAll(marks), "doc_id", "text", "toxic", bound).count()
        assert n <= bound and n >= min(0.8 * bound, 390)


def test_calibration_follows_the_counts():
    share = np.array([0.05, 0.5, 0.95])
    n = np.array([1000.0, 1000.0, 1000.0])
    fit = toxicity.fit_calibration(share, n, n * [0.01, 0.3, 0.9])
    got = [toxicity.calibrated(x, fit) for x in share]
    assert got == sorted(got) and np.abs(np.array(got) - [0.01, 0.3, 0.9]).max() < 0.12
    flat = toxicity.fit_calibration(share, n, n * 0.5)
    assert flat[0] == 0.1
