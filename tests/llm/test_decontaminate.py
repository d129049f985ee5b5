import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from rainspark.llm import decontaminate, queries
from tests.llm.helpers import SF, edge, nothing, table


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, items, width=10):
    w, hit, found = words(text), set(), set()
    for item, body in items:
        b = words(body)
        n = min(width, len(b))
        if n:
            windows = {tuple(b[i : i + n]) for i in range(len(b) - n + 1)}
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found.add(str(item))
    return len(w), len(hit), sorted(found)


def brute_longest(text, items):
    """Words of the longest run of a document that stands in an item, however short, and its first place."""
    w, best = words(text), (0, None)
    for _, body in items:
        b = words(body)
        starts = {}
        for f, x in enumerate(b):
            starts.setdefault(x, []).append(f)
        for i in range(len(w)):
            for f in starts.get(w[i], ()):
                m = 1
                while i + m < len(w) and f + m < len(b) and w[i + m] == b[f + m]:
                    m += 1
                best = max(best, (m, i), key=lambda x: (x[0], -(x[1] or 0)))
    return best


def longest_of(m):
    return (m.length, m.doc_word) if m else (0, None)


def report(spark, docs, items, **more):
    got = decontaminate.scan(docs, items, columns=["doc_id"], **more)
    rows = got.select("*", decontaminate.n_hit().alias("n_hit")).collect()
    return [(r.doc_id, (r.n_words, r.n_hit, sorted(set(r["items"]))), r) for r in rows]


def test_query_against_brute_force(spark):
    docs = {r.doc_id: r.text for r in table(spark, "documents").collect()}
    items = [(r.item_id, r.text) for r in table(spark, "benchmark").collect()]
    rows = queries.op10_suffix_decontamination(spark, SF).collect()
    assert len(rows) == len(docs) and any(r.contaminated for r in rows)
    for r in rows:
        n, hit, found = brute(docs[r.doc_id], items)
        digest = hashlib.sha256(",".join(found).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (n, hit, len(found), digest, hit > 0)
        assert (r.longest_words, r.longest_at) == brute_longest(docs[r.doc_id], items)


def test_short_items_blocks_and_edges(spark):
    items = [(1, "two three"), (2, "W29990 w29991"), (3, None), (4, "..."), (5, "line"), (5, "line"), (None, "wörds and")]
    items += [(7, "a b c d e f g h i j k l m n"), (8, "k l m n o p a b c d e f g h i j zz")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    named = [("" if i is None else i, t) for i, t in items]
    for size in (32 << 20, 40):
        rows = report(spark, edge(spark), bench, block_bytes=size)
        assert len(rows) == 10
        texts = {}
        for r in edge(spark).collect():
            texts.setdefault(r.doc_id, []).append(r.text)
        for doc, got, r in rows:
            assert got in [brute(t, named) for t in texts[doc]], doc
            assert longest_of(r.longest) in [brute_longest(t, items) for t in texts[doc]], doc
    assert report(spark, nothing(spark), bench) == []
    assert all(x[1][1:] == (0, []) and x[2].longest is None for x in report(spark, edge(spark), bench.filter("false")))


def test_longest_matches_and_places(spark):
    body = " ".join(f"x{i}" for i in range(30))
    bench = spark.createDataFrame([(1, body)], "item_id long, text string")
    text = "before it " + " ".join(f"x{i}" for i in range(3, 25)) + " after"
    docs = spark.createDataFrame([(1, text), (2, " ".join(f"x{i}" for i in range(9)))], "doc_id long, text string")
    rows = {d: r for d, _, r in report(spark, docs, bench)}
    assert [(m.item_id, m.doc_word, m.item_word, m.length) for m in rows[1].matches] == [("1", 2, 3, 22)]
    assert rows[2].matches == [] and tuple(rows[2].longest) == ("1", 0, 0, 9)
    assert tuple(rows[1].longest) == ("1", 2, 3, 22)
    twice = spark.createDataFrame([(1, body), (2, "y " + body), (3, "z " * 12)], "item_id long, text string")
    for size in (32 << 20, 60):  # in one block and in several, whose hits are joined
        rows = {d: r for d, _, r in report(spark, docs.withColumn("_row", F.lit("x")), twice, block_bytes=size)}
        found = sorted((m.item_id, m.doc_word, m.item_word, m.length) for m in rows[1].matches)
        assert found == [("1", 2, 3, 22), ("2", 2, 4, 22)] and rows[2].matches == []
    kept = decontaminate.decontaminate(docs.withColumn("hits", F.lit(1)), bench).collect()
    assert [(r.doc_id, r.hits) for r in kept] == [(2, 1)]


def test_kept_columns_of_any_name(spark):
    bench = spark.createDataFrame([(1, "one two three"), (2, "nothing of that")], "item_id long, text string")
    docs = edge(spark)
    for size in (32 << 20, 20):
        got = decontaminate.scan(docs, bench, block_bytes=size)
        rows = got.collect()
        assert set(docs.columns) <= set(got.columns) and {(r["_text"], r["_row"], r["c0"]) for r in rows} == {("x", "x", "x")}
        assert sorted(r.doc_id for r in rows if r["hits"]) == [3, 4]


def test_suffix_array_and_search():
    """Few words, long repeats: every suffix in order, every item suffix at its rank, matches and their places by brute force."""
    rng = random.Random(3)
    for words_, copies in ((2, 1), (3, 5), (40, 2)):
        text = [rng.randint(0, words_) for _ in range(rng.randint(50, 300))] * copies
        items = [" ".join(f"w{rng.randint(1, words_)}" for _ in range(rng.choice([1, 3, 12, 30]))) for _ in range(12)]
        items += [" ".join(f"w{x}" for x in text[20:45] if x)]
        s = decontaminate.suite([(str(i), x) for i, x in enumerate(items)], 10)
        docs = [np.array([s.vocabulary.get(b"w%d" % x, 0) for x in d], np.int64) for d in (text, text[10:60], [], text[:5])]
        ids, starts = decontaminate.joined(docs)
        a = decontaminate.SuffixArray.of(ids, s.bits)

        def tail(row, p):
            row = row.tolist()
            return row[p : row.index(0, p)]

        suffixes = [tail(a.ids, p) for p in a.places.tolist()]
        assert sorted(a.places.tolist()) == np.flatnonzero(ids).tolist() and suffixes == sorted(suffixes)
        rank, length = decontaminate.searched(a, s)
        for p, r, n in zip(s.array.places.tolist(), rank.tolist(), length.tolist(), strict=True):
            t = tail(s.array.ids, p)
            assert r == sum(x < t for x in suffixes)
            assert n == max(next((i for i, (u, v) in enumerate(zip(x, t)) if u != v), min(len(x), len(t))) for x in suffixes)
        got = {(n, w): set() for n, (slots, *_) in s.windows.items() for w in range(len(slots))}
        for p, n, w in zip(*(x.tolist() for x in decontaminate.occurrences(a, s, rank, length)), strict=True):
            got[n, w].add(p)
        for (n, w), at in got.items():
            window = tail(s.array.ids, s.array.places[s.windows[n][0][w]])[:n]
            assert at == {p for p in range(len(ids)) if ids[p : p + n].tolist() == window}
