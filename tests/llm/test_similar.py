import itertools
import random
import re

from rainspark.llm import similar
from tests.llm.helpers import DOCS, SF, edge, nothing, table


def shingles(text, k=5):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    k = min(k, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if words else frozenset()


def brute(docs):
    """doc_id -> least doc_id reachable over pairs of similarity 0.8 and more; texts without words are one group."""
    sets = {i: shingles(t) for i, t in docs.items()}
    parent = {i: i for i in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if sets[a] == sets[b] or 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {i: find(i) for i in docs}


def changed(rng, words, share):
    return [f"x{rng.random()}" if rng.random() < share else w for w in words]


def groups(spark, docs):
    rows = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs.items()], DOCS)
    return {r.doc_id: r.component_id for r in similar.similar_groups(rows).collect()}


def test_tables_against_brute_force(spark):
    docs = {r.doc_id: r.text for r in table(spark, "documents").collect()}
    assert groups(spark, docs) == brute(docs)


def test_near_copies_and_shared_passages(spark):
    """Groups of near copies are found, texts that share two thirds of their words in one passage stay apart."""
    rng = random.Random(5)
    docs = {}
    for _ in range(6):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([60, 300, 900]))]
        for _ in range(12):
            docs[len(docs)] = " ".join(changed(rng, base, 0.006))
    passage = [f"p{i}" for i in range(80)]
    for _ in range(40):
        docs[len(docs)] = " ".join(passage + [f"q{rng.randrange(10**9)}" for _ in range(40)])
    got, want = groups(spark, docs), brute(docs)
    assert got == want
    assert len(set(want.values())) < 90 and all(got[i] == i for i in range(72, 112))


def test_chain_of_edits_is_one_group(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(200)]
    docs = {}
    for i in range(30):
        docs[i] = " ".join(words)
        words[rng.randrange(200)] = f"n{i}"
    assert groups(spark, docs) == brute(docs) == dict.fromkeys(range(30), 0)


def test_edges(spark):
    rows = similar.similar_groups(edge(spark)).collect()
    assert len(rows) == 10
    by = {r.doc_id: r.component_id for r in rows}
    assert by[1] == by[2] == by[9] == 1 and by[4] == by[3] == 3 and by[6] == 6 and by[7] == 7
    assert similar.similar_groups(nothing(spark)).count() == 0


def planted(rng, share, n, size=45):
    """n isolated pairs, each of two sets of one-word shingles with a similarity of share or just above."""
    docs = {}
    for p in range(n):
        both = -(-2 * size * share // (1 + share))
        for side in "ab":
            words = [f"p{p}-{k}-{rng.random()}" if k >= both else f"p{p}-{k}" for k in range(size)]
            docs[len(docs)] = " ".join(words)
    return docs


def planted_links(spark, share, n, similarity):
    rng = random.Random(3)
    rows = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in planted(rng, share, n).items()], DOCS)
    got = {r.doc_id: r.component_id for r in similar.similar_groups(rows, words=1, similarity=similarity).collect()}
    return sum(got[2 * p + 1] == got[2 * p] == 2 * p for p in range(n)), len(set(got.values()))


def test_no_isolated_pair_at_the_limit_is_lost(spark):
    """Signatures of one in 24 pairs at 0.8 and of one in 50 at 0.82 are too far apart for the ring."""
    for share in (0.8, 0.82, 0.85):
        assert planted_links(spark, share, 150, 0.8) == (150, 150)


def test_similarity_sets_the_budget(spark):
    assert planted_links(spark, 0.7, 150, 0.7) == (150, 150)
    assert planted_links(spark, 0.7, 150, 0.75) == (0, 300)
    assert [similar.budget_of(x) for x in (0.7, 0.8, 0.9)] == [14, 10, 6]
    assert similar.chain_of(10) == 3 and 14 * similar.chain_of(14) < similar.POSITIONS


def test_large_group_below_and_at_the_limit(spark):
    """Copies with one to six edits each: many near each other, few linked; labels and bitmaps lose nothing."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(10**6)}" for _ in range(80)]
    docs = {}
    for i in range(260):
        words = list(base)
        for _ in range(rng.choice([1, 1, 2, 3, 6])):
            words[rng.randrange(80)] = f"n{rng.random()}"
        docs[i] = " ".join(words)
    want = brute(docs)
    assert groups(spark, docs) == want and 20 < len(set(want.values())) < 200
