import re
from collections import Counter

from rainspark.llm import quality, queries
from tests.llm.helpers import SF, edge, nothing, table


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    many = Counter(windows)
    inside = {j for i, w in enumerate(windows) if many[w] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside), failed)


def same(rows, texts):
    for r in rows:
        got = tuple(r[c] for c in (*quality.BASE_FIELDS, "base_failed"))
        assert got in {brute(t) for t in texts[r.doc_id]}
        assert not (r.base_failed and r.kept)


def test_query_against_brute_force(spark):
    rows = queries.op6_quality_cascade(spark, SF).collect()
    texts = {r.doc_id: [r.text] for r in table(spark, "documents").collect()}
    assert len(rows) == len(texts)
    same(rows, texts)


def test_verdict_does_not_depend_on_the_order(spark):
    docs = table(spark, "documents")
    want = {r.doc_id: not brute(r.text)[5] and not any(x.rejects(quality.Text(r.text)) for x in quality.RULES) for r in docs.collect()}
    assert {r.doc_id: r.kept for r in queries.op6_quality_cascade(spark, SF).collect()} == want


def test_base_rules_stand_in_the_ranking_by_what_they_add(spark):
    """With the counts paid for, the dear rule on repeated words costs next to nothing; on its own it costs most."""
    docs = table(spark, "documents")
    every = (*quality.BASE_RULES, *quality.RULES)
    paid, alone = (quality.measure(docs, every, "text", 200, counted) for counted in (True, False))
    assert paid["too_repetitive"][0] < alone["too_repetitive"][0] / 5
    assert paid["too_repetitive"][0] < paid["too_few_letters"][0] and alone["too_repetitive"][0] > alone["too_few_words"][0]
    assert {r.name for r in quality.order_rules(every, paid)} == {r.name for r in every}


def test_sample_is_a_bound(spark):
    """A repeated id doesn't bring all its rows."""
    docs = spark.range(3000).selectExpr("1L as doc_id", "'a b c' as text")
    measured = quality.measure(docs, (quality.Rule("all", lambda t: True),), "text", 50, False)
    assert 0 < measured["all"][1] <= 1


def test_verdict_without_counts(spark):
    docs = table(spark, "documents")
    want = {r.doc_id: r.kept for r in quality.apply_rules(docs).collect()}
    rows = quality.apply_rules(docs, counts=False)
    assert rows.columns == ["doc_id", "kept"] and {r.doc_id: r.kept for r in rows.collect()} == want


def test_null_ids(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, None), (1, "x " * 30)], "doc_id long, text string")
    assert sorted((str(r.doc_id), r.n_words) for r in quality.apply_rules(docs).collect()) == [("1", 30), ("None", 0), ("None", 2)]


def test_order_of_rules():
    rules = quality.RULES[:3]
    measured = {rules[0].name: (1.0, 0.1), rules[1].name: (0.1, 0.1), rules[2].name: (0.01, 0.0)}
    assert quality.order_rules(rules, measured) == [rules[1], rules[0], rules[2]]


def test_edges(spark):
    rows = quality.apply_rules(edge(spark), columns=["doc_id", "kept", "lang"]).collect()
    assert len(rows) == 10
    texts = {}
    for r in edge(spark).collect():
        texts.setdefault(r.doc_id, []).append(r.text)
    same(rows, texts)
    assert quality.apply_rules(nothing(spark)).count() == 0


def test_wide_vocabulary_windows():
    words = [f"w{i}".encode() for i in range(9000)] + [b"w1", b"w2", b"w3", b"w4", b"w5"]
    assert quality.repeated_words(words, 5) == 10


def test_kept_columns_of_any_name(spark):
    docs = edge(spark)
    got = quality.apply_rules(docs, columns=docs.columns)
    assert set(docs.columns) - {"kept", "n_words"} < set(got.columns) and {r["_text"] for r in got.collect()} == {"x"}
