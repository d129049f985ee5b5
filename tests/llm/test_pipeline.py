import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from rainspark.llm import decontaminate, quality, similar, simhash
from tests.llm.helpers import SF, edge, nothing, table
from tests.llm.test_decontaminate import brute as hits
from tests.llm.test_packing import check
from tests.llm.test_quality import brute as counts
from tests.llm.test_similar import brute as groups
from tests.llm.test_similar import shingles
from tests.llm.test_suffix_dedup import brute as repeats


def brute(rows, items):
    """The stages in plain Python: (doc_id, text) that are left to pack."""
    left = [(i, t) for i, t in rows if not counts(t)[5] and not any(r.rejects(quality.Text(t)) for r in quality.RULES)]
    group = groups(dict(left))
    left = [(i, t) for i, t in left if group[i] == i]
    cut = []
    for (i, t), (b, gone) in zip(left, repeats(left), strict=True):
        text = np.frombuffer(b, np.uint8)[~gone].tobytes().decode("utf-8", "ignore") if gone.any() else t
        if not gone.any() or text.strip(" "):
            cut.append((i, text))
    return [(i, t) for i, t in cut if hits(t, items)[1] == 0]


def test_pipeline_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, "documents").collect()]
    items = [(r.item_id, r.text) for r in table(spark, "benchmark").collect()]
    want = dict(brute(rows, items))
    pieces = corpus_pipeline.run(spark, SF).collect()
    assert {p.doc_id for p in pieces} == set(want) and 0 < len(want) < len(rows)
    assert check(pieces, want, 2048) == 0


def test_every_stage_takes_edge_cases(spark):
    docs = edge(spark).select("*", F.lit(1).alias("cuts"), F.lit(1).alias("row"))
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, docs, SF)
        if name != "packing":
            assert out.columns == corpus_pipeline.COLUMNS
        out.collect()
        assert step(spark, nothing(spark), SF).count() == 0


def test_clean_documents_stay(spark):
    text = " ".join(f"word{i} clean{i}" for i in range(60))
    docs = spark.createDataFrame([(i, text.replace("clean", f"tidy{i}x"), "en", "s", 1) for i in range(20)], docs_schema())
    out = corpus_pipeline.quality_rules(spark, docs, SF)
    assert sorted(r.doc_id for r in out.collect()) == list(range(20))
    assert corpus_pipeline.benchmark_leaks(spark, docs, SF).count() == 20
    assert decontaminate.words_of(text)[0] == b"word0"


def docs_schema():
    return "doc_id long, text string, lang string, source string, n_chars long"


def test_near_duplicates_come_from_fingerprints(spark, monkeypatch):
    """Without the searches that follow, links of fingerprints within four bits stand, if the sets are similar."""
    words = [f"w{i}" for i in range(4000)]
    texts = [" ".join(words), " ".join(w if i != 2000 else "other" for i, w in enumerate(words))]
    often = "so it goes " * 200
    texts += [often + "first end of many words that differ", often + "second finish with some few others instead"]
    texts += [" ".join(f"v{k}-{i}" for i in range(90)) for k in range(3)] + [" ".join(words)]
    fps = [simhash.fingerprint(t, 5) for t in texts]
    sets = [shingles(t) for t in texts]
    near = {(a, b) for b in range(len(texts)) for a in range(b) if (fps[a] ^ fps[b]).bit_count() <= 4}
    assert near == {(0, 1), (0, 7), (1, 7), (2, 3)} and len(sets[2] & sets[3]) < 0.8 * len(sets[2] | sets[3])
    none = spark.createDataFrame([], "a long, b long")
    for name in ("star_pairs", "open_pairs", "prefix_pairs"):
        monkeypatch.setattr(similar, name, lambda *_: none)
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], docs_schema())
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, SF).collect()) == [0, 2, 3, 4, 5, 6]


def test_tasks_of_repeated_passages_have_one_python_worker(spark):
    """A second one beside it (a UDF on the cut text) stays with the executor and keeps its memory."""
    once = "".join(chr(0x4E00 + i) for i in range(40))
    texts = [once, "first " + once[:30] + " last", "ab" + "\u00e9" * 40, "\u00e8" + "\u00e9" * 30 + "\u00ea tail", None, once[:20], once]
    docs = spark.createDataFrame([(i, t, "en", "s", 7) for i, t in enumerate(texts)], docs_schema())
    out = corpus_pipeline.passage_dedup(spark, docs, SF)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "ArrowEvalPython" not in plan
    want = {}
    for (i, t), (b, gone) in zip(enumerate(texts), repeats(list(enumerate(texts))), strict=True):
        left = np.frombuffer(b, np.uint8)[~gone].tobytes().decode("utf-8", "ignore")
        if not gone.any():
            want[i] = (t, 7)
        elif left.strip(" "):
            want[i] = (left, len(left))
    assert set(want) == {0, 1, 2, 3, 4} and want[1][0] != texts[1] and want[3][0] != texts[3]
    assert {r.doc_id: (r.text, r.n_chars) for r in out.collect()} == want
