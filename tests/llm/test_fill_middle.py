import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rainspark.llm import fill_middle, queries
from tests.llm.helpers import SF, edge, nothing, table


def brute(doc, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    digest = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_against_brute_force(spark):
    docs = {r.doc_id: r.text for r in table(spark, "documents").collect()}
    rows = queries.op11_fill_in_middle(spark, SF).collect()
    assert len(rows) == len(docs) and {r.form for r in rows} == {"plain", "psm", "spm"}
    for r in rows:
        n, form, pre, mid, out = brute(r.doc_id, docs[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256) == (n, form, pre, mid, sha(out))
        assert r.restored_sha256 == sha(docs[r.doc_id] or "")


def check(spark, docs, **more):
    got = fill_middle.rearrange_texts(docs, **more)
    got = got.select("*", fill_middle.restored(F.col("output"), F.col("form")).alias("back")).collect()
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, []).append(r.text)
    for r in got:
        made = [brute(r.doc_id, t) for t in texts[r.doc_id]]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) in made
        assert r.back in [t or "" for t in texts[r.doc_id]]
    return got


@pytest.mark.parametrize("piece", [4 << 20, 50])
def test_edges(spark, piece):
    assert len(check(spark, edge(spark), piece_bytes=piece)) == 10
    assert check(spark, nothing(spark)) == []


def test_marks_in_texts_and_null_ids(spark):
    texts = ["<P>", "a<S>b", "x <M", "<<P", "P><", "<", "<S", "><M>", "😀é<", "", None, "́á", "aé" * 5000]
    rows = [(i if i % 5 else None, t) for i, t in enumerate(texts * 6)]
    got = check(spark, spark.createDataFrame(rows, "doc_id long, text string"))
    assert len(got) == len(rows)


def test_outputs_that_do_not_fit_are_null(spark):
    rows = [("<P>a<S>b<M>c", "psm"), ("<P>a<S>b<M>c", "spm"), ("<P>a<S>b", "psm"), ("<P>a<S>b<M>c<M>", "psm"), ("x<P>a<S>b<M>c", "psm"),
            ("<S>b<P>a<M>c", "spm"), ("abc", "plain"), ("abc", "other"), (None, "psm"), ("abc", None), ("<P><S><M>", "psm")]
    df = spark.createDataFrame(rows, "output string, form string").coalesce(1)
    got = [r[0] for r in df.select(fill_middle.restored(F.col("output"), F.col("form"))).collect()]
    assert got == ["acb", None, None, None, None, "acb", "abc", None, None, None, ""]


def test_marks_are_checked():
    for bad in [("<P>", "<P>", "<M>"), ("", "<S>", "<M>"), ("<P<", "<S>", "<M>"), ("<P>", "[S]", "<M>"), ("<P", "<P>", "<M>"), ("é", "<S>", "<M>")]:
        with pytest.raises(ValueError):
            fill_middle.Marks(*bad)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab<PSM>é😀 \n", max_size=12), min_size=1, max_size=6), st.randoms(use_true_random=False), st.integers(1, 9))
def test_scatter_and_gather_in_pieces(texts, random, piece):
    marks = fill_middle.Marks()
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    starts = np.cumsum([0] + [len(t.encode()) for t in texts])
    draws = np.array([[random.getrandbits(32) for _ in range(4)] for _ in texts], np.int64)
    out, out_starts, facts = fill_middle.rearrange(data, starts, draws, marks, 90, 20)
    back, back_starts, fits = fill_middle.put_back(out, out_starts, facts["form"], marks)
    assert fits.all() and back.tobytes() == data.tobytes() and back_starts.tolist() == starts.tolist()
    edges = np.sort(np.array([random.randrange(len(data) + 1) for _ in range(3)]))
    shifts = np.array([random.randrange(50) for _ in range(3)])
    whole = [x for _, p in fill_middle.displaced(edges, shifts, len(data), 1 << 20) for x in p.tolist()]
    assert whole == [x for _, p in fill_middle.displaced(edges, shifts, len(data), piece) for x in p.tolist()]
