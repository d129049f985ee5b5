import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rainspark.llm import packing, queries
from tests.llm.helpers import SF, edge, nothing, table

VOCABULARY = packing.public_vocabulary()


def check(pieces, docs, window):
    """docs: list of token id lists; pieces: rows with ids. Each id is in one piece; sequences have no gaps."""
    whole = Tokenizer.from_file(VOCABULARY.path)
    by_doc, by_seq = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_seq.setdefault(p.sequence_id, []).append(p)
        assert p.length > 0 and len(p.ids) == 4 * p.length
    for i, text in docs.items():
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 1]
        got = sorted(by_doc[i], key=lambda p: p.start)
        assert b"".join(bytes(p.ids) for p in got) == np.array(ids, "<u4").tobytes()
        at = 0
        for p in got:
            assert (p.start, p.doc_tokens) == (at, len(ids))
            at += p.length
    padding = 0
    for ps in by_seq.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding


def test_whole_table(spark):
    docs = table(spark, "documents")
    pieces = packing.pack(docs, VOCABULARY).collect()
    assert check(pieces, {r.doc_id: r.text for r in docs.collect()}, 2048) == 0
    rows = {(r.doc_id, r.start): r for r in queries.op2_nnls_packing(spark, SF).collect()}
    for p in pieces:
        assert rows[p.doc_id, p.start].ids_crc32 == zlib.crc32(bytes(p.ids))


def test_edges_and_special_strings(spark):
    extra = spark.createDataFrame([(20, "a<|endoftext|>b"), (21, "   \n\n x" * 50), (22, "é" * 3000)], "doc_id long, text string")
    docs = edge(spark).filter("doc_id <> 6").unionByName(extra, allowMissingColumns=True)
    pieces = packing.pack(docs, VOCABULARY, window=64).collect()
    assert check(pieces, {r.doc_id: r.text for r in docs.collect()}, 64) == 0
    twice = packing.pack(edge(spark).filter("doc_id = 6"), VOCABULARY, window=64)
    assert twice.agg(F.sum("length")).first()[0] == 2 * twice.first().doc_tokens
    assert packing.pack(nothing(spark), VOCABULARY).count() == 0


def test_rank_encoder_equals_the_tokenizer(spark):
    whole = Tokenizer.from_file(VOCABULARY.path)
    texts = [r.text or "" for r in table(spark, "documents").limit(100).collect()] + ["", " ", "\x00\x7f", "𝔘𝔫𝔦​", "1234567890" * 9]
    assert VOCABULARY.encode(texts) == [x.ids for x in whole.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("seed", range(4))
def test_plan_places_every_tail_once(seed):
    rng = np.random.default_rng(seed)
    window = 64
    histogram = np.bincount(rng.integers(0, window, rng.integers(1, 4000)), minlength=window)
    histogram[37] += 3000 * (seed == 3)
    plan = packing.make_plan(histogram, window)
    seen = {}
    for length in range(1, window):
        for rank in range(histogram[length]):
            pieces = packing.place(plan, length, rank)
            assert sum(p[1] for p in pieces) == length
            for _, size, seq, offset in pieces:
                seen.setdefault(seq, []).append((offset, size))
    for parts in seen.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= window and at & (at - 1) == 0
    assert max(seen, default=-1) < plan.full_base


def test_least_squares_is_solved():
    rng = np.random.default_rng(5)
    combos = packing.combinations(24)
    truth = rng.integers(0, 20, len(combos)) * (rng.random(len(combos)) < 0.2)
    histogram = np.zeros(24)
    for c, n in zip(combos, truth, strict=True):
        np.add.at(histogram, c, n)
    x = packing.solve_counts(combos, histogram, rounds=2000)
    made = np.zeros(24)
    for c, n in zip(combos, x, strict=True):
        np.add.at(made, c, n)
    assert (x >= 0).all() and abs(made[1:] - histogram[1:]).max() < 0.05 * histogram[1:].max()


def test_whole_fills_come_from_least_squares():
    """Rounding keeps the solution's total: nine of ten whole windows are its, whatever the size of the table."""
    for n in (2000, 10_000, 100_000):
        lengths = np.random.default_rng(n).lognormal(5.5, 1.2, n).astype(np.int64) % 2048
        plan = packing.make_plan(np.bincount(lengths, minlength=2048), 2048)
        assert plan.solved > 0.9 * (plan.solved + plan.greedy) > 0.05 * n


def test_running_sums_of_rounded_counts():
    x = np.random.default_rng(1).random(5000) * 0.02
    got = packing.round_counts(x)
    assert (got >= 0).all() and abs(np.cumsum(got) - np.cumsum(x)).max() <= 0.5 and got.sum() > 40


def test_null_ids_and_repeated_rows(spark):
    docs = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (5, None), (5, "d e")], "doc_id long, text string")
    pieces = packing.pack(docs, VOCABULARY, window=64).collect()
    assert sorted((str(p.doc_id), p.doc_tokens) for p in pieces if p.start == 0) == [("5", 1), ("5", 3), ("None", 4), ("None", 4)]
    assert sum(p.length for p in pieces) == 12
