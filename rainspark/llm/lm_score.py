"""Score texts with a bigram model by deleted interpolation (Jelinek and Mercer, 1980).

Maximum-likelihood estimates of orders 2, 1 and 0 are mixed with weights that depend on how often the context was seen
(buckets by powers of two). The weights come from expectation-maximisation on a deleted section of the training
texts, with that section's counts taken out of the estimates.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainspark.llm.blobs import dump, dump_small, dump_sorted, give_back, load, load_sorted, range_cuts
from rainspark.llm.common import bounded_batches, mix64, new_path, partitions, texts

#: Local number and key of the end of a text, which is also the context of its first word.
END = 0
END_KEY = np.uint64(0x9E3779B97F4A7C15)
BUCKETS = 66

_BLOCK = "deleted boolean, doc_ids array<bigint>, held array<boolean>, sizes binary, words binary, ids binary"


def encode(docs: DataFrame, block_bytes: int) -> DataFrame:
    """Texts as numbered words, in blocks of about block_bytes of text, written once to the shared folder.

    docs: doc_id, text, held, deleted. A block holds deleted or other texts only. `words` are the 64-bit hashes of
    the block's distinct words; at V distinct words in all, two share a key with a probability of about V^2 / 2^65.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[bool, list] = {}

        def fresh() -> list:
            return [0, defaultdict(count(1).__next__), [], [], []]

        def close(deleted: bool) -> pa.RecordBatch:
            _, numbers, ids, held, arrays = open_.pop(deleted)
            keys = np.array([END_KEY, *map(xxhash.xxh3_64_intdigest, numbers)], np.uint64)
            sizes = np.array([len(a) for a in arrays], np.int64)
            columns = [[deleted], [ids], [held], [dump_small(sizes)], [dump(keys)], [dump(np.concatenate(arrays))]]
            kinds = [pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.bool_()), *[pa.binary()] * 3]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                ["deleted", "doc_ids", "held", "sizes", "words", "ids"],
            )

        for batch in batches:
            for doc, text, held, deleted in zip(*(batch.column(i) for i in range(4)), strict=True):
                deleted = deleted.as_py()
                if deleted not in open_:
                    open_[deleted] = fresh()
                now = open_[deleted]
                data = text.as_py().encode("utf-8", "surrogatepass")
                tokens = data.lower().split()
                ids = np.zeros(len(tokens) + 1, np.uint32)
                ids[:-1] = list(map(now[1].__getitem__, tokens))
                now[0] += len(data) + 64
                now[2].append(doc.as_py())
                now[3].append(held.as_py())
                now[4].append(ids)
                if now[0] >= block_bytes:
                    yield close(deleted)
        for deleted in list(open_):
            yield close(deleted)

    path = new_path(docs.sparkSession, "encoded")
    docs.mapInArrow(run, _BLOCK).withColumn("block", F.monotonically_increasing_id()).write.parquet(path)
    return docs.sparkSession.read.schema(_BLOCK + ", block long").parquet(path)


def bigrams(words: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct bigram keys, the bigram of every token, and every token's context."""
    before = np.concatenate([np.zeros(1, ids.dtype), ids[:-1]])
    scrambled = mix64(words)
    keys = mix64(scrambled[before] * np.uint64(3) + words[ids])
    distinct, which = np.unique(keys, return_inverse=True)
    return distinct, which, before


def _requests(ranges: int):
    """Each block's distinct keys with its training counts, as sorted runs by key range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words, ids, sizes = load(row["words"]), load(row["ids"]), load(row["sizes"])
                learn = np.repeat(~np.array(row["held"], bool), sizes)
                pairs, which, _ = bigrams(words, ids)
                order = np.argsort(words)
                runs = [
                    (words[order], np.bincount(ids[learn], minlength=len(words))[order]),
                    (pairs, np.bincount(which[learn], minlength=len(pairs))),
                ]
                cuts = [range_cuts(k, ranges) for k, _ in runs]
                for r in range(ranges):
                    piece = {"block": row["block"], "deleted": row["deleted"], "part": r}
                    if all(cut[r] == cut[r + 1] for cut in cuts):  # so there are never more rows than keys, however many ranges
                        continue
                    for n, ((keys, c), cut) in enumerate(zip(runs, cuts, strict=True)):
                        at = slice(cut[r], cut[r + 1])
                        piece |= {f"keys{n}": dump_sorted(keys[at]), f"counts{n}": dump_small(c[at])}
                    yield pa.RecordBatch.from_pylist([piece], schema=_REQUEST)
                give_back()

    return run


_REQUEST = pa.schema(
    [("block", pa.int64()), ("deleted", pa.bool_()), ("part", pa.int32())]
    + [(f"{x}{n}", pa.binary()) for n in range(2) for x in ("keys", "counts")]
)
_REQUEST_SQL = "block long, deleted boolean, part int, keys0 binary, counts0 binary, keys1 binary, counts1 binary"
_ANSWER = pa.schema(
    [("block", pa.int64()), ("deleted", pa.bool_()), ("part", pa.int32())]
    + [(f"{x}{n}", pa.binary()) for n in range(2) for x in ("all", "out")]
    + [("tokens", pa.int64()), ("tokens_out", pa.int64()), ("types", pa.int64())]
)
_ANSWER_SQL = (
    "block long, deleted boolean, part int, all0 binary, out0 binary, all1 binary, out1 binary, "
    "tokens long, tokens_out long, types long"
)


def _merge(table: pa.Table) -> pa.Table:
    """For a key range: every block's counts summed, and sent back to each block in the order of its own keys.

    `all` counts all training texts, `out` the deleted section. The first block's row carries the range's totals.
    """
    rows = table.to_pylist()
    out = [{k: r[k] for k in ("block", "deleted", "part")} | {"tokens": 0, "tokens_out": 0, "types": 0} for r in rows]
    for n in range(2):
        keys = [load_sorted(r[f"keys{n}"]) for r in rows]
        counts = [load(r[f"counts{n}"]).astype(np.int64) for r in rows]
        joined = np.concatenate(keys)
        distinct, which = np.unique(joined, return_inverse=True)
        weights = np.concatenate(counts)
        gone = np.concatenate([c * r["deleted"] for c, r in zip(counts, rows, strict=True)])
        total = np.bincount(which, weights, len(distinct)).astype(np.int64)
        deleted = np.bincount(which, gone, len(distinct)).astype(np.int64)
        at = 0
        for o, k in zip(out, keys, strict=True):
            own = which[at : at + len(k)]
            o |= {f"all{n}": dump_small(total[own]), f"out{n}": dump_small(deleted[own]) if o["deleted"] else None}
            at += len(k)
        if n == 0:
            out[0] |= {"tokens": int(total.sum()), "tokens_out": int(deleted.sum()), "types": int((total > 0).sum())}
    give_back()
    return pa.Table.from_pylist(out, schema=_ANSWER)


def _counts(row: dict, answers: pa.Table, name: str) -> tuple[np.ndarray, ...]:
    """A block's arrays: token ids, contexts, the bigram of each token, and counts by word and by bigram."""
    words, ids = load(row["words"]), load(row["ids"])
    pairs, which, before = bigrams(words, ids)
    parts = sorted(answers.select(["part", f"{name}0", f"{name}1"]).to_pylist(), key=lambda r: r["part"])
    by_key, by_pair = (np.concatenate([load(p[f"{name}{n}"]).astype(np.int64) for p in parts]) for n in range(2))
    by_word = np.empty(len(words), np.int64)
    by_word[np.argsort(words)] = by_key
    assert len(by_pair) == len(pairs)
    return ids, before, which, by_word, by_pair


def bucket_of(context: np.ndarray) -> np.ndarray:
    """0 for a context never seen, else 1 + floor(log2(count))."""
    return np.where(context > 0, np.frexp(context.astype(np.float64))[1], 0)


def fit_weights(evidence: DataFrame, rounds: int) -> np.ndarray:
    """Weights (bucket x order) by expectation-maximisation. A round is one pass over the deleted section's evidence;
    a row for each bucket comes to the driver."""
    weights = np.full((BUCKETS, 3), 1 / 3)

    def expect(lam: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((BUCKETS, 3))
            for batch in batches:
                for row in batch.to_pylist():
                    bucket, times = load(row["bucket"]).astype(np.int64), load(row["times"]).astype(np.float64)
                    parts = lam[bucket] * np.stack([load(row["p2"]), load(row["p1"]), load(row["p0"])], 1)
                    parts *= (times / parts.sum(1))[:, None]
                    for k in range(3):
                        sums[:, k] += np.bincount(bucket, parts[:, k], BUCKETS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(BUCKETS), pa.int64()), *(pa.array(sums[:, k]) for k in range(3))], ["bucket", "a", "b", "c"]
            )

        return run

    for _ in range(rounds):
        got = evidence.mapInArrow(expect(weights), "bucket long, a double, b double, c double")
        got = got.groupBy("bucket").agg(*(F.sum(c).alias(c) for c in "abc")).collect()
        for r in got:
            seen = np.array([r.a, r.b, r.c]) + 1e-3  # keeps every order possible
            weights[r.bucket] = seen / seen.sum()
    weights[0] = [0, weights[0, 1] / weights[0, 1:].sum(), weights[0, 2] / weights[0, 1:].sum()]
    return weights


def score(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sections: int = 7,
    held_out: int = 2,
    deleted: int = 3,
    rounds: int = 12,
    block_bytes: int = 8 << 20,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10 probability) of every row.

    A row's section is crc32(id as text) mod `sections`; the model never learns from section `held_out`, and takes
    its weights from section `deleted`. Counts go by key range: every block sends its distinct keys once, pre-counted,
    so a word that fills the corpus costs one entry for each block, and gets each key's counts back in the same order.

    Nulls: a null text is empty and has the end only; a null id counts as the empty text. Repeated rows count each
    time. If nothing is left to learn from, all estimates are uniform. An empty table gives no rows.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    part = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % sections
    rows = texts(docs, id_col, text_col).select("doc_id", "text", (part == held_out).alias("held"), (part == deleted).alias("deleted"))
    blocks = encode(rows, block_bytes)
    size = blocks.agg(F.sum(F.octet_length("ids")), F.count("*")).first()
    ranges = max(min(partitions(spark), 4 * (size[1] or 1)), (size[0] or 0) // (8 << 20), 1)
    path = new_path(spark, "counts")
    asked = blocks.mapInArrow(_requests(ranges), _REQUEST_SQL)
    asked.groupBy("part").applyInArrow(_merge, _ANSWER_SQL).write.parquet(path)
    answers = spark.read.schema(_ANSWER_SQL).parquet(path)
    got = answers.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", "tokens_out", "types"))).first()
    tokens, tokens_out, types = (int(x) for x in got)
    uniform = 1 / (types + 1)

    def estimates(ids, before, which, by_word, by_pair, n):
        context = by_word[before]
        p2 = by_pair[which] / np.maximum(context, 1)
        return bucket_of(context), p2, by_word[ids] / max(n, 1)

    def evidence(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            *_, a_word, a_pair = _counts(row, right, "all")
            ids, before, which, d_word, d_pair = _counts(row, right, "out")
            _, first, times = np.unique(which, return_index=True, return_counts=True)
            bucket, p2, p1 = estimates(ids[first], before[first], which[first], a_word - d_word, a_pair - d_pair, tokens - tokens_out)
            p0 = np.full(len(p1), uniform, np.float32)
            columns = {"p2": p2.astype(np.float32), "p1": p1.astype(np.float32), "p0": p0}
            out.append({k: dump(v) for k, v in columns.items()} | {"bucket": dump_small(bucket), "times": dump_small(times)})
        return pa.Table.from_pylist(out, schema=pa.schema([(c, pa.binary()) for c in ("bucket", "times", "p2", "p1", "p0")]))

    path = new_path(spark, "evidence")
    blocks.filter("deleted").groupBy("block").cogroup(answers.filter("deleted").groupBy("block")).applyInArrow(
        evidence, "bucket binary, times binary, p2 binary, p1 binary, p0 binary"
    ).write.parquet(path)
    weights = fit_weights(spark.read.parquet(path), rounds)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            ids, before, which, by_word, by_pair = _counts(row, right, "all")
            sizes = load(row["sizes"]).astype(np.int64)
            bucket, p2, p1 = estimates(ids, before, which, by_word, by_pair, tokens)
            lam = weights[bucket]
            p = np.log10(lam[:, 0] * p2 + lam[:, 1] * p1 + lam[:, 2] * uniform)
            base = np.log10((by_word[ids] + 1) / (tokens + types + 1))
            starts = np.cumsum(sizes) - sizes
            out.append(
                pa.table(
                    {
                        "doc_id": pa.array(row["doc_ids"], pa.int64()),
                        "held_out": pa.array(row["held"], pa.bool_()),
                        "n_tokens": sizes,
                        "n_known": np.add.reduceat((by_word[ids] > 0).astype(np.int64), starts),
                        "train_tokens": np.full(len(sizes), tokens, np.int64),
                        "base_score": np.add.reduceat(base, starts),
                        "score": np.add.reduceat(p, starts),
                    }
                )
            )
        give_back()
        return pa.concat_tables(out)

    return (
        blocks.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(
            finish,
            "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
        )
    )
