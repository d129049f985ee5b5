"""Pack tokenised documents into windows by non-negative least squares over the histogram of lengths."""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rainspark.llm.blobs import give_back
from rainspark.llm.common import bounded_batches, new_path, partitions, texts


@functools.cache
def _encoders(path: str, ranks_path: str, pattern: str):
    import tiktoken
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    special = [t.content for t in whole.get_added_tokens_decoder().values()]
    return whole, tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), special


@dataclass(frozen=True)
class Vocabulary:
    """A tokenizer file, and its vocabulary as ranks for a faster encoder that gives the same ids.

    The ids are those of `tokenizers` for `path`. The rank encoder stands in for it on texts without a special string,
    and each batch is compared with the tokenizer itself on one text; if they ever differ, the tokenizer does it all.
    """

    path: str
    ranks_path: str
    pattern: str

    def encode(self, texts_: list[str]) -> list[list[int]]:
        whole, fast, special = _encoders(self.path, self.ranks_path, self.pattern)
        probe = min(range(len(texts_)), key=lambda i: abs(len(texts_[i]) - 500), default=None)
        if probe is None:
            return []
        plain = whole.encode(texts_[probe], add_special_tokens=False).ids
        if not any(s in texts_[probe] for s in special) and fast.encode_ordinary(texts_[probe]) != plain:
            return [x.ids for x in whole.encode_batch(texts_, add_special_tokens=False)]
        return [
            whole.encode(t, add_special_tokens=False).ids if any(s in t for s in special) else fast.encode_ordinary(t)
            for t in texts_
        ]


def public_vocabulary() -> Vocabulary:
    import public_tokenizers as public

    return Vocabulary(public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN)


def combinations(window: int) -> np.ndarray:
    """All pairs and triples of lengths that fill the window, as rows of three (a pair has a zero)."""
    rows = [np.stack([np.zeros(window // 2, np.int64), np.arange(1, window // 2 + 1), window - np.arange(1, window // 2 + 1)], 1)]
    for a in range(1, window // 3 + 1):
        b = np.arange(a, (window - a) // 2 + 1)
        rows.append(np.stack([np.full(len(b), a), b, window - a - b], 1))
    return np.concatenate(rows)


def solve_counts(combos: np.ndarray, histogram: np.ndarray, rounds: int = 120) -> np.ndarray:
    """x >= 0 that minimises |A x - histogram|, column j of A counting the lengths in combination j.

    Accelerated projected gradient steps; the step size comes from a power iteration. Entry 0 of the histogram stands
    for the missing third member of a pair and has no weight.
    """
    size = len(histogram)
    target = histogram.astype(np.float64).copy()
    target[0] = 0

    def forward(x: np.ndarray) -> np.ndarray:
        y = sum(np.bincount(combos[:, c], x, size) for c in range(3))
        y[0] = 0
        return y

    def back(y: np.ndarray) -> np.ndarray:
        return y[combos].sum(1)

    v = np.ones(len(combos))
    for _ in range(8):
        w = back(forward(v))
        norm = np.linalg.norm(w)
        v = w / norm
    x = ahead = np.zeros(len(combos))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(ahead - back(forward(ahead) - target) / (1.05 * norm), 0)
        t, before = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        ahead, x = new + (before - 1) / t * (new - x), new
    return x


def round_counts(x: np.ndarray) -> np.ndarray:
    """Whole counts whose running sums stay within a half of those of x. A solution that is spread over very many
    combinations, each far below one, so keeps its total; rounding each for itself would leave nothing."""
    return np.diff(np.rint(np.cumsum(x)), prepend=0).astype(np.int64)


@dataclass
class Plan:
    """Where the k-th tail of each length goes. Its size depends on the window alone, not on the input.

    first[l] .. first[l + 1] are the entries of length l; entry e takes the tails of rank from[e] on, up to the next
    entry, into the sequences from sequence[e] on, at offset[e]. Ranks from used[l] on are residual: they form one
    stream that starts at residual[l] for each length and is cut into windows; its last window is cut into powers of two.
    solved and greedy are the numbers of whole windows from least squares and from the greedy pass.
    """

    window: int
    first: np.ndarray
    start: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    used: np.ndarray
    residual: np.ndarray
    residual_base: int
    residual_ends: list[int]
    full_base: int
    solved: int = 0
    greedy: int = 0


def make_plan(histogram: np.ndarray, window: int) -> Plan:
    """Solve, round, solve again for what is left while that fills a tenth of it, pack residuals greedily into exact
    windows, and lay out the rest as one stream to cut."""
    left = histogram.copy()
    left[0] = 0
    chosen: list[tuple[tuple[int, ...], int]] = []
    solved = 0

    def take(lengths: tuple[int, ...], most: int) -> None:
        need = {x: lengths.count(x) for x in lengths}
        n = min([most, *(int(left[x]) // c for x, c in need.items())])
        if n > 0:
            for x, c in need.items():
                left[x] -= n * c
            chosen.append((lengths, n))

    if left.sum() > 1:
        every = combinations(window)
        while True:
            before = int(left.sum())
            combos = every[((left[every] > 0) | (every == 0)).all(1)]
            if not len(combos):
                break
            x = round_counts(solve_counts(combos, left))
            order = np.flatnonzero(x)
            for j in order[np.argsort(-x[order], kind="stable")].tolist():
                take(tuple(c for c in combos[j].tolist() if c), int(x[j]))
            if 10 * (before - int(left.sum())) < before:
                break
        solved = sum(n for _, n in chosen)
        for a in range(window - 1, 0, -1):  # residuals: longest first, best whole fill
            if left[a] and left[window - a]:
                take((a, window - a), int(left[a]))
            while left[a]:
                b = np.arange(1, window - a)
                fit = b[(left[b] > 0) & (left[window - a - b] > 0) & (b <= window - a - b)]
                before = int(left[a])
                for c in fit[::-1].tolist():
                    take((a, c, window - a - c), int(left[a]))
                    if not left[a]:
                        break
                if left[a] == before:
                    break
    entries: dict[int, list[tuple[int, int, int]]] = {}
    used = np.zeros(window, np.int64)
    base = 0
    for lengths, n in chosen:
        at = 0
        for x in lengths:
            entries.setdefault(x, []).append((int(used[x]), base, at))
            used[x] += n
            at += x
        base += n
    flat = [e for x in range(window) for e in entries.get(x, [])]
    first = np.concatenate([[0], np.cumsum([len(entries.get(x, [])) for x in range(window)])])
    sizes = left * np.arange(window)
    residual = sizes[::-1].cumsum()[::-1] - sizes  # longest first
    total = int(sizes.sum())
    ends = [total // window * window]
    for bit in range(window.bit_length() - 1, -1, -1):
        if total % window >> bit & 1:
            ends.append(ends[-1] + (1 << bit))
    table = np.array(flat, np.int64).reshape(-1, 3)
    return Plan(
        window, first, table[:, 0], table[:, 1], table[:, 2], used, residual, base, ends, base + total // window + len(ends) - 1, solved, base - solved
    )


def place(plan: Plan, length: int, rank: int) -> list[tuple[int, int, int, int]]:
    """(start in the tail, length, sequence_id, offset) of the pieces of a tail."""
    if rank < plan.used[length]:
        a, b = plan.first[length], plan.first[length + 1]
        e = a + int(np.searchsorted(plan.start[a:b], rank, "right")) - 1
        return [(0, length, int(plan.sequence[e] + rank - plan.start[e]), int(plan.offset[e]))]
    at = int(plan.residual[length]) + (rank - int(plan.used[length])) * length
    whole, out, done = plan.residual_ends[0], [], 0
    while done < length:
        here = at + done
        if here < whole:
            n, begin = here // plan.window, here // plan.window * plan.window
            end = begin + plan.window
        else:
            k = next(i for i, e in enumerate(plan.residual_ends) if e > here)
            n, begin, end = whole // plan.window + k - 1, plan.residual_ends[k - 1], plan.residual_ends[k]
        size = min(length - done, end - here)
        out.append((done, size, plan.residual_base + n, here - begin))
        done += size
    return out


def pack(
    docs: DataFrame,
    vocabulary: Vocabulary,
    window: int = 2048,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset of every piece.

    A document's whole windows are sequences of their own; its tail (shorter than the window) is placed by the plan,
    which knows the histogram of tail lengths only (at most `window` rows come to the driver). Ranks within a length
    come from two levels (buckets within a length), so a length that a third of all rows share is spread out. Texts
    are tokenised once and written to the shared folder.

    Nulls: a null text is empty and has the end id only. Rows with equal or null ids are documents of their own. An
    empty table gives no rows. Other columns are ignored. Only sequences whose fill is a power of two or the window
    exist, so there is no padding.
    """
    spark = docs.sparkSession
    bounded_batches(spark)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                coded = [np.array([*ids, end_id], "<u4") for ids in vocabulary.encode(part.column(1).to_pylist())]
                n = pa.array([len(x) for x in coded], pa.int64())
                small = [(x.astype("<u2") if x.max() < 1 << 16 else x).tobytes() for x in coded]
                yield pa.RecordBatch.from_arrays([part.column(0), n, pa.array(small, pa.binary())], ["doc_id", "n", "packed"])
        give_back()

    path = new_path(spark, "tokens")
    coded = texts(docs, id_col, text_col).mapInArrow(encode, "doc_id long, n long, packed binary")
    coded.withColumn("row", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path)
    coded = spark.read.schema("doc_id long, n long, packed binary, row long").parquet(path)

    rows = coded.select(
        "row", (F.col("n") % window).alias("tail"), F.floor(F.col("n") / window).alias("full")
    ).withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(partitions(spark))))
    histogram = np.zeros(window, np.int64)
    for r in rows.groupBy("tail").count().collect():
        histogram[r["tail"]] = r["count"]
    plan = make_plan(histogram, window)

    sizes = rows.groupBy("tail", "bucket").agg(F.count("*").alias("c"))
    ahead = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "tail", "bucket", F.coalesce(F.sum("c").over(ahead.partitionBy("tail")), F.lit(0)).alias("tails_before")
    )
    fulls = rows.groupBy("bucket").agg(F.sum("full").alias("f"))
    fulls = fulls.select("bucket", F.coalesce(F.sum("f").over(ahead), F.lit(0)).alias("fulls_before"))
    in_bucket = Window.partitionBy("bucket").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    in_both = Window.partitionBy("bucket", "tail").orderBy("row")
    ranked = (
        rows.withColumn("f", F.coalesce(F.sum("full").over(in_bucket), F.lit(0)))
        .withColumn("k", F.row_number().over(in_both) - 1)
        .join(F.broadcast(fulls), "bucket")  # a row for each bucket
        .join(starts, ["bucket", "tail"])
        .select("row", (F.col("tails_before") + F.col("k")).alias("rank"), (F.col("fulls_before") + F.col("f")).alias("full_rank"))
    )
    known = spark.sparkContext.broadcast(plan)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = known.value
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                out: list[tuple] = []
                part = batch.slice(at, 500)
                for doc, n, packed, rank, full in zip(*(part.column(i).to_pylist() for i in range(5)), strict=True):
                    ids = np.frombuffer(packed, "<u4" if len(packed) == 4 * n else "<u2").astype("<u4")
                    whole = n // p.window * p.window
                    pieces = [(s, p.window, p.full_base + full + s // p.window, 0) for s in range(0, whole, p.window)]
                    if n > whole:
                        pieces += [(whole + s, *rest) for s, *rest in place(p, n - whole, rank)]
                    out += [(doc, s, size, ids[s : s + size].tobytes(), n, q, o) for s, size, q, o in pieces]
                kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3
                columns = zip(*out, strict=True) if out else [[]] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)
        give_back()

    joined = coded.join(ranked, "row").select("doc_id", "n", "packed", "rank", "full_rank")
    return joined.mapInArrow(
        cut, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    )
