"""Find benchmark passages in training documents through suffix arrays of the training shards."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainspark.llm.blobs import give_back
from rainspark.llm.common import bounded_batches, stage

#: Bytes that make words: digits, letters (upper case is lowered first) and all bytes of non-ASCII characters.
_FOLD = bytes(
    c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 0x20 if 0x41 <= c <= 0x5A else 0x20 for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


@dataclass
class SuffixArray:
    """All suffixes of a row of word numbers, in order; 0 stands for a word that no benchmark item has, and for an end.

    A suffix goes up to the next 0. ids = the numbers and some more zeros; places[i] = where the i-th suffix begins; keys[i]
    = its first words as one integer; equal suffixes stay in the order of their places.
    """

    ids: np.ndarray
    places: np.ndarray
    keys: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, bits: int) -> SuffixArray:
        """By doubling: ordered by the first words that fit into 62 bits, then by twice as many a round, where it is not yet settled."""
        depth = 62 // bits
        ids = np.concatenate([ids, np.zeros(max(depth, _STEP), ids.dtype)]).astype(np.int32)
        places = np.flatnonzero(ids)
        keys = np.zeros(len(places), np.int64)
        live = np.ones(len(places), bool)
        for k in range(depth):
            word = np.where(live, ids[places + k], 0)
            live = word > 0
            keys = keys << bits | word
        order = np.argsort(keys, kind="stable")
        places, keys, live = places[order], keys[order], live[order]
        begin, size = runs_of(keys)
        group = np.repeat(begin, size)
        rank = np.zeros(len(ids), np.int64)  # of the words so far, from 1; 0 at an end
        rank[places] = group + 1
        ends = np.flatnonzero(ids == 0)
        open_ = np.flatnonzero(np.repeat(size > 1, size) & live)
        while len(open_):
            then = group[open_] * (len(ids) + 1) + rank[places[open_] + depth]
            order = np.argsort(then, kind="stable")
            places[open_], then = places[open_[order]], then[order]
            begin, size = runs_of(then)
            group[open_] = np.repeat(open_[begin], size)
            rank[places[open_]] = group[open_] + 1
            depth *= 2
            open_ = open_[np.repeat(size > 1, size)]
            open_ = open_[ends[np.searchsorted(ends, places[open_])] - places[open_] >= depth]  # the others are equal to their ends
        return cls(ids, places, keys)


_STEP = 16
_ALL = np.iinfo(np.int64).max


def runs_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begin, size) of the runs of equal neighbours."""
    begin = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    return begin, np.diff(np.append(begin, len(values)))


def compared(x: np.ndarray, at: np.ndarray, y: np.ndarray, to: np.ndarray, depth: int = _ALL) -> tuple[np.ndarray, np.ndarray]:
    """Of the suffixes of x at `at` and of y at `to`: (words in common, up to depth; sign of the order within depth)."""
    common, sign = np.zeros(len(at), np.int64), np.zeros(len(at), np.int8)
    ahead = np.arange(_STEP)
    for begin in range(0, len(at), 1 << 15):  # so many rows that the words looked at stay a few megabytes
        live = np.arange(begin, min(begin + (1 << 15), len(at)))
        while len(live):
            n = common[live]
            a, b = x[(at[live] + n)[:, None] + ahead], y[(to[live] + n)[:, None] + ahead]
            stop = (a != b) | (a == 0) | (n[:, None] + ahead >= depth)
            ends = stop.any(1)
            first = np.where(ends, stop.argmax(1), _STEP)
            common[live] = n + first
            row, col = np.flatnonzero(ends), first[ends]
            sign[live[row]] = np.where(common[live[row]] < depth, np.sign(a[row, col] - b[row, col]), 0)
            live = live[~ends]
    return common, sign


def insertion(a: SuffixArray, s: SuffixArray, to: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int = _ALL, after: bool = False) -> np.ndarray:
    """Binary search for the suffixes of s at `to` between low and high: how many suffixes of a are less, by `depth` words; with
    `after` how many are less or equal."""
    low, high = low.copy(), high.copy()
    live = np.flatnonzero(low < high)
    while len(live):
        mid = (low[live] + high[live]) // 2
        sign = compared(a.ids, a.places[mid], s.ids, to[live], depth)[1]
        up = sign < (1 if after else 0)
        low[live[up]] = mid[up] + 1
        high[live[~up]] = mid[~up]
        live = live[low[live] < high[live]]
    return low


@dataclass
class Suite:
    """Benchmark items of one block: their words as numbers from 1, one after another, and their own suffix array.

    starts = where each item begins; windows[length] = distinct windows in order: the slot in the suffix array that
    stands for each, and where its places begin in `items` and `firsts` (item number and first word).
    """

    ids: list[str]
    vocabulary: dict[bytes, int]
    bits: int
    starts: np.ndarray
    array: SuffixArray
    windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def joined(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(numbers with a 0 after each row, where each row begins): no match goes over an end."""
    counts = np.array([len(x) for x in rows], np.int64)
    ids = np.concatenate([y for x in rows for y in (x, np.zeros(1, np.int64))]) if rows else np.zeros(0, np.int64)
    return ids, np.cumsum(counts + 1) - counts - 1


def suite(rows: list[tuple[str, str | None]], width: int) -> Suite:
    """An item of fewer words than `width` is one window; repeated items count once, and their order does not matter."""
    rows = sorted(set(rows), key=lambda x: (x[0], x[1] or ""))
    vocabulary: dict[bytes, int] = {}
    items = [np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(t)], np.int64) for _, t in rows]
    bits = max(len(vocabulary).bit_length(), 1)
    ids, starts = joined(items)
    array = SuffixArray.of(ids, bits)
    slot = np.zeros(len(ids), np.int64)
    slot[array.places] = np.arange(len(array.places))
    found: dict[int, list[np.ndarray]] = {}
    for item, start in zip(items, starts.tolist(), strict=True):
        if len(item):
            n = min(width, len(item))
            found.setdefault(n, []).append(start + np.arange(len(item) - n + 1))
    windows = {}
    for n, got in found.items():
        slots = np.sort(slot[np.concatenate(got)])
        at = array.places[slots]
        same = compared(array.ids, at[1:], array.ids, at[:-1], n)[0] >= n
        begin = np.flatnonzero(np.concatenate([[True], ~same]))
        item = np.searchsorted(starts, at, "right") - 1
        windows[n] = (slots[begin], np.append(begin, len(slots)), item, at - starts[item])
    return Suite([i for i, _ in rows], vocabulary, bits, starts, array, windows)


def searched(a: SuffixArray, s: Suite) -> tuple[np.ndarray, np.ndarray]:
    """Binary search of every suffix of every item in a shard's suffix array: (its rank there, words of its longest match)."""
    t = s.array
    low = np.searchsorted(a.keys, t.keys, "left")
    high = np.where(t.keys & ((1 << s.bits) - 1), np.searchsorted(a.keys, t.keys, "right"), low)  # the key is the whole suffix
    rank = insertion(a, t, t.places, low, high)
    length = np.zeros(len(rank), np.int64)
    for side in (rank - 1, rank):  # the longest match is next to it
        rows = np.flatnonzero((side >= 0) & (side < len(a.places)))
        length[rows] = np.maximum(length[rows], compared(a.ids, a.places[side[rows]], t.ids, t.places[rows])[0])
    return rank, length


def occurrences(a: SuffixArray, s: Suite, rank: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, length, distinct window) of every window that occurs in a shard: those whose suffix has a match of a window's
    words or more, at all suffixes around its rank that share them."""
    out = [(np.zeros(0, np.int64),) * 3]
    for width, (slots, *_) in s.windows.items():
        which = np.flatnonzero(length[slots] >= width)
        to, at = s.array.places[slots[which]], rank[slots[which]]
        low = insertion(a, s.array, to, np.zeros_like(at), at, width)
        high = insertion(a, s.array, to, at, np.full_like(at, len(a.places)), width, after=True)
        count = high - low
        rows = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
        out.append((a.places[rows], np.full(len(rows), width), np.repeat(which, count)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def longest_runs(a: SuffixArray, starts: np.ndarray, s: Suite, rank: np.ndarray, width: int) -> list[dict | None]:
    """Of each document the first of its longest runs of words that stand in an item, of up to `width` words.

    The item suffixes next to a suffix of the shard, before and after it, share the most words with it; which they are follows
    from the ranks and depends on that suffix and the items alone.
    """
    after = np.cumsum(np.bincount(rank, minlength=len(a.places) + 1))[: len(a.places)]
    best = np.zeros(len(a.ids), np.int64)  # by place
    near = np.zeros(len(a.ids), np.int64)
    for side in (after - 1, after):
        rows = np.flatnonzero((side >= 0) & (side < len(rank)))
        at, to = a.places[rows], s.array.places[side[rows]]
        n = compared(a.ids, at, s.array.ids, to, width)[0]
        more = n > best[at]
        best[at[more]], near[at[more]] = n[more], to[more]
    out: list[dict | None] = [None] * len(starts)
    if len(starts):
        most = np.maximum.reduceat(best, starts)
        owner = np.searchsorted(starts, np.arange(len(best)), "right") - 1
        first = np.flatnonzero((best > 0) & (best == most[owner]))
        docs, begin = np.unique(owner[first], return_index=True)
        at = first[begin]
        item = np.searchsorted(s.starts, near[at], "right") - 1
        for d, p, k, f in zip(docs.tolist(), (at - starts[docs]).tolist(), item.tolist(), (near[at] - s.starts[item]).tolist(), strict=True):
            out[d] = {"item_id": s.ids[k], "doc_word": p, "item_word": f, "length": int(most[d])}
    return out


def places(s: Suite, width: np.ndarray, window: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, item, item's word) of all benchmark places of the windows in these rows."""
    out = [(np.zeros(0, np.int64),) * 3]
    for n in np.unique(width).tolist():
        _, begin, items, firsts = s.windows[n]
        rows = np.flatnonzero(width == n)
        count = begin[window[rows] + 1] - begin[window[rows]]
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begin[window[rows]], count)
        out.append((np.repeat(rows, count), items[at], firsts[at]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def longest(starts: np.ndarray, s: Suite, at: np.ndarray, width: np.ndarray, window: np.ndarray) -> dict[int, list[dict]]:
    """Of each document and item the longest verbatim match: the windows that follow one another on both sides make it.

    Places of the suffix array and of the item with the same distance between them are one diagonal; a run of
    neighbouring windows on it is a match of their number less one plus a window's words. Of equally long ones the first stays.
    """
    row, item, first = places(s, width, window)
    if not len(row):
        return {}
    place, words = at[row], width[row]
    doc = np.searchsorted(starts, place, "right") - 1
    order = np.lexsort((place, place - first, item, doc))
    doc, item, first, place, words = (x[order] for x in (doc, item, first, place, words))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (place[1:] - first[1:] != place[:-1] - first[:-1]) | (place[1:] != place[:-1] + 1)
    begin = np.flatnonzero(fresh)
    length = np.diff(np.append(begin, len(order))) - 1 + words[begin]
    best = np.lexsort((place[begin], -length, item[begin], doc[begin]))
    keep = np.ones(len(best), bool)
    d, k = doc[begin][best], item[begin][best]
    keep[1:] = (d[1:] != d[:-1]) | (k[1:] != k[:-1])
    out: dict[int, list[dict]] = {}
    for i in best[keep].tolist():
        j = begin[i]
        row_ = {"item_id": s.ids[item[j]], "doc_word": int(place[j] - starts[doc[j]]), "item_word": int(first[j]), "length": int(length[i])}
        out.setdefault(int(doc[j]), []).append(row_)
    return out


_MATCH = T.StructType(
    [T.StructField("item_id", T.StringType())] + [T.StructField(c, T.LongType()) for c in ("doc_word", "item_word", "length")]
)


def blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> list[DataFrame]:
    """The benchmark (id, text) cut by hash into tables of about block_bytes; its size is measured first."""
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // block_bytes) or 1
    part = F.pmod(F.xxhash64("id", "text"), F.lit(n))
    return [items.filter(part == k) for k in range(n)] if n > 1 else [items]


def load_suite(block: DataFrame, width: int) -> Broadcast:
    """One block, which is small by its cut, as a broadcast."""
    rows = [(r["id"], r["text"]) for r in block.toLocalIterator()]
    return block.sparkSession.sparkContext.broadcast(suite(rows, width))


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    columns: list[str] | None = None,
    width: int = 10,
    block_bytes: int = 16 << 20,
    with_matches: bool = True,
) -> DataFrame:
    """`columns` of docs with n_words, hits (first and last word of each covered run), items, matches (of each item with a
    window in the document the longest verbatim match and its places) and longest: the longest verbatim match with any
    item, however short, at its first place in the document, with one item that holds it; null without a word in common.

    Every few megabytes of documents are a shard with one suffix array of all its words, in which every suffix of every item is
    searched; a shard never sees another's rows, and no row is shuffled. Without with_matches the last two are empty. A benchmark of up to block_bytes, which is measured, is broadcast. A larger one passes by in blocks,
    one in memory at a time: the documents are written once to the shared folder, each block's hits and matches are written too,
    and they are joined to the documents at the end. Nulls: a null text has no words;
    a null item id is named by the empty string. Repeated rows are marked one by one, repeated items count once.
    An empty benchmark marks nothing. A column of docs with the name of a result is replaced.
    """
    named = ["n_words", "hits", "items", "matches", "longest"]
    keep = [c for c in (columns or docs.columns) if c not in named]
    bounded_batches(docs.sparkSession)
    own = [f"c{i}" for i in range(len(keep))]  # own names can't clash
    rows = docs.select(
        F.col(text_col).alias("_text"),
        *(F.col(c).alias(o) for c, o in zip(keep, own, strict=True)),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<long>").alias("hits"),
        F.array().cast("array<string>").alias("items"),
        F.array().cast(T.ArrayType(_MATCH)).alias("matches"),
        F.lit(None).cast(_MATCH).alias("longest"),
    )
    parts = blocks(benchmark, item_col, item_text_col, block_bytes)
    names = [*own, *named]
    if len(parts) == 1:
        got = rows.mapInArrow(_marker(load_suite(parts[0], width), names, width, with_matches), T.StructType([rows.schema[c] for c in names]))
        return got.toDF(*keep, *named)
    plain = stage(rows.withColumn("_row", F.monotonically_increasing_id()), "documents")
    found = []
    for part in parts:
        step = load_suite(part, width)
        marked = plain.select("_text", "_row", *named).mapInArrow(
            _marker(step, ["_row", *named], width, with_matches), T.StructType([plain.schema[c] for c in ("_row", *named)])
        )
        found.append(stage(marked.filter((F.size("hits") > 0) | F.col("longest").isNotNull() | F.lit(part is parts[0])), "hits"))
        step.destroy()
    every = reduce(DataFrame.unionByName, found).groupBy("_row")
    every = every.agg(
        F.max("n_words").alias("n_words"),
        *(F.flatten(F.collect_list(c)).alias(c) for c in ("hits", "items", "matches")),
        F.max_by("longest", F.when(F.col("longest").isNotNull(), F.struct("longest.length", -F.col("longest.doc_word"), "longest.item_id"))).alias("longest"),
    )
    return plain.drop(*named, "_text").join(every, "_row").select(*names).toDF(*keep, *named)


def shards(batches: Iterator[pa.RecordBatch], size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Batches put together to about `size` bytes of text (the first column), or what is left at the end."""
    held: list[pa.RecordBatch] = []
    total = 0
    for batch in batches:
        held.append(batch)
        total += batch.column(0).nbytes
        if total >= size:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, total = [], 0
    if sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _marker(step: Broadcast, names: list[str], width: int, with_matches: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = step.value
        get = s.vocabulary.get
        for batch in shards(batches):
            coded = [np.array([get(w, 0) for w in words_of(t)], np.int64) for t in batch.column(0).to_pylist()]
            ids, starts = joined(coded)
            array = SuffixArray.of(ids, s.bits)
            rank, common = searched(array, s)
            at, size, window = occurrences(array, s, rank, common)
            out = {c: batch.column(c) for c in names}
            out["n_words"] = pa.array([len(x) for x in coded], pa.int64())
            edges = np.zeros(len(ids) + 1, np.int64)
            np.add.at(edges, at, 1)
            np.add.at(edges, at + size, -1)
            hit = np.diff(np.concatenate([[0], (np.cumsum(edges) > 0).astype(np.int8)]))
            runs = np.stack([np.flatnonzero(hit == 1), np.flatnonzero(hit == -1) - 1], 1)
            hits = batch.column("hits").to_pylist()
            items = batch.column("items").to_pylist()
            matches = batch.column("matches").to_pylist()
            for d, (a, b) in zip((np.searchsorted(starts, runs[:, 0], "right") - 1).tolist(), runs.tolist(), strict=True):
                hits[d] = [*hits[d], a - int(starts[d]), b - int(starts[d])]
            owner = np.searchsorted(starts, at, "right") - 1
            seen, first_at = np.unique(np.stack([owner, size, window], 1), axis=0, return_index=True) if len(at) else (np.zeros((0, 3), np.int64), at)
            which, item, _ = places(s, seen[:, 1], seen[:, 2])  # each document and distinct window once
            for d, k in np.unique(np.stack([seen[which, 0], item], 1), axis=0).tolist():
                items[d] = [*items[d], s.ids[k]]
            if with_matches:
                best = longest_runs(array, starts, s, rank, width)
                for d, rows in longest(starts, s, at, size, window).items():
                    matches[d] = [*matches[d], *rows]
                    best[d] = max([best[d], *rows], key=lambda m: (m["length"], -m["doc_word"]))
                out["longest"] = pa.array(best, batch.schema.field("longest").type)
            out["hits"] = pa.array(hits, batch.schema.field("hits").type)
            out["items"] = pa.array(items, batch.schema.field("items").type)
            out["matches"] = pa.array(matches, batch.schema.field("matches").type)
            yield pa.RecordBatch.from_arrays([out[c] for c in names], names)
            give_back()

    return run


def n_hit():
    """Words inside any run of `hits`. Runs of several benchmark blocks may overlap, so their union is measured."""
    pair = F.transform(
        F.sequence(F.lit(0), (F.size("hits") / 2 - 1).cast("int")),
        lambda i: F.struct(F.get("hits", (2 * i).cast("int")).alias("a"), F.get("hits", (2 * i + 1).cast("int")).alias("b")),
    )
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("end"))

    def add(acc, p):
        fresh = F.greatest(p["b"] - F.greatest(p["a"] - 1, acc["end"]), F.lit(0).cast("long"))
        return F.struct((acc["n"] + fresh).alias("n"), F.greatest(acc["end"], p["b"]).alias("end"))

    return F.when(F.size("hits") == 0, F.lit(0).cast("long")).otherwise(F.aggregate(F.array_sort(pair), start, add)["n"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents without a hit, with their own columns (whatever these are called)."""
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    text = plain.columns[docs.columns.index(text_col)]
    marked = scan(plain, benchmark, text_col=text, columns=plain.columns, with_matches=False, **options)
    return marked.filter(F.size("hits") == 0).select(*plain.columns).toDF(*docs.columns)
