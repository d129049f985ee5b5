"""Ranked lexical search: exact top documents of every query, through posting lists cut into blocks of similar documents."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rainspark.llm.blobs import dump_small, give_back, load
from rainspark.llm.common import bounded_batches, discard, partitions, stage
from rainspark.llm.decontaminate import blocks, words_of

#: Parts of a score: SCALE * tf div (TF * tf + NORM * m). Fixed by the ranking formula, like the 25 of norms().
SCALE, TF, NORM = 1_000_000_000, 1000, 12


def norms(n: np.ndarray, rows: int, terms: int) -> np.ndarray:
    """m of documents with n terms each, in a corpus of `rows` documents with `terms` terms in all."""
    return 100 - 25 + (25 * n * rows) // max(terms, 1)


def weight(rows: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * rows + 2) / (2 * df + 1)))


@dataclass
class Group:
    """Queries that share one matrix of documents: their numbers, its columns (terms), and each query's columns with how often it has them."""

    queries: list[int]
    columns: np.ndarray
    terms: list[np.ndarray]
    times: list[np.ndarray]


@dataclass
class Queries:
    """One block of queries: keys, the numbers of all their terms, and groups of queries with few terms in all."""

    keys: list[str]
    vocabulary: dict[bytes, int]
    groups: list[Group]

    def widest(self) -> int:
        return max((len(g.columns) for g in self.groups), default=1)


def read_queries(rows: list[tuple[str, str | None]], width: int) -> Queries:
    """Groups are filled in order, up to `width` terms; a query of more terms is a group of its own."""
    vocabulary: dict[bytes, int] = {}
    counted = []
    for _, text in rows:
        ids = np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words_of(text)], np.int64)
        counted.append(np.unique(ids, return_counts=True))
    groups: list[Group] = []
    held: list[int] = []
    columns = np.zeros(0, np.int64)
    for q, (ids, _) in enumerate(counted):
        both = np.union1d(columns, ids)
        if held and len(both) > width:
            groups.append(_group(held, columns, counted))
            held, both = [], ids
        held, columns = [*held, q], both
    if held:
        groups.append(_group(held, columns, counted))
    return Queries([key for key, _ in rows], vocabulary, groups)


def _group(held: list[int], columns: np.ndarray, counted: list[tuple[np.ndarray, np.ndarray]]) -> Group:
    return Group(held, columns, [np.searchsorted(columns, counted[q][0]) for q in held], [counted[q][1] for q in held])


@dataclass
class Shard:
    """Documents as rows of a matrix of impacts: parts[d, t] is what term t gives document d, without the term's weight."""

    parts: np.ndarray
    weights: np.ndarray
    block: int
    lists: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.peak = self.parts.max(0)
        self.sketch = sketches(self.parts, self.weights)

    def blocked(self, term: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The posting list of a term: documents in order of block, where blocks begin, and the summary of each.

        Documents spread over the list are centres, and every other one joins the centre most like it. A summary has the
        largest part of every coordinate in its block. Blocks are built when a query first opens the list.
        """
        if term not in self.lists:
            docs = np.flatnonzero(self.parts[:, term])
            centres = docs[:: self.block]
            nearest = (self.sketch[docs] @ self.sketch[centres].T).argmax(1) if len(centres) > 1 else np.zeros(len(docs), np.int64)
            order = np.argsort(nearest, kind="stable")
            begin = np.flatnonzero(np.diff(nearest[order], prepend=-1))
            summary = np.maximum.reduceat(self.parts[docs[order]], begin, axis=0)
            self.lists[term] = (docs[order], np.append(begin, len(docs)), summary)
        return self.lists[term]


def sketches(parts: np.ndarray, weights: np.ndarray, width: int = 32) -> np.ndarray:
    """Directions of the documents' vectors in fewer dimensions, by signs that follow from the coordinate alone."""
    signs = np.random.default_rng(1).choice(np.array([-1.0, 1.0], np.float32), (parts.shape[1], width))
    out = (parts * weights.astype(np.float32)) @ signs
    return out / np.maximum(np.sqrt((out * out).sum(1, keepdims=True)), 1e-9)


@dataclass
class Top:
    """The best `k` so far of one query over the shards of a task: scores and documents, best first."""

    k: int
    scores: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    docs: list = field(default_factory=list)

    def limit(self) -> int:
        """What a document must reach to be among the best; equal scores still count, as the smaller name wins."""
        return int(self.scores[-1]) if len(self.scores) >= self.k else 1

    def add(self, scores: np.ndarray, docs: list) -> None:
        order = sorted(zip([-s for s in self.scores.tolist()] + [-s for s in scores.tolist()], self.docs + docs, strict=True), key=lambda x: (x[0], _rank(x[1])))
        self.scores = np.array([-s for s, _ in order[: self.k]], np.int64)
        self.docs = [d for _, d in order[: self.k]]


def _rank(name) -> tuple:
    return (name is None, name if name is not None else 0)


def exact_sums(parts: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Products of rows with factors. Doubles are exact as long as no sum reaches 2**53, which is checked."""
    if len(factors) == 0:
        return np.zeros(len(parts), np.int64)
    if float(factors.sum()) * (SCALE // TF) < 2.0**53:
        return (parts.astype(np.float64) @ factors.astype(np.float64)).astype(np.int64)
    return (parts.astype(np.int64) * factors).sum(1)


def search_shard(shard: Shard, names: list, terms: np.ndarray, times: np.ndarray, top: Top) -> tuple[int, int]:
    """Bring one query's best up to date with a shard; (blocks met, blocks skipped).

    Lists are opened from the term that can add most. A document not met yet has only terms of the lists to come, so the
    search ends when these together can't reach the limit. In an open list a block is skipped if and only if its summary,
    counted for the terms to come, can't reach it.
    """
    factor = times * shard.weights[terms]
    most = factor * shard.peak[terms]
    order = np.argsort(-most, kind="stable")[: np.count_nonzero(most)]
    terms, factor = terms[order], factor[order]
    rest = np.cumsum(most[order][::-1])[::-1]
    seen = np.zeros(len(shard.parts), bool)
    met = skipped = 0
    for i, term in enumerate(terms.tolist()):
        if rest[i] < top.limit():
            break
        docs, begin, summary = shard.blocked(term)
        reach = exact_sums(summary[:, terms[i:]], factor[i:])
        keep = reach >= top.limit()
        met += len(keep)
        skipped += int((~keep).sum())
        for b in np.flatnonzero(keep)[np.argsort(-reach[keep], kind="stable")].tolist():
            if reach[b] < top.limit():  # the limit rose since
                skipped += 1
                continue
            inside = docs[begin[b] : begin[b + 1]]
            inside = inside[~seen[inside]]
            seen[inside] = True
            if len(inside):
                scores = exact_sums(shard.parts[inside][:, terms], factor)
                good = np.flatnonzero(scores >= top.limit())
                if len(good):
                    top.add(scores[good], [names[d] for d in inside[good].tolist()])
    return met, skipped


def count_terms(docs: DataFrame, queries: Queries, cells: int) -> DataFrame:
    """Postings of the documents for the terms of the queries: rows of names, n, and (document, term, tf) as packed arrays.

    A row holds as many documents as make a matrix of `cells` numbers; a document without any of the terms counts for N and
    L alone and leaves no name. `rows` and `terms` are what a row adds to N and L.
    """
    held = docs.sparkSession.sparkContext.broadcast(queries.vocabulary)
    most = max(1, cells // queries.widest())
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = held.value.get
        names: list = []
        n: list[int] = []
        ids: list[np.ndarray] = []
        tf: list[np.ndarray] = []
        rows = total = 0

        def packed() -> pa.RecordBatch:
            none = [np.zeros(0, np.int64)]
            lengths = np.array([len(x) for x in ids], np.int64)
            arrays = [np.array(n, np.int64), lengths, np.concatenate(ids or none), np.concatenate(tf or none)]
            return pa.RecordBatch.from_arrays(
                [pa.array([names], pa.list_(name_type)), *(pa.array([dump_small(a)], pa.binary()) for a in arrays), pa.array([rows]), pa.array([total])],
                ["names", "n", "lengths", "ids", "tf", "rows", "terms"],
            )

        name_type = pa.int64()
        for batch in batches:
            name_type = batch.column(0).type
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(text)
                if not words:
                    continue
                rows += 1
                total += len(words)
                found = [i for i in map(get, words) if i is not None]
                if found:
                    got, count = np.unique(np.array(found, np.int64), return_counts=True)
                    names.append(name)
                    n.append(len(words))
                    ids.append(got)
                    tf.append(count)
                if len(names) >= most:
                    yield packed()
                    names, n, ids, tf, rows, total = [], [], [], [], 0, 0
        if rows:
            yield packed()
        give_back()

    fields = f"names array<{kind}>, n binary, lengths binary, ids binary, tf binary, rows bigint, terms bigint"
    return docs.select("doc_id", "text").mapInArrow(run, fields)


def document_frequencies(counted: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each of `size` terms: summed in each task, then over the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            for ids in batch.column(0).to_pylist():
                df += np.bincount(load(ids), minlength=size)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(df[at])], ["term", "df"])

    out = np.zeros(size, np.int64)
    sums = counted.select("ids").mapInArrow(run, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df"))
    for r in sums.collect():  # one row for each term of the queries
        out[r["term"]] = r["df"]
    return out


def rank(
    docs: DataFrame,
    queries: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    query_col: str = "item_id",
    query_text_col: str = "text",
    k: int = 20,
    block: int = 32,
    cells: int = 8 << 20,
    width: int = 4096,
    query_bytes: int = 4 << 20,
) -> DataFrame:
    """item_id (in its own type), rank, doc_id and score of the k best documents of every query with a score above 0.

    Documents are counted once for the terms of all queries of a block and written as shards. Each task searches its shards
    one after another and keeps the best k of every query, whose worst is the limit that blocks of later shards must reach;
    so every block is decided by an exact bound, and no candidate is lost. The best of all tasks are ranked in two steps.

    Queries of more than query_bytes, which is measured, pass by in blocks, one in memory at a time. A block's terms and
    their document frequencies are broadcast. Inside a task queries go in groups of `width` terms, and a shard has as many
    documents as make a matrix of `cells` numbers. Nulls: a null text has no terms, a null document id comes after all
    others. Rows with equal ids are ranked one by one; repeated queries (same id and text) count once, and texts of one
    query id share its ranks. Empty tables give no rows; other columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    named = queries.select(F.col(query_col).alias("item_id"), F.col(query_text_col).alias("text")).distinct()
    named = stage(named.withColumn("key", F.sha2(F.concat(F.coalesce(F.col("item_id").cast("string"), F.lit("")), F.lit("\n"), F.coalesce("text", F.lit(""))), 256)), "queries")
    found = None
    for part in blocks(named.select("key", "text"), "key", "text", query_bytes):
        block_of = read_queries([(r["id"], r["text"]) for r in part.toLocalIterator()], width)
        got = stage(_search_block(rows, block_of, k, block, cells), "best")
        found = got if found is None else found.unionByName(got)
    best = found.join(named.select("key", "item_id"), "key").drop("key")
    return _best(best, ["item_id"], k, "rank").select("item_id", "rank", "doc_id", "score")


def _best(found: DataFrame, by: list[str], k: int, name: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn(name, F.row_number().over(order)).filter(F.col(name) <= k)


def _search_block(rows: DataFrame, queries: Queries, k: int, block: int, cells: int) -> DataFrame:
    """The k best of every query of the block, by key."""
    spark = rows.sparkSession
    counted = stage(count_terms(rows, queries, cells), "postings")
    sums = counted.agg(F.sum("rows").alias("rows"), F.sum("terms").alias("terms")).first()
    n_rows, n_terms = int(sums["rows"] or 0), int(sums["terms"] or 0)
    df = document_frequencies(counted, len(queries.vocabulary))
    weights = np.array([weight(n_rows, d) for d in df.tolist()], np.int64)
    held = spark.sparkContext.broadcast((queries.keys, queries.groups, weights))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, groups, weights = held.value
        tops = [Top(k) for _ in keys]
        name_type = pa.int64()
        for batch in batches:
            name_type = batch.schema.field("names").type.value_type
            for i in range(batch.num_rows):
                names = batch.column("names")[i].as_py()
                n, lengths, ids, tf = (load(batch.column(c)[i].as_py()).astype(np.int64) for c in ("n", "lengths", "ids", "tf"))
                if not len(names):
                    continue
                m = np.repeat(norms(n, n_rows, n_terms), lengths)
                doc, part = np.repeat(np.arange(len(names)), lengths), SCALE * tf // (TF * tf + NORM * m)
                for g in groups:
                    column = np.full(len(weights), -1)
                    column[g.columns] = np.arange(len(g.columns))
                    inside = column[ids] >= 0
                    parts = np.zeros((len(names), len(g.columns)), np.int32)
                    parts[doc[inside], column[ids[inside]]] = part[inside]
                    shard = Shard(parts, weights[g.columns], block)
                    for q, terms, times in zip(g.queries, g.terms, g.times, strict=True):
                        search_shard(shard, names, terms, times, tops[q])
                    give_back()
        out = [(key, d, int(s)) for key, top in zip(keys, tops, strict=True) for s, d in zip(top.scores, top.docs, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], name_type), pa.array([x[2] for x in out], pa.int64())], ["key", "doc_id", "score"]
        )

    got = counted.select("names", "n", "lengths", "ids", "tf").mapInArrow(run, f"key string, doc_id {kind}, score bigint")
    salted = got.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(partitions(spark))))
    best = stage(_best(salted, ["key", "salt"], k, "r").drop("salt", "r"), "candidates")
    discard(counted)
    return _best(best, ["key"], k, "r").drop("r")
