"""Toxicity from the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index, votes, calibration."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rainspark.llm.blobs import give_back
from rainspark.llm.common import bounded_batches, discard, stage
from rainspark.llm.decontaminate import words_of

#: Similarities that differ by less than this count as equal.
DIGITS = 9


@dataclass(frozen=True)
class Settings:
    """Parameters of the model.

    examples: labelled rows used at most (by hash of the id), the bound of everything fitted; terms: terms kept at
    most; least_chi2, least_effect and least_rows: a term is kept only if its presence goes with the label that clearly, that
    strongly (chi-square by example, so that more examples don't let in ever weaker terms) and in so many examples; prefixes: beside a whole word its first 4 to 7 characters are terms, since compounds share them;
    rest: weight of the words that aren't terms, so that one term in a long text isn't a text full of them;
    neighbours: examples that vote; near: added to the distance 1 - cosine, whose inverse is the weight of a vote;
    block: examples in a block of the index.
    """

    examples: int = 20000
    terms: int = 1024
    least_chi2: float = 15.0
    least_effect: float = 0.004
    least_rows: int = 3
    prefixes: tuple[int, ...] = (4, 5, 6, 7)
    rest: float = 0.3
    neighbours: int = 15
    near: float = 0.02
    block: int = 32


def terms_of(word: bytes, prefixes: tuple[int, ...]) -> list[str]:
    """A word as a whole (ends in $) and its beginnings (end in *)."""
    text = word.decode("utf-8", "replace")
    return [text + "$", *(text[:n] + "*" for n in prefixes if len(text) > n)]


class Vocabulary:
    """Numbers of the kept terms; remembers which of them a word has, for up to a million words."""

    def __init__(self, terms: list[str], prefixes: tuple[int, ...]) -> None:
        self.number = {t: i for i, t in enumerate(terms)}
        self.prefixes = prefixes
        self.known: dict[bytes, tuple[int, ...]] = {}

    def count(self, text: str | None) -> tuple[dict[int, int], int]:
        """How often each kept term is in a text, and how many of its words have none."""
        found: dict[int, int] = {}
        rest = 0
        for word, n in Counter(words_of(text)).items():
            terms = self.known.get(word)
            if terms is None:
                if len(self.known) >= 1 << 20:
                    self.known.clear()
                terms = tuple(self.number[t] for t in terms_of(word, self.prefixes) if t in self.number)
                self.known[word] = terms
            if not terms:
                rest += n
            for t in terms:
                found[t] = found.get(t, 0) + n
        return found, rest


def weigh(ids: np.ndarray, counts: np.ndarray, rest: int, idf: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates and values of a vector of length 1; the last coordinate, len(idf), stands for all other words.

    Their number counts to the nearest half power of two, so that texts of about the same length share a vector.
    """
    values = np.sqrt(counts) * idf[ids]
    if rest:
        ids, values = np.append(ids, len(idf)), np.append(values, s.rest * 2 ** (round(2 * math.log2(rest)) / 4))
    length = math.sqrt(float(values @ values))
    return ids, values / length if length else values


@dataclass
class Index:
    """Distinct example vectors in blocks of similar ones, and for each coordinate the blocks it is in with its maximum.

    cols, vals and begin are the vectors; n and toxic count the examples that share one; ids names the first of them and
    order is its place among all examples. first says where blocks begin. term_begin, term_block and term_max are the postings by block.
    """

    width: int
    cols: np.ndarray
    vals: np.ndarray
    begin: np.ndarray
    n: np.ndarray
    toxic: np.ndarray
    ids: list
    order: np.ndarray
    first: np.ndarray
    term_begin: np.ndarray
    term_block: np.ndarray
    term_max: np.ndarray
    known: dict[tuple[bytes, bytes], int]

    def bounds(self, ids: np.ndarray, values: np.ndarray) -> np.ndarray:
        """No vector of a block has a larger product with the query than its bound."""
        out = np.zeros(len(self.first) - 1)
        for t, v in zip(ids.tolist(), values.tolist(), strict=True):
            part = slice(self.term_begin[t], self.term_begin[t + 1])
            out[self.term_block[part]] += v * self.term_max[part]
        return out

    def __post_init__(self) -> None:
        self.sizes = np.diff(self.begin)

    def products(self, blocks: list[int], query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The vectors of these blocks, and the product of each with the query."""
        spans = [(self.first[b], self.first[b + 1]) for b in blocks]
        parts = [slice(self.begin[low], self.begin[high]) for low, high in spans]
        sizes = np.concatenate([self.sizes[low:high] for low, high in spans])
        each = query[np.concatenate([self.cols[p] for p in parts])] * np.concatenate([self.vals[p] for p in parts])
        return np.concatenate([np.arange(low, high) for low, high in spans]), np.add.reduceat(each, np.cumsum(sizes) - sizes)


def _key(cols: np.ndarray, vals: np.ndarray) -> tuple[bytes, bytes]:
    return cols.tobytes(), np.round(vals, DIGITS).tobytes()


def build_index(vectors: list[tuple[object, int, np.ndarray, np.ndarray]], width: int, block: int) -> Index:
    """From (id, toxic, coordinates, values) of every example, in the order of ids. Vectors lie next to those with the same largest values."""
    same: dict[tuple[bytes, bytes], list[int]] = {}
    for k, (_, _, cols, vals) in enumerate(vectors):
        same.setdefault(_key(cols, vals), []).append(k)
    groups = list(same.values())

    def place(group: list[int]) -> tuple:
        _, _, cols, vals = vectors[group[0]]
        top = np.argsort(-vals, kind="stable")
        return (*cols[top[:3]].tolist(), *(-vals[top]).tolist())

    groups.sort(key=place)
    spare = width + 1  # vectors without any coordinate get one of value 0, so that none is empty
    cols = [vectors[g[0]][2] if len(vectors[g[0]][2]) else np.array([spare]) for g in groups]
    vals = [vectors[g[0]][3] if len(vectors[g[0]][3]) else np.zeros(1) for g in groups]
    begin = np.concatenate([[0], np.cumsum([len(c) for c in cols])]).astype(np.int64)
    all_cols = np.concatenate(cols).astype(np.int64) if cols else np.zeros(0, np.int64)
    all_vals = np.concatenate(vals) if vals else np.zeros(0)
    first = np.append(np.arange(0, len(groups), block), len(groups))
    owner = np.repeat(np.arange(len(groups)) // block, np.diff(begin))
    key = all_cols * max(len(first) - 1, 1) + owner
    order = np.argsort(key, kind="stable")
    distinct, at = np.unique(key[order], return_index=True)
    top = np.maximum.reduceat(all_vals[order], at) if len(at) else np.zeros(0)
    term, in_block = np.divmod(distinct, max(len(first) - 1, 1))
    return Index(
        width,
        all_cols,
        all_vals,
        begin,
        np.array([len(g) for g in groups], np.int64),
        np.array([sum(vectors[k][1] for k in g) for g in groups], np.int64),
        [vectors[g[0]][0] for g in groups],
        np.array([g[0] for g in groups], np.int64),
        first,
        np.searchsorted(term, np.arange(width + 3)),
        in_block,
        top,
        {_key(*vectors[g[0]][2:]): i for i, g in enumerate(groups)},
    )


def nearest(index: Index, ids: np.ndarray, values: np.ndarray, k: int, without: int | None = None) -> list[tuple[float, int, float, float]]:
    """(cosine, vector, votes, toxic votes) of the k nearest examples, nearest first; exact.

    Blocks are opened in the order of their bounds, until the next bound is below the k-th cosine. Examples at the last
    cosine share the votes left to them equally, so the result doesn't depend on the order of the index.
    `without` is a vector from which one example is left out (twice signed: -1 - v for a clean one, v for a toxic one).
    """
    query = np.zeros(index.width + 2)
    query[ids] = values
    bounds = index.bounds(ids, values)
    order = np.argsort(-bounds, kind="stable")
    n, toxic = index.n.astype(float), index.toxic.astype(float)
    left = None
    if without is not None:
        left = without if without >= 0 else -1 - without
    which, cosine = np.zeros(0, np.int64), np.zeros(0)
    limit = -1.0
    at, step = 0, 2
    while at < len(order) and bounds[order[at]] >= limit - 10.0**-DIGITS:
        opened = order[at : at + step]
        more, value = index.products(opened[bounds[opened] >= limit - 10.0**-DIGITS].tolist(), query)
        which, cosine = np.append(which, more), np.append(cosine, np.round(value, DIGITS))
        at, step = at + step, min(2 * step, 32)
        rank = np.argsort(-cosine, kind="stable")
        which, cosine = which[rank], cosine[rank]
        enough = np.flatnonzero(np.cumsum(n[which] - (which == left)) >= k)
        if len(enough):
            limit = float(cosine[enough[0]])
            which, cosine = which[cosine >= limit], cosine[cosine >= limit]  # all ties stay
    order = np.lexsort((index.order[which], -cosine))
    which, cosine = which[order], cosine[order]
    have, bad = n[which], toxic[which]
    if left is not None:
        have, bad = have - (which == left), bad - ((which == left) & (without >= 0))
    out: list[tuple[float, int, float, float]] = []
    free = float(k)
    at = 0
    while at < len(which) and free > 0:
        end = int(np.searchsorted(-cosine, -cosine[at], "right"))
        total = float(have[at:end].sum())
        share = min(1.0, free / total) if total else 0.0
        out += [
            (float(cosine[j]), int(which[j]), share * float(have[j]), share * float(bad[j])) for j in range(at, end) if have[j] > 0
        ]
        free -= share * total
        at = end
    return out


def vote(found: list[tuple[float, int, float, float]], prior: float, s: Settings) -> float:
    """Share of toxic votes, each weighted by the inverse of its distance; the prior has one vote at distance 1."""
    weights = [1 / (1 - min(c, 1.0) + s.near) for c, *_ in found]
    total = sum(w * v for w, (_, _, v, _) in zip(weights, found, strict=True))
    bad = sum(w * t for w, (*_, t) in zip(weights, found, strict=True))
    one = 1 / (1 + s.near)
    return (bad + one * prior) / (total + one)


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def fit_calibration(share: np.ndarray, n: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """(a, b) of sigmoid(a * logit(share) + b), by Newton steps on the votes of examples that were left out.

    A weak pull towards (1, 0), worth four examples, keeps it defined for few examples; a is never below 0.1, so the
    order of the votes stays.
    """
    x = _logit(share)
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-(theta[0] * x + theta[1])))
        w = n * p * (1 - p)
        gradient = np.array([((toxic - n * p) * x).sum(), (toxic - n * p).sum()]) - 4 * (theta - [1.0, 0.0])
        hessian = np.array([[(w * x * x).sum() + 4, (w * x).sum()], [(w * x).sum(), w.sum() + 4]])
        step = np.linalg.solve(hessian, gradient)
        theta = theta + np.clip(step, -1, 1)
        theta[0] = max(theta[0], 0.1)
        if np.abs(step).max() < 1e-9:
            break
    return float(theta[0]), float(theta[1])


def calibrated(share: float, fit: tuple[float, float]) -> float:
    return float(1 / (1 + np.exp(-(fit[0] * _logit(np.array(share)) + fit[1]))))


@dataclass
class Model:
    """Everything fitted on the examples; its size is bounded by the settings, whatever the corpus."""

    settings: Settings
    terms: list[str]
    idf: np.ndarray
    index: Index
    prior: float
    fit: tuple[float, float]


def held_out(id_col: Column) -> Column:
    """Rows that are never learned from: crc32 of the id as text, modulo 5, is 0. A null id counts as an empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def pick_examples(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, bound: int) -> DataFrame:
    """doc_id, toxic and text of at most `bound` labelled rows to learn from, written once.

    Ids are taken by buckets of their hash, whose sizes are counted first, as many as stay within the bound. An id with
    several labels is toxic if one says so, one with several texts has the first in order. The picked ids are at most
    `bound`, so they are broadcast and the texts of the others stay where they are.
    """
    buckets = 1 << 12
    marked = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col)))
    marked = marked.groupBy(F.col(id_col).alias("doc_id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
    marked = stage(marked.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets))), "labels")
    sizes = {r["bucket"]: r["count"] for r in marked.groupBy("bucket").count().collect()}
    upto = int(np.searchsorted(np.cumsum([sizes.get(b, 0) for b in range(buckets)]), bound, "right"))
    picked = marked.filter(F.col("bucket") < upto).select("doc_id", "toxic")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    found = stage(found, "examples")
    discard(marked)
    return found


def pick_terms(examples: DataFrame, s: Settings) -> list[str]:
    """Terms whose presence goes with the label, by chi-square over the examples: the clearest, of equally clear ones the longest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                both[toxic != 0].update({t for w in set(words_of(text)) for t in terms_of(w, s.prefixes)})
        names = list(both[0].keys() | both[1].keys())
        for low in range(0, len(names), 50000):
            part = names[low : low + 50000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array([both[1][t] for t in part], pa.int64()), pa.array([both[0][t] for t in part], pa.int64())], ["term", "bad", "good"])
        give_back()

    n = examples.agg(F.sum(F.lit(1)).alias("n"), F.sum("toxic").alias("bad")).first()
    bad_rows, rows = float(n["bad"] or 0), float(n["n"] or 0)
    if not 0 < bad_rows < rows:
        return []
    counts = examples.select("text", "toxic").mapInArrow(run, "term string, bad long, good long")
    counts = counts.groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).filter(F.col("bad") + F.col("good") >= s.least_rows)
    a, b = F.col("bad").cast("double"), F.col("good").cast("double")
    seen = a + b
    cross = a * (rows - bad_rows - b) - b * (bad_rows - a)
    chi2 = rows * cross * cross / (seen * (rows - seen) * bad_rows * (rows - bad_rows))
    kept = counts.filter(seen < rows).withColumn("chi2", chi2).filter(F.col("chi2") > max(s.least_chi2, s.least_effect * rows))
    got = kept.orderBy(F.desc("chi2"), F.desc(F.length("term")), "term").limit(s.terms).collect()  # at most s.terms rows
    return [r["term"] for r in got]


def count_terms(docs: DataFrame, terms: list[str], s: Settings) -> DataFrame:
    """doc_id, term numbers, their counts and the number of other words, for every row; text and all else stay behind."""
    held = docs.sparkSession.sparkContext.broadcast(terms)  # at most s.terms short strings

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(held.value, s.prefixes)
        for batch in batches:
            found = [vocabulary.count(t) for t in batch.column(1).to_pylist()]
            ids = [sorted(f) for f, _ in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(ids, pa.list_(pa.int32())),
                    pa.array([[f[t] for t in i] for i, (f, _) in zip(ids, found, strict=True)], pa.list_(pa.int64())),
                    pa.array([r for _, r in found], pa.int64()),
                ],
                ["doc_id", "ids", "counts", "rest"],
            )
        give_back()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>, counts array<bigint>, rest bigint")


def document_frequencies(counted: DataFrame, size: int) -> np.ndarray:
    """Rows that hold each term: summed in each task, then over the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            df += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(df[at])], ["term", "df"])

    out = np.zeros(size)
    sums = counted.select("ids").mapInArrow(run, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df"))
    for r in sums.collect():  # at most `size` rows
        out[r["term"]] = r["df"]
    return out


def _vectors(batch: pa.RecordBatch, idf: np.ndarray, s: Settings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for ids, counts, rest in zip(*(batch.column(c).to_pylist() for c in ("ids", "counts", "rest")), strict=True):
        yield weigh(np.array(ids, np.int64), np.array(counts, np.float64), rest, idf, s)


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, s: Settings) -> tuple[Model, DataFrame]:
    """The model, and the written term counts of every row of docs.

    Terms, index and calibration come from the examples, inverse document frequencies from all rows.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    examples = pick_examples(docs, labels, id_col, text_col, label_col, s.examples)
    terms = pick_terms(examples, s)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    counted = stage(count_terms(rows, terms, s), "terms")
    df = document_frequencies(counted, len(terms))
    idf = np.log((1 + counted.count()) / (1 + df)) + 1e-6
    known = stage(count_terms(examples, terms, s).join(F.broadcast(examples.select("doc_id", "toxic")), "doc_id"), "known")
    vectors = []
    for r in known.orderBy("doc_id").toLocalIterator():  # at most s.examples rows of at most s.terms numbers
        cols, vals = weigh(np.array(r["ids"], np.int64), np.array(r["counts"], np.float64), r["rest"], idf, s)
        vectors.append((r["doc_id"], r["toxic"], cols, vals))
    index = build_index(vectors, len(terms), s.block)
    bad = sum(v[1] for v in vectors)
    model = Model(s, terms, idf, index, (bad + 0.5) / (len(vectors) + 2), (1.0, 0.0))
    model.fit = _calibrate(known, model)
    discard(examples, known)
    return model, counted


def _calibrate(known: DataFrame, model: Model) -> tuple[float, float]:
    """Every example meets the index without itself, in tasks; its vote goes into one of 1000 bins, and the bins to the driver."""
    held = known.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        n, bad = np.zeros(1001, np.int64), np.zeros(1001, np.int64)
        bins: dict[int, int] = {}
        for batch in batches:
            for (cols, vals), toxic in zip(_vectors(batch, m.idf, m.settings), batch.column("toxic").to_pylist(), strict=True):
                own = m.index.known[_key(cols, vals)]
                left = own if toxic else -1 - own
                if left not in bins:
                    bins[left] = round(1000 * vote(nearest(m.index, cols, vals, m.settings.neighbours, left), m.prior, m.settings))
                k = bins[left]
                n[k] += 1
                bad[k] += toxic
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(n[at]), pa.array(bad[at])], ["bin", "n", "bad"])

    dealt = known.repartition(max(1, min(64, known.sparkSession.sparkContext.defaultParallelism)))
    rows = dealt.mapInArrow(run, "bin long, n long, bad long").groupBy("bin").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).collect()
    if not rows:
        return 1.0, 0.0
    return fit_calibration(*(np.array([r[c] for r in rows], float) / d for c, d in (("bin", 1000), ("n", 1), ("bad", 1))))


def score(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    settings: Settings | None = None,
    evidence: int = 3,
) -> DataFrame:
    """doc_id, held_out, score, predicted and evidence (example, cosine, share of toxic votes, term) of every row.

    The score is the calibrated share of distance-weighted votes of the nearest examples; only the text decides it. The
    evidence names the nearest examples and the term that adds most to the cosine (null if it is all other words).
    Rows are never shuffled; the model, bounded by its settings, is broadcast. Nulls: a null text is empty and gets the
    score of the examples at large; a null id is held out; null labels are not learned from. Without any label of each
    kind there are no terms. Repeated rows score alike; an empty table gives no rows; other columns are ignored.
    """
    s = settings or Settings()
    model, counted = fit(docs, labels, id_col, text_col, label_col, s)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        known: dict[tuple[bytes, bytes], tuple[float, list[dict]]] = {}
        for batch in batches:
            scores, why = [], []
            for cols, vals in _vectors(batch, m.idf, s):
                key = _key(cols, vals)
                if key not in known:
                    if len(known) >= 1 << 16:
                        known.clear()
                    found = nearest(m.index, cols, vals, s.neighbours)
                    known[key] = (calibrated(vote(found, m.prior, s), m.fit), _evidence(m, cols, vals, found[:evidence]))
                got = known[key]
                scores.append(got[0])
                why.append(got[1])
            named = pa.struct([("example", batch.column("doc_id").type), ("cosine", pa.float64()), ("toxic", pa.float64()), ("term", pa.string())])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(why, pa.list_(named))], ["doc_id", "score", "evidence"]
            )
        give_back()

    kind = counted.schema["doc_id"].dataType.simpleString()
    got = counted.mapInArrow(run, f"doc_id {kind}, score double, evidence array<struct<example:{kind},cosine:double,toxic:double,term:string>>")
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0)
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"), "evidence")


def _evidence(m: Model, cols: np.ndarray, vals: np.ndarray, found: list[tuple[float, int, float, float]]) -> list[dict]:
    query = np.zeros(m.index.width + 2)
    query[cols] = vals
    out = []
    for cosine, v, votes, bad in found:
        part = slice(m.index.begin[v], m.index.begin[v + 1])
        shared = query[m.index.cols[part]] * m.index.vals[part]
        top = int(m.index.cols[part][shared.argmax()])
        term = m.terms[top] if top < len(m.terms) and shared.max() > 0 else None
        out.append({"example": m.index.ids[v], "cosine": cosine, "toxic": bad / votes, "term": term})
    return out
