"""Quality rules run as a short-circuit cascade, ordered by rejections per unit of cost."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainspark.llm.blobs import give_back
from rainspark.llm.common import bounded_batches

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
BULLETS = (b"-", b"*", "•".encode())
BASE_FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


class Text:
    """A text whose features are worked out when a rule first asks for them. Null counts as empty."""

    def __init__(self, text: str | None) -> None:
        self.text = text or ""

    @cached_property
    def data(self) -> bytes:
        return self.text.encode("utf-8", "surrogatepass")

    @cached_property
    def words(self) -> list[bytes]:
        return self.data.split()  # bytes split at 20 and 09-0D, no other white space

    @cached_property
    def lines(self) -> list[bytes]:
        return [x for x in self.data.split(b"\n") if x.strip()]

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, SPACES))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        return repeated_words(self.words, 5)

    @cached_property
    def n_lettered(self) -> int:
        return sum(1 for x in self.words if any(c > 0x40 and (c | 0x20) - 0x61 < 26 or c >= 0x80 for c in x))


def repeated_words(words: list[bytes], width: int) -> int:
    """Words that lie in a window of `width` words which the list holds twice or more. Exact: windows are numbered, not hashed."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    if len(seen) == len(words):
        return 0
    window, base = ids[:n], len(seen)
    for k in range(1, width):
        window = window * len(seen) + ids[k : k + n]
        base *= len(seen)
        if base > 2**62 // len(seen):
            window = np.unique(window, return_inverse=True)[1].astype(np.int64)
            base = n
    _, inverse, counts = np.unique(window, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[inverse] > 1)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + width, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


@dataclass(frozen=True)
class Rule:
    """rejects(text) is true for a text that the rule throws out."""

    name: str
    rejects: Callable[[Text], bool]


def too_few_words(t: Text) -> bool:
    return t.n_words < 10


def too_repetitive(t: Text) -> bool:
    return 100 * t.n_repeat_words > 20 * t.n_words


def too_many_symbols(t: Text) -> bool:
    return 10 * t.n_symbols > 3 * t.n_words


def odd_word_length(t: Text) -> bool:
    return not 2 * t.n_words <= t.word_chars <= 20 * t.n_words


def too_many_dup_lines(t: Text) -> bool:
    """Over 30 % of the lines; one or two repeated lines of a short text are no sign."""
    return t.n_dup_lines > 2 and 100 * t.n_dup_lines > 30 * len(t.lines)


def too_few_letters(t: Text) -> bool:
    return 100 * t.n_lettered < 60 * t.n_words


def mostly_bullets(t: Text) -> bool:
    return 100 * sum(x.lstrip().startswith(BULLETS) for x in t.lines) > 90 * len(t.lines)


def mostly_cut_off(t: Text) -> bool:
    return 100 * sum(x.rstrip().endswith((b"...", "…".encode())) for x in t.lines) > 30 * len(t.lines)


#: The two base rules; a text that fails either is rejected whatever the others say.
BASE_RULES = (Rule("too_few_words", too_few_words), Rule("too_repetitive", too_repetitive))
#: Further rules of the cascade.
RULES = (
    Rule("too_many_symbols", too_many_symbols),
    Rule("odd_word_length", odd_word_length),
    Rule("too_many_dup_lines", too_many_dup_lines),
    Rule("too_few_letters", too_few_letters),
    Rule("mostly_bullets", mostly_bullets),
    Rule("mostly_cut_off", mostly_cut_off),
)


def measure(df: DataFrame, rules: tuple[Rule, ...], text_col: str, sample: int, counted: bool) -> dict[str, tuple[float, float]]:
    """Seconds per text and share of rejections of every rule, on `sample` rows at most.

    A rule's cost is what it adds: if the counts are worked out for every text anyway (counted), it meets a Text that has
    them, else a fresh one, and pays for the features that it needs. The sample only sets the order of the rules, never a
    verdict; whatever rows it has, however often an id is repeated, they are no more than `sample`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {r.name: [0.0, 0] for r in rules}
        n = 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                n += 1
                for rule in rules:
                    t = Text(text)
                    if counted:
                        for c in BASE_FIELDS:
                            getattr(t, c)
                    began = time.perf_counter()
                    total[rule.name][1] += rule.rejects(t)
                    total[rule.name][0] += time.perf_counter() - began
        yield pa.RecordBatch.from_pylist(
            [{"name": k, "seconds": s, "rejected": c, "n": n} for k, (s, c) in total.items()],
            schema=pa.schema([("name", pa.string()), ("seconds", pa.float64()), ("rejected", pa.int64()), ("n", pa.int64())]),
        )

    share = min(1.0, 2 * sample / max(df.count(), 1))
    picked = df.select(text_col).sample(share, 7).limit(sample)
    got = picked.mapInArrow(run, "name string, seconds double, rejected long, n long")
    sums = got.groupBy("name").agg(F.sum("seconds").alias("s"), F.sum("rejected").alias("r"), F.sum("n").alias("n"))
    return {x["name"]: (x["s"] / max(x["n"], 1), x["r"] / max(x["n"], 1)) for x in sums.collect()}


def order_rules(rules: tuple[Rule, ...], measured: dict[str, tuple[float, float]]) -> list[Rule]:
    """Most rejections per second first; among rules that reject nothing, the cheapest first."""

    def rank(rule: Rule) -> tuple[float, float, str]:
        cost, share = measured.get(rule.name, (1.0, 0.0))
        return -share / max(cost, 1e-9), cost, rule.name

    return sorted(rules, key=rank)


def apply_rules(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: tuple[Rule, ...] = RULES,
    base_rules: tuple[Rule, ...] = BASE_RULES,
    sample: int = 1000,
    columns: list[str] | None = None,
    counts: bool = True,
) -> DataFrame:
    """`columns` of df (the id if none are named) with the base counts, base_failed and kept of every row; without `counts`
    only with kept.

    A text meets all rules, base rules included, in the measured order and leaves at the first that rejects it; features
    are worked out on demand. The counts are of every text, rejected or not, so asking for them costs more than the
    verdict. No shuffle of the table takes place. Nulls: a null text has no words and fails. Repeated rows are judged one by one;
    an empty table gives no rows; a column of df with the name of a result is replaced.
    """
    bounded_batches(df.sparkSession)
    every = (*base_rules, *rules)
    ordered = order_rules(every, measure(df, every, text_col, sample, counts)) if every else []
    base_fields, named = (BASE_FIELDS, ["base_failed", "kept"]) if counts else ((), ["kept"])
    keep = [c for c in (columns or [id_col]) if c not in (*base_fields, *named)]
    rows = df.select(F.col(text_col).alias("t"), *(F.col(c).alias(f"c{i}") for i, c in enumerate(keep)))  # own names can't clash
    rows_out = rows.columns[1:]
    fields = [T.StructField(c, T.LongType()) for c in base_fields] + [T.StructField(c, T.BooleanType()) for c in named]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {c: [] for c in (*base_fields, *named)}
            for text in batch.column(0).to_pylist():
                t = Text(text)
                for c in base_fields:
                    out[c].append(getattr(t, c))
                if counts:
                    out["base_failed"].append(any(r.rejects(t) for r in base_rules))
                out["kept"].append(not any(r.rejects(t) for r in ordered))
            new = [pa.array(out[c], pa.int64()) for c in base_fields] + [pa.array(out[c], pa.bool_()) for c in named]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *new], [*rows_out, *base_fields, *named])
        give_back()

    got = rows.mapInArrow(run, T.StructType([rows.schema[c] for c in rows_out] + fields))
    return got.toDF(*keep, *base_fields, *named)
