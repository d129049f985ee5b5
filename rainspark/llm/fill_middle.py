"""Fill-in-the-middle: cut texts into prefix, middle and suffix and write the middle last, byte by byte in whole batches."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainspark.llm.common import bounded_batches

PLAIN, PSM, SPM = "plain", "psm", "spm"


@dataclass(frozen=True)
class Marks:
    """The strings before prefix, suffix and middle.

    All begin with one ASCII character that is nowhere else in them, so that a mark in an output can't overlap another
    or arise where two segments meet.
    """

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self) -> None:
        parts = (self.prefix, self.suffix, self.middle)
        if len(set(parts)) < 3 or not all(parts) or not "".join(parts).isascii():
            raise ValueError("marks must be three different ASCII strings")
        if len({x[0] for x in parts}) > 1 or any(x[0] in x[1:] for x in parts) or any(a != b and a.startswith(b) for a in parts for b in parts):
            raise ValueError("marks must share a first character that is nowhere else in them, and none may begin another")

    def encoded(self) -> tuple[bytes, bytes, bytes]:
        return self.prefix.encode(), self.suffix.encode(), self.middle.encode()


def find_mark(data: np.ndarray, starts: np.ndarray, mark: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(text, place) of every occurrence of mark that lies inside one text; text i is data[starts[i]:starts[i + 1]]."""
    size = len(data) - len(mark) + 1
    if size <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(data[:size] == mark[0])
    for k in range(1, len(mark)):
        at = at[data[at + k] == mark[k]]
    text = np.searchsorted(starts, at, "right") - 1
    inside = at + len(mark) <= starts[text + 1]
    return text[inside], at[inside]


def displaced(begins: np.ndarray, shifts: np.ndarray, total: int, piece: int = 1 << 20) -> Iterator[tuple[slice, np.ndarray]]:
    """The place that every byte moves to: from begins[i] on bytes move by shifts[i].

    The changes of the shift are a difference array over the bytes, whose cumulative sum is the shift of every byte.
    It is laid out for `piece` bytes at a time, so memory doesn't grow with the length of a text.
    """
    change = np.diff(shifts, prepend=0)
    carry = 0
    for low in range(0, total, piece):
        high = min(low + piece, total)
        first, last = np.searchsorted(begins, [low, high])
        difference = np.zeros(high - low, np.int64)
        np.add.at(difference, begins[first:last] - low, change[first:last])
        shift = np.cumsum(difference) + carry
        carry = int(shift[-1])
        yield slice(low, high), np.arange(low, high) + shift


def scan_cuts(data: np.ndarray, starts: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens, end of prefix, end of middle) of every text.

    A token is a run of ASCII letters or any other single code point. The two cuts fall after draws % (tokens + 1) tokens.
    """
    letter = ((data | 0x20) - np.uint8(97)) < 26
    begins = (data & 0xC0) != 0x80
    begins[1:] &= ~(letter[1:] & letter[:-1])
    begins[starts[:-1][np.diff(starts) > 0]] = True
    where = np.append(np.flatnonzero(begins), len(data))
    first = np.searchsorted(where, starts)
    n = np.diff(first)
    cuts = np.sort(draws[:, :2] % (n + 1)[:, None], axis=1)
    return n, where[first[:-1] + cuts[:, 0]], where[first[:-1] + cuts[:, 1]]


def rearrange(
    data: np.ndarray, starts: np.ndarray, draws: np.ndarray, marks: Marks, cut_percent: int, spm_percent: int
) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """Outputs of all texts as one array with its starts, and n, form, prefix_chars and middle_chars of each."""
    n, one, two = scan_cuts(data, starts, draws)
    begin, end = starts[:-1], starts[1:]
    plain = (begin == end) | (draws[:, 2] % 100 >= cut_percent)
    p, s, m = marks.encoded()
    for mark in (p, s, m):
        plain[find_mark(data, starts, mark)[0]] = True
    spm = ~plain & (draws[:, 3] % 100 < spm_percent)
    psm = ~plain & ~spm
    one, two = np.where(plain, end, one), np.where(plain, end, two)
    out_starts = np.concatenate([[0], np.cumsum(end - begin + np.where(plain, 0, len(p) + len(s) + len(m)))])
    out = np.empty(out_starts[-1], np.uint8)
    base = out_starts[:-1]
    prefix = base + np.where(psm, len(p), np.where(spm, len(s) + end - two + len(p), 0))
    suffix = base + np.where(psm, len(p) + one - begin + len(s), np.where(spm, len(s), end - begin))
    middle = np.where(plain, base, out_starts[1:] - (two - one))
    edges = np.stack([begin, one, two], 1).ravel()
    shifts = np.stack([prefix - begin, middle - one, suffix - two], 1).ravel()
    for part, to in displaced(edges, shifts, len(data)):
        out[to] = data[part]
    for mark, places in ((p, prefix), (s, suffix), (m, middle)):
        at = places[~plain] - len(mark)
        for k, byte in enumerate(mark):
            out[at + k] = byte
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    form = np.where(plain, PLAIN, np.where(spm, SPM, PSM))
    return out, out_starts, {"n": n, "form": form, "prefix_chars": heads[one] - heads[begin], "middle_chars": heads[two] - heads[one]}


def put_back(data: np.ndarray, starts: np.ndarray, form: np.ndarray, marks: Marks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(texts as one array, starts, whether each is valid), from outputs and forms alone.

    An output is not valid if its form is unknown or its marks aren't there once each, in the order of the form.
    """
    p, s, m = marks.encoded()
    begin, end = starts[:-1], starts[1:]
    at = {}
    once = np.ones(len(begin), bool)
    for mark in (p, s, m):
        text, place = find_mark(data, starts, mark)
        once &= np.bincount(text, minlength=len(begin)) == 1
        at[mark] = np.full(len(begin), -1)
        at[mark][text] = place
    psm = (form == PSM) & once & (at[p] == begin) & (at[p] < at[s]) & (at[s] < at[m])
    spm = (form == SPM) & once & (at[s] == begin) & (at[s] < at[p]) & (at[p] < at[m])
    plain = form == PLAIN
    cut = psm | spm
    prefix = np.where(cut, at[p] + len(p), begin)
    suffix = np.where(cut, at[s] + len(s), end)
    middle = np.where(cut, at[m] + len(m), end)
    prefix_end = np.where(psm, at[s], np.where(spm, at[m], np.where(plain, end, begin)))
    suffix_end = np.where(psm, at[m], np.where(spm, at[p], end))
    sizes = np.stack([prefix_end - prefix, end - middle, suffix_end - suffix], 1)
    to = np.concatenate([[0], np.cumsum(sizes.ravel())])
    shifts = np.stack([prefix, middle, suffix], 1).ravel() - to[:-1]
    out = np.empty(to[-1], np.uint8)
    for part, source in displaced(to[:-1], shifts, len(out)):
        out[part] = data[source]
    return out, to[::3], plain | cut


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column without nulls, and where each value starts."""
    wide = pa.types.is_large_string(column.type)
    starts = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[starts[0] : starts[-1]], starts - starts[0]


def _strings(data: np.ndarray, starts: np.ndarray, kind: pa.DataType, valid: np.ndarray | None = None) -> pa.Array:
    offsets = starts.astype(np.int64 if pa.types.is_large_string(kind) else np.int32)
    mask = None if valid is None or valid.all() else pa.py_buffer(np.packbits(valid, bitorder="little").tobytes())
    return pa.Array.from_buffers(kind, len(starts) - 1, [mask, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])


def _pieces(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in parts of about `limit` bytes of text; a text is never divided."""
    if not batch.num_rows:
        return
    ends = _bytes_of(batch.column(column))[1][1:]
    low = 0
    while low < batch.num_rows:
        done = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield batch.slice(low, high - low)
        low = high


def rearrange_texts(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    marks: Marks | None = None,
    seed: int = 1,
    cut_percent: int = 90,
    spm_percent: int = 20,
    piece_bytes: int = 4 << 20,
) -> DataFrame:
    """doc_id, n (tokens), form (plain, psm or spm), prefix_chars, middle_chars (null if plain) and output of every row.

    Where a text is cut, and how it is written, follows from the sha256 of the seed and the id alone, so a lost task
    makes the same rows again. No row is shuffled. A text that is empty, holds a mark or isn't drawn stays as it is.
    Nulls: a null text is empty, a null id draws like an empty one. Repeated rows come out alike; an empty table gives no
    rows; other columns of df are ignored. A text is one string in one task, whatever its length.
    """
    marks = marks or Marks()
    bounded_batches(df.sparkSession)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    rows = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *draws)
    fields = [rows.schema["doc_id"]] + [T.StructField(c, t) for c, t in _FIELDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _pieces(batch, "text", piece_bytes):
                data, starts = _bytes_of(part.column("text"))
                drawn = np.stack([part.column(f"h{i + 1}").to_numpy(zero_copy_only=False) for i in range(4)], 1)
                out, out_starts, facts = rearrange(data, starts, drawn, marks, cut_percent, spm_percent)
                plain = facts["form"] == PLAIN
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(facts["n"], pa.int64()),
                        pa.array(facts["form"], pa.string()),
                        pa.array(facts["prefix_chars"], pa.int64(), mask=plain),
                        pa.array(facts["middle_chars"], pa.int64(), mask=plain),
                        _strings(out, out_starts, part.column("text").type),
                    ],
                    ["doc_id", *(c for c, _ in _FIELDS)],
                )

    return rows.mapInArrow(run, T.StructType(fields))


_FIELDS = [("n", T.LongType()), ("form", T.StringType()), ("prefix_chars", T.LongType()), ("middle_chars", T.LongType()), ("output", T.StringType())]


def restored(output: Column, form: Column, marks: Marks | None = None) -> Column:
    """The text that an output was made from; null where output or form is null or they don't fit each other."""
    marks = marks or Marks()

    @F.arrow_udf("string")
    def restore(outputs: pa.Array, forms: pa.Array) -> pa.Array:
        valid = np.asarray(outputs.is_valid()) & np.asarray(forms.is_valid())
        data, starts = _bytes_of(outputs.fill_null(""))
        texts, text_starts, fits = put_back(data, starts, np.array(forms.fill_null("").to_pylist(), object), marks)
        return _strings(texts, text_starts, outputs.type, fits & valid)

    return restore(output, form)
