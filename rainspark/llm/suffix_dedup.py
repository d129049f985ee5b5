"""Remove passages that repeat an earlier document, through a distributed merge sort of suffixes.

The order of work follows distributed string sorting with prefix doubling (Bingmann, Sanders, Schimek, 2020):

1. A sparse set of suffixes is enough. Of the k-mers inside a window of `length` bytes the least by hash is its anchor;
   equal windows have equal anchors at equal places, so equal windows meet among the suffixes that start at anchors.
2. Hashes of the anchors' k-mers are exchanged first. A suffix whose k-mer stands once in all documents has no
   partner and drops out, before any of its bytes move. (Equal hashes of unlike k-mers only let a suffix through.)
3. Every block sorts its remaining suffixes, front-codes the sorted run and sends it off by key range.
4. Each range is merged by a loser tree over the runs. The tree keeps with every head the length of its common prefix
   with the last output, decides by those lengths alone where they differ and else compares from there on.
5. Suffixes with the same k-mer come out side by side. Their windows are compared byte by byte, each gets the least
   document that holds it, and the answer goes back to the block that asked.

A k-mer that stands in very many places, with whatever around it, would be one group of any size. Its windows don't go
by suffix but by their own hash, each once for a block, and so spread over all ranges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainspark.llm.blobs import dump, dump_small, dump_sorted, give_back, load, load_sorted, range_cuts, squeeze, unsqueeze
from rainspark.llm.common import bounded_batches, mix64, new_path, partitions

KMER = 24
LAST = (1 << 63) - 1  # stands for a null id: later than every document

_BLOCK = "doc_ids array<bigint>, carried array<string>, sizes binary, data binary"
_BLOCK_ARROW = pa.schema(
    [("doc_ids", pa.list_(pa.int64())), ("carried", pa.list_(pa.string())), ("sizes", pa.binary()), ("data", pa.binary())]
)


def blocks_of(docs: DataFrame, block_bytes: int) -> DataFrame:
    """doc_id, text, carried as compressed blocks of about block_bytes, written once to the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        carried: list = []
        data: list[bytes] = []
        size = 0

        def close() -> pa.RecordBatch:
            row = {"doc_ids": ids, "carried": carried, "sizes": dump_small(np.array([len(x) for x in data], np.int64))}
            return pa.RecordBatch.from_pylist([row | {"data": squeeze(b"".join(data))}], schema=_BLOCK_ARROW)

        for batch in batches:
            for doc, text, more in zip(*(batch.column(i) for i in range(3)), strict=True):
                ids.append(doc.as_py())
                carried.append(more.as_py())
                data.append(text.as_py().encode("utf-8", "surrogatepass"))
                size += len(data[-1]) + 64
                if size >= block_bytes:
                    yield close()
                    ids, carried, data, size = [], [], [], 0
        if ids:
            yield close()
        give_back()

    path = new_path(docs.sparkSession, "texts")
    docs.mapInArrow(run, _BLOCK).withColumn("block", F.monotonically_increasing_id()).write.parquet(path)
    return docs.sparkSession.read.schema(_BLOCK + ", block long").parquet(path)


def kmer_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the KMER bytes from each position on, by doubling a polynomial hash."""
    x = data.astype(np.uint64) + np.uint64(1)
    factor, width = 0x9E3779B97F4A7C15, 1
    by_width = {}
    while width < 16:
        x = x[:-width] * np.uint64(factor) + x[width:]
        factor, width = factor * factor % (1 << 64), 2 * width
        by_width[width] = (x, factor)
    half, factor = by_width[8]
    return mix64(x[: len(x) - 8] * np.uint64(factor) + half[16:])


def anchors(data: bytes, sizes: np.ndarray, length: int, chunk: int = 1 << 19) -> tuple[np.ndarray, ...]:
    """(anchor, first window, number of windows, k-mer key) of all runs of windows with the same anchor.

    Windows never cross documents. A window's anchor is the k-mer of least hash in it, the leftmost of equals. Least
    hashes are small ones, so the key is mixed once more: equal ranges of keys then hold about equally many anchors.
    """
    n = len(data)
    raw = np.frombuffer(data + bytes(length + KMER), np.uint8)
    span = length - KMER + 1
    chosen = np.empty(n, np.int32)
    low = np.uint64((1 << 24) - 1)
    places, hashes = [], []
    for a in range(0, n, chunk):
        b = min(a + chunk, n)
        h = kmer_hashes(raw[a : b + length - 1])
        least = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        width = 1
        while 2 * width <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        rest = span - width
        if rest:
            least = np.minimum(least[:-rest], least[rest:])
        near = (least & low).astype(np.int32)[: b - a]
        chosen[a:b] = near + a
        near = near[np.concatenate([[True], near[1:] != near[:-1]])]
        places.append(near + a)
        hashes.append(h[near])
    ends = np.cumsum(sizes)
    broken = np.zeros(n + 1, np.int32)
    np.add.at(broken, np.maximum(ends - length + 1, ends - sizes), 1)
    np.add.at(broken, ends, -1)
    valid = np.cumsum(broken[:n], dtype=np.int32) == 0
    change = np.ones(n + 1, bool)
    change[1:n] = (chosen[1:] != chosen[:-1]) | ~valid[1:] | ~valid[:-1]
    first = np.flatnonzero(valid & change[:n])
    last = np.flatnonzero(valid & change[1:])
    anchor = chosen[first].astype(np.int64)
    if not len(anchor):
        return anchor, first, first, anchor.astype(np.uint64)
    found = np.searchsorted(np.concatenate(places), anchor)
    return anchor, first, last - first + 1, mix64(np.concatenate(hashes)[found])


def _open(row: dict) -> tuple[bytes, np.ndarray, np.ndarray]:
    sizes = load(row["sizes"]).astype(np.int64)
    ids = np.array([LAST if i is None else i for i in row["doc_ids"]], np.int64)
    return unsqueeze(row["data"]), sizes, ids


_ASK = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("keys", pa.binary()), ("many", pa.binary()), ("times", pa.binary())])


def _ask(ranges: int, bits: int, length: int):
    """Every block's distinct k-mer hashes, by range, whether the block has each in two documents or more, and how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                data, sizes, ids = _open(row)
                anchor, _, _, h = anchors(data, sizes, length)
                doc = ids[np.searchsorted(np.cumsum(sizes), anchor, "right")]
                order = np.lexsort((doc, h))
                h, doc = h[order] >> np.uint64(64 - bits), doc[order]
                first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
                changes = np.concatenate([[0], np.cumsum((h[1:] == h[:-1]) & (doc[1:] != doc[:-1]))]) if len(h) else first
                many = np.diff(np.append(changes[first], changes[-1] if len(h) else 0)) > 0
                keys, times = h[first], np.diff(np.append(first, len(h)))
                cut = range_cuts(keys << np.uint64(64 - bits), ranges)
                for r in range(ranges):
                    if cut[r] == cut[r + 1]:  # so there are never more rows than keys, however many ranges
                        continue
                    at = slice(cut[r], cut[r + 1])
                    piece = [[row["block"]], [r], [dump_sorted(keys[at])], [dump(np.packbits(many[at]))], [dump_small(times[at])]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(piece, _ASK.types, strict=True)], _ASK.names)
                give_back()

    return run


def _partners(most: int):
    """For a range of hashes: which of each block's keys stand in two documents or more, and which in over `most` places."""

    def run(table: pa.Table) -> pa.Table:
        return _shared_keys(table.to_pylist(), most)

    return run


def _shared_keys(rows: list[dict], most: int) -> pa.Table:
    keys = [load_sorted(r["keys"]) for r in rows]
    _, which, times = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    shared = times > 1
    at = 0
    for r, k in zip(rows, keys, strict=True):
        many = np.unpackbits(load(r["many"]))[: len(k)].astype(bool)
        shared[which[at : at + len(k)][many]] = True
        at += len(k)
    often = shared & (np.bincount(which, np.concatenate([load(r["times"]) for r in rows]), len(times)) > most)
    at, out = 0, []
    for r, k in zip(rows, keys, strict=True):
        bits = dump(np.packbits(shared[which[at : at + len(k)]]))
        out.append({"block": r["block"], "part": r["part"], "n": len(k), "shared": bits, "often": dump(np.packbits(often[which[at : at + len(k)]]))})
        at += len(k)
    give_back()
    return pa.Table.from_pylist(out, schema=_SHARED)


_SHARED = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("n", pa.int64()), ("shared", pa.binary()), ("often", pa.binary())])


def front_code(records: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Of sorted rows of bytes: the length that each shares with the row before, and the bytes from there on."""
    n, width = records.shape
    shared = np.zeros(n, np.uint16)
    if n > 1:
        differ = records[1:] != records[:-1]
        shared[1:] = np.where(differ.any(1), differ.argmax(1), width)
    return shared, records[np.arange(width) >= shared[:, None]].tobytes()


def front_decode(shared: np.ndarray, rest: bytes, width: int) -> Iterator[tuple[int, bytes]]:
    """(shared length, row) of a front-coded run, one at a time."""
    row, at = b"", 0
    for k in shared.tolist():
        end = at + width - k
        row = row[:k] + rest[at:end]
        at = end
        yield k, row


def merge_runs(runs: list[Iterator[tuple[int, bytes]]]) -> Iterator[tuple[int, bytes, int]]:
    """(length shared with the output before, row, run) of sorted front-coded runs, by a loser tree.

    shared[r] is how much the head of run r shares with the last output. Of two heads the one that shares more is the
    lesser; only heads that share equally much are compared, from there on, and the loser then knows what it shares
    with the winner. Equal rows come out in the order of the runs.
    """
    k = len(runs)
    head: list[bytes | None] = [None] * k
    shared = [0] * k
    for r, run in enumerate(runs):
        got = next(run, None)
        if got:
            head[r] = got[1]

    def duel(a: int, b: int) -> tuple[int, int]:
        x, y = head[a], head[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        h = shared[a]
        if h != shared[b]:
            return (a, b) if h > shared[b] else (b, a)
        u, v = x[h:], y[h:]
        if u == v:
            first, second = (a, b) if a < b else (b, a)
            shared[second] = len(x)
            return first, second
        different = int.from_bytes(u) ^ int.from_bytes(v)
        same = h + len(u) - (different.bit_length() + 7) // 8
        if u < v:
            shared[b] = same
            return a, b
        shared[a] = same
        return b, a

    losers = [0] * k
    best = list(range(k))
    winners = {k + r: r for r in best}
    for node in range(k - 1, 0, -1):
        winners[node], losers[node] = duel(winners[2 * node], winners[2 * node + 1])
    w = winners[1] if k > 1 else 0
    while k and head[w] is not None:
        yield shared[w], head[w], w
        got = next(runs[w], None)
        shared[w], head[w] = got if got else (0, None)
        node = (k + w) // 2
        while node:
            w, losers[node] = duel(w, losers[node])
            node //= 2


def _records(data: bytes, anchor: np.ndarray, first: np.ndarray, windows: np.ndarray, length: int) -> np.ndarray:
    """A row of bytes for each run of windows: the suffix from its anchor, then what stands before it, backwards.

    Only bytes that the run's windows hold are there (zeros elsewhere), and both lengths.
    """
    raw = np.frombuffer(bytes(length) + data + bytes(length), np.uint8)
    span = length - KMER
    right, left = first + windows - 1 + length - anchor, anchor - first
    out = np.zeros((len(anchor), length + span + 2), np.uint8)
    cols = np.arange(length)
    for a in range(0, len(anchor), 1 << 14):
        at = slice(a, a + (1 << 14))
        base = (anchor[at] + length)[:, None]
        out[at, :length] = np.where(cols < right[at, None], raw[base + cols], 0)
        out[at, length + 1 : -1] = np.where(cols[:span] < left[at, None], raw[base - 1 - cols[:span]], 0)
    out[:, length] = right
    out[:, -1] = left
    return out


_RUN = pa.schema(
    [("block", pa.int64()), ("part", pa.int32()), ("alone", pa.bool_())]
    + [(c, pa.binary()) for c in ("shared", "rest", "least", "places", "windows", "entry")]
)
_RUN_SQL = "block long, part int, alone boolean, " + ", ".join(f"{c} binary" for c in ("shared", "rest", "least", "places", "windows", "entry"))


def _windows(data: bytes, at: np.ndarray, doc: np.ndarray, length: int, chunk: int = 1 << 17) -> tuple[np.ndarray, ...]:
    """The distinct windows of `length` bytes at these places, the least document of each, and which one every place has."""
    raw, kind = np.frombuffer(data, np.uint8), f"S{length}"
    found, which, n = [np.empty(0, kind)], [], 0
    for a in range(0, len(at), chunk):
        rows = np.ascontiguousarray(raw[at[a : a + chunk, None] + np.arange(length)]).view(kind).ravel()
        own, back = np.unique(rows, return_inverse=True)
        found.append(own)
        which.append(back + n)
        n += len(own)
    distinct, back = np.unique(np.concatenate(found), return_inverse=True)
    which = back[np.concatenate(which)] if which else np.empty(0, np.int64)
    least = np.full(len(distinct), LAST)
    np.minimum.at(least, which, doc)
    return distinct, least, which


def _window_runs(block: int, data: bytes, at: np.ndarray, doc: np.ndarray, length: int, parts: int) -> Iterator[dict]:
    """The distinct windows at these places as sorted front-coded runs of their own, dealt out by the windows' own hash."""
    distinct, least, which = _windows(data, at, doc, length)
    table = distinct.view(np.uint8).reshape(-1, length)
    h = np.zeros(len(table), np.uint64)
    for k in range(length):
        h = (h + table[:, k]) * np.uint64(0x9E3779B97F4A7C15)
    part = (mix64(h) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part[which], kind="stable")
    rank = np.empty(len(distinct), np.int64)
    for r in np.unique(part).tolist():
        mine = np.flatnonzero(part == r)
        rank[mine] = np.arange(len(mine))
        lo, hi = np.searchsorted(part[which[order]], [r, r + 1])
        places = order[lo:hi]
        lengths, rest = front_code(table[mine])
        yield (
            {"block": block, "part": r, "alone": True, "shared": dump(lengths), "rest": squeeze(rest), "least": dump(least[mine])}
            | {"places": dump_small(at[places]), "windows": dump_small(np.ones(len(places), np.int64)), "entry": dump_small(rank[which[places]])}
        )


def _bits_of(answers: list[dict], name: str) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.uint8), *(np.unpackbits(load(a[name]))[: a["n"]] for a in answers)]).astype(bool)


def range_of(table: np.ndarray, cuts: np.ndarray, times: np.ndarray) -> np.ndarray:
    """The key range of each sorted row of bytes. A cut that came out `times` times stands for a prefix that fills as many
    ranges; its rows are dealt to these by the rest of their k-mer, so equal k-mers stay together."""
    words = np.ascontiguousarray(table[:, :KMER]).view(">u8").astype(np.uint64)
    prefix = words[:, 0] >> np.uint64(1)
    part = np.searchsorted(cuts, prefix, "right")
    if len(cuts) and times.max() > 1:
        at = np.minimum(np.searchsorted(cuts, prefix), len(cuts) - 1)
        hot = np.flatnonzero((cuts[at] == prefix) & (times[at] > 1))
        rest = mix64(words[hot, 0] + mix64(words[hot, 1]) * np.uint64(3) + mix64(words[hot, 2]) * np.uint64(5))
        part[hot] = len(cuts) + 1 + (np.cumsum(times) - times)[at[hot]] + (rest % times[at[hot]].astype(np.uint64)).astype(np.int64)
    return part


def _send(cuts: np.ndarray, times: np.ndarray, bits: int, length: int, parts: int):
    """A block's suffixes that have partners, as sorted front-coded runs by key range.

    An entry is a distinct row of bytes with the least document of the block that holds it. Where the entries stand
    in the block travels along and comes back with the answer.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        answers = sorted(right.to_pylist(), key=lambda r: r["part"])
        shared, often = _bits_of(answers, "shared"), _bits_of(answers, "often")
        for row in left.to_pylist():
            data, sizes, ids = _open(row)
            anchor, first, windows, h = anchors(data, sizes, length)
            which = np.unique(h >> np.uint64(64 - bits), return_inverse=True)[1]
            some = np.flatnonzero(often[which])
            if len(some):
                n = windows[some]
                at = np.repeat(first[some] - np.cumsum(n) + n, n) + np.arange(n.sum())
                holder = ids[np.searchsorted(np.cumsum(sizes), at, "right")]
                out.extend(_window_runs(row["block"], data, at, holder, length, parts))
            keep = np.flatnonzero(shared[which] & ~often[which])
            anchor, first, windows = anchor[keep], first[keep], windows[keep]
            doc = ids[np.searchsorted(np.cumsum(sizes), anchor, "right")]
            table = _records(data, anchor, first, windows, length)
            flat = table.view(f"S{table.shape[1]}").ravel()
            order = np.lexsort((doc, flat))
            same = flat[order][1:] == flat[order][:-1]
            entry_of = np.cumsum(np.concatenate([[0], ~same])) if len(order) else np.zeros(0, np.int64)
            heads = order[np.flatnonzero(np.concatenate([[True], ~same]))] if len(order) else order
            table = table[heads]
            part = range_of(table, cuts, times)
            dealt = np.argsort(part, kind="stable")
            table, least, part = table[dealt], doc[heads][dealt], part[dealt]
            place = np.empty(len(dealt), np.int64)
            place[dealt] = np.arange(len(dealt))
            again = np.argsort(place[entry_of], kind="stable")
            order, entry_of = order[again], place[entry_of][again]
            names, begin = np.unique(part, return_index=True)
            for r, a, b in zip(names.tolist(), begin, np.append(begin[1:], len(part)), strict=False):
                lo, hi = np.searchsorted(entry_of, [a, b])
                lengths, rest = front_code(table[a:b])
                out.append(
                    {"block": row["block"], "part": r, "alone": False, "shared": dump(lengths), "rest": squeeze(rest), "least": dump(least[a:b])}
                    | {"places": dump_small(first[order[lo:hi]]), "windows": dump_small(windows[order[lo:hi]])}
                    | {"entry": dump_small(entry_of[lo:hi] - a)}
                )
        give_back()
        return pa.Table.from_pylist(out, schema=_RUN)

    return run


_FOUND = pa.schema(
    [("block", pa.int64())] + [(c, pa.binary()) for c in ("places", "windows", "entry", "least", "odd", "odd_least")]
)
_FOUND_SQL = "block long, " + ", ".join(f"{c} binary" for c in ("places", "windows", "entry", "least", "odd", "odd_least"))


def _merge(length: int):
    """Merge a range's runs; find for every window of every entry the least document that holds it.

    `least` has a document for each entry all of whose windows have the same; the windows of the others (`odd`
    entries, marked by -1) follow one after another in `odd_least`.
    """
    span = length - KMER

    def resolve(group: list, least: list, odd: list) -> None:
        if len(group) == 1:
            _, doc, members = group[0]
            for r, i in members:
                least[r][i] = doc
            return
        holder: dict[bytes, int] = {}
        strings = []
        for row, doc, _ in group:
            right, left = row[length], row[-1]
            text = row[length + 1 : length + 1 + left][::-1] + row[:right]
            own = [text[i : i + length] for i in range(left + right - length + 1)]
            strings.append(own)
            for s in own:
                if holder.get(s, LAST) >= doc:
                    holder[s] = doc
        for (_, _, members), own in zip(group, strings, strict=True):
            got = [holder[s] for s in own]
            for r, i in members:
                if got.count(got[0]) == len(got):
                    least[r][i] = got[0]
                else:
                    least[r][i] = -1
                    odd[r].append((i, got))

    def alone(rows: list[dict]) -> list[dict]:
        """Answers for windows that came by their own hash: equal ones follow one another in the merge, one a block at most."""
        docs = [load(r["least"]).tolist() for r in rows]
        least = [[0] * len(d) for d in docs]
        place = [0] * len(rows)
        same: list[tuple[int, int]] = []
        best = LAST

        def settle() -> None:
            for r, i in same:
                least[r][i] = best
            same.clear()

        for shared, _, r in merge_runs([front_decode(load(x["shared"]), unsqueeze(x["rest"]), length) for x in rows]):
            if shared < length:
                settle()
                best = LAST
            best = min(best, docs[r][place[r]])
            same.append((r, place[r]))
            place[r] += 1
        settle()
        none = {"odd": dump_small(np.empty(0, np.int64)), "odd_least": dump(np.empty(0, np.int64))}
        return [
            {c: row[c] for c in ("block", "places", "windows", "entry")} | {"least": dump(np.array(x, np.int64))} | none
            for row, x in zip(rows, least, strict=True)
        ]

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["block"])
        out = alone([r for r in rows if r["alone"]])
        rows = [r for r in rows if not r["alone"]]
        width = length + span + 2
        docs = [load(r["least"]).tolist() for r in rows]
        least = [[0] * len(d) for d in docs]
        odd: list[list] = [[] for _ in rows]
        runs = [front_decode(load(r["shared"]), unsqueeze(r["rest"]), width) for r in rows]
        place = [0] * len(rows)
        group: list = []
        for shared, row, r in merge_runs(runs):
            i = place[r]
            place[r] = i + 1
            doc = docs[r][i]
            if shared == width:
                last = group[-1]
                last[1] = min(last[1], doc)
                last[2].append((r, i))
                continue
            if shared < KMER and group:
                resolve(group, least, odd)
                group = []
            group.append([row, doc, [(r, i)]])
        if group:
            resolve(group, least, odd)
        for r, row in enumerate(rows):
            odd[r].sort()
            flat = np.array([d for _, got in odd[r] for d in got], np.int64)
            out.append(
                {c: row[c] for c in ("block", "places", "windows", "entry")}
                | {"least": dump(np.array(least[r], np.int64)), "odd": dump_small(np.array([i for i, _ in odd[r]], np.int64))}
                | {"odd_least": dump(flat)}
            )
        give_back()
        return pa.Table.from_pylist(out, schema=_FOUND)

    return run


def _apply(length: int, as_text: bool):
    """Mark the bytes of every window whose least document is earlier than its own, and cut them out."""
    schema = _result(as_text)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            data, sizes, ids = _open(row)
            ends = np.cumsum(sizes)
            edges = np.zeros(len(data) + length + 1, np.int32)
            for found in right.to_pylist():
                at, windows, entry = (load(found[c]).astype(np.int64) for c in ("places", "windows", "entry"))
                least, odd = load(found["least"]), load(found["odd"]).astype(np.int64)
                doc = ids[np.searchsorted(ends, at, "right")]
                plain = (least[entry] < doc) & (least[entry] >= 0)
                np.add.at(edges, at[plain], 1)
                np.add.at(edges, at[plain] + windows[plain] - 1 + length, -1)
                some = np.flatnonzero(np.isin(entry, odd))
                if len(some):
                    n = np.zeros(len(least), np.int64)
                    n[entry] = windows
                    begin = np.cumsum(n[odd]) - n[odd]
                    count = windows[some]
                    step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                    value = load(found["odd_least"])[np.repeat(begin[np.searchsorted(odd, entry[some])], count) + step]
                    where = np.repeat(at[some], count) + step
                    hit = where[value < np.repeat(doc[some], count)]
                    np.add.at(edges, hit, 1)
                    np.add.at(edges, hit + length, -1)
            gone = np.cumsum(edges[: len(data)]) > 0
            raw = np.frombuffer(data, np.uint8)
            for i, more, a, b in zip(row["doc_ids"], row["carried"], (ends - sizes).tolist(), ends.tolist(), strict=True):
                step = np.diff(np.concatenate([[0], gone[a:b].astype(np.int8), [0]]))
                spans = np.stack([np.flatnonzero(step == 1), np.flatnonzero(step == -1)], 1)
                kept = raw[a:b][~gone[a:b]].tobytes()
                result = {"doc_id": i, "carried": more, "n_bytes": b - a, "kept": kept.decode("utf-8", "ignore") if as_text else kept}
                out.append(result | {"spans": [{"first": x, "end": y} for x, y in spans.tolist()]})
        give_back()
        return pa.Table.from_pylist(out, schema=schema)

    return run


_SPAN = pa.struct([("first", pa.int64()), ("end", pa.int64())])


def _result(as_text: bool) -> pa.Schema:
    kept = pa.string() if as_text else pa.binary()
    return pa.schema([("doc_id", pa.int64()), ("carried", pa.string()), ("n_bytes", pa.int64()), ("kept", kept), ("spans", pa.list_(_SPAN))])


def _result_sql(as_text: bool) -> str:
    kept = "string" if as_text else "binary"
    return f"doc_id long, carried string, n_bytes long, kept {kept}, spans array<struct<first: long, end: long>>"


def _splitters(blocks: DataFrame, parts: int, each: int = 64) -> np.ndarray:
    """The first 8 bytes (less a bit) of suffixes that split all suffixes into about equal parts, from regular samples.

    A prefix that fills several parts comes out several times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                data = unsqueeze(packed) + bytes(8)
                at = np.linspace(0, len(data) - 8, each).astype(np.int64)
                raw = np.frombuffer(data, np.uint8)[at[:, None] + np.arange(8)]
                value = (np.ascontiguousarray(raw).view(">u8").ravel() >> np.uint64(1)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(value)], ["prefix"])

    if parts < 2:
        return np.zeros(0, np.uint64)
    shares = [i / parts for i in range(1, parts)]
    got = blocks.select("data").mapInArrow(run, "prefix long").agg(F.percentile_approx("prefix", shares, 10 * parts)).first()[0]
    return np.array(got or [], np.int64).astype(np.uint64)


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 50,
    carry_col: str | None = None,
    block_bytes: int = 4 << 20,
    part_bytes: int = 8 << 20,
    group_places: int = 1 << 12,
    as_text: bool = False,
) -> DataFrame:
    """doc_id, carried (carry_col as text), n_bytes, kept (the bytes left) and spans (first and end of each removed run).

    With as_text, kept is text, without what is left of characters that were cut. The task that cuts decodes it, so that no
    second Python worker stands beside its own; idle workers stay with their executor and keep their memory.

    A byte goes if a string of `length` bytes that covers it also starts in a document with a smaller id; strings are
    judged on the input. Copies inside one document stay. A passage that many documents share costs one entry for
    each block of documents and context, whatever the number of copies. What shares a k-mer is compared as one group in
    memory; k-mers in more than group_places places send each of their windows as an entry of its own through the same
    merge instead, where equal ones stream by, so no group grows with the input. Ids are integers.

    Nulls: a null text is empty; a null id is later than every other, and rows without id don't remove from one another.
    Neither do rows with the same id. Texts shorter than `length` stay whole. An empty table gives no rows.
    """
    if length < KMER + 1 or length > 200:
        raise ValueError(f"length must be between {KMER + 1} and 200")
    spark = docs.sparkSession
    bounded_batches(spark)
    carried = F.col(carry_col).cast("string") if carry_col else F.lit(None).cast("string")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), carried.alias("carried")
    )
    blocks = blocks_of(rows, block_bytes)
    size, n = blocks.agg(F.coalesce(F.sum(F.octet_length("data")), F.lit(0)), F.count("*")).first()
    parts = max(min(partitions(spark), 4 * max(n, 1)), size // part_bytes, 1)
    bits = min(64, max(32, (size + 1).bit_length() + 12))
    asked = blocks.mapInArrow(_ask(parts, bits, length), "block long, part int, keys binary, many binary, times binary")
    shared = asked.groupBy("part").applyInArrow(_partners(group_places), "block long, part int, n long, shared binary, often binary")
    cuts, times = np.unique(_splitters(blocks, parts), return_counts=True)
    runs = blocks.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(_send(cuts, times, bits, length, parts), _RUN_SQL)
    found = runs.groupBy("part").applyInArrow(_merge(length), _FOUND_SQL)
    return blocks.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(_apply(length, as_text), _result_sql(as_text))
