"""Groups of texts whose word shingles have a Jaccard similarity of 0.8 or more, by pigeonring and prefix filtering.

The first links are those of SimHash fingerprints on their ring of segments (simhash.py), checked on whole sets. At that
similarity the 64 majority bits differ in about ten places and texts that only share passages reach as near, so a budget
that can be searched reaches some of the links. The others are looked for between the groups so far, on a second ring,
whose segments are the positions of a min-wise signature: two texts differ at each with a probability of one minus
their similarity.

Signatures may lie further apart than the budget by chance. So what the ring has connected is contracted, and an exact
search goes over the rest: of two similar sets, the n - ceil(similarity * n) + 1 rarest shingles of each (n its size) have one in common.

Two filters without loss stand in every join. A link joins different labels, so of the sets under one key only those
outside its most frequent label are looked up. And a bitmap of parities differs in no more places than the sets do
(Sandes, Teodoro, Melo, 2017), so most pairs that are near but below the limit never leave the join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainspark.llm.blobs import dump, dump_sorted, give_back, load, load_sorted, range_cuts, squeeze, unsqueeze
from rainspark.llm.common import bounded_batches, discard, mix64, partitions, stage
from rainspark.llm.graph import components
from rainspark.llm.simhash import fingerprint, spanning_links

#: Positions of a signature, and positions after a key whose low bytes travel with it.
POSITIONS, AHEAD = 32, 8
#: Words of 64 bits in a bitmap of parities.
BITMAP = 4
SKETCH = [f"bits{k}" for k in range(BITMAP)]
_PRIMES = mix64(np.arange(1, POSITIONS + 64, dtype=np.uint64) << np.uint64(7)) | np.uint64(1)


def budget_of(similarity: float, missed: float = 0.05) -> int:
    """Differences that a link's signatures may have: more than that come with a probability of `missed` at most."""
    left, chance = 1.0, 1 - similarity
    for differ in range(POSITIONS - 1):
        left -= math.comb(POSITIONS, differ) * chance**differ * similarity ** (POSITIONS - differ)
        if left <= missed:
            return differ
    return POSITIONS - 1


def chain_of(budget: int) -> int:
    """Positions of a key: the most for which a proportional budget leaves no difference."""
    return (POSITIONS - 1) // max(budget, 1)


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """The distinct 64-bit hashes of all word shingles, sorted; fewer words are one shingle, none is no shingle."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    width = min(words, len(tokens))
    one = np.fromiter(map(xxhash.xxh64_intdigest, tokens), np.uint64, len(tokens))
    n = len(one) - width + 1
    total = np.full(n, width, np.uint64)
    for k in range(width):
        total = total * _PRIMES[POSITIONS] + mix64(one[k : k + n])
    return np.unique(mix64(total))


def signature(hashes: np.ndarray, chunk: int = 1 << 12) -> np.ndarray:
    """The least value of the hashes under each of POSITIONS multiplications."""
    least = np.full(POSITIONS, np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), chunk):
        np.minimum(least, (hashes[at : at + chunk, None] * _PRIMES[:POSITIONS]).min(0), out=least)
    return mix64(least)


def parities(hashes: np.ndarray) -> np.ndarray:
    """For each of 64 * BITMAP places whether an odd number of hashes falls there, as signed 64-bit words."""
    odd = np.bincount((hashes >> np.uint64(40)).astype(np.int64) % (64 * BITMAP), minlength=64 * BITMAP) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def signed_rows(df: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """doc_id, fp, node (a hash of the set of shingles: equal sets are one node), n (size), bits and sig of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, node, n, bits, sigs = [], [], [], [], []
            for cell in batch.column(1):
                text = cell.as_py()
                hashes = shingle_hashes(text, words)
                fps.append(fingerprint(text, words))
                node.append(node_of(hashes))
                n.append(len(hashes))
                bits.append(parities(hashes))
                sigs.append((signature(hashes) >> np.uint64(33)).astype(np.int32))
            flags = np.array(bits, np.int64).reshape(-1, BITMAP)
            cols = [batch.column(0), pa.array(np.array(fps, np.uint64).view(np.int64)), pa.array(node, pa.int64()), pa.array(n, pa.int32())]
            cols += [*(pa.array(np.ascontiguousarray(flags[:, k])) for k in range(BITMAP)), _lists(sigs, pa.int32())]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "fp", "node", "n", *SKETCH, "sig"])
        give_back()

    bounded_batches(df.sparkSession)
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    fields = T.StructType([rows.schema["doc_id"]]).add("fp", T.LongType()).add("node", T.LongType()).add("n", T.IntegerType())
    for c in SKETCH:
        fields.add(c, T.LongType())
    return rows.mapInArrow(run, fields.add("sig", T.ArrayType(T.IntegerType())))


def node_of(hashes: np.ndarray) -> int:
    """The name of a set of shingles, as a signed 64-bit integer."""
    return int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes())).astype(np.int64))


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    return pa.array(values, pa.list_(kind))


def _chain(a: Column, b: Column, budget: int) -> Column:
    """The first l positions of a chain differ in floor(l * budget / POSITIONS) places at most, as far as bytes travel."""
    x, total, ok = a.bitwiseXOR(b), F.lit(0), F.lit(True)
    for k in range(AHEAD):
        total = total + (F.shiftrightunsigned(x, 8 * k).bitwiseAND(F.lit(255)) != 0).cast("int")
        ok = ok & (total <= (chain_of(budget) + k + 1) * budget // POSITIONS)
    return ok


def _can_link(similarity: float) -> Column:
    """Sizes and bitmaps of columns with the suffixes _a and _b allow the similarity; no link fails this."""
    total = F.col("n_a") + F.col("n_b")
    differ = sum((F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in SKETCH), F.lit(0))
    sized = F.least("n_a", "n_b") >= similarity * F.greatest("n_a", "n_b") - 1e-9
    return sized & (differ <= (1 - similarity) / (1 + similarity) * total + 1e-6)


def ring(nodes: DataFrame, chain: int) -> DataFrame:
    """start, key, ahead, before and node for every start on a node's ring, where another node has the same key.

    key is a hash of the start and `chain` positions, before that of the start one earlier, and ahead has the low bytes
    of the AHEAD positions behind the chain. One shuffle of narrow rows; keys of one node go before anything is joined.
    """
    turns = F.concat("sig", F.slice("sig", 1, chain + AHEAD))
    rows = nodes.select("node", turns.alias("sig"), F.explode(F.sequence(F.lit(0), F.lit(POSITIONS - 1))).alias("start"))

    def key(start: Column) -> Column:
        return F.xxhash64(start, *(F.get("sig", start + k) for k in range(chain)))

    ahead = F.lit(0).cast("long")
    for k in range(AHEAD):
        low = F.get("sig", F.col("start") + chain + k).bitwiseAND(F.lit(255)).cast("long")
        ahead = ahead.bitwiseOR(F.shiftleft(low, 8 * k))
    before = key((F.col("start") + POSITIONS - 1) % POSITIONS)
    rows = rows.select("node", F.col("start").cast("byte").alias("start"), key(F.col("start")).alias("key"), ahead.alias("ahead"), before.alias("before"))
    return rows.withColumn("_n", F.count("*").over(Window.partitionBy("key"))).filter("_n > 1").drop("_n")


def _named(rows: DataFrame, end: str) -> DataFrame:
    return rows.select("key", *(F.col(c).alias(f"{c}_{end}") for c in rows.columns if c != "key"))


def star_pairs(rows: DataFrame, budget: int) -> DataFrame:
    """Pairs a < b of each node with one member of every key group that it is in, another order for every key."""
    first = rows.groupBy("key").agg(F.min_by(F.struct("node", "ahead"), F.xxhash64("node", "key")).alias("lead"))
    near = (F.col("node") != F.col("lead.node")) & _chain(F.col("ahead"), F.col("lead.ahead"), budget)
    met = rows.select("key", "node", "ahead").join(first, "key").filter(near)
    return met.select(F.least("node", "lead.node").alias("a"), F.greatest("node", "lead.node").alias("b")).distinct()


def apart(rows: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two sides whose join on key has every pair of rows with different labels once or twice, for keys of several labels.

    rows: key, node and more; labels: node, label and more. The left side is what is outside the most frequent label of
    its key: of two labels one is. Columns have the suffixes _a and _b (key and key_b); minor_b says whether a row of the
    right side is on the left one too. Sizes are counted on narrow rows, and only rows of mixed keys get the rest.
    """
    named = labels.select(F.col("node").alias("_node"), "label")
    sizes = rows.select("key", "node").join(named, F.col("node") == F.col("_node")).groupBy("key", "label").agg(F.count("*").alias("c"))
    most = sizes.groupBy("key").agg(F.max_by("label", F.struct("c", "label")).alias("most"), F.count("*").alias("labels"))
    mixed = stage(rows.join(most.filter("labels > 1").drop("labels"), "key").join(labels, "node"), "mixed")
    mixed = mixed.withColumn("minor", F.col("label") != F.col("most")).drop("most")
    return _named(mixed.filter("minor").drop("minor"), "a"), _named(mixed, "b").withColumnRenamed("key", "key_b")


def _other_label() -> Column:
    """Different labels; of two rows outside the most frequent label only one order."""
    return (F.col("label_a") != F.col("label_b")) & (~F.col("minor_b") | (F.col("node_a") < F.col("node_b")))


def open_pairs(rows: DataFrame, labels: DataFrame, budget: int, similarity: float) -> DataFrame:
    """All pairs a < b of a key group with different labels; a group of one label takes no part.

    labels: node, label, n and bits. A run of equal positions gives a key at each start; only its first one lists the
    pair (start 0 always does).
    """
    left, right = apart(rows, labels)
    fresh = (F.col("before_a") != F.col("before_b")) | (F.col("start_a") == 0)
    near = _other_label() & fresh & _can_link(similarity) & _chain(F.col("ahead_a"), F.col("ahead_b"), budget)
    met = left.join(right, (F.col("key") == F.col("key_b")) & near)
    return met.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def fingerprint_pairs(prints: DataFrame, labels: DataFrame, errors: int, similarity: float) -> DataFrame:
    """Pairs a < b of nodes that links of SimHash fingerprints connect and whose sizes and bitmaps allow the similarity.

    prints: fp and node, distinct. Nodes with equal fingerprints are paired with one of them, which stands for them on the ring.
    Between two groups of stars one link is taken; if its sets differ, the searches that follow look for others.
    """
    leads = stage(prints.groupBy("fp").agg(F.min("node").alias("lead")), "leads")
    near = spanning_links(leads.select("fp"), errors)
    for end in ("a", "b"):
        near = near.join(leads.select(F.col("fp").alias(end), F.col("lead").alias(f"lead_{end}")), end)
    equal = prints.join(leads, "fp").filter("node <> lead").select(F.col("lead").alias("lead_a"), F.col("node").alias("lead_b"))
    both = near.select("lead_a", "lead_b").union(equal).filter("lead_a <> lead_b")
    pairs = both.select(F.least("lead_a", "lead_b").alias("a"), F.greatest("lead_a", "lead_b").alias("b")).distinct()
    return _with_ends(pairs, labels, ["n", *SKETCH]).filter(_can_link(similarity)).select("a", "b")


def _with_ends(pairs: DataFrame, nodes: DataFrame, columns: list[str]) -> DataFrame:
    for end in ("a", "b"):
        pairs = pairs.join(nodes.select(F.col("node").alias(end), *(F.col(c).alias(f"{c}_{end}") for c in columns)), end)
    return pairs


def in_budget(pairs: DataFrame, nodes: DataFrame, labels: DataFrame, budget: int, similarity: float) -> DataFrame:
    """The pairs of different labels with signatures within the budget over the whole ring and bitmaps that allow the similarity."""
    pairs = _with_ends(pairs, labels, ["label", "n", *SKETCH]).filter((F.col("label_a") != F.col("label_b")) & _can_link(similarity))
    pairs = _with_ends(pairs.select("a", "b"), nodes, ["sig"])
    differ = F.size(F.filter(F.zip_with("sig_a", "sig_b", lambda x, y: x != y), lambda x: x))
    return pairs.filter(differ <= budget).select("a", "b")


def node_texts(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """node and the text that gives its set. Rows may be equal in id and text: one of them does."""
    return docs.join(nodes.select("node", F.col("least").alias("doc_id")), "doc_id").select("node", "text").dropDuplicates(["node"])


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, words: int, similarity: float) -> DataFrame:
    """The pairs whose sets of shingles are similar."""
    pairs = listed = stage(pairs, "pairs")
    ids = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_hashes(x.as_py(), words).view(np.int64) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(sets, pa.int64())], ["node", "shingles"])
        give_back()

    chosen = node_texts(nodes.join(ids, "node", "left_semi"), docs)
    sets = stage(chosen.mapInArrow(run, "node long, shingles array<long>"), "sets")
    for end in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("node").alias(end), F.col("shingles").alias(f"set_{end}")), end)
    both = F.size(F.array_intersect("set_a", "set_b"))
    either = F.size("set_a") + F.size("set_b") - both
    out = stage(pairs.filter(both >= similarity * either - 1e-9).select("a", "b"), "similar")
    discard(listed, sets)
    return out


_SETS = pa.schema([("sizes", pa.binary()), ("data", pa.binary())])


def _text_blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """Texts as compressed blocks of about block_bytes, written once to the shared folder. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data: list[bytes] = []
        size = 0

        def close() -> pa.RecordBatch:
            row = {"sizes": dump(np.array([len(x) for x in data], np.int64)), "data": squeeze(b"".join(data))}
            return pa.RecordBatch.from_pylist([row], schema=_SETS)

        for batch in batches:
            for text in batch.column(0):
                data.append((text.as_py() or "").encode("utf-8", "surrogatepass"))
                size += len(data[-1]) + 64
                if size >= block_bytes:
                    yield close()
                    data, size = [], 0
        if data:
            yield close()
        give_back()

    blocks = docs.select("text").mapInArrow(run, "sizes binary, data binary")
    return stage(blocks.withColumn("block", F.monotonically_increasing_id()), "blocks")


def _block_sets(row: dict, words: int) -> list[np.ndarray]:
    """The sets of a block's texts, equal ones once."""
    ends = np.cumsum(load(row["sizes"])).tolist()
    data = unsqueeze(row["data"])
    sets = [shingle_hashes(data[a:b].decode("utf-8", "surrogatepass"), words) for a, b in zip([0, *ends], ends, strict=False)]
    return list({x.tobytes(): x for x in sets}.values())


_COUNTS = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("keys", pa.binary()), ("times", pa.binary())])
_CLASSES = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("classes", pa.binary())])
_PREFIX = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("at", pa.int32())])


def prefixes(docs: DataFrame, words: int, similarity: float, block_bytes: int = 4 << 20) -> DataFrame:
    """key, node and at (place in the order) of the shingles in each set's prefix that another text has.

    The order is by the binary logarithm of the number of texts that hold a shingle (equal ones of a block count once),
    then by hash. The numbers come from an exchange of every block's distinct shingles by range, so frequent shingles stand
    last and single ones send nothing.
    """
    ranges = max(partitions(docs.sparkSession), 1)
    blocks = _text_blocks(docs, block_bytes)
    size, n = blocks.agg(F.coalesce(F.sum(F.octet_length("data")), F.lit(0)), F.count("*")).first()
    ranges = max(min(ranges, 4 * max(n, 1)), size // (2 << 20))

    def distinct(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(np.concatenate([*sets, np.empty(0, np.uint64)]), return_counts=True)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, times = distinct(_block_sets(row, words))
                cut = range_cuts(keys, ranges)
                for r in range(ranges):
                    if cut[r] == cut[r + 1]:
                        continue
                    at = slice(cut[r], cut[r + 1])
                    piece = [[row["block"]], [r], [dump_sorted(keys[at])], [dump(times[at].astype(np.uint32))]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(piece, _COUNTS.types, strict=True)], _COUNTS.names)
                give_back()

    def count(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        keys = [load_sorted(r["keys"]) for r in rows]
        _, which = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(which, np.concatenate([load(r["times"]) for r in rows]))
        classes = np.frexp(total)[1].astype(np.uint8) - np.uint8(1)
        classes[total == 1] = 0
        classes[total > 1] = np.maximum(classes[total > 1], 1)
        ends = np.cumsum([len(k) for k in keys])
        out = [{"block": r["block"], "part": r["part"], "classes": dump(classes[which[e - len(k) : e]])} for r, k, e in zip(rows, keys, ends, strict=True)]
        give_back()
        return pa.Table.from_pylist(out, schema=_CLASSES)

    def choose(left: pa.Table, right: pa.Table) -> pa.Table:
        answers = sorted(right.to_pylist(), key=lambda r: r["part"])
        answer = np.concatenate([np.zeros(0, np.uint8), *(load(r["classes"]) for r in answers)])
        cols: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(3)]
        for row in left.to_pylist():
            sets = _block_sets(row, words)
            keys = distinct(sets)[0]
            for own in sets:
                size = len(own)
                kind = answer[np.searchsorted(keys, own)]
                order = np.argsort(kind, kind="stable")[: size - math.ceil(similarity * size - 1e-9) + 1]
                at = np.flatnonzero(kind[order])
                for col, x in zip(cols, (own[order[at]].view(np.int64), np.full(len(at), node_of(own)), at), strict=True):
                    col.append(x)
        give_back()
        return pa.Table.from_arrays([pa.array(np.concatenate(c), t) for c, t in zip(cols, _PREFIX.types, strict=True)], schema=_PREFIX)

    asked = blocks.mapInArrow(ask, "block long, part int, keys binary, times binary")
    answers = asked.groupBy("part").applyInArrow(count, "block long, part int, classes binary")
    got = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(choose, "key long, node long, at int")
    out = stage(got.dropDuplicates(["key", "node"]), "prefixes")
    discard(blocks)
    return out


def prefix_pairs(rows: DataFrame, labels: DataFrame, similarity: float) -> DataFrame:
    """All pairs a < b of different labels that share a shingle of their prefixes and can be similar by size and place.

    At the first shingle that two sets share, they have no more in common than that one and what follows in both.
    """
    left, right = apart(rows, labels)
    most = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b"))
    placed = most >= similarity / (1 + similarity) * (F.col("n_a") + F.col("n_b")) - 1e-6
    met = left.join(right, (F.col("key") == F.col("key_b")) & _other_label() & placed & _can_link(similarity))
    return met.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def _linked(labels: DataFrame, found: DataFrame) -> DataFrame:
    """labels (node, label and more) with those that the found pairs join made one."""
    named = labels.select("node", "label")
    edges = found
    for end in ("a", "b"):
        edges = edges.join(named.select(F.col("node").alias(end), F.col("label").alias(f"label_{end}")), end)
    joined = components(edges.select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))).withColumnRenamed("node", "label")
    out = stage(labels.join(joined, "label", "left").withColumn("label", F.coalesce("component", "label")).drop("component"), "labelled")
    discard(found, labels, sweep=True)
    return out


def similar_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8, errors: int = 4) -> DataFrame:
    """doc_id and component_id (the least doc_id that links reach) of every row; a link is a Jaccard similarity of
    `similarity` or more between the sets of shingles.

    Every link is verified on whole sets. The first ones come from SimHash fingerprints that differ in `errors` bits at
    most. More are found as their signatures differ within a budget: some chain on the ring then keeps within proportional
    budgets, its first positions being equal. Dense groups are contracted by verified stars first, so the search for
    further links passes over pairs that are already connected. The others are found by a shingle that their sets share
    among the rarest, so no link between different groups is lost. Nothing is capped.

    The id must be unique unless rows are equal in text too; it may be of any ordered type and not null. Texts without
    words are one group, and so are texts with equal shingles. Repeated rows share a component. An empty table gives no rows.
    """
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    budget = budget_of(similarity)
    signed = stage(signed_rows(docs, "doc_id", "text", words), "signed")
    rows = signed.select("doc_id", "node")
    least = rows.groupBy("node").agg(F.min("doc_id").alias("least"))
    whole = signed.drop("doc_id", "fp").dropDuplicates(["node"]).join(least, "node")
    nodes = stage(whole, "nodes")
    labels = stage(nodes.select("node", "n", *SKETCH, F.col("node").alias("label")), "labelled")
    near = fingerprint_pairs(signed.select("fp", "node").distinct(), labels, errors, similarity)
    labels = _linked(labels, verified(near, nodes, docs, words, similarity))
    rings = stage(ring(nodes, chain_of(budget)), "rings")
    near = in_budget(star_pairs(rings, budget), nodes, labels, budget, similarity)
    labels = _linked(labels, verified(near, nodes, docs, words, similarity))
    near = in_budget(open_pairs(rings, labels, budget, similarity), nodes, labels, budget, similarity)
    labels = _linked(labels, verified(near, nodes, docs, words, similarity))
    discard(rings)
    listed = prefixes(docs, words, similarity)
    labels = _linked(labels, verified(prefix_pairs(listed, labels, similarity), nodes, docs, words, similarity))
    discard(listed, sweep=True)
    at = labels.select("node", "label").join(nodes.select("node", "least"), "node")
    low = at.groupBy("label").agg(F.min("least").alias("component_id"))
    return rows.join(at.join(low, "label").select("node", "component_id"), "node").select("doc_id", "component_id")
