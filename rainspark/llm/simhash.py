"""Near-duplicates by SimHash, with pigeonring filtering of candidates (Qin and Xiao, 2018)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainspark.llm.blobs import give_back
from rainspark.llm.common import bounded_batches, partitions, stage
from rainspark.llm.graph import components

BITS = 64


def fingerprint(text: str | None, words: int, seed: int = 42, chunk: int = 1 << 16) -> int:
    """The 64 majority bits of the XXH64 of all word shingles (repeats count); zero for a text without words."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    joined, width = b" ".join(tokens), min(words, len(tokens))
    ends = (np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1).tolist()
    starts = [0, *(e + 1 for e in ends[: len(tokens) - width])]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], seed) for s, e in zip(starts, ends[width - 1 :], strict=True)], np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), chunk):
        octets = hashes[at : at + chunk].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """doc_id and fingerprint (as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = np.array([fingerprint(x, words) for x in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got)], ["doc_id", "fp"])
        give_back()

    bounded_batches(df.sparkSession)
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], T.StructField("fp", T.LongType())]))


def segments(errors: int) -> list[tuple[int, int]]:
    """(first bit, width) of errors + 1 segments on the ring of 64 bits."""
    n = errors + 1
    edges = [round(i * BITS / n) for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _part(fp: Column, first: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def stars(fps: DataFrame, errors: int) -> DataFrame:
    """Links (a, b) from the least of each group of distinct fingerprints that agree outside one run of `errors` bits.

    Such fingerprints are all linked to one another, so a star stands for them; a group has 2^errors members at most.
    """
    width = min(errors, 8)
    masks = [((1 << min(width, BITS - at)) - 1) << at for at in range(0, BITS, width)]
    keys = F.array(*(F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(_signed(~m))).alias("key")) for i, m in enumerate(masks)))
    groups = fps.select("fp", F.inline(keys)).groupBy("i", "key").agg(F.min("fp").alias("a"), F.collect_list("fp").alias("all"))
    return groups.filter(F.size("all") > 1).select("a", F.explode("all").alias("b")).filter("a <> b")


def _signed(bits: int) -> int:
    bits &= (1 << 64) - 1
    return bits - (1 << 64) if bits >> 63 else bits


def links(fps: DataFrame, errors: int) -> DataFrame:
    """All pairs a < b of distinct fingerprints (column fp) that differ in `errors` bits at most.

    If fps has a column `label`, pairs with equal labels are known to be connected and are left out.

    Of m = errors + 1 segments on a ring, some chain that starts at segment i has at most floor(l * errors / m)
    differences in its first l segments, for every l. For l = 1 that is none and for l = 2 one: a fingerprint is
    listed once per i under the two segments, and looked up under their exact value and each value one bit away in
    the second. The budgets for longer chains prune what meets there, before the full Hamming check. Nothing is capped.
    """
    ring = segments(errors)
    m = len(ring)
    if errors < 1:
        raise ValueError("links() is for distinct fingerprints; equal ones need no search")

    def key(i: int, flip: int = 0) -> Column:
        (p, w), (q, v) = ((at, min(size, 28)) for at, size in (ring[i], ring[(i + 1) % m]))
        second = _part(F.col("fp"), q, v).bitwiseXOR(F.lit(flip).cast("long"))
        return F.struct(
            (F.lit(i).cast("long") * (1 << 56) + _part(F.col("fp"), p, w) * (1 << v) + second).alias("key"),
            F.lit(i).alias("start"),
        )

    def budget(i: int) -> Column:
        x = F.col("a").bitwiseXOR(F.col("b"))
        ok, total = F.lit(True), F.lit(0)
        for n in range(1, m):
            total = total + F.bit_count(_part(x, *ring[(i + n - 1) % m]))
            if n > 2:
                ok = ok & (total <= n * errors // m)
        return (F.col("start") == i) & ok

    flips = [(i, f) for i in range(m) for f in [0, *(1 << b for b in range(min(ring[(i + 1) % m][1], 28)))]]
    if "label" not in fps.columns:
        fps = fps.select("fp", F.col("fp").alias("label"))
    fps = fps.repartition(partitions(fps.sparkSession), "fp")  # few bytes now, many rows below
    looked = fps.select(F.col("fp").alias("a"), F.col("label").alias("label_a"), F.inline(F.array(*(key(i, f) for i, f in flips))))
    listed = fps.select(F.col("fp").alias("b"), F.col("label").alias("label_b"), F.inline(F.array(*(key(i) for i in range(m))))).withColumnRenamed(
        "start", "listed_start"
    )
    chain = budget(0)
    for i in range(1, m):
        chain = chain | budget(i)
    near = (F.col("a") < F.col("b")) & (F.col("label_a") != F.col("label_b")) & chain & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= errors)
    return looked.join(listed, (looked["key"] == listed["key"]) & near).select("a", "b", "label_a", "label_b")


def labelled(fps: DataFrame, found: DataFrame) -> DataFrame:
    """fps (distinct fingerprints) with label, the name of the group that the found stars connect; written to the shared folder."""
    dense = components(found).select(F.col("node").alias("fp"), F.col("component").alias("label"))
    return stage(fps.join(dense, "fp", "left").withColumn("label", F.coalesce("label", "fp")), "labelled")


def spanning_links(fps: DataFrame, errors: int) -> DataFrame:
    """Links a < b that connect what all links connect: the stars, and one link for each two groups of stars that have any."""
    found = stage(stars(fps, errors), "stars")
    between = links(labelled(fps, found), errors).groupBy(F.least("label_a", "label_b"), F.greatest("label_a", "label_b"))
    return found.unionByName(between.agg(F.min(F.struct("a", "b")).alias("link")).select("link.a", "link.b"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, errors: int = 4) -> DataFrame:
    """doc_id, fp and component_id (the least doc_id that links reach) of every row.

    Equal fingerprints are one node, so a group of copies costs one row in the search, and membership is joined back.
    Dense groups are contracted by stars first, so that the search lists links between groups, not all pairs in one.
    Nulls: a null text has no words and fingerprint zero, linked like any other; a null id takes part, but names a
    component only if no other id is in it. The id may be of any ordered type. Repeated rows share a component. An empty table gives no rows.
    """
    rows = stage(fingerprints(df, id_col, text_col, words), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    if errors:
        nodes = stage(nodes, "distinct")
        nodes = labelled(nodes, stars(nodes, errors))
        pairs = links(nodes.select("fp", "label"), errors).select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))
        joined = components(pairs).withColumnRenamed("node", "label")
        nodes = nodes.join(joined, "label", "left").withColumn("component", F.coalesce("component", "label"))
    else:
        nodes = nodes.withColumn("component", F.col("fp"))
    low = nodes.groupBy("component").agg(F.min("least").alias("component_id"))
    named = nodes.join(low, "component").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")
