"""Assign rows to shards with jump consistent hashing (Lamping and Veach, 2014)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rainspark.llm.common import partitions, stage


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each unsigned 64-bit key, for all keys at once; no ring table is kept.

    A key jumps from candidate shard to candidate shard until it would leave [0, shards). Going from n to n + 1
    shards a key either stays or moves to shard n, and about 1 / (n + 1) of the keys move.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    state = keys.astype(np.uint64, copy=True)
    shard = np.zeros(len(state), np.int64)
    ahead = np.zeros(len(state), np.int64)
    active = np.arange(len(state))
    while len(active):
        shard[active] = ahead[active]
        state[active] = state[active] * np.uint64(2862933555777941757) + np.uint64(1)
        unit = ((state[active] >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
        ahead[active] = np.floor((shard[active] + 1) * (float(1 << 31) / unit)).astype(np.int64)
        active = active[ahead[active] < shards]
    return shard


def jump_shard(key: Column, shards: int) -> Column:
    """Column form of jump_hash for a long column without nulls."""

    @F.pandas_udf("int")
    def assign(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for keys in batches:
            yield pd.Series(jump_hash(keys.to_numpy(np.int64).view(np.uint64), shards).astype(np.int32))

    return assign(key)


def shard_rows(df: DataFrame, id_col: str, text_col: str, shards: int = 8, buckets: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard, grown_shard (with one more shard) and slot (gapless in the shard) of every row.

    Only the id and the number of shards decide the shard. Slots come from a two-level rank: rows are numbered inside
    (shard, bucket) and each bucket starts where the ones before it end, so no task ever orders a whole shard.
    The table of bucket sizes has shards x buckets rows at most, whatever the input, and is broadcast.

    Nulls: a null text has no bytes (size 1, crc32 0); rows with a null id share one shard. Repeated rows each get
    a slot of their own. Empty tables give no rows. Other columns of df are ignored.
    """
    buckets = buckets or partitions(df.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    key = F.xxhash64("doc_id")
    rows = (
        rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_crc32", F.lit("bucket")), F.lit(buckets)))
        .withColumn("shard", jump_shard(key, shards))
        .withColumn("grown_shard", jump_shard(key, shards + 1))
    )
    rows = stage(rows, "shards")  # narrow rows, so that texts are read and hashed once
    sizes = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("rank", F.row_number().over(inside))
        .join(F.broadcast(starts), ["shard", "bucket"])
        .select(
            "doc_id", "size", "text_crc32", "shard", "grown_shard", (F.col("start") + F.col("rank") - 1).alias("slot")
        )
    )
