"""A training corpus from raw documents: quality rules, near-duplicates, repeated passages, benchmark leaks, packing.

run(spark, sf_dir) applies STAGES to the documents table. Each stage's rows are written as Parquet into the shared
folder and read again by the next. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rainspark.llm import decontaminate, packing, quality, similar, suffix_dedup
from rainspark.llm.common import stage

#: SQL can't express byte pair encoding or XXH64; tests hold the rows against a brute-force version.
ORACLE_SQL = None

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that every quality rule keeps."""
    return quality.apply_rules(docs, columns=COLUMNS, counts=False).filter("kept").select(COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each group of near-duplicates (five-word shingles, similarity 0.8 or more).

    SimHash fingerprints within four bits give the first links, by op5's pigeonring, and exact checks on whole sets of
    shingles follow: of those links, and for links of similar texts that lie further apart.
    Rows are told apart by id and text; of rows equal in both one stays. A null id comes after all others.
    """
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64("text").alias("text_hash"))
    rows = docs.select(*COLUMNS, key.alias("key"))
    groups = similar.similar_groups(rows, "key", "text", words=5, similarity=0.8, errors=4)
    first = groups.select(F.col("component_id").alias("key")).distinct()
    kept = rows.join(first, "key", "left_semi")
    again = rows.groupBy("key").count().filter("count > 1").select("key")  # only these rows are shuffled with their texts
    return kept.join(again, "key", "left_anti").unionByName(kept.join(again, "key", "left_semi").dropDuplicates(["key"])).select(COLUMNS)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 bytes or more that an earlier document holds.

    Characters cut at their middle go as a whole; a document of which nothing is left goes; n_chars is counted anew.
    The other columns travel with the text, so nothing is joined back.
    """
    rest = F.struct("lang", "source", "n_chars", F.col("text").isNull().alias("no_text"))
    rows = docs.select("doc_id", "text", F.to_json(rest).alias("rest"))
    left = suffix_dedup.remove_repeats(rows, length=50, carry_col="rest", as_text=True)
    whole = F.size("spans") == 0
    fields = F.from_json("carried", "lang string, source string, n_chars long, no_text boolean").alias("rest")
    left = left.select("doc_id", whole.alias("whole"), "kept", fields)
    text = F.when(~F.col("whole") | ~F.col("rest.no_text"), F.col("kept"))
    n_chars = F.when(F.col("whole"), F.col("rest.n_chars")).otherwise(F.length("kept").cast("long"))
    kept = left.filter(F.col("whole") | F.col("kept").rlike(r"[^\x20\x09-\x0D]"))
    return kept.select("doc_id", text.alias("text"), "rest.lang", "rest.source", n_chars.alias("n_chars"))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark table."""
    return decontaminate.decontaminate(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of at most 2048."""
    got = packing.pack(docs, packing.public_vocabulary(), window=2048, end_id=1)
    return got.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_dedup),
    ("repeated passages", passage_dedup),
    ("benchmark leaks", benchmark_leaks),
    ("packing", pack_windows),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
