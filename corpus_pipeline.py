"""From raw documents to packed sequences, in stages that are each written as Parquet and read again.

Every stage but the last returns the columns of documents, whatever they are called. Of rows that are linked the one
with the least id stays (null ids last), so rows that repeat both id and text count as one document from the second
stage on; rows without a word are linked with nothing. Null texts are empty, and an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickvault.llm import jaccard, packing, quality, substring
from tickvault.llm.common import stored


def columns(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of documents out of the struct `row`."""
    return rows.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current policy."""
    return columns(quality.recorded(docs).where(quality.passes("v1")), docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents, the one with the least id."""
    stay = jaccard.clustered(docs).where("stays").groupBy("doc_id", "digest").agg((F.count_if(F.col("key").isNotNull()) > 1).alias("again"))
    stay = stay.select(F.col("doc_id").alias("id"), F.col("digest").alias("of"), "again")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("bigint").alias("doc"), F.xxhash64("text").alias("digest"))
    kept = lambda some: rows.join(some, F.col("doc").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("of")), "left_semi")
    return columns(kept(stay.where("not again")).unionByName(kept(stay.where("again")).dropDuplicates(["doc", "digest"])), docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what an earlier document or an earlier place has; texts that lose nothing stay as they are."""
    cut = substring.deduplicated(docs, carry=True)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    made = {"text": text.alias("text"), "n_chars": F.char_length(text).cast("bigint").alias("n_chars")}
    return cut.select(*[made[c] if c in made else F.col("row")[c].alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left, with their sequences."""
    return packing.packed(packing.pieces(docs)).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [("quality rules", quality_rules), ("n-gram Jaccard join", ngram_jaccard), ("substring dedup", substring_dedup), ("packing", pack)]

#: Tokens and packing are not SQL; the tests compare the pipeline with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
