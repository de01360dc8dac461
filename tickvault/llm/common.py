"""Helpers that the operators of this package share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Word separators: space and the five ASCII controls from tab to carriage return.
SEPARATORS = "[\\x20\\x09-\\x0D]+"


class Digests(dict):
    """64-bit hashes of words, each computed when it is first met; a worker keeps one, up to a size."""

    MOST = 200_000

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]):
        import numpy as np

        if len(self) > self.MOST:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), "u8", len(words))


DIGESTS = Digests()


#: Bytes that a writer of an intermediate table holds before it writes them.
ROW_GROUP = 16 << 20
#: Whether Spark removes the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Words of a text as an array; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")


def width(spark: SparkSession) -> int:
    """The number of shuffle partitions that the cluster asks for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def measured(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """(bytes of all texts, number of rows)."""
    return tuple(docs.agg(F.coalesce(F.sum(F.octet_length(text).cast("bigint")), F.lit(0)), F.count("*")).first())


def shards(spark: SparkSession, total: int, size: int, least: int = 4) -> int:
    """The number of shards of about `size` bytes; `least` for each shuffle partition at least."""
    return max(least * width(spark), -(-total // size))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or in tests a temporary one."""
    set_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not set_dir:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        set_dir = known.get() if known.isDefined() else None
    if not set_dir:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        set_dir = tempfile.mkdtemp(prefix="tickvault-")
        spark.conf.set("spark.checkpoint.dir", set_dir)
    return set_dir.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: its lineage ends there, so a lost executor costs no more than the tasks it ran.

    Nothing reads the shuffles of a written table again, so their files go with the write and do not pile up until the
    driver collects garbage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
