"""Last write wins over a stream.

Each micro-batch is resolved by itself and written as one delta, in a folder named by the batch: a batch that runs again
overwrites its own delta, so restarts leave nothing twice. A compaction writes what all deltas up to a number come to into
a base of that number, and leaves later deltas alone; deltas that the base has are deleted afterwards, and one that
is written again, by a batch that runs twice, adds nothing new. A read resolves the newest base and all deltas by the same order,
whatever order the files came in. No state is kept between batches, so none grows with the keys.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickvault.operators.lww import latest
from tickvault.sources import store

DELTA, BASE = "delta", "base"


def start(stream: DataFrame, target: str, keys: Sequence[str], order: Sequence[str], checkpoint: str, available_now: bool = True):
    """Runs the stream into `target`; with available_now it ends when what is there has been read."""

    def put(batch: DataFrame, number: int) -> None:
        latest(batch, keys, order).write.mode("overwrite").parquet(f"{target}/{DELTA}={number:012d}")

    writer = stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _numbers(spark: SparkSession, target: str, kind: str) -> list[int]:
    """Numbers of the finished deltas or bases, ascending."""
    return sorted(int(p.rpartition("/")[0].rpartition("=")[2]) for p in store.find(spark, target, "_SUCCESS") if re.search(rf"/{kind}=\d+/_SUCCESS$", p))


def _rows(spark: SparkSession, target: str, upto: int | None = None) -> DataFrame:
    """The newest base and all deltas that are there, up to a number."""
    found = {BASE: _numbers(spark, target, BASE)[-1:], DELTA: [n for n in _numbers(spark, target, DELTA) if upto is None or n <= upto]}
    if not any(found.values()):
        raise FileNotFoundError(f"{target} has no delta")
    kinds = [spark.read.option("basePath", target).parquet(*[f"{target}/{kind}={n:012d}" for n in some]).drop(kind) for kind, some in found.items() if some]
    return reduce(DataFrame.unionByName, kinds)


def current(spark: SparkSession, target: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last value of each key over the base and all deltas."""
    return latest(_rows(spark, target), keys, order)


def compact(spark: SparkSession, target: str, keys: Sequence[str], order: Sequence[str]) -> None:
    """Folds the base and all finished deltas into a new base; may run beside the stream, and again after a crash."""
    deltas = _numbers(spark, target, DELTA)
    bases = _numbers(spark, target, BASE)
    if not deltas:
        return
    last = max(deltas[-1], *(n + 1 for n in bases[-1:]), 0)
    latest(_rows(spark, target, deltas[-1]), keys, order).write.mode("overwrite").parquet(f"{target}/{BASE}={last:012d}")
    for kind, numbers in ((DELTA, deltas), (BASE, bases)):
        for n in numbers:
            store.delete(spark, f"{target}/{kind}={n:012d}")


def incremental(points: DataFrame, marks: DataFrame, keys: Sequence[str], time: str = "time_ns") -> DataFrame:
    """Points later than the high-water mark of their key (column `mark`); keys without one are new as a whole."""
    joined = points.join(marks, list(keys), "left")
    return joined.where(F.col("mark").isNull() | (F.col(time) > F.col("mark"))).drop("mark")
