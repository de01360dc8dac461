"""Last write wins: of all values of a key, the one that the total order puts last."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickvault.operators.ordered import numbered

#: Order of a source's kinds in one shard: a log overrides a stored file.
KINDS = {"tsm": 0, "wal": 1}


def _precedence(prefix: str = "") -> list[Column]:
    c = lambda name: F.col(prefix + name)
    kind = F.when(c("kind") == "wal", F.lit(KINDS["wal"])).otherwise(F.lit(KINDS["tsm"]))
    return [c("shard_id"), kind.alias("kind"), F.when(c("kind") == "wal", F.lit(0)).otherwise(c("generation")).alias("generation"), c("sequence"), c("source_id")]


def source_order(prefix: str = "") -> Column:
    """struct in precedence order, of the columns shard_id, kind, generation, sequence, source_id, pos. A log's generation does not count."""
    return F.struct(*_precedence(prefix), F.col(prefix + "pos"))


def read_order(sources: DataFrame, out: str = "rank") -> DataFrame:
    """Adds the place, from 0, at which a source (shard_id, kind, generation, sequence, source_id) is read out: the order of precedence, the last wins."""
    order = [f"_by_{i}" for i in range(len(_precedence()))]
    return numbered(sources.withColumns(dict(zip(order, _precedence()))), order, out).drop(*order)


def latest(df: DataFrame, keys: Sequence[str], order: Column | Sequence[str], form: str = "max_by") -> DataFrame:
    """One row for each key: the last in order.

    `max_by` combines on the map side, so a key that holds much of the data shuffles one row a task; `row_number` sorts each
    key's rows in one task and suits data already laid out by key. Both give the same rows where the order is total; among rows
    equal in it the result is one of them."""
    order = F.struct(*order) if not isinstance(order, Column) else order
    rest = [c for c in df.columns if c not in keys]
    if form == "row_number":
        w = Window.partitionBy(*keys).orderBy(order.desc())
        return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n").select(*keys, *rest)
    if form != "max_by":
        raise ValueError(f"no form {form}")
    last = F.max_by(F.struct(*rest), order).alias("_last")
    return df.groupBy(*keys).agg(last).select(*keys, *[F.col("_last")[c].alias(c) for c in rest])


def latest_points(points: DataFrame, form: str = "max_by") -> DataFrame:
    """Points of all sources, one a (inst_id, field, time_ns), by the precedence of their sources."""
    return latest(points, ["inst_id", "field", "time_ns"], source_order(), form)
