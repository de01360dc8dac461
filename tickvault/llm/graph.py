"""Joins whose hot keys are spread, and connected components of a graph that is spread over the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickvault.llm.common import stored, width

#: A key with fewer rows is never hot.
FEW = 1000
#: Tasks that the rows of one key are dealt to.
SALTS = 8


def hot_keys(rows: DataFrame, key: str, one_in: int = 1) -> list[int]:
    """The keys with the most rows, two for each shuffle partition at most; `rows` may be one in so many of those meant.

    Which keys are hot only says how rows travel, never what comes of them."""
    counts = rows.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > max(FEW // one_in, 8))
    return [r[key] for r in counts.orderBy(F.col("n").desc(), key).limit(2 * width(rows.sparkSession)).collect() if r[key] is not None]


def parted(rows: DataFrame, key: str, hot: list[int]) -> tuple[DataFrame, DataFrame]:
    """(rows of other keys, rows of hot keys)."""
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))  # two keys a shuffle partition at most
    return rows.where(~is_hot), rows.where(is_hot)


def matched(rows: DataFrame, key: str, known: DataFrame, hot: list[int], how: str = "left") -> DataFrame:
    """rows joined with `known`, which has one row a key: rows of a hot key stay where they are and meet a broadcast of its row."""
    if not hot:
        return rows.join(known, key, how)
    (others, many), (rest, few) = parted(rows, key, hot), parted(known, key, hot)
    return others.join(rest, key, how).unionByName(many.join(F.broadcast(few), key, how))


def salted(rows: DataFrame, key: str, known: DataFrame, by: str, how: str = "inner") -> DataFrame:
    """rows joined with `known`, which has one short row a key and is copied to SALTS tasks; the rows of a key are dealt to these by another column."""
    copies = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64(by, F.lit("salt")), F.lit(SALTS)).cast("int")).join(copies, [key, "salt"], how).drop("salt")


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the least id that can be reached, for each id of (a bigint, b bigint).

    Each round replaces an edge's ends by the least ids known to be connected with them, so chains shorten by half at
    least as fast as labels spread. Messages are minima and combine before they are shuffled; edges of a hub, and members
    of a large component, are spread by salt. Each round's labels are written, and the rounds end when no label changes."""
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("id")).agg(F.least(F.col("a"), F.min("b")).alias("component")), "labels")
    while True:
        near = salted(both, "b", labels.withColumnRenamed("id", "b"), "a").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near"))
        # what a neighbour knows is told to the old label as well, so that whole trees move at once
        told = labels.join(near, "id").select(F.col("component").alias("id"), "near").groupBy("id").agg(F.min("near").alias("told"))
        spread = labels.join(near, "id").join(told, "id", "left").select("id", F.col("component").alias("was"), F.least("component", "near", "told").alias("component"))
        roots = spread.select(F.col("id").alias("component"), F.col("component").alias("root"))
        new = stored(salted(spread, "component", roots, "id", "left").select("id", "was", F.least("component", "root").alias("component")), "labels")
        done = new.where("was <> component").isEmpty()
        labels = new.select("id", "component")
        if done:
            return labels
