"""Splitting an export into tasks: by a tag, by contract month, and by calendar month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickvault.functions import timeutil
from tickvault.functions.series import contract_month

#: Tags that a shard or a contract is looked for under, in this order. Fixed values.
PREFERRED_TAGS = ("instId", "instrument", "symbol")
CONTRACT_TAGS = ("instrument", "instId")


def tag_cardinality(rows: DataFrame) -> DataFrame:
    """(tag, n): exact numbers of distinct values of each tag in a map column `tags`."""
    return rows.select(F.explode("tags").alias("tag", "value")).groupBy("tag").agg(F.countDistinct("value").alias("n"))


def detect_tag(keys: DataFrame, explicit: str | None = None) -> str:
    """The tag to shard series (rows with a map `tags`) by: the explicit one; else a preferred one with several values;
    else the first that is unique for each series; else that with most values, the later name on ties; else the only one."""
    found = {r["tag"]: r["n"] for r in tag_cardinality(keys).collect()}  # a row a tag
    known = ", ".join(sorted(found)) or "<none>"
    if explicit is not None:
        if explicit not in found:
            raise ValueError(f"no tag {explicit}; there are: {known}")
        return explicit
    for tag in PREFERRED_TAGS:
        if found.get(tag, 0) > 1:
            return tag
    total = keys.count()
    if unique := sorted(t for t, n in found.items() if n == total):
        return unique[0]
    if many := [(n, t) for t, n in found.items() if n > 1]:
        return max(many)[1]
    if len(found) == 1:
        return next(iter(found))
    raise ValueError(f"no tag to shard by; there are: {known}")


def detect_contract_tag(keys: DataFrame, explicit: str | None = None) -> str:
    found = {r[0] for r in keys.select(F.explode(F.map_keys("tags"))).distinct().collect()}
    if explicit is not None:
        if explicit not in CONTRACT_TAGS or explicit not in found:
            raise ValueError(f"no contract tag {explicit}")
        return explicit
    for tag in CONTRACT_TAGS:
        if tag in found:
            return tag
    raise ValueError("no contract tag")


def tag_tasks(keys: DataFrame, tag: str) -> DataFrame:
    """(shard, series_key): a task for each value of the tag; a value that several series have is an error, and so is a series without it."""
    rows = keys.select(F.try_element_at("tags", F.lit(tag)).alias("shard"), "series_key")
    counts = rows.groupBy("shard").agg(F.count("*").alias("n"), F.min("series_key").alias("series_key"))
    fault = F.raise_error(F.concat(F.lit("shard without a series of its own: "), F.coalesce("shard", F.lit("<none>")))).cast("string")
    return counts.select(F.when((F.col("n") > 1) | F.col("shard").isNull(), fault).otherwise(F.col("shard")).alias("shard"), "series_key")


def contract_tasks(keys: DataFrame, tag: str) -> DataFrame:
    """(shard, regex): a task for each contract month."""
    month = contract_month(F.element_at("tags", tag))
    return keys.select(month.alias("m")).select(F.col("m.bucket").alias("shard"), F.col("m.regex").alias("regex")).distinct()


def expand(shards: DataFrame, start: Column, end: Column) -> DataFrame:
    """Each shard with each month window of [start, end): adds w_start, w_end and label."""
    rows = shards.withColumn("_w", F.explode(timeutil.month_windows(start, end)))
    return rows.select(*shards.columns, F.col("_w.w_start").alias("w_start"), F.col("_w.w_end").alias("w_end"), timeutil.window_label(F.col("_w.w_start"), F.col("_w.w_end")).alias("label"))


def by_month_first(tasks: DataFrame) -> DataFrame:
    return tasks.orderBy("w_start", "w_end", "shard")
