"""Ordered operators: numbering, samples, runs and comparisons by position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranges(df: DataFrame, order: Sequence[str], out: str = "_range") -> DataFrame:
    """Adds the number of a row's range in the order. Where the ranges begin is found once, a row a shuffle partition, so the number of a row never depends on how a plan is run."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.struct(*order)
    lows = df.select(*order).repartitionByRange(n, *order).groupBy(F.spark_partition_id()).agg(F.min(key).alias("low")).select("low")
    bounds = spark.createDataFrame([([r["low"] for r in lows.collect()],)], lows.select(F.array("low").alias("_lows")).schema)
    at = F.size(F.filter("_lows", lambda low: low <= key))
    return df.crossJoin(F.broadcast(bounds)).withColumn(out, at).drop("_lows")


def numbered(df: DataFrame, order: Sequence[str], out: str = "row_no") -> DataFrame:
    """Row numbers from 0 in a total order of columns, nulls first, without a single task for all rows: ranges of the order are numbered apart, after the counts of the ranges before them."""
    dealt = ranges(df, order)
    counts = dealt.groupBy("_range").agg(F.count("*").alias("_c"))
    before = F.coalesce(F.sum("_c").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(F.col("_range").alias("_r"), before.alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    rows = dealt.withColumn("_in", inside)
    return rows.join(F.broadcast(counts), rows["_range"] == counts["_r"]).withColumn(out, F.col("_before") + F.col("_in")).drop("_range", "_r", "_before", "_in")


def parts(df: DataFrame, order: Sequence[str | Column], rows_per_part: int, by: Sequence[str] = ()) -> DataFrame:
    """Adds part_no: how many full parts come before a row, within each `by`, or over all rows."""
    if by:
        rn = F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1
        return df.withColumn("part_no", F.floor(rn / rows_per_part).cast("bigint"))
    return numbered(df, order).withColumn("part_no", F.floor(F.col("row_no") / rows_per_part).cast("bigint")).drop("row_no")


def first_rows(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], n: int) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_n") <= n).drop("_n")


def sample_ranks(df: DataFrame, by: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first, the middle and the last row of each group, with their rank from 0."""
    w = Window.partitionBy(*by)
    ranked = df.withColumn("sample_rank", F.row_number().over(w.orderBy(*order)) - 1).withColumn("_n", F.count("*").over(w))
    last = F.col("_n") - 1
    return ranked.where((F.col("sample_rank") == 0) | (F.col("sample_rank") == F.floor(F.col("_n") / 2)) | (F.col("sample_rank") == last)).drop("_n")


def random_ranks(total: int, n: int, seed: int) -> list[int]:
    """First, last and middle of `total` ranks, and n others by seed."""
    import random

    fixed = {0, total - 1, total // 2} if total else set()
    return sorted(fixed | set(random.Random(seed).sample(range(total), min(n, total))))


def not_increasing(df: DataFrame, by: Sequence[str], time: str, order: Sequence[str | Column]) -> DataFrame:
    """Rows whose time is not later than that of the row before."""
    before = F.lag(time).over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("previous", before).where(F.col("previous") >= F.col(time))


def runs(df: DataFrame, by: Sequence[str], value: str, order: Sequence[str | Column]) -> DataFrame:
    """Adds run_id: how many times the value has changed so far, from 0."""
    w = Window.partitionBy(*by).orderBy(*order)
    changed = F.coalesce((~F.lag(value).over(w).eqNullSafe(F.col(value))).cast("int"), F.lit(0))
    first = F.row_number().over(w) == 1
    return df.withColumn("_c", F.when(first, F.lit(0)).otherwise(changed)).withColumn("run_id", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_c")


def gaps(df: DataFrame, by: Sequence[str], number: str, first: int = 0) -> DataFrame:
    """Rows of distinct numbers that do not continue first, first + 1, and so on."""
    rows = df.select(*by, number).distinct()
    expected = F.row_number().over(Window.partitionBy(*by).orderBy(number)) - 1 + first
    return rows.withColumn("expected", expected).where(F.col("expected") != F.col(number))


def compare_by_position(left: DataFrame, right: DataFrame, order: Sequence[str | Column], columns: Sequence[str]) -> DataFrame:
    """(n_left, n_right, first_mismatch): the first place at which two streams differ, by value or by length; null if none."""
    a = numbered(left.select(*columns), order).select(F.col("row_no").alias("rn"), F.struct(*columns).alias("x"))
    b = numbered(right.select(*columns), order).select(F.col("row_no").alias("rn"), F.struct(*columns).alias("y"))
    both = a.join(b, "rn", "full")
    return both.agg(F.count("x").alias("n_left"), F.count("y").alias("n_right"), F.min(F.when(~F.col("x").eqNullSafe(F.col("y")), F.col("rn"))).alias("first_mismatch"))
