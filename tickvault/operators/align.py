"""Aligning the streams of fields on time into sparse wide rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickvault.functions.book import side_scales

#: Fields of an order book. Fixed values.
BOOK_FIELDS = ("action", "asks", "bids", "checksum", "ts")


def wide(points: DataFrame, keys: Sequence[str], field: str, values: Mapping[str, Column], order: Column) -> DataFrame:
    """One row for each key that has a value of any field; an absent field is null.

    Resolves rewrites and aligns in a single shuffle: each field is the last value by order among the rows of that field."""
    made = [F.max_by(value, F.when(F.col(field) == name, order)).alias(name) for name, value in values.items()]
    return points.where(F.col(field).isin(*values)).groupBy(*keys).agg(*made)


def full_outer(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer alignment of two streams that have each key once."""
    return left.join(right, list(keys), "full")


#: Rows from which the scales of a dataset are taken, and the digits added to what they show.
SAMPLE_ROWS, SPARE_DIGITS = 10, 2


def book_scales(rows: DataFrame) -> DataFrame:
    """(inst_id, px_scale, sz_scale) from the first rows of each instrument by time; malformed sides do not count."""
    first = rows.withColumn("_n", F.row_number().over(Window.partitionBy("inst_id").orderBy("time_ns"))).where(F.col("_n") <= SAMPLE_ROWS)
    for side in ("asks", "bids"):
        first = first.withColumn(f"_{side}", side_scales(F.col(side)))
    top = lambda c: F.max(F.greatest(F.coalesce(F.col("_asks")[c], F.lit(0)), F.coalesce(F.col("_bids")[c], F.lit(0))))
    return first.groupBy("inst_id").agg((top("px") + SPARE_DIGITS).alias("px_scale"), (top("sz") + SPARE_DIGITS).alias("sz_scale"))
