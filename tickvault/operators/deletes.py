"""Deletes as range anti-joins. A join on the series is an equi join, which Catalyst plans by size; only the range is left to test."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def without_tombstones(points: DataFrame, tombstones: DataFrame, on: Sequence[str] = ("source_id", "series", "field"), time: str = "time_ns") -> DataFrame:
    """Points that no tombstone of their own source covers; min_time and max_time count in."""
    p, t = points.alias("p"), tombstones.alias("t")
    same = [F.col(f"p.{c}") == F.col(f"t.{c}") for c in on]
    inside = F.col(f"p.{time}").between(F.col("t.min_time"), F.col("t.max_time"))
    cond = inside
    for c in same:
        cond = cond & c
    return p.join(t, cond, "left_anti")


def without_later_deletes(writes: DataFrame, deletes: DataFrame, on: Sequence[str] = ("source_id", "series", "field"), time: str = "time_ns", seq: str = "seq") -> DataFrame:
    """Values of a log that no later entry of it deletes; a delete without a range has nulls for it and covers all times."""
    w, d = writes.alias("w"), deletes.alias("d")
    cond = (F.col(f"d.{seq}") > F.col(f"w.{seq}")) & (F.col("d.min_time").isNull() | (F.col(f"w.{time}") >= F.col("d.min_time"))) & (F.col("d.max_time").isNull() | (F.col(f"w.{time}") <= F.col("d.max_time")))
    for c in on:
        cond = cond & (F.col(f"w.{c}") == F.col(f"d.{c}"))
    return w.join(d, cond, "left_anti")
