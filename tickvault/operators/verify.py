"""Checks of one dataset against another. Each gives the rows at fault, or a row that tells the first fault."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickvault.functions import book, decimalx
from tickvault.operators import lww, ordered


def manifest_diff(old: DataFrame, new: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Keys of both sides with their state (same, differ, old_only, new_only) and both values."""
    a = old.select(*keys, *[F.col(v).alias(f"old_{v}") for v in values], F.lit(True).alias("_a"))
    b = new.select(*keys, *[F.col(v).alias(f"new_{v}") for v in values], F.lit(True).alias("_b"))
    differ = F.lit(False)
    for v in values:
        differ = differ | ~F.col(f"old_{v}").eqNullSafe(F.col(f"new_{v}"))
    state = F.when(F.col("_b").isNull(), "old_only").when(F.col("_a").isNull(), "new_only").when(differ, "differ").otherwise("same")
    return a.join(b, list(keys), "full").select(*keys, state.alias("state"), *[f"{side}_{v}" for v in values for side in ("old", "new")])


def first_difference(left: DataFrame, right: DataFrame, at: str = "at") -> DataFrame:
    """(n_left, n_right, first_mismatch) of rows (at, x) and (at, y) that are numbered alike."""
    both = left.join(right, at, "full")
    return both.agg(F.count("x").alias("n_left"), F.count("y").alias("n_right"), F.min(F.when(~F.col("x").eqNullSafe(F.col("y")), F.col(at))).alias("first_mismatch"))


KEYS = ["inst_id", "field", "time_ns"]


def merge_faults(sources: DataFrame, merged: DataFrame, value: str = "payload") -> DataFrame:
    """Points of the merged table that differ from what the sources give by last write wins, and points that only one side has."""
    expected = lww.latest_points(sources).select(*KEYS, value)
    return manifest_diff(expected, merged.select(*KEYS, value), KEYS, [value]).where("state <> 'same'")


def order_faults(merged: DataFrame, position: str = "pos") -> DataFrame:
    """Points whose time is not later than that of the point before them in the stream."""
    return ordered.not_increasing(merged, ["inst_id", "field"], "time_ns", [position])


def state_faults(state: DataFrame, manifest: DataFrame) -> DataFrame:
    """Sources whose recorded counts and those of their manifest differ."""
    return manifest_diff(state, manifest, ["source_id", "inst_id", "field"], ["n"]).where("state <> 'same'")


def build_faults(aligned: DataFrame, built: DataFrame) -> DataFrame:
    """Rows of a built order book that differ from what the aligned texts and the dataset's scales give.

    aligned: inst_id, time_ns, action, asks, bids, checksum, ts (texts); built: as book_rows() makes it."""
    scales = built.select("inst_id", "px_scale", "sz_scale").distinct()
    expected = book_rows(aligned.join(scales, "inst_id"))
    values = [c for c in expected.columns if c not in ("inst_id", "time_ns")]
    return manifest_diff(expected, built, ["inst_id", "time_ns"], values).where("state <> 'same'")


def book_rows(rows: DataFrame) -> DataFrame:
    """The final rows of an order book: codes, integers, and packed or raw sides. A bad action or ts is an error."""
    asks, bids = (book.encode_side(F.col(c), F.col("px_scale"), F.col("sz_scale")) for c in ("asks", "bids"))
    ts = decimalx.int64(F.col("ts"))
    bad_ts = F.raise_error(F.concat(F.lit("bad ts "), F.col("ts"))).cast("bigint")
    return rows.withColumn("_a", asks).withColumn("_b", bids).select(
        "inst_id", "time_ns", book.action_code(F.col("action")).alias("action"), F.col("_a.raw").alias("asks_raw"), F.col("_a.packed").alias("asks"), F.col("_b.raw").alias("bids_raw"), F.col("_b.packed").alias("bids"),
        F.col("checksum").cast("bigint").alias("checksum"), F.when(F.col("ts").isNotNull() & ts.isNull(), bad_ts).otherwise(ts).alias("ts"), "px_scale", "sz_scale",
    )
