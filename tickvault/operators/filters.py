"""Predicates of an export. All stay Column expressions, so they reach the scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Measurements that an export leaves out unless told otherwise. Fixed values.
EXCLUDED = frozenset(
    [
        "chainlink_eth_price",
        "deribit_perpetual",
        "settle_prices",
        "target_position",
        "hedge_target_position",
        "candlestick_chart",
        "candlestick_chart_option_price",
        "candlestick_chart_option_price_test",
        "candlstick",
        "deribit_delta_recorder",
        "deribit_option",
        "dex_option_price",
        "dex_option_price_model",
        "implied_voltality",
        "option",
        "option_market_metrics_online",
        "option_market_metrics_symbol_profit_online",
        "option_market_metrics_test",
        "option_market_metrics_total_profit_online",
        "option_price",
        "option_profit_daily_merge_test",
        "option_settle_prices",
        "options",
        "predict_product_price",
        "predict_product_price_delta_test",
        "predict_product_price_test",
        "test",
        "test_settle_price_table",
    ]
)


class Missing(ValueError):
    """Something that was asked for is not there."""


def between(time: Column, start=None, end=None) -> Column:
    """start <= time < end; None leaves a side open."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (time >= F.lit(start))
    return cond & (time < F.lit(end)) if end is not None else cond


def after(time: Column, mark) -> Column:
    """Rows that a resumed export still needs."""
    return F.lit(True) if mark is None else time > F.lit(mark)


def tags_equal(tags: Column, wanted: Mapping[str, str]) -> Column:
    cond = F.lit(True)
    for key in sorted(wanted):
        cond = cond & F.coalesce(F.try_element_at(tags, F.lit(key)) == wanted[key], F.lit(False))
    return cond


def tag_matches(df: DataFrame, tags: str, key: str, regex: str) -> DataFrame:
    """Rows whose tag has a match anywhere; rows without the tag go, and no match at all is an error."""
    out = df.where(F.coalesce(F.try_element_at(F.col(tags), F.lit(key)).rlike(regex), F.lit(False)))
    if out.isEmpty():
        raise Missing(f"no series has a tag {key} that matches {regex}")
    return out


def exact_series(df: DataFrame, column: str, key: str) -> DataFrame:
    out = df.where(F.col(column) == key)
    if out.isEmpty():
        raise Missing(f"no series {key}")
    return out


def chosen(df: DataFrame, column: str, wanted: Sequence[str]) -> DataFrame:
    """Rows of the wanted ids; an id without rows is an error."""
    out = df.where(F.col(column).isin(*wanted))
    have = {r[0] for r in out.select(column).distinct().collect()}  # no more than were asked for
    if missing := sorted({*wanted} - have):
        raise Missing(f"not found: {', '.join(missing)}")
    return out


def among(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rows whose value is in the only column of `ids`; neither side is collected."""
    return df.join(ids.toDF(column), column, "left_semi")


def retained(df: DataFrame, column: str, excluded: Sequence[str] | frozenset[str] = EXCLUDED) -> DataFrame:
    """Rows of all but the excluded names, as a predicate that reaches the scan."""
    return df.where(~F.col(column).isin(*sorted(excluded)))


def allowed(measurement: str, allow_excluded: bool = False) -> str:
    if measurement in EXCLUDED and not allow_excluded:
        raise ValueError(f"measurement {measurement} is excluded")
    return measurement


def existing(df: DataFrame, columns: Sequence[str], limit: int | None = None) -> DataFrame:
    """The columns that there are, in the order asked for."""
    out = df.select(*[c for c in columns if c in df.columns])
    return out if limit is None else out.limit(limit)


def canonical(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """Exactly these columns; those that are missing are null."""
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in schema.items()])
