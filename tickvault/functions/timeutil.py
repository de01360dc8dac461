"""Nanosecond times as BIGINT, their text forms, and calendar months. The truth is always the integer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NANOS = 1_000_000_000


def rfc3339_ns(text: Column) -> Column:
    """Nanoseconds since the epoch of an RFC 3339 text with up to nine digits of a second and an offset; null if it is none.

    No digit is lost: whole seconds come from the timestamp, the fraction from its own digits."""
    form = r"^(\d{4}-\d\d-\d\d)[Tt ](\d\d:\d\d:\d\d)(?:\.(\d{1,9}))?([Zz]|[+-]\d\d:\d\d)$"
    part = lambda i: F.regexp_extract(text, form, i)
    zone = F.when(F.upper(part(4)) == "Z", F.lit("+00:00")).otherwise(part(4))
    seconds = F.unix_seconds(F.try_to_timestamp(F.concat(part(1), F.lit("T"), part(2), zone)))
    return F.when(text.rlike(form), seconds * F.lit(NANOS) + F.rpad(part(3), 9, "0").cast("bigint"))


def naive_rfc3339_ns(text: Column) -> Column:
    """Like rfc3339_ns; a text without an offset is in UTC."""
    return rfc3339_ns(F.when(text.rlike(r"[0-9]$") & ~text.rlike(r"[+-]\d\d:\d\d$"), F.concat(text, F.lit("Z"))).otherwise(text))


def ns_text(ns: Column) -> Column:
    """Nine digits of a second, or none if they are all zero."""
    rest = F.pmod(ns, F.lit(NANOS))
    return F.concat(second_text(ns), F.when(rest != 0, F.concat(F.lit("."), F.lpad(rest.cast("string"), 9, "0"))).otherwise(F.lit("")), F.lit("Z"))


def ns_text_short(ns: Column) -> Column:
    """As few digits of a second as tell the time."""
    rest = F.pmod(ns, F.lit(NANOS))
    digits = F.regexp_replace(F.lpad(rest.cast("string"), 9, "0"), "0+$", "")
    return F.concat(second_text(ns), F.when(rest != 0, F.concat(F.lit("."), digits)).otherwise(F.lit("")), F.lit("Z"))


def second_text(ns: Column) -> Column:
    """`YYYY-MM-DDTHH:MM:SS` in UTC, by integer division."""
    return F.date_format(F.timestamp_seconds(floor_seconds(ns)).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss")


def floor_seconds(ns: Column) -> Column:
    """Whole seconds, towards the past."""
    less = F.when(F.pmod(ns, F.lit(NANOS)) == 0, F.lit(0)).when(ns < 0, F.lit(1)).otherwise(F.lit(0))
    return F.call_function("div", ns, F.lit(NANOS)) - less


def to_ns(ts: Column) -> Column:
    """Nanoseconds of a timestamp (of either kind, taken as UTC)."""
    return F.unix_micros(ts.cast("timestamp")) * 1000


def month_start(ts: Column) -> Column:
    return F.date_trunc("MM", ts)


def next_month(ts: Column) -> Column:
    """The first instant of the month after."""
    return F.add_months(F.date_trunc("MM", ts), 1).cast("timestamp")


def month_windows(start: Column, end: Column) -> Column:
    """array<struct<w_start, w_end>>: half-open windows that cut [start, end) at month borders; an empty or turned interval is an error."""
    firsts = F.sequence(F.date_trunc("MM", start), F.date_trunc("MM", end - F.expr("interval 1 microsecond")), F.expr("interval 1 month"))
    made = F.transform(firsts, lambda m: F.struct(F.greatest(m, start).alias("w_start"), F.least(F.add_months(m, 1).cast("timestamp"), end).alias("w_end")))
    return F.when(end > start, made).otherwise(F.raise_error(F.lit("the end must be later than the start")).cast("array<struct<w_start: timestamp, w_end: timestamp>>"))


def window_label(start: Column, end: Column) -> Column:
    """`YYYY-MM` of a whole month, else both ends in compact form."""
    compact = lambda c: F.date_format(c, "yyyyMMdd'T'HHmmss'Z'")
    whole = (start == F.date_trunc("MM", start)) & (end == next_month(start))
    return F.when(whole, F.date_format(start, "yyyy-MM")).otherwise(F.concat(compact(start), F.lit("__"), compact(end)))
