"""Decimal texts as scaled 64-bit integers, without rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A sign, digits and at most one dot, with a digit somewhere; no exponent, no blanks.
DECIMAL = r"^[+-]?(?:\d+\.?\d*|\.\d+)$"
LOWEST = -(1 << 63)


def _fraction(text: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(text, r"\.(\d*)$", 1), "0+$", "")


def decimal_scale(text: Column) -> Column:
    """Digits of the fraction without zeros at its end; null if the text is no decimal."""
    return F.when(text.rlike(DECIMAL), F.length(_fraction(text)))


def int64(text: Column) -> Column:
    """A signed integer within +-(2^63 - 1), else null."""
    value = F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("bigint"))
    return F.when(value != F.lit(LOWEST), value)


def scaled_int(text: Column, scale: Column | int) -> Column:
    """The decimal times 10^scale; null for other texts, for digits beyond the scale, and beyond 64 bits."""
    scale = F.lit(scale) if isinstance(scale, int) else scale
    sign = F.when(text.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    whole, fraction = F.regexp_extract(text, r"^[+-]?(\d*)", 1), _fraction(text)
    digits = F.concat(sign, whole, F.rpad(fraction, scale, "0"))
    fits = text.rlike(DECIMAL) & (F.length(fraction) <= scale)
    # a decimal such as `.` + nothing cannot occur; `.0` at scale 0 has no digits left and is zero
    value = F.when(fits, F.when(digits.isin("", "-"), F.lit("0")).otherwise(digits).try_cast("bigint"))
    return F.when(value != F.lit(LOWEST), value)


def scaled_text(value: Column, scale: Column | int) -> Column:
    """The shortest decimal text of a scaled integer."""
    scale = F.lit(scale) if isinstance(scale, int) else scale
    digits = F.regexp_replace(value.cast("string"), "^-", "")
    digits = F.when(F.length(digits) <= scale, F.lpad(digits, scale + 1, "0")).otherwise(digits)
    whole = F.substring(digits, F.lit(1), F.length(digits) - scale)
    fraction = F.regexp_replace(F.substring(digits, F.length(digits) - scale + 1, scale), "0+$", "")
    return F.concat(F.when(value < 0, F.lit("-")).otherwise(F.lit("")), whole, F.when(fraction != "", F.concat(F.lit("."), fraction)).otherwise(F.lit("")))


def little_endian_hex(value: Column) -> Column:
    """The eight bytes of a bigint, lowest first, in hexadecimal."""
    return F.regexp_replace(F.lpad(F.hex(value), 16, "0"), "(..)(..)(..)(..)(..)(..)(..)(..)", "$8$7$6$5$4$3$2$1")


def from_little_endian(data: Column) -> Column:
    """A bigint from eight bytes, lowest first."""
    return F.conv(F.regexp_replace(F.hex(data), "(..)(..)(..)(..)(..)(..)(..)(..)", "$8$7$6$5$4$3$2$1"), 16, -10).cast("bigint")


def uvarint_length(value: Column) -> Column:
    """Bytes of an unsigned integer at seven bits a byte."""
    return F.when(value == 0, F.lit(1)).otherwise(F.ceil(F.length(F.bin(value)) / 7)).cast("int")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Null where the denominator is not positive."""
    return F.when(denominator > 0, numerator / F.when(denominator > 0, denominator))


def human_bytes(size: Column) -> Column:
    """Two digits and a unit of 1024."""
    units = ["B", "KB", "MB", "GB", "TB", "PB"]
    value, out = size.cast("double"), None
    for k, unit in reversed(list(enumerate(units))):
        text = F.format_string(f"%.2f {unit}", value / float(1024**k))
        out = text if out is None else F.when(value < float(1024 ** (k + 1)), text).otherwise(out)
    return out


def human_bytes_short(size: Column) -> Column:
    """As human_bytes, with whole bytes below 1024."""
    return F.when(size < 1024, F.concat(size.cast("string"), F.lit(" B"))).otherwise(human_bytes(size))


def human_ratio(value: Column) -> Column:
    return F.when(value.isNull(), F.lit("-")).otherwise(F.format_string("%.2fx", value))


def human_duration(seconds: Column) -> Column:
    """`HH:MM:SS`, hours as many as there are."""
    s = F.floor(seconds).cast("bigint")
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600).cast("bigint"), F.floor(s % 3600 / 60).cast("bigint"), s % 60)
