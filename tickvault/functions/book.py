r"""Sides of an order book: JSON text of levels ["price","size","liquidations","orders"], and its packed form.

Packed: a version byte 1, the number of levels as unsigned 32-bit, then four signed 64-bit integers a level, all little
endian; prices and sizes are scaled. A side whose text is not of that form, or has a number that the scales do not hold,
is kept as it is, whole.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickvault.functions.bind import let
from tickvault.functions.decimalx import decimal_scale, from_little_endian, int64, little_endian_hex, scaled_int, scaled_text

_W, _S = r"[ \t\r\n]*+", r'"[^"\\]*+"'
_LEVEL = rf"\[{_W}{_S}{_W},{_W}{_S}{_W},{_W}{_S}{_W},{_W}{_S}{_W}\]"
#: Quantifiers give nothing back, so a text of any length needs no stack.
SIDE = rf"^{_W}\[{_W}(?:{_LEVEL}{_W}(?:,{_W}{_LEVEL}{_W})*+)?+\]{_W}$"
LEVELS = "array<struct<px: bigint, sz: bigint, liq: bigint, orders: bigint>>"
VERSION = 1


def is_side(payload: Column) -> Column:
    return payload.rlike(SIDE)


def level_texts(payload: Column) -> Column:
    """array<struct<px, sz, liq, orders>> of strings; null if the text is no side."""
    def cells(flat: Column) -> Column:
        n = F.floor(F.size(flat) / 4).cast("int")
        made = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(*[F.get(flat, i * 4 + k).alias(c) for k, c in enumerate(("px", "sz", "liq", "orders"))]))
        return F.when(n > 0, made).otherwise(F.array().cast("array<struct<px: string, sz: string, liq: string, orders: string>>"))

    return F.when(is_side(payload), let(F.regexp_extract_all(payload, F.lit(r'"([^"\\]*)"'), F.lit(1)), cells))


def levels(payload: Column, px_scale: Column | int, sz_scale: Column | int) -> Column:
    """Scaled levels; null if any number of the side does not fit."""
    made = F.transform(level_texts(payload), lambda v: F.struct(scaled_int(v["px"], px_scale).alias("px"), scaled_int(v["sz"], sz_scale).alias("sz"), int64(v["liq"]).alias("liq"), int64(v["orders"]).alias("orders")))
    part = lambda v: v["px"].isNull() | v["sz"].isNull() | v["liq"].isNull() | v["orders"].isNull()
    return let(made, lambda m: F.when(~F.exists(m, part), m))


def pack_levels(scaled: Column) -> Column:
    def packed(side: Column) -> Column:
        count = F.substring(little_endian_hex(F.size(side).cast("bigint")), 1, 8)
        body = F.array_join(F.transform(side, lambda v: F.concat(*[little_endian_hex(v[c]) for c in ("px", "sz", "liq", "orders")])), "")
        return F.when(side.isNotNull(), F.unhex(F.concat(F.lit("01"), count, body)))

    return let(scaled, packed)


def pack(payload: Column, px_scale: Column | int, sz_scale: Column | int) -> Column:
    return pack_levels(levels(payload, px_scale, sz_scale))


def unpack(data: Column) -> Column:
    """Scaled levels of a packed side; a short one, another version and a wrong size are errors."""
    return let(data, _unpack)


def _unpack(data: Column) -> Column:
    n = F.conv(F.regexp_replace(F.hex(F.substring(data, 2, 4)), "(..)(..)(..)(..)", "$4$3$2$1"), 16, 10).cast("bigint")
    at = lambda i, k: from_little_endian(F.substring(data, (F.lit(6) + i * 32 + k * 8).cast("int"), F.lit(8)))
    made = F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1), lambda i: F.struct(*[at(i, k).alias(c) for k, c in enumerate(("px", "sz", "liq", "orders"))]))
    fault = lambda text: F.raise_error(F.lit(text)).cast(LEVELS)
    return (
        F.when(data.isNull(), None)
        .when(F.octet_length(data) < 5, fault("packed side too short"))
        .when(F.hex(F.substring(data, 1, 1)) != "01", fault("packed side of another version"))
        .when(F.octet_length(data) != n * 32 + 5, fault("packed side has a wrong size"))
        .when(n == 0, F.array().cast(LEVELS))
        .otherwise(made)
    )


def encode_side(payload: Column, px_scale: Column | int, sz_scale: Column | int) -> Column:
    """struct<packed, raw>: one of them for a side with text, none for an empty or missing one."""
    return let(pack(payload, px_scale, sz_scale), lambda packed: F.struct(packed.alias("packed"), F.when(packed.isNull() & (F.length(payload) > 0), payload).alias("raw")))


def side_text(scaled: Column, px_scale: Column | int, sz_scale: Column | int) -> Column:
    cell = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    each = F.transform(scaled, lambda v: F.concat(F.lit("["), F.concat_ws(",", cell(scaled_text(v["px"], px_scale)), cell(scaled_text(v["sz"], sz_scale)), cell(v["liq"].cast("string")), cell(v["orders"].cast("string"))), F.lit("]")))
    return F.concat(F.lit("["), F.array_join(each, ","), F.lit("]"))


def reconstruct(raw: Column, packed: Column, px_scale: Column | int, sz_scale: Column | int) -> Column:
    """The text of a side: the raw one if there is one, else from the packed one."""
    return F.coalesce(raw, side_text(unpack(packed), px_scale, sz_scale))


def side_scales(payload: Column) -> Column:
    """struct<px, sz>: the largest scales of a side; null if the side or a number is malformed."""
    scales = F.transform(level_texts(payload), lambda v: F.struct(decimal_scale(v["px"]).alias("px"), decimal_scale(v["sz"]).alias("sz")))
    top = lambda all_, c: F.coalesce(F.array_max(F.transform(all_, lambda v: v[c])), F.lit(0)).alias(c)
    return let(scales, lambda x: F.when(~F.exists(x, lambda v: v["px"].isNull() | v["sz"].isNull()), F.struct(top(x, "px"), top(x, "sz"))))


#: Codes of the book's actions. Fixed values.
ACTIONS = {"snapshot": 1, "update": 2}


def action_code(action: Column) -> Column:
    """Unknown actions are an error."""
    out = F.when(action.isNull(), F.lit(None).cast("int"))
    for name, code in ACTIONS.items():
        out = out.when(action == name, F.lit(code))
    return out.otherwise(F.raise_error(F.concat(F.lit("unknown action "), action)).cast("int"))


def action_name(code: Column) -> Column:
    out = F.when(code.isNull(), F.lit(None).cast("string"))
    for name, number in ACTIONS.items():
        out = out.when(code == number, F.lit(name))
    return out.otherwise(F.concat(F.lit("unknown("), code.cast("string"), F.lit(")")))
