"""Column functions against the literals of the reference inputs."""

from __future__ import annotations

import struct

import pytest
from pyspark.sql import functions as F

from tickvault.functions import book, decimalx, series, timeutil


def column(spark, f, *values, kind="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
    return [r.y for r in df.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


def test_escapes(spark):
    assert column(spark, lambda c: series.split_escaped(c, ","), "a,b\\,c,,d\\", "", ",", "a\\\\,b") == [["a", "b,c", "", "d\\"], [""], ["", ""], ["a\\", "b"]]
    assert [tuple(r) for r in column(spark, lambda c: series.split_first_escaped(c, "="), "a\\=b=c\\=d", "abc", "=x")] == [("a=b", "c\\=d"), ("abc", ""), ("", "x")]
    assert column(spark, series.unescape, "a\\,b", "x\\", None) == ["a,b", "x\\", None]


def test_series_keys(spark):
    got = column(spark, series.parse_series_key, "option_price,expiration=1Apr23,instId=BTC-1APR23-27500-CALL,side=c", "m", "m\\,x,a\\ b=c\\=d,e", "m,a=1,a=2", None)
    assert [(r.measurement, r.tags) if r else None for r in got] == [("option_price", {"expiration": "1Apr23", "instId": "BTC-1APR23-27500-CALL", "side": "c"}), ("m", {}), ("m,x", {"a b": "c=d", "e": ""}), ("m", {"a": "2"}), None]
    back = spark.sql("select map('b', '1,2', 'a', 'x=y') t").select(series.series_key(F.lit("m m"), F.col("t")).alias("k")).first().k
    assert back == "m\\ m,a=x\\=y,b=1\\,2"


def test_contract_months(spark):
    got = column(spark, series.contract_month, "BTC-1APR23-27500-CALL", "BTC-5may23-29000-PUT")
    assert [tuple(r) for r in got] == [("BTC-APR23", "^BTC-[0-9]{1,2}APR23-"), ("BTC-MAY23", "^BTC-[0-9]{1,2}MAY23-")]
    for bad in ("BTC-1APR23", "BTC-APRIL-1-C"):
        with pytest.raises(Exception, match="no contract month"):
            column(spark, series.contract_month, bad)


def test_names(spark):
    assert column(spark, series.sanitize_name, " a/b:c ", "   ", 'x"y') == ["a_b_c", "series", "x_y"]
    assert column(spark, series.quote_ident, 'a"b\\') == ['"a\\"b\\\\"']
    assert column(spark, series.quote_string, "it's") == ["'it\\'s'"]
    assert [tuple(r) if r else None for r in column(spark, series.file_name, "/x/000001-02.tsm", "a.tsm")] == [(1, 2), None]
    assert column(spark, series.wal_segment, "/x/_00012.wal", "/x/y12.wal") == [12, None]
    assert [tuple(r) for r in column(spark, series.composite_key, "m,a=b#!~#f", "m")] == [("m,a=b", "f"), ("m", "")]


def test_line_protocol(spark):
    lines = ['noise-prefix depth_feed,instId=BTC-USDT-SWAP asks="[[\\"1\\", \\"2\\"]]" 123\r\n', 'depth_feed,channel=books,instId=BTC-USDT-SWAP asks="[[\\"1\\", \\"2\\"]]",checksum=42i 123', "depth_feed,instId=x a=1", "other,a=1 b=2 3", 'depth_feed,instId=x a="q,w e",b=t -5']
    got = column(spark, lambda c: series.lp_line(c, "depth_feed"), *lines)
    assert got[2] is None and got[3] is None
    assert got[0].fields["asks"].s == '[["1", "2"]]' and got[0].time_ns == 123 and got[0].tags == {"instId": "BTC-USDT-SWAP"}
    assert got[1].fields["checksum"].l == 42
    assert got[4].fields["a"].s == "q,w e" and got[4].fields["b"].b is True and got[4].time_ns == -5


def test_times(spark):
    assert column(spark, timeutil.rfc3339_ns, "2024-01-01T00:00:00.123456789Z", "2024-01-01T02:00:00.5+02:00", "2024-01-01T00:00:00", "1969-12-31T23:59:59.999999999Z") == [1704067200123456789, 1704067200500000000, None, -1]
    assert column(spark, timeutil.naive_rfc3339_ns, "2024-01-01T00:00:00", "x") == [1704067200000000000, None]
    assert column(spark, timeutil.ns_text, 0, 1704067200123456789, -1, kind="bigint") == ["1970-01-01T00:00:00Z", "2024-01-01T00:00:00.123456789Z", "1969-12-31T23:59:59.999999999Z"]
    assert column(spark, timeutil.ns_text_short, 1704067200500000000, kind="bigint") == ["2024-01-01T00:00:00.5Z"]


def test_month_windows(spark):
    df = spark.sql("select timestamp'2024-01-15 00:00:00' a, timestamp'2024-03-01 00:00:00' b")
    rows = df.select(F.explode(timeutil.month_windows(F.col("a"), F.col("b"))).alias("w")).select(timeutil.window_label(F.col("w.w_start"), F.col("w.w_end")).alias("l")).collect()
    assert [r.l for r in rows] == ["20240115T000000Z__20240201T000000Z", "2024-02"]
    with pytest.raises(Exception, match="later than the start"):
        df.select(timeutil.month_windows(F.col("b"), F.col("a"))).collect()


def test_scaled_decimals(spark):
    assert column(spark, lambda c: decimalx.scaled_int(c, 3), "12", "-0.5", "1.2300", "1.23456", ".", "", "1e3", " 1 ", "5.", ".25", None) == [12000, -500, 1230, None, None, None, None, None, 5000, 250, None]
    assert column(spark, lambda c: decimalx.scaled_int(c, 0), "9223372036854775807", "-9223372036854775808", "9223372036854775808", "-0") == [9223372036854775807, None, None, 0]
    assert column(spark, lambda c: decimalx.scaled_int(c, 1), "9223372036854775807") == [None]
    assert column(spark, lambda c: decimalx.scaled_text(c, 3), 12000, -500, 1, 0, kind="bigint") == ["12", "-0.5", "0.001", "0"]
    assert column(spark, decimalx.decimal_scale, "1.2300", "0.0100", "2", "x") == [2, 2, 0, None]
    assert column(spark, decimalx.int64, "+5", "-7", "1.0", "-9223372036854775808") == [5, -7, None, None]
    assert column(spark, decimalx.uvarint_length, 0, 127, 128, kind="bigint") == [1, 1, 2]
    assert column(spark, decimalx.human_bytes_short, 999, 1024, 1790 * 2**30, kind="bigint") == ["999 B", "1.00 KB", "1.75 TB"]
    assert column(spark, decimalx.human_duration, 3725, kind="int") == ["01:02:05"]


GOOD = '[["1.25","2.5","0","7"],["1.20","2","1","8"]]'
BAD = ['[["1","2"]]', '[["1","2","0"]]', '[["1","2","0","1","extra"]]', '[["1\\u0031","2","0","1"]]', '[["1","2","0","1"]]x', '[[1,"2","0","1"]]', '[["1.23456","2","0","1"]]', '[["1","2","0","1"],]']


def test_book(spark):
    packed = column(spark, lambda c: book.pack(c, 4, 3), GOOD, " [ ] ", ' [ [ "1" , "2" , "0" , "1" ] ] ')
    assert bytes(packed[0]) == b"\x01" + struct.pack("<I", 2) + struct.pack("<8q", 12500, 2500, 0, 7, 12000, 2000, 1, 8)
    assert bytes(packed[1]) == b"\x01\0\0\0\0" and len(packed[2]) == 37
    assert column(spark, lambda c: book.pack(c, 4, 3), *BAD) == [None] * len(BAD)
    assert [(r.packed, r.raw) for r in column(spark, lambda c: book.encode_side(c, 4, 3), *BAD[:2], "", None)] == [(None, BAD[0]), (None, BAD[1]), (None, None), (None, None)]
    assert column(spark, lambda c: book.reconstruct(F.lit(None).cast("string"), book.pack(c, 4, 3), 4, 3), GOOD) == ['[["1.25","2.5","0","7"],["1.2","2","1","8"]]']
    assert [tuple(r) if r else None for r in column(spark, book.side_scales, '[["0.12345","0.0001000","0","1"],["0.1","2.5000","0","1"]]', BAD[0], "[]")] == [(5, 4), None, (0, 0)]
    assert len(column(spark, lambda c: book.levels(c, 2, 2), "[" + ",".join(['["1.5","2","0","1"]'] * 20000) + "]")[0]) == 20000


@pytest.mark.parametrize("data, fault", [(b"\x01\0\0", "too short"), (b"\x02\0\0\0\0", "another version"), (b"\x01\x01\0\0\0", "wrong size")])
def test_unpack_faults(spark, data, fault):
    with pytest.raises(Exception, match=fault):
        column(spark, book.unpack, bytearray(data), kind="binary")


def test_actions(spark):
    assert column(spark, book.action_code, "snapshot", "update", None) == [1, 2, None]
    assert column(spark, book.action_name, 1, 2, 9, None, kind="int") == ["snapshot", "update", "unknown(9)", None]
    with pytest.raises(Exception, match="unknown action"):
        column(spark, book.action_code, "delete")
