"""Sources over byte fixtures that the package's own encoders make."""

from __future__ import annotations

import http.server
import json
import math
import random
import struct
import threading
import urllib.parse

import pytest
from pyspark.sql import functions as F

from tickvault.plans import export
from tickvault.sources import codecs, text, tsm, wal

T0 = 1_700_000_000_000_000_000


@pytest.mark.parametrize(
    "times",
    [[], [5], [T0 + k * 1_000_000_000 for k in range(50)], [T0, T0 + 7, T0 + 1000, T0 + 5_000_000], [10, 5, 7], [0, 1 << 62, (1 << 62) + 1], [-5, -3, -1], [T0 + k + (k % 3) for k in range(500)], [4, 4, 4, 9]],
)
def test_times(times):
    assert codecs.decode_times(codecs.encode_times(times)).tolist() == times


@pytest.mark.parametrize("values", [[1], [1, 2, 3, 4], [0] * 300, [5, -5, 1 << 62, -(1 << 62)], [-(1 << 63), (1 << 63) - 1, 0], list(range(0, 900, 7)), [random.Random(1).randrange(-1000, 1000) for _ in range(400)]])
def test_integers(values):
    assert codecs.decode_integers(codecs.encode_integers(values)).tolist() == values


@pytest.mark.parametrize("values", [[1.0], [1.5, 1.5, 1.5, 2.25, -0.0, 1e300, 5e-324], [math.inf, -math.inf, 0.1, 0.2], [random.Random(2).uniform(-1, 1) for _ in range(300)]])
def test_floats(values):
    assert [struct.pack(">d", v) for v in codecs.decode_floats(codecs.encode_floats(values))] == [struct.pack(">d", v) for v in values]


def test_other_blocks():
    for kind, values in ((codecs.STRING, [b"", b"a" * 300, "é".encode()]), (codecs.BOOLEAN, [True, False] * 9), (codecs.UNSIGNED, [0, (1 << 64) - 1, 5])):
        times = list(range(len(values)))
        got = codecs.decode_block(codecs.encode_block(kind, times, values))
        assert got[0] == kind and got[1].tolist() == times and list(got[2]) == values
    with pytest.raises(codecs.Corrupt):
        codecs.decode_block(b"\x09\x00")


def key(inst, field):
    return f"depth_feed,instId={inst}#!~#{field}".encode()


@pytest.fixture
def tree(tmp_path):
    """Two shards of storage files with a tombstone, and logs."""
    a, b, w = tmp_path / "data/1", tmp_path / "data/2", tmp_path / "wal/2"
    for d in (a, b, w):
        d.mkdir(parents=True)
    side = b'[["1.25","2.5","0","7"]]'
    S, I = codecs.STRING, codecs.INTEGER
    (a / "000001-01.tsm").write_bytes(tsm.write_tsm({key("X", "action"): [(S, [1, 2, 3], [b"snapshot", b"update", b"update"])], key("X", "asks"): [(S, [1, 2], [side, b"[]"]), (S, [3], [b"bad"])], key("X", "checksum"): [(I, [1, 2, 3], [10, 20, 30])], key("X", "other"): [(I, [1], [1])]}))
    (a / "000001-01.tombstone").write_bytes(tsm.write_tombstone([(key("X", "checksum"), 2, 2)], 4))
    (a / "000002-01.tsm").write_bytes(tsm.write_tsm({key("X", "checksum"): [(I, [2, 3], [21, 31])]}))
    (b / "000001-01.tsm").write_bytes(tsm.write_tsm({key("X", "checksum"): [(I, [3, 4], [32, 42])]}))
    (w / "_00001.wal").write_bytes(wal.write_entry([(key("X", "checksum"), wal.INTEGER, [(4, 43), (5, 50), (6, 60)])]) + wal.delete_range_entry([key("X", "checksum")], 5, 5))
    (w / "_00002.wal").write_bytes(wal.write_entry([(key("X", "checksum"), wal.INTEGER, [(6, 61), (6, 62)]), (key("W", "checksum"), wal.INTEGER, [(1, 1)])]) + b"\x01\x00\x00\x00\xff")
    return tmp_path


def test_export_of_a_book(spark, tree):
    points = export.source_points(spark, f"{tree}/data", f"{tree}/wal")
    rows = {r.time_ns: r for r in export.book_text(points).collect()}
    assert {t: r.checksum for t, r in rows.items()} == {1: 10, 2: 21, 3: 32, 4: 43, 6: 62}
    assert rows[1].action == "snapshot" and rows[4].action is None and rows[2].asks == "[]"
    out = f"{tree}/out/book.parquet"
    first = export.export_book(spark, f"{tree}/data", out, f"{tree}/wal")
    assert first["rows"] == 5 and export.export_book(spark, f"{tree}/data", out, f"{tree}/wal") == json.loads(json.dumps(first))
    built = {r.time_ns: r for r in spark.read.parquet(out).collect()}
    assert built[1].action == 1 and bytes(built[1].asks)[:5] == b"\x01\x01\0\0\0" and built[3].asks is None and built[3].asks_raw == "bad" and built[1].px_scale == 4


def test_pruning_and_index(spark, tree):
    assert {(r.time_ns, r.v_long) for r in tsm.points(spark, f"{tree}/data", fields=["checksum"], start=2, end=4).collect()} == {(3, 30), (2, 21), (3, 31), (3, 32)}
    index = tsm.index(spark, f"{tree}/data")
    assert index.where("source_id = '1/000001-01'").count() == 4 and index.agg(F.sum("blocks")).first()[0] == 7


@pytest.mark.parametrize("version", [1, 2, 3, 4])
def test_tombstones(version):
    records = [(b"a#!~#f", 1, 5), (b"b#!~#f", -3, 9), (b"c#!~#f", 0, 0)]
    want = records if version > 1 else [(k, -(1 << 63), (1 << 63) - 1) for k, _, _ in records]
    assert list(tsm.read_tombstone(tsm.write_tombstone(records, version, members=2))) == want


def test_a_changed_block_is_found(spark, tree):
    path = tree / "data/1/000002-01.tsm"
    data = bytearray(path.read_bytes())
    data[12] ^= 1
    path.write_bytes(bytes(data))
    with pytest.raises(Exception, match="checksum"):
        tsm.points(spark, f"{tree}/data").count()


def test_spools(spark, tmp_path):
    (tmp_path / "a.okdsp.zst").write_bytes(text.write_spool([(1, b"x"), (2, b"y" * 300)]) + __import__("pyarrow").compress(text.spool_records([(3, b"z")]), codec="zstd", asbytes=True))
    (tmp_path / "b.okdsp.zst").write_bytes(text.write_spool([(7, (5).to_bytes(8, "little"))], text.INT64))
    rows = text.spools(spark, str(tmp_path)).orderBy("path", "pos").collect()
    assert [(r.pos, r.time_ns, len(r.payload), r.v_long) for r in rows] == [(0, 1, 1, None), (1, 2, 300, None), (2, 3, 1, None), (0, 7, 8, 5)]


def test_line_protocol_file(spark, tmp_path):
    (tmp_path / "x.lp").write_text("depth_feed,instId=A a=1i,b=t 5\nnoise\n")
    assert {(r.inst_id, r.field, r.v_long, r.v_bool) for r in text.line_protocol(spark, str(tmp_path / "x.lp"), "depth_feed").collect()} == {("A", "a", 1, None), ("A", "b", None, True)}


def chunk(inst, values):
    return json.dumps({"results": [{"series": [{"name": "option", "columns": ["time", "instrument", "mark_price"], "values": [[t, inst, p] for t, p in values]}]}]})


def test_chunks(spark):
    chunks = [chunk("ETH-9SEP22-1000-C", [(1, 1.1), (2, 1.2)]), chunk("ETH-16SEP22-1000-C", [(3, 1.3), (4, None)])]
    rows = text.chunk_rows(spark.createDataFrame([(c,) for c in chunks], "value string"), {"mark_price": "float", "absent": "integer"}, ["instrument"]).orderBy("time").collect()
    assert [tuple(r) for r in rows] == [(1, "ETH-9SEP22-1000-C", None, 1.1), (2, "ETH-9SEP22-1000-C", None, 1.2), (3, "ETH-16SEP22-1000-C", None, 1.3), (4, "ETH-16SEP22-1000-C", None, None)]
    with pytest.raises(Exception, match="boom"):
        text.chunk_rows(spark.createDataFrame([('{"results":[{"error":"boom"}]}',)], "value string"), {"a": "float"}, []).collect()
    with pytest.raises(ValueError):
        text.chunk_rows(spark.createDataFrame([], "value string"), {"a": "float"}, ["a"])


def test_http_export(spark, tmp_path):
    class Answer(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            q = urllib.parse.parse_qs(urllib.parse.urlparse(self.path).query)["q"][0]
            if q.startswith("SHOW FIELD"):
                body = {"results": [{"series": [{"values": [["mark_price", "float"]]}]}]}
            elif q.startswith("SHOW TAG"):
                body = {"results": [{"series": [{"values": [["instrument"]]}]}]}
            elif q.startswith("SHOW SERIES"):
                body = {"results": [{"series": [{"values": [["ticks,instrument=A"], ["ticks,instrument=B"]]}]}]}
            else:
                body = json.loads(chunk("A" if "'A'" in q else "B", [(1, 1.5), (2, 2.5)]))
            self.send_response(200)
            self.end_headers()
            self.wfile.write(json.dumps(body).encode() + b"\n")

        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Answer)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        url = f"http://127.0.0.1:{server.server_port}"
        out = str(tmp_path / "ticks.parquet")
        told = export.export_measurement(spark, url, "db", "ticks", out)
        assert told["rows"] == 4 and told["measurement"] == "ticks"
        assert {tuple(r) for r in spark.read.parquet(out).collect()} == {(t, i, p) for i in "AB" for t, p in ((1, 1.5), (2, 2.5))}
        with pytest.raises(ValueError, match="excluded"):
            export.export_measurement(spark, url, "db", "option_price", out)
        with pytest.raises(ValueError, match="another export"):
            export.export_measurement(spark, url, "db", "ticks", out, end=5)
    finally:
        server.shutdown()
