"""Write-ahead logs as rows of writes and deletes.

A log is all segments `_<n>.wal` of a shard. Entries are `type, length, compressed payload`; the sequence of a row is its
segment and its running number there, so rows are in order whatever the sizes of entries. Replaying is relational: a value goes if a later entry deletes its
key, or a range of it with the value's time inside; of several values of one time the last stays. Deletes of a log touch
the log's own values only.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickvault.functions.series import wal_segment
from tickvault.operators.deletes import without_later_deletes
from tickvault.operators.lww import latest
from tickvault.sources import store
from tickvault.sources.codecs import Corrupt, snappy, unsnappy
from tickvault.sources.tsm import TYPES, VALUES, named

WRITE, DELETE, DELETE_RANGE = 1, 2, 3
FLOAT, INTEGER, BOOLEAN, STRING, UNSIGNED = 1, 2, 3, 4, 5
NUMBERS = {FLOAT: ">d", INTEGER: ">q", UNSIGNED: ">Q"}
COLUMNS = {FLOAT: "v_double", INTEGER: "v_long", BOOLEAN: "v_bool", STRING: "v_string", UNSIGNED: "v_unsigned"}
#: Sequences leave so many rows a segment, which is more than the bytes of any; and so many segments.
ROWS, SEGMENTS = 1 << 40, 1 << 23


def write_entry(values: list[tuple[bytes, int, list[tuple[int, object]]]]) -> bytes:
    """An entry of (key, type, [(time, value)])."""
    out = bytearray()
    for key, kind, points in values:
        out += struct.pack(">BH", kind, len(key)) + key + struct.pack(">I", len(points))
        for time, v in points:
            out += struct.pack(">q", time)
            out += struct.pack(">I", len(v)) + v if kind == STRING else bytes([bool(v)]) if kind == BOOLEAN else struct.pack(NUMBERS[kind], v)
    return framed(WRITE, bytes(out))


def delete_entry(keys: list[bytes]) -> bytes:
    return framed(DELETE, b"\n".join(keys))


def delete_range_entry(keys: list[bytes], low: int, high: int) -> bytes:
    return framed(DELETE_RANGE, struct.pack(">qq", low, high) + b"".join(struct.pack(">I", len(k)) + k for k in keys))


def framed(kind: int, payload: bytes) -> bytes:
    packed = snappy(payload)
    return struct.pack(">BI", kind, len(packed)) + packed


def entries(data: bytes) -> Iterator[tuple[int, bytes]]:
    """(type, payload) of the whole entries; a segment that was cut short ends before the entry that is not whole."""
    at = 0
    while at + 5 <= len(data):
        kind, n = struct.unpack_from(">BI", data, at)
        if at + 5 + n > len(data) or not n:
            return
        yield kind, unsnappy(data[at + 5 : at + 5 + n])
        at += 5 + n


def values_of(payload: bytes) -> dict[bytes, tuple[int, list[tuple[int, object]]]]:
    """key -> (type, values); of a key that comes twice the last counts."""
    out, at = {}, 0
    while at < len(payload):
        kind, n = struct.unpack_from(">BH", payload, at)
        key, at = payload[at + 3 : at + 3 + n], at + 3 + n
        (count,) = struct.unpack_from(">I", payload, at)
        at += 4
        points = []
        for _ in range(count):
            (time,) = struct.unpack_from(">q", payload, at)
            at += 8
            if kind == STRING:
                (n,) = struct.unpack_from(">I", payload, at)
                v, at = payload[at + 4 : at + 4 + n], at + 4 + n
            elif kind == BOOLEAN:
                v, at = payload[at] == 1, at + 1
            elif kind in NUMBERS:
                (v,) = struct.unpack_from(NUMBERS[kind], payload, at)
                at += 8
            else:
                raise Corrupt(f"a log value of type {kind}")
            points.append((time, v))
        out[key] = (kind, points)
    return out


LOG = f"shard_id int, segment bigint, seq bigint, pos bigint, key string, deletes boolean, min_time bigint, max_time bigint, time_ns bigint, {VALUES}"


def log(spark: SparkSession, root: str) -> DataFrame:
    """Writes (with time_ns and a value) and deletes (with min_time and max_time, null for all times) in the order of seq and pos."""
    paths = store.find(spark, root, r"_\d+\.wal")
    rows = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths)), "path")
    rows = rows.select(F.regexp_extract("path", r"(\d+)/_\d+\.wal$", 1).try_cast("int").alias("shard_id"), wal_segment(F.col("path")).alias("segment"), "path")

    rows = rows.where("segment is not null and shard_id is not null")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for shard, segment, path in zip(*(c.to_pylist() for c in batch.columns)):
                where, name = fs.FileSystem.from_uri(path)
                with where.open_input_file(name) as f:
                    yield from logged(shard, segment, f.read())

    return rows.mapInArrow(read, LOG)


SCHEMA = pa.schema([("shard_id", pa.int32()), ("segment", pa.int64()), ("seq", pa.int64()), ("pos", pa.int64()), ("key", pa.string()), ("deletes", pa.bool_()), ("min_time", pa.int64()), ("max_time", pa.int64()), ("time_ns", pa.int64()), *TYPES.items()])


def logged(shard: int, segment: int, data: bytes) -> Iterator[pa.RecordBatch]:
    """The rows of one segment."""
    if segment >= SEGMENTS or len(data) >= ROWS:
        raise Corrupt(f"segment {segment} of {len(data)} bytes leaves no room for sequences")
    out, before = [], 0
    for kind, payload in entries(data):
        base = {"shard_id": shard, "segment": segment, "pos": 0, "deletes": kind != WRITE}
        fresh = len(out)
        if kind == WRITE:
            for key, (own, points) in values_of(payload).items():
                for k, (time, v) in enumerate(points):
                    out.append(base | {"key": key.decode("utf-8", "replace"), "pos": k, "time_ns": time, COLUMNS[own]: Decimal(v) if own == UNSIGNED else v})
        elif kind == DELETE:
            out += [base | {"key": key.decode("utf-8", "replace")} for key in payload.split(b"\n")]
        elif kind == DELETE_RANGE:
            low, high = struct.unpack_from(">qq", payload)
            at = 16
            while at < len(payload):
                (n,) = struct.unpack_from(">I", payload, at)
                out.append(base | {"key": payload[at + 4 : at + 4 + n].decode("utf-8", "replace"), "min_time": low, "max_time": high})
                at += 4 + n
        for k, row in enumerate(out[fresh:]):
            row["seq"] = segment * ROWS + before + k
        before += len(out) - fresh
        if len(out) > 50_000:
            yield pa.RecordBatch.from_pylist(out, SCHEMA)
            out = []
    if out:
        yield pa.RecordBatch.from_pylist(out, SCHEMA)


def decoded(contents: DataFrame) -> DataFrame:
    """The rows of segments (shard_id, segment, content)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, segment, data in zip(*(c.to_pylist() for c in batch.columns)):
                yield from logged(shard, segment, data)

    return contents.select(F.col("shard_id").cast("int"), F.col("segment").cast("bigint"), "content").mapInArrow(run, LOG)


def points(spark: SparkSession, root: str, fields=None, start: int | None = None, end: int | None = None) -> DataFrame:
    """What the logs leave: a point a (shard, key, time), with the columns of `tsm.points`."""
    return replayed(log(spark, root), fields, start, end)


def replayed(rows: DataFrame, fields=None, start: int | None = None, end: int | None = None) -> DataFrame:
    """Writes that no later entry deletes, the last of each time."""
    writes = rows.where("not deletes")
    kept = without_later_deletes(writes, rows.where("deletes").select("shard_id", "key", "seq", "min_time", "max_time"), ["shard_id", "key"])
    if start is not None:
        kept = kept.where(F.col("time_ns") >= start)
    if end is not None:
        kept = kept.where(F.col("time_ns") < end)
    last = latest(kept.drop("deletes", "min_time", "max_time"), ["shard_id", "key", "time_ns"], ["seq", "pos"])
    out = named(last.withColumn("pos", F.col("seq")))
    if fields is not None:
        out = out.where(F.col("field").isin(*fields))
    return out.select(F.concat(F.lit("wal-"), F.col("shard_id")).alias("source_id"), "shard_id", F.lit(0).alias("generation"), F.lit(0).alias("sequence"), "pos", "time_ns", *TYPES, "series", "field", "inst_id", F.lit("wal").alias("kind"))
