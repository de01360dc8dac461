"""Time-structured storage files and their tombstones as rows of points.

Files come through Spark's binary reader, one row a file, so any store that Spark reads will do; names tell the shard,
the generation and the sequence. Each task walks the index of its file, leaves out series, fields and blocks that cannot
match, and decodes the rest into Arrow batches. Blocks are checked against their CRC. Tombstones are rows of their own,
and a range anti-join within the source applies them.
"""

from __future__ import annotations

import gzip
import struct
import zlib
from collections.abc import Iterator, Sequence
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickvault.functions.series import composite_key, parse_series_key
from tickvault.operators.deletes import without_tombstones
from tickvault.sources.codecs import BOOLEAN, FLOAT, INTEGER, STRING, UNSIGNED, Corrupt, decode_block, encode_block

MAGIC, VERSION, SEPARATOR = 0x16D116D1, 1, b"#!~#"
VALUES = "v_double double, v_long bigint, v_bool boolean, v_string binary, v_unsigned decimal(20,0)"
COLUMNS = {FLOAT: "v_double", INTEGER: "v_long", BOOLEAN: "v_bool", STRING: "v_string", UNSIGNED: "v_unsigned"}
TYPES = {"v_double": pa.float64(), "v_long": pa.int64(), "v_bool": pa.bool_(), "v_string": pa.binary(), "v_unsigned": pa.decimal128(20, 0)}
NAME = r"(?:^|/)(\d+)/(\d+)-(\d+)\.(?:tsm|tombstone)$"


def write_tsm(series: dict[bytes, list[tuple[int, list[int], list]]]) -> bytes:
    """A file of blocks (kind, times, values) by key `series#!~#field`."""
    body, index = bytearray(struct.pack(">IB", MAGIC, VERSION)), bytearray()
    for key in sorted(series):
        kinds = {kind for kind, _, _ in series[key]}
        index += struct.pack(">H", len(key)) + key + struct.pack(">BH", kinds.pop(), len(series[key]))
        for kind, times, values in series[key]:
            data = encode_block(kind, times, values)
            index += struct.pack(">qqqI", min(times), max(times), len(body), len(data) + 4)
            body += struct.pack(">I", zlib.crc32(data)) + data
    return bytes(body) + bytes(index) + struct.pack(">Q", len(body))


def index_of(data: bytes) -> Iterator[tuple[bytes, int, list[tuple[int, int, int, int]]]]:
    """(key, kind, [(min time, max time, offset, size)])."""
    if len(data) < 13 or struct.unpack_from(">IB", data) != (MAGIC, VERSION):
        raise Corrupt("not a storage file of this version")
    at, end = struct.unpack(">Q", data[-8:])[0], len(data) - 8
    while at < end:
        (n,) = struct.unpack_from(">H", data, at)
        key = data[at + 2 : at + 2 + n]
        kind, count = struct.unpack_from(">BH", data, at + 2 + n)
        at += 5 + n
        yield key, kind, [struct.unpack_from(">qqqI", data, at + 28 * k) for k in range(count)]
        at += 28 * count


def block_at(data: bytes, offset: int, size: int, verify: bool = True) -> bytes:
    (crc,) = struct.unpack_from(">I", data, offset)
    block = data[offset + 4 : offset + size]
    if verify and zlib.crc32(block) != crc:
        raise Corrupt(f"the block at {offset} does not match its checksum")
    return block


def columns_of(kind: int, values) -> dict[str, pa.Array]:
    n = len(values)
    own = COLUMNS[kind]
    made = {c: pa.nulls(n, t) for c, t in TYPES.items()}
    made[own] = pa.array([Decimal(int(v)) for v in values] if kind == UNSIGNED else values, TYPES[own])
    return made


def files(spark: SparkSession, root: str, suffix: str) -> DataFrame:
    """(path, shard_id, generation, sequence, source_id, content) of files `<shard>/<generation>-<sequence>.<suffix>` anywhere below root."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{suffix}").option("recursiveFileLookup", "true").load(root)
    part = lambda k: F.regexp_extract("path", NAME, k).try_cast("int")
    found = rows.where(F.col("path").rlike(NAME)).select("path", part(1).alias("shard_id"), part(2).alias("generation"), part(3).alias("sequence"), "content")
    return found.withColumn("source_id", F.concat_ws("/", "shard_id", F.regexp_extract("path", r"(\d+-\d+)\.\w+$", 1)))


def index(spark: SparkSession, root: str) -> DataFrame:
    """(source_id, series, field, kind, blocks, min_time, max_time): what the files hold, without decoding a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = [(source, key.decode("utf-8", "replace"), kind, len(e), min(x[0] for x in e), max(x[1] for x in e)) for key, kind, e in index_of(data)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64()))], ["source_id", "key", "kind", "blocks", "min_time", "max_time"])

    rows = files(spark, root, "tsm").select("source_id", "content").mapInArrow(run, "source_id string, key string, kind int, blocks int, min_time bigint, max_time bigint")
    return rows.withColumn("_k", composite_key(F.col("key"))).select("source_id", F.col("_k.series").alias("series"), F.col("_k.field").alias("field"), "kind", "blocks", "min_time", "max_time")


POINTS = f"source_id string, shard_id int, generation int, sequence int, key string, pos bigint, time_ns bigint, {VALUES}"


def blocks(spark: SparkSession, root: str, **prune) -> DataFrame:
    """Points of all files below root, before tombstones."""
    return decoded(files(spark, root, "tsm"), **prune)


def decoded(contents: DataFrame, fields: Sequence[str] | None = None, start: int | None = None, end: int | None = None, contains: str | None = None, verify: bool = True) -> DataFrame:
    """Points of files (source_id, shard_id, generation, sequence, content). fields, [start, end) and a text that the key must contain prune what is decoded."""
    wanted = None if fields is None else {f.encode() for f in fields}
    needle = None if contains is None else contains.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            for source, shard, gen, seq, data in zip(*(c.to_pylist() for c in batch.columns)):
                pos = 0
                for key, _, entries in index_of(data):
                    if wanted is not None and key.rpartition(SEPARATOR)[2] not in wanted or needle is not None and needle not in key:
                        continue
                    for low, high, offset, size in entries:
                        if start is not None and high < start or end is not None and low >= end:
                            continue
                        kind, times, values = decode_block(block_at(data, offset, size, verify))
                        keep = np.ones(len(times), bool)
                        if start is not None:
                            keep &= times >= start
                        if end is not None:
                            keep &= times < end
                        n, at = int(keep.sum()), pos + np.flatnonzero(keep)
                        pos += len(times)
                        if not n:
                            continue
                        values = [v for v, k in zip(values, keep) if k] if isinstance(values, list) else values[keep]
                        head = {"source_id": pa.array([source] * n), "shard_id": pa.array([shard] * n, pa.int32()), "generation": pa.array([gen] * n, pa.int32()), "sequence": pa.array([seq] * n, pa.int32()), "key": pa.array([key.decode("utf-8", "replace")] * n), "pos": pa.array(at, pa.int64()), "time_ns": pa.array(times[keep])}
                        yield pa.RecordBatch.from_pydict(head | columns_of(kind, values))

    return named(contents.select("source_id", "shard_id", "generation", "sequence", "content").mapInArrow(run, POINTS))


def named(rows: DataFrame) -> DataFrame:
    """Splits the key into series, inst_id (the tag instId) and field."""
    rows = rows.withColumn("_k", composite_key(F.col("key"))).withColumn("series", F.col("_k.series")).withColumn("field", F.col("_k.field"))
    inst = F.try_element_at(parse_series_key(F.col("series"))["tags"], F.lit("instId"))
    return rows.withColumn("inst_id", inst).drop("_k", "key")


def write_tombstone(records: list[tuple[bytes, int, int]], version: int, members: int = 1) -> bytes:
    """A tombstone file of versions 1 to 4; the last may have several compressed members."""
    if version == 1:
        return b"\n".join(key for key, _, _ in records) + b"\n"
    raw = lambda some: b"".join(struct.pack(">I", len(k)) + k + struct.pack(">qq", a, b) for k, a, b in some)
    head = struct.pack(">I", 0x1500 + version)
    if version == 2:
        return head + raw(records)
    step = -(-len(records) // members) or 1
    return head + b"".join(gzip.compress(raw(records[k : k + step])) for k in range(0, len(records), step))


def read_tombstone(data: bytes) -> Iterator[tuple[bytes, int, int]]:
    """(key, first time, last time) of a tombstone file of any version."""
    version = struct.unpack(">I", data[:4])[0] - 0x1500 if len(data) >= 4 else 1
    if version not in (2, 3, 4):
        for line in data.split(b"\n"):
            if line:
                yield line, -(1 << 63), (1 << 63) - 1
        return
    flat, at = data[4:] if version == 2 else gzip.decompress(data[4:]), 0
    while at < len(flat):
        (n,) = struct.unpack_from(">I", flat, at)
        low, high = struct.unpack_from(">qq", flat, at + 4 + n)
        yield flat[at + 4 : at + 4 + n], low, high
        at += 20 + n


def tombstones(spark: SparkSession, root: str) -> DataFrame:
    """(source_id, series, field, min_time, max_time)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if rows := [(source, k.decode("utf-8", "replace"), a, b) for k, a, b in read_tombstone(data)]:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int64(), pa.int64()))], ["source_id", "key", "min_time", "max_time"])

    rows = files(spark, root, "tombstone").select("source_id", "content").mapInArrow(run, "source_id string, key string, min_time bigint, max_time bigint")
    return rows.withColumn("_k", composite_key(F.col("key"))).select("source_id", F.col("_k.series").alias("series"), F.col("_k.field").alias("field"), "min_time", "max_time")


def points(spark: SparkSession, root: str, **prune) -> DataFrame:
    """Points that are still there: `blocks` without what a tombstone of the same file covers."""
    rows = blocks(spark, root, **prune).withColumn("kind", F.lit("tsm"))
    return without_tombstones(rows, tombstones(spark, root))
