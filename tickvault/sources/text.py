"""Sources of text: line protocol, chunked query results, and spools."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickvault.functions.series import lp_line
from tickvault.sources.codecs import Corrupt, read_uvarint, uvarint


def line_protocol(spark: SparkSession, path: str, measurement: str) -> DataFrame:
    """(series tags, field, time_ns, and the value by its kind) of each field of each line that parses; other lines go."""
    lines = spark.read.text(path).select(lp_line(F.col("value"), measurement).alias("p")).where("p is not null")
    rows = lines.select(F.col("p.tags").alias("tags"), F.col("p.time_ns").alias("time_ns"), F.explode("p.fields").alias("field", "v"))
    return rows.select("tags", F.try_element_at("tags", F.lit("instId")).alias("inst_id"), "field", "time_ns", F.col("v.s").alias("v_string"), F.col("v.l").alias("v_long"), F.col("v.d").alias("v_double"), F.col("v.b").alias("v_bool"))


#: Storage types of fields and the columns they become; others become text. Fixed values.
FIELD_TYPES = {"float": "double", "integer": "bigint", "string": "string", "boolean": "boolean"}
CHUNK = "struct<error: string, results: array<struct<error: string, series: array<struct<name: string, tags: map<string, string>, columns: array<string>, values: array<array<string>>>>>>>"


def chunk_rows(chunks: DataFrame, fields: Mapping[str, str], tags: list[str], column: str = "value") -> DataFrame:
    """Rows `time, <tags>, <fields>` (names sorted) of chunked query results, a JSON text a row.

    Columns are taken by name; one that a chunk lacks, and a value that its row lacks, is null. An error in a result is raised."""
    if clash := sorted({*fields} & {*tags}):
        raise ValueError(f"both a tag and a field: {', '.join(clash)}")
    rows = chunks.select(F.from_json(column, CHUNK).alias("c")).select(F.explode("c.results").alias("r"), F.col("c.error").alias("e"))
    fault = F.coalesce("e", "r.error")
    rows = rows.select(F.when(fault.isNotNull(), F.raise_error(fault).cast("array<struct<name: string, tags: map<string, string>, columns: array<string>, values: array<array<string>>>>")).otherwise(F.col("r.series")).alias("s"))
    rows = rows.select(F.explode("s").alias("s")).select("s.columns", F.explode("s.values").alias("row"))
    at = lambda name: F.try_element_at("row", F.nullif(F.array_position("columns", name), F.lit(0)).cast("int"))
    return rows.select(at("time").cast("bigint").alias("time"), *[at(t).alias(t) for t in sorted(tags)], *[at(f).try_cast(FIELD_TYPES.get(fields[f], "string")).alias(f) for f in sorted(fields)])


def chunked_json(spark: SparkSession, path: str, fields: Mapping[str, str], tags: list[str]) -> DataFrame:
    return chunk_rows(spark.read.text(path), fields, tags)


MAGIC = b"OKDSP01\n"
BYTES, INT64 = 1, 2


def write_spool(records: list[tuple[int, bytes]], kind: int = BYTES) -> bytes:
    """One compressed frame of a spool; frames may follow each other, the first alone has the header."""
    return pa.compress(spool_header(kind) + spool_records(records), codec="zstd", asbytes=True)


def spool_header(kind: int) -> bytes:
    return MAGIC + bytes([kind])


def spool_records(records: list[tuple[int, bytes]]) -> bytes:
    return b"".join(t.to_bytes(8, "little", signed=True) + uvarint(len(v)) + v for t, v in records)


def read_spool(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(kind, time, value) of a spool of any number of frames."""
    with pa.input_stream(pa.py_buffer(data), compression="zstd") as stream:
        flat = stream.read()
    if flat[: len(MAGIC)] != MAGIC:
        raise Corrupt("not a spool")
    kind, at = flat[len(MAGIC)], len(MAGIC) + 1
    while at < len(flat):
        if at + 8 > len(flat):
            raise Corrupt("a spool cut short")
        time = int.from_bytes(flat[at : at + 8], "little", signed=True)
        n, at = read_uvarint(flat, at + 8)
        if at + n > len(flat):
            raise Corrupt("a spool cut short")
        yield kind, time, flat[at : at + n]
        at += n


def spools(spark: SparkSession, root: str) -> DataFrame:
    """(path, pos, time_ns, payload, v_long): records of binary spools below root, in their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = [(path, pos, t, v, int.from_bytes(v, "little", signed=True) if kind == INT64 else None) for pos, (kind, t, v) in enumerate(read_spool(data))]
                for k in range(0, len(rows), 50_000):
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows[k : k + 50_000]), (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int64()))], ["path", "pos", "time_ns", "payload", "v_long"])

    rows = spark.read.format("binaryFile").option("pathGlobFilter", "*.okdsp*").option("recursiveFileLookup", "true").load(root)
    return rows.select("path", "content").mapInArrow(run, "path string, pos bigint, time_ns bigint, payload binary, v_long bigint")


def tsv_spools(spark: SparkSession, path: str) -> DataFrame:
    """(path, time_ns, payload) of text spools `time<TAB>JSON`."""
    parts = F.split("value", "\t", 2)
    return spark.read.text(path).select(F.input_file_name().alias("path"), F.get(parts, F.lit(0)).try_cast("bigint").alias("time_ns"), F.get(parts, F.lit(1)).alias("payload")).where("time_ns is not null")


def write_tsv_spools(points: DataFrame, path: str) -> None:
    """A folder for each instrument and field, of compressed lines `time<TAB>JSON` in time order."""
    rows = points.select("inst_id", "field", "time_ns", F.concat(F.col("time_ns").cast("string"), F.lit("\t"), F.col("payload")).alias("value"))
    rows.repartition("inst_id", "field").sortWithinPartitions("inst_id", "field", "time_ns").drop("time_ns").write.partitionBy("inst_id", "field").option("compression", "gzip").text(path)
